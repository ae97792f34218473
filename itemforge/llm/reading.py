"""Problem 4: reading level of each document.

Method: every sentence is classified by a regularised multinomial model over words and the letter triples inside them;
the weights of a word (its own and its triples') are added up once and kept.  A document's level comes from the mean of
its sentences' distributions through a second, calibrated model.  The fit takes at most ``FIT_DOCUMENTS`` labelled
documents, chosen by hash; every document is classified.  Null and empty texts have no level; a text without words gets
the most frequent level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from itemforge.llm.arrow import Shared, map_rows, once
from itemforge.llm.sentences import Splitter

LEVELS = ("basico", "medio", "avancado")
FIT_DOCUMENTS = 1500
PENALTY = 3e-3


def _triples(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def _length_class(n: int) -> str:
    return f"#{min(n // 5, 10)}"


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _adam(grad, shape: tuple[int, ...], steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    for t in range(1, steps + 1):
        g = grad(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


class LevelModel:
    """Weights of words, triples and sentence lengths, and the calibration of documents."""

    def __init__(self, word_weights: dict[str, np.ndarray], triple_weights: dict[str, np.ndarray], bias: np.ndarray, calibration: np.ndarray, prior: int):
        self.own, self.triple, self.bias, self.calibration, self.prior = word_weights, triple_weights, bias, calibration, prior
        self.cache: dict[str, tuple[float, ...]] = {}

    def weight(self, word: str) -> tuple[float, ...]:
        w = self.cache.get(word)
        if w is None:
            if len(self.cache) > 400_000:
                self.cache.clear()
            v = np.zeros(len(LEVELS))
            if word[0] != "#":
                ts = _triples(word)
                for t in ts:
                    if (x := self.triple.get(t)) is not None:
                        v = v + x / len(ts)
            if (x := self.own.get(word)) is not None:
                v = v + x
            w = self.cache[word] = tuple(float(x) for x in v)
        return w

    def document(self, sentences: list[list[str]]) -> np.ndarray:
        """Mean of the sentence distributions, weighted by the root of their length."""
        cache, rows, mass = self.cache, [], []
        for words in sentences:
            a = b = c = 0.0
            for w in words:
                x = cache.get(w) or self.weight(w)
                a += x[0]
                b += x[1]
                c += x[2]
            n = len(words) or 1
            x = self.weight(_length_class(len(words)))
            rows.append((a / n**0.5 + x[0] + self.bias[0], b / n**0.5 + x[1] + self.bias[1], c / n**0.5 + x[2] + self.bias[2]))
            mass.append(n**0.5)
        if not rows:
            return np.full(len(LEVELS), 1 / len(LEVELS))
        p = _softmax(np.array(rows))
        return (np.array(mass) @ p) / sum(mass)

    def level(self, sentences: list[list[str]]) -> tuple[str, float]:
        """(level, calibrated probability)."""
        if not sentences:
            return LEVELS[self.prior], 0.0
        d = self.document(sentences)
        p = _softmax((np.append(np.log(d + 1e-3), 1.0) @ self.calibration)[None])[0]
        k = int(p.argmax())
        return LEVELS[k], float(p[k])


def fit_levels(documents: list[tuple[list[list[str]], str]]) -> LevelModel:
    """Fit sentence and document models on labelled documents.

    Documents are calibrated on what a sentence model fitted on the other half of them says, so that confidence is not that of
    texts already seen.
    """
    model = _fit_sentences(documents)
    k = len(LEVELS)
    held, target = [], []
    for mine, other in ((documents[0::2], documents[1::2]), (documents[1::2], documents[0::2])) if len(documents) > 40 else ((documents, documents),):
        judge = model if other is documents else _fit_sentences(other)
        held += [np.append(np.log(judge.document(ss) + 1e-3), 1.0) for ss, _ in mine]
        target += [LEVELS.index(g) for _, g in mine]
    x, y = np.array(held or [[0.0] * k + [1.0]]), np.eye(k)[target or [0]]
    model.calibration = _adam(lambda c: x.T @ (_softmax(x @ c) - y) / len(x) + 1e-3 * c, (k + 1, k), 300, 0.1)
    return model


def _fit_sentences(documents: list[tuple[list[list[str]], str]]) -> LevelModel:
    """The regularised model of sentences, its documents not calibrated yet."""
    y_doc = np.array([LEVELS.index(g) for _, g in documents] or [0])
    k = len(LEVELS)
    sentences = [(s, d) for d, (ss, _) in enumerate(documents) for s in ss if s]
    seen = Counter(w for s, _ in sentences for w in set(s))
    vocabulary = {w: i for i, w in enumerate(w for w, n in seen.items())}
    lengths = {_length_class(5 * i): len(vocabulary) + i for i in range(11)}
    rows, cols, vals = [], [], []
    for r, (s, _) in enumerate(sentences):
        x = len(s) ** -0.5
        for w in s:
            rows.append(r), cols.append(vocabulary[w]), vals.append(x)
        rows.append(r), cols.append(lengths[_length_class(len(s))]), vals.append(1.0)
    triples: dict[str, int] = {}
    wr, wt, wv = [], [], []
    for w, i in vocabulary.items():
        ts = _triples(w)
        for t in ts:
            wr.append(i), wt.append(triples.setdefault(t, len(triples))), wv.append(1 / len(ts))
    rows, cols, vals, wr, wt, wv = (np.array(a) for a in (rows, cols, vals, wr, wt, wv))
    n_words, n_cols, n_triples = len(vocabulary), len(vocabulary) + len(lengths), len(triples)
    frequent = np.zeros(n_cols, bool)
    frequent[[i for w, i in vocabulary.items() if seen[w] >= 3]] = True
    frequent[n_words:] = True
    y = np.eye(k)[y_doc[[d for _, d in sentences]]] if sentences else np.zeros((0, k))
    n = max(len(sentences), 1)

    def spread(w: np.ndarray) -> np.ndarray:
        own, tri = w[:n_cols] * frequent[:, None], w[n_cols : n_cols + n_triples]
        total = own.copy()
        for j in range(k):
            total[:, j] += np.bincount(wr, wv * tri[wt, j], n_cols) if len(wr) else 0
        return total

    def grad(w: np.ndarray) -> np.ndarray:
        total = spread(w)
        z = np.stack([np.bincount(rows, vals * total[cols, j], n) for j in range(k)], 1) + w[-1] if len(rows) else np.zeros((n, k))
        err = (_softmax(z)[: len(y)] - y) / n
        g = np.zeros_like(w)
        if len(rows):
            by_col = np.stack([np.bincount(cols, vals * err[rows, j], n_cols) for j in range(k)], 1)
            g[:n_cols] = by_col * frequent[:, None]
            g[n_cols : n_cols + n_triples] = np.stack([np.bincount(wt, wv * by_col[wr, j], n_triples) for j in range(k)], 1)
            g[-1] = err.sum(0)
        return g + PENALTY * w / 10

    w = _adam(grad, (n_cols + n_triples + 1, k), 120, 0.1)
    own = {x: w[i] for x, i in vocabulary.items() if frequent[i]} | {x: w[i] for x, i in lengths.items()}
    return LevelModel(own, {t: w[n_cols + i] for t, i in triples.items()}, w[-1], np.eye(k + 1, k), int(np.bincount(y_doc, minlength=k).argmax()))


def labelled_sample(df: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, label_col: str, most: int, strata: str | None = None) -> list[tuple[str, list[str]]]:
    """(text, labels) of at most ``most`` labelled rows with text, chosen by hash of the key; the sample is bounded.

    With ``strata``, a column such as the language label, up to ``most`` / 3 rows come from each of its values, so that
    rare ones are learned too; eight times ``most`` labelled keys are looked at for that.
    """
    marks = labels.select(F.col(f"`{label_id}`").alias("k"), F.col(f"`{label_col}`").alias("g")).where("k is not null and g is not null")
    keys = marks.groupBy("k").agg(F.array_sort(F.collect_set("g")).alias("g"))
    asked = (8 if strata else 2) * most
    under = min(1 << 30, int((1 << 30) * 1.1 * asked / max(keys.count(), 1)))  # so that what is looked at does not grow with the labels
    chosen = keys.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < under)
    kind = F.col(f"`{strata}`") if strata else F.lit(None).cast("string")
    text = df.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").alias("t"), kind.alias("s")).where(F.length("t") > 0)
    found = text.join(F.broadcast(chosen), "k").withColumn("h", F.pmod(F.xxhash64("k"), F.lit(1 << 30)))
    if strata:
        turn = F.row_number().over(Window.partitionBy("s").orderBy("h", "k"))
        found = found.withColumn("r", turn).where(F.col("r") <= most // 3)
    rows = sorted(found.select("h", "k", "t", "g").collect(), key=lambda r: (r.h, r.k))[:most]
    return [(r.t, list(r.g)) for r in rows]


def reading_levels(df: DataFrame, id_col: str, text_col: str, model: LevelModel) -> DataFrame:
    """(id_linha, nivel, confianca) of every row whose text is neither null nor empty; no shuffle.

    A text without words gets the most frequent level with confidence 0; ties go to the easier level; repeated rows
    repeat.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    held = Shared(df.sparkSession, model)

    def make():
        known, cut = once(held, _same), Splitter()

        def work(ids: list, texts: list) -> Iterator[tuple]:
            for i, t in zip(ids, texts):
                if t:
                    yield i, *known.level(cut.words(t))

        return work

    return map_rows(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), make, "id_linha bigint, nivel string, confianca double")


def _same(model: LevelModel) -> LevelModel:
    return model
