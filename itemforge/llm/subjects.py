"""Problem 5: subject areas of each document.

Method: latent Dirichlet topics fitted by distributed variational steps.  Each labelled document of the sample may draw its
words only from the topics of its subjects and from shared topics, which keeps topics apart.  Topics are then mapped to
subjects through their top terms: a topic stands for the subject whose labelled documents use most of its top terms, and
for none if no subject has the most of them.  A new document's topic proportions are inferred over all topics; they say
what each of its words was drawn for, and the document gets the subjects that hold a share of its proportions and at least
one word's worth of at least two of its sentences.

The fit takes at most ``FIT_DOCUMENTS`` labelled documents, chosen by hash; each step is a Spark job over the sample
whose partial counts are added by one small shuffle.  Every document is assigned.  Null and empty texts get no subject,
and so do texts in which no subject reaches two sentences.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.arrow import Shared, map_rows, once
from itemforge.llm.reading import labelled_sample
from itemforge.llm.sentences import Splitter

#: The subjects of the bank.
SUBJECTS = (
    "fisica", "quimica", "biologia", "historia", "geografia", "filosofia", "sociologia", "direito",
    "literatura", "linguistica", "artes", "esporte", "informatica", "matematica", "estatistica", "financas",
)
SHARED = 4
FIT_DOCUMENTS = 2500
STEPS = 8
ALPHA, ALPHA_SHARED, BETA, LEAST_DOCUMENTS = 0.1, 8.0, 0.02, 4
#: Top terms that the inspection looks at, and the share of them that must speak for one subject.
TERMS, TERM_SHARE = 12, 0.5
#: A word counts as drawn for a topic from this probability on, given the document's proportions, and for as much as
#: the topic has of it without any document, if that is at least the second value.
DRAWN, OWN = 0.6, 0.5
#: Rounds of the inference of a document's topic proportions, and what a subject must hold of those of all subjects.
ROUNDS, LEAST_SHARE = 5, 0.02
#: A sentence treats a subject whose topics explain so many of its words; a document needs so many such sentences.
SENTENCE_MASS, DOCUMENT_SENTENCES = 0.9, 2


def _expect(doc: dict[str, int], allowed: list[int], phi: dict[str, np.ndarray], rounds: int = 6) -> tuple[np.ndarray, list[tuple[str, np.ndarray]]]:
    """Variational step of one document over its allowed topics: topic weights and expected counts by word."""
    words = [w for w in doc if w in phi]
    prior = np.array([ALPHA if j < len(SUBJECTS) else ALPHA_SHARED for j in allowed])
    gamma = prior + 1.0
    if not words:
        return gamma, []
    table = np.array([phi[w][allowed] for w in words])
    counts = np.array([doc[w] for w in words], float)[:, None]
    for _ in range(rounds):
        r = table * (gamma / gamma.sum())
        r /= r.sum(1, keepdims=True) + 1e-30
        gamma = prior + (counts * r).sum(0)
    return gamma, list(zip(words, counts * r))


def fit_topics(spark: SparkSession, sample: list[tuple[str, list[str]]], steps: int = STEPS) -> "TopicModel":
    """Topics of a bounded labelled sample, by ``steps`` distributed variational steps."""
    k = len(SUBJECTS) + SHARED
    if not sample:
        return TopicModel({}, np.ones(k) / k, {})
    least = min(LEAST_DOCUMENTS, 1 + len(sample) // 100)
    rows = [(t, [SUBJECTS.index(g) for g in gs if g in SUBJECTS]) for t, gs in sample]
    parts = max(1, min(spark.sparkContext.defaultParallelism, len(rows) // 100))
    texts = spark.createDataFrame(rows, "t string, g array<int>").repartition(parts)

    def bag():
        cut = Splitter()

        def work(ts: list, gs: list) -> Iterator[tuple]:
            for t, g in zip(ts, gs):
                c = Counter(w for s in cut.words(t) for w in s if len(w) > 1)
                yield list(c), list(c.values()), g

        return work

    bags = map_rows(texts, bag, "w array<string>, n array<int>, g array<int>").cache()
    spread = {r.w: r.n for r in bags.select(F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect()}
    rng = np.random.default_rng(7)
    words = sorted(spread)
    counts = {w: rng.uniform(0.5, 1.5, k) for w in words}
    labelled = {w: np.zeros(len(SUBJECTS)) for w in words}
    first = bags.select(F.explode("g").alias("g"), "w").select("g", F.explode("w").alias("w")).groupBy("g", "w").agg(F.count(F.lit(1)).alias("n")).collect()
    for r in first:
        if r.w in counts:
            counts[r.w][r.g] += r.n
            labelled[r.w][r.g] += r.n
    for w in words:
        counts[w][len(SUBJECTS) :] += rng.uniform(0.5, 1.0, SHARED) * spread[w] / SHARED
    for _ in range(steps):
        total = np.sum([counts[w] for w in words], axis=0) + BETA * len(words)
        phi = {w: (counts[w] + BETA) / total for w in words}
        held = spark.sparkContext.broadcast(phi)

        def step():
            def work(ws: list, ns: list, gs: list) -> Iterator[tuple]:
                found: dict[str, np.ndarray] = {}
                for w, n, g in zip(ws, ns, gs):
                    allowed = [*g, *range(len(SUBJECTS), k)]
                    for x, e in _expect(dict(zip(w, n)), allowed, held.value)[1]:
                        if x not in found:
                            found[x] = np.zeros(k)
                        found[x][allowed] += e
                for x, e in found.items():
                    yield x, e.tolist()

            return work

        added = (
            map_rows(bags, step, "w string, e array<double>").groupBy("w")
            .agg(*[F.sum(F.element_at("e", j + 1)).alias(f"e{j}") for j in range(k)]).collect()
        )
        counts = {w: np.zeros(k) for w in words}
        for r in added:
            counts[r[0]] = np.array(r[1:], float)
        held.unpersist()
    bags.unpersist()
    return TopicModel(counts, np.sum([counts[w] for w in words], axis=0), labelled)


class TopicModel:
    """Expected counts of each word by topic, the map of topics to subjects, and the inference of proportions."""

    def __init__(self, counts: dict[str, np.ndarray], weight: np.ndarray, labelled: dict[str, np.ndarray]):
        self.counts, self.weight, self.labelled = counts, weight, labelled
        words = sorted(counts)
        self.row = {w: i for i, w in enumerate(words)}
        self.phi = (np.array([counts[w] for w in words]).reshape(len(words), len(weight)) + BETA) / (weight + BETA * max(len(words), 1))
        self.map = self.mapped()
        self.prior = np.array([ALPHA if g is not None else ALPHA_SHARED for g in self.map])
        self.known = [j for j, g in enumerate(self.map) if g is not None]
        own = (self.phi / self.phi.sum(1, keepdims=True))[:, self.known]
        self.own = np.where(own >= OWN, own, 0.0)
        self.into = np.eye(len(SUBJECTS))[[self.map[j] for j in self.known]].reshape(len(self.known), len(SUBJECTS))

    def top_terms(self, most: int = TERMS) -> dict[int, list[str]]:
        """Terms of each topic by count times share of the term's own counts."""
        out = {}
        for j in range(len(self.weight)):
            score = {w: c[j] * c[j] / (c.sum() + 1e-9) for w, c in self.counts.items()}
            out[j] = sorted(score, key=lambda w: (-score[w], w))[:most]
        return out

    def mapped(self) -> list[int | None]:
        """Subject of each topic: the one in whose labelled documents most of its top terms are at home, relative to its size."""
        size = np.sum(list(self.labelled.values()), axis=0) + 1 if self.labelled else np.ones(len(SUBJECTS))
        out: list[int | None] = []
        for terms in self.top_terms().values():
            home = Counter(int((self.labelled[w] / size).argmax()) for w in terms if self.labelled[w].any())
            sure = Counter(int((self.labelled[w] / size).argmax()) for w in terms if (self.labelled[w] / size).max() > TERM_SHARE * (self.labelled[w] / size).sum())
            best = home.most_common(1)
            out.append(best[0][0] if best and sure[best[0][0]] > TERM_SHARE * len(terms) else None)
        return out

    def subjects(self, sentences: list[list[str]]) -> list[tuple[str, int, float]]:
        """(subject, sentences that treat it, share of the subjects' proportions), most treated first."""
        row = self.row
        ids, ends = [], []
        for s in sentences:
            ids += [row[w] for w in s if w in row]
            ends.append(len(ids))
        if not ids or not self.known:
            return []
        table = self.phi[ids]
        gamma = self.prior + 1.0
        for _ in range(ROUNDS):  # gamma = prior + what the words draw in proportion to it
            gamma = self.prior + gamma * ((1.0 / (table @ gamma)) @ table)
        drawn = (table * gamma)[:, self.known] >= DRAWN * (table @ gamma)[:, None]
        upto = np.zeros((len(ids) + 1, len(SUBJECTS)))
        np.cumsum((drawn * self.own[ids]) @ self.into, axis=0, out=upto[1:])
        edges = upto[[0, *ends]]
        treated = (edges[1:] - edges[:-1] >= SENTENCE_MASS).sum(0)
        share = (gamma - self.prior)[self.known] @ self.into
        share /= share.sum() + 1e-12
        found = np.flatnonzero((treated >= DOCUMENT_SENTENCES) & (share >= LEAST_SHARE))
        return [(SUBJECTS[j], int(treated[j]), float(share[j])) for j in sorted(found.tolist(), key=lambda j: (-treated[j], j))]


def subject_areas(df: DataFrame, id_col: str, text_col: str, model: TopicModel) -> DataFrame:
    """(id_linha, assunto, frases, proporcao) of every document, one row for each of its subjects; no shuffle.

    Null, empty and wordless texts, and texts without a subject of two sentences, give no row; repeated rows repeat.
    Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    held = Shared(df.sparkSession, model)

    def make():
        known, cut = once(held, _same), Splitter()

        def work(ids: list, texts: list) -> Iterator[tuple]:
            for i, t in zip(ids, texts):
                if t:
                    for g, n, share in known.subjects(cut.words(t)):
                        yield i, g, n, share

        return work

    return map_rows(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), make, "id_linha bigint, assunto string, frases int, proporcao double")


def _same(model: TopicModel) -> TopicModel:
    return model


__all__ = ["fit_topics", "labelled_sample", "subject_areas", "TopicModel", "SUBJECTS"]
