"""Problem 2: language of documents and of the passages inside them.

Method: cross-parsing entropy.  The labelled text of each language, sentence after sentence, goes into a suffix automaton;
a text is parsed greedily into longest matches of the automaton, across word ends, and the language that needs fewest
phrases for the same characters wins.  A dynamic programme over the words chooses languages and where they change, at a
price for each change that is higher inside a sentence than between two.

Parsing goes word by word: what a word does to the state of an automaton (the phrases it closes, the state it leaves) is
kept, so that a text costs one look-up for each word and language.  Names inside sentences belong to no language.

Labels are noisy, so the labelled sample is purged first by the likelihood of each sentence's words; parsing needs text
that is of one language almost throughout.  The sample is bounded by ``SAMPLE_ROWS`` rows of each label, chosen by hash,
and ``SAMPLE_CHARS`` characters a language; all rows are classified.  Null, empty and wordless texts have no language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm.arrow import Shared, hashed_sample, map_rows, once
from itemforge.llm.canonical import Canonizer
from itemforge.llm.scan import join_broken, strip_running

LANGUAGES = ("pt", "en", "es")
SAMPLE_ROWS, SAMPLE_CHARS = 400, 90_000
MIN_WORDS = 6
CACHE_STEPS = 600_000
#: Bits of a count of phrases in a sum over several languages; a text would need a hundred million words to fill them.
FIELD = 32
MASK = (1 << FIELD) - 1
#: Prices of a change of language in phrases: between two sentences, and inside one.
CHANGE, CHANGE_INSIDE = 1.0, 3.0
_PIECES = re.compile(r"[.!?…“”\"«»\n]+")
_TABLE_LINE = re.compile(r"^\|.*\|[ \t]*$", re.M)
_WRAPPED = re.compile(r"\n[ \t]*(?=[a-zà-ÿ])")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_ANY_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
#: A reference line: surname in capitals, initial, source.
_REFERENCE = re.compile(r"^[^\W\d_]{3,}, [A-ZÀ-Ú]\. .*$", re.M)
_FORMULA = re.compile(r"\$[^$\n]*\$|https?://\S+|\S+@\S+")


class SuffixAutomaton:
    """All substrings of a text; answers longest matches, word by word."""

    def __init__(self, text: str):
        follow: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in follow[p]:
                follow[p][c] = cur
                p = link[p]
            if p != -1:
                q = follow[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and follow[p].get(c) == q:
                        follow[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        # One flat table: small, and nothing in it for the garbage collector to walk.
        self.follow = {(state << 21) | ord(c): to for state, by in enumerate(follow) for c, to in by.items()}
        self.start = self.follow.get(ord(" "), 0)
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}

    def _read(self, state: int, text: str) -> int | None:
        """The state after ``text``, or None where no longer match holds it."""
        for c in text:
            state = self.follow.get((state << 21) | ord(c))
            if state is None:
                return None
        return state

    def _inside(self, word: str) -> int:
        """Longest-match phrases of a word that the sample does not hold whole; an unknown character is a phrase."""
        count, at, text = 0, 0, f" {word} "
        while at < len(text):
            state, k = 0, at
            while k < len(text) and (to := self.follow.get((state << 21) | ord(text[k]))) is not None:
                state, k = to, k + 1
            count, at = count + 1, max(k, at + 1)
        return count

    def step(self, state: int, word: str) -> tuple[int, int]:
        """(state, new phrases) after a word: none while the match goes on, one if the word begins a phrase, more if it falls apart."""
        found = self.steps.get((state, word))
        if found is None:
            if len(self.steps) >= CACHE_STEPS:
                self.steps.clear()
            on = self._read(state, word + " ") if state != self.start else None
            if on is not None:
                found = on, 0
            else:
                begun = self._read(self.start, word + " ")
                found = (self.start, self._inside(word)) if begun is None else (begun, 1)
            self.steps[state, word] = found
        return found

    def phrases(self, words: list[str]) -> int:
        """Number of longest-match phrases that cover the words."""
        state, count = self.start, 0
        for w in words:
            state, new = self.step(state, w)
            count += new
        return count


def _words_of(sentence: str) -> list[str | None]:
    """Lower-case words of a sentence; names inside it and words without letters, which tell no language, are None."""
    return _lowered(_ANY_WORD.findall(sentence))


def _pieces(text: str) -> Iterator[list[str | None]]:
    """Words of every sentence that has some, as ``_words_of`` gives them."""
    for piece in _PIECES.split(text):
        if words := _ANY_WORD.findall(piece):
            yield _lowered(words)


def _lowered(words: list[str]) -> list[str | None]:
    odd = [k for k, w in enumerate(words) if not (w.islower() and w.isalpha())]
    if odd == [0] and words[0].isalpha() and len(words) > 2:
        words[0] = words[0].lower()
    elif odd:
        plain = {k: words[k].isalpha() or bool(_WORD.fullmatch(words[k])) for k in odd}
        shouted = sum(words[k].isupper() for k in odd) * 2 > len(words) - len(odd) + sum(plain.values())
        first = next((k for k in range(len(words)) if plain.get(k, True)), 0)
        for k in odd:
            w = words[k]
            words[k] = w.lower() if plain[k] and (k == first or shouted or not w[0].isupper()) else None
    return words


class Profile:
    """One automaton for each language, over the sentences of its purged sample."""

    def __init__(self, sentences: dict[str, list[list[str]]]):
        self.languages = tuple(sentences)
        self.automata = [SuffixAutomaton(_running(sentences[g])) for g in self.languages]


def _running(sentences: list[list[str]]) -> str:
    """Running text: a blank before and behind each word, a sign that no text has between sentences."""
    return "\n".join(f" {' '.join(s)} " for s in sentences)


def _bounded(sentences: list[list[str]], most: int) -> list[list[str]]:
    """Sentences from the first on, up to so many characters."""
    out, size = [], 0
    for s in sentences:
        size += sum(map(len, s)) + len(s)
        if size > most:
            break
        out.append(s)
    return out


def purged(texts: list[tuple[str, str]], rounds: int = 4) -> dict[str, list[list[str]]]:
    """Different sentences of each language from (label, text) rows with noisy labels.

    Round by round, each sentence goes to the language that most likely wrote its words by the counts of the round before;
    sentences that no language clearly wrote leave.  This only cleans the sample; languages are told by parsing.
    """
    found: dict[str, tuple[str, list[str]]] = {}
    for label, text in texts:
        for s in _PIECES.split(_REFERENCE.sub("", text)):
            w = [x for x in _words_of(s) if x]
            if len(w) >= 4:
                found.setdefault(" ".join(w), (label, w))
    sentences = list(found.values())
    given = [label for label, _ in sentences]
    languages = [g for g in LANGUAGES if g in set(given)]
    for _ in range(rounds if languages else 0):
        words = {g: Counter() for g in languages}
        for g, (_, w) in zip(given, sentences):
            if g:
                words[g].update(w)
        size = {g: sum(c.values()) + 1 for g, c in words.items()}
        given = []
        for _, w in sentences:
            score = {g: sum(math.log((words[g][x] + 0.05) / size[g]) for x in w) for g in languages}
            best = sorted(score.values(), reverse=True)
            clear = len(best) < 2 or best[0] - best[1] > 0.7 * len(w)
            given.append(max(score, key=score.get) if clear else "")
    return {g: _bounded([w for label, (_, w) in zip(given, sentences) if label == g], SAMPLE_CHARS) for g in languages}


class Classifier:
    """Passages of a text with their language and confidence; built once in each task."""

    def __init__(self, profile: Profile):
        self.profile, self.form = profile, Canonizer()
        start = tuple(a.start for a in profile.automata)
        self.joint, self.ids = [start], {start: 0}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}

    def _step(self, joint: int, word: str) -> tuple[int, int]:
        """(joint state, new phrases) of all automata after a word, kept for the next time.

        The phrases are one number: ``FIELD`` bits for each language and, above them, for the least of them, so that one sum adds all.
        """
        if len(self.steps) >= CACHE_STEPS:
            del self.joint[1:]
            self.ids = {self.joint[0]: 0}
            self.steps.clear()
            joint = 0
        after, new = [], []
        for automaton, state in zip(self.profile.automata, self.joint[joint]):
            found = automaton.steps.get((state, word)) or automaton.step(state, word)
            after.append(found[0])
            new.append(found[1])
        states = tuple(after)
        at = self.ids.get(states)
        if at is None:
            at = self.ids[states] = len(self.joint)
            self.joint.append(states)
        packed = min(new)
        for n in reversed(new):
            packed = packed << FIELD | n
        found = self.steps[joint, word] = (at, packed)
        return found

    def _unpacked(self, packed: int) -> list[int]:
        """New phrases by language, and the least of them."""
        return [packed >> FIELD * k & MASK for k in range(len(self.profile.languages) + 1)]

    def clean(self, text: str) -> str:
        """The text in its undamaged form, as far as it can be told."""
        if not text.isascii():
            text = self.form.canonical(self.form.garbled.restore(text))
        text = strip_running(text)
        if "\n" in text:
            text = _WRAPPED.sub(" ", join_broken(text))
            if "|" in text:
                text = _TABLE_LINE.sub("", text)
        if "$" in text or "@" in text:
            text = _FORMULA.sub(" ", text)
        return text

    def _units(self, text: str) -> Iterator[tuple[float, int, list[int]]]:
        """(price of a change before it, words, phrases by language) of sentences, and of single words of mixed sentences."""
        steps, none = self.steps, (0,) * len(self.profile.languages)
        for words in _pieces(text):
            at, packed = 0, 0
            for w in words:
                if w is not None:
                    try:
                        at, new = steps[at, w]
                    except KeyError:
                        at, new = self._step(at, w)
                    packed += new
            *total, least = self._unpacked(packed)
            # What changes inside could save at most; below the price of one, the sentence is of one language.
            if min(total) - least <= CHANGE_INSIDE:
                yield CHANGE, len(words), total
                continue
            at = 0
            for k, w in enumerate(words):
                cost = none
                if w is not None:
                    at, new = steps.get((at, w)) or self._step(at, w)
                    cost = self._unpacked(new)[:-1]
                yield CHANGE if k == 0 else CHANGE_INSIDE, 1, cost

    def passages(self, text: str | None) -> list[tuple[str, int, float]]:
        """(language, words, confidence) of the stretches in one language, in order."""
        if not text:
            return []
        if not self.profile.languages:
            return [("und", n, 0.0)] if (n := len(_ANY_WORD.findall(text))) else []
        text = self.clean(text)
        if ", " in text:
            text = _REFERENCE.sub("\n", text)
        units = list(self._units(text))
        if not units:
            return []
        all_ = range(len(self.profile.languages))
        total = [*map(sum, zip(*(u[2] for u in units)))]
        low = min(total)
        g = total.index(low)
        if all(u[2][g] == min(u[2]) for u in units):  # one language is best everywhere, so no change can pay
            margin = min((x for h, x in enumerate(total) if h != g), default=low + 1) - low
            n = sum(u[1] for u in units)
            return [(self.profile.languages[g], n, 1 - math.exp(-margin))] if margin >= 1 else [("und", n, 0.0)]
        best, path = [0.0] * len(total), []
        for price, _, cost in units:
            cheapest = min(all_, key=best.__getitem__)
            move = best[cheapest] + price
            frm = [g if best[g] <= move else cheapest for g in all_]
            best = [min(best[g], move) + cost[g] for g in all_]
            path.append(frm)
        g = min(all_, key=best.__getitem__)
        runs: list[list] = []
        for frm, (_, n, cost) in zip(reversed(path), reversed(units)):
            if runs and runs[-1][0] == g:
                runs[-1][1] += n
                runs[-1][2] = [a + b for a, b in zip(runs[-1][2], cost)]
            else:
                runs.append([g, n, list(cost)])
            g = frm[g]
        merged: list[list] = []
        for g, n, cost in reversed(runs):
            rest = min((cost[h] for h in all_ if h != g), default=cost[g] + n)
            margin = rest - cost[g]
            if margin < 1 and len(runs) > 1:  # a stretch that no language explains better goes with what is before it
                if merged:
                    merged[-1][1] += n
                continue
            if merged and merged[-1][0] == g:
                merged[-1][1] += n
                merged[-1][2] += margin
            else:
                merged.append([g, n, margin])
        if not merged or len(merged) == 1 and merged[0][2] < 1:
            return [("und", sum(u[1] for u in units), 0.0)]
        return [(self.profile.languages[g], n, 1 - math.exp(-m)) for g, n, m in merged]


def fit_profile(df: DataFrame, id_col: str, label_col: str, text_col: str, sample_rows: int = SAMPLE_ROWS) -> dict[str, list[list[str]]]:
    """Sentences by language from a bounded sample: ``sample_rows`` rows of each label, by hash of the key."""
    base = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").alias("g"), F.col(f"`{text_col}`").alias("t")).where(F.col("g").isin(*LANGUAGES) & (F.length("t") > 0))
    form = Canonizer()
    return purged([(r.g, join_broken(strip_running(form.canonical(form.garbled.restore(r.t))))) for r in hashed_sample(base, "i", sample_rows, "g")])


def passages(df: DataFrame, id_col: str, fields: list[str], words: dict[str, list[list[str]]]) -> DataFrame:
    """(id_linha, campo, ordem, idioma, palavras, confianca): the passages of every field; no shuffle.

    Null, empty and wordless fields give no row; an undecidable field gives ``und`` with confidence 0; repeated rows
    repeat.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    held = Shared(df.sparkSession, words)

    def make():
        tell = Classifier(once(held, Profile))

        def work(ids: list, *texts: list) -> Iterator[tuple]:
            for name, column in zip(fields, texts):
                for i, t in zip(ids, column):
                    for k, (g, n, c) in enumerate(tell.passages(t)):
                        yield i, name, k, g, n, c

        return work

    return map_rows(df.select(*[F.col(f"`{c}`") for c in (id_col, *fields)]), make, "id_linha bigint, campo string, ordem int, idioma string, palavras int, confianca double")


def language_cases(df: DataFrame, id_col: str, label_col: str, fields: list[str], words: dict[str, list[list[str]]]) -> DataFrame:
    """(id_linha, campo, idioma): languages with a passage of at least six words that differ from the row's label.

    A null, empty or unknown label differs from every language; no row comes twice for a row of ``df``; no shuffle.
    """
    held = Shared(df.sparkSession, words)

    def make():
        tell = Classifier(once(held, Profile))

        def work(ids: list, labels: list, *texts: list) -> Iterator[tuple]:
            for name, column in zip(fields, texts):
                for i, label, t in zip(ids, labels, column):
                    for g in sorted({g for g, n, _ in tell.passages(t) if n >= MIN_WORDS} - {"und", label}):
                        yield i, name, g

        return work

    return map_rows(df.select(*[F.col(f"`{c}`") for c in (id_col, label_col, *fields)]), make, "id_linha bigint, campo string, idioma string")
