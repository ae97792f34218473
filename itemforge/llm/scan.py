"""Problem 1: what a scanned page leaves in a text, and continuous readable text in its place.

Method: running lines are weighed and taken out (``itemforge.llm.running``); what is left is read as one stream of letters
across line ends.  Where the stream is odd (a word broken at a line's end, a word that the lexicon does not hold) a lattice
of readings is laid over its letters and those beside it: lexicon words, known compounds with their hyphen, misread words
with their confusions undone, and the letters as they are.  A path may join across blanks and line ends and part where
nothing stood, each at a price; the cheapest path decides words, joins, cuts and confusions together.  A second dynamic
programme chooses the paragraph ends.

The lexicon comes from all distinct texts: words from a share of them on, letter triples, compounds with a hyphen.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from itemforge.llm.running import open_shapes, running, strip_running

__all__ = ["Lexicon", "Reader", "fit_lexicon", "join_broken", "paragraphs", "scan_traces", "strip_running"]

#: Where a running line stood; a sentence it interrupted goes on.
_CUT = "\ue020"
#: A word broken at the end of a line, also where running lines stood between its halves.
BROKEN = re.compile(rf"([^\W\d_]{{1,30}})[-¬‐] ?\n(?:[ \t]*{_CUT}?[ \t]*\n)*[ \t]*([^\W\d_]{{1,30}})")
_HYPHEN_END = re.compile(r"[-¬‐] ?\n")


def join_broken(text: str) -> str:
    """Words broken across lines made whole without a lexicon; other line ends stay."""
    return BROKEN.sub(r"\1\2", text) if _HYPHEN_END.search(text) else text


# ---------------------------------------------------------------------------------------------------------------------
# Words


#: What the reader of scanned pages wrote -> what stood there.
CONFUSIONS = (
    ("@", "a"), ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("5", "ã"), ("6", "b"), ("9", "g"), ("8", "b"), ("4", "a"), ("3", "e"), ("|", "l"),
    ("c", "e"), ("l", "i"), ("f", "t"), ("ri", "n"), ("ii", "u"), ("rn", "m"), ("h", "li"), ("g", "ç"), ("vv", "w"), ("cl", "d"), ("i", "l"),
)
#: A word belongs to the lexicon from this share of all words on, and at least from this count.
LEXICON_SHARE, LEXICON_LEAST = 4e-6, 8
#: Letter triples count from this share of all words on; a shape of lines recurs from this share of the texts, and this count, on.
TRIPLE_SHARE, SHAPE_SHARE, SHAPE_LEAST = 1e-6, 2e-4, 8
#: A lexicon word explains an unknown one only if it is this many times as frequent.
RATIO = 20
_TOKEN = re.compile(r"[\w@|]+")
_PLAIN = re.compile(r"[^\W\d_]+")
_SKIPPED = re.compile(r"\$[^$\n]*\$|https?://\S+|[\w.+-]+@[\w-]+\.[\w.-]+|(?<!\w)@\w+")
_DOTTED = re.compile(r"\.\w")
_ODD = re.compile(r"[0-9@|]")
_MEASURE = re.compile(r"\d[\d.,]* ?$")


_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
#: Prices: a confusion, a blank dropped, a blank set, a letter of a word that the lexicon does not hold.
CONFUSED, DROPPED, SET, UNKNOWN = 4.0, 3.0, 3.0, 3.5
#: Beside these signs, the last of which stands for a lost character, a word is part of a longer one.
_BESIDE = "-’'\ufffd"
#: Words of one letter that a path may use, and the longest piece of a path.
SHORT_WORDS, LONGEST_PIECE = "aoeéày", 40


def count_words(texts: list[str | None]) -> dict[str, int]:
    """Lower-case words of letters and compounds with their counts, words broken across lines counted whole; open shapes of lines
    under a line end."""
    found: Counter[str] = Counter()
    for t in texts:
        if t:
            if "\n" in t:
                found.update("\n" + s for s in open_shapes(t))
            t = join_broken(t).lower()
            found.update(_PLAIN.findall(t))
            if "-" in t:
                found.update(_COMPOUND.findall(t))
    return found


class Lexicon:
    """Frequent words, the letter triples of all words and compounds with a hyphen, all with counts; shapes of lines that recur."""

    def __init__(self, words: dict[str, int], triples: dict[str, int], total: int, compounds: dict[str, int] | None = None, shapes: frozenset[str] = frozenset()):
        self.words, self.triples, self.total, self.compounds, self.shapes = words, triples, max(total, 1), compounds or {}, shapes


def without_misreadings(words: dict[str, int]) -> dict[str, int]:
    """The words without those of four letters and more that one confusion makes of a word ``RATIO`` times as frequent."""
    probe = Reader(Lexicon(words, {}, 0))
    return {w: n for w, n in words.items() if len(w) < 4 or all(words.get(v, 0) < RATIO * n for v in probe._variants(w, False))}


class Reader:
    """Finds the traces of a scanned page and gives back continuous text; built once in each task."""

    def __init__(self, lexicon: Lexicon):
        from itemforge.llm.canonical import Canonizer

        self.lexicon, self.form = lexicon, Canonizer()
        self.known: dict[str, str | None] = {}
        self.paths: dict[tuple[str, ...], tuple[str, tuple[str, ...]]] = {}
        self.by_first: dict[str, list[tuple[str, str]]] = {}
        for seen, meant in CONFUSIONS:
            self.by_first.setdefault(seen[0], []).append((seen, meant))

    def _variants(self, word: str, both: bool = True) -> list[str]:
        """The word with one confusion undone, or with two."""
        one: dict[str, None] = {}
        for i, c in enumerate(word):
            for seen, meant in self.by_first.get(c, ()):
                if word.startswith(seen, i):
                    one[word[:i] + meant + word[i + len(seen) :]] = None
        two: dict[str, None] = {}
        if both and len(word) > 4:
            for w in one:
                for i, c in enumerate(w):
                    for seen, meant in self.by_first.get(c, ()):
                        if w.startswith(seen, i):
                            two[w[:i] + meant + w[i + len(seen) :]] = None
        return [*one, *(w for w in two if w not in one and w != word)]

    def _weakest(self, word: str, like: str) -> float:
        """Count of the rarest letter triple of ``word`` among those ``like`` does not have."""
        padded, other = f"^{word}$", {f"^{like}$"[i : i + 3] for i in range(len(like))}
        fresh = [t for i in range(len(padded) - 2) if (t := padded[i : i + 3]) not in other]
        return min((self.lexicon.triples.get(t, 0) for t in fresh), default=0)

    def reading(self, word: str) -> str | None:
        """What a misrecognised word stood for, or None if the word stands as it is (kept in a cache)."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > 300_000:
            self.known.clear()
        low = word.lower()
        found = None
        if low not in self.lexicon.words and low[::-1] not in self.lexicon.words:
            own, triples = self.lexicon.triples.get("#" + low, 0), self.lexicon.triples
            padded = f"^{low}$"
            odd = bool(_ODD.search(low)) or min(triples.get(padded[i : i + 3], 0) for i in range(len(low))) <= 2e-5 * self.lexicon.total
            best = 0
            for v in self._variants(low, odd):
                n = self.lexicon.words.get(v, 0)
                if n > best and n >= RATIO * own:
                    best, found = n, v
            if found is None and odd and (len(low) >= 5 or _ODD.search(low)):
                found = self._by_triples(low)
            if found and word[0].isupper():
                found = found.upper() if word.isupper() and len(word) > 1 else found[0].upper() + found[1:]
        self.known[word] = found
        return found

    def _by_triples(self, low: str) -> str | None:
        """For words outside the lexicon, such as names: the reading whose letter triples are usual, if these are not."""
        usual = 2e-5 * self.lexicon.total
        odd = bool(_ODD.search(low))
        best, found = 0.0, None
        for v in self._variants(low):
            if not v.isalpha():
                continue
            here, there = self._weakest(low, v), self._weakest(v, low)
            if there > best and (odd and there > 0 or here <= 0.002 * there and there >= usual):
                best, found = there, v
        return found

    def _price(self, word: str) -> float:
        return math.log(self.lexicon.total / self.lexicon.words[word])

    def path(self, units: tuple[str, ...], broken: bool = False) -> tuple[str, tuple[str, ...]]:
        """(text, what was done) of the cheapest path over the letters of neighbouring units (kept in a cache).

        Units are the halves of a broken word, or words beside each other.  A piece is a lexicon word, a known compound over
        a broken end, a unit (or the whole of a broken word) with its confusions undone, or one left as it is.
        """
        key = (*units, "-" if broken else " ")
        if key in self.paths:
            return self.paths[key]
        if len(self.paths) > 200_000:
            self.paths.clear()
        words, letters = self.lexicon.words, "".join(units)
        ends = {0}
        for u in units:
            ends.add(max(ends) + len(u))
        n = len(letters)
        inner = ends - {0, n}
        best: list[tuple[float, str, tuple[str, ...]] | None] = [(0.0, "", ())] + [None] * n
        for e in range(1, n + 1):
            for b in range(max(0, e - LONGEST_PIECE) if n <= LONGEST_PIECE else 0, e):
                if best[b] is None or n > LONGEST_PIECE and not (b in ends and e in ends):
                    continue
                piece, crossed = letters[b:e], [k for k in inner if b < k < e]
                low = piece.lower()
                whole = (b, e) == (0, n) if broken else b in ends and e in ends and not crossed
                options: list[tuple[float, str, tuple[str, ...]]] = []
                if low in words and (len(low) > 1 or low in SHORT_WORDS):
                    options.append((self._price(low), piece, ()))
                elif whole:
                    options.append((UNKNOWN * len(piece), piece, ()))
                    if (r := self.reading(piece) if _candidate(piece) else None) is not None:
                        options.append((self._price(r.lower()) + CONFUSED if r.lower() in words else UNKNOWN * len(piece) - 1, r, ("sinal",)))
                if broken and whole and (compound := "-".join(units).lower()) in self.lexicon.compounds:
                    options.append((math.log(self.lexicon.total / self.lexicon.compounds[compound]), "-".join(units), ()))
                for cost, text, done in options:
                    if broken:
                        done += ("quebra",) * bool(crossed or e in inner)
                    else:
                        cost += DROPPED * len(crossed)
                        done += ("corte",) * len(crossed)
                    if e < n and (broken or e not in inner):
                        if broken and not letters.islower():  # names are not parted
                            continue
                        cost += SET
                        done += ("junta",)
                    cost += best[b][0]
                    if best[e] is None or cost < best[e][0] - 1e-9:
                        best[e] = (cost, best[b][1] + (" " if b else "") + text, best[b][2] + done)
        found = best[n]
        self.paths[key] = out = (found[1], found[2]) if found else (("-" if broken else " ").join(units), ())
        return out

    def _odd(self, text: str) -> dict[str, str | None]:
        """Words that the lexicon does not hold, each with its confusions undone, or None where it stands as it is."""
        known, words = self.known, self.lexicon.words
        odd: dict[str, str | None] = {}
        for w in set(_TOKEN.findall(text)):
            if w not in words:
                r = known.get(w, w)
                if r is w:
                    r = self.reading(w) if _candidate(w) else known.setdefault(w, None)
                if r is not None or w.islower() and w.isalpha() and len(w) > 1:
                    odd[w] = r
        return odd

    def decode(self, text: str | None) -> tuple[Counter, str | None]:
        """(what was done, text): kinds are ``linha`` (running line taken out), ``quebra`` (broken word joined), ``sinal`` (misread
        word read), ``corte`` (torn word joined), ``junta`` (glued words parted).  Null and empty texts stay; lines stay lines.
        """
        done: Counter = Counter()
        if not text:
            return done, text
        lines = running(text, self.lexicon.shapes)
        if lines:
            done["linha"] = len(lines)
            out, at = [], 0
            for b, e in lines:
                out += [text[at:b], _CUT]
                at = e
            text = "".join(out) + text[at:]
        if _HYPHEN_END.search(text):

            def whole(m: re.Match) -> str:
                if _CUT in m.group() and not m.group(2)[0].islower():
                    return m.group()
                joined, did = self.path((m.group(1), m.group(2)), True)
                done.update(did if "quebra" in did else (*did, "quebra"))
                return joined

            text = BROKEN.sub(whole, text)
        odd = self._odd(text)
        text = self._words(text, odd, done) if odd else text
        return done, _REJOIN.sub(" ", text).replace(_CUT, "") if lines else text

    def _words(self, text: str, odd: dict[str, str | None], done: Counter) -> str:
        """The text with odd words read, alone or with the words beside them."""
        skip = sorted(m.span() for m in _SKIPPED.finditer(text)) if "$" in text or "@" in text or "http" in text else []
        at, out, last = 0, [], 0
        tokens = list(_TOKEN.finditer(text))
        for k, m in enumerate(tokens):
            w = m.group()
            b, e = m.span()
            if w not in odd or b < last:
                continue
            while at < len(skip) and skip[at][1] <= b:
                at += 1
            if at < len(skip) and skip[at][0] < e or _DOTTED.match(text, e) or b > 1 and text[b - 1] == "." and text[b - 2].isalpha():
                continue
            if odd[w] is not None:
                if len(w) <= 2 and _MEASURE.search(text[max(0, b - 12) : b]) or b and text[b - 1] in "-’'" or e < len(text) and text[e] in "-’'" and len(w) < 4:
                    continue
                out += [text[last:b], odd[w]]
                last = e
                done["sinal"] += 1
                continue
            if b and text[b - 1] in _BESIDE or e < len(text) and text[e] in _BESIDE or w[::-1] in self.lexicon.words:
                continue
            found = self._beside(text, tokens, k, last)
            if found:
                begin, end, read, did = found
                out += [text[last:begin], read]
                last = end
                done.update(did)
        return "".join(out) + text[last:]

    def _beside(self, text: str, tokens: list[re.Match], k: int, last: int) -> tuple[int, int, str, tuple[str, ...]] | None:
        """(begin, end, text, what was done) where an unknown word is glued, or torn from the word beside it."""
        near = lambda a, b: text[a.end() : b.start()] == " " and a.group().islower() and b.group().islower() and (a.group() + b.group()).isalpha()
        options = []
        if k + 1 < len(tokens) and near(tokens[k], tokens[k + 1]) and tokens[k].group() + tokens[k + 1].group() in self.lexicon.words:
            options.append((tokens[k], tokens[k + 1]))
        if k and tokens[k - 1].start() >= last and near(tokens[k - 1], tokens[k]) and tokens[k - 1].group() + tokens[k].group() in self.lexicon.words:
            options.append((tokens[k - 1], tokens[k]))
        if len(tokens[k].group()) > 5 and not self.lexicon.triples.get("#" + tokens[k].group()):
            options.append((tokens[k],))
        for group in options:
            read, did = self.path(tuple(m.group() for m in group))
            if did and len(read.split()) < 4:
                return group[0].start(), group[-1].end(), read, did
        return None

    def clean(self, text: str | None) -> str | None:
        """The canonical form on which traces are sought."""
        return text if not text or text.isascii() else self.form.canonical(self.form.garbled.restore(text))

    def repair(self, text: str | None) -> str | None:
        """Continuous readable paragraphs; null stays null and empty stays empty."""
        done, text = self.decode(self.clean(text))
        return paragraphs(text) if text else text


_REJOIN = re.compile(rf"(?<![.!?:;\s])[ \t]*\n[ \t]*{_CUT}[ \t]*\n[ \t]*(?=[^\W\d_])")


def _candidate(word: str) -> bool:
    """Words that can be misrecognised: with letters, not a code or a measure."""
    letters = sum(c.isalpha() for c in word)
    if letters < len(word):
        if letters < 2 or sum(c.islower() for c in word) < 2 and not word[0].isupper():
            return False
        if word[0].isdigit() and letters < 3:
            return False
        return not (word.isupper() and len(word) < 5)
    return len(word) >= 2 and (word.islower() or word[1:].islower() or word.isupper() and len(word) > 3)


#: Costs of the paragraph choice.
_JOIN_AFTER_STOP, _JOIN_BEFORE_CAPITAL, _BREAK_INSIDE, _SHORT = 1.0, 0.6, 2.5, 0.8
_OWN_LINE = re.compile(r"^\s*(?:\||\d{1,2}[.)] |[-•*] |[A-Ea-e][.)] |#)")


def paragraphs(text: str) -> str:
    """Lines joined into paragraphs; dynamic programming chooses for each line end whether a paragraph ends there.

    The state is the choice at the previous line end, so that runs of short lines (verse, lists, tables) keep their
    line ends together.
    """
    lines = text.split("\n")
    if len(lines) < 2:
        return text
    widest = max(len(x) for x in lines) or 1
    best = {True: 0.0, False: 1e9}
    back: list[dict[bool, bool]] = []
    for a, b in zip(lines, lines[1:]):
        verse = a.rstrip()[-1:] == "," and len(a) < 40 and len(b) < 40 and max(len(a), len(b)) < 0.7 * widest
        fixed = verse or not a.strip() or not b.strip() or _OWN_LINE.match(a) or _OWN_LINE.match(b)
        ended = a.rstrip()[-1:] in ".!?:;…”\"" if a.strip() else True
        capital = b.lstrip()[:1].isupper() or b.lstrip()[:1] in "“\"¿¡—"
        join = 9.0 if fixed else _JOIN_AFTER_STOP * ended + _JOIN_BEFORE_CAPITAL * capital + _SHORT * (len(a) < 0.5 * widest)
        split = 0.0 if fixed else _BREAK_INSIDE * (not ended) * (1 if not capital else 0.6)
        step, frm = {}, {}
        for now, cost in ((True, split), (False, join)):
            frm[now] = min((True, False), key=lambda was: best[was] + (0.2 if was != now else 0.0))
            step[now] = best[frm[now]] + (0.2 if frm[now] != now else 0.0) + cost
        best = step
        back.append(frm)
    state = min(best, key=best.get)
    choice = []
    for frm in reversed(back):
        choice.append(state)
        state = frm[state]
    out = lines[0]
    for split, line in zip(reversed(choice), lines[1:]):
        out = out + "\n" + line if split else out.rstrip() + " " + line.lstrip()
    return out


def fit_lexicon(df, fields: list[str]) -> Lexicon:
    """Lexicon of all distinct texts, so that copies do not vote: each task counts its own words, one shuffle adds the counts.

    What goes to the driver has a bound that no data moves: words of a share of at least ``LEXICON_SHARE``, letter triples of at
    least ``TRIPLE_SHARE``, compounds and shapes of lines likewise.
    """
    from pyspark.sql import functions as F

    from itemforge.llm.arrow import map_rows
    from itemforge.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)

    def make():
        def work(texts: list):
            yield from count_words(texts).items()
            yield "", sum(1 for t in texts if t)

        return work

    each = df.select(F.explode(F.array(*[F.col(f"`{f}`") for f in fields])).alias("t")).where("length(t) > 0").distinct()
    counted = map_rows(each, make, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))

    def kinds():
        def work(words: list, counts: list):
            found: Counter[str] = Counter()
            total = 0
            for w, n in zip(words, counts):
                if w[:1] in ("", "\n") or "-" in w:
                    kind = "d" if not w else "s" if w[0] == "\n" else "c"
                    if kind == "d" or n >= LEXICON_LEAST:
                        yield kind, w, n
                    continue
                total += n
                padded = f"^{w}$"
                for i in range(len(padded) - 2):
                    found[padded[i : i + 3]] += n
                if n >= LEXICON_LEAST:
                    yield "w", w, n
            yield from (("t", t, n) for t, n in found.items())
            yield "a", "", total

        return work

    rows = map_rows(counted, kinds, "k string, w string, n bigint").groupBy("k", "w").agg(F.sum("n").alias("n")).checkpoint()
    size = {r.k: r.n for r in rows.where("k in ('a', 'd')").collect()}
    total = size.get("a") or 0
    least = max(LEXICON_LEAST, LEXICON_SHARE * total)
    held = rows.where(F.when(F.col("k") == "t", F.col("n") >= TRIPLE_SHARE * total).when(F.col("k") == "s", F.col("n") >= max(SHAPE_LEAST, SHAPE_SHARE * size.get("d", 0))).otherwise(F.col("n") >= least)).collect()
    words = {r.w: r.n for r in held if r.k == "w"}
    kept = without_misreadings(words)
    triples = {r.w: r.n for r in held if r.k == "t"} | {"#" + w: n for w, n in words.items() if w not in kept}
    return Lexicon(kept, triples, total, {r.w: r.n for r in held if r.k == "c"}, frozenset(r.w[1:] for r in held if r.k == "s"))


def scan_traces(df, id_col: str, fields: list[str], lexicon: Lexicon, texts: bool = True):
    """(id_linha, campo, n_linhas, n_quebras, n_sinais, n_cortes, n_juntas, texto_reparado) of every field that was changed, a
    field of lines that only became paragraphs included; no shuffle.  Without ``texts`` the text is null, and such fields give no row.

    Null, empty and blank fields give no row; repeated input rows repeat; very long texts are read whole.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    from pyspark.sql import functions as F

    from itemforge.llm.arrow import Shared, map_rows, once

    held, texts_too = Shared(df.sparkSession, lexicon), texts

    def make():
        reader = once(held, Reader)

        def work(ids: list, *texts: list):
            for name, column in zip(fields, texts):
                for i, t in zip(ids, column):
                    if not t:
                        continue
                    clean = reader.clean(t)
                    done, text = reader.decode(clean)
                    text = paragraphs(text) if text and texts_too else text if texts_too else None
                    if done or texts_too and text != clean:
                        yield i, name, done["linha"], done["quebra"], done["sinal"], done["corte"], done["junta"], text

        return work

    return map_rows(
        df.select(*[F.col(f"`{c}`") for c in (id_col, *fields)]), make,
        "id_linha bigint, campo string, n_linhas int, n_quebras int, n_sinais int, n_cortes int, n_juntas int, texto_reparado string",
    )


def with_traces(found):
    """Rows of ``scan_traces`` with a trace of the page itself: a running line, a broken word or a misread character."""
    return found.where("n_linhas + n_quebras + n_sinais > 0")
