"""Problem 10: personal information inside free text.

Method: a semi-Markov conditional random field.  Segments are windows of tokens: runs of digit groups, of capitalised words,
from a street word to a number, around an at-sign; each of bounded length, overlapping freely.  Whole-span features (the
form of the span, the words before and behind it, what the corpus knows of names) score a segment with a type; text outside
segments scores nothing.  Dynamic programming over segment ends chooses boundaries and types together.

Weights maximise the conditional likelihood (forward-backward over the segments, L2, adaptive gradient steps).  No labelled
documents exist, so the model is fitted on two kinds of labelled texts: sentences made here from forms of personal data and of
what resembles it (``itemforge.llm.examples``), and ``FIT_DOCUMENTS`` documents, chosen by hash, with the spans that are sure by
those forms and the corpus's own names.  Words around a span, or the form of a number, are hidden at random, so that forms and contexts both learn.

Given and family names are learned from what the corpus itself says of persons (local parts of e-mail addresses, name
lines of forms), counted over all documents.

Null and empty texts have no span and stay as they are.
"""

from __future__ import annotations

import bisect
import math
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm import examples
from itemforge.llm.arrow import Shared, hashed_sample, map_rows, once
from itemforge.session import checkpoint_dir

TYPES = ("email", "phone", "id", "address", "name")
FIT_DOCUMENTS, FIT_SENTENCES = 2000, 2400
EPOCHS, STEP, SHRINK, HIDDEN = 5, 0.35, 1e-5, 0.3
#: A name is known from this share of the corpus's names on, and from two occurrences on.
NAME_SHARE = 1e-5
#: Longest segments: digit groups, capitalised words, characters of an address.
GROUPS, NAME_WORDS, ADDRESS_CHARS = 5, 4, 90
_S = "[ \xa0\u2007\u2009\u202f]"
_CAP = r"[A-ZÀ-ÖØ-Ý][\wÀ-ÿ'’]{1,40}"
_PARTICLE = r"(?:d[aeo]s?|del|de la|de los|e|y|van|von|di|DE|DA|DO|DOS|DAS|DEL)"

_AT = rf"(?:{_S}?@{_S}?|{_S}?[(\[{{<]{_S}?(?i:at|arroba|a){_S}?[)\]}}>]{_S}?|{_S}(?i:arroba|at){_S})"
_DOT = rf"(?:\.|{_S}?[(\[]{_S}?(?i:dot|ponto|punto){_S}?[)\]]{_S}?|{_S}(?i:dot|ponto|punto){_S})"
_AT_SIGN = re.compile(_AT)
_BEFORE_AT = re.compile(r"(?<![\w.+@-])[A-Za-z0-9][\w.+-]*$")
_BEHIND_AT = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![\w@])")
_AT_HINT = re.compile(r"@|(?i:arroba|[(\[{<] ?a|\bat\b)")
EMAIL = re.compile(rf"(?<![\w.+@-])[A-Za-z0-9][\w.+-]*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![\w@])")
#: One digit group: digits with dots, dashes and slashes inside, a bracket, a plus or up to three letters before, a letter behind.
GROUP = re.compile(r"(?<![\w@/$€£.,-])(?:\+\d{1,3}(?:[.-]?\d+)*(?:\(\d{2,4}\)\d[\d.-]*\d)?|\(\d{2,4}\)(?:\d[\d.\-/]*\d)?|(?:[A-Z]{1,3}-?)?\d(?:[\d.\-/]*\d)?(?:-?[A-Z])?)(?![\w@])")
STREET = (
    r"(?:[Rr]ua|RUA|R\.|[Aa]venida|AVENIDA|[Aa]v\.|Avda\.(?: de)?|[Tt]ravessa|TRAVESSA|Trav\.|[Aa]lameda|ALAMEDA|Al\.|[Pp]raça|Pça\.|[Ll]argo|[Ee]strada|[Rr]odovia|"
    r"[Cc]alle|CALLE|C/|[Pp]laza|PLAZA|Pza\.|[Pp]aseo|[Cc]amino|[Cc]arrera|[Rr]onda)"
)
_STREET = re.compile(rf"(?<!\w){STREET}(?={_S})")
ADDRESS = re.compile(rf"{STREET}{_S}+(?:(?:d[aeo]s?|del|de la|DOS|DAS|DA|DO|DE){_S})*{_CAP}(?:{_S}{_CAP}){{0,3}},?{_S}?(?:(?:n[.ºo°]*|n\.º|nº|número|num\.?|no\.|#){_S}?)?\d{{1,5}}(?!\w)")
_FLAT = re.compile(rf",{_S}(?:apto|casa|bloco|piso|sala|apt\.?|puerta){_S}\w+")
ADDRESS_EN = re.compile(rf"(?<![\w.,-])\d{{1,5}}{_S}(?:{_CAP}{_S}){{1,3}}(?:Street|Road|Avenue|Lane|Drive|Court|Square|Place|Way|Terrace|St|Rd|Ave)\b\.?")
_CAPS = re.compile(rf"(?<![\w@'’-]){_CAP}(?:(?:{_S}{_PARTICLE})?{_S}{_CAP})+")
_CAP_WORD = re.compile(_CAP)
_WORDS_BEFORE = re.compile(r"[^\W\d_]+|[@#]")
_WORD_BEHIND = re.compile(r"\W{0,3}([^\W\d_]+)")
_FORM = re.compile(r"^(?:Nome|Name|Nombre)[^\n:]{0,12}: *([^\n]{3,60})$", re.M)
_LOCAL = re.compile(r"^([A-Za-z]{2,})[._-]([A-Za-z]{3,})")
#: First words of places and institutions; words after which a number is no person's, or is one's.
PLACES = frozenset({"alto", "barra", "escola", "colegio", "instituto", "universidade", "universidad", "school", "lagoa", "nova", "novo", "porto", "praia", "rio", "san", "santa", "santo", "sao", "serra", "vale", "vila", "editora", "rua", "calle", "avenida"})
NOT_PERSONAL = frozenset({"isbn", "issn", "protocolo", "lote", "item", "ítem", "protocol", "batch", "nota", "edital", "processo", "expediente", "doi"})


_MONEY = ("$", "€", "£")


def plain(word: str) -> str:
    """Lower case without accents."""
    low = word.lower()
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c))


def shape(span: str) -> str:
    """Digits as 9, capitals as A, any blank as a blank."""
    return re.sub(r"\s", " ", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", span)))


class Names:
    """Given names and family-name forms learned from the corpus."""

    def __init__(self, given: dict[str, int], family: dict[str, int]):
        self.given = given
        self.begin, self.end = Counter(), Counter()
        for w, n in family.items():
            self.begin[w[:4]] += n
            self.end[w[-4:]] += n
        self.family = family
        self.least = max(2, sum(family.values()) // 2000)

    def is_family(self, word: str) -> bool:
        w = plain(word)
        return w in self.family or self.end[w[-4:]] >= self.least and self.begin[w[:4]] >= self.least


def _digits(text: str) -> int:
    return sum(map(str.isdigit, text))


def candidates(text: str, names: Names) -> list[tuple[int, int, str]]:
    """Segments (begin, end, type) of bounded length that the model may choose."""
    out: list[tuple[int, int, str]] = []
    if _AT_HINT.search(text):
        for m in _AT_SIGN.finditer(text):
            domain = _BEHIND_AT.match(text, m.end())
            begin = max(0, m.start() - 64)
            local = _BEFORE_AT.search(text[begin : m.start()]) if domain else None
            if local:
                out.append((begin + local.start(), domain.end(), "email"))
    groups = [m.span() for m in GROUP.finditer(text)]
    for k, (b, _) in enumerate(groups):
        digits = 0
        for j in range(k, min(k + GROUPS, len(groups))):
            if j > k and (groups[j][0] - groups[j - 1][1] != 1 or text[groups[j][0] - 1] not in " \xa0\u2007\u2009\u202f"):
                break
            e = groups[j][1]
            digits += _digits(text[groups[j][0] : e])
            if digits > 15 or e - b > 26:
                break
            if digits > 6 or digits > 4 and j == k and text[b].isalpha():
                out += [(b, e, "phone"), (b, e, "id")] if not text[b].isalpha() else [(b, e, "id")]
    for m in _STREET.finditer(text):
        if a := ADDRESS.match(text, m.start(), m.start() + ADDRESS_CHARS):
            out.append((a.start(), a.end(), "address"))
            if f := _FLAT.match(text, a.end()):
                out.append((a.start(), f.end(), "address"))
    if "S" in text or "R" in text or "A" in text or "L" in text:
        out += [(m.start(), m.end(), "address") for m in ADDRESS_EN.finditer(text)]
    for m in _CAPS.finditer(text):
        words = [(t.start() + m.start(), t.end() + m.start()) for t in _CAP_WORD.finditer(m.group())]
        for k in range(len(words) - 1):
            if plain(text[words[k][0] : words[k][1]]) in PLACES:
                continue
            out += [(words[k][0], words[j][1], "name") for j in range(k + 1, min(k + NAME_WORDS, len(words))) if text[words[j][1] : words[j][1] + 1] not in _MONEY]
    return out


def features(text: str, b: int, e: int, kind: str, names: Names, hide: bool = False, bare: bool = False) -> tuple[str, ...]:
    """Features of a whole segment; ``hide`` leaves the words around it out, ``bare`` the form of a number."""
    span = text[b:e]
    left = [plain(w) for w in _WORDS_BEFORE.findall(text[max(0, b - 40) : b])[-2:]] if not hide else []
    near = left[-1] if left else "^"
    if kind == "name":
        words = [plain(w) for w in _CAP_WORD.findall(span)]
        given, family = words[0] in names.given, [names.is_family(w) for w in words[1:]]
        start = b == 0 or text[:b].rstrip(" \xa0")[-1:] in ".!?\n:"
        behind = _WORD_BEHIND.match(text, e)
        return (
            "name", f"name|l={near}", f"name|g={given}", f"name|f={family[0]}", f"name|gf={given}{family[0]}", f"name|last={family[-1]}", f"name|all={all(family)}", f"name|k={len(words)}",
            f"name|up={span.isupper()}", f"name|start={start}{given}", f"name|cap={_cut(text, b)}{_goes_on(text, e)}", f"name|r={plain(behind.group(1)) if behind and not hide else '$'}",
        )
    bad = any(w in NOT_PERSONAL for w in left)
    if kind in ("phone", "id"):
        s = shape(span)
        n = _digits(span)
        seps = "".join(sorted(set(s) - {"9", "A"}))
        around = (kind, f"{kind}|l={near}", f"{kind}|l2={left[0] if len(left) > 1 else '^'}", f"{kind}|bad={bad}", f"{kind}|more={_more(text, b, e)}")
        form = (
            f"{kind}|s={s}", f"{kind}|n={n}", f"{kind}|+={span[0] == '+'}", f"{kind}|(={'(' in span}", f"{kind}|sep={seps}", f"{kind}|sn={seps}{n}", f"{kind}|end={s[-5:]}", f"{kind}|begin={s[:4]}",
            f"{kind}|letter={'A' in s}",
        )
        return around if bare else around + form
    if kind == "address":
        return (kind, f"address|w={plain(span.split()[0])}", f"address|d={span[0].isdigit()}", f"address|flat={bool(_FLAT.search(span))}", f"address|more={bool(_FLAT.match(text, e))}")
    local = _AT_SIGN.split(span)[0]
    return (kind, f"email|@={'@' in span}", f"email|sp={' ' in span}", f"email|dot={'.' in span}", f"email|local={any(c in '._-' or c.isdigit() for c in local)}", f"email|tld={re.split('[^A-Za-z]', span)[-1].lower()}")


def _more(text: str, b: int, e: int) -> str:
    """Whether a digit group stands right before or behind a segment."""
    before, behind = text[max(0, b - 3) : b].rstrip()[-1:], text[e : e + 2]
    return f"{before.isdigit() or before == ')'}{len(behind) == 2 and behind[0].isspace() and (behind[1].isdigit())}"


def _cut(text: str, b: int) -> bool:
    """Whether a capitalised word stands right before a segment."""
    before = text[max(0, b - 30) : b].rstrip(" \xa0")
    word = re.search(r"([^\W\d_]+)$", before)
    return bool(word and word.group()[0].isupper() and len(word.group()) > 1 and len(before) < b + 30)


def _goes_on(text: str, e: int) -> bool:
    """Whether a capitalised word stands right behind a segment."""
    return len(text) > e + 2 and text[e] in " \xa0" and text[e + 1].isupper() and text[e + 2].isalpha()


def lattice(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """(segments by end, for each the number of segments, in that order, that end where it begins or before)."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0]))
    ends = [spans[i][1] for i in order]
    return order, [bisect.bisect_right(ends, spans[i][0], 0, k) for k, i in enumerate(order)]


def decode(spans: list[tuple[int, int, str]], scores: list[float]) -> list[int]:
    """Best set of non-overlapping segments (semi-Markov dynamic programming over segment ends)."""
    order, before = lattice(spans)
    best = [0.0]
    for k, i in enumerate(order):
        best.append(max(best[k], best[before[k]] + scores[i]))
    chosen, k = [], len(order)
    while k:
        if best[k] > best[k - 1] + 1e-12:
            chosen.append(order[k - 1])
            k = before[k - 1]
        else:
            k -= 1
    return chosen[::-1]


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(order: list[int], before: list[int], scores: list[float]) -> tuple[float, list[float]]:
    """(log of the sum over all sets of non-overlapping segments, probability of each segment) by forward and backward sums."""
    n = len(order)
    forward = [0.0]
    for k, i in enumerate(order):
        forward.append(_add(forward[k], forward[before[k]] + scores[i]))
    backward = [-math.inf] * n + [0.0]
    out = [0.0] * n
    for k in range(n - 1, -1, -1):
        i, here = order[k], backward[k + 1]
        out[i] = math.exp(forward[before[k]] + scores[i] + here - forward[n])
        backward[k] = _add(backward[k], here) if backward[k] > -math.inf else here
        m = before[k]
        backward[m] = _add(backward[m], here + scores[i]) if backward[m] > -math.inf else here + scores[i]
    return forward[n], out


def sure_spans(text: str, spans: list[tuple[int, int, str]], names: Names) -> set[int]:
    """Segments of a document that are labelled for the fit: forms the made sentences use, addresses, known given with family name."""
    sure: list[int] = []
    for k, (b, e, kind) in enumerate(spans):
        left = [plain(w) for w in _WORDS_BEFORE.findall(text[max(0, b - 30) : b])[-2:]]
        if kind in ("phone", "id"):
            if left and left[-1] in NOT_PERSONAL or shape(text[b:e]) not in (examples.ID_FORMS if kind == "id" else examples.PHONE_FORMS):
                continue
        elif kind == "name":
            words = [plain(w) for w in _CAP_WORD.findall(text[b:e])]
            if words[0] not in names.given or not all(map(names.is_family, words[1:])):
                continue
        sure.append(k)
    kept, last = set(), 0
    for k in sorted(sure, key=lambda k: (spans[k][0], -spans[k][1])):
        if spans[k][0] >= last:
            kept.add(k)
            last = spans[k][1]
    return kept


def fit_weights(labelled: list[tuple[str, set[tuple[int, int, str]] | None]], names: Names, epochs: int = EPOCHS) -> dict[str, float]:
    """Weights of greatest conditional likelihood over texts with their spans; None asks for the sure ones."""
    rng = random.Random(11)
    data = []
    for text, gold in labelled:
        spans = candidates(text, names)
        if not spans:
            continue
        right = sure_spans(text, spans, names) if gold is None else {k for k, s in enumerate(spans) if s in gold}
        views = [[features(text, *s, names, *how) for s in spans] for how in ((), (True,), (False, True))]
        data.append((*lattice(spans), views, right))
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    for _ in range(epochs):
        rng.shuffle(data)
        for order, before, views, right in data:
            fs = views[rng.choices((0, 1, 2), (1 - 2 * HIDDEN, HIDDEN, HIDDEN))[0]]
            scores = [sum(weights.get(f, 0.0) for f in x) for x in fs]
            _, p = marginals(order, before, scores)
            slope: dict[str, float] = {}
            for i, x in enumerate(fs):
                d = (i in right) - p[i]
                if abs(d) > 1e-4:
                    for f in x:
                        slope[f] = slope.get(f, 0.0) + d
            for f, d in slope.items():
                d -= SHRINK * weights.get(f, 0.0)
                squares[f] = squares.get(f, 0.0) + d * d
                weights[f] = weights.get(f, 0.0) + STEP * d / math.sqrt(squares[f] + 1e-8)
    return {f: w for f, w in weights.items() if abs(w) > 1e-3}


class Finder:
    """Finds spans in texts; built once in each task."""

    def __init__(self, model: tuple[Names, dict[str, float]]):
        self.names, self.weights = model
        self.known: dict[tuple[str, ...], float] = {}

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """Chosen segments in order."""
        if not text:
            return []
        found = candidates(text, self.names)
        if not found:
            return []
        scores = []
        for s in found:
            x = features(text, *s, self.names)
            score = self.known.get(x)
            if score is None:
                if len(self.known) > 200_000:
                    self.known.clear()
                score = self.known[x] = sum(self.weights.get(f, 0.0) for f in x)
            scores.append(score)
        return sorted(found[i] for i in decode(found, scores))

    def masked(self, text: str | None) -> str | None:
        """The text with every span replaced by its typed placeholder."""
        out, at = [], 0
        for b, e, kind in self.spans(text):
            out += [text[at:b], f"[{kind.upper()}]"]
            at = e
        return "".join(out) + text[at:] if out else text


def fit_names(df: DataFrame, text_col: str) -> Names:
    """Given and family names of all documents: e-mail local parts and name lines; one small shuffle; at most
    ``1 / NAME_SHARE`` names of each kind, whatever the data."""

    def make():
        def work(texts: list) -> Iterator[tuple]:
            found: Counter[tuple[str, str]] = Counter()
            for t in texts:
                if not t:
                    continue
                if "@" in t or "arroba" in t or "at" in t:
                    for m in EMAIL.finditer(t):
                        if p := _LOCAL.match(m.group()):
                            found["g", p.group(1).lower()] += 1
                            found["f", p.group(2).lower()] += 1
                for m in _FORM.finditer(t):
                    words = [plain(w) for w in re.findall(_CAP, m.group(1))]
                    if len(words) > 1:
                        found["g", words[0]] += 1
                        for w in words[1:]:
                            found["f", w] += 1
            yield from ((k, w, n) for (k, w), n in found.items())

        return work

    checkpoint_dir(df.sparkSession)
    counted = map_rows(df.select(F.col(f"`{text_col}`")), make, "k string, w string, n bigint").groupBy("k", "w").agg(F.sum("n").alias("n")).checkpoint()
    whole = {r.k: r.n for r in counted.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    least = {k: max(2, math.ceil(NAME_SHARE * n)) for k, n in whole.items()}
    rows = counted.where(F.col("n") >= F.when(F.col("k") == "g", least.get("g", 2)).otherwise(least.get("f", 2))).collect()
    given = max(2, whole.get("g", 0) / 5000)
    return Names({r.w: r.n for r in rows if r.k == "g" and r.n >= given}, {r.w: r.n for r in rows if r.k == "f"})


def fit_model(df: DataFrame, id_col: str, text_col: str, most: int = FIT_DOCUMENTS) -> tuple[Names, dict[str, float]]:
    """Names of all documents; span weights from made sentences and a bounded sample of documents chosen by hash of the key."""
    names = fit_names(df, text_col)
    sample = hashed_sample(df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).where(F.col("t").rlike("[0-9]{2}|@")), "i", most)
    made = examples.sentences(FIT_SENTENCES, sorted(names.given), sorted(names.family))
    return names, fit_weights([(r.t, None) for r in sample] + made, names)


def personal_spans(df: DataFrame, id_col: str, text_col: str, model: tuple[Names, dict[str, float]]) -> DataFrame:
    """(doc_id, tipo, inicio, fim) of every span; positions count code points; no shuffle.

    Null and empty texts give no row; spans never overlap; repeated rows repeat.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    held = Shared(df.sparkSession, model)

    def make():
        find = once(held, Finder)

        def work(ids: list, texts: list) -> Iterator[tuple]:
            for i, t in zip(ids, texts):
                for b, e, kind in find.spans(t):
                    yield i, kind, b, e

        return work

    return map_rows(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), make, "doc_id bigint, tipo string, inicio bigint, fim bigint")


def masked_texts(df: DataFrame, id_col: str, text_col: str, model: tuple[Names, dict[str, float]]) -> DataFrame:
    """(doc_id, texto) of every row, spans replaced by placeholders; null stays null, empty stays empty; no shuffle.

    Other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    held = Shared(df.sparkSession, model)

    def make():
        find = once(held, Finder)

        def work(ids: list, texts: list) -> Iterator[tuple]:
            return zip(ids, map(find.masked, texts))

        return work

    return map_rows(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), make, "doc_id bigint, texto string")
