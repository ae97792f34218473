"""Problem 3: visually identical text made of different characters.

Method: a quick-check set over all of Unicode (built once from the normalisation properties of every code point: those whose quick check is "no", those whose check is "maybe" because they combine with what is before them,
blanks that are not U+0020 and invisible characters; and look-alike letters, which no property tells) isolates unstable
segments; one scan for characters that are not usual says where to look.  Only a segment, widened to the word around it, is normalised; the canonical piece is spliced into the unchanged
text, if it differs.  What a wrong encoding left behind is recognised first and is no unstable segment.

Superscripts, ordinal signs, quotation marks, dashes, Greek symbols in formulas and whole words in another script are
stable.  Null stays null, empty stays empty.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm.arrow import map_rows
from itemforge.llm.encoding import Repairer

#: Letters of other scripts drawn like Latin ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝѵӏАВЕКМНОРСТУХІЈЅԌ" "αονρϲιυκχΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ" "ɑɡ" "օսհոՕՍ" "ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ",
    "aeopcyxijshdqwvlABEKMHOPCTYXIJSG" "aovpciukxABEZHIKMNOPTYXC" "ag" "ouhnOU" "ABCDEHJKLMPRSTVWZ",
))
INVISIBLE = "\u00ad͏\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff︀-️"
BLANKS = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
#: Signs that compatibility normalisation would change but that are stable here.
STABLE = frozenset("ªº²³¹⁰ⁱ⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎…´¨¯¸˙µ¼½¾ℓ№™℃℉′″‴‼⁇⁈⁉")
GREEK_FORMULA = frozenset("ανρικυχ")


_OPERATORS = frozenset("=/+−-·×^_<>≤≥")


def _quick_check() -> tuple[frozenset[str], frozenset[str]]:
    """(code points whose quick check is "no", combining ones) over all of Unicode.

    Superscripts, subscripts and fractions keep their meaning only as they are and count as stable; so do signs in ``STABLE``.
    """
    no, combining = set(), set()
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        if unicodedata.combining(c):
            combining.add(c)
        elif not unicodedata.is_normalized("NFKC", c) and c not in STABLE and not 0xD800 <= cp < 0xE000 and not unicodedata.decomposition(c).startswith(("<super>", "<sub>", "<fraction>")):
            no.add(c)
    return frozenset(no), frozenset(combining)


_NO, _MARKS = _quick_check()
_LOOSE = re.compile(f"[{INVISIBLE}{BLANKS}]")
_ANY_SUSPECT = re.compile("[^\\x00-\\x7fáàâãçéêíñóôõúüÁÀÂÃÇÉÊÍÓÔÕÚºª°²³–—“”•€£©]")


def _is_unstable(c: str) -> bool:
    return c in _NO or c in _MARKS or c in LOOKALIKES or bool(_LOOSE.match(c))


_SKIP = re.compile(f"[{INVISIBLE}]+")


def _runs(text: str) -> list[tuple[int, int]]:
    """The contexts of segments: unbroken runs of letters, with the marks and invisible characters inside them."""
    out, begin = [], None
    for i, c in enumerate(text):
        inside = c.isalpha() or begin is not None and (c in _MARKS or bool(_SKIP.match(c)))
        if inside and begin is None:
            begin = i
        elif not inside and begin is not None:
            out.append((begin, i))
            begin = None
    return out + ([(begin, len(text))] if begin is not None else [])


class Canonizer:
    """Canonical form of texts; built once in each task."""

    def __init__(self) -> None:
        self.garbled = Repairer()

    def segments(self, text: str | None) -> list[tuple[int, int, str]]:
        """Unstable segments with their canonical replacement, left to right, not overlapping."""
        if not text or not _ANY_SUSPECT.search(text):
            return []
        hits = [m.start() for m in _ANY_SUSPECT.finditer(text) if _is_unstable(m.group())]
        if not hits:
            return []
        left: set[int] = set()
        for b, e, _ in self.garbled.spans(text):
            left.update(range(b, e))
        runs = None
        out: list[tuple[int, int, str]] = []
        done = 0
        for i in hits:
            if i < done or i in left:
                continue
            c = text[i]
            if c in LOOKALIKES:
                if runs is None:
                    runs = _runs(text)
                b, e = next(((b, e) for b, e in runs if b <= i < e), (i, i + 1))
                if not self._stands_for_latin(text, i, b, e):
                    continue
                out.append((i, i + 1, LOOKALIKES[c]))
                done = i + 1
            elif c in _MARKS:
                b = i - 1 if i else i
                if out and out[-1][1] > b:
                    b, head = out[-1][0], out[-1][2]
                    out.pop()
                else:
                    head = text[b:i]
                e = i + 1
                while e < len(text) and (text[e] in _MARKS or _SKIP.match(text[e])):
                    e += 1
                whole = unicodedata.normalize("NFC", head + _SKIP.sub("", text[i:e]))
                if whole != text[b:e]:  # a mark that nothing composes with stays
                    out.append((b, e, whole))
                done = e
            elif _SKIP.match(c):
                out.append((i, i + 1, ""))
                done = i + 1
            elif c.isspace():
                out.append((i, i + 1, " "))
                done = i + 1
            else:
                out.append((i, i + 1, unicodedata.normalize("NFKC", c)))
                done = i + 1
        return out

    @staticmethod
    def _stands_for_latin(text: str, i: int, b: int, e: int) -> bool:
        """A look-alike letter counts beside Latin letters, or alone as a one-letter word that no formula uses."""
        word = _SKIP.sub("", text[b:e])
        latin = any(c.isascii() or "À" <= c <= "ɏ" or "Ａ" <= c <= "ｚ" for c in word if c.isalpha() and c not in LOOKALIKES)
        if latin or not "Ͱ" <= text[i] <= "ԯ":
            return latin
        alike = all(c in LOOKALIKES for c in word if c.isalpha())
        if not alike:
            return False
        if text[i] in GREEK_FORMULA:
            return text[i] in "ο"
        if len(word) > 1:
            return not all("Ѐ" <= c <= "ԯ" or c in "οϲ" for c in word) or len(word) <= 2
        if text[i] in "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ":  # a capital Greek letter alone is a symbol where an operator stands beside it
            return not (text[max(0, b - 3) : b].rstrip()[-1:] in _OPERATORS or text[e : e + 3].lstrip()[:1] in _OPERATORS)
        return True

    def canonical(self, text: str | None) -> str | None:
        """Unchanged text with canonical segments spliced in."""
        parts = self.segments(text)
        if not parts:
            return text
        out, at = [], 0
        for b, e, c in parts:
            out += [text[at:b], c]
            at = e
        return "".join(out) + text[at:]


def unstable_fields(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id_linha, campo, texto_canonico, n_trechos) of every field with an unstable segment; no shuffle.

    Null and empty fields give no row; repeated input rows repeat.  Other columns are ignored, whatever their names; an empty table gives an empty table.
    """

    def make():
        form = Canonizer()

        def work(ids: list, *texts: list) -> Iterator[tuple]:
            for name, column in zip(fields, texts):
                for i, t in zip(ids, column):
                    if t and (parts := form.segments(t)):
                        yield i, name, form.canonical(t), len(parts)

        return work

    return map_rows(df.select(*[F.col(f"`{c}`") for c in (id_col, *fields)]), make, "id_linha bigint, campo string, texto_canonico string, n_trechos int")
