"""Problem 6: text decoded with the wrong character encoding.

Method: the garbled sequence of every repertoire character is computed for all ordered pairs of a list of encodings (and for
two rounds of the common ones), all sequences go into one multi-pattern automaton, and only matched spans are replaced;
correct text beside them stays as it is.  Sequences of one character are ambiguous, so they count only where the correct
reading could not stand: inside a lower-case word, or glued to a unit; letters that names of other languages have count
inside a word only, and only if two places of the text say so.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.llm.arrow import map_rows

#: Characters that texts in the three languages are expected to hold beyond ASCII.
LETTERS = "áàâãäçéèêëíìîïñóòôõöúùûüÁÀÂÃÄÇÉÈÊËÍÌÎÏÑÓÒÔÕÖÚÙÛÜ"
SIGNS = "ºª°²³§¿¡«»–—‘’“”…•€£·µ±×÷αβγδθλπρσφωμΔΣΩмирбвгдежзклнопстуфхцчшщыьэюя"
#: Encodings in which texts of the three languages are written, and those as which they are read by mistake, the usual
#: ones first.  UTF-8 read as a code page gives several characters for one, one code page read as another one for one.
WRITTEN = ("cp1252", "mac_roman", "cp850")
READ = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251", "cp1250", "iso8859_2", "iso8859_7", "iso8859_15", "cp1253", "cp1254", "cp1257")
WIDE_PAIRS = tuple(("utf-8", r) for r in READ)
#: Pairs whose one-character images are no letters of European names.
PLAIN_PAIRS = (("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp1251"))
BYTE_PAIRS = PLAIN_PAIRS + tuple((w, r) for w in WRITTEN for r in READ if w != r and (w, r) not in PLAIN_PAIRS and not (w == "cp1252" and r in ("latin-1", "iso8859_15", "cp1254")))
LOST = "�"
#: Images of one character that scanned and typeset texts hold for other reasons: blanks and hyphens.
NEVER_ALONE = frozenset("\xa0\xad¬")
#: Latin look-alikes among the letters of the Cyrillic code page: no evidence of garbling alone.
LOOKALIKE = frozenset("аеорсухіѕјАВЕКМНОРСТХІЅЈУ")
GREEK_ALIKE = frozenset("αονρϲιυκχΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ")
#: Signs that stand inside words for good reason.
SIGNS_INSIDE = frozenset("’‘“”–—…•·")
LOWER = frozenset("abcdefghijklmnopqrstuvwxyzáàâãäçéèêëíìîïñóòôõöúùûü")
USUAL_LOWER = frozenset("abcdefghijklmnopqrstuvwxyzáàâãçéêíñóôõúü")
#: Readings that words of the three languages use; the rest of LETTERS is only garbled, never restored by one character.
READINGS = frozenset("áàâãçéêíñóôõúüÁÀÂÃÇÉÊÍÑÓÔÕÚÜºª°²³")
#: Capitals that none of the three languages uses.
FOREIGN_UPPER = frozenset("ÈÌÒÙÛÎËÏÝÞÅÆØÐ")
#: Readings that win a tie between pairs.
FREQUENT = frozenset("áãçéêíóúàâõº°²À")


def _decode(raw: bytes, reader: str) -> str | None:
    out = []
    for b in raw:
        try:
            out.append(bytes([b]).decode(reader))
        except UnicodeDecodeError:
            if reader != "cp1252":
                return None
            out.append(chr(b))
    return "".join(out)


def garbled_table() -> dict[str, list[tuple[str, str]]]:
    """Garbled sequence -> [(pair, character)], from the repertoire and the encoding pairs."""
    table: dict[str, list[tuple[str, str]]] = {}

    def add(seq: str | None, pair: str, c: str) -> None:
        if seq and seq != c and not seq.isascii():
            table.setdefault(seq, []).append((pair, c))

    for c in LETTERS + SIGNS + "\xa0":
        for w, r in WIDE_PAIRS:
            once = _decode(c.encode(w), r)
            add(once, f"{w}>{r}", c)
            if once and r in ("cp1252", "latin-1"):
                add(_decode(once.encode("utf-8"), "cp1252"), f"{w}>{r}>2", c)
        if c in READINGS:
            for w, r in BYTE_PAIRS:
                raw = c.encode(w, "ignore")
                seq = _decode(raw, r) if raw else None
                if seq and seq not in NEVER_ALONE and ((w, r) in PLAIN_PAIRS or seq not in LETTERS + "ºª°²³µ"):
                    add(seq, f"{w}>{r}", c)
    return table


#: A text without these is clean; the test costs one scan.
_SUSPECT = re.compile("[^\\x00-\\x7fáàâãçéêíñóôõúüºª°²³–—“”‘’…•€]")
#: What every garbled sequence has at least one of.
_TRIGGER = re.compile("[^\\x00-\\x7fáàâãçéêíñóôõúüºª°²]")


class Repairer:
    """Finds and restores garbled spans; built once in each task."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        table = garbled_table()
        self.longest = max(map(len, table))
        plain = {f"{w}>{r}" for w, r in PLAIN_PAIRS}
        #: Single characters that only other pairs give.
        self.strict = frozenset(seq for seq, readings in table.items() if len(seq) == 1 and not any(p in plain for p, _ in readings))
        for seq, readings in table.items():
            self.automaton.add_word(seq, (len(seq), seq, readings))
        self.automaton.make_automaton()

    def _windows(self, text: str) -> list[tuple[int, int]]:
        """Where the automaton has to look: every garbled sequence holds a character of ``_TRIGGER``, and none is longer than ``longest``."""
        out: list[tuple[int, int]] = []
        for m in _TRIGGER.finditer(text):
            b, e = max(0, m.start() - self.longest + 1), m.start() + self.longest
            if out and b <= out[-1][1]:
                out[-1] = (out[-1][0], e)
            else:
                out.append((b, e))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str | None]]:
        """Garbled spans as (begin, end, restored text or None where nothing can be restored)."""
        if not text or not _SUSPECT.search(text):
            return []
        found = []
        for b, e in self._windows(text):
            found += [(b + end - n + 1, b + end + 1, seq, readings) for end, (n, seq, readings) in self.automaton.iter(text[b:e])]
        found.sort(key=lambda m: (m[0], -m[1]))
        wide, single, last = [], [], 0
        for b, e, seq, readings in found:
            if b < last:
                continue
            if e - b > 1:
                c = readings[0][1]
                if self._wide_holds(text, b, e, c):
                    wide.append((b, e, c))
                    last = e
            else:
                single.append((b, e, seq, readings))
        taken = {i for b, e, _ in wide for i in range(b, e)}
        votes: Counter[str] = Counter()  # by pair, sure places only
        held, sure = [], 0.0
        for b, e, seq, readings in single:
            if b in taken:
                continue
            strength = self._strict_holds(text, b, seq) if seq in self.strict else self._single_holds(text, b, seq)
            if strength:
                held.append((b, e, readings, strength))
                if strength == 2:
                    sure += 0.5 if seq in self.strict else 1.0
                    votes.update({p: 1.0 if c in FREQUENT else 0.9 for p, c in readings})
        out: list[tuple[int, int, str | None]] = list(wide)
        if votes and sure >= 1:
            order = {f"{w}>{r}": -i for i, (w, r) in enumerate(BYTE_PAIRS)}
            best = max(votes, key=lambda p: (votes[p], order.get(p, -99)))
            for b, e, readings, _ in held:
                c = next((c for p, c in readings if p == best), None)
                if c:
                    out.append((b, e, c))
        out += [(m, m + 1, None) for m in (i for i, c in enumerate(text) if c == LOST)] if LOST in text else []
        return sorted(out)

    @staticmethod
    def _strict_holds(text: str, i: int, c: str) -> int:
        """As ``_single_holds``, for characters that other causes put into texts: only a place inside a word is a sign."""
        if c in SIGNS_INSIDE or c in GREEK_ALIKE or c in LOOKALIKE or not (c.isalpha() or c in "‹›‡†‚„ˆ˜⌡⌠" or "─" <= c <= "▟" or "\x80" <= c <= "\x9f"):
            return 1
        return 2 if 0 < i < len(text) - 1 and text[i - 1] in LOWER and text[i + 1] in LOWER else 1

    @staticmethod
    def _wide_holds(text: str, b: int, e: int, c: str) -> bool:
        """Correct capitals followed by a sign ("AMANHÃ©") are no garbling; neither are whole Cyrillic words."""
        before = text[b - 1] if b else " "
        if before.isupper() and b > 1 and text[b - 2].isupper() and c.islower() and (e == len(text) or not text[e].isalpha() or text[e].isupper()):
            return False
        seq = text[b:e]
        if all("Ѐ" <= x <= "ӿ" or "─" <= x <= "▟" for x in seq) and "Ѐ" <= seq[0] <= "ӿ":
            return before in LOWER or e < len(text) and text[e] in LOWER
        if seq[0] in "ÃÂ" and seq[1] in "€£¥" and (e == len(text) or text[e] in " \u00a00123456789"):
            return before.islower()
        return True

    @staticmethod
    def _single_holds(text: str, i: int, c: str) -> int:
        """2: sure sign of a wrong single-byte reading; 1: holds if another place of the text is sure; 0: correct."""
        before = text[i - 1] if i else " "
        after = text[i + 1] if i + 1 < len(text) else " "
        if "Ѐ" <= c <= "ӿ":
            near_latin = before in LOWER or after in LOWER or before.isascii() and before.isalpha() or after.isascii() and after.isalpha()
            if c == "у" and before in "aeiouáéíóúâêô" and after.isalpha() and after.isascii() and after not in "aeiou":
                return 2  # the place of an accented o, where no y stands
            if c in LOOKALIKE:
                return 1
            alone = not any("Ѐ" <= x <= "ӿ" for x in (before, after))
            return 2 if near_latin or alone else 1
        inside = before in LOWER or (after in LOWER and (before in " \n(“\"" or before.isalpha()))
        if c.isalpha():
            if c in USUAL_LOWER:
                return 0
            if c in FOREIGN_UPPER and not (before.isupper() and after.isupper()):
                return 2
            if c.isupper():
                if before in LOWER and (after in LOWER or not after.isalpha()):
                    return 2
                if before.isupper() and after in LOWER and i >= 1 and (i < 2 or not text[i - 2].isalpha()):
                    return 2 if c not in READINGS else 1
                return 0 if before.isupper() or after.isupper() else 1
            return 2 if before in LOWER or after in LOWER else 1
        if c in "“”‘’–—…•€£§ºª°²³¿¡«»©®±":
            return 2 if before in USUAL_LOWER and after in USUAL_LOWER and c not in "–—…•©®’‘“”" else 1
        if "─" <= c <= "▟" or c in "˙‡†„‚¾½¼¶·¸¨≠≤≥∞√∫∏∑∂Ω":
            glued = before.isalpha() or after.isalpha()
            return 2 if glued or "─" <= c <= "▟" or c in "‡†˙¶¾" else 1
        return 2 if inside else 1

    def restore(self, text: str | None) -> str | None:
        """The text with matched spans replaced; null stays null, lost characters stay."""
        for _ in range(3):
            spans = [s for s in self.spans(text) if s[2] is not None]
            if not spans:
                return text
            out, at = [], 0
            for b, e, c in spans:
                out += [text[at:b], c]
                at = e
            text = "".join(out) + text[at:]
        return text


def garbled_fields(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id_linha, campo, texto_restaurado, n_trechos) of every field with a garbled span; no shuffle.

    Null and empty fields give no row; a field gives one row however many spans it has; repeated input rows repeat.
    Other columns are ignored, whatever their names; an empty table gives an empty table.
    """

    def make():
        fix = Repairer()

        def work(ids: list, *texts: list) -> Iterator[tuple]:
            for name, column in zip(fields, texts):
                for i, t in zip(ids, column):
                    if t and (spans := fix.spans(t)):
                        yield i, name, fix.restore(t), len(spans)

        return work

    return map_rows(df.select(*[F.col(f"`{c}`") for c in (id_col, *fields)]), make, "id_linha bigint, campo string, texto_restaurado string, n_trechos int")


def restore_fields(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Every row of ``df`` as (id, fields...) with garbled spans restored; null stays null, empty stays empty.

    Other columns are ignored, whatever their names; an empty table gives an empty table.
    """

    def make():
        fix = Repairer()

        def work(ids: list, *texts: list) -> Iterable[tuple]:
            return zip(ids, *[[fix.restore(t) for t in column] for column in texts])

        return work

    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"`{f}` string" for f in fields)
    return map_rows(df.select(*[F.col(f"`{c}`") for c in (id_col, *fields)]), make, schema)
