"""Problem 1, lines: running headers, footers and page numbers between the lines of a text.

A line is weighed by what it is made of: numbers in a frame, words for pages and booklets, capitals and codes speak for a
running line; words of a sentence, the end of one, and marks of lists and tables speak against it.  Lines whose weight
leaves them open are decided by recurrence: the shape of a running line stands in many texts.
"""

from __future__ import annotations

import re
import unicodedata

#: Words of page heads and feet in the three languages, without accents.
BOOKLET = frozenset({
    "caderno", "cuaderno", "booklet", "prova", "prueba", "exam", "exame", "examen", "simulado", "vestibular", "concurso", "edicao", "dia", "day", "aplicacao",
    "tecnologias", "ciencias", "humanas", "natureza", "linguagens", "codigos", "matematica", "redacao", "questoes", "gabarito", "rascunho",
    "azul", "amarelo", "amarela", "branco", "branca", "rosa", "cinza", "verde", "laranja",
})
PAGE = frozenset({"pagina", "paginas", "pag", "pags", "page", "pg", "p"})
LINKS = frozenset({"a", "as", "da", "das", "de", "do", "dos", "del", "e", "of", "o", "os", "sua", "suas", "y"})
#: Letters that digits and signs are misread for.
_MISREAD = str.maketrans("01@5|", "oiasl")
_ROMAN = re.compile(r"(?=[ivxlc]{2})c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
_ROMAN_LINE = re.compile(rf"[\[(]?{_ROMAN.pattern}[\])]?|[-–—] ?{_ROMAN.pattern} ?[-–—]", re.I)
_FRAME = r"[\s\[\](){}|.·•*–—-]*"
_NUMBER_LINE = re.compile(rf"{_FRAME}\d{{1,3}}(?:\s*(?:/|de|of)\s*\d{{1,3}})?{_FRAME}")
_CODE = re.compile(r"\*[A-Za-z0-9]{4,}\*")
_TOKEN = re.compile(r"\*[A-Za-z0-9]{4,}\*|[^\W_](?:[\w@]*[^\W_])?[ºª°]?|[^\w\s]")
_LIST = re.compile(r"\s*(?:\||#|\d{1,2}[.)]\s|[A-Ea-e][.)]\s|[-•*]\s+[^\d\s])")
_SENTENCE_END = frozenset(".,;:!?…\"”»")
LONGEST = 90
#: Weights: end of a sentence or mark of a list, words of a sentence, words of booklets (at most two count), a word for a page before
#: a number, a number, the share of capitals, capitals that no booklet uses, recurrence; and the weight from which a line is a running one.
END, CONTENT, WORD, PAGES, DIGITS, CAPITALS, SHOUTED, RECURS, ENOUGH = -6.0, -1.5, 2.0, 4.0, 1.0, 3.0, -0.5, 2.0, 4.0
#: Evidence (booklet words, capitals, a gap before it) from which the end of a line is a running one.
TAIL = 3


def plain(word: str) -> str:
    """Lower case without accents; digits and signs inside a word as the letters they are misread for."""
    low = word.lower()
    if not low.isalpha() and any(c.isalpha() for c in low) and not low[0].isdigit():
        low = low.translate(_MISREAD)
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c))


def shape(line: str) -> str:
    """What a line is made of: numbers as 0, capitals as A, capitalised words as Aa, other words as they are."""
    kind = lambda w: "0" if w[0].isdigit() else "A" if w.isupper() and len(w) > 1 else "Aa" if w[0].isupper() else w
    return " ".join(kind(t) for t in _TOKEN.findall(line))


def weight(line: str) -> float:
    """Weight of a line for being a running one, without its recurrence."""
    line = line.strip()
    if not line or len(line) > LONGEST:
        return END
    if _NUMBER_LINE.fullmatch(line) or _ROMAN_LINE.fullmatch(line) or _CODE.fullmatch(line):
        return ENOUGH
    if line[-1] in _SENTENCE_END or _LIST.match(line):
        return END
    words, capitals, booklet, content, pages, digits = 0, 0, 0, 0, False, False
    tokens = _TOKEN.findall(line)
    for k, t in enumerate(tokens):
        if _CODE.fullmatch(t):
            return ENOUGH
        if t[0].isdigit() or not t[0].isalnum():
            digits = digits or t[0].isdigit()
            continue
        p = plain(t)
        words += 1
        if p in PAGE and any(x[0].isdigit() or _ROMAN.fullmatch(x) for x in tokens[k + 1 : k + 3]):
            pages = True
        elif p in BOOKLET:
            booklet += 1
            capitals += t.isupper()
        elif t.isupper() and len(t) > 1 and not _ROMAN.fullmatch(t):
            capitals += 1
        elif _ROMAN.fullmatch(t):
            digits = True
        elif p not in LINKS:
            content += 1
    alien = max(0, capitals - booklet - 3)
    return CONTENT * content + WORD * min(booklet, 2) + PAGES * pages + DIGITS * digits + CAPITALS * capitals / max(words, 1) + SHOUTED * alien


def tail(line: str) -> int:
    """Where, at the end of a line that begins otherwise, a running line was set; its length if nowhere."""
    end = line.rstrip()
    tokens = list(_TOKEN.finditer(end))
    if not tokens:
        return len(line)
    k, words, caps, digits, first = len(tokens), 0, 0, 0, len(tokens)
    while k:
        t = tokens[k - 1].group()
        p = plain(t)
        if _CODE.fullmatch(t):
            words, caps, digits, first = words + 2, caps + 1, digits + 1, k - 1
        elif t[0].isdigit():
            ordinal = t[-1] in "ºª°"
            gap = k < len(tokens) and tokens[k].start() - tokens[k - 1].end() > 1
            digits += 1
            first = k - 1 if ordinal or gap else first
        elif p in BOOKLET or p in PAGE:
            words, caps, first = words + 1, caps + (t.isupper() and len(t) > 1), k - 1
        elif t.isupper() and len(t) > 1:
            caps, first = caps + 1, k - 1
        elif p not in LINKS and t not in "|-–—•":
            break
        k -= 1
    if k == 0 or first == len(tokens) or not digits and not (words >= 2 and caps):
        return len(line)
    begin = tokens[first].start()
    gap = len(end[:begin]) - len(end[:begin].rstrip())
    return len(end[:begin].rstrip()) if words + caps + (gap > 1) >= TAIL and gap and words else len(line)


_LAST = frozenset("*0123456789")


def _may_have_tail(line: str) -> bool:
    """One look at the last word."""
    end = line.rstrip()
    if not end:
        return False
    if end[-1] in _LAST:
        return True
    last = end[end.rfind(" ") + 1 :]
    return last.isalpha() and (last.isupper() and len(last) > 1 or plain(last) in BOOKLET)


def running(text: str, recurs=frozenset()) -> list[tuple[int, int]]:
    """(begin, end) of running lines and running ends of lines, in order; ``recurs`` holds shapes that many texts have.

    The only line of a text is never one as a whole.
    """
    out, at = [], 0
    several = "\n" in text.strip()
    for line in text.split("\n"):
        if several and len(line) <= LONGEST + 20 and line.strip():
            w = weight(line)
            if w >= ENOUGH or w >= ENOUGH - RECURS and shape(line) in recurs:
                out.append((at, at + len(line)))
                at += len(line) + 1
                continue
        if _may_have_tail(line) and (cut := tail(line)) < len(line):
            out.append((at + cut, at + len(line)))
        at += len(line) + 1
    return out


def strip_running(text: str, recurs=frozenset()) -> str:
    """The text without running headers, footers and page numbers, on lines of their own or at a line's end."""
    found = running(text, recurs)
    if not found:
        return text
    out, at = [], 0
    for b, e in found:
        out.append(text[at:b])
        at = e
    return re.sub(r"\n\s*\n", "\n", "".join(out) + text[at:])


def open_shapes(text: str) -> set[str]:
    """Shapes of the lines that only recurrence can decide."""
    if "\n" not in text.strip():
        return set()
    return {shape(x) for x in text.split("\n") if len(x) <= LONGEST and ENOUGH - RECURS <= weight(x) < ENOUGH}
