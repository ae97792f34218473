"""What a printed page leaves in the text of its questions: heads, feet, watermarks and banners.

A line is read as a string of word kinds (an area, a colour, a day, a booklet, a page, a number), one letter for each
word; short patterns over that string tell lines of the page and where a page foot begins behind an alternative.
"""

from __future__ import annotations

import re
import unicodedata

BRAND = "SIMULADO"
BARCODE = re.compile(r"\*[0-9A-Za-z_–-]+\*")
_I = re.IGNORECASE

#: Kinds of the words of page heads and feet, without accents.
KINDS = {
    "C": ("AMARELO", "AZUL", "CINZA", "ROSA", "BRANCO", "VERDE"),
    "A": ("CIENCIAS", "MATEMATICA", "LINGUAGENS", "REDACAO"),
    "S": ("CH", "CN", "LC", "MT", "RED"),
    "D": ("DIA",),
    "W": ("DOMINGO", "SABADO"),
    "K": ("CADERNO",),
    "k": ("RNO",),
    "P": ("PAGINA",),
    "T": ("TECNOLOGIAS",),
    "Q": ("QUESTOES", "QUESTAO"),
    "x": ("TEXTO",),
    "c": ("COMUM",),
    "p": ("PARA",),
    "a": ("A", "AS"),
    "d": ("DE", "DA", "E", "SUAS", "NATUREZA", "HUMANAS", "CODIGOS"),
    "L": ("APLICACAO",),
    "R": ("RASCUNHO",),
    "t": ("TRANSCREVA",),
    "f": ("FOLHA",),
    "s": ("SUA",),
    "o": ("O",),
}
_KIND = {w: k for k, words in KINDS.items() for w in words}
#: Lines of the page: booklet with colour or page; page with number; area with day, booklet or weekday; area code with day; day
#: alone or with booklet; area banner; range of questions; essay sheet.
_PAGE_LINE = re.compile(r".*(?:K[nN].*[CP]|[CP].*K[nN])|.*P[nN]|A.*[DKW]|SnD|nD(?:K|$)|Ad*T$|Qd[nN]a[nN]$|Rd?A?$|tasA|o?p?a?fdA!?$")
#: Where a page foot begins: essay sheet, area, area code with day, range of questions, booklet, day with booklet, second
#: application, colour or page at the end, a text for several questions.
_FOOT = re.compile(r"R|tasA|o?p?a?fdA|A|[nN]?SnD|Qd[nN]a[nN]|[Kk][nN]|nDK|C?nL|CP[nN]|C[nN]?$|P[nN]$|xc?paQ[nN]")
_SHEET = re.compile(r"R|tasA|o?p?a?fdA")
_TOKEN = re.compile(r"(\d+)[ºª°Oo]?(?![^\W_])|([^\W\d_]+)|([.!?])")
_MARKS = " \t•-–—|"
#: The banner that columns cut into pieces, and a piece that reads otherwise.
BANNER, BANNER_PIECES = "RASCUNHO DA REDACAO", ("NUNHO",)


def _pieces(banner: str) -> frozenset[str]:
    """Stretches of the banner of four letters or more that begin or end where one of its words does."""
    begins = [m.start() for m in re.finditer(r"\S+", banner)]
    ends = [m.end() for m in re.finditer(r"\S+", banner)]
    cut = {banner[b:e] for b in begins for e in range(b + 4, len(banner) + 1)} | {banner[b:e] for e in ends for b in range(e - 3)}
    return frozenset(p.strip() for p in cut if len(p.replace(" ", "")) > 3) - {"REDACAO"}


_BANNER = _pieces(BANNER) | set(BANNER_PIECES)


class _Upper(dict):
    """Capital without accent of a letter; other characters stay."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = found = unicodedata.normalize("NFD", c)[0].upper()[:1] if c.isalpha() else c
        return found


_UPPER = _Upper()


def plain(text: str) -> str:
    """Upper case without accents, character by character, so that positions stay."""
    return text.upper() if text.isascii() else text.translate(_UPPER)


def kinds(text: str) -> tuple[str, list[int]]:
    """One letter for each word or number of a line, and where each begins; ``n`` is 1 or 2, ``N`` another number, ``.`` any other word, ``!`` the end of a sentence."""
    found, at = [], []
    for m in _TOKEN.finditer(plain(text)):
        number, word, _ = m.groups()
        found.append(("n" if number in ("1", "2") else "N") if number else _KIND.get(word, ".") if word else "!")
        at.append(m.start())
    return "".join(found), at


#: What every page line, foot and essay sheet has something of.
_HINT = re.compile("|".join(("CADERNO", "RNO", "P[AÁ]GINA", "DIA", "DOMINGO", "S[AÁ]BADO", "TECNOLOGIAS", "QUEST", "APLICA", "RASCUNHO", "TRANSCREVA", "REDA", "CI[EÊ]NCIAS", "MATEM", "LINGUAGENS", *KINDS["C"])), _I)


def is_page_line(line: str, brand: str = BRAND) -> bool:
    """Whether a line belongs to the page, not to a question."""
    if re.fullmatch(rf"\d{{1,2}}|(?:{brand}\s*)?20\d{{2}}", line, _I):
        return True
    if _HINT.search(line) and _PAGE_LINE.match(kinds(line)[0]):
        return True
    return len(line) <= len(BANNER) + 2 and plain(line).rstrip(".") in _BANNER


def _cut(text: str, begin: re.Pattern) -> str:
    """The text up to where, in its last line, ``begin`` is met."""
    last = text.rfind("\n") + 1
    if not _HINT.search(text, last):
        return text
    shape, at = kinds(text[last:])
    m = begin.search(shape)
    return text[: last + at[m.start()]].rstrip(_MARKS + "\n") if m else text


def without_foot(text: str) -> str:
    """An alternative without the page foot that was read with it."""
    return _cut(text, _FOOT)


def without_sheet(text: str) -> str:
    """A statement without the essay sheet that was read with it."""
    return _cut(text, _SHEET)
