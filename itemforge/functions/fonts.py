"""Characters behind font codes: glyph names, encodings with differences, symbol fonts, private-use codes, code maps."""

from __future__ import annotations

import re
import unicodedata

#: Letters of the symbol font's encoding in code order, and its signs.
_SYMBOL_UPPER = "ΑΒΧΔΕΦΓΗΙϑΚΛΜΝΟΠΘΡΣΤΥςΩΞΨΖ"
_SYMBOL_LOWER = "αβχδεφγηιϕκλμνοπθρστυϖωξψζ"
_SYMBOL_SIGNS = {0x2D: "−", 0xA2: "′", 0xA3: "≤", 0xA5: "∞", 0xAE: "→", 0xB0: "°", 0xB1: "±", 0xB2: "″", 0xB3: "≥", 0xB4: "×", 0xB9: "≠", 0xBA: "≡", 0xBB: "≈", 0xB8: "÷", 0xB7: "•", 0xC5: "⊕", 0xC7: "∩", 0xC8: "∪", 0xCE: "∈", 0xCF: "∉", 0xD6: "√", 0xD7: "⋅", 0xC6: "∅", 0xE5: "∑", 0xF2: "∫"}
SYMBOL = {**{0x41 + k: c for k, c in enumerate(_SYMBOL_UPPER)}, **{0x61 + k: c for k, c in enumerate(_SYMBOL_LOWER)}, **_SYMBOL_SIGNS}
_ACCENTS = {"grave": "̀", "acute": "́", "circumflex": "̂", "tilde": "̃", "dieresis": "̈", "cedilla": "̧", "ring": "̊", "caron": "̌"}
_NAMED = {
    "space": " ", "exclam": "!", "quotedbl": '"', "numbersign": "#", "dollar": "$", "percent": "%", "ampersand": "&", "quotesingle": "'", "parenleft": "(", "parenright": ")", "asterisk": "*",
    "plus": "+", "comma": ",", "hyphen": "-", "period": ".", "slash": "/", "colon": ":", "semicolon": ";", "less": "<", "equal": "=", "greater": ">", "question": "?", "at": "@", "bracketleft": "[",
    "backslash": "\\", "bracketright": "]", "underscore": "_", "braceleft": "{", "bar": "|", "braceright": "}", "endash": "–", "emdash": "—", "quoteleft": "‘", "quoteright": "’", "quotedblleft": "“",
    "quotedblright": "”", "bullet": "•", "degree": "°", "ordfeminine": "ª", "ordmasculine": "º", "fi": "fi", "fl": "fl", "ff": "ff", "ellipsis": "…", "minus": "−", "multiply": "×", "divide": "÷",
    "plusminus": "±", "section": "§", "germandbls": "ß", "dotlessi": "ı", "radical": "√", "lessequal": "≤", "greaterequal": "≥", "notequal": "≠", "infinity": "∞", "periodcentered": "·",
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "onesuperior": "¹", "twosuperior": "²", "threesuperior": "³",
}


def style(base_font: str) -> str:
    """Name of a font without the tag of a subset."""
    return re.sub(r"^/?[A-Z]{6}\+", "", base_font).lstrip("/")


def glyph(name: str) -> str | None:
    """Text of a glyph name: listed names, letters, letters with an accent's name, ``uniXXXX`` and ``uXXXXX`` codes."""
    name = name.lstrip("/").split(".")[0]
    if name in _NAMED:
        return _NAMED[name]
    if len(name) == 1:
        return name
    if m := re.fullmatch(r"uni([0-9A-Fa-f]{4})|u([0-9A-Fa-f]{4,6})", name):
        return chr(int(m.group(1) or m.group(2), 16))
    if len(name) > 1 and (mark := _ACCENTS.get(name[1:])):
        return unicodedata.normalize("NFC", name[0] + mark)
    try:
        return unicodedata.lookup(f"GREEK {'CAPITAL' if name[0].isupper() else 'SMALL'} LETTER {name.upper()}")
    except KeyError:
        return None


def differences(items: list) -> dict[int, str]:
    """Code map of an encoding's differences: numbers set the code, names follow."""
    out, code = {}, 0
    for x in items:
        if isinstance(x, (int, float)):
            code = int(x)
        else:
            if (c := glyph(str(x))) is not None:
                out[code] = c
            code += 1
    return out


def private_use(c: str, base_font: str = "") -> str:
    """Characters of the private area that hold plain codes: symbol fonts through their encoding, others as they are."""
    if not "\uf000" <= c <= "\uf0ff":
        return c
    code = ord(c) - 0xF000
    return SYMBOL.get(code, chr(code)) if "symbol" in style(base_font).lower() else chr(code)


def code_map(cmap: str, base_font: str = "") -> dict[int, str]:
    """Code map of a ToUnicode program (``bfchar`` and ``bfrange``), private-use targets resolved."""

    def text(h: str) -> str:
        raw = bytes.fromhex(h if len(h) % 2 == 0 else h + "0")
        return "".join(private_use(c, base_font) for c in raw.decode("utf-16-be", "replace"))

    out: dict[int, str] = {}
    for block in re.findall(r"beginbfchar(.*?)endbfchar", cmap, re.S):
        for a, b in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            out[int(a, 16)] = text(b)
    for block in re.findall(r"beginbfrange(.*?)endbfrange", cmap, re.S):
        for a, b, c, many in re.findall(r"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f]+)>|\[(.*?)\])", block, re.S):
            if c:
                first = text(c)
                for k in range(min(int(b, 16) - int(a, 16) + 1, 65536)):
                    out[int(a, 16) + k] = first[:-1] + chr(ord(first[-1]) + k)
            else:
                for k, h in enumerate(re.findall(r"<([0-9A-Fa-f]+)>", many)):
                    out[int(a, 16) + k] = text(h)
    return out
