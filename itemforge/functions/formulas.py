"""Formulas in the text of questions: one scanner over characters tells commands, scripts and words apart.

Everything that marks formulas asks the scanner; ``$...$`` encloses what is marked.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

from itemforge.functions.scalar import PICTURE

#: Names of functions, and of commands that formulas use.
FUNCTIONS = frozenset({"log", "sen", "cos", "tg", "rad", "det", "max", "min", "lim", "mod"})
COMMANDS = frozenset({
    "alpha", "approx", "begin", "beta", "bullet", "cap", "cdot", "circ", "cos", "cup", "delta", "Delta", "div", "end", "epsilon", "equiv", "eta", "frac",
    "gamma", "Gamma", "ge", "geq", "in", "infty", "lambda", "Lambda", "ldots", "le", "left", "leftarrow", "leq", "ln", "log", "mu", "ne", "neq", "notin",
    "nu", "omega", "Omega", "phi", "Phi", "pi", "Pi", "pm", "psi", "rho", "right", "rightarrow", "sen", "sigma", "Sigma", "sqrt", "sum", "tau", "tg",
    "therefore", "theta", "Theta", "times", "varnothing", "xi",
})
SYMBOLS = {
    "α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "Δ": r"\Delta", "θ": r"\theta", "λ": r"\lambda", "μ": r"\mu", "π": r"\pi", "ρ": r"\rho",
    "σ": r"\sigma", "φ": r"\phi", "ω": r"\omega", "Ω": r"\Omega", "≤": r"\le", "≥": r"\ge", "≠": r"\ne", "±": r"\pm", "×": r"\times", "÷": r"\div",
    "·": r"\cdot", "∞": r"\infty", "→": r"\rightarrow", "∈": r"\in", "∪": r"\cup", "∩": r"\cap", "√": r"\sqrt", "≈": r"\approx", "−": "-",
}
#: Commands whose arguments make a formula of their own in prose, commands that make one of an alternative, relations.
BUILT, SIGNS = ("frac", "sqrt"), ("frac", "sqrt", "pi", "cdot", "times", "begin{pmatrix}", "le", "ge", "ne", "pm", "circ", "div", "alpha", "beta", "theta")
RELATIONS = ("<", ">", "=", r"\leq", r"\geq", r"\le", r"\ge", r"\ne")
MATRIX_END = r"\end{pmatrix}"

#: A dollar sign of the text that is no money sign: held apart while ``$`` delimits formulas, ``\\$`` in the end.
DOLLAR = "\ue002"
_LITERAL_DOLLAR = re.compile(r"(?<!\bR)(?<!\bU)(?<!\bUS)\$")
#: Letters and digits of the mathematical alphabets, which some fonts draw twice.
_MATH_ALPHABET = re.compile("([\U0001d400-\U0001d7ff])\\1?")
_SYMBOL = re.compile("|".join(map(re.escape, SYMBOLS)))
_NAME = re.compile(r"[a-zA-Z]+")
_ANY = "|".join(sorted(COMMANDS, key=lambda c: (-len(c), c)))
_GLUED = re.compile(rf"\\(?!(?:{_ANY})(?![a-zA-Z]))({_ANY})(?=[a-zA-Z])")


# --- scanner ----------------------------------------------------------------------------------------------------------


def closed(text: str, at: int, pair: str = "{}") -> int:
    """End of the bracket that opens at ``at``, nested ones included; ``at`` itself if it never closes."""
    depth = 0
    for k in range(at, len(text)):
        depth += (text[k] == pair[0]) - (text[k] == pair[1])
        if not depth:
            return k + 1
    return at


def command_end(text: str, at: int) -> tuple[str, int, int]:
    """(name, end of the name, end of the arguments) of the command at ``at``."""
    m = _NAME.match(text, at + 1)
    name_end = end = m.end() if m else at + 1
    while True:
        k = end
        while k < len(text) and text[k].isspace():
            k += 1
        closing = closed(text, k, "{}") if text[k : k + 1] == "{" else closed(text, k, "[]") if text[k : k + 1] == "[" else k
        if closing == k:
            return m.group() if m else "", name_end, end
        end = closing


def script_end(text: str, at: int) -> int:
    """End of the script whose sign stands at ``at``: a bracket, or the letters and digits that follow; ``at`` if there is none."""
    k = at + 1
    if text[k : k + 1] == "{":
        return closed(text, k) if closed(text, k) > k + 2 else at
    while k < len(text) and text[k].isascii() and text[k].isalnum():
        k += 1
    return k if k > at + 1 else at


def tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, begin, end): commands with their arguments, scripts in brackets, words, single other characters."""
    k = 0
    while k < len(text):
        kind, end = "outro", k + 1
        if text[k] == "\\" and k + 1 < len(text) and text[k + 1].isalpha():
            kind, end = "comando", command_end(text, k)[2]
        elif text[k] in "^_" and text[k + 1 : k + 2] == "{":
            kind, end = "índice", max(closed(text, k + 1), k + 1)
        elif text[k].isalpha() and text[k] <= "ÿ":
            kind = "palavra"
            while end < len(text) and text[end].isalpha() and text[end] <= "ÿ":
                end += 1
        yield kind, k, end
        k = end


def has_prose(text: str) -> bool:
    """A word of four letters, or two of three, outside commands, scripts and function names."""
    long = [e - b for kind, b, e in tokens(text) if kind == "palavra" and e - b > 2 and text[b:e].lower() not in FUNCTIONS]
    return len(long) > 1 or sum(long) > 3


def outside_formulas(text: str, change) -> str:
    """Apply ``change`` to the parts outside ``$...$``; with an odd number of signs the whole text is one part."""
    parts = text.split("$")
    if len(parts) % 2 == 0:
        return change(text)
    return "$".join(p if k % 2 else change(p) for k, p in enumerate(parts))


# --- marks ------------------------------------------------------------------------------------------------------------


def _variable(text: str, at: int) -> int:
    """End of the indexed letters that begin at ``at``."""
    while at + 1 < len(text) and text[at].isascii() and text[at].isalpha() and text[at + 1] == "_" and (end := script_end(text, at + 1)) > at + 1:
        at = end
    return at


def _compared(text: str, at: int) -> int:
    """End of indexed letters and of those that relations tie to them."""
    end = _variable(text, at)
    while end > at:
        k = end
        while text[k : k + 1].isspace():
            k += 1
        sign = next((r for r in RELATIONS if text.startswith(r, k)), None)
        if sign is None:
            break
        k += len(sign)
        while text[k : k + 1].isspace():
            k += 1
        further = _variable(text, k)
        if further == k:
            break
        end = further
    return end


def _power(text: str, at: int) -> int:
    """End of a power that begins at ``at``: a number with any exponent, or up to three letters with a digit or bracket."""
    k = at
    number = text[at].isdigit()
    while k < len(text) and text[k].isascii() and (text[k].isdigit() if number else text[k].isalpha()):
        k += 1
    if text[k : k + 1] != "^" or k == at or not number and (k - at > 3 or text[at - 1 : at] in ("\\", "}")):
        return at
    end = script_end(text, k)
    if not number and end > k and text[k + 1] != "{":
        end = k + 2 if text[k + 1].isdigit() else k
    return end if end > k else at


def mark_inline(text: str) -> str:
    """``$`` around indexed variables, powers of numbers and short powers; commands and their arguments stay untouched."""
    if "_" not in text and "^" not in text:
        return text
    out, k = [], 0
    free = lambda c: c != "$" and c != "_" and not c.isalnum()
    while k < len(text):
        if text[k] == "\\" and (ends := command_end(text, k))[2] > ends[1]:
            out.append(text[k : ends[2]])
            k = ends[2]
            continue
        end = k
        if text[k].isascii() and text[k].isalnum() and (k == 0 or free(text[k - 1])):
            end = next((e for e in (_compared(text, k), _power(text, k)) if e > k and (e == len(text) or free(text[e]))), k)
        out.append(f"${text[k:end]}$" if end > k else text[k])
        k = max(end, k + 1)
    return "".join(out)


def _built(text: str) -> list[tuple[int, int]]:
    """Outermost fractions, roots and matrices of a text, and scripts that hold a command, each with what it belongs to."""
    found: list[tuple[int, int]] = []
    for kind, b, e in tokens(text):
        if found and b < found[-1][1]:
            continue
        before = text[found[-1][1] if found else 0 : b]
        if kind == "índice" and "\\" in text[b:e]:
            found.append((b - len(before) + len(before.rstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.)]")), e))
        elif kind == "comando":
            name, name_end, _ = command_end(text, b)
            if name == "begin" and text.startswith("{pmatrix}", name_end) and (close := text.find(MATRIX_END, name_end)) > 0:
                found.append((b, close + len(MATRIX_END)))
            elif name in BUILT:
                end = name_end
                for _ in range(1 + (name == "frac")):
                    if text[end : end + 1] == "[":
                        end = closed(text, end, "[]")
                    end = closed(text, end) if text[end : end + 1] == "{" else end
                whole = re.search(r"\d+\s+$", before) if name == "frac" else None
                if end > name_end:
                    found.append((b - len(whole.group()) if whole else b, end))
    return found


def mark_in_prose(text: str) -> str:
    """In a line of prose only the formulas get ``$``: outermost first, then what ``mark_inline`` finds."""

    def built(part: str) -> str:
        out, at = [], 0
        for b, e in _built(part):
            out += [part[at:b], f"${part[b:e]}$"]
            at = e
        return "".join(out) + part[at:]

    return outside_formulas(outside_formulas(text, built), mark_inline)


def split_glued(text: str) -> str:
    """A blank after the longest known command that an unknown command begins with."""
    return _GLUED.sub(r"\\\1 ", text)


def with_commands(text: str) -> str:
    """Symbols as commands, with a blank before a letter that follows."""

    def command(m: re.Match) -> str:
        c = SYMBOLS[m.group()]
        return c + (" " if c[-1].isalpha() and text[m.end() : m.end() + 1].isalpha() else "")

    return _SYMBOL.sub(command, text)


def span_text(text: str) -> str:
    """Text of a span as the page fold takes it: plain letters, commands for symbols, literal dollars held apart."""
    text = _MATH_ALPHABET.sub(lambda m: unicodedata.normalize("NFKC", m.group(1)), text.replace("\u200a", ""))
    return _LITERAL_DOLLAR.sub(DOLLAR, with_commands(text) if text.strip() != "√" else text)


def holds_sign(text: str) -> bool:
    """Whether a text has a script sign or a command that makes a formula."""
    return "^" in text or "_" in text or any("\\" + s in text for s in SIGNS)


def format_alternative(text: str) -> str:
    """Formula of an alternative in ``$...$``: whole alternatives, or only the formulas of prose."""
    body = text.strip()
    if body in ("", PICTURE):
        return body
    closing = body.endswith("$")
    body = body[:-1].rstrip() if closing else body
    if body.endswith(r"\cdot"):
        body = body[: -len(r"\cdot")].rstrip()
    if closing:
        if body.startswith("$") and body.count("$") == 1:
            body = "$" + body[1:].removesuffix(".").strip()
        return body + "$"
    if "$" in body or not holds_sign(body):
        return body
    if has_prose(body):
        return mark_in_prose(body)
    return f"${body[:-1].strip() if body.endswith('.') and not body.endswith('..') else body}$"


def format_cell(text: str) -> str:
    """Symbols of a table cell as commands; a cell that is an expression goes into ``$...$`` whole."""
    text = with_commands(text)
    commands = [b for b in range(len(text)) if text[b] == "\\" and _NAME.match(text, b + 1)]
    words = re.findall(r"[^\W\d_]+", re.sub(r"\\[a-zA-Z]+", " ", text))
    scripted = any(text[k] in "^_" and text[k + 1 : k + 2] != "}" and text[k + 1 :].lstrip("{")[:1].isalnum() for k in range(len(text)))
    related = any(c in text for c in "<>=") and any(len(w) == 1 for w in words)
    whole = (commands or scripted or related) and max(map(len, words), default=0) < 4 and not any(c in text for c in "$ªº")
    return f"${text}$" if whole else mark_inline(text)


def markdown(rows: list[list[str]], caption: str | None = None) -> str:
    """A table as Markdown: optional caption line, header, separator, body; ``|`` is escaped."""
    shown = [[format_cell(c or "").replace("|", r"\|") for c in r] for r in rows]
    lines = ["| " + " | ".join(r) + " |" for r in shown]
    if lines:
        lines.insert(1, "|" + "---|" * len(shown[0]))
    return "\n".join(([format_cell(caption).replace("|", r"\|")] if caption else []) + lines)
