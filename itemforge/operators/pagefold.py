"""Reading text of a page column with its formulas: spans and strokes -> lines in reading order.

The steps consume what they use (a radical takes its radicand, a fraction its two sides, a matrix its rows) and their
order is part of the result, so one column of one page is one group of a grouped map; its spans are bounded by the page.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemforge.functions import formulas
from itemforge.functions import geometry as G
from itemforge.functions import question as Q
from itemforge.operators import segment
from itemforge.operators.layout import PAGE, page_bottom, page_columns

HEAD, TALLEST, LINE, SCRIPT, SHIFT = 45.0, 50.0, 4.5, 0.85, 1.2
#: Length of a fraction bar, text of a side, least reach of a side in points and in sizes, how far a side may cross the bar.
BAR_SHORTEST, BAR_LONGEST, SIDE_LONGEST, REACH, REACH_SIZES, CROSSING = 2.0, 80.0, 35, 16.0, 1.8, 3.0
_WORDS = re.compile(r"[A-Za-zÀ-ÿ]{3,}")
OPEN, CLOSE = "([{⎛⎜⎝", ")]}⎞⎟⎠"
#: Pieces from which tall delimiters are put together, and the delimiter they form.
PIECES = dict.fromkeys("⎛⎜⎝(", "(") | dict.fromkeys("⎞⎟⎠)", ")") | dict.fromkeys("⎡⎢⎣[", "[") | dict.fromkeys("⎤⎥⎦]", "]")
SYMBOL_FONTS = re.compile("Symbol|Math|Extra")


@dataclass
class Piece:
    x0: float
    y0: float
    x1: float
    y1: float
    text: str
    size: float
    base: float
    kind: str = "span"
    font: str = ""
    xs: tuple[float, ...] = ()

    @property
    def cx(self) -> float:
        return (self.x0 + self.x1) / 2

    @property
    def cy(self) -> float:
        return (self.y0 + self.y1) / 2


def scripts(line: list[Piece]) -> str:
    """Pieces of one line, left to right: smaller ones off the base line become scripts, gaps become blanks."""
    line = sorted(line, key=lambda p: p.x0)
    spans = [p for p in line if p.kind == "span" and p.text.strip()]
    tall = max((p.size for p in spans), default=0.0)
    level = next((p.base for p in spans if p.size >= SCRIPT * tall), 0.0)
    out, end, mode = "", None, ""
    for p in line:
        text = p.text if p.kind != "span" else p.text.replace("\u200a", "")
        now = ""
        if p.kind == "span" and p.size < SCRIPT * tall and text.strip():
            now = "^" if p.base < level - SHIFT else "_" if p.base > level + SHIFT else ""
        if now == "^" and text.strip() in ("a", "o") and out[-1:].isdigit():
            text, now = {"a": "ª", "o": "º"}[text.strip()], ""
            out += text
            end, mode = p.x1, ""
            continue
        if now and now == mode and out.endswith("}"):
            out = out[:-1] + text.strip() + "}"
        elif now:
            out = out.rstrip() + f"{now}{{{text.strip()}}}"
        else:
            if end is not None and p.x0 - end > 0.25 * max(p.size, 1) and out[-1:].strip() and text[:1].strip():
                out += " "
            out += text
        end, mode = p.x1, now
    return re.sub(r"[ \t]+", " ", out).strip()


def radicals(pieces: list[Piece], bars: list[tuple[float, float, float]]) -> tuple[list[Piece], list[tuple[float, float, float]]]:
    """Radical signs with the bar that starts at their top right; the bar is used up, what it covers is the radicand."""
    bars, out, used = list(bars), [], set()
    for k, p in enumerate(pieces):
        if p.text.strip() != "√" or k in used:
            continue
        bar = next((b for b in bars if abs(b[0] - p.x1) <= 1.5 and p.y0 - 3 <= b[2] <= p.y0 + 0.5 * (p.y1 - p.y0)), None)
        if bar is None:
            continue
        bars.remove(bar)
        held = [j for j, q in enumerate(pieces) if j != k and j not in used and bar[0] - 1.5 <= q.cx <= bar[1] + 2 and bar[2] - 1 <= q.cy <= p.y1 + 2]
        used.update([k, *held])
        inner = [pieces[j] for j in held]
        out.append(Piece(p.x0, min(p.y0, bar[2]), max(p.x1, bar[1]), p.y1, "\\sqrt{" + scripts(inner) + "}", p.size, p.base, "radical"))
    return [p for j, p in enumerate(pieces) if j not in used] + out, bars


def stacked(pieces: list[Piece]) -> list[Piece]:
    """Delimiters of symbol fonts that are set one below the other in one column, as one delimiter of their whole height."""
    kind = lambda p: PIECES.get(p.text.strip()[:1], "") if SYMBOL_FONTS.search(p.font) and len(set(map(PIECES.get, p.text.strip()))) == 1 else ""
    tall = sorted((p for p in pieces if kind(p)), key=lambda p: (kind(p), round(p.x0), p.y0))
    made: list[Piece] = []
    for p in tall:
        last = made[-1] if made else None
        if last and PIECES[last.text] == kind(p) and abs(last.x0 - p.x0) <= 1 and last.y0 < p.y0 <= last.y1 + 0.5:
            made[-1] = replace(last, y1=max(last.y1, p.y1), base=p.base)
        else:
            made.append(replace(p, text=kind(p)))
    return [p for p in pieces if not kind(p)] + made


def underscores(pieces: list[Piece]) -> tuple[list[Piece], list[tuple[float, float, float]]]:
    """Pieces without those of underscores only, and the bars that these draw a little below their base line."""
    drawn = [p for p in pieces if re.fullmatch("_{2,}", p.text.strip())]
    return [p for p in pieces if not any(p is d for d in drawn)], [(p.x0, p.x1, p.base + 0.15 * p.size) for p in drawn]


def cut_at(piece: Piece, x: float) -> list[Piece]:
    """A piece in two where its characters lie on either side of ``x``; whole if their edges are unknown or one side is blank."""
    if len(piece.xs) != len(piece.text) + 1:
        return [piece]
    k = sum((a + b) / 2 < x for a, b in zip(piece.xs, piece.xs[1:]))
    parts = []
    for b, e in ((0, k), (k, len(piece.text))):
        text = piece.text[b:e]
        lead, end = len(text) - len(text.lstrip()), len(text.rstrip())
        if not text.strip():
            return [piece]
        xs = piece.xs[b + lead : b + end + 1]
        parts.append(replace(piece, text=text.strip(), x0=xs[0], x1=xs[-1], xs=xs))
    return parts


def _side(p: Piece, y: float) -> int:
    """-1 if a piece belongs above a bar, 1 if below, 0 if neither: its middle decides, its near edge may cross a little, its far one has a reach."""
    side = -1 if p.cy < y - 0.5 else 1 if p.cy > y + 0.5 else 0
    near, far = (y - p.y1, y - p.y0) if side < 0 else (p.y0 - y, p.y1 - y)
    crossing, reach = (CROSSING, max(REACH, REACH_SIZES * p.size)) if p.kind == "span" else (CROSSING / 2, max(REACH, p.y1 - p.y0 + CROSSING))
    return side if near >= -crossing and far <= reach else 0


def _fits(text: str) -> bool:
    """Whether a text can stand on one side of a fraction: short, without words."""
    words = [text[b:e].lower() for kind, b, e in formulas.tokens(text) if kind == "palavra" and e - b > 2]
    return len(text) <= SIDE_LONGEST and set(words) <= formulas.FUNCTIONS


def fractions(pieces: list[Piece], bars: list[tuple[float, float, float]]) -> list[Piece]:
    """Short bars with text close above and below, shortest first so that inner fractions come first."""
    for x0, x1, y in sorted(bars, key=lambda b: (b[1] - b[0], b[2], b[0])):
        if not BAR_SHORTEST <= x1 - x0 <= BAR_LONGEST:
            continue
        for end in (x0, x1):
            pieces = [part for p in pieces for part in (cut_at(p, end) if p.x0 + 1 < end < p.x1 - 1 and p.kind == "span" and _side(p, y) and _fits(p.text) else [p])]
        sides: dict[int, list[Piece]] = {-1: [], 0: [], 1: []}
        for p in pieces:
            sides[_side(p, y) if x0 - 2 <= p.cx <= x1 + 2 else 0].append(p)
        over, under = sides[-1], sides[1]
        ordinal = x1 - x0 <= 6 and [p.text.strip() for p in over] in (["a"], ["o"]) and over[0].size < 7.5
        top, low = scripts(over), scripts(under)
        if ordinal or not over or not under or not (_fits(top) and _fits(low)):
            continue
        whole = over + under
        size = max(p.size for p in whole)
        made = Piece(min(p.x0 for p in whole), min(p.y0 for p in over), max(p.x1 for p in whole), max(p.y1 for p in under), f"\\frac{{{top}}}{{{low}}}", size, y + 0.3 * size, "fraction")
        pieces = [*sides[0], made]
    return pieces


def matrices(pieces: list[Piece]) -> list[Piece]:
    """Tall delimiters that face each other around at least two rows without words."""
    tall = [p for p in pieces if p.kind == "span" and p.text.strip() in OPEN + CLOSE and p.text.strip() and p.y1 - p.y0 >= 1.8 * _usual(pieces)]
    for left in [p for p in tall if p.text.strip() in OPEN]:
        right = next((q for q in sorted(tall, key=lambda q: q.x0) if q.text.strip() in CLOSE and q.x0 > left.x0 and abs(q.y0 - left.y0) <= 10 and abs(q.y1 - left.y1) <= 10), None)
        if right is None or not any(p is left for p in pieces) or not any(p is right for p in pieces):
            continue
        held = [p for p in pieces if left.x1 - 1 <= p.cx <= right.x0 + 1 and left.y0 - 2 <= p.cy <= left.y1 + 2 and p is not left and p is not right]
        rows: list[list[Piece]] = []
        for p in sorted(held, key=lambda p: p.cy):
            if rows and p.cy - rows[-1][0].cy <= 6:
                rows[-1].append(p)
            else:
                rows.append([p])
        if len(rows) < 2 or any(p.kind != "span" or _WORDS.search(p.text) for p in held):
            continue
        body = " \\\\ ".join(" & ".join(c.text.strip() for c in sorted(r, key=lambda c: c.x0)) for r in rows)
        gone = {id(p) for p in [left, right, *held]}
        mid = (left.y0 + left.y1) / 2
        made = Piece(left.x0, left.y0, right.x1, left.y1, f"\\begin{{pmatrix}} {body} \\end{{pmatrix}}", _usual(pieces), mid + 3, "matrix")
        pieces = [p for p in pieces if id(p) not in gone] + [made]
    return pieces


def _usual(pieces: list[Piece]) -> float:
    sizes = sorted(p.size for p in pieces if p.text.strip())
    return sizes[len(sizes) // 2] if sizes else 10.0


def lines_of(pieces: list[Piece]) -> list[list[Piece]]:
    """Lines of a column: a piece joins a line near its level, or as a script that touches it."""
    full = [p for p in pieces if p.text.strip()]
    usual = _usual(full)
    lines: list[list[Piece]] = []
    for p in sorted((p for p in full if p.size >= SCRIPT * usual or p.kind != "span"), key=lambda p: (p.base if p.kind == "span" else p.cy + 3, p.x0)):
        level = p.base if p.kind == "span" else p.cy + 3
        if lines and level - lines[-1][0].base <= LINE and lines[-1][0].kind == "span":
            lines[-1].append(p)
        elif lines and p.kind != "span" and any(q.y0 - 1 <= p.cy <= q.y1 + 1 for q in lines[-1]):
            lines[-1].append(p)
        elif lines and lines[-1][0].kind != "span" and lines[-1][0].y0 - 1 <= p.cy <= lines[-1][0].y1 + 1:
            lines[-1].append(p)
        else:
            lines.append([p])
    for p in (p for p in full if p.size < SCRIPT * usual and p.kind == "span"):
        near = [ln for ln in lines if min(abs(q.cy - p.cy) for q in ln) <= usual and any(q.x0 - 2 <= p.cx <= q.x1 + 3 * usual for q in ln)]
        (min(near, key=lambda ln: min(abs(q.cy - p.cy) for q in ln)) if near else lines.append([]) or lines[-1]).append(p)
    return sorted((ln for ln in lines if ln), key=lambda ln: min(q.y0 if q.kind == "span" else q.cy for q in ln))


def column_text(pieces: list[Piece], bars: list[tuple[float, float, float]], markers: list[Piece], bottom: float) -> str:
    """Text of one column: crop, then radicals, fractions, matrices, then lines; table markers take their place."""
    kept = [p for p in pieces if p.y1 > HEAD and p.y0 < bottom and p.y1 - p.y0 <= TALLEST and not Q.BARCODE.fullmatch(p.text.strip())]
    kept = [p for p in kept if not any(m.x0 <= p.cx <= m.x1 and m.y0 <= p.cy <= m.y1 for m in markers)]
    bars = [b for b in bars if not any(m.x0 <= (b[0] + b[1]) / 2 <= m.x1 and m.y0 <= b[2] <= m.y1 for m in markers)]
    kept, drawn = underscores(stacked(kept))
    kept, bars = radicals(kept, bars + drawn)
    kept = matrices(fractions(kept, bars))
    out = []
    for line in lines_of(kept) + [[m] for m in markers]:
        text = scripts(line) if line[0].kind != "table" else line[0].text
        made = [p for p in line if p.kind not in ("span", "table")]
        if made:
            text = Q.mark_in_prose(text) if Q.has_prose(text) else f"${text}$" if "$" not in text else text
        out.append((min(p.y0 for p in line), min(p.x0 for p in line), text))
    return "\n".join(Q.split_glued(t) for _, _, t in sorted(out, key=lambda r: r[:2]) if t)


def _piece(r) -> Piece:
    raw = r.text or ""
    text = Q.span_text(raw) if r.kind == "span" else raw
    xs = tuple(r.xs) if r.xs is not None and text == raw else ()
    return Piece(r.x0, r.y0, r.x1, r.y1, text, r.size, r.base, r.kind, r.font or "", xs)


def page_texts(pages: DataFrame, blocks: DataFrame, lines: DataFrame, spans: DataFrame, drawings: DataFrame, tables: DataFrame, brand: str = Q.BRAND) -> DataFrame:
    """(doc_id, page_no, text): cleaned text of every page after the cover, columns in order.

    ``spans``: doc_id, page_no, x0..y1, text, size, base, and where known font and xs, the edges of the characters;
    ``tables``: accepted tables as boxes with tbl_no.  One shuffle brings a column's spans, strokes and tables together.
    """
    cols, bottoms = page_columns(pages, blocks), page_bottom(pages, lines)
    setup = cols.join(bottoms, PAGE).where("page_no >= 1")

    def placed(df: DataFrame, kind: str, *extra) -> DataFrame:
        j = df.join(setup, PAGE)
        col = F.when(F.col("single") | ((F.col("x0") + F.col("x1")) / 2 < F.col("mid")), 0).otherwise(1)
        return j.select(*PAGE, col.alias("col"), "bottom", F.lit(kind).alias("kind"), *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], *extra)

    known = lambda c, kind: (F.col(c) if c in spans.columns else F.lit(None)).cast(kind).alias(c)
    none = [F.lit(None).cast("string").alias("font"), F.lit(None).cast("array<double>").alias("xs")]
    text = placed(spans, "span", F.col("text"), F.col("size").cast("double").alias("size"), F.col("base").cast("double").alias("base"), known("font", "string"), known("xs", "array<double>"))
    roots = placed(drawings.where(G.radical_sign()), "span", F.lit("√").alias("text"), (F.col("y1") - F.col("y0")).alias("size"), F.col("y1").cast("double").alias("base"), *none)
    flat = drawings.where("y1 - y0 < 1.5 and x1 - x0 >= 2")
    strokes = placed(flat, "bar", F.lit("").alias("text"), F.lit(0.0).alias("size"), F.lit(0.0).alias("base"), *none)
    marks = placed(tables, "table", F.format_string("\ue010%d:%d\ue011", F.col("page_no").cast("int"), F.col("tbl_no").cast("int")).alias("text"), F.lit(0.0).alias("size"), F.lit(0.0).alias("base"), *none)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.itertuples(index=False))
        make = lambda k: [_piece(r) for r in rows if r.kind == k]
        bars = [(r.x0, r.x1, (r.y0 + r.y1) / 2) for r in rows if r.kind == "bar"]
        first = rows[0]
        return pd.DataFrame({"doc_id": [str(first.doc_id)], "page_no": [int(first.page_no)], "col": [int(first.col)], "text": [column_text(make("span"), bars, make("table"), first.bottom)]})

    both = text.unionByName(roots).unionByName(strokes).unionByName(marks)
    columns = both.groupBy(*PAGE, "col").applyInPandas(fold, "doc_id string, page_no int, col int, text string")
    clean = columns.withColumn("text", segment.clean_page(F.col("text"), brand))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda s: s["text"]), "\n")
    return clean.groupBy(*PAGE).agg(joined.alias("text"))
