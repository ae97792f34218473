"""Boolean columns on page drawings.

A drawing has x0, y0, x1, y1, fill and color (arrays), width, dashes and ``items``: an array of structs with ``cmd``
(``l`` line, ``re`` rectangle, ``c`` curve, ``qu`` quad) and ``pts``, an array of structs x, y (two points of a line, two
corners of a rectangle, four points of a curve or quad).  Null geometry gives false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWING_ITEMS = "array<struct<cmd:string,pts:array<struct<x:double,y:double>>>>"
HEAD, DEEPEST, LEFT, RIGHT = 40.0, 745.0, 25.0, 570.0


def _box() -> tuple[Column, ...]:
    return tuple(F.col(c) for c in ("x0", "y0", "x1", "y1"))


def _outside(bottom: Column) -> Column:
    x0, y0, x1, y1 = _box()
    return (y0 < HEAD) | (y1 > F.greatest(F.lit(DEEPEST), bottom)) | (x0 < LEFT) | (x1 > RIGHT)


def _any(test) -> Column:
    return F.coalesce(F.exists("items", test), F.lit(False))


def _slanted(a: Column, b: Column) -> Column:
    return (F.abs(a["x"] - b["x"]) >= 5) & (F.abs(a["y"] - b["y"]) >= 5)


def vector_figure(bottom: Column) -> Column:
    """A drawing that is a figure of its own: dashes, curves, boxes, bars, slanted strokes, paths; rules and frames are not."""
    x0, y0, x1, y1 = _box()
    w, h = x1 - x0, y1 - y0
    longer, shorter = F.greatest(w, h), F.least(w, h)
    frame = (w > 260) | (h > 450) | ((w < 1) & (h > 400)) | ((h < 1) & (w > 230) & ((y0 < 85) | (y1 > 730)))
    dash = F.trim(F.coalesce(F.col("dashes"), F.lit("")))
    dashed = (dash != "") & ~dash.startswith("[]") & (longer >= 10) & ~((h < 1) & (w >= 220))
    curved = _any(lambda i: i["cmd"] == "c") & (longer >= 12)
    boxed = _any(lambda i: i["cmd"] == "re") & (w < 230) & (((shorter >= 15) & (h < 350)) | ((shorter >= 4) & (longer >= 15) & (shorter <= 40)))
    slanted = _any(lambda i: (i["cmd"] == "l") & _slanted(i["pts"][0], i["pts"][1]))
    path = (F.size(F.filter("items", lambda i: i["cmd"] == "l")) >= 3) & (w >= 15) & (h >= 15) & (w < 230)
    quad = _any(lambda i: (i["cmd"] == "qu") & F.exists(F.sequence(F.lit(0), F.lit(3)), lambda k: _slanted(i["pts"][k], i["pts"][(k + 1) % 4])))
    return F.coalesce(~_outside(bottom) & ~frame & (F.size("items") > 0) & (dashed | curved | boxed | slanted | path | quad), F.lit(False))


def answer_ring() -> Column:
    """The coloured ring around a marked answer: outline only, thick, 10 to 20 points, saturated, curves alone."""
    x0, y0, x1, y1 = _box()
    size = F.greatest(x1 - x0, y1 - y0)
    vivid = (F.size("color") == 3) & (F.array_max("color") - F.array_min("color") >= 0.3)
    return F.coalesce(F.col("fill").isNull() & (F.col("width") >= 1.5) & size.between(10, 20) & vivid & (F.size("items") > 0) & F.forall("items", lambda i: i["cmd"] == "c"), F.lit(False))


def cluster_noise(bottom: Column) -> Column:
    """Margins, rules, hatching, single straight strokes and dots, which no cluster counts."""
    x0, y0, x1, y1 = _box()
    w, h = x1 - x0, y1 - y0
    one = F.try_element_at("items", F.lit(1))
    a, b = one["pts"][0], one["pts"][1]
    dx, dy = F.abs(a["x"] - b["x"]), F.abs(a["y"] - b["y"])
    stroke = (F.size("items") == 1) & (one["cmd"] == "l") & (((dy < 1) & (dx <= 80)) | (dx < 0.5) | (dy < 0.5))
    return F.coalesce(_outside(bottom) | ((w < 1) & (h > 300)) | ((h < 1.5) & (w > 200)) | ((h <= 4) & (w > 50)) | F.coalesce(stroke, F.lit(False)) | (F.greatest(w, h) <= 5), F.lit(True))


def outlined_glyph() -> Column:
    """A letter drawn as a filled outline."""
    x0, y0, x1, y1 = _box()
    return F.coalesce(F.col("fill").isNotNull() & (F.size("items") >= 4) & (y1 - y0).between(3.5, 10) & (x1 - x0).between(0.8, 9), F.lit(False))


def answer_circle() -> Column:
    """The dark filled circle in front of a drawn alternative."""
    x0, y0, x1, y1 = _box()
    return F.coalesce((x1 - x0).between(6.8, 7.0) & (y1 - y0).between(6.8, 7.0) & (F.size("items") == 4) & (F.try_element_at("fill", F.lit(1)) < 0.2), F.lit(False))


def radical_sign() -> Column:
    """A root sign drawn as a filled shape: narrow and tall, a corner at its top right, where the bar begins, and a foot."""
    x0, y0, x1, y1 = _box()
    w, h = x1 - x0, y1 - y0
    some = lambda test: _any(lambda i: F.exists(i["pts"], test))
    corner = some(lambda p: (F.abs(p["x"] - x1) <= 0.8) & (F.abs(p["y"] - y0) <= 0.8))
    foot = some(lambda p: (F.abs(p["y"] - y1) <= 0.8) & p["x"].between(x0 + 0.3 * w, x1 - 0.2 * w))
    return F.coalesce(F.col("fill").isNotNull() & w.between(2.5, 9) & h.between(4, 25) & corner & foot, F.lit(False))
