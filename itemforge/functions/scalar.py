"""Column expressions: safe casts, colours, days, ordered classification rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bank's vocabulary.
AREAS = ("CN", "CH", "LC", "MT")
COLOURS = {"AZUL": "AZUL", "AMARELO": "AMARELO", "AMARELA": "AMARELO", "BRANCO": "BRANCO", "BRANCA": "BRANCO", "ROSA": "ROSA", "CINZA": "CINZA", "VERDE": "VERDE"}
PREFERRED_COLOURS = ("AMARELO", "AZUL", "CINZA", "ROSA", "VERDE", "BRANCO")
ADAPTED_WORDS = ("digital", "adaptad", "ledor", "brail", "ampliad", "superampliad", "leitor tela", "dosvox", "nvda", "libras", "videoprova", "especial")
SECOND_CALL_WORDS = ("reaplica", "ppl", "oportunidade", "segunda", "2ª", "2a")
FIRST_CALL_KEYS = ("P1", "REGULAR", "PRIMEIRA", "1")
SECOND_CALL_KEYS = ("P2", "PPL", "REAPLICACAO", "REAPLICAÇÃO", "SEGUNDA", "2")
TABLE_COLOUR_ORDER = ("AZUL", "AMARELO", "AMARELA", "BRANCO", "BRANCA", "ROSA", "CINZA", "VERDE")
PICTURE = "[Figura / Imagem]"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def safe_double(c: Column) -> Column:
    """Number of a text or number, null where it is none."""
    return c.try_cast("double")


def safe_long(c: Column) -> Column:
    """Whole number of a text such as ``3`` or ``3.0``; null for anything else, fractions included."""
    d = safe_double(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def colour(c: Column) -> Column:
    """Unified colour name; null for null, empty and unknown names."""
    key = F.upper(strip(c.cast("string")))
    return F.element_at(F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv]), F.coalesce(key, F.lit("")))


def exam_day(area: Column, year: Column, strict: bool = False) -> Column:
    """Day on which an area is examined: the calendar changed after 2016.  Unknown areas give null, or fail if strict."""
    a = F.upper(strip(area))
    early = year <= 2016
    rule = (
        F.when(a == "CH", 1)
        .when(a == "MT", 2)
        .when(a == "CN", F.when(early, 1).otherwise(2))
        .when(a == "LC", F.when(early, 2).otherwise(1))
    )
    return rule.otherwise(F.raise_error(F.concat(F.lit("unknown area "), F.coalesce(a, F.lit("null"))))) if strict else rule


def application_key(c: Column) -> Column:
    """``P1`` or ``P2`` of an application label; unknown and null labels count as the first call."""
    return F.when(F.upper(strip(c)).isin(*SECOND_CALL_KEYS), "P2").otherwise("P1")


def contains_any(c: Column, words) -> Column:
    """Whether any of the substrings occurs; null texts contain none."""
    return F.coalesce(reduce(lambda a, b: a | b, [c.contains(w) for w in words]), F.lit(False))


def first_rule(*rules: tuple[Column, object]) -> Column:
    """Value of the first condition that holds; null if none does."""
    out = None
    for when, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(when, v) if out is None else out.when(when, v)
    return out


def described_colour(c: Column) -> Column:
    """Colour of a dictionary description: the first in the fixed order that begins it or follows a blank."""
    low = F.lower(c)
    return first_rule(*[(low.startswith(x.lower()) | low.contains(f" {x.lower()}"), COLOURS[x]) for x in TABLE_COLOUR_ORDER])


def buckets_above(x: Column, bounds: list[float]) -> Column:
    """Number of boundaries strictly below a value: the band or column index of a coordinate."""
    return F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b < x))


def collapse(c: Column) -> Column:
    """White space runs of any kind become one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
