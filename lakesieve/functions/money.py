"""Money texts as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesieve.functions.text import clean

# Fixed value: what counts as an amount in a text; the order of the alternatives matters.
AMOUNT = r"([0-9]{1,3}(?:[.,][0-9]{3})*[.,][0-9]{2}|[0-9]+(?:[.,][0-9]+)?)"
# Currency marks.
MARKS = ("B/.", "B/", "$", "USD")


def _comma_is_last(c: Column) -> Column:
    return F.instr(F.reverse(c), ",") < F.instr(F.reverse(c), ".")


def price(c: Column) -> Column:
    """The first amount of a text; the last of two kinds of separators is the decimal point. Null if there is none."""
    v = F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), AMOUNT, 1)
    both = v.contains(",") & v.contains(".")
    plain = F.when(both & _comma_is_last(v), F.replace(F.replace(v, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(both, F.replace(v, F.lit(","), F.lit(""))).otherwise(F.replace(v, F.lit(","), F.lit(".")))
    return plain.try_cast("double")


def number(c: Column) -> Column:
    """A cell as a number; signs stay, and what is none is 0."""
    t = clean(c)
    for mark in (*MARKS, " "):
        t = F.replace(t, F.lit(mark), F.lit(""))
    both = t.contains(",") & t.contains(".")
    t = F.when(both & _comma_is_last(t), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(both, F.replace(t, F.lit(","), F.lit(""))).otherwise(F.replace(t, F.lit(","), F.lit(".")))
    return F.coalesce(F.regexp_replace(t, r"[^0-9.\-]", "").try_cast("double"), F.lit(0.0))


def unit_reference(value: Column, quantity: Column) -> Column:
    return F.when((value > 0) & (quantity > 0), value / quantity).otherwise(value)
