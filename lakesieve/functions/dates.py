"""Dates and deadlines in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesieve.functions.bind import bind
from lakesieve.functions.text import clean, norm_label

# What reads as a date and as a time.
DATES = r"\b(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})\b"
TIMES = r"\b(\d{1,2})(?::(\d{2}))?\s*([APap]\.?M\.?)?\b"


def day_first(c: Column) -> Column:
    """d-m-y, else m-d-y, else y-m-d; with / or -; null if none fits."""
    def read(s: Column) -> Column:
        t = s["t"]
        two, four = ([F.try_to_timestamp(t, F.lit(f"{x}-{y}")) for x in ("d-M", "M-d")] for y in ("yy", "yyyy"))
        whole = F.coalesce(*four, F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")))
        return F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{2}$"), F.coalesce(*two)).otherwise(whole)

    return bind(read, t=F.replace(clean(c), F.lit("/"), F.lit("-")))


def deadline(c: Column, of_range: str = "last") -> Column:
    """The instant that a text sets.

    Of two dates or more the last at 23:59, or the first at 0:00; with one date
    the last thing in the text that reads as a time, which for a bare date is its
    own month. That reading is part of the tables' meaning.
    """
    last = of_range == "last"

    def parse(s: Column) -> Column:
        of = lambda k: F.try_element_at(F.regexp_extract_all(s["t"], F.lit(TIMES), k), F.lit(-1))
        half = F.upper(F.replace(of(3), F.lit("."), F.lit("")))
        return bind(lambda x: instant(s, x), found=F.regexp_extract_all(s["t"], F.lit(DATES), 1), h=of(1).cast("int"), m=of(2).try_cast("int"), half=half)

    def instant(s: Column, x: Column) -> Column:
        found, h, half, n = x["found"], x["h"], x["half"], F.size(x["found"])
        hour = F.when((half == "AM") & (h == 12), 0).when((half == "PM") & (h != 12), h % 12 + 12).otherwise(h)
        day = F.when(n == 0, s["t"]).otherwise(F.try_element_at(found, F.when((n >= 2) & F.lit(last), -1).otherwise(1)))
        hours = F.when(n == 0, 0).when(n >= 2, 23 if last else 0).otherwise(F.coalesce(hour, F.lit(23)))
        minutes = F.when(n == 0, 0).when(n >= 2, 59 if last else 0).when(h.isNull(), 59).otherwise(F.coalesce(x["m"], F.lit(0)))
        return day_first(day) + F.make_dt_interval(F.lit(0), hours, minutes)

    return bind(parse, t=F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "–—", "--"), r"(?i)\s+a\s+", " a "))


def date_token(c: Column) -> Column:
    """The latest full date in a text, as it stands there; the last one of equal dates, or of none that is a date."""
    tokens = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b\d{2}[\-/]\d{2}[\-/]\d{4}\b"), 0)
    dated = F.filter(F.transform(tokens, lambda t, i: F.struct(day_first(t).alias("d"), i.alias("i"), t.alias("t"))), lambda s: s["d"].isNotNull())
    return F.when(F.size(tokens) == 0, "").otherwise(F.coalesce(F.array_max(dated)["t"], F.try_element_at(tokens, F.lit(-1))))


def order_date(lines: Column, mark: str = "orden de compra", reach: int = 5) -> Column:
    """The latest full date on a line that holds the mark or on those up to `reach` from there; the first of equal ones, else empty."""
    def near(line: Column, i: Column) -> Column:
        hit = norm_label(line).contains(mark)
        return F.when(hit, F.transform(F.slice(lines, i + 1, reach), date_token)).otherwise(F.array().cast("array<string>"))

    tokens = F.filter(F.flatten(F.transform(lines, near)), lambda t: t != "")
    dated = F.filter(F.transform(tokens, lambda t, i: F.struct(day_first(t).alias("d"), (-i).alias("i"), t.alias("t"))), lambda s: s["d"].isNotNull())
    return F.coalesce(F.array_max(dated)["t"], F.lit(""))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds to the millisecond."""
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000, 3)


def pick_date(lines: Column, labels: list[str]) -> Column:
    """The date on the first line that holds a label and has one, there or on the next line."""
    wanted = [norm_label(F.lit(x)) for x in labels]

    def at(line: Column, i: Column) -> Column:
        n = norm_label(line)
        hit = wanted[0].isNull()
        for w in wanted:
            hit = hit | n.contains(w)
        return F.when(hit, F.coalesce(F.nullif(date_token(line), F.lit("")), date_token(F.coalesce(F.get(lines, i + 1), F.lit("")))))

    found = F.filter(F.transform(lines, at), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def delivery_days(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(norm_label(c), r"(\d{1,3})\s*dias", 1).try_cast("double"), F.lit(0.0))


def days_between(a: Column, b: Column) -> Column:
    return F.coalesce(F.datediff(day_first(b), day_first(a)).cast("double"), F.lit(0.0))


def with_delivery(days: Column, delivery: Column) -> Column:
    return F.when((days > 0) & (delivery > 0), days + delivery).otherwise(F.greatest(days, F.lit(0.0)))
