"""Wide and long forms, column order, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesieve.functions.text import norm_txt, strip


def wide(df: DataFrame, items: str, prefix: str, width: int, field: str | None = None) -> DataFrame:
    """An array as columns prefix1 .. prefix<width>, blank where it is shorter."""
    def at(i: int) -> Column:
        x = F.get(F.col(items), F.lit(i - 1))
        return F.coalesce((x[field] if field else x).cast("string"), F.lit(""))

    return df.withColumns({f"{prefix}{i}": at(i) for i in range(1, width + 1)})


def width_of(df: DataFrame, items: str) -> int:
    """The longest array: one aggregate, for when the schema must follow the data."""
    return df.agg(F.max(F.size(items))).first()[0] or 0


def align(df: DataFrame, target: list[str], extras: bool = False) -> DataFrame:
    """Columns in target's order, missing ones blank; extra ones behind, if asked. Names match without case."""
    have = {c.strip().lower(): c for c in df.columns}
    cols = [F.coalesce(F.col(f"`{have[t.lower()]}`").cast("string"), F.lit("")).alias(t) if t.lower() in have else F.lit("").alias(t) for t in target]
    if extras:
        known = {t.lower() for t in target}
        cols += [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for k, c in have.items() if k not in known]
    return df.select(*cols)


def header_union(a: list[str], b: list[str]) -> list[str]:
    """The first header's columns, then those that only the second has."""
    low = {x.lower() for x in a}
    return [*a, *[x for x in b if x.lower() not in low]]


def pad(row: Column, width: int) -> Column:
    """A ragged row at a given width."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.get(row, i), F.lit("")))


def canonical_columns(df: DataFrame, rename: dict[str, str]) -> DataFrame:
    """Renamed columns; of several with one name the first value that isn't blank, left to right. Unnamed ones go."""
    groups: dict[str, list[int]] = {}
    for i, c in enumerate(df.columns):
        if not c.lower().startswith("unnamed"):
            groups.setdefault(rename.get(c, c), []).append(i)
    own = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return own.select(*[F.coalesce(*[F.nullif(F.trim(F.col(f"_{i}").cast("string")), F.lit("")) for i in at], F.lit("")).alias(name) for name, at in groups.items()])


def pick_column(columns: list[str], exact: list[str], all_of: list[str] = (), none_of: list[str] = ()) -> str | None:
    """The column with one of the normalised names, else the first that holds all of some words and none of others."""
    import re
    import unicodedata

    def norm(x: str) -> str:
        t = "".join(ch for ch in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(ch))
        return re.sub(r"[^a-z0-9]+", " ", t).strip()

    for want in exact:
        for c in columns:
            if norm(c) == norm(want):
                return c
    for c in columns:
        if all_of and all(norm(w) in norm(c) for w in all_of) and not any(norm(w) in norm(c) for w in none_of):
            return c
    return None


def blank(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit(""))) == ""


def missing_fields(fields: list[str]) -> Column:
    """Names of the blank ones."""
    return F.filter(F.array(*[F.when(blank(F.col(f)), F.lit(f)) for f in fields]), lambda x: x.isNotNull())


# Texts of a pager's cells, without accents.
NAVIGATION = ("...", "…", "?", "anterior", "siguiente", "ultimo", "primero", "pagina")


def is_pager(cells: Column) -> Column:
    """Whether every cell that isn't blank is a pager's, accents and case aside; true for a blank row."""
    some = F.filter(cells, lambda x: ~blank(x))
    return F.forall(some, lambda x: norm_txt(x).isin(*NAVIGATION) | x.rlike(r"^[\d\s.,;:<>?\-…]+$"))


def is_numeric_pager(cells: Column) -> Column:
    """Whether all cells that aren't blank are digits; false for a blank row."""
    some = F.filter(cells, lambda x: ~blank(x))
    return (F.size(some) > 0) & F.forall(some, lambda x: F.regexp_replace(x, r"[.…\s]", "").rlike(r"^\d*$"))


# What a table says when it has no rows.
NO_ROWS = ("no se encontraron", "no matching records")


def is_real_row(cells: Column) -> Column:
    """Whether a row has a cell that isn't blank and none that says there are no rows."""
    nothing = F.exists(cells, lambda x: F.lower(x).contains(NO_ROWS[0]) | F.lower(x).contains(NO_ROWS[1]))
    return F.exists(cells, lambda x: ~blank(x)) & ~F.coalesce(nothing, F.lit(False))


def is_excluded(name: Column, listed: list[str]) -> Column:
    """Whether a name holds one of the listed ones, without case."""
    return F.exists(F.array(*[F.lit(x.upper()) for x in listed]).cast("array<string>"), lambda x: F.upper(name).contains(x))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns by their names in a table; those without one keep theirs."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def canonical_label(label: str, repairs: dict[str, str]) -> str:
    """A column's label: UTF-8 that was read as Latin-1 is repaired, parts are replaced in order, what precedes `::` goes."""
    try:
        label = label.encode("latin-1").decode("utf-8")
    except UnicodeError:
        pass
    for old, new in repairs.items():
        label = label.replace(old, new)
    return label.rpartition("::")[2].strip()


def fill_items(df: DataFrame, items: str, prefix: str = "item_") -> DataFrame:
    """An array's entries in the columns prefix1, prefix2 .. that df has, blank ones where it is shorter; no column is added."""
    own = [c for c in df.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    return df.withColumns({c: F.coalesce(F.get(F.col(items), F.lit(int(c[len(prefix) :]) - 1)).cast("string"), F.lit("")) for c in own})


def by_header(row: Column, header: list[str]) -> Column:
    """A ragged row as a struct of its header's names, blank where it is shorter; what is beyond the header goes."""
    return F.struct(*[F.coalesce(F.get(row, F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(header)])


def has_payload(fields: list[str]) -> Column:
    """Whether any of the fields isn't blank."""
    return F.size(missing_fields(fields)) < len(fields)


def stamp(df: DataFrame, column: str, now: Column) -> DataFrame:
    """The time of a run in every row, first of the columns."""
    return df.select(F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias(column), *[c for c in df.columns if c != column])


def zip_pairs(names: Column, values: Column, left: str, right: str) -> Column:
    """Parallel lists as pairs; a value that is missing is blank, a blank name drops its pair."""
    pairs = F.transform(names, lambda x, i: F.struct(F.trim(x).alias(left), F.coalesce(F.get(values, i), F.lit("")).alias(right)))
    return F.filter(pairs, lambda p: F.coalesce(p[left], F.lit("")) != "")
