"""Anti joins, moves, lookups in steps, and row enrichment."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lakesieve.functions.nearest import likest
from lakesieve.functions.text import clean, ficha_digits, norm_label
from lakesieve.operators.dedup import first_by
from lakesieve.session import ship
from lakesieve.sources.tables import settled


def not_known(df: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows none of whose keys is known.

    One anti join a key: a single condition with OR would compare every pair. A
    null or empty key is known nowhere.
    """
    for k in keys:
        own = known.where(F.col(k).isNotNull() & (F.col(k) != "")).select(F.col(k).alias("_k")).distinct()
        df = df.join(own, F.col(k) == F.col("_k"), "left_anti")
    return df


def checked(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)) == "TRUE", F.lit(False))


def move(sources: list[DataFrame], target: DataFrame, flag: str, key: str, order: str) -> tuple[DataFrame, list[DataFrame]]:
    """(rows to append to target, what stays of each source).

    Of checked rows the first of each key goes, in the order of the sources, unless
    target has it; all checked rows leave their source.
    """
    marked = [s.where(checked(F.col(flag))).withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    one = first_by(both, F.col(key), [F.col("_src"), F.col(order)], blank_is_unique=True)
    return not_known(one, target, key).drop("_src"), [s.where(~checked(F.col(flag))) for s in sources]


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """old with new's columns set where new has the key, and new's other keys added.

    Columns that only old has keep their values; those that only new has are null
    where new has no row. Of new rows of one key the last by `order` counts (by all
    columns, where no order is given). order: columns of new that the result need
    not have. A null key is one key.
    """
    own = [c for c in new.columns if c != key]
    last = F.struct(*[F.col(f"`{c}`") for c in (order or own)])
    one = new.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in own]), last).alias("_new"), F.lit(True).alias("_set"))
    set_, known = F.coalesce(F.col("_set"), F.lit(False)), F.lit(True).alias("_known")
    both = old.select(F.col(f"`{key}`").alias("_old_key"), F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("_old"), known).join(one, F.expr("_old_key <=> _key"), "full_outer")
    ours, theirs = F.col("_old"), F.col("_new")
    cols = [F.when(F.col("_known"), F.col("_old_key")).otherwise(F.col("_key")).alias(key)]
    cols += [(F.when(set_, theirs[c]).otherwise(ours[c]) if c in own else ours[c]).alias(c) for c in old.columns if c != key]
    return both.select(*cols, *[theirs[c].alias(c) for c in own if c not in old.columns and c not in (order or [])])


def append_new(old: DataFrame, new: DataFrame, order: str, *keys: str) -> DataFrame:
    """Rows of new none of whose keys stands in old or in an earlier row of new that was itself appended.

    Rows of the batch that share keys form chains; each chain goes to one group, in
    which the rows are taken in order. A null or blank key is shared with nobody.
    """
    fresh = settled(not_known(new, old, *keys).withColumn("_row", F.monotonically_increasing_id()))
    name = lambda k: F.when(F.trim(F.col(k)) != "", F.concat(F.lit(f"{k}="), F.col(k)))
    held = fresh.select("_row", F.col(order).alias("_o"), *[name(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    # the first row of each first key alone decides, unless a later key ties rows together
    out = held
    for i in range(len(keys)):
        w = W.partitionBy(f"_k{i}").orderBy("_o", "_row")
        out = out.withColumn(f"_f{i}", F.when(F.col(f"_k{i}").isNotNull(), F.first("_row").over(w)).otherwise(F.col("_row")))
    first = [F.col(f"_f{i}") == F.col("_row") for i in range(len(keys))]
    sure = settled(out.withColumn("_sure", reduce(lambda a, b: a & b, first)))
    # A row that is the first of all its keys is taken; rows that share a key with a taken one are not.
    # What remains waits for rows that themselves are not taken: it is asked again without those.
    taken, rest = sure.where("_sure").select("_row", *[f"_k{i}" for i in range(len(keys))]), sure.where("not _sure")
    done = taken.select("_row")
    while True:
        for i in range(len(keys)):
            rest = rest.join(taken.select(F.col(f"_k{i}").alias("_t")).where("_t is not null").distinct(), F.col(f"_k{i}") == F.col("_t"), "left_anti")
        rest = settled(rest.select("_row", "_o", *[f"_k{i}" for i in range(len(keys))]))
        if rest.isEmpty():
            return fresh.join(settled(done), "_row", "left_semi").drop("_row")
        for i in range(len(keys)):
            w = W.partitionBy(f"_k{i}").orderBy("_o", "_row")
            rest = rest.withColumn(f"_f{i}", F.when(F.col(f"_k{i}").isNotNull(), F.first("_row").over(w)).otherwise(F.col("_row")))
        rest = settled(rest.withColumn("_sure", reduce(lambda a, b: a & b, first)))
        taken, rest = rest.where("_sure").select("_row", *[f"_k{i}" for i in range(len(keys))]), rest.where("not _sure")
        done = settled(done.unionByName(taken.select("_row")))


def with_detail(df: DataFrame, detail: DataFrame, link: str, order: str) -> DataFrame:
    """Each row with its link's detail, the first one by order, looked up once a link; a blank link has none."""
    one = first_by(detail.where(F.trim(F.col(link)) != ""), F.col(link), [F.col(order)]).drop(order)
    return df.join(one, link, "left")


def all_links(tables: list[DataFrame], link: str) -> DataFrame:
    """(link): what any of the tables holds, each once, blank ones left out."""
    cols = [t.select(F.trim(F.col(link)).alias(link)) for t in tables]
    return reduce(lambda a, b: a.unionByName(b), cols).where(F.col(link) != "").distinct()


def job_of(requests: DataFrame, jobs: DataFrame, later: DataFrame | None = None) -> DataFrame:
    """Requests with their job's fields, from `later` (jobs read anew) where `jobs` lacks it; estado 'error' where both do."""
    known = jobs.select("name", F.struct(*jobs.columns).alias("_j"), F.lit(0).alias("_at"))
    if later is not None:
        known = known.unionByName(later.select("name", F.struct(*jobs.columns).alias("_j"), F.lit(1).alias("_at")))
    known = known.groupBy("name").agg(F.min_by("_j", "_at").alias("_j"))
    out = requests.join(known, requests["job"] == known["name"], "left")
    return out.select(*requests.columns, *[F.col(f"_j.{c}").alias(c) for c in jobs.columns if c != "name"], F.when(F.col("_j").isNull(), "error").otherwise("ok").alias("estado"))


def update_rows(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Single cells set by key: a change's fields that aren't null replace the row's; changes of unknown keys do nothing.

    changes has one row a key.
    """
    own = [c for c in changes.columns if c != key]
    got = df.join(changes.select(key, *[F.col(c).alias(f"_c_{c}") for c in own]), key, "left")
    return got.select(*[F.coalesce(f"_c_{c}", c).alias(c) if c in own else F.col(c) for c in df.columns])


def replace_partition(old: DataFrame, new: DataFrame, key: str, value) -> DataFrame:
    """Rows of other keys, and the new ones."""
    return old.where(~F.col(key).eqNullSafe(F.lit(value))).unionByName(new, allowMissingColumns=True)


def fill_blanks(df: DataFrame, by_key: dict[str, Column], by_place: dict[str, Column], found: Column) -> DataFrame:
    """Blank fields from the row that the key finds, or else from the one in the same place."""
    return df.withColumns({c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.when(found, by_key[c]).otherwise(by_place[c])) for c in by_key})


def best_per_key(df: DataFrame, keys: list[str], score: Column, seq: Column, fields: list[str]) -> DataFrame:
    """For each key the record with the highest score, the first of equals."""
    best = F.min_by(F.struct(*fields), F.struct((-score).alias("s"), seq.alias("o")))
    return df.groupBy(*keys).agg(best.alias("rec")).select(*keys, "rec.*")


def cascade(df: DataFrame, steps: list[tuple[DataFrame, list[tuple[str, str]]]], fields: list[str]) -> DataFrame:
    """Left lookups in turn: each field from the first step that knows the row; step, its number (0: none).

    steps: (lookup, [(column of df, column of lookup)]); a lookup has one row a key.
    """
    out = df
    for i, (lookup, on) in enumerate(steps, 1):
        renamed = lookup.select(*[F.col(b).alias(f"_k{i}_{b}") for _, b in on], *[F.col(f).alias(f"_f{i}_{f}") for f in fields], F.lit(True).alias(f"_hit{i}"))
        out = out.join(renamed, reduce(lambda a, b: a & b, [F.col(a) == F.col(f"_k{i}_{b}") for a, b in on]), "left")
    n = range(1, len(steps) + 1)
    step = F.coalesce(*[F.when(F.col(f"_hit{i}"), F.lit(i)) for i in n], F.lit(0))
    cols = {f: F.coalesce(*[F.when(F.col(f"_hit{i}"), F.col(f"_f{i}_{f}")) for i in n], F.lit("")) for f in fields}
    return out.select(*df.columns, step.alias("step"), *[c.alias(f) for f, c in cols.items()])


# Known names that a task holds as a tree; the least and the most names that it looks up in one.
KNOWN, FEW, LOTS = 30_000, 250, 20_000


def fuzzy_lookup(names: DataFrame, known: DataFrame, left: str, right: str, least: float, stop: tuple[str, ...] = (), by: tuple[str, ...] = (), seq: str | None = None) -> DataFrame:
    """For each name the known one with the highest score of `least` or more, the first in order (of seq, then by name) of equals.

    by: columns of both sides that must be equal. Names are normalised ones. The
    known names are dealt over parts that a task holds, and so are the names that
    ask; each part gives the best that it has (lakesieve.functions.nearest).
    """
    ship(names.sparkSession)
    given = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in by], F.col("_t") != "")
    x = settled(names.select(*by, F.col(left).alias("_t")).where(given).distinct())
    own = known.select(*by, F.col(right).alias("_t"), (F.col(seq) if seq else F.lit(0)).alias("_o")).where(given).groupBy(*by, "_t").agg(F.min("_o").alias("_o"))
    # numbers that ascend in this order, without one task that sees all rows
    y = settled(own.orderBy("_o", "_t").select(*by, "_t", F.monotonically_increasing_id().alias("_r")))
    n, m = x.groupBy(*by).agg(F.count("*").alias("_n")), y.groupBy(*by).agg(F.count("*").alias("_m"))
    sizes = n.join(m, list(by)) if by else n.crossJoin(m)
    lot = F.greatest(F.lit(FEW), F.least(F.lit(LOTS), F.col("_n") / 48))
    units = settled(sizes.select(*by, F.monotonically_increasing_id().alias("_g"), F.ceil(F.col("_n") / lot).alias("_lots"), F.ceil(F.col("_m") / KNOWN).alias("_parts")))
    with_units = lambda d: d.join(units, list(by)) if by else d.crossJoin(units)
    deal = lambda c: F.pmod(F.xxhash64("_t"), F.col(c)).alias(c[:-1])
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).alias(c[:-1])
    unit = ["_g", "_lot", "_part"]
    spark = names.sparkSession
    tasks = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    asks = with_units(x).select(F.col("_g").alias("_g"), deal("_lots"), each("_parts"), *by, "_t").repartition(tasks, *unit)
    told = with_units(y).select(F.col("_g").alias("_g"), each("_lots"), deal("_parts"), "_t", "_r").repartition(tasks, *unit)
    schema = T.StructType([*x.schema.fields, T.StructField("_b", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_r", T.LongType())])
    best = asks.groupBy(*unit).cogroup(told.groupBy(*unit)).applyInArrow(_likest(least, stop, x.columns), schema)
    best = best.groupBy(*by, "_t").agg(F.min_by(F.struct("_b", "_score"), F.struct((-F.col("_score")).alias("s"), F.col("_r"))).alias("_m"))
    return best.select(*by, F.col("_t").alias(left), F.col("_m._b").alias(right), F.col("_m._score").alias("score"))


def _likest(least: float, stop: tuple[str, ...], columns: list[str]) -> Callable:
    """A unit's names with the likest of its known ones."""

    def look(asks: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("_r")
        at, found, scores = likest(asks["_t"].to_pylist(), told["_t"].to_pylist(), least, stop)
        out, hit = asks.select(columns).take(pa.array(at, pa.int64())), told.take(pa.array(found, pa.int64()))
        return out.append_column("_b", hit["_t"]).append_column("_score", pa.array(scores, pa.float64())).append_column("_r", hit["_r"])

    return look


# Fixed value: words of names that tell nothing.
STOP = ("s", "a", "sa", "de", "del", "la", "y")


def catalog_lookup(df: DataFrame, known: DataFrame, code: str, name: str, aliases: str, known_code: str, known_name: str, seq: str, fields: list[str]) -> DataFrame:
    """df with step, via and fields from the catalogue `known`, whose rows are in the order of seq.

    Steps for a name: 1 code and name; 2 the name without a code; 3 the likest name
    of the code, score 0.5 or more; 4 the name under any code; 5 the likest of all
    names, 0.75 or more; 0 none. A key stands for its record with the most fields
    that aren't blank. Where all fields that a name finds are blank, the aliases
    (an array) are looked up in turn, till one finds a field: via is that alias.
    """
    rec = known.select(ficha_digits(F.col(known_code)).alias("_c"), norm_label(F.col(known_name)).alias("_n"), F.col(seq).alias("_s"), *[clean(F.col(f)).alias(f) for f in fields]).where("_n <> ''")
    filled = reduce(lambda a, b: a + b, [(F.col(f) != "").cast("int") for f in fields])
    both, every = settled(best_per_key(rec, ["_c", "_n"], filled, F.col("_s"), fields)), settled(best_per_key(rec, ["_n"], filled, F.col("_s"), fields))
    names = settled(rec.groupBy("_c", "_n").agg(F.min("_s").alias("_s")))
    # who asks for the same is answered once
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = df.withColumn("_c", F.regexp_replace(blank(F.col(code)), r"\D", "")).withColumn("_t", blank(F.col(name))).withColumn("_al", F.coalesce(F.transform(F.col(aliases), blank), F.array().cast("array<string>")))
    same = ["_c", "_t", "_al"]
    tries = rows.select(*same).distinct().select(*same, F.posexplode(F.concat(F.array("_t"), "_al")).alias("_i", "_text"))
    tries = tries.withColumn("_p", norm_label(F.col("_text")))
    asked = settled(tries.select("_c", "_p").where("_p <> ''").distinct())
    left = settled(asked.join(both.select("_c", F.col("_n").alias("_p")), ["_c", "_p"], "left_anti").join(both.where("_c = ''").select(F.col("_n").alias("_p")), "_p", "left_anti"))
    near = fuzzy_lookup(left.where("_c <> ''"), names.where("_c <> ''"), "_p", "_n", 0.5, STOP, ("_c",), "_s")
    near = settled(near.join(both, ["_c", "_n"]).select("_c", "_p", *fields))
    far = left.join(near, ["_c", "_p"], "left_anti").join(every.select(F.col("_n").alias("_p")), "_p", "left_anti")
    far = settled(fuzzy_lookup(far, names, "_p", "_n", 0.75, STOP, (), "_s").join(every, "_n").select("_p", *fields))
    one = [("_p", "_n")]
    got = cascade(asked, [(both, [("_c", "_c"), *one]), (both.where("_c = ''"), one), (near, [("_c", "_c"), ("_p", "_p")]), (every, one), (far, [("_p", "_p")])], fields)
    told = reduce(lambda a, b: a | b, [F.col(f) != "" for f in fields])
    found = tries.join(got, ["_c", "_p"]).where((F.col("_i") == 0) | told).groupBy(*same).agg(F.min_by(F.struct("step", "_i", "_text", *fields), F.struct((~told).alias("b"), F.col("_i"))).alias("_m"))
    via = F.when(F.col("_m._i") > 0, F.trim("_m._text"))
    return rows.join(found, same, "left").select(*df.columns, F.coalesce("_m.step", F.lit(0)).alias("step"), F.coalesce(via, F.lit("")).alias("via"), *[F.coalesce(f"_m.{f}", F.lit("")).alias(f) for f in fields])
