"""First-wins deduplication, duplicate logs, union with what was there before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_by(df: DataFrame, key: Column, order: list[Column], blank_is_unique: bool = False) -> DataFrame:
    """The first row of each key; rows with a blank key all stay if asked.

    row_number() = 1 gets a group limit below the exchange, so that a hot key's
    rows are cut down before they move.
    """
    ranked = df.withColumn("_k", key)
    blank = F.coalesce(F.col("_k").cast("string"), F.lit("")) == ""
    w = W.partitionBy("_k").orderBy(*order)
    if not blank_is_unique:
        return ranked.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_k", "_r")
    kept = ranked.where(~blank).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return kept.unionByName(ranked.where(blank)).drop("_k")


def composite_key(*parts: Column) -> Column:
    """Trimmed parts with bars between; blank if all are."""
    return F.regexp_replace(F.concat_ws("|", *[F.trim(F.coalesce(p.cast("string"), F.lit(""))) for p in parts]), r"^\|+|\|+$", "")


def duplicate_log(df: DataFrame, key: Column, order: list[Column], row: Column) -> DataFrame:
    """Each repeated row with the first one: row and original, as JSON texts."""
    w = W.partitionBy("_k").orderBy(*order)
    ranked = df.withColumn("_k", key).withColumn("row", row)
    ranked = ranked.withColumn("rn", F.row_number().over(w)).withColumn("original", F.first("row").over(w))
    return ranked.where("rn > 1").select("rn", F.to_json("original").alias("datos_original"), F.to_json("row").alias("datos_duplicado"))


def existing_wins(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Both, deduplicated by key; rows that were there go first."""
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return first_by(both, F.col(key), [F.col("_src"), F.col(order)], blank_is_unique=True).drop("_src")


def suspicious_groups(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Groups of trimmed keys with `least` rows or more (two at the very least)."""
    trimmed = [F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(k) for k in keys]
    return df.select(*trimmed).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= max(2, least))
