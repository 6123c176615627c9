"""Discarding, classifying, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesieve.operators.reshape import blank


def discard_reason(price: Column, word: Column, codes: Column, rs: Column, sr: Column, least: float = 1000.0) -> Column:
    """Why an act is discarded: a price under the least, a listed word, a code of RS and none of SR; empty if it isn't."""
    return F.when(F.coalesce(price < least, F.lit(False)), "precio").when(F.coalesce(word, F.lit("")) != "", F.concat(F.lit("med:"), word)).when(F.arrays_overlap(codes, rs) & ~F.arrays_overlap(codes, sr), "RS").otherwise("")


def classify(sr: Column, rs: Column, ct: Column) -> Column:
    return F.when(sr, "sr").when(rs, "rs").when(ct, "ct").otherwise("sf")


def destination(kind: Column) -> Column:
    """One of three tables."""
    return F.when(kind == "ct", "ct").when(kind == "sr", "sr").otherwise("sf")


def evidence(unit: Column, provider: Column, deserted: Column, direct: Column) -> tuple[Column, Column]:
    """(review flag, certainty) of a study's row."""
    review = ((unit <= 0) | (F.trim(F.coalesce(provider, F.lit(""))) == "")).cast("int")
    sure = F.when(deserted, F.when(unit > 0, 0.45).otherwise(0.99)).when(review == 1, 0.45).when(direct, 0.99).otherwise(0.95)
    return review, sure


def is_winner(provider: Column, winner: Column) -> Column:
    return F.when((provider != "") & (winner != "") & (provider == winner), 1).otherwise(0)


def page_type(lines: Column) -> Column:
    """1 where a page names its provider block, else 2."""
    return F.when(F.exists(lines, lambda x: F.lower(x).contains("informacion del proponente")), 1).otherwise(2)


def award_dates(link: Column, bidders: Column, date: Column, award: Column) -> tuple[Column, Column]:
    """(date, award date): without a link to the bids the date is the award's; then, without bidders, a blank award date is the date."""
    day = F.when(blank(link), award).otherwise(date)
    return day, F.when((F.coalesce(F.size(bidders), F.lit(0)) <= 0) & blank(award) & ~blank(day), day).otherwise(award)


def failed_fetches(acts: DataFrame, link: str, page: str, mark: str = "skip_timeout_xpath") -> DataFrame:
    """(link, fecha): the discards of links whose page could not be fetched."""
    return acts.where(F.col(page).isNull()).select(link, F.lit(mark).alias("fecha")).distinct()


def whitelist(rows: DataFrame, column: str) -> DataFrame:
    """(ficha): the codes of a list, digits without leading zeros, each once; zeros alone are 0."""
    digits = F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit("")), r"\D+", "")
    return rows.select(F.regexp_replace(digits, "^0+(?=.)", "").alias("ficha")).where("ficha <> ''").distinct()


def legacy_dictionary(rows: DataFrame, code: str, name: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(codes, names): codes of 1 to 6 characters as they are; the last code of each lower-case name."""
    own = rows.select(F.trim(F.col(code).cast("string")).alias("ficha"), F.lower(F.trim(F.col(name))).alias("nombre"), F.col(seq).alias("s"))
    own = own.where("ficha <> '' and length(ficha) <= 6")
    return own.select("ficha").distinct(), own.where("nombre <> ''").groupBy("nombre").agg(F.max_by("ficha", "s").alias("ficha"))


def run_row(detail: DataFrame, run: Column, started: Column, finished: Column) -> DataFrame:
    """A run's totals by its detail rows (link, estado): acts, distinct links, failed ones, start, end, status."""
    totals = detail.groupBy(run.alias("run")).agg(F.count("*").alias("total"), F.countDistinct("link").alias("unicos"), F.count_if(F.col("estado") == "error").alias("errores"), F.min(started).alias("inicio"), F.max(finished).alias("fin"))
    return totals.withColumn("estado", F.when(F.col("errores") == 0, "ok").when(F.col("errores") < F.col("total"), "parcial").otherwise("error"))
