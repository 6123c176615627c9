"""Mixing sources to target weights by Pareto order sampling.

Targets come from the sources' weights by water filling: each source gets its
weight's share of all words, but ``max_repeat`` times its own size at most; what
is over goes to the others by weight. A source whose target is r times its size
takes floor(r) certain copies of every document. The rest is a fixed-size sample
with unequal inclusion probabilities: a document's inclusion odds are p / (1-p) for
p = r - floor(r), times its own weight where a column of weights is given.
Documents are ranked by random odds over inclusion odds,
``(u / (1-u)) / (weight * p / (1-p))``, and taken in that order up to the words
that are still wanted, to the nearest document. ``u`` is a hash of the id and the
seed; rows that share an id stand by their size and a hash of the text, so that
reruns agree. DataFrame operations only.

No source is ever ordered as a whole: the place of the cut is found by counting
words in 256 intervals of the rank, then in 256 intervals of the one that holds
it, three times over; only the rows of the last interval are put in order.

Defined results
---------------
null text            size 0, taken 0
null source          a source of its own, after all others
null id              hashed as the empty text
repeated rows        each is a row of its own; equal ids share a random number
weights              null or not above 0: inclusion odds of 0, taken after all others
empty table          empty result
other columns        ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesieve.llm.common import WORD, cut, named

LEVELS, BITS = 3, 8


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of a hash of seed and id."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sources: DataFrame, max_repeat: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, source_size -> also target.

    The table has a row for each source, so that ordering it in one task is
    bounded by their number and not by the documents.
    """
    place = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    t = sources.withColumn("w", F.element_at(cycle, (F.row_number().over(place) - 1) % len(weights) + 1))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))).withColumn("ratio", F.col("cap") / F.col("w"))
    every = W.partitionBy()
    filled = W.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("left_words", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("level", F.col("left_words") / F.col("left_w"))
    # Sources stand by cap / weight; the first whose share stays under its cap sets the level for itself and all after it.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(every).getField("level")
    return t.withColumn("level", level).select("source", "source_size", F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("level") * F.col("w")).otherwise(F.col("cap")).alias("target"))


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeat: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix-1", keep: tuple[str, ...] = (), weight_col: str | None = None) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken, and the columns of keep.

    weight_col: how many times a document's inclusion odds are those of the others of its source; 1 without it.
    """
    kept = [named(c).alias(f"keep_{c}") for c in keep]
    weight = F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.lit(1.0)
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), uniform(F.col(id_col), seed).alias("u"), weight.alias("weight"), F.xxhash64(F.col(text_col)).alias("tie"), *kept)
    base = cut(base, "mix")
    sources = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), max_repeat, weights)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.withColumn("whole", F.floor(share)).withColumn("p", share - F.col("whole"))
    # start: words of the sample before the interval [lo, lo + 1) / 256^level of the rank in which the cut lies
    sources = cut(sources.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("lo", F.lit(0).cast("long")).withColumn("start", F.lit(0).cast("long")), "sources")
    ranked = _ranked(base, sources)
    for level in range(1, LEVELS + 1):
        unit = BITS * (LEVELS - level)
        inside = ranked.where((F.shiftright("place", unit + BITS) == F.col("lo")) & (F.col("p") > 0))
        bins = inside.groupBy("source", F.shiftright("place", unit).alias("bin")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("start").alias("start"))
        run = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
        bins = bins.withColumn("end", F.col("start") + F.sum("words").over(run))
        hit = bins.where(F.col("end") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bin", F.expr("end - words").alias("start"))).alias("hit"))
        hit = hit.select(F.col("source").alias("_source"), F.col("hit.bin").alias("_lo"), F.col("hit.start").alias("_start"))
        at = sources.join(hit, F.col("source").eqNullSafe(F.col("_source")), "left")
        # without a hit all that is inside is taken: the interval moves past the last
        past = F.lit(1 << (BITS * level)).cast("long")
        sources = cut(at.select("source", "source_size", "target", "whole", "p", "rest", F.coalesce("_lo", past).alias("lo"), F.coalesce("_start", "start").alias("start")), "sources")
        ranked = _ranked(base, sources)
    order = W.partitionBy("source").orderBy("v", "id", "size", "tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = ranked.where((F.col("place") == F.col("lo")) & (F.col("p") > 0)).withColumn("mid", F.col("start") + F.sum("size").over(order) - F.col("size") / 2)
    edge = edge.withColumn("extra", (F.col("mid") <= F.col("rest")).cast("long"))
    sure = ranked.where(~((F.col("place") == F.col("lo")) & (F.col("p") > 0))).withColumn("extra", ((F.col("place") < F.col("lo")) & (F.col("p") > 0)).cast("long"))
    out = sure.unionByName(edge.drop("mid")).withColumn("copies", F.col("whole") + F.col("extra"))
    return out.select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *[named(f"keep_{c}").alias(c) for c in keep])


def _ranked(base: DataFrame, sources: DataFrame) -> DataFrame:
    """base with its source's state, the rank v in (0, 1) and its place among 256^LEVELS."""
    s = sources.withColumnRenamed("source", "_source")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")) * F.col("weight"))
    # odds / (1 + odds) puts the rank between 0 and 1; without a chance it is 1
    v = F.when((F.col("p") > 0) & (F.col("weight") > 0), odds / (1 + odds)).when(F.col("p") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    top = 1 << (BITS * LEVELS)
    place = F.least(F.floor(F.col("v") * F.lit(float(top))), F.lit(top - 1)).cast("long")
    return base.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("v", v).withColumn("place", place)
