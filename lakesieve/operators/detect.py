"""Catalogue codes and names in free text.

A code stands in a text as a whole run of letters and digits, and a name as a
whole run of words. So instead of testing every code against every text, texts
are split once and joined on equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.functions.text import code_of, norm_name, norm_txt

TRUNCATED = r"\.\.\.|…"


def dictionary(rows: DataFrame, code: str, name: str, seq: str) -> DataFrame:
    """(nombre, ficha, truncado, ord): the last code of a name, in the order of the names' first rows."""
    d = rows.select(code_of(F.col(code)).alias("ficha"), norm_name(F.col(name)).alias("nombre"), F.col(name).rlike(TRUNCATED).alias("t"), F.col(seq).alias("s")).where("ficha <> '' and nombre <> ''")
    return d.groupBy("nombre").agg(F.max_by("ficha", "s").alias("ficha"), F.max("t").alias("truncado"), F.min("s").alias("ord"))


def codes_in(texts: DataFrame, codes: DataFrame, id_col: str, text_col: str, code_col: str) -> DataFrame:
    """(id, ficha) for every code that a text holds."""
    tokens = texts.select(id_col, F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit("[0-9A-Za-z]+"), 0))).alias("ficha"))
    return tokens.join(codes.select(F.col(code_col).alias("ficha")).distinct(), "ficha", "left_semi").select(id_col, "ficha")


def names_in(texts: DataFrame, names: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, nombre, ficha, ord) for every name that a text holds; a truncated name may go on within its last word.

    Each place of a text gives its word and the run of as many words as the longest
    name has; runs and names meet on the first word (its beginning, for a truncated
    name of one word), and the run tells whether the name goes on. The text itself
    is never moved.
    """
    longest = names.agg(F.coalesce(F.max(F.size(F.split("nombre", " "))), F.lit(1)).alias("most"))
    pattern = F.concat(F.lit("(?:^| )(?=((?:[a-z0-9]+(?: |$)){1,"), "most", F.lit("}))"))
    runs = texts.select(id_col, norm_name(F.col(text_col)).alias("t")).crossJoin(F.broadcast(longest))  # one row
    runs = runs.select(id_col, F.explode(F.regexp_extract_all("t", pattern, 1)).alias("run"))
    places = runs.select(id_col, F.concat(F.trim("run"), F.lit(" ")).alias("run"), F.substring_index("run", " ", 1).alias("w"))
    n = names.withColumn("w", F.substring_index("nombre", " ", 1)).withColumn("one", F.col("truncado") & ~F.col("nombre").contains(" "))
    tail = F.when(F.col("truncado"), "").otherwise(" ")
    hits = places.join(n.where("not one"), "w").where(F.col("run").startswith(F.concat("nombre", tail)))
    short = n.where("one").withColumn("l", F.length("nombre")).drop("w")
    cuts = short.agg(F.collect_set("l").alias("cuts"))  # no more than a word has letters
    begun = places.select(id_col, "w").distinct().crossJoin(F.broadcast(cuts)).select(id_col, "w", F.explode("cuts").alias("l")).where(F.length("w") >= F.col("l"))
    hits_short = begun.withColumn("nombre", F.expr("substring(w, 1, l)")).join(short.drop("l"), "nombre")
    cols = [id_col, "nombre", "ficha", "ord"]
    return hits.select(*cols).unionByName(hits_short.select(*cols)).distinct()


def tokens(texts: DataFrame, rows: DataFrame, id_col: str, text_col: str, code: str, name: str, seq: str, none: str = "No Detectada") -> DataFrame:
    """(id, tokens, label): codes in text order of their digits as strings, then '* code' for names whose code isn't there yet."""
    names = dictionary(rows, code, name, seq)
    by_code = codes_in(texts, rows.select(code_of(F.col(code)).alias("c")), id_col, text_col, "c").select(id_col, "ficha", F.lit(0).alias("k"), F.lit(None).cast("long").alias("o"))
    by_name = names_in(texts, names, id_col, text_col).select(id_col, "ficha", F.lit(1).alias("k"), F.col("ord").cast("long").alias("o"))
    best = by_code.unionByName(by_name).groupBy(id_col, "ficha").agg(F.min(F.struct("k", "o")).alias("b"))
    item = F.struct(F.col("b.k").alias("k"), F.col("b.o").alias("o"), "ficha")
    out = best.groupBy(id_col).agg(F.transform(F.sort_array(F.collect_set(item)), lambda x: F.when(x["k"] == 0, x["ficha"]).otherwise(F.concat(F.lit("* "), x["ficha"]))).alias("tokens"))
    out = texts.select(id_col).join(out, id_col, "left")
    return out.select(id_col, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), F.coalesce(F.nullif(F.array_join("tokens", ", "), F.lit("")), F.lit(none)).alias("label"))


def base_codes(tokens_col):
    """Codes of tokens, without stars, each once."""
    return F.array_distinct(F.filter(F.transform(tokens_col, lambda t: F.trim(F.replace(t, F.lit("*"), F.lit("")))), lambda x: x != ""))


def first_word_of(texts: DataFrame, words: DataFrame, id_col: str, text_col: str, word_col: str) -> DataFrame:
    """(id, word): the least listed word that a text holds; of word characters only."""
    w = texts.select(id_col, F.explode(F.array_distinct(F.split(norm_txt(F.col(text_col)), r"[^\w]+"))).alias("word")).where("word <> ''")
    return w.join(words.select(F.col(word_col).alias("word")).distinct(), "word", "left_semi").groupBy(id_col).agg(F.min("word").alias("word"))
