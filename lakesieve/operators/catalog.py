"""Records from catalogue lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesieve.functions.money import number, unit_reference
from lakesieve.functions.text import clean, norm_label, unaccent

# Fixed value: the line that opens a product.
PRODUCT = r"(?:^|\s)(\d+)\)\s*Nombre de Producto\s*[:=]\s*(.+)"
TOTAL = r"(?i)total\s+de\s+productos\s*[:=]?\s*(\d+)"


def records(lines: DataFrame, doc: str, order: str, text: str) -> DataFrame:
    """doc, product, nombre, fields: `key: value` lines under the product line above them; the last value of a key wins.

    A document's lines are one window; a product is a session that its line opens.
    """
    opens = F.regexp_extract(F.col(text), PRODUCT, 1)
    w = W.partitionBy(doc).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    s = lines.withColumn("num", opens).withColumn("session", F.sum((F.col("num") != "").cast("int")).over(w)).where("session > 0")
    s = s.withColumn("k", F.trim(F.substring_index(text, ":", 1))).withColumn("v", F.trim(F.expr(f"substring({text}, instr({text}, ':') + 1)")))
    own = s.where("num <> ''").select(doc, "session", F.col("num").cast("int").alias("product"), F.trim(F.regexp_extract(F.col(text), PRODUCT, 2)).alias("nombre"))
    values = s.where((F.col("num") == "") & F.col(text).contains(":")).groupBy(doc, "session", "k").agg(F.max_by("v", order).alias("v"))
    fields = values.groupBy(doc, "session").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("fields"))
    return own.join(fields, [doc, "session"], "left").drop("session")


def declared_total(text):
    return F.regexp_extract(text, TOTAL, 1).try_cast("int")


def cell_key_value(lines, aliases: dict[str, str]):
    """(key, value) of a cell: its first one to three lines, joined, are a known label; the shortest that fits wins."""
    names = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    norm = lambda c: F.trim(F.regexp_replace(F.lower(unaccent(F.lower(c))), r"[.,º\s]+", " "))
    tried = []
    for k in (1, 2, 3):
        key = F.try_element_at(names, norm(F.array_join(F.slice(lines, 1, k), " ")))
        value = F.trim(F.array_join(F.slice(lines, k + 1, F.greatest(F.size(lines) - k, F.lit(0))), " "))
        tried.append(F.when((F.size(lines) >= k) & key.isNotNull(), F.struct(key.alias("key"), value.alias("value"))))
    return F.coalesce(*tried)


def header_of(line, aliases: dict[str, str]):
    """The known label before a colon or an equals sign, or that the whole line is."""
    names = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    at = lambda c: F.try_element_at(names, F.trim(F.lower(unaccent(F.lower(c)))))
    return F.coalesce(at(F.substring_index(line, ":", 1)), at(F.substring_index(line, "=", 1)), at(line))


def completeness(found: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """key, esperados, extraidos, razon: documents whose records are not as many as they declare."""
    n = found.groupBy(key).agg(F.count("*").alias("extraidos"))
    both = declared.join(n, key, "left").select(key, F.col("esperados"), F.coalesce("extraidos", F.lit(0).cast("long")).alias("extraidos"))
    return both.where("esperados <> extraidos").withColumn("razon", F.when(F.col("extraidos") == 0, "vacio").when(F.col("extraidos") < F.col("esperados"), "incompleto").otherwise("sobran"))


def unit_data(rows: DataFrame, codes: DataFrame, key: str, code: str) -> DataFrame:
    """key, unit, ref, qty, um of each page from the rows of its tables (table_rows; row 0 is the header).

    A table counts if a header tells a unit or a reference price. Of its rows the
    first whose description contains the code is read, else the first. Over a page's
    tables each amount is the first positive one, the unit of measure the first that
    isn't blank. A page without such a table has zeros and a blank.
    """
    tables = rows.groupBy(F.col("id").alias(key), "tbl").agg(F.sort_array(F.collect_list(F.struct("row", "cells"))).alias("r")).where(F.size("r") > 1)
    tables = tables.join(codes.select(key, F.col(code).alias("_code")), key).select(key, "tbl", "_code", F.transform(F.get("r", F.lit(0))["cells"], norm_label).alias("h"), F.transform(F.slice("r", 2, F.size("r") - 1), lambda x: x["cells"]).alias("body"))
    first = lambda fits: F.array_position(F.transform("h", fits), True).cast("int") - 1
    tables = tables.withColumns({
        "p": first(lambda h: h.contains("precio unitario")),
        "f": first(lambda h: h.contains("precio") & h.contains("referencia")),
        "q": first(lambda h: h.contains("cantidad")),
        "u": first(lambda h: h.contains("unidad de medida")),
        "d": first(lambda h: h.contains("descripcion") | h.contains("especificaciones del comprador")),
    }).where("p >= 0 or f >= 0")
    told = F.filter("body", lambda c: (F.col("d") >= 0) & (F.col("_code") != "") & F.lower(F.get(c, F.col("d"))).contains(F.lower("_code")))
    row = F.coalesce(F.get(told, F.lit(0)), F.get("body", F.lit(0)))
    cell = lambda i: F.when(F.col(i) >= 0, F.get("c", F.col(i)))
    amount = lambda i: F.when(F.col(i) >= 0, number(cell(i)))
    tables = tables.withColumn("c", row).select(key, "tbl", amount("p").alias("unit"), F.when(F.col("f") >= 0, unit_reference(number(cell("f")), number(cell("q")))).alias("ref"), amount("q").alias("qty"), F.nullif(clean(cell("u")), F.lit("")).alias("um"))
    # the first positive one, or else what the last table that has one says
    pick = lambda v: F.coalesce(F.min_by(v, F.when(F.col(v) > 0, F.struct(F.lit(0).alias("k"), F.col("tbl").alias("t"))).when(F.col(v).isNotNull(), F.struct(F.lit(1).alias("k"), (-F.col("tbl")).alias("t")))), F.lit(0.0)).alias(v)
    found = tables.groupBy(key).agg(pick("unit"), pick("ref"), pick("qty"), F.min_by("um", F.when(F.col("um").isNotNull(), F.col("tbl"))).alias("um"))
    return codes.select(key).join(found, key, "left").select(key, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("unit", "ref", "qty")], F.coalesce("um", F.lit("")).alias("um"))
