"""Derived inputs of the queries, on Spark and as DuckDB CTEs of the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.sources.tables import read_table as table

ACTS_SQL = """acts AS (SELECT o_orderkey AS id,
  'HTTP://Portal.Example/Inicio//#/' || CASE WHEN o_orderkey % 3 = 0 THEN 'pliego-de-cargos' WHEN o_orderkey % 3 = 1 THEN 'solicitud-de-cotizacion' ELSE 'otros' END || '/2025-0-' || CAST(o_orderkey AS VARCHAR) || '-LP/' || 'abcDEF' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS enlace,
  c_name || ' ' || o_orderpriority AS titulo, 'B/. ' || format('{:,.2f}', o_totalprice) AS precio_txt, strftime(o_orderdate, '%d-%m-%Y') AS fecha_txt,
  n_name AS entidad, CASE o_orderstatus WHEN 'F' THEN 'Adjudicado' WHEN 'O' THEN 'Abierto' ELSE 'Desierto' END AS estado, o_totalprice AS precio
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
BIDS_SQL = """bids AS (SELECT l_orderkey AS acto, s_name AS proveedor, l_extendedprice AS total, l_linenumber AS n, l_partkey AS p FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
CATALOG_SQL = """catalog AS (SELECT l_orderkey AS ord, l_linenumber AS n, s_name AS oferente, CAST(p_partkey % 50 AS VARCHAR) AS ficha, p_brand AS marca, p_type AS modelo, n_name AS pais, l_partkey AS p, l_suppkey AS s, l_extendedprice AS x
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
REQUESTS_SQL = """requests AS (SELECT event_id AS id, event_type AS job, CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'enqueued' WHEN 2 THEN 'running' WHEN 3 THEN 'done' ELSE 'error' END AS status,
  CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 50 END AS priority, ts AS requested_at, event_id AS seq FROM events)"""


def acts(spark: SparkSession, d: str) -> DataFrame:
    """Orders as acts. Customers and nations are joined by keys; nations have 25 rows."""
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    k = F.col("o_orderkey")
    marker = F.when(k % 3 == 0, "pliego-de-cargos").when(k % 3 == 1, "solicitud-de-cotizacion").otherwise("otros")
    link = F.concat(F.lit("HTTP://Portal.Example/Inicio//#/"), marker, F.lit("/2025-0-"), k.cast("string"), F.lit("-LP/abcDEF"), F.lpad(k.cast("string"), 8, "0"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("id"), link.alias("enlace"), F.concat("c_name", F.lit(" "), "o_orderpriority").alias("titulo"), F.concat(F.lit("B/. "), F.format_number("o_totalprice", 2)).alias("precio_txt"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("fecha_txt"), F.col("n_name").alias("entidad"), F.when(F.col("o_orderstatus") == "F", "Adjudicado").when(F.col("o_orderstatus") == "O", "Abierto").otherwise("Desierto").alias("estado"), F.col("o_totalprice").alias("precio"),
    )


def bids(spark: SparkSession, d: str) -> DataFrame:
    li, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    return li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("acto"), F.col("s_name").alias("proveedor"), F.col("l_extendedprice").alias("total"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"))


def catalog(spark: SparkSession, d: str) -> DataFrame:
    li, p, s, n = (table(spark, d, t) for t in ("lineitem", "part", "supplier", "nation"))
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("n"), F.col("s_name").alias("oferente"), (F.col("p_partkey") % 50).cast("string").alias("ficha"), F.col("p_brand").alias("marca"), F.col("p_type").alias("modelo"), F.col("n_name").alias("pais"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("x"))


def requests(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    i = F.col("event_id")
    status = F.element_at(F.array(*[F.lit(x) for x in ("pending", "enqueued", "running", "done", "error")]), (i % 5 + 1).cast("int"))
    priority = F.element_at(F.array(*[F.lit(x) for x in (0, 5, 10, 50)]), (i % 4 + 1).cast("int"))
    return e.select(i.alias("id"), F.col("event_type").alias("job"), status.alias("status"), priority.alias("priority"), F.col("ts").alias("requested_at"), i.alias("seq"))
