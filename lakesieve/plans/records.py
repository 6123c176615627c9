"""Queries over appends, configurations, run records, cells and the study's evidence."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakesieve.functions import dates, html, text
from lakesieve.operators import joins, reshape, rules
from lakesieve.plans.views import ACTS_SQL, BIDS_SQL, REQUESTS_SQL, acts, bids, requests
from lakesieve.sources import tables
from lakesieve.sources.tables import read_table as table
from lakesieve.streaming import requests as rq

Q, SQL = {}, {}


def append_chunks(s, d):
    """Acts in two batches of chunks of 150; what holds a closed tender is rejected as a chunk and goes to the dead letters (SK1, SK2)."""
    at = f"{tables.work_dir(s)}/append-{uuid.uuid4().hex}"
    a = tables.settled(acts(s, d).select("id", "titulo", "precio"))
    first = tables.append_chunks(a.where("id % 2 = 0"), f"{at}/t", "id")
    second = tables.append_chunks(a.where("id % 2 = 1"), f"{at}/t", "id", accepts=F.lit(False), letters=f"{at}/l", sheet="actos")
    counts = first.unionByName(second).agg(F.sum("ok").alias("ok"), F.sum("failed").alias("fallidas"))
    back, _ = tables.replay(tables.read_dead_letters(s, f"{at}/l"))
    rows = s.read.parquet(f"{at}/t").agg(F.count("*").alias("filas"), F.sum("id").alias("ids"))
    letters = back.agg(F.count("*").alias("cartas"), F.sum(F.col("row")[0].cast("long")).alias("ids_cartas"))
    return counts.crossJoin(rows).crossJoin(letters)


Q["q_append_chunks"] = append_chunks
SQL["q_append_chunks"] = """SELECT CAST(count(*) FILTER (o_orderkey % 2 = 0) AS BIGINT) AS ok, CAST(count(*) FILTER (o_orderkey % 2 = 1) AS BIGINT) AS fallidas,
CAST(count(*) FILTER (o_orderkey % 2 = 0) AS BIGINT) AS filas, CAST(sum(o_orderkey) FILTER (o_orderkey % 2 = 0) AS BIGINT) AS ids,
CAST(count(*) FILTER (o_orderkey % 2 = 1) AS BIGINT) AS cartas, CAST(sum(o_orderkey) FILTER (o_orderkey % 2 = 1) AS BIGINT) AS ids_cartas FROM orders"""


def append_new(s, d):
    """Customers' acts whose customer or price stands in an earlier row, known or of the same batch, are not appended."""
    o = table(s, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("k1"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("k2"))
    return joins.append_new(o.where("o_orderkey % 10 = 0"), o.where("o_orderkey % 10 <> 0"), "o_orderkey", "k1").select("o_orderkey")


Q["q_append_new"] = append_new
SQL["q_append_new"] = """SELECT min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderkey % 10 <> 0
AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0) GROUP BY o_custkey"""


def state_json(s, d):
    """Each job's last run, saved as JSON in the jobs' order and read back; the default serves where there is no file (SK16, SC20, SK10)."""
    at = f"{tables.work_dir(s)}/state-{uuid.uuid4().hex}"
    e = requests(s, d)
    last = rq.latest(e, "job", ["requested_at", "seq"], ["status", "id"]).select(F.col("job").alias("job_name"), F.col("status"), F.col("id"))
    tables.save_state(last, f"{at}/state.json")
    schema = "job_name string, status string, id long"
    got = tables.read_config(s, schema, None, f"{at}/state.json", [])
    default = tables.read_config(s, schema, None, f"{at}/none.json", [("ninguno", "x", 0)])
    tables.write_sorted(got.unionByName(default), f"{at}/sorted", "job_name")
    return s.read.parquet(f"{at}/sorted")


Q["q_state_json"] = state_json
SQL["q_state_json"] = f"""WITH {REQUESTS_SQL} SELECT job AS job_name, arg_max(status, (requested_at, seq)) AS status, arg_max(id, (requested_at, seq)) AS id FROM requests GROUP BY 1
UNION ALL SELECT 'ninguno', 'x', 0"""


def point_update(s, d):
    """Status and note of single requests, set by id (SK12); notes are cut at 240 characters."""
    e = requests(s, d).select("id", "status", F.lit(None).cast("string").alias("notes"))
    changes = e.where("id % 7 = 0").select("id", F.when(F.col("id") % 2 == 0, "done").alias("status"), F.substring(F.repeat(F.lit("nota "), 60), 1, 240).alias("notes"))
    return joins.update_rows(e, changes, "id")


Q["q_point_update"] = point_update
SQL["q_point_update"] = f"""WITH {REQUESTS_SQL} SELECT id, CASE WHEN id % 14 = 0 THEN 'done' ELSE status END AS status, CASE WHEN id % 7 = 0 THEN left(repeat('nota ', 60), 240) END AS notes FROM requests"""


def renamed(s, d):
    """Columns by their names in the table, labels repaired and mapped, items filled into the columns that are there."""
    p = table(s, d, "part").select("p_partkey", F.col("p_name").alias("PaÃ­s::Nombre GenÃ©rico"), "p_brand", "p_type", F.lit("a").alias("item_1"), F.lit("b").alias("item_2"))
    label = {c: reshape.canonical_label(c, {"Genérico": "generico"}) for c in p.columns}
    out = reshape.renamed(p.drop("p_size", "nada"), label | {"p_brand": "marca"})
    return reshape.fill_items(out.withColumn("l", F.array("p_type", "marca", "p_type")), "l").drop("l", "p_type")


Q["q_rename_columns"] = renamed
SQL["q_rename_columns"] = 'SELECT p_partkey, p_name AS "Nombre generico", p_brand AS marca, p_type AS item_1, p_brand AS item_2 FROM part'


def active_jobs(s, d):
    """Configured jobs that can run, read from ragged rows by a header (F7, P20), and each request's job."""
    n = table(s, d, "nation")
    k = F.col("n_nationkey")
    row = F.when(k % 5 == 0, F.array("n_name", F.lit(" 'py' "), F.lit("a.py"), F.lit("lunes, jue"), F.lit("8:30")))
    row = row.when(k % 5 == 1, F.array("n_name", F.lit("py"), F.lit("b.py"), F.lit(""), F.lit(""), F.lit(" No ")))
    row = row.when(k % 5 == 2, F.array("n_name", F.lit("py"), F.lit("c.py"))).when(k % 5 == 3, F.array("n_name", F.lit("py"), F.lit("d.py"), F.lit("lunes")))
    row = row.otherwise(F.array("n_name", F.lit(""), F.lit("e.py"), F.lit("martes"), F.lit("9:00")))
    rows = n.select(reshape.by_header(row, ["name", "python", "script", "days", "times", "enabled"]).alias("r")).select("r.*")
    jobs = rq.active_jobs(rows).select("name", "python", "script", F.array_join("times", ",").alias("times"))
    asked = n.select("n_nationkey", F.col("n_name").alias("job"))
    return joins.job_of(asked, jobs.where("script = 'a.py'"), jobs)


Q["q_active_jobs"] = active_jobs
SQL["q_active_jobs"] = """SELECT n_nationkey, n_name AS job, CASE WHEN n_nationkey % 5 IN (0, 2) THEN 'py' END AS python,
CASE n_nationkey % 5 WHEN 0 THEN 'a.py' WHEN 2 THEN 'c.py' END AS script, CASE n_nationkey % 5 WHEN 0 THEN '08:30' WHEN 2 THEN '' END AS times,
CASE WHEN n_nationkey % 5 IN (0, 2) THEN 'ok' ELSE 'error' END AS estado FROM nation"""


def whitelist(s, d):
    """Codes of a list as digits without leading zeros (F20), and as the old dictionary takes them (SC5)."""
    p = table(s, d, "part").withColumn("c", F.concat(F.lit("F-00"), F.col("p_partkey") % 300)).withColumn("n", F.concat(F.lit(" "), F.upper("p_name")))
    codes, names = rules.legacy_dictionary(p, "c", "n", "p_partkey")
    return rules.whitelist(p, "c").select(F.lit("ct_rir").alias("lista"), "ficha").unionByName(codes.select(F.lit("antigua").alias("lista"), "ficha")).unionByName(names.select("nombre", "ficha").toDF("lista", "ficha"))


Q["q_whitelist"] = whitelist
SQL["q_whitelist"] = """WITH c AS (SELECT p_partkey, p_partkey % 300 AS k, 'F-00' || (p_partkey % 300) AS c, lower(p_name) AS n FROM part)
SELECT DISTINCT 'ct_rir' AS lista, CAST(k AS VARCHAR) AS ficha FROM c UNION ALL SELECT DISTINCT 'antigua', c FROM c WHERE k < 100
UNION ALL SELECT n, arg_max(c, p_partkey) FROM c WHERE k < 100 GROUP BY n"""


def links_total(s, d):
    """What links three tables hold, blank ones left out, each once (U4, F21), and how many rows name them."""
    li = table(s, d, "lineitem")
    a, b = li.select(F.concat(F.lit(" s"), "l_suppkey").alias("enlace")), li.select(F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("p"), "l_partkey")).otherwise(" ").alias("enlace"))
    c = table(s, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("enlace"))
    unique = joins.all_links([a, b, c], "enlace").agg(F.count("*").alias("unicos"))
    return unique.crossJoin(a.unionByName(b).unionByName(c).where("trim(enlace) <> ''").agg(F.count("*").alias("total")))


Q["q_links_total"] = links_total
SQL["q_links_total"] = """WITH l AS (SELECT 's' || l_suppkey AS e FROM lineitem UNION ALL SELECT 'p' || l_partkey FROM lineitem WHERE l_partkey % 2 = 0 UNION ALL SELECT 's' || s_suppkey FROM supplier)
SELECT CAST(count(DISTINCT e) AS BIGINT) AS unicos, CAST(count(*) AS BIGINT) AS total FROM l"""


def detail_join(s, d):
    """Each line with its part's first detail, looked up once a link (J15); rows without any payload go."""
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", F.when(F.col("l_partkey") % 9 == 0, " ").otherwise(F.concat(F.lit("p"), "l_partkey")).alias("link"))
    both = table(s, d, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("link"), "p_brand", F.col("p_partkey").alias("o"))
    more = both.select("link", F.lit("otra").alias("p_brand"), (F.col("o") + 1_000_000).alias("o"))
    got = joins.with_detail(li, both.unionByName(more), "link", "o")
    return got.where(reshape.has_payload(["link", "p_brand"])).select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "link", "p_brand")


Q["q_detail_join"] = detail_join
SQL["q_detail_join"] = """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, 'p' || l_partkey AS link, CASE WHEN l_partkey % 2 = 0 THEN p_brand END AS p_brand
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_partkey % 9 <> 0"""


def order_dates(s, d):
    """The latest date near a line that names the purchase order."""
    a = acts(s, d)
    day = lambda n: F.date_format(F.date_add(F.to_date("fecha_txt", "dd-MM-yyyy"), n), "dd-MM-yyyy")
    lines = F.array(day(90), F.concat(F.lit("ORDEN  de Compra No. "), F.col("id").cast("string")), F.concat(F.lit("del "), "fecha_txt"), day(3), F.lit("x"), F.lit("45-45-2024"), day(60), F.lit("Fin"))
    none = F.array(F.lit("orden de pago"), F.col("fecha_txt"))
    return a.select("id", dates.order_date(lines).alias("oc"), dates.order_date(none).alias("sin"))


Q["q_order_dates"] = order_dates
SQL["q_order_dates"] = "SELECT o_orderkey AS id, strftime(CAST(o_orderdate AS DATE) + 3, '%d-%m-%Y') AS oc, '' AS sin FROM orders"


def certificates(s, d):
    """Certificate numbers (S12), postback arguments (S23) and the values of form cells."""
    p = table(s, d, "part")
    k = F.col("p_partkey").cast("string")
    number = F.concat(F.lit("ct dndm - cc - "), k, F.lit(" - 03 - 24/R"))
    link = F.concat(F.lit("javascript:__doPostBack('grid','Page$"), k, F.lit("')"))
    cell = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('<input VALUE=" "><input value = " '), "p_name", F.lit(' &amp; Cía&#46;">')))
    cell = cell.when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("<textarea rows=2>\n <b>"), "p_name", F.lit("</b> &oacute;&nbsp;</textarea>"))).otherwise(F.concat(F.lit("<td>&lt;b&gt; "), "p_name", F.lit("</td>")))
    arg = text.postback(link)
    return p.select("p_partkey", text.certificate(F.concat(F.lit("1: "), number, F.lit(" fin"))).alias("cert"), text.is_certificate(number).alias("es"), text.is_certificate(F.concat(number, F.lit("x"))).alias("no"), arg["target"].alias("target"), arg["argument"].alias("argument"), html.cell_value(cell).alias("valor"))


Q["q_certificates"] = certificates
SQL["q_certificates"] = """SELECT p_partkey, CASE WHEN p_partkey < 100000 THEN 'CT DNDM - CC - ' || p_partkey || ' - 03 - 24/R' ELSE '' END AS cert, p_partkey < 100000 AS es, false AS no,
'grid' AS target, 'Page$' || p_partkey AS argument, CASE p_partkey % 3 WHEN 0 THEN p_name || ' & Cía.' WHEN 1 THEN p_name || ' ó' ELSE p_name END AS valor FROM part"""


def award_dates(s, d):
    """Dates that stand in for one another (T10), the discards of failed fetches (C4) in the same table."""
    a = acts(s, d).withColumn("cuadro", F.when(F.col("id") % 4 == 0, " ").otherwise("u")).withColumn("adj", F.when(F.col("id") % 3 == 0, "").otherwise("01-01-2020"))
    bidders = F.when(F.col("id") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    day, award = rules.award_dates(F.col("cuadro"), bidders, F.col("fecha_txt"), F.col("adj"))
    out = a.select(F.col("id").cast("string").alias("id"), day.alias("fecha"), award.alias("adj"))
    gone = rules.failed_fetches(a.withColumn("html", F.when(F.col("id") % 11 > 0, "x")), "enlace", "html")
    return out.unionByName(gone.select(F.md5("enlace").alias("id"), "fecha", F.lit(None).cast("string").alias("adj")))


Q["q_award_dates"] = award_dates
SQL["q_award_dates"] = f"""WITH {ACTS_SQL}, x AS (SELECT id, enlace, CASE WHEN id % 4 = 0 THEN CASE WHEN id % 3 = 0 THEN '' ELSE '01-01-2020' END ELSE fecha_txt END AS fecha, CASE WHEN id % 3 = 0 THEN '' ELSE '01-01-2020' END AS a FROM acts)
SELECT CAST(id AS VARCHAR) AS id, fecha, CASE WHEN id % 2 = 1 AND a = '' AND fecha <> '' THEN fecha ELSE a END AS adj FROM x
UNION ALL SELECT md5(enlace), 'skip_timeout_xpath', NULL FROM x WHERE id % 11 = 0"""


def run_rows(s, d):
    """A row for each run: totals, distinct links, start, end, status (A13), and its seconds."""
    e = table(s, d, "events").select(F.col("event_type").alias("run"), F.col("user_id").cast("string").alias("link"), F.when((F.col("event_type") == "click") & (F.col("event_id") % 9 == 0), "error").otherwise("ok").alias("estado"), F.col("ts").cast("timestamp").alias("t"))
    got = rules.run_row(e, F.col("run"), F.col("t"), F.col("t"))
    return got.select("run", "total", "unicos", "errores", "estado", dates.seconds_between(F.col("inicio"), F.col("fin")).alias("segundos"))


Q["q_run_rows"] = run_rows
SQL["q_run_rows"] = """SELECT event_type AS run, CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT user_id) AS BIGINT) AS unicos, CAST(count(*) FILTER (event_type = 'click' AND event_id % 9 = 0) AS BIGINT) AS errores,
CASE WHEN count(*) FILTER (event_type = 'click' AND event_id % 9 = 0) = 0 THEN 'ok' WHEN count(*) FILTER (event_type = 'click' AND event_id % 9 = 0) < count(*) THEN 'parcial' ELSE 'error' END AS estado,
round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 3) AS segundos FROM events GROUP BY 1"""


def sources(s, d):
    """A table's columns (SC11), a query with parameters (SC10), picked columns (SC3), an absent table (SC7), the newest file (O9), pages up to a cap."""
    n = table(s, d, "nation")
    ranges = tables.read_ranges(s, {"there": f"{d}/region.parquet", "absent": f"{d}/nothing.parquet"}, "r_regionkey int, r_name string")
    by_name = s.sql("SELECT count(*) AS n FROM {t} WHERE n_nationkey >= :least", args={"least": 5}, t=n)
    picked = tables.pick_columns(n.withColumn("x", F.when(F.col("n_nationkey") % 2 == 0, 1)), "n_name", "x")
    files = s.createDataFrame([("a", 1), ("c", 3), ("b", 3)], "path string, modificationTime long")
    one = lambda k, df: df.select(F.lit(k).alias("que"), F.col(df.columns[0]).cast("string").alias("valor"))
    shape = tables.columns_of(n.select("n_nationkey", "n_name")).agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "name", "type"))), ", ").alias("v"))
    parts = [one("columnas", shape), one("consulta", by_name), one("elegidas", picked.agg(F.count("*"))), one("ahi", ranges["there"].agg(F.count("*"))), one("ausente", ranges["absent"].agg(F.count("*"))), one("nuevo", tables.newest(files)), one("paginas", n.where("n_regionkey <= 2").agg(F.count("*")))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


Q["q_sources"] = sources
SQL["q_sources"] = """SELECT 'columnas' AS que, 'n_name string, n_nationkey int' AS valor UNION ALL SELECT 'consulta', CAST(count(*) AS VARCHAR) FROM nation WHERE n_nationkey >= 5
UNION ALL SELECT 'elegidas', CAST(count(*) AS VARCHAR) FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'ahi', CAST(count(*) AS VARCHAR) FROM region UNION ALL SELECT 'ausente', '0'
UNION ALL SELECT 'nuevo', 'c' UNION ALL SELECT 'paginas', CAST(count(*) AS VARCHAR) FROM nation WHERE n_regionkey <= 2"""


def late_states(s, d):
    """Requests' states that come in the wrong order: an older one that comes late changes nothing (ST10); untouched keys are not read again."""
    at = f"{tables.work_dir(s)}/late-{uuid.uuid4().hex}/t"
    e = requests(s, d).select(F.col("seq").alias("id"), "status", F.lit(2).alias("v"))
    tables.keep_latest(e, at, "id", ["v"])
    tables.keep_latest(e.where("id % 3 = 0").select("id", F.lit("viejo").alias("status"), F.lit(1).alias("v")), at, "id", ["v"])
    tables.keep_latest(e.where("id % 5 = 0").select("id", F.lit("nuevo").alias("status"), F.lit(3).alias("v")), at, "id", ["v"])
    return s.read.parquet(at).select("id", "status", "v")


Q["q_late_states"] = late_states
SQL["q_late_states"] = f"WITH {REQUESTS_SQL} SELECT id, CASE WHEN id % 5 = 0 THEN 'nuevo' ELSE status END AS status, CASE WHEN id % 5 = 0 THEN 3 ELSE 2 END AS v FROM requests"


def price_cells(s, d):
    """A bidder's cells by their header's names (P20) and the cheapest of each act among rows that aren't blank."""
    b = bids(s, d).select("acto", F.array("proveedor", F.col("total").cast("decimal(18,2)").cast("string")).alias("c"))
    rows = b.select("acto", reshape.by_header(F.col("c"), ["nombre", "precio", "nota"]).alias("r")).select("acto", "r.*")
    return rows.where(reshape.has_payload(["nombre", "nota"])).groupBy("acto").agg(F.min(F.col("precio").cast("decimal(18,2)")).cast("string").alias("precio"), F.max("nota").alias("nota"))


Q["q_header_cells"] = price_cells
SQL["q_header_cells"] = f"WITH {BIDS_SQL} SELECT acto, CAST(min(CAST(total AS DECIMAL(18,2))) AS VARCHAR) AS precio, '' AS nota FROM bids GROUP BY 1"
