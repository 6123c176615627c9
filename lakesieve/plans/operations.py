"""Queries over detection, rules, requests and schedules."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakesieve.functions import dates, text
from lakesieve.functions.text import norm_name
from lakesieve.operators import catalog as cat
from lakesieve.operators import detect, rules
from lakesieve.plans.parsing import _norm
from lakesieve.plans.views import ACTS_SQL, REQUESTS_SQL, acts, requests
from lakesieve.sources.html_tables import table_rows
from lakesieve.sources.tables import read_table as table
from lakesieve.sources.tables import work_dir
from lakesieve.streaming import requests as rq

Q, SQL = {}, {}


def detect_codes(s, d):
    docs = table(s, d, "documents")
    codes = docs.select(F.explode(text.ficha_tokens(F.col("text"))).alias("c")).select(F.replace("c", F.lit("*"), F.lit("")).alias("c")).distinct()
    return detect.codes_in(docs, codes, "doc_id", "text", "c").groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("ficha")), ", ").alias("fichas"))


Q["q_detect_codes"] = detect_codes
SQL["q_detect_codes"] = """WITH c AS (SELECT DISTINCT replace(unnest(regexp_extract_all(text, '\\b\\d{3,8}\\*?\\b')), '*', '') AS c FROM documents), t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[0-9A-Za-z]+')) AS w FROM documents)
SELECT doc_id, string_agg(w, ', ' ORDER BY w) AS fichas FROM t WHERE w IN (SELECT c FROM c) GROUP BY 1"""


def _names(s, d):
    """Beginnings of benchmark passages as names, every second one truncated."""
    b = table(s, d, "benchmark")
    words = F.slice(F.split(norm_name(F.col("text")), " "), 1, 3)
    name = F.array_join(words, " ")
    return b.select((F.col("item_id") + 100).cast("string").alias("codigo"), F.when(F.col("item_id") % 2 == 0, F.concat(F.substring(name, 1, 9), F.lit("..."))).otherwise(name).alias("nombre"), F.col("item_id").alias("seq"))


Q["q_detect_names"] = lambda s, d: detect.names_in(table(s, d, "documents"), detect.dictionary(_names(s, d), "codigo", "nombre", "seq"), "doc_id", "text").select("doc_id", "nombre", "ficha")
_NAMES = f"""b AS (SELECT item_id, CAST(item_id + 100 AS VARCHAR) AS ficha, array_to_string(string_split({_norm("text")}, ' ')[1:3], ' ') AS n FROM benchmark),
r AS (SELECT item_id, ficha, trim(CASE WHEN item_id % 2 = 0 THEN substr(n, 1, 9) ELSE n END) AS nombre, item_id % 2 = 0 AS trunc FROM b), n AS (SELECT nombre, arg_max(ficha, item_id) AS ficha, bool_or(trunc) AS trunc, min(item_id) AS o FROM r WHERE nombre <> '' GROUP BY 1), t AS (SELECT doc_id, text, ' ' || {_norm("text")} || ' ' AS t FROM documents)"""
SQL["q_detect_names"] = f"WITH {_NAMES} SELECT doc_id, nombre, ficha FROM t JOIN n ON contains(t, ' ' || nombre || CASE WHEN trunc THEN '' ELSE ' ' END)"


def label(s, d):
    docs = table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" 101 y 103 de 00102"))).otherwise(F.col("text")).alias("text"))
    return detect.tokens(docs, _names(s, d), "doc_id", "text", "codigo", "nombre", "seq").select("doc_id", "label", F.array_join(F.array_sort(detect.base_codes(F.col("tokens"))), ",").alias("bases"))


Q["q_detect_label"] = label
SQL["q_detect_label"] = f"""WITH {_NAMES}, u AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' 101 y 103 de 00102' ELSE text END AS x, CASE WHEN doc_id % 5 = 0 THEN t || '101 y 103 de 00102 ' ELSE t END AS t FROM t),
c AS (SELECT DISTINCT doc_id, w AS ficha FROM (SELECT doc_id, unnest(regexp_extract_all(x, '[0-9A-Za-z]+')) AS w FROM u) WHERE w IN (SELECT ficha FROM r)),
m AS (SELECT doc_id, ficha, min(o) AS o FROM u JOIN n ON contains(t, ' ' || nombre || CASE WHEN trunc THEN '' ELSE ' ' END) GROUP BY 1, 2),
a AS (SELECT doc_id, ficha, 0 AS k, 0 AS o, ficha AS tok FROM c UNION ALL SELECT doc_id, ficha, 1, o, '* ' || ficha FROM m WHERE (doc_id, ficha) NOT IN (SELECT (doc_id, ficha) FROM c))
SELECT d.doc_id, coalesce(string_agg(tok, ', ' ORDER BY k, o, ficha), 'No Detectada') AS label, coalesce(string_agg(DISTINCT ficha, ',' ORDER BY ficha), '') AS bases FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id GROUP BY 1"""

Q["q_legacy_detect"] = lambda s, d: table(s, d, "documents").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), r"(?U)[^\w]+"))).alias("w")).join(table(s, d, "documents").select(F.explode(text.ficha_tokens(F.col("text"))).alias("w")).distinct(), "w", "left_semi").groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("w")), ", ").alias("fichas"))
SQL["q_legacy_detect"] = """WITH c AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\b\\d{3,8}\\*?\\b')) AS c FROM documents), t AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '[^\\pL\\pN\\pM_]+')) AS w FROM documents)
SELECT doc_id, string_agg(w, ', ' ORDER BY w) AS fichas FROM t WHERE w IN (SELECT c FROM c) GROUP BY 1"""

_MEDS = ("idiot", "scum", "token", "license", "mit")
Q["q_medic_first"] = lambda s, d: detect.first_word_of(table(s, d, "documents"), s.createDataFrame([(w,) for w in _MEDS], "w string"), "doc_id", "text", "w")
SQL["q_medic_first"] = f"SELECT doc_id, min(w) AS word FROM (SELECT doc_id, unnest(string_split_regex(regexp_replace(translate(trim(lower(text)), '{text.ACCENTED}', '{text.PLAIN}'), '\\s+', ' ', 'g'), '[^\\w]+')) AS w FROM documents) WHERE w IN {_MEDS} GROUP BY 1"


def discard(s, d):
    a = acts(s, d).withColumn("codes", F.array((F.col("id") % 20).cast("string"), (F.col("id") % 7).cast("string")))
    rs, sr = F.array(F.lit("3"), F.lit("15")), F.array(F.lit("5"))
    word = F.when(F.col("titulo").contains("URGENT"), "urgent")
    reason = rules.discard_reason(F.col("precio"), word, F.col("codes"), rs, sr, 20000.0)
    return a.select("id", reason.alias("motivo"), F.arrays_overlap("codes", sr).alias("has_sr"))


Q["q_discard_reason"] = discard
SQL["q_discard_reason"] = f"WITH {ACTS_SQL} SELECT id, CASE WHEN precio < 20000 THEN 'precio' WHEN contains(titulo, 'URGENT') THEN 'med:urgent' WHEN (id % 20 IN (3, 15) OR id % 7 IN (3, 15)) AND NOT (id % 20 = 5 OR id % 7 = 5) THEN 'RS' ELSE '' END AS motivo, id % 20 = 5 OR id % 7 = 5 AS has_sr FROM acts"


def route(s, d):
    a = acts(s, d)
    k = rules.classify(F.col("id") % 4 == 0, F.col("id") % 9 == 0, F.col("id") % 2 == 0)
    one = a.select("id", rules.destination(k).alias("destino"))
    return one.unionByName(a.where((F.col("id") % 20).isin(1, 2)).select("id", F.lit("ct_rir").alias("destino"))).groupBy("destino").agg(F.count("*").alias("n"), F.sum("id").alias("suma"))


Q["q_route"] = route
SQL["q_route"] = f"WITH {ACTS_SQL}, r AS (SELECT id, CASE WHEN id % 4 = 0 THEN 'sr' WHEN id % 9 = 0 THEN 'sf' WHEN id % 2 = 0 THEN 'ct' ELSE 'sf' END AS destino FROM acts UNION ALL SELECT id, 'ct_rir' FROM acts WHERE id % 20 IN (1, 2)) SELECT destino, CAST(count(*) AS BIGINT) AS n, CAST(sum(id) AS BIGINT) AS suma FROM r GROUP BY 1"


def acts_for(s, d, code="1234"):
    """Acts whose tokens hold the code; if none does, those that contain it. The scan gets the weaker condition."""
    a = acts(s, d).select("id", F.concat_ws(", ", F.col("id").cast("string"), (F.col("id") + 1).cast("string")).alias("f")).where(F.col("f").contains(code))
    a = a.withColumn("exact", F.exists(text.ficha_tokens(F.col("f")), lambda t: F.regexp_replace(t, r"\D", "") == code))
    some = a.agg(F.coalesce(F.bool_or("exact"), F.lit(False)).alias("some"))
    return a.crossJoin(F.broadcast(some)).where("exact or not some").dropDuplicates(["id"]).orderBy(F.desc("id")).select("id", "exact")


Q["q_acts_for_ficha"] = acts_for
SQL["q_acts_for_ficha"] = f"WITH {ACTS_SQL}, x AS (SELECT id, id = 1234 OR id + 1 = 1234 AS exact FROM acts WHERE contains(id || ', ' || (id + 1), '1234')) SELECT id, exact FROM x WHERE exact OR NOT (SELECT bool_or(exact) FROM x) ORDER BY id DESC LIMIT 50"


def pick(s, d):
    a = acts(s, d).withColumn("l", F.when(F.col("id") % 2 == 0, F.array(F.lit("Título"), F.lit("Fecha de Apertura"), F.concat(F.lit("el "), "fecha_txt"))).otherwise(F.array(F.concat(F.lit("Apertura: 01-01-1990 y "), "fecha_txt"), F.lit("x"))))
    return a.select("id", dates.pick_date(F.col("l"), ["fecha de apertura", "apertura"]).alias("fecha"), dates.pick_date(F.col("l"), ["nada"]).alias("nada"))


Q["q_pick_date"] = pick
SQL["q_pick_date"] = f"WITH {ACTS_SQL} SELECT id, fecha_txt AS fecha, '' AS nada FROM acts"


def html_tables(s, d):
    """Every act's bids as HTML tables, read back; each table's largest total."""
    a = acts(s, d).select("id", F.concat(F.lit("<p>x</p><table><tr><th>Proponente</th><th>Total</th></tr><tr><td>"), "titulo", F.lit("</td><td>"), "precio_txt", F.lit("<br></td></tr><tr><td>Total</td><td>B/. 1.50</td></tr></table>")).alias("html"))
    from lakesieve.functions.money import number

    rows = table_rows(a, "id", "html").where("row > 0")
    return rows.groupBy("id", "tbl").agg(F.max(number(F.get("cells", F.lit(1)))).alias("mayor"), F.min_by(F.get("cells", F.lit(0)), "row").alias("primero"))


Q["q_html_tables_whole"] = html_tables
SQL["q_html_tables_whole"] = f"WITH {ACTS_SQL} SELECT id, CAST(0 AS INT) AS tbl, precio AS mayor, titulo AS primero FROM acts"


def unit_data(s, d):
    """Prices and quantities of every act's code from two tables; every third act's code is in neither."""
    line = lambda tag, *cells: F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit(f"<{tag}>"), c if not isinstance(c, str) else F.lit(c), F.lit(f"</{tag}>"))], F.lit("</tr>"))
    one = F.concat(line("th", "Descripción", "Precio Unitario", "Cantidad", "Unidad de Medida"), line("td", "otro", "B/. 9.00", "7", "caja"), line("td", F.concat(F.lit("Art. "), F.col("id").cast("string"), F.lit(" x")), F.when(F.col("id") % 2 == 0, F.col("precio_txt")).otherwise("-"), "3", "unidad"))
    two = F.concat(line("th", "Especificaciones del Comprador", "Precio Referencia", "Precio Unitario", "Cantidad"), line("td", "x", F.col("precio_txt"), "2,50", "4"))
    a = acts(s, d).select("id", F.when(F.col("id") % 3 == 0, "no hay").otherwise(F.concat(F.lit("ART. "), F.col("id").cast("string"))).alias("code"), F.concat(F.lit("<table>"), one, F.lit("</table><table>"), two, F.lit("</table>")).alias("html"))
    return cat.unit_data(table_rows(a, "id", "html"), a.select("id", "code"), "id", "code")


Q["q_unit_data"] = unit_data
SQL["q_unit_data"] = f"WITH {ACTS_SQL} SELECT id, CASE WHEN id % 3 = 0 THEN 9.0 WHEN id % 2 = 0 THEN precio ELSE 2.5 END::DOUBLE AS unit, precio / 4 AS ref, CASE WHEN id % 3 = 0 THEN 7 ELSE 3 END::DOUBLE AS qty, CASE WHEN id % 3 = 0 THEN 'caja' ELSE 'unidad' END AS um FROM acts"

Q["q_request_queue"] = lambda s, d: rq.queue(requests(s, d).where(F.lower("status").isin("pending", "enqueued"))).select("id", "job", "priority", "place", "behind")
SQL["q_request_queue"] = f"WITH {REQUESTS_SQL}, q AS (SELECT *, row_number() OVER (ORDER BY priority, seq) AS place, count(*) OVER () AS t FROM requests WHERE status IN ('pending', 'enqueued')) SELECT id, job, priority, CAST(place AS INT) AS place, CAST(greatest(t - 12, 0) AS BIGINT) AS behind FROM q WHERE place <= 12"


def last_run(s, d):
    e = requests(s, d).withColumn("dur", (F.col("id") % 9000).cast("double"))
    r = rq.latest(e, "job", ["requested_at", "seq"], ["id", "status", "dur", F.date_format("requested_at", "yyyy-MM-dd HH:mm:ss").alias("fin")])
    return r.select("job", "id", "status", "fin", text.format_duration(F.col("dur")).alias("duracion"), rq.overdue(F.col("dur"), F.when(F.col("job") == "view", 1200.0)).alias("excedido"))


Q["q_last_run"] = last_run
SQL["q_last_run"] = f"""WITH {REQUESTS_SQL}, l AS (SELECT job, arg_max({{'id': id, 'st': status, 'at': requested_at}}, {{'a': requested_at, 'b': seq}}) AS r FROM requests GROUP BY 1), x AS (SELECT job, r.id AS id, r.st AS status, strftime(r.at, '%Y-%m-%d %H:%M:%S') AS fin, r.id % 9000 AS d FROM l)
SELECT job, id, status, fin, concat_ws(' ', CASE WHEN d >= 3600 THEN (d // 3600) || ' h' END, CASE WHEN d >= 3600 OR d % 3600 >= 60 THEN (d % 3600 // 60) || ' min' END, (d % 60) || ' s') AS duracion, d >= CASE WHEN job = 'view' THEN 1200 ELSE 4200 END AS excedido FROM x"""

Q["q_request_state"] = lambda s, d: rq.latest(requests(s, d).withColumn("req", F.col("id") % 400), "req", ["requested_at", "seq"], ["status", "job"])
SQL["q_request_state"] = f"WITH {REQUESTS_SQL} SELECT id % 400 AS req, arg_max(status, {{'a': requested_at, 'b': seq}}) AS status, arg_max(job, {{'a': requested_at, 'b': seq}}) AS job FROM requests GROUP BY 1"


def cron(s, d):
    jobs = s.createDataFrame([("click", "lunes,jueves", "08:00 20:30"), ("view", "mon tue wed thu fri sat sun", "12:00")], "job string, d string, t string").select("job", rq.parse_days(F.col("d")).alias("days"), rq.parse_times(F.col("t")).alias("times"))
    slots = rq.slots(jobs, "2024-01-01", "2024-01-30")
    ran = table(s, d, "events").select(F.col("event_type").alias("job"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"))
    missed = slots.join(ran, ["job", "slot"], "left_anti")
    return missed.select("job", F.date_format("slot", "yyyy-MM-dd HH:mm").alias("slot")).orderBy(F.desc("slot"), "job").limit(300)


Q["q_cron_slots"] = cron
SQL["q_cron_slots"] = """WITH d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS TIMESTAMP) AS d),
s AS (SELECT 'click' AS job, d + INTERVAL 8 HOUR AS slot FROM d WHERE isodow(d) IN (1, 4) UNION ALL SELECT 'click', d + INTERVAL 20 HOUR + INTERVAL 30 MINUTE FROM d WHERE isodow(d) IN (1, 4) UNION ALL SELECT 'view', d + INTERVAL 12 HOUR FROM d)
SELECT job, strftime(slot, '%Y-%m-%d %H:%M') AS slot FROM s WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = s.job AND date_trunc('hour', e.ts) = s.slot) ORDER BY slot DESC, job LIMIT 300"""


def stream_requests(s, d):
    """The events as a stream of files, taken up by an incremental query with a watermark."""
    src = requests(s, d)
    at = f"{work_dir(s)}/requests-{uuid.uuid4().hex}"
    src.repartition(4).write.parquet(f"{at}/in")
    rq.counted_by_status(s, f"{at}/in", src.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), f"{at}/out", f"{at}/state")
    return s.read.parquet(f"{at}/out").select("id", "job", "status", "priority")


Q["q_stream_requests"] = stream_requests
SQL["q_stream_requests"] = f"WITH {REQUESTS_SQL} SELECT id, job, status, priority FROM requests"

Q["q_requests_per_window"] = lambda s, d: rq.windowed(requests(s, d).withColumn("requested_at", F.col("requested_at").cast("timestamp")), "1 day").select("job", F.date_format("start", "yyyy-MM-dd").alias("dia"), "n")
SQL["q_requests_per_window"] = f"WITH {REQUESTS_SQL} SELECT job, strftime(requested_at, '%Y-%m-%d') AS dia, CAST(count(*) AS BIGINT) AS n FROM requests GROUP BY 1, 2"
