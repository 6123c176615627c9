"""Queries over scalar functions: prices, dates, links, texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesieve.functions import dates, html, money, text, url
from lakesieve.functions.text import ACCENTED, PLAIN
from lakesieve.operators import rules
from lakesieve.plans.views import ACTS_SQL, acts
from lakesieve.sources.tables import read_table as table
from lakesieve.streaming.requests import parse_days, parse_times

Q, SQL = {}, {}


def _norm(c: str) -> str:
    return f"trim(regexp_replace(translate(lower(coalesce({c}, '')), '{ACCENTED}', '{PLAIN}'), '[^a-z0-9]+', ' ', 'g'))"


def _amount(c: str) -> str:
    v = f"regexp_extract(coalesce({c}, ''), '([0-9]{{1,3}}(?:[.,][0-9]{{3}})*[.,][0-9]{{2}}|[0-9]+(?:[.,][0-9]+)?)', 1)"
    return f"TRY_CAST(CASE WHEN contains({v}, ',') AND contains({v}, '.') THEN CASE WHEN instr(reverse({v}), ',') < instr(reverse({v}), '.') THEN replace(replace({v}, '.', ''), ',', '.') ELSE replace({v}, ',', '') END ELSE replace({v}, ',', '.') END AS DOUBLE)"


def opportunity_summary(s, d):
    a = acts(s, d).withColumn("p", money.price(F.col("precio_txt")))
    kind = F.when(F.col("p") < 50000, "descartar").otherwise(rules.classify(F.col("estado") == "Abierto", F.lit(False), F.col("estado") == "Adjudicado"))
    return a.withColumn("clase", kind).groupBy("entidad", "clase").agg(F.count("*").alias("n"), F.sum(F.col("p").cast("decimal(18,2)")).cast("double").alias("total"))


Q["q_opportunity_summary"] = opportunity_summary
SQL["q_opportunity_summary"] = f"""WITH {ACTS_SQL}, x AS (SELECT entidad, estado, {_amount("precio_txt")} AS p FROM acts)
SELECT entidad, CASE WHEN p < 50000 THEN 'descartar' WHEN estado = 'Abierto' THEN 'sr' WHEN estado = 'Adjudicado' THEN 'ct' ELSE 'sf' END AS clase, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(p AS DECIMAL(18,2))) AS DOUBLE) AS total FROM x GROUP BY 1, 2"""

Q["q_price_parse"] = lambda s, d: acts(s, d).select("id", money.price(F.col("precio_txt")).alias("precio"), money.price(F.translate("precio_txt", ",.", ".,")).alias("europeo"), money.price(F.substring("precio_txt", 1, 9)).alias("corto"), money.price(F.col("entidad")).alias("sin_precio"))
SQL["q_price_parse"] = f"""WITH {ACTS_SQL} SELECT id, {_amount("precio_txt")} AS precio, {_amount("translate(precio_txt, ',.', '.,')")} AS europeo, {_amount("substr(precio_txt, 1, 9)")} AS corto, {_amount("entidad")} AS sin_precio FROM acts"""

Q["q_num_parse"] = lambda s, d: acts(s, d).select("id", money.number(F.col("precio_txt")).alias("num"), money.number(F.concat(F.lit("USD -"), F.regexp_extract("precio_txt", r"(\d+),", 1), F.lit(",5"))).alias("signo"), money.number(F.lit("n/a")).alias("nada"), money.unit_reference(money.number(F.col("precio_txt")), F.col("id") % 3).alias("unidad"))
_NUM = "coalesce(TRY_CAST(regexp_replace(CASE WHEN contains(t, ',') AND contains(t, '.') THEN CASE WHEN instr(reverse(t), ',') < instr(reverse(t), '.') THEN replace(replace(t, '.', ''), ',', '.') ELSE replace(t, ',', '') END ELSE replace(t, ',', '.') END, '[^0-9.\\-]', '', 'g') AS DOUBLE), 0.0)"
_MARKS = "replace(replace(replace(replace(replace({}, 'B/.', ''), 'B/', ''), '$', ''), 'USD', ''), ' ', '')"
SQL["q_num_parse"] = f"""WITH {ACTS_SQL}, a AS (SELECT id, {_MARKS.format("precio_txt")} AS t1, {_MARKS.format("'USD -' || regexp_extract(precio_txt, '(\\d+),', 1) || ',5'")} AS t2 FROM acts)
SELECT id, {_NUM.replace("(t,", "(t1,").replace("(t)", "(t1)").replace("(t, ", "(t1, ")} AS num, {_NUM.replace("(t,", "(t2,").replace("(t)", "(t2)")} AS signo, 0.0::DOUBLE AS nada,
CASE WHEN id % 3 > 0 AND {_NUM.replace("(t,", "(t1,").replace("(t)", "(t1)")} > 0 THEN {_NUM.replace("(t,", "(t1,").replace("(t)", "(t1)")} / (id % 3) ELSE {_NUM.replace("(t,", "(t1,").replace("(t)", "(t1)")} END AS unidad FROM a"""

# white space that isn't ASCII's, at both ends and inside
def _padded():
    return F.concat(F.lit("\t\u00a0 "), F.replace("text", F.lit(" "), F.lit("\u2003 ")), F.lit("\u3000\n"))


Q["q_norm_text"] = lambda s, d: table(s, d, "documents").select("doc_id", F.md5(text.norm_txt(_padded())).alias("txt"), F.md5(text.norm_name(F.col("text"))).alias("nombre"))
SQL["q_norm_text"] = """SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '\\s+', ' ', 'g'))) AS txt,
md5(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'))) AS nombre FROM documents"""

Q["q_sanitize"] = lambda s, d: table(s, d, "documents").select("doc_id", F.md5(text.sanitize(_padded())).alias("limpio"), F.md5(text.repair_mojibake(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))).alias("reparado"))
SQL["q_sanitize"] = "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS limpio, md5(text) AS reparado FROM documents"

Q["q_norm_url"] = lambda s, d: table(s, d, "pages").select("page_id", url.normalize_url(F.col("url")).alias("normal"))
SQL["q_norm_url"] = """SELECT page_id, 'https://' || lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) || CASE WHEN rtrim(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g'), '/') = '' THEN '/' ELSE rtrim(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g'), '/') END
  || CASE WHEN regexp_extract(url, '#(.*)$', 1) <> '' THEN '#' || lower(regexp_extract(url, '#(.*)$', 1)) ELSE '' END AS normal FROM pages"""

Q["q_act_key"] = lambda s, d: acts(s, d).select("id", url.act_key(F.col("enlace")).alias("clave"), url.expected_code(F.col("enlace")).alias("codigo"), url.process_code(F.col("enlace")).alias("proceso"), url.normalize_url(F.col("enlace"), drop_token=True).alias("normal"))
SQL["q_act_key"] = f"""WITH {ACTS_SQL}, k AS (SELECT id, '2025-0-' || id || '-LP' AS c, id % 3 AS r, lower('abcDEF' || lpad(CAST(id AS VARCHAR), 8, '0')) AS tok FROM acts)
SELECT id, CASE r WHEN 0 THEN 'pliego-de-cargos:' || c WHEN 1 THEN 'solicitud-de-cotizacion:' || c ELSE 'acto:' || c END AS clave, c AS codigo, CASE WHEN r < 2 THEN c ELSE '' END AS proceso,
'https://www.portal.example/Inicio#/' || CASE r WHEN 0 THEN 'pliego-de-cargos/' || lower(c) WHEN 1 THEN 'solicitud-de-cotizacion/' || lower(c) ELSE 'otros/' || lower(c) || '/' || tok END AS normal FROM k"""

Q["q_abs_url_href"] = lambda s, d: table(s, d, "pages").select("page_id", url.first_href(F.col("html"), "t").alias("con_t"), url.first_href(F.col("html"), "/", "the").alias("sin_the"), url.abs_url(F.lit("#/x")).alias("relativa"))
SQL["q_abs_url_href"] = """WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)(?:href|data-uw-original-href)=["'']([^"'']+)["'']', 1) AS l FROM pages),
f AS (SELECT page_id, list_filter(l, lambda x: contains(lower(x), 't'))[1] AS a, list_filter(l, lambda x: contains(x, '/') AND NOT contains(lower(x), 'the'))[1] AS b FROM h)
SELECT page_id, coalesce(CASE WHEN regexp_matches(a, '^https?://') THEN a WHEN starts_with(a, '/') THEN 'https://www.portal.example' || a ELSE 'https://www.portal.example/' || a END, '') AS con_t,
coalesce(CASE WHEN regexp_matches(b, '^https?://') THEN b WHEN starts_with(b, '/') THEN 'https://www.portal.example' || b ELSE 'https://www.portal.example/' || b END, '') AS sin_the, 'https://www.portal.example/#/x' AS relativa FROM f"""

Q["q_days_between"] = lambda s, d: acts(s, d).select("id", dates.days_between(F.lit("01-01-1995"), F.col("fecha_txt")).alias("dias"), dates.delivery_days(F.concat(F.lit("Entrega: "), (F.col("id") % 40).cast("string"), F.lit(" días"))).alias("entrega"), dates.with_delivery(dates.days_between(F.lit("01-01-1995"), F.col("fecha_txt")), (F.col("id") % 40).cast("double")).alias("total"), F.bround(F.col("precio") / 7, 4).alias("redondo"))
SQL["q_days_between"] = f"""WITH {ACTS_SQL}, x AS (SELECT *, CAST(date_diff('day', DATE '1995-01-01', CAST(strptime(fecha_txt, '%d-%m-%Y') AS DATE)) AS DOUBLE) AS dd FROM acts)
SELECT id, dd AS dias, CAST(id % 40 AS DOUBLE) AS entrega, CASE WHEN dd > 0 AND id % 40 > 0 THEN dd + id % 40 ELSE greatest(dd, 0.0) END AS total, round_even(precio / 7, 4) AS redondo FROM x"""


def _ranged(s, d):
    a = acts(s, d)
    k = F.col("id") % 4
    return a.withColumn("f", F.when(k == 0, F.concat(F.lit("01-01-1995 a "), "fecha_txt")).when(k == 1, F.concat("fecha_txt", F.lit(" 10:30 AM"))).when(k == 2, F.lit("pendiente")).otherwise(F.replace("fecha_txt", F.lit("-"), F.lit("/"))))


def _purge(which):
    def run(s, d):
        x = _ranged(s, d).withColumn("t", dates.deadline(F.col("f"), which))
        kept = x.where(~F.coalesce(F.col("t") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.lit(False)))
        return kept.select("id", F.date_format("t", "yyyy-MM-dd HH:mm").alias("limite"))

    return run


def _purge_sql(several):
    return f"""WITH {ACTS_SQL}, x AS (SELECT id, id % 4 AS k, strptime(fecha_txt, '%d-%m-%Y') AS b, CAST(substr(fecha_txt, 4, 2) AS INT) AS m, CAST(substr(fecha_txt, 7, 4) AS INT) AS y FROM acts),
t AS (SELECT id, CASE k WHEN 0 THEN {several} WHEN 1 THEN b + INTERVAL 10 HOUR + INTERVAL 30 MINUTE WHEN 2 THEN NULL ELSE b + to_hours(m) END AS t FROM x)
SELECT id, strftime(t, '%Y-%m-%d %H:%M') AS limite FROM t WHERE t IS NULL OR t >= TIMESTAMP '2000-01-01 00:00:00'"""


Q["q_purge_range_last"], SQL["q_purge_range_last"] = _purge("last"), _purge_sql("b + INTERVAL 23 HOUR + INTERVAL 59 MINUTE")
Q["q_purge_range_first"], SQL["q_purge_range_first"] = _purge("first"), _purge_sql("TIMESTAMP '1995-01-01 00:00:00'")

Q["q_ficha_tokens"] = lambda s, d: table(s, d, "documents").select("doc_id", F.array_join(text.ficha_tokens(F.col("text")), ",").alias("tokens"), text.ficha_digits(F.substring("text", -6, 6)).alias("digitos"), text.code_of(F.col("text")).alias("codigo"))
SQL["q_ficha_tokens"] = """WITH t AS (SELECT doc_id, text, list_distinct(regexp_extract_all(text, '\\b\\d{3,8}\\*?\\b')) AS d, regexp_extract_all(text, '\\b\\d{3,8}\\*?\\b') AS l FROM documents)
SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS tokens, regexp_replace(right(text, 6), '[^0-9]', '', 'g') AS digitos,
regexp_replace(regexp_extract(text, '(?:^|[^0-9])([0-9]{1,6})(?:[^0-9]|$)', 1), '^0+([0-9])', '\\1') AS codigo FROM t"""

Q["q_schedule_parse"] = lambda s, d: s.createDataFrame([("a", "Lunes, miércoles;VIERNES", "8:00, 17:30 25:00"), ("b", "mon/tue mon", "07:05;7:05"), ("c", "", None), ("d", "hoy", "9")], "job string, days string, times string").select("job", F.array_join(parse_days(F.col("days")), ",").alias("dias"), F.array_join(parse_times(F.col("times")), ",").alias("horas"), F.sha2(F.concat_ws("|", F.array_sort(parse_days(F.col("days")))), 256).alias("firma"))
SQL["q_schedule_parse"] = "SELECT job, dias, horas, sha256(orden) AS firma FROM (VALUES ('a', 'mon,wed,fri', '08:00,17:30', 'fri|mon|wed'), ('b', 'mon,tue', '07:05', 'mon|tue'), ('c', '', '', ''), ('d', '', '', '')) t(job, dias, horas, orden)"

Q["q_dq_probes"] = lambda s, d: table(s, d, "documents").select(F.explode(F.split("text", r"\s+")).alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("w").rlike(r"(?i)^(?:nan|\d+|\.{3})$")).alias("malos"), F.count_if(F.col("w").rlike(r"^[\d\.]+$")).alias("numericos"))
SQL["q_dq_probes"] = "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (regexp_matches(w, '(?i)^(?:nan|\\d+|\\.{3})$')) AS BIGINT) AS malos, CAST(count(*) FILTER (regexp_matches(w, '^[\\d\\.]+$')) AS BIGINT) AS numericos FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS w FROM documents)"

Q["q_token_overlap"] = lambda s, d: table(s, d, "part").select("p_partkey", F.bround(text.token_overlap(text.norm_name(F.col("p_name")), text.norm_name(F.concat("p_type", F.lit(" "), "p_name")), ("de", "la")), 6).alias("parte"))
SQL["q_token_overlap"] = f"""WITH t AS (SELECT p_partkey, list_filter(list_distinct(string_split({_norm("p_name")}, ' ')), lambda x: x NOT IN ('', 'de', 'la')) AS a, list_filter(list_distinct(string_split({_norm("p_type || ' ' || p_name")}, ' ')), lambda x: x NOT IN ('', 'de', 'la')) AS b FROM part)
SELECT p_partkey, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE round(len(list_intersect(a, b)) / greatest(len(a), len(b)), 6) END AS parte FROM t"""

Q["q_html_lines"] = lambda s, d: table(s, d, "pages").select("page_id", F.size(html.lines(F.col("html"))).alias("n"), F.md5(F.array_join(html.lines(F.col("html")), "|")).alias("lineas"), rules.page_type(html.lines(F.col("html"))).alias("tipo"))
SQL["q_html_lines"] = """WITH s AS (SELECT page_id, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<noscript.*?</noscript>|<!--.*?-->', ' ', 'g') AS h FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?i)<br ?/?>|</(?:p|div|tr|li|h[1-6]|td|th)>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS t FROM s),
e AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS t FROM b),
l AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM e)
SELECT page_id, CAST(len(l) AS INT) AS n, md5(array_to_string(l, '|')) AS lineas, CASE WHEN len(list_filter(l, lambda x: contains(lower(x), 'informacion del proponente'))) > 0 THEN 1 ELSE 2 END AS tipo FROM l"""

_LABEL = r'<a href="/([^"]+)">([^<]*)</a>'
Q["q_html_fields"] = lambda s, d: table(s, d, "pages").select("page_id", html.first_text(F.col("html"), ["(?is)<h1[^>]*>(.*?)</h1>", "(?is)<title[^>]*>(.*?)</title>"]).alias("titulo"), html.first_text(F.col("html"), ["(?is)<nada>(.*?)</nada>"]).alias("nada"), F.size(html.all_texts(F.col("html"), ["(?is)<nada>(.*?)</nada>", "(?is)<li>(.*?)</li>"])).alias("puntos"), html.pick_value(html.labelled(F.col("html"), _LABEL), ["the", "for"]).alias("valor"))
_F = "nullif(trim(regexp_replace(regexp_extract(html, '{}', 1), '<[^>]+>', ' ', 'g')), '')"
_N = f"regexp_replace(translate(trim(lower(x.b)), '{ACCENTED}', '{PLAIN}'), '\\s+', ' ', 'g')"
SQL["q_html_fields"] = f"""WITH p AS (SELECT page_id, html, list_zip(regexp_extract_all(html, '{_LABEL}', 1), regexp_extract_all(html, '{_LABEL}', 2)) AS z FROM pages),
z AS (SELECT page_id, html, list_transform(z, lambda q: {{'b': q[1], 'v': q[2]}}) AS z FROM p)
SELECT page_id, coalesce({_F.format("(?is)<h1[^>]*>(.*?)</h1>")}, {_F.format("(?is)<title[^>]*>(.*?)</title>")}, 'No Disponible') AS titulo, 'No Disponible' AS nada, CAST(len(regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1)) AS INT) AS puntos,
coalesce(list_filter(z, lambda x: {_N} = 'the')[1].v, list_filter(z, lambda x: {_N} = 'for')[1].v, list_filter(z, lambda x: contains({_N}, 'the'))[1].v, list_filter(z, lambda x: contains({_N}, 'for'))[1].v, '') AS valor FROM z"""
