"""Queries over joins, deduplication, reshaping, keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakesieve.functions import url
from lakesieve.functions.text import norm_name
from lakesieve.operators import catalog as cat
from lakesieve.operators import dedup, joins, reshape
from lakesieve.plans.views import ACTS_SQL, BIDS_SQL, CATALOG_SQL, acts, bids, catalog
from lakesieve.sources.tables import read_table as table

Q, SQL = {}, {}


def _links(s, d):
    a = acts(s, d).select("id", url.normalize_url(F.col("enlace"), drop_token=True).alias("k1"), url.act_key(F.col("enlace")).alias("k2"))
    return a.where("id % 5 <> 0"), a.where("id % 3 = 0"), a.where("id % 7 = 0")


_K = f"""WITH {ACTS_SQL}, k AS (SELECT id, '2025-0-' || id || '-LP' AS c, id % 3 AS r, lower('abcDEF' || lpad(CAST(id AS VARCHAR), 8, '0')) AS tok FROM acts),
l AS (SELECT id, 'https://www.portal.example/Inicio#/' || CASE r WHEN 0 THEN 'pliego-de-cargos/' || lower(c) WHEN 1 THEN 'solicitud-de-cotizacion/' || lower(c) ELSE 'otros/' || lower(c) || '/' || tok END AS k1,
CASE r WHEN 0 THEN 'pliego-de-cargos:' || c WHEN 1 THEN 'solicitud-de-cotizacion:' || c ELSE 'acto:' || c END AS k2 FROM k)"""


def links_anti(s, d):
    new, known, gone = _links(s, d)
    return dedup.first_by(joins.not_known(joins.not_known(new, known, "k1"), gone, "k1"), F.col("k1"), [F.col("id")])


Q["q_links_anti"] = links_anti
SQL["q_links_anti"] = _K + "SELECT * FROM l WHERE id % 5 <> 0 AND k1 NOT IN (SELECT k1 FROM l WHERE id % 3 = 0) AND k1 NOT IN (SELECT k1 FROM l WHERE id % 7 = 0)"


def links_anti_or(s, d):
    new, known, gone = _links(s, d)
    return joins.not_known(new, known.unionByName(gone), "k1", "k2").select("id", "k2")


Q["q_links_anti_or"] = links_anti_or
SQL["q_links_anti_or"] = _K + "SELECT id, k2 FROM l n WHERE id % 5 <> 0 AND NOT EXISTS (SELECT 1 FROM l k WHERE (k.id % 3 = 0 OR k.id % 7 = 0) AND (k.k1 = n.k1 OR k.k2 = n.k2))"


def _flagged(s, d):
    a = acts(s, d).select("id", F.concat(F.lit("k"), (F.col("id") % 4000).cast("string")).alias("clave"), F.when(F.col("id") % 4 == 0, " true ").when(F.col("id") % 4 == 1, "TRUE").otherwise("").alias("flag"))
    return [a.where("id % 2 = 0"), a.where("id % 2 = 1")], a.where("id % 11 = 0").select("clave")


_FL = f"WITH {ACTS_SQL}, a AS (SELECT id, 'k' || (id % 4000) AS clave, CASE id % 4 WHEN 0 THEN ' true ' WHEN 1 THEN 'TRUE' ELSE '' END AS flag FROM acts) "
Q["q_move_checked"] = lambda s, d: joins.move(*_flagged(s, d), "flag", "clave", "id")[0]
SQL["q_move_checked"] = _FL + "SELECT id, clave, flag FROM (SELECT *, row_number() OVER (PARTITION BY clave ORDER BY id % 2, id) AS r FROM a WHERE upper(trim(flag)) = 'TRUE') WHERE r = 1 AND clave NOT IN (SELECT clave FROM a WHERE id % 11 = 0)"


def remaining(s, d):
    left = joins.move(*_flagged(s, d), "flag", "clave", "id")[1]
    return left[0].unionByName(left[1])


Q["q_remaining_after_move"] = remaining
SQL["q_remaining_after_move"] = _FL + "SELECT id, clave, flag FROM a WHERE upper(trim(flag)) <> 'TRUE'"

def upsert(s, d):
    """New titles and a column that the table lacks, each key's change twice: the later one counts, and prices stay."""
    a = acts(s, d)
    new = a.where("id % 3 < 2").select("id", F.upper("titulo").alias("titulo"), F.col("precio_txt").alias("Proponente 1"), F.lit(2).alias("v"))
    early = a.where("id % 3 = 0").select("id", F.lit("x").alias("titulo"), F.lit("y").alias("Proponente 1"), F.lit(1).alias("v"))
    return joins.upsert(a.where("id % 3 > 0").select("id", "titulo", "precio"), new.unionByName(early), "id", ["v"])


Q["q_upsert"] = upsert
SQL["q_upsert"] = f"""WITH {ACTS_SQL} SELECT id, CASE WHEN id % 3 < 2 THEN upper(titulo) ELSE titulo END AS titulo, CASE WHEN id % 3 > 0 THEN precio END AS precio,
CASE WHEN id % 3 < 2 THEN precio_txt END AS "Proponente 1" FROM acts"""

Q["q_replace_partition"] = lambda s, d: joins.replace_partition(acts(s, d).select("id", "entidad"), acts(s, d).where("entidad = 'FRANCE' and id % 2 = 0 or entidad = 'NATION_3' and id % 2 = 0").select((F.col("id") * 10).alias("id"), "entidad"), "entidad", "NATION_3")
SQL["q_replace_partition"] = f"WITH {ACTS_SQL} SELECT id, entidad FROM acts WHERE entidad <> 'NATION_3' UNION ALL SELECT id * 10, entidad FROM acts WHERE entidad IN ('FRANCE', 'NATION_3') AND id % 2 = 0"


def header_align(s, d):
    a = acts(s, d).select("id", F.col("titulo").alias("Titulo"), "estado")
    b = acts(s, d).where("id % 10 = 0").select("id", "entidad")
    target = reshape.header_union(["ID", "titulo", "nuevo"], ["estado", "entidad"])
    row = reshape.pad(F.array(F.col("ID"), F.col("titulo")), 4)
    return reshape.align(a, target).unionByName(reshape.align(b, target)).withColumn("fila", F.array_join(row, "|"))


Q["q_header_align"] = header_align
SQL["q_header_align"] = f"""WITH {ACTS_SQL}, x AS (SELECT CAST(id AS VARCHAR) AS "ID", titulo, '' AS nuevo, estado, '' AS entidad FROM acts UNION ALL SELECT CAST(id AS VARCHAR), '', '', '', entidad FROM acts WHERE id % 10 = 0)
SELECT *, "ID" || '|' || titulo || '||' AS fila FROM x"""


def items_wide(s, d):
    li, p = table(s, d, "lineitem"), table(s, d, "part")
    x = li.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("acto")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("p_name").alias("n")))).alias("items"))
    return reshape.wide(x, "items", "item_", reshape.width_of(x, "items"), "n").withColumn("n_items", F.size("items")).drop("items")


Q["q_items_wide"] = items_wide
SQL["q_items_wide"] = """SELECT acto, n_items, coalesce(COLUMNS('item_[0-9]+'), '') AS '\\0' FROM (PIVOT (
  SELECT l_orderkey AS acto, p_name, 'item_' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS c,
         CAST(count(*) OVER (PARTITION BY l_orderkey) AS INT) AS n_items
  FROM lineitem JOIN part ON l_partkey = p_partkey) ON c USING first(p_name) GROUP BY acto, n_items)"""


def bidders_wide(s, d):
    x = bids(s, d).groupBy("acto").agg(F.sort_array(F.collect_list(F.struct("n", "p", F.col("proveedor").alias("nombre"), F.col("total").cast("decimal(18,2)").alias("precio")))).alias("b"))
    width = reshape.width_of(x, "b")
    x = reshape.wide(reshape.wide(x, "b", "Proponente ", width, "nombre"), "b", "Precio Proponente ", width, "precio")
    text = F.array_join(F.transform("b", lambda y: F.concat(y["nombre"], F.lit(" — "), y["precio"].cast("string"))), "\n")
    return x.withColumn("num_participantes", F.size("b").cast("string")).withColumn("texto", F.md5(text)).drop("b")


Q["q_bidders_wide"] = bidders_wide
_N = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, s_name, l_extendedprice)"
_P = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
SQL["q_bidders_wide"] = f"""SELECT acto, num_participantes, texto, coalesce(COLUMNS('.*Proponente [0-9]+'), '') AS '\\0' FROM (PIVOT (
  SELECT acto, num_participantes, texto, p || n AS c, v FROM (
    SELECT l_orderkey AS acto, {_N} AS n, s_name, {_P} AS precio, CAST(count(*) OVER (PARTITION BY l_orderkey) AS VARCHAR) AS num_participantes,
           md5(string_agg(s_name || ' — ' || {_P}, chr(10)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, s_name, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS texto
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) x, LATERAL (VALUES ('Proponente ', s_name), ('Precio Proponente ', precio)) y(p, v))
  ON c USING first(v) GROUP BY acto, num_participantes, texto)"""


def min_bidder(s, d):
    b = bids(s, d).withColumn("v", F.when(F.col("n") % 3 == 0, 0.0).otherwise(F.col("total")))
    low = F.struct((F.col("v") <= 0).alias("sin"), F.when(F.col("v") > 0, F.col("v")).otherwise(F.col("total")).alias("x"), F.col("proveedor").alias("o"))
    return b.groupBy("acto").agg(F.min_by("proveedor", low).alias("ganador"), F.min("total").alias("minimo"), F.min_by("proveedor", F.struct("total", "proveedor")).alias("barato"))


Q["q_min_bidder"] = min_bidder
SQL["q_min_bidder"] = f"WITH {BIDS_SQL}, v AS (SELECT *, CASE WHEN n % 3 = 0 THEN 0 ELSE total END AS v FROM bids) SELECT acto, arg_min(proveedor, {{'a': v <= 0, 'b': CASE WHEN v > 0 THEN v ELSE total END, 'c': proveedor}}) AS ganador, min(total) AS minimo, arg_min(proveedor, {{'a': total, 'b': proveedor}}) AS barato FROM v GROUP BY 1"


def suspicious(s, d):
    g = dedup.suspicious_groups(table(s, d, "documents"), ["text"], 2)
    x = table(s, d, "documents").withColumn("t", F.trim("text")).join(g.select(F.col("text").alias("t"), "n"), "t")
    return x.orderBy("doc_id").limit(500).select("doc_id", "n")


Q["q_suspicious_groups"] = suspicious
SQL["q_suspicious_groups"] = "SELECT doc_id, CAST(n AS BIGINT) AS n FROM (SELECT doc_id, count(*) OVER (PARTITION BY trim(text)) AS n FROM documents) WHERE n >= 2 ORDER BY doc_id LIMIT 500"

Q["q_dedup_keyed"] = lambda s, d: dedup.existing_wins(table(s, d, "documents").where("doc_id % 2 = 1").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("text")).alias("k")), table(s, d, "documents").where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("text")).alias("k")), "k", "doc_id").select("doc_id", F.md5("k").alias("k"))
SQL["q_dedup_keyed"] = "WITH x AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END AS k FROM documents) SELECT doc_id, md5(k) AS k FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY 1 - doc_id % 2, doc_id) AS r FROM x) WHERE r = 1 OR k = ''"

Q["q_duplicate_log"] = lambda s, d: dedup.duplicate_log(table(s, d, "documents"), F.col("text"), [F.col("doc_id")], F.struct("doc_id", "lang")).select(F.col("rn").cast("long").alias("rn"), "datos_original", "datos_duplicado")
SQL["q_duplicate_log"] = """WITH x AS (SELECT text, doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' AS j FROM documents), r AS (SELECT row_number() OVER w AS rn, first_value(j) OVER w AS datos_original, j AS datos_duplicado FROM x WINDOW w AS (PARTITION BY text ORDER BY doc_id)) SELECT CAST(rn AS BIGINT) AS rn, datos_original, datos_duplicado FROM r WHERE rn > 1"""


def coalesce_columns(s, d):
    c = catalog(s, d).select("ord", "n", "p", "s", "x", F.when(F.col("n") % 2 == 0, F.col("marca")).otherwise("").alias("Marca"), F.col("modelo").alias("Marca comercial"), F.lit("z").alias("Unnamed: 3"), F.col("pais").alias("Pais"))
    return reshape.canonical_columns(c, {"Marca comercial": "Marca"}).withColumn("Pais", F.when(F.col("n") == "1", F.lower("Pais")).otherwise(F.col("Pais")))


Q["q_coalesce_columns"] = coalesce_columns
SQL["q_coalesce_columns"] = f"""WITH {CATALOG_SQL} SELECT CAST(ord AS VARCHAR) AS ord, CAST(n AS VARCHAR) AS n, CAST(p AS VARCHAR) AS p, CAST(s AS VARCHAR) AS s, CASE WHEN x >= 10000000 THEN '' ELSE CAST(x AS VARCHAR) END AS x, CASE WHEN n % 2 = 0 THEN marca ELSE modelo END AS "Marca", CASE WHEN n = 1 THEN lower(pais) ELSE pais END AS "Pais" FROM catalog"""

Q["q_parent_child"] = lambda s, d: table(s, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("estado")).join(table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("h")), "c_custkey").select("c_custkey", "c_name", F.explode("h").alias("h")).select("c_custkey", "c_name", F.col("h.o_orderkey").alias("acto"), F.col("h.o_orderstatus").alias("estado"))
SQL["q_parent_child"] = "SELECT c_custkey, c_name, o_orderkey AS acto, o_orderstatus AS estado FROM customer JOIN orders ON o_custkey = c_custkey"


def enrich(s, d):
    p = table(s, d, "part")
    t = p.select("p_partkey", F.lower("p_name").alias("k"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(" ").alias("marca"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).alias("tipo"))
    by_key = p.where("p_partkey % 4 = 0").groupBy(F.lower("p_name").alias("k2")).agg(F.min_by(F.struct("p_brand", "p_type"), "p_partkey").alias("a"))
    by_place = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("i"), F.struct("p_brand", "p_type").alias("b"))
    j = t.join(by_key, F.col("k") == F.col("k2"), "left").join(by_place, F.col("p_partkey") == F.col("i"), "left")
    return joins.fill_blanks(j, {"marca": F.col("a.p_brand"), "tipo": F.col("a.p_type")}, {"marca": F.col("b.p_brand"), "tipo": F.col("b.p_type")}, F.col("a").isNotNull()).select("p_partkey", "marca", "tipo")


Q["q_enrich_merge"] = enrich
SQL["q_enrich_merge"] = """WITH a AS (SELECT lower(p_name) AS k, arg_min(p_brand, p_partkey) AS b, arg_min(p_type, p_partkey) AS t FROM part WHERE p_partkey % 4 = 0 GROUP BY 1)
SELECT p.p_partkey, CASE WHEN p.p_partkey % 3 = 0 THEN p.p_brand WHEN a.k IS NOT NULL THEN a.b ELSE q.p_brand END AS marca, CASE WHEN p.p_partkey % 2 = 0 THEN p.p_type WHEN a.k IS NOT NULL THEN a.t ELSE q.p_type END AS tipo
FROM part p LEFT JOIN a ON lower(p.p_name) = a.k LEFT JOIN part q ON q.p_partkey = p.p_partkey AND q.p_partkey % 5 = 0"""

Q["q_required_fields"] = lambda s, d: catalog(s, d).select("ord", "n", "p", "s", F.when(F.col("n") == 1, " ").otherwise(F.col("marca")).alias("marca"), F.when(F.col("ord") % 3 == 0, F.lit(None)).otherwise(F.col("modelo")).alias("modelo"), "pais").withColumn("faltan", F.array_join(reshape.missing_fields(["marca", "modelo", "pais"]), ",")).where("faltan <> ''").groupBy("faltan").agg(F.count("*").alias("n"))
SQL["q_required_fields"] = f"WITH {CATALOG_SQL}, x AS (SELECT concat_ws(',', CASE WHEN n = 1 THEN 'marca' END, CASE WHEN ord % 3 = 0 THEN 'modelo' END) AS faltan FROM catalog) SELECT faltan, CAST(count(*) AS BIGINT) AS n FROM x WHERE faltan <> '' GROUP BY 1"

_CELLS = [["1", "2", "…", "Siguiente"], ["", " "], ["A", "2"], ["10", "1.000"], ["< >", "3 - 4"], ["Nombre", ""], ["1", "Último"], ["PÁGINA", "2"], ["First", "Last"]]
Q["q_pagination_filter"] = lambda s, d: table(s, d, "nation").select("n_nationkey", F.element_at(F.array(*[F.array(*[F.lit(x) for x in r]) for r in _CELLS]), F.col("n_nationkey") % 9 + 1).alias("c")).select("n_nationkey", reshape.is_pager(F.col("c")).alias("v1"), reshape.is_numeric_pager(F.col("c")).alias("v2"))
SQL["q_pagination_filter"] = f"""WITH c AS (SELECT n_nationkey, list_filter(({_CELLS!r})[n_nationkey % 9 + 1], lambda x: trim(x) <> '') AS l FROM nation)
SELECT n_nationkey, len(list_filter(l, lambda x: NOT regexp_full_match(lower(strip_accents(x)), '[0-9 .,;:<>?…-]+|siguiente|anterior|primero|ultimo|pagina'))) = 0 AS v1,
       len(l) > 0 AND len(list_filter(l, lambda x: NOT regexp_full_match(x, '[0-9.… ]*'))) = 0 AS v2 FROM c"""


def catalog_parse(s, d):
    p = table(s, d, "part")
    lines = F.array(F.concat(F.lit("x 0"), (F.col("p_partkey") % 7 + 1).cast("string"), F.lit(") Nombre de Producto: "), "p_name"), F.concat(F.lit("Marca: "), "p_brand"), F.lit("sin dos puntos"), F.concat(F.lit("Marca: "), F.upper("p_type")), F.concat(F.lit("Modelo: "), F.col("p_size").cast("string"), F.lit(":b")))
    x = p.select((F.col("p_partkey") % 100).alias("doc"), F.posexplode(lines).alias("i", "t"), "p_partkey").withColumn("o", F.col("p_partkey") * 10 + F.col("i"))
    x = x.withColumn("t", F.regexp_replace("t", r"^x 0(\d)", "x $1"))
    return cat.records(x, "doc", "o", "t").select("doc", "product", "nombre", F.col("fields")["Marca"].alias("marca"), F.col("fields")["Modelo"].alias("modelo"))


Q["q_catalog_parse"] = catalog_parse
SQL["q_catalog_parse"] = "SELECT p_partkey % 100 AS doc, CAST(p_partkey % 7 + 1 AS INT) AS product, p_name AS nombre, upper(p_type) AS marca, p_size || ':b' AS modelo FROM part"



def _score():
    return (F.col("n") % 2 == 0).cast("int") + (F.col("s") % 3 == 0).cast("int")


Q["q_catalog_best"] = lambda s, d: joins.best_per_key(catalog(s, d), ["ficha", "oferente"], _score(), F.struct("ord", "n", "p", "s", "x"), ["marca", "modelo", "pais"])
_RANK = "row_number() OVER (PARTITION BY {} ORDER BY -(CAST(n % 2 = 0 AS INT) + CAST(s % 3 = 0 AS INT)), ord, n, p, s, x)"
SQL["q_catalog_best"] = f"WITH {CATALOG_SQL} SELECT ficha, oferente, marca, modelo, pais FROM (SELECT *, {_RANK.format('ficha, oferente')} AS r FROM catalog) WHERE r = 1"


def lookup_whole(s, d):
    """Every bid against the whole catalogue; some ask for a code or a provider that it hasn't."""
    c = catalog(s, d)
    both = joins.best_per_key(c, ["ficha", "oferente"], _score(), F.struct("ord", "n", "p", "s", "x"), ["marca", "pais"])
    one = joins.best_per_key(c, ["oferente"], _score(), F.struct("ord", "n", "p", "s", "x"), ["marca", "pais"])
    b = bids(s, d).select("acto", "n", "p", "total", F.when(F.col("n") == 2, F.concat("proveedor", F.lit("?"))).otherwise(F.col("proveedor")).alias("proveedor"), F.when(F.col("n") == 3, "x").otherwise((F.col("p") % 50).cast("string")).alias("f"))
    got = joins.cascade(b, [(both, [("f", "ficha"), ("proveedor", "oferente")]), (one, [("proveedor", "oferente")])], ["marca", "pais"])
    return got.groupBy("step", "marca", "pais").agg(F.count("*").alias("n"))


Q["q_catalog_lookup_exact_whole"] = lookup_whole
SQL["q_catalog_lookup_exact_whole"] = f"""WITH {CATALOG_SQL}, {BIDS_SQL}, q AS (SELECT CASE WHEN n = 2 THEN proveedor || '?' ELSE proveedor END AS o, CASE WHEN n = 3 THEN 'x' ELSE CAST(p % 50 AS VARCHAR) END AS f FROM bids),
a AS (SELECT * FROM (SELECT *, {_RANK.format('ficha, oferente')} AS r FROM catalog) WHERE r = 1), o AS (SELECT * FROM (SELECT *, {_RANK.format('oferente')} AS r FROM catalog) WHERE r = 1)
SELECT CASE WHEN a.r = 1 THEN 1 WHEN o.r = 1 THEN 2 ELSE 0 END AS step, coalesce(a.marca, o.marca, '') AS marca, coalesce(a.pais, o.pais, '') AS pais, CAST(count(*) AS BIGINT) AS n
FROM q LEFT JOIN a ON a.ficha = q.f AND a.oferente = q.o LEFT JOIN o ON o.oferente = q.o GROUP BY 1, 2, 3"""


def lookup_fuzzy(s, d):
    sup = table(s, d, "supplier")
    asked = sup.select(norm_name(F.concat(F.translate("s_name", "1", "l"), F.lit(" sa"))).alias("buscado"))
    known = sup.select(norm_name(F.col("s_name")).alias("oferente"))
    return joins.fuzzy_lookup(asked, known, "buscado", "oferente", 0.75, ("sa", "de")).select("buscado", "oferente", F.round("score", 6).alias("score"))


Q["q_catalog_lookup_fuzzy"] = lookup_fuzzy


def lookup_alias(s, d):
    """Every bid against the whole catalogue by all steps, under its provider's name and then its aliases; a few providers are misspelt or known by an alias only."""
    c = catalog(s, d).withColumn("seq", F.struct("ord", "n", "p", "s", "x"))
    k = F.substring_index("proveedor", "#", -1).cast("int")
    name = F.when(k <= 4, F.concat(F.translate("proveedor", "0", "o"), F.lit(" S.A."))).when(k <= 8, F.concat(F.lit("Grupo "), F.col("acto") % 3)).otherwise(F.col("proveedor"))
    b = bids(s, d).select("acto", (F.col("p") % 50).cast("string").alias("f"), name.alias("o"), F.array(F.lit(" "), F.when(k <= 8, F.col("proveedor")), F.lit("Grupo 0")).alias("alias"))
    got = joins.catalog_lookup(b, c, "f", "o", "alias", "ficha", "oferente", "seq", ["marca", "modelo", "pais"])
    return got.groupBy("f", "o", "step", "via", "marca", "modelo", "pais").agg(F.count("*").alias("n"))


Q["q_catalog_lookup_alias"] = lookup_alias


def dead_letter(s, d):
    """Every act in a round trip through JSON texts: rejected rows come back as rows, those still rejected stay."""
    from lakesieve.sources.tables import replay

    a = acts(s, d).select(F.to_json(F.struct(F.lit("2025").alias("ts"), F.col("entidad").alias("sheet"), F.array(F.array(F.col("id").cast("string"), "titulo"), F.array(F.lit("x"))).alias("rows"), F.lit("error").alias("reason"))).alias("j"))
    letters = a.select(F.from_json("j", "ts string, sheet string, rows array<array<string>>, reason string").alias("l")).select("l.*")
    ok, stay = replay(letters, F.col("sheet") < "J")
    return ok.select("sheet", "n", F.array_join("row", "|").alias("fila")).unionByName(stay.select("sheet", F.lit(-1).alias("n"), F.array_join(F.get("rows", F.lit(0)), "|").alias("fila")))


Q["q_dead_letter_whole"] = dead_letter
SQL["q_dead_letter_whole"] = f"WITH {ACTS_SQL} SELECT entidad AS sheet, 0 AS n, id || '|' || titulo AS fila FROM acts WHERE entidad < 'J' UNION ALL SELECT entidad, 1, 'x' FROM acts WHERE entidad < 'J' UNION ALL SELECT entidad, -1, id || '|' || titulo FROM acts WHERE entidad >= 'J'"


def upsert_windows(s, d):
    """Change of a table's first rows from page to page, by the signature before."""
    w = W.partitionBy("conv_id").orderBy("turn")
    c = table(s, d, "conversations").withColumn("firma", F.md5("text"))
    return c.select("conv_id", "turn", F.coalesce(F.lag("firma").over(w) == F.col("firma"), F.lit(False)).alias("igual"))


Q["q_table_signature"] = upsert_windows
SQL["q_table_signature"] = "SELECT conv_id, turn, coalesce(lag(md5(text)) OVER (PARTITION BY conv_id ORDER BY turn) = md5(text), false) AS igual FROM conversations"

_ALIASES = {"n registro sanitario": "Registro", "marca": "Marca", "pais origen": "Pais"}


def cell_values(s, d):
    c = catalog(s, d).select("ord", "n", "p", "s", F.when(F.col("n") % 3 == 0, F.array(F.lit("País"), F.lit("Origen"), F.col("pais"))).when(F.col("n") % 3 == 1, F.array(F.lit("MARCA."), F.col("marca"), F.col("modelo"))).otherwise(F.array(F.lit("otro"), F.col("marca"))).alias("l"), F.concat(F.lit("Marca= "), "marca").alias("h"))
    kv = cat.cell_key_value(F.col("l"), _ALIASES)
    return c.select(F.coalesce(kv["key"], F.lit("-")).alias("clave"), F.coalesce(kv["value"], F.lit("-")).alias("valor"), cat.header_of(F.col("h"), _ALIASES).alias("cab")).groupBy("clave", "valor", "cab").agg(F.count("*").alias("n"))


Q["q_cell_values"] = cell_values
SQL["q_cell_values"] = f"WITH {CATALOG_SQL} SELECT CASE n % 3 WHEN 0 THEN 'Pais' WHEN 1 THEN 'Marca' ELSE '-' END AS clave, CASE n % 3 WHEN 0 THEN pais WHEN 1 THEN marca || ' ' || modelo ELSE '-' END AS valor, 'Marca' AS cab, CAST(count(*) AS BIGINT) AS n FROM catalog GROUP BY 1, 2, 3"


def complete(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("doc"), cat.declared_total(F.concat(F.lit("Total de Productos: "), (F.col("o_orderkey") % 6).cast("string"))).alias("esperados"))
    return cat.completeness(table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc")), o, "doc").groupBy("razon").agg(F.count("*").alias("n"))


Q["q_completeness"] = complete
SQL["q_completeness"] = "WITH x AS (SELECT o_orderkey % 6 AS e, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS g FROM orders) SELECT CASE WHEN g = 0 THEN 'vacio' WHEN g < e THEN 'incompleto' ELSE 'sobran' END AS razon, CAST(count(*) AS BIGINT) AS n FROM x WHERE e <> g GROUP BY 1"


def bid_pairs(s, d):
    b = bids(s, d).groupBy("acto").agg(F.sort_array(F.collect_list(F.struct("n", "p", "proveedor", "total"))).alias("b"))
    names, prices = F.transform("b", lambda x: F.when(x["n"] == 2, " ").otherwise(x["proveedor"])), F.slice(F.transform("b", lambda x: x["n"].cast("string")), 1, 3)
    z = reshape.zip_pairs(names, prices, "nombre", "precio")
    real = reshape.is_real_row(F.transform(z, lambda x: x["nombre"]))
    return b.select("acto", F.array_join(F.transform(z, lambda x: F.concat(x["nombre"], F.lit("="), x["precio"])), ";").alias("pares"), real.alias("real"), F.coalesce(reshape.is_excluded(F.get(names, F.lit(0)), ["supplier#00000001"]), F.lit(False)).alias("fuera"))


Q["q_bid_pairs"] = bid_pairs
SQL["q_bid_pairs"] = f"""WITH {BIDS_SQL}, x AS (SELECT acto, list({{'n': CASE WHEN n = 2 THEN '' ELSE proveedor END, 'v': CAST(n AS VARCHAR)}} ORDER BY n, p, proveedor, total) AS l FROM bids GROUP BY 1),
z AS (SELECT acto, l, list_filter(list_transform(l, lambda y, i: {{'n': y.n, 'v': CASE WHEN i <= 3 THEN y.v ELSE '' END}}), lambda y: y.n <> '') AS z FROM x)
SELECT acto, array_to_string(list_transform(z, lambda y: y.n || '=' || y.v), ';') AS pares, len(z) > 0 AS real, contains(upper(l[1].n), 'SUPPLIER#00000001') AS fuera FROM z"""
