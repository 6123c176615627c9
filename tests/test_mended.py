"""White space of all kinds, entities, pagers, keyed tables, plans: what equal oracles would not show."""

import re

import pytest
from pyspark.sql import functions as F

from lakesieve.functions import dates, html, text, url
from lakesieve.operators import detect, joins, reshape
from lakesieve.sources import tables
from lakesieve.streaming import requests as rq


def one(spark, column, value=None):
    return spark.createDataFrame([(value,)], "c string").select(column).first()[0]


@pytest.mark.parametrize(("given", "want"), [("\tFoo  bár \n", "foo bar"), (None, ""), ("\x1c　", ""), (" A B ", "a b")])
def test_white_space(spark, given, want):
    assert one(spark, text.norm_txt(F.col("c")), given) == want


def test_clean(spark):
    for given, want in (("  x\t", "x"), (" NaN ", ""), ("<NA>", ""), ("none\n", ""), ("nano", "nano"), (None, "")):
        assert one(spark, text.clean(F.col("c")), given) == want


def test_lines_and_cells(spark):
    page = "<h1>Licitaci&oacute;n&nbsp;&#241;&#x41;</h1><script>if (a<b) '</p>'</script><p>a<b>b</b><!-- x --> c<br/>d</p>  <style>p{}</style>&lt;p&gt;"
    assert one(spark, html.lines(F.col("c")), page) == ["Licitación ñA", "a b c", "d", "<p>"]
    assert one(spark, html.lines(F.col("c"))) == [] and one(spark, html.unescape(F.col("c"))) is None
    assert one(spark, html.cell_value(F.col("c")), '<input value=" "><input VALUE = "a &lt; b">') == "a < b"
    assert one(spark, html.cell_value(F.col("c")), "<textarea>\n x <i>y</i></textarea>") == "x y"
    assert one(spark, html.cell_value(F.col("c"))) == ""


def test_pager(spark):
    rows = {("1", "Último"): True, ("Página", "2"): True, ("First", "Last"): False, ("", None): True, ("…", "?"): True, ("A", "1"): False}
    for cells, want in rows.items():
        assert spark.range(1).select(reshape.is_pager(F.array(*[F.lit(x).cast("string") for x in cells]))).first()[0] == want, cells


def test_upsert_keeps_what_is_not_mapped(spark):
    old = spark.createDataFrame([(1, "t", 5.0), (2, "u", 6.0), (None, "n", 1.0)], "id int, titulo string, precio double")
    new = spark.createDataFrame([(1, "T2", 1), (1, "T3", 2), (3, None, 1), (None, "N", 1)], "id int, titulo string, v int")
    got = {tuple(r) for r in joins.upsert(old, new, "id", ["v"]).collect()}
    assert got == {(1, "T3", 5.0), (2, "u", 6.0), (3, None, None), (None, "N", 1.0)}
    assert joins.upsert(old, new.limit(0), "id", ["v"]).count() == 3 and joins.upsert(old.limit(0), new, "id", ["v"]).count() == 3


def test_append_takes_earlier_rows_of_the_batch_into_account(spark):
    old = spark.createDataFrame([("a", "1")], "k1 string, k2 string")
    new = spark.createDataFrame([(1, "a", "9"), (2, "b", "2"), (3, "c", "2"), (4, "c", "3"), (5, None, ""), (6, "", None), (7, "d", "3"), (8, "d", "4")], "o int, k1 string, k2 string")
    known, want = ({"a"}, {"1"}), []
    for r in new.orderBy("o").collect():
        mine = [(i, k) for i, k in enumerate((r.k1, r.k2)) if k]
        if all(k not in known[i] for i, k in mine):
            want.append(r.o)
            for i, k in mine:
                known[i].add(k)
    assert sorted(r.o for r in joins.append_new(old, new.repartition(3), "o", "k1", "k2").collect()) == want == [2, 4, 5, 6, 8]


def test_replace_key_with_nothing(spark, tmp_path):
    at = f"{tmp_path}/t"
    spark.createDataFrame([(1, "a"), (2, "b c"), (3, "d")], "v int, k string").write.partitionBy("k").parquet(at)
    tables.replace_key(spark.createDataFrame([(9, "a")], "v int, k string"), at, "k", ["a", "b c"])
    assert {(r.v, r.k) for r in spark.read.parquet(at).collect()} == {(9, "a"), (3, "d")}


def test_swap_reads_what_it_replaces(spark, tmp_path):
    at = f"{tmp_path}/t"
    spark.range(5).write.parquet(at)
    tables.swap(spark.read.parquet(at).where("id > 2"), at)
    assert spark.read.parquet(at).count() == 2


def test_chunks(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("x").alias("t"))
    got = tables.append_chunks(rows, f"{tmp_path}/t", "id", accepts=F.col("id") != 500, chunk=100, letters=f"{tmp_path}/l", sheet="s").first()
    kept = {r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()}
    back, _ = tables.replay(tables.read_dead_letters(spark, f"{tmp_path}/l"))
    again = {int(r.row[0]) for r in back.collect()}
    assert got.ok == len(kept) and got.failed == len(again) and 500 in again and kept | again == set(range(1000)) and len(again) <= 100


def test_names_in_long_texts(spark):
    names = spark.createDataFrame([("guante", "1", False, 1), ("guante de latex", "2", False, 2), ("jeringa de plas", "3", True, 3), ("guan", "4", True, 4)], "nombre string, ficha string, truncado boolean, ord int")
    texts = spark.createDataFrame([(1, "x " * 3000 + "Guante de látex"), (2, "la jeringa de plástico"), (3, "guantes"), (4, None), (5, ""), (6, "jeringa de")], "id int, t string")
    got = {(r.id, r.ficha) for r in detect.names_in(texts, names, "id", "t").collect()}
    assert got == {(1, "1"), (1, "2"), (1, "4"), (2, "3"), (3, "4")}


def test_plans_stay_small(spark):
    df = spark.createDataFrame([("x",)], "c string")
    for column, most in ((url.normalize_url(F.col("c"), drop_token=True), 40), (url.act_key(F.col("c")), 40), (dates.deadline(F.col("c")), 40)):
        plan = df.select(column)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("regexp_", plan)) <= most


def test_config_changes_and_sources(spark, tmp_path):
    config = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    _, mark = rq.changed(config, None)
    assert rq.changed(config.orderBy(F.desc("n")), mark) == (False, mark) and rq.changed(config.limit(1), mark)[0]
    assert tables.read_config(spark, "name string, n int", config.limit(0), f"{tmp_path}/no", [("z", 0)]).first().name == "z"


def test_labels():
    assert reshape.canonical_label("PaÃ­s::Nombre ", {"Nom": "nom"}) == "nombre" and reshape.canonical_label("日本", {}) == "日本"
