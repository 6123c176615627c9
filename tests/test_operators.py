"""Relational operators on a few rows."""

from pyspark.sql import functions as F

from lakesieve.operators import catalog, dedup, detect, joins, reshape, rules
from lakesieve.sources import tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_anti_join_by_either_key(spark):
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", ""), (3, "c", None), (4, "d", "y")], "id int, u string, k string")
    known = spark.createDataFrame([("a", ""), ("z", "y"), ("q", None)], "u string, k string")
    assert [r[0] for r in rows(joins.not_known(new, known, "u", "k"), "id")] == [2, 3]
    plan = joins.not_known(new, known, "u", "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_move_twice_is_move_once(spark):
    a = spark.createDataFrame([(1, "k", " true"), (2, "k", "TRUE"), (3, "m", "")], "id int, k string, f string")
    b = spark.createDataFrame([(4, "k", "TRUE"), (5, "n", "TRUE")], "id int, k string, f string")
    target = spark.createDataFrame([("n",)], "k string")
    moved, left = joins.move([a, b], target, "f", "k", "id")
    assert [r[0] for r in rows(moved.select("id"), "id")] == [1]
    assert [x.count() for x in left] == [1, 0]
    again, _ = joins.move([a, b], target.unionByName(moved.select("k")), "f", "k", "id")
    assert again.isEmpty()


def test_upsert_is_idempotent_and_adds_columns(spark, tmp_path):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, "x"), ("c", 4, None)], "k string, v int, w string")
    at = str(tmp_path / "t")
    tables.upsert_table(old, at, "k")
    for _ in range(2):
        tables.upsert_table(new, at, "k")
        assert rows(spark.read.parquet(at), "k") == [("a", 1, None), ("b", 3, "x"), ("c", 4, None)]


def test_replace_key(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.partitionBy("k").parquet(at)
    tables.replace_key(spark.createDataFrame([("b", 9)], "k string, v int"), at, "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(at).collect()) == [("a", 1), ("b", 9)]


def test_dead_letters(spark, tmp_path):
    at = str(tmp_path / "dlq")
    tables.write_dead_letters(spark.createDataFrame([("t", "s", [["a"], ["b"]], "r" * 600)], "ts string, sheet string, rows array<array<string>>, reason string"), at)
    (tmp_path / "dlq" / "bad.json").write_text("not json\n\n")
    got = tables.read_dead_letters(spark, at)
    assert [(r.sheet, len(r.reason)) for r in got.collect()] == [("s", 500)]
    ok, stay = tables.replay(got, F.col("sheet") == "s")
    assert ok.count() == 2 and stay.isEmpty()


def test_lists_pages_and_results(spark, tmp_path):
    (tmp_path / "l.csv").write_text("Ácido\nDos Palabras\nde\nácido\n")
    assert rows(tables.read_words(spark, str(tmp_path / "l.csv"), ("de",)), "value") == [("acido",)]
    for i, t in enumerate(("a,b\n1,2\n", "a,c\n3,4\n")):
        (tmp_path / f"p{i}.csv").write_text(t)
    got = tables.read_pages(spark, [str(tmp_path / "p0.csv"), str(tmp_path / "p1.csv")])
    assert [(r.a, r.b, r.c, r.pagina) for r in got.orderBy("pagina").collect()] == [("1", "2", None, 1), ("3", None, "4", 2)]
    (tmp_path / "log").write_text("x\nRESULT_JSON={1}\ny\nRESULT_JSON={2}\n")
    assert tables.last_result(spark, str(tmp_path / "log")).first()[0] == "{2}"


def test_first_by_keeps_blank_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, None)], "i int, k string")
    assert [r[0] for r in rows(dedup.first_by(df, F.col("k"), [F.col("i")], blank_is_unique=True), "i")] == [1, 3, 4]


def test_reshape(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "x array<string>")
    assert reshape.width_of(df, "x") == 2
    assert sorted(tuple(r)[1:] for r in reshape.wide(df, "x", "item_", 2).collect()) == [("", ""), ("", ""), ("a", "b")]
    c = spark.createDataFrame([("", "y", "u")], ["A", "B", "Unnamed: 1"])
    assert reshape.canonical_columns(c, {"B": "A"}).collect()[0].asDict() == {"A": "y"}
    assert reshape.pick_column(["Nº Ficha", "Ficha Técnica"], ["no ficha"], ["ficha"], ["no"]) == "Nº Ficha"
    assert reshape.header_union(["a", "B"], ["b", "c"]) == ["a", "B", "c"]


def test_detection(spark):
    texts = spark.createDataFrame([(1, "ref 123, 12a y é12 Guantes de Látex"), (2, "alambres"), (3, None)], "id long, t string")
    words = spark.createDataFrame([("F-0123", "x", 1), ("12", "Guantes de látex", 2), ("9", "alamb...", 3), ("9", "nada", 4)], "c string, n string, s long")
    got = {r.id: r.label for r in detect.tokens(texts, words, "id", "t", "c", "n", "s").collect()}
    assert got == {1: "12, 123", 2: "* 9", 3: "No Detectada"}


def test_rules(spark):
    df = spark.createDataFrame([(500.0, None, ["1"]), (None, "gasa", ["1"]), (5000.0, None, ["3"]), (5000.0, None, ["3", "5"])], "p double, w string, c array<string>")
    reason = rules.discard_reason(F.col("p"), F.col("w"), F.col("c"), F.array(F.lit("3")), F.array(F.lit("5")))
    assert [r[0] for r in df.select(reason).collect()] == ["precio", "med:gasa", "RS", ""]


def test_records_go_on_over_pages(spark):
    lines = ["intro", "1) Nombre de Producto: Gasa", "Marca: A", "Marca: B:c", "2) Nombre de Producto = Hilo"]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)], "doc string, i int, t string")
    assert [(r.product, r.nombre, r.fields) for r in catalog.records(df, "doc", "i", "t").orderBy("product").collect()] == [(1, "Gasa", {"Marca": "B:c"}), (2, "Hilo", None)]


def test_fuzzy_lookup_finds_names_without_a_shared_word(spark):
    a = spark.createDataFrame([("laboratorios acme",), ("zzz",)], "a string")
    b = spark.createDataFrame([("laboratorio acmes",), ("otro",)], "b string")
    got = [tuple(r)[:2] for r in joins.fuzzy_lookup(a, b, "a", "b", 0.75).collect()]
    assert got == [("laboratorios acme", "laboratorio acmes")]
