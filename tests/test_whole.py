"""Whole jobs: nothing is left out of what a query or an operator is given."""

from lakesieve.functions.similarity import name_score
from lakesieve.operators import catalog, joins
from lakesieve.plans import catalogue
from lakesieve.sources.html_tables import table_rows

DATA = "/root/testdata/sf0.001"


def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet").count()


def test_html_tables_reads_every_act(spark):
    assert catalogue.queries()["q_html_tables_whole"](spark, DATA).select("id").distinct().count() == orders(spark)


def test_unit_data(spark):
    head = "<tr><th>Descripción</th><th>Precio Unitario</th><th>Precio Referencia</th><th>Cantidad</th><th>Unidad de Medida</th></tr>"
    row = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    table = lambda *r: f"<table>{head}{''.join(r)}</table>"
    other = "<table><tr><th>Cantidad</th></tr><tr><td>99</td></tr></table>"
    pages = [
        (1, "A-7", table(row("x", "5", "10", "2", "caja"), row("art. a-7", "6", "30", "3", "bolsa"), row("A-7", "8", "8", "8", "z"))),
        (2, "A-7", other + table(row("x", "B/. 1,234.50", "10", "0", "")) + table(row("A-7", "9", "4", "2", "caja"))),
        (3, "A-7", table(row("A-7", "-", "0", "0", "")) + table(row("x", "3"))),
        (4, "A-7", other),
        (5, "", table(row("x", "5", "0", "1", "u"), row("", "6", "1", "1", "v"))),
        (6, "A-7", table(row("x", "-3", "0", "0", "nan")) + table(row("x", "-2", "0", "0", "u"))),
        (7, None, table(row("x", "5", "8", "2", "u"))),
    ]
    df = spark.createDataFrame(pages, "id long, code string, html string")
    got = catalog.unit_data(table_rows(df, "id", "html"), df, "id", "code")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 6.0, 10.0, 3.0, "bolsa"), (2, 1234.5, 10.0, 2.0, "caja"), (3, 3.0, 0.0, 0.0, ""), (4, 0.0, 0.0, 0.0, ""), (5, 5.0, 0.0, 1.0, "u"), (6, -2.0, 0.0, 0.0, "u"), (7, 5.0, 4.0, 2.0, "u")]


def test_dead_letters_of_every_act(spark):
    got = catalogue.queries()["q_dead_letter_whole"](spark, DATA)
    assert got.where("n <> 1").count() == orders(spark) and got.where("n = 1").count() == got.where("n = 0").count()


def brute_lookup(cat, code, name, aliases):
    """The reference's lookup, record by record."""
    def one(p):
        for hit in ({(c, n): k for c, n, k in best(lambda r: (r[0], r[1]))}, ):
            if (code, p) in hit or ("", p) in hit:
                return (1, hit[code, p]) if (code, p) in hit else (2, hit["", p])
            if code and (near := top([(n, k) for (c, n), k in hit.items() if c == code], p, 0.5)):
                return 3, near
        names = {n: k for _, n, k in best(lambda r: r[1])}
        return (4, names[p]) if p in names else (5, far) if (far := top(list(names.items()), p, 0.75)) else (0, ("", ""))

    def best(key):
        out = {}
        for r in cat:
            if key(r) not in out or sum(map(bool, r[2])) > sum(map(bool, out[key(r)][2])):
                out[key(r)] = r
        return list(out.values())

    def top(known, p, least):
        scores = [name_score(p, n, joins.STOP) for n, _ in known]
        return known[scores.index(max(scores))][1] if scores and max(scores) >= least else None

    first = one(name)
    if not any(first[1]):
        for a in aliases:
            if a and any((got := one(a))[1]):
                return got[0], a, got[1]
    return first[0], "", first[1]


def test_catalog_lookup_is_the_references(spark):
    cat = [
        ("12", "acme medica", ("A", "")), ("12", "acme salud norte", ("B", "")), ("12", "beta", ("", "")), ("13", "acme medica", ("C", "x")),
        ("", "sin ficha", ("D", "")), ("13", "gamma laboratorios", ("E", "")), ("13", "delta uno", ("F", "")), ("12", "delta dos", ("", "")), ("14", "acme medica", ("", "")),
        ("14", "delta dos", ("G", "y")), ("12", "acme medica", ("A2", "z")),
    ]
    asked = [
        ("12", "acme medica", []), ("14", "acme medica", ["gamma laboratorios"]), ("99", "sin ficha", []), ("12", "acme sur", []), ("12", "gamma laboratorios", []),
        ("99", "gamma laboratorio", []), ("12", "nadie", ["", "otro", "beta", "delta uno"]), ("12", "beta", ["nadie", "acme medica"]), ("", "acme medica", []),
        ("99", "delta", []), ("99", "acme", []), ("12", "nadie", ["tampoco"]), ("13", "delta", []), ("99", "nadie", ["gamma laboratorios", "acme medica"]),
    ]
    known = spark.createDataFrame([(i, c, n.upper(), *f) for i, (c, n, f) in enumerate(cat)], "i int, c string, n string, m string, p string")
    df = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "id int, f string, o string, alias array<string>")
    got = joins.catalog_lookup(df, known, "f", "o", "alias", "c", "n", "i", ["m", "p"]).orderBy("id").collect()
    assert [(r.step, r.via, (r.m, r.p)) for r in got] == [brute_lookup(cat, *a) for a in asked]
    assert {r.step for r in got} == {0, 1, 2, 3, 4, 5} and any(r.via for r in got)


def test_catalog_lookup_knows_every_provider(spark):
    got = catalogue.queries()["q_catalog_lookup_exact_whole"](spark, DATA)
    bids = spark.read.parquet(f"{DATA}/lineitem.parquet")
    steps = {r.step: r.n for r in got.groupBy("step").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    # the whole catalogue holds all bids, so only altered keys are missed
    assert steps == {0: bids.where("l_linenumber = 2").count(), 1: bids.where("l_linenumber not in (2, 3)").count(), 2: bids.where("l_linenumber = 3").count()}


def test_acts_for_a_code_are_all(spark):
    from lakesieve.plans.operations import acts_for

    ids = [r[0] for r in spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey").collect()]
    want = sorted((i for i in ids if "12" in f"{i}, {i + 1}"), reverse=True)
    assert len(want) > 50 and [r.id for r in acts_for(spark, DATA, "12").collect()] == want


def test_cell_value_has_all_lines(spark):
    from pyspark.sql import functions as F

    lines = [str(i) for i in range(2500)]
    df = spark.createDataFrame([(["Marca", *lines],), (["Marca"],), (["País", "Origen", "x"],), (["nada"],)], "l array<string>")
    got = [r.kv and tuple(r.kv) for r in df.select(catalog.cell_key_value(F.col("l"), {"marca": "Marca", "pais origen": "Pais"}).alias("kv")).collect()]
    assert got == [("Marca", " ".join(lines)), ("Marca", ""), ("Pais", "x"), None]
