import pytest
from pyspark.sql import functions as F

from marlstone.functions import amounts, text
from marlstone.sources import dictionaries


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_money_rounds_halves_away_from_zero(spark):
    rows = [(280000.0,), (2.5,), (-2.5,), (0.0,), (None,), (999.4,)]
    got = [r[0] for r in one(spark, rows, "v double", text.money(F.col("v")))]
    assert got == ["$280,000", "$3", "-$3", "$0", None, "$999"]
    assert [r[0] for r in one(spark, rows, "v double", text.money_or_null(F.col("v")))][3:5] == [None, None]


def test_kilometres(spark):
    rows = [(12500.0,), (None,), (1.5,), (0.0,)]
    assert [r[0] for r in one(spark, rows, "v double", text.kilometres(F.col("v")))] == ["12,500 km", "No disponible", "1.5 km", "0 km"]


def test_title_and_link_fall_back(spark):
    rows = [("", "A", None, 2020, "", "s"), (None, "A", "B", None, None, None), ("T", "A", "B", 1, "u", "s")]
    got = one(spark, rows, "t string, m string, o string, y int, l string, s string", text.title(*map(F.col, "tmoy")), text.link(F.col("l"), F.col("s"), "b/"))
    assert got == [("A 2020", "b/s"), ("A B", None), ("T", "u")]


def test_tokens_split_on_any_space(spark):
    got = one(spark, [("Qué es la garantía?",), ("ab abc  ABCD",), ("",)], "q string", text.tokens(F.col("q")))
    assert got == [(["qué", "garantía?"],), (["abc", "abcd"],), ([],)]


def test_contains_takes_wildcards_literally(spark):
    rows = [("100% A_b\\c",), ("1000 Axb",), (None,)]
    for term, expected in (("%", [True, False, None]), ("a_B", [True, False, None]), ("b\\", [True, False, None]), ("", [True, True, None])):
        assert [r[0] for r in one(spark, rows, "v string", text.contains_ci(F.col("v"), term))] == expected
    assert [r[0] for r in one(spark, rows, "v string", text.contains_ci(F.col("v"), "a_b", raw_pattern=True))] == [True, True, None]


@pytest.mark.parametrize("given, value, changed", [(280.0, 280000.0, True), (999.99, 999990.0, True), (1000.0, 1000.0, False), (0.0, 0.0, True)])
def test_prices_in_thousands(spark, given, value, changed):
    assert one(spark, [(given,)], "v double", amounts.price_detail(F.col("v")))[0][0] == (value, changed)
    assert amounts.full_price_value(given) == value


def test_down_payments(spark):
    got = [tuple(r[0]) for r in one(spark, [(20.0,), (100.0,), (101.0,), (50000.0,)], "v double", amounts.down_payment_detail(F.col("v")))]
    assert got == [(20.0, True, False), (100.0, True, False), (101000.0, False, True), (50000.0, False, False)]


def test_quote_by_hand(spark):
    parts = amounts.quote(F.col("p"), F.col("d"), F.col("m"), F.col("r"))
    rows = [(10000.0, 0.0, 48, 15.0), (12000.0, 0.0, 12, 0.0), (10000.0, 20.0, 0, 15.0), (10000.0, 100.0, 48, 15.0)]
    got = one(spark, rows, "p double, d double, m int, r double", *parts.values())
    assert got[0][2] == pytest.approx(278.3074826647632)
    assert got[1][2] == 1000.0 and got[1][4] == 0.0
    assert got[2][2] is None and got[3][2] == 0.0


def test_half_up(spark):
    assert [r[0] for r in one(spark, [(2.5,), (-2.5,), (1.4,)], "v double", amounts.half_up(F.col("v")))] == [3, -2, 1]


def test_percent_and_corrections(spark):
    assert one(spark, [(15.0, None, "x"), (12.5, "y", "x")], "r double, a string, b string", text.percent(F.col("r")), text.corrections(F.col("a"), F.col("b"))) == [("15%", ["x"]), ("12.5%", ["y", "x"])]


def test_dictionaries():
    brands, models = dictionaries.by_form(dictionaries.BRANDS), dictionaries.by_form(dictionaries.MODELS)
    assert (len(brands), len(set(brands.values()))) == (118, 32)
    assert (len(models), len(set(models.values()))) == (191, 91)
    assert brands["toyota"] == "Toyota" and models["x trail"] == "X-Trail"
