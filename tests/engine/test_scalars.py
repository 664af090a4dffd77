"""Truth tables of the scalar functions and criteria."""

import pytest
from pyspark.sql import functions as F

from cellspark.functions import criteria as cr
from cellspark.functions import scalars as sc


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def num(x):
    return F.lit(x).cast("double")


def val(x):
    if x is None:
        return sc.cell()
    return sc.cell(txt=F.lit(x)) if isinstance(x, str) else sc.cell(num=F.lit(float(x)))


@pytest.mark.parametrize(
    ("x", "digits", "want"),
    [(1.005, 2, 1.01), (-1.005, 2, -1.01), (2.675, 2, 2.68), (21.049999999999997, 1, 21.1), (6.5, 0, 7.0), (-6.5, 0, -7.0), (1.2345, 2, 1.23), (None, 1, None), (1234.5, -2, 1200.0)],
)
def test_round(spark, x, digits, want):
    assert one(spark, sc.round_half_away(num(x), digits)) == want


@pytest.mark.parametrize(("x", "decimals", "group", "want"), [(-1234567.44, 1, True, "-1,234,567.4"), (4205, 0, True, "4,205"), (25839, 0, False, "25839"), (1.005, 2, False, "1.01"), (-0.0049, 2, False, "0.00"), (None, 0, False, "0"), (2.5, 0, False, "3")])
def test_text(spark, x, decimals, group, want):
    assert one(spark, sc.text_fixed(num(x), decimals, group)) == want


@pytest.mark.parametrize(("x", "digits", "want"), [(1e19, 0, 1e19), (1e19, 2, 1e19), (-1e300, 1, -1e300), (2.0**53, 0, 9007199254740990.0), (123456789012345.6, 0, 123456789012346.0)])
def test_round_large(spark, x, digits, want):
    assert one(spark, sc.round_half_away(num(x), digits)) == want


def test_large_quotients(spark):
    assert one(spark, sc.quotient(num(1e21), num(3.0))) == 1e21 / 3 and one(spark, sc.quotient(num(-1e21), num(1.0))) == -1e21
    assert one(spark, sc.modulo(num(1e21), num(7.0))) == 1e21 - 7.0 * (1e21 / 7.0)
    assert one(spark, sc.text_fixed(num(1e19), 1, True)) == "10,000,000,000,000,000,000.0"
    assert one(spark, sc.text_fixed(num(-0.04), 1, True)) == "0.0" and one(spark, sc.text_fixed(num(-0.5), 1)) == "-0.5"


@pytest.mark.parametrize(("x", "want"), [(1e20, "100000000000000000000"), (1e21, "1e+21"), (-1.25e22, "-1.25e+22"), (1e-20, "1e-20"), (1.5e-7, "1.5e-7"), (0.000001234567890123456, "0.00000123456789012346"), (1e-6, "0.000001"), (123456789012345680000.0, "123456789012346000000"), (0.0, "0"), (-0.0, "0"), (1e300, "1e+300"), (1234567890123456.0, "1234567890123460"), (-0.5, "-0.5"), (float("nan"), None)])
def test_general_numbers_of_all_sizes(spark, x, want):
    assert one(spark, sc.general_number(num(x))) == want


def test_needles_with_patterns_are_errors(spark):
    assert one(spark, sc.literal_needle(F.lit("5~~9인"))) == "5~9인" and one(spark, sc.literal_needle(F.lit("a~b"))) == "a~b"
    assert one(spark, sc.literal_needle(F.lit("a*"))) is None and one(spark, sc.literal_needle(F.lit("~?"))) is None


def test_arithmetic(spark):
    assert one(spark, sc.quotient(num(187.0), num(12.0))) == 15
    assert one(spark, sc.quotient(num(-187.0), num(12.0))) == -15
    assert one(spark, sc.modulo(num(187.0), num(12.0))) == 7
    assert one(spark, sc.modulo(num(7.0), num(-3.0))) == -2
    assert one(spark, sc.modulo(num(1.0), num(0.0))) is None
    assert one(spark, sc.divide(num(1.0), num(0.0))) is None
    assert one(spark, sc.divide(num(60.0), sc.percent(num(125.0)))) == 48


def test_texts(spark):
    assert one(spark, sc.concat(val(2021), val("년"))) == "2021년"
    assert one(spark, sc.concat(val(21.049999999999997), val("%"))) == "21.05%"
    assert one(spark, sc.concat(sc.cell(num=sc.divide(num(1.0), num(0.0))), val("년"))) is None
    assert one(spark, sc.general_number(num(0.1 + 0.2))) == "0.3"
    assert one(spark, sc.general_number(num(100.0))) == "100"
    assert one(spark, sc.find(F.lit("_"), F.lit("a_b"))) == 2
    assert one(spark, sc.find(F.lit("_"), F.lit("abc"))) is None
    assert one(spark, sc.left(F.lit("294,525(70.6)"), num(7.0))) == "294,525"
    assert one(spark, sc.left(F.lit("abc"), num(-1.0))) is None
    assert one(spark, sc.right(F.lit("2025년"), num(2.0))) == "5년"
    assert one(spark, sc.right(F.lit("abc"), num(0.0))) == ""
    assert one(spark, sc.substitute(F.lit("a-b-c"), F.lit("-"), F.lit("+"))) == "a+b+c"
    assert one(spark, sc.substitute(F.lit("abc"), F.lit(""), F.lit("+"))) == "abc"
    assert one(spark, sc.unescape(F.lit("5~*3~?~~"))) == "5*3?~"
    assert one(spark, sc.has_wildcard(F.lit("a~*"))) is False
    assert one(spark, sc.has_wildcard(F.lit("a*"))) is True
    assert one(spark, sc.ascii_fold(F.lit("ABÉ"))) == "abÉ"


@pytest.mark.parametrize(("s", "want"), [(" 1,234.5 ", 1234.5), ("12%", 0.12), ("", None), ("x", None), ("12d", None), ("-3", -3.0)])
def test_number_value(spark, s, want):
    assert one(spark, sc.number_value(F.lit(s))) == want


@pytest.mark.parametrize(("s", "number", "prefix"), [("", 0.0, 0.0), ("12", 12.0, 12.0), ("12abc", None, 12.0), ("abc", None, 0.0), ("1e3", 1000.0, 1000.0), ("Infinity", None, 0.0), (" 7 ", 7.0, 7.0)])
def test_texts_as_numbers(spark, s, number, prefix):
    assert one(spark, sc.text_number(F.lit(s))) == number
    assert one(spark, sc.number_prefix(F.lit(s))) == prefix


def test_logic(spark):
    assert [one(spark, sc.truthy(val(x))) for x in (1, 0, "a", "", None)] == [True, False, True, False, False]
    assert [one(spark, sc.is_number(val(x))) for x in (1, "1", None)] == [1, 0, 0]
    assert one(spark, sc.all_of(val(1), val("x"))) == 1 and one(spark, sc.all_of(val(1), val(None))) == 0
    assert [one(spark, sc.compare(val(a), op, val(b))) for a, op, b in ((1, "=", 1), ("a", "=", "A"), (None, "=", None), (None, "=", 0), (2, "<", "10"), ("x", "<", 1), (1, "<>", "1"))] == [1, 0, 1, 0, 1, 1, 0]
    dash = lambda x: one(spark, sc.general_text(sc.zero_dash(val(x))))
    assert [dash(x) for x in (0, None, "text", 5, "7")] == ["-", "-", "-", "5", "7"]
    assert one(spark, sc.if_else(val(None), F.lit("a"), F.lit("b"))) == "b"


@pytest.mark.parametrize(
    ("expected", "got", "same"),
    [(None, None, True), (None, 0, False), (0, None, False), ("a", "a", True), ("a", "A", False), (1, 1 + 1e-10, True), (1, 1 + 1e-8, False), (1e12, 1e12 + 100, True), (1234.5, "1,234.5", True), ("1,234.5", 1234.5, False), (5, "5", True), ("5", 5, True), (0, 1e-10, True)],
)
def test_same_value(spark, expected, got, same):
    assert one(spark, sc.same_value(val(expected), val(got))) is same


def test_split():
    assert [(c.op, c.rhs) for c in map(cr.split, (">=7", "> 6", "<>", "=", "x", None, 2025.0, "<=a=b"))] == [(">=", "7"), (">", "6"), ("<>", ""), ("=", ""), ("=", "x"), ("=", ""), ("=", "2025"), ("<=", "a=b")]


COUNTS = [(">6", 2), ("> 6", 2), (">=7", 2), ("<=5", 2), ("<5", 1), ("=5", 1), ("5", 1), ("<>5", 3), ("<>", 4)]


@pytest.mark.parametrize(("raw", "want"), COUNTS)
def test_the_same_counts_on_all_paths(spark, raw, want):
    df = spark.createDataFrame([(10.0, None), (5.0, None), (7.0, None), (3.0, None)], "n double, t string")
    c = cr.split(raw)
    text = df.select(sc.general_number(F.col("n")).alias("t"))
    on_number = F.col("n").isNotNull() if raw == "<>" else cr.on_long_number(F.col("n"), c)
    assert df.filter(on_number).count() == want
    assert text.filter(cr.on_long_text(F.col("t"), c)).count() == want
    assert df.filter(cr.on_grid(F.col("n"), F.col("t"), c)).count() == want
    assert df.filter(cr.on_page(F.col("n"), F.col("t"), c)).count() == want


def test_blanks_and_texts(spark):
    labels = spark.createDataFrame([(None, "계"), (None, "남자"), (None, "OECD"), (None, None)], "n double, t string")
    count = lambda f, raw: labels.filter(f(F.col("n"), F.col("t"), cr.split(raw)) if f is not cr.on_long_text else f(F.col("t"), cr.split(raw))).count()
    assert [count(f, "<>oecd") for f in (cr.on_long_text, cr.on_grid, cr.on_page)] == [2, 3, 3]
    assert [count(f, "=") for f in (cr.on_long_text, cr.on_grid, cr.on_page)] == [0, 1, 1]
    assert one(spark, cr.on_long_text(F.lit("abc"), cr.split(">=0"))) is True
    assert one(spark, cr.on_long_number(num(1.0), cr.split("<text"))) is True
    assert one(spark, cr.on_long_number(num(1.0), cr.split("=text"))) is False
    assert one(spark, cr.on_page(num(0.1 + 0.2), F.lit(None).cast("string"), cr.split(">0.3"))) is False
