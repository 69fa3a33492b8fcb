import pytest
from pyspark.sql import functions as F

from leadflow.functions.numbers import greatest_or_null, ratio, safe_ratio
from leadflow.functions.text import (
    ci_contains_any, ci_eq, ci_in, ci_ne, ci_not_in, conform_name, disqualified, fold, fold_text, to_day,
)

from .frames import day


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


VALUES = [None, "", "Service", "SERVICE", "service work"]


@pytest.mark.parametrize("expression, expected", [
    (lambda c: ci_eq(c, "Service"), [None, False, True, True, False]),
    (lambda c: ci_ne(c, "Service"), [None, True, False, False, True]),
    (lambda c: ci_ne(c, "Service", keep_null=True), [True, True, False, False, True]),
    (lambda c: ci_in(c, ["service", "x"]), [None, False, True, True, False]),
    (lambda c: ci_not_in(c, ["service", "x"]), [None, True, False, False, True]),
    (lambda c: ci_not_in(c, ["service", "x"], keep_null=True), [True, True, False, False, True]),
])
def test_case_rules(spark, expression, expected):
    assert column(spark, VALUES, expression) == expected


ACCENTS = ["José", "JOSE", "jose", "Jose\u0301", "JOS\u00c9", None, "", "Josef", "ÅNGSTRÖM ñ", "ǅ ß ø", "漢字", "Việt", "\u0301"]


def test_fold_takes_accents_for_none(spark):
    got = column(spark, ACCENTS, fold)
    assert got == ["jose"] * 5 + [None, "", "josef", "angstrom n", "ǆ ß ø", "漢字", "viet", ""]
    assert [fold_text(x) for x in ACCENTS if x is not None] == [x for x in got if x is not None]


@pytest.mark.parametrize("expression, expected", [
    (lambda c: ci_eq(c, "josé"), [True] * 5 + [None, False, False]),
    (lambda c: ci_ne(c, "jose", keep_null=True), [False] * 5 + [True, True, True]),
    (lambda c: ci_in(c, ["JOSÉ", "x"]), [True] * 5 + [None, False, False]),
    (lambda c: ci_contains_any(c, ["OSÉ"]), [True] * 5 + [None, False, True]),
])
def test_accents_in_tests(spark, expression, expected):
    assert column(spark, ACCENTS[:8], expression) == expected


def test_to_day(spark):
    texts = ["2024-03-01T10:11:12.000+0000", "2024-03-02", "2024-3-5", "", "garbage", None, "2024-02-30"]
    assert column(spark, texts, to_day) == [day(1), day(2), day(5), None, None, None, None]


def test_conform_name(spark):
    assert column(spark, ["  Ann LEE ", "ann lee", None, "a  b"], conform_name) == ["ann lee", "ann lee", None, "a  b"]


def test_disqualified(spark):
    reasons = ["x BAD or old DATA", "Spammer", "not the TYPE of work we do!", "Out Of Area", "Price", None]
    assert column(spark, reasons, disqualified) == [True, True, True, True, False, None]


def test_ratios(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (None, 3), (6, None)], "n int, d int")
    got = df.select(ratio("n", "d"), safe_ratio("n", "d")).collect()
    assert [tuple(r) for r in got] == [(2.0, 2.0), (None, 0.0), (None, None), (None, None)]


def test_guard_of_another_column(spark):
    df = spark.createDataFrame([(6, 0, 1), (6, 2, 0)], "n int, d int, g int")
    assert [r[0] for r in df.select(safe_ratio("n", "d", guard="g")).collect()] == [None, 0.0]


def test_greatest_or_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a int, b int")
    assert [r[0] for r in df.select(greatest_or_null(F.col("a"), F.col("b"))).collect()] == [2, None, None]
