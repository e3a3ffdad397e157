"""Casts, decoders and name parsing on every code, null, unknown and malformed values."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import pairs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pharmavane.functions import casts, codes, decode, names


def apply(table, fn, values, kind="string"):
    df = table(f"x:{kind}", *values)
    return [row[0] for row in df.select(fn(F.col("x"))).collect()]


INTEGERS = [
    "12", " 12 ", "12.7", "12.", ".5", ".", "+.5", "-.5", "-", "+", "+5", "-12.7", "0012.9", "1e3",
    "12.a", "12..3", "", "abc", "3000000000", "3000000000.5", "2147483647.99", "-2147483648.1",
    "5 .2", "\t7\n", "NaN", "1d", None,
]


def legacy_cast(spark, df, kind):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return [r[0] for r in df.select(F.col("x").cast(kind)).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_int_cast_equals_the_non_ansi_cast(spark, table):
    df = table("x", *INTEGERS)
    assert apply(table, casts.string_to_int, INTEGERS) == legacy_cast(spark, df, "int")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+- eE", max_size=12), min_size=1, max_size=60))
def test_int_cast_on_random_text(spark, table, values):
    df = table("x", *values)
    assert apply(table, casts.string_to_int, values) == legacy_cast(spark, df, "int")


def test_int_cast_of_drifted_types(table):
    doubles = table("x:double", 12.7, -0.9, 1e12, None)
    assert [r[0] for r in doubles.select(casts.to_int(doubles, "x")).collect()] == [12, 0, None, None]
    ints = table("x:int", 3, None)
    assert [r[0] for r in ints.select(casts.to_int(ints, "x")).collect()] == [3, None]


def test_float_cast(table):
    got = apply(table, casts.to_float, ["70", "70.5", "-5", "N/A", "", None])
    assert got == [70.0, 70.5, -5.0, None, None, None]


@pytest.mark.parametrize(
    "labels, fn",
    [
        (codes.AGE_GROUPS, decode.age_group),
        (codes.OUTCOMES, decode.outcome),
        (codes.ROUTES, decode.route),
    ],
)
def test_text_codes(table, labels, fn):
    values = [*labels, "0", "7x", "068", "48", None]
    assert apply(table, fn, values) == [labels.get(v) for v in values]


def test_code_lists():
    assert list(codes.AGE_GROUPS.values()) == ["Neonate", "Infant", "Child", "Adolescent", "Adult", "Elderly"]
    assert len(codes.ROUTES) == 67
    assert codes.ROUTES["048"] == "Oral" and codes.ROUTES["067"] == "Vaginal"
    assert codes.OUTCOMES["5"] == "Fatal"


def test_integer_codes(table):
    assert apply(table, decode.sex, [0, 1, 2, 3, None], "int") == [None, "Male", "Female", None, None]
    assert apply(table, decode.serious, [0, 1, 2, None], "int") == [None, True, False, None]
    assert apply(table, decode.flag, [0, 1, 2, None], "int") == [False, True, False, False]
    got = apply(table, decode.recurrence, [0, 1, 2, 3, 4, None], "int")
    assert got == [None, "Yes", "No", "Unknown", None, None]


@pytest.mark.parametrize(
    "unit, years",
    [(800, 240.0), (801, 24.0), (802, 2.0), (803, 24 / 52.143), (804, 24 / 365.25), (805, 24 / 8766), (799, None), (806, None), (None, None)],
)
def test_age_years(table, unit, years):
    df = table("a:int u:int", (24, unit))
    got = df.select(decode.age_years(F.col("a"), F.col("u"))).first()[0]
    assert got == (None if years is None else pytest.approx(years, rel=1e-6))


@pytest.mark.parametrize(
    "unit, days",
    [("801", 3 * 365.25), ("802", 3 * 30.46), ("803", 21.0), ("804", 3.0), ("805", 3 / 24), ("806", 3 / 1440), ("800", None), (None, None)],
)
def test_duration_days(table, unit, days):
    df = table("n:int u", (3, unit))
    assert df.select(decode.duration_days(F.col("n"), F.col("u"))).first()[0] == days


@pytest.mark.parametrize(
    "unit, factor, standard",
    [("001", 1e-6, 1e6), ("002", 1e-3, 1e3), ("003", 1, 1), ("004", 1e3, 1e-3), ("005", None, None), (None, None, None)],
)
def test_dose(table, unit, factor, standard):
    df = table("n:float u", (0.5, unit))
    number, code = F.col("n"), F.col("u")
    got = df.select(
        decode.dose_mg(number, code), decode.dose_mg(number, code, codes.DOSE_TO_MG_STANDARD)
    ).first()
    assert tuple(got) == tuple(None if f is None else 0.5 * f for f in (factor, standard))


def test_weight(table):
    values = ["70", "70.5", "-5", "N/A", "", "12345678", "0.0001", "0", "NaN", None]
    got = apply(table, lambda c: decode.valid_weight(casts.to_float(c)), values)
    assert got == [70.0, 70.5, None, None, None, None, None, 0.0, None, None]


DATES = {
    "2005": dt.date(2005, 1, 1),
    "200503": dt.date(2005, 3, 1),
    "20050315": dt.date(2005, 3, 15),
    "20050230": None,
    "20051301": None,
    "2005011": None,
    "20050": None,
    "10041227": None,
    "1899": None,
    "1900": dt.date(1900, 1, 1),
    "19000100": None,
    "2005-03-15": None,
    "2005-3-1": None,
    " 2005": None,
    "200503151": None,
    "20040229": dt.date(2004, 2, 29),
    "": None,
    "abc": None,
    "abcd": None,
}


def test_partial_dates(table):
    values = [*DATES, None]
    assert apply(table, decode.partial_date, values) == [*DATES.values(), None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789-a ", max_size=9), min_size=1, max_size=80))
def test_partial_date_equals_its_three_steps(table, values):
    steps = apply(table, lambda c: decode.compact_date(decode.floor_date(decode.complete_date(c))), values)
    assert apply(table, decode.partial_date, values) == steps


def test_year_of_text(table):
    got = apply(table, decode.year_of_text, ["20050315", "1004", "12", "abcd", "", None])
    assert got == [2005, 1004, None, None, None, None]


def test_age_bands(table):
    got = apply(table, decode.age_band, [64.9, 65.0, 70.99, 71.0, 80.5, 81.0, None], "float")
    assert got == [None, "65-70", "65-70", "71-80", "71-80", "81+", None]


def test_display_names(table):
    df = table("n", "2016 Q4 (part 11 of 23)", " 2023 Q1", "", None)
    got = pairs(
        df.select(
            names.year_token(F.col("n")).alias("y"),
            names.year_quarter(F.col("n")).alias("q"),
            names.part_total(F.col("n")).alias("p"),
        ),
        "y", "q", "p",
    )
    assert got[0] == ("2016", "2016Q4", 23)
    assert [g[0] for g in got] == ["2016", "2023", "", ""]


def test_sizes(table):
    assert apply(table, names.size_or_default, ["51.2", "100.24", None]) == [51.2, 100.24, -1.0]


def test_paths(table):
    path = "data/pq/drug/2004/drug-event-part-1-of-2.snappy.parquet"
    df = table("p", path)
    got = df.select(names.path_year(F.col("p")), names.path_stem(F.col("p"))).first()
    assert tuple(got) == ("2004", "drug-event-part-1-of-2")


def test_year_list():
    assert names.year_list("2004, 2005 ,2006") == ["2004", "2005", "2006"]
    assert names.year_list("") is None and names.year_list(None) is None
