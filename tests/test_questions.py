"""Questions and star schema on small hand-checked tables."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import pairs
from pyspark.sql import functions as F

from pharmavane.operators import questions, star
from pharmavane.schemas import AGE, SERIOUSNESS_FLAGS

COLUMNS = (
    "patientid patientagegroup patientsex serious:boolean "
    + " ".join(f"{f}:boolean" for f in SERIOUSNESS_FLAGS)
    + " receivedate receiptdate safetyreportid:int age:float"
)


@pytest.fixture
def patient(table):
    def person(pid, serious, age, received, report=None, **flags):
        return (
            pid, None, None, serious, *[flags.get(f, False) for f in SERIOUSNESS_FLAGS],
            received, received, report, age,
        )

    rows = [
        person("a", True, 70.0, "20040101", seriousnessdeath=True),
        person("b", True, 65.0, "20050101", seriousnessdeath=True, seriousnessother=True),
        person("c", None, 82.0, "20050202"),
        person("d", True, 64.9, "20060101"),
        person("e", False, 75.0, "2006", report=9),
        person("f", True, 75.0, "20060301", report=9, seriousnessdisabling=True),
        person("g", True, None, "bad"),
    ]
    return table(COLUMNS, *rows).withColumnRenamed("age", AGE)


@pytest.fixture
def drug(table):
    rows = [
        ("a", "X"), ("a", "X"), ("a", "Y"), ("b", "X"), ("b", None), ("c", "X"), ("d", "Y"),
        ("e", "Y"), ("f", "Y"), ("g", "X"), ("nobody", "X"),
    ]
    return table("patientid medicinalproduct", *rows).withColumns(
        {
            "activesubstancename": F.lit(None).cast("string"),
            "drugadministrationroute": F.lit("Oral"),
            "drugstartdate": F.lit(dt.date(2004, 2, 27)),
            "drugenddate": F.lit(dt.date(2004, 3, 2)),
            "drugstructuredosage(mg)": F.lit(5.0),
        }
    )


def test_top_serious(patient, drug):
    top = questions.top_serious_meds(patient, drug)
    assert pairs(top, "medicinalproduct", "n_reports") == [("X", 2), ("Y", 2)]
    assert pairs(questions.top_serious_meds(patient, drug, k=1), "medicinalproduct") == [("X",)]


def test_event_types(patient, drug):
    got = sorted(pairs(questions.event_types_by_drug(patient, drug), "medicinalproduct", "event_type", "n_reports"))
    assert got == [("X", "death", 2), ("X", "other", 1), ("Y", "death", 1), ("Y", "disability", 1)]
    ranks = {r[:2]: r[2:] for r in pairs(questions.event_type_rank(patient, drug), "medicinalproduct", "event_type", "share", "event_rank")}
    assert ranks["X", "death"] == (pytest.approx(2 / 3), 1) and ranks["Y", "death"] == (0.5, 1)


def test_trend(patient, drug):
    got = pairs(questions.yearly_trend(patient).orderBy("year"), "year", "n_reports", "n_serious", "change_reports", "change_serious")
    # Rows e and f are versions of one report.
    assert got == [(2004, 1, 1, None, None), (2005, 2, 1, 1, 0), (2006, 2, 2, 0, 1)]
    only = pairs(questions.yearly_trend(patient, drug, "Y").orderBy("year"), "year", "n_reports")
    assert only == [(2004, 1), (2006, 2)]
    # 2005 is absent, so 2006 has no year before.
    gap = questions.yearly_trend(patient, drug, "Y").orderBy("year")
    assert pairs(gap, "change_reports") == [(None,), (None,)]


def test_rolling_share(patient, drug):
    got = questions.rolling_serious_share(patient, drug, years=2).orderBy("medicinalproduct", "year")
    assert pairs(got, "medicinalproduct", "year", "rolling_reports", "rolling_serious", "serious_share") == [
        ("X", 2004, 1, 1, 1.0), ("X", 2005, 3, 2, 2 / 3), ("Y", 2004, 1, 1, 1.0), ("Y", 2006, 2, 2, 1.0),
    ]


def test_age_bands(patient):
    got = pairs(questions.age_band_risk(patient).orderBy("age_band"), "age_band", "n_reports", "n_serious", "death", "death_share")
    assert got == [("65-70", 2, 2, 2, 1.0), ("71-80", 1, 1, 0, 0.0), ("81+", 1, 0, 0, 0.0)]


def test_populations(patient):
    assert star.older(patient).count() == 5
    assert star.serious_only(patient).count() == 5


def test_dimensions(patient, drug):
    dim = star.dim_drug(drug)
    assert dim.count() == 3 and dim.select("drug_key").distinct().count() == 3
    assert pairs(star.dim_patient(patient).filter("patientid = 'c'"), "age_band") == [("81+",)]
    days = star.dim_date(drug.withColumn("drugstartdate", F.when(F.col("patientid") == "a", dt.date(2004, 3, 1)).otherwise(F.col("drugstartdate"))), "drugstartdate")
    assert [d for (d,) in sorted(pairs(days, "date_key"))] == [dt.date(2004, 2, 27), dt.date(2004, 2, 28), dt.date(2004, 2, 29), dt.date(2004, 3, 1)]
    assert star.dim_date(drug.filter("false"), "drugstartdate").count() == 0


def test_keys_do_not_run_together(table):
    names = table("medicinalproduct activesubstancename drugadministrationroute", ("a|b", "c", None), ("a", "b|c", None), ("a", None, "b|c"), ("~", None, None), (None, "~", None))
    assert star.dim_drug(names).select("drug_key").distinct().count() == 5


def test_facts(patient, drug, table):
    fact = star.fact_drug(patient, drug)
    assert fact.count() == 9
    assert pairs(fact.filter("patientid = 'a'").orderBy("n_mentions"), "n_mentions", "max_dose_mg") == [(1, 5.0), (2, 5.0)]
    assert fact.join(star.dim_drug(drug), "drug_key", "left_anti").count() == 0
    reaction = table("patientid reactionmeddrapt reactionoutcome", ("a", "T", "Fatal"), ("a", "T", None), ("b", "T", "Unknown"))
    got = star.fact_reaction(patient, reaction).orderBy("patientid")
    assert pairs(got, "patientid", "n_mentions", "n_fatal") == [("a", 2, 1), ("b", 1, 0)]


def test_orphans(patient, drug):
    assert pairs(star.orphans(drug, patient), "patientid") == [("nobody",)]
    assert star.having(patient, drug.filter("medicinalproduct = 'Y'")).count() == 4


def test_route_dimension(spark, table):
    coded = table("route_code", "048", "999", None)
    got = star.with_dim(coded, star.route_dimension(spark), "route_code")
    assert sorted(pairs(got, "route_code", "route"), key=str) == [("048", "Oral"), ("999", None), (None, None)]
