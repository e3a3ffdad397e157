"""Pair counts against brute force, with ordinary and very long reports."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations, product

import pytest
from helpers import pairs
from pyspark.sql import functions as F

from pharmavane.operators import signals
from pharmavane.operators.skew import split_heavy


def baskets(seed):
    """Short reports, a few long ones, copies of a long one, and one very long one."""
    rng = random.Random(seed)
    names = [f"D{n:02d}" for n in range(30)]
    lists = [rng.sample(names, rng.randrange(1, 5)) for _ in range(60)]
    lists += [rng.sample(names, rng.randrange(8, 16)) for _ in range(5)]
    lists += [names[3:14]] * 4
    lists.append(names + [f"RARE{n}" for n in range(20)])
    terms = [[f"T{n}" for n in rng.sample(range(25), rng.randrange(0, 4))] for _ in lists]
    terms[-1] = [f"T{n}" for n in range(25)]
    return lists, terms


def items_of(spark, lists, terms=None):
    rows = [(f"r{i}", "a", x) for i, xs in enumerate(lists) for x in set(xs)]
    rows += [(f"r{i}", "b", y) for i, ys in enumerate(terms or []) for y in set(ys)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "report string, side string, item string").repartition(3)


@pytest.mark.parametrize("limit", [6, 10, 1000])
@pytest.mark.parametrize("min_n", [1, 2, 3])
def test_pairs_within(spark, limit, min_n):
    lists, _ = baskets(limit * 10 + min_n)
    want = Counter(p for xs in lists for p in combinations(sorted(set(xs)), 2))
    got = signals.pair_counts(items_of(spark, lists), True, min_n, basket_limit=limit)
    assert {(a, b): n for a, b, n in pairs(got, "a", "b", "n")} == {
        p: n for p, n in want.items() if n >= min_n
    }


@pytest.mark.parametrize("limit", [7, 1000])
@pytest.mark.parametrize("min_n", [1, 3])
def test_pairs_across(spark, limit, min_n):
    lists, terms = baskets(limit + min_n)
    want = Counter(p for xs, ys in zip(lists, terms) for p in product(set(xs), set(ys)))
    got = signals.pair_counts(items_of(spark, lists, terms), False, min_n, basket_limit=limit)
    assert {(a, b): n for a, b, n in pairs(got, "a", "b", "n")} == {
        p: n for p, n in want.items() if n >= min_n
    }


def test_long_reports_do_not_form_all_pairs(spark):
    """One report with very many drugs found nowhere else gives no pair rows."""
    lists = [[f"D{n}" for n in range(3000)], ["D1", "D2"], ["D1", "D2"], ["D5"]]
    items = items_of(spark, lists)
    ordinary, heavy = split_heavy(items, "report", 200)
    light = signals._light_pairs(ordinary, True)
    found = signals._heavy_pairs(heavy, light, True, 3)
    assert sum(f.count() for f in found) == 1
    got = signals.pair_counts(items, True, 3)
    assert pairs(got, "a", "b", "n") == [("D1", "D2", 3)]


def test_heavy_split_keeps_all_rows(spark):
    df = spark.createDataFrame([("hot", n) for n in range(50)] + [(f"k{n}", n) for n in range(25)], "k string, v int")
    light, heavy = split_heavy(df, "k", 10)
    assert light.count() == 25 and heavy.count() == 50
    same, none = split_heavy(df, "k", 50)
    assert none is None and same.count() == 75


def two_by_two(lists, x, y):
    a = sum(x in s and y in s for s in lists)
    b = sum(x in s and y not in s for s in lists)
    c = sum(x not in s and y in s for s in lists)
    return a, b, c, len(lists) - a - b - c


def test_measures(spark, table):
    lists = [["A", "B"], ["A", "B"], ["A", "B"], ["A"], ["B"], ["C"], ["C", "D"], ["C", "D"], ["C", "D"], []]
    patient = table("patientid safetyreportid:int", *[(str(i), None) for i in range(len(lists))])
    drug = table("patientid medicinalproduct", *[(str(i), d) for i, xs in enumerate(lists) for d in xs + xs])
    got = {(r.drug_a, r.drug_b): r for r in signals.drug_pair_signal(patient, drug).collect()}
    assert set(got) == {("A", "B"), ("C", "D")}
    a, b, c, d = two_by_two(lists, "A", "B")
    row = got["A", "B"]
    assert (row.n_reports, row.n_first, row.n_second, row.n_total) == (a, a + b, a + c, 10)
    assert row.prr == pytest.approx((a / (a + b)) / (c / (c + d)))
    assert row.ror == pytest.approx(a * d / (b * c))
    assert row.observed_expected == pytest.approx(a / ((a + b) * (a + c) / 10))
    # D is never without C: the second row of the table is empty.
    assert got["C", "D"].prr is None and got["C", "D"].ror is None


def test_versions_of_a_report_count_once(spark, table):
    patient = table("patientid safetyreportid:int", *[(str(i), 7) for i in range(5)], ("9", None))
    drug = table("patientid medicinalproduct", *[(str(i), d) for i in range(5) for d in "AB"], ("9", "A"), ("9", "B"))
    both = signals.drug_pairs(patient, drug, min_n=1)
    assert pairs(both, "drug_a", "drug_b", "n_reports") == [("A", "B", 2)]
    assert signals.drug_pairs(patient, drug).count() == 0  # three reports are asked for


def test_drugs_with_reactions(spark, table):
    patient = table("patientid safetyreportid:int", *[(str(i), None) for i in range(6)])
    drug = table("patientid medicinalproduct", *[(str(i), "A") for i in range(4)], ("4", "B"), ("5", None))
    reaction = table("patientid reactionmeddrapt", *[(str(i), "X") for i in range(3)], ("4", "X"), ("5", "X"))
    got = signals.drug_reaction_signal(patient, drug, reaction)
    assert pairs(got, "drug", "reaction", "n_reports", "n_first", "n_second", "n_total") == [("A", "X", 3, 4, 5, 6)]
    assert got.first().prr == pytest.approx((3 / 4) / (2 / 2))
