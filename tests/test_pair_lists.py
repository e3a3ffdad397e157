"""Pairs within reports from their lists, against plain pairs."""

from __future__ import annotations

import itertools
import random

import pytest
from helpers import pairs

from pharmavane.operators import pair_lists


def tables(spark, seed=2):
    rng = random.Random(seed)
    patient = [(f"p{k}", None if k % 7 == 0 else 100 + k % 20) for k in range(40)]
    drug = [(f"p{rng.randrange(45)}", rng.choice([None, *"ABCDEFG"])) for _ in range(150)]
    drug += [("p3", f"D{k}") for k in range(60)] * 2  # one report with very many
    return (
        spark.createDataFrame(patient, "patientid string, safetyreportid int"),
        spark.createDataFrame(drug, "patientid string, medicinalproduct string"),
        patient, drug,
    )


@pytest.mark.parametrize("list_items", [2, 7, 200])
def test_lists_lose_nothing(spark, list_items):
    patient, drug, patients, drugs = tables(spark)
    report = {p: f"report:{r}" if r is not None else f"row:{p}" for p, r in patients}
    held = {}
    for p, item in drugs:
        if p in report and item:
            held.setdefault(report[p], []).append(item)
    lists = pair_lists.report_lists(patient, drug, list_items=list_items)
    rows = lists.collect()
    found = {}
    for r in rows:
        assert r.items == sorted(r.items) and 0 <= r.part < r.parts
        found.setdefault(r.report, []).extend(r.items)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(set(v)) for k, v in held.items()}
    assert sum(r.n_rows for r in rows) == sum(map(len, held.values()))
    assert all(r.parts == 1 for r in rows) == (list_items == 200)

    want = sorted((k, a, b) for k, v in held.items() for a, b in itertools.combinations(sorted(set(v)), 2))
    assert sorted(pairs(pair_lists.all_pairs(lists), "report", "a", "b")) == want
    for item in ("A", "D5", "absent"):
        beside = sorted((k, x) for k, v in held.items() if item in v for x in set(v) - {item})
        assert sorted(pairs(pair_lists.pairs_with(lists, item), "report", "other")) == beside
        counts = {}
        for _, x in beside:
            counts[x] = counts.get(x, 0) + 1
        assert dict(pairs(pair_lists.pair_counts(lists, item), "other", "n_reports")) == counts


def test_empty(spark):
    patient, drug, *_ = tables(spark)
    lists = pair_lists.report_lists(patient, drug.limit(0))
    assert lists.count() == pair_lists.all_pairs(lists).count() == pair_lists.pairs_with(lists, "A").count() == 0
