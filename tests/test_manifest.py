"""Index shape, file lists and next-fit batches."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from helpers import pairs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pharmavane.operators import manifest, packing
from pharmavane.operators.ordering import with_ordinal
from pharmavane.sources import index


def document(*entries, total=12000):
    rows = [{"display_name": n, "size_mb": s, "file": f"f{i}"} for i, (n, s) in enumerate(entries)]
    return json.dumps({"results": {"drug": {"event": {"total_records": total, "partitions": rows}}}})


def listed(table, *entries):
    parsed = index.check_index(index.parse_index(table("index_json", document(*entries))))
    return index.index_files(parsed)


@pytest.mark.parametrize("text", ["{}", "", '{"meta": 1}'])
def test_index_without_results(table, text):
    with pytest.raises(ValueError):
        index.check_index(index.parse_index(table("index_json", text)))


def test_index_file(spark, tmp_path):
    path = tmp_path / "index.json"
    path.write_text(json.dumps(json.loads(document(("2012 Q1 (part 1 of 1)", "5.0"))), indent=2))
    files = index.index_files(index.check_index(index.read_index(spark, str(path))))
    assert pairs(files, "total_records", "seq", "file", "size_mb") == [(12000, 0, "f0", "5.0")]


def test_one_year(table):
    names = [("2012 Q1 (part 1 of 3)", "5.0"), ("2012 Q1 (part 2 of 3)", "10.0"), ("2012 Q1 (part 3 of 3)", "25.0")]
    years = manifest.by_year(listed(table, *names), keep=("total_records",))
    assert pairs(years, "partition_id", "count", "size_mb", "total_records") == [("2012", 3, 40.0, 12000)]
    lists = manifest.file_lists(listed(table, *names), list_rows=2).orderBy("list_no")
    assert pairs(lists, "list_no", "files") == [(0, ["f0", "f1"]), (1, ["f2"])]


def test_two_years_and_missing_size(table):
    files = listed(table, ("2012 Q1", "5.0"), ("2013 Q1", "25.0"), ("2012 Q2", "10.0"), ("2012 Q3", None))
    years = manifest.by_year(files).orderBy("seq")
    assert pairs(years, "partition_id", "count", "size_mb", "unsized") == [("2012", 3, 15.0, 1), ("2013", 1, 25.0, 0)]
    assert manifest.total_size(files).first()[0] == 40.0
    picked = manifest.select_years(years, " 2013")
    assert pairs(picked, "partition_id") == [("2013",)]
    assert manifest.select_years(years, "").count() == 2
    assert manifest.with_display_prefix(files, "2012").count() == 3


def test_part_names_advance_on_success_only(table):
    files = listed(table, ("2012", "1"), ("2012", "1"), ("2013", "1"), ("2012", "1")).withColumn(
        "succeeded", F.col("seq") != 1
    )
    got = manifest.part_names(files).orderBy("seq")
    assert pairs(got, "seq", "part_name") == [
        (0, "drug-event-part-1-of-3"), (2, "drug-event-part-1-of-1"), (3, "drug-event-part-2-of-3"),
    ]


def test_ordinal_over_blocks_and_null_groups(spark):
    rows = [(None if n % 3 == 0 else f"g{n % 2}", n) for n in range(50)]
    df = spark.createDataFrame(rows, "g string, seq long")
    got = with_ordinal(df, ["g"], block_rows=4, total="size", where=F.col("seq") % 5 != 0)
    want = []
    for g in (None, "g0", "g1"):
        mine = [n for key, n in rows if key == g]
        kept = [n for n in mine if n % 5]
        want += [(g, n, i + 1, len(mine)) for i, n in enumerate(kept)]
    assert sorted(pairs(got, "g", "seq", "ordinal", "size"), key=str) == sorted(want, key=str)


def sized(spark, sizes):
    return spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "seq long, size_mb double")


def brute_next_fit(sizes, cap):
    batch, run, out = 1, 0.0, []
    for i, s in enumerate(sizes):
        s = s or 0.0
        if s > cap:
            continue
        if run + s > cap:
            batch, run = batch + 1, 0.0
        run += s
        out.append((i, batch))
    return out


@pytest.mark.parametrize(
    "sizes, cap, batches, oversized",
    [
        ([4000, 3000, 2000], 10000, 1, 0),
        ([12000, 4000, 3000], 10000, 1, 1),
        ([5000, 4000, 2000], 9000, 2, 0),
        ([5000, 4000, 2000], 1000, 0, 3),
    ],
)
def test_batches(spark, sizes, cap, batches, oversized):
    df = sized(spark, [float(s) for s in sizes])
    packed = packing.pack_next_fit(df, cap)
    assert packed.select("batch_id").distinct().count() == batches
    assert packing.oversized(df, cap).count() == oversized
    assert packed.count() + oversized == len(sizes)


@pytest.mark.parametrize("block_rows", [1, 3, 7, 1000])
@pytest.mark.parametrize(
    "sizes, cap",
    [
        ([1.0] * 40, 7.0),  # never falls into step by itself
        ([float(n * 37 % 11) for n in range(60)], 12.0),
        ([0.0] * 10 + [5.0, None, 9.0, 2.5, 2.5] * 4, 10.0),
        ([0.1, 0.2, 0.3] * 15, 0.7),
    ],
)
def test_blocks_agree_with_one_pass(spark, sizes, cap, block_rows):
    packed = packing.pack_next_fit(sized(spark, sizes), cap, block_rows=block_rows)
    assert sorted(pairs(packed, "seq", "batch_id")) == brute_next_fit(sizes, cap)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 120), min_size=1, max_size=40), st.integers(1, 9))
def test_random_batches(spark, sizes, block_rows):
    sizes = [float(s) for s in sizes]
    packed = packing.pack_next_fit(sized(spark, sizes), 100.0, block_rows=block_rows)
    assert sorted(pairs(packed, "seq", "batch_id")) == brute_next_fit(sizes, 100.0)
    totals = manifest.batch_summary(packed)
    assert all(t <= 100.0 for (t,) in pairs(totals, "total_size_mb"))


def run_through(sizes, run, cap):
    breaks = 0
    for size in sizes:
        if run + size > cap:
            breaks, run = breaks + 1, 0.0
        run += size
    return run, breaks


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), min_size=1, max_size=12), min_size=1, max_size=5), st.integers(0, 25))
def test_summaries_compose(blocks, run):
    cap = 25.0
    found = [packing.Summary.of_rows(np.array(b, float), cap) for b in blocks]
    whole = found[0]
    for after in found[1:]:
        whole = whole.then(after)
    for summary, rows in [(found[0], blocks[0]), (whole, sum(blocks, []))]:
        out, breaks = summary.enter(np.array([run]))
        assert (out[0], breaks[0]) == run_through(rows, float(run), cap)
    assert len(whole.limits) <= sum(map(len, blocks)) + 1


@pytest.mark.parametrize("sizes, cap, block_rows", [([1.0] * 390, 7.0, 3), ([3.0] * 200, 10.0, 4), ([0.5] * 260, 100.0, 2)])
def test_rounds_grow_with_the_logarithm_of_blocks(spark, monkeypatch, sizes, cap, block_rows):
    """Sizes that never fall into step, and batches that span many blocks."""
    rounds = []
    kind = type(spark.range(1))
    kept = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda df, *a: rounds.append(1) or kept(df, *a))
    packed = packing.pack_next_fit(sized(spark, sizes), cap, block_rows=block_rows)
    assert sorted(pairs(packed, "seq", "batch_id")) == brute_next_fit(sizes, cap)
    blocks = -(-len(sizes) // block_rows)
    assert 2 < len(rounds) <= math.ceil(math.log2(blocks)) + 2


def test_groups_pack_apart(spark):
    rows = [(g, i, float(i % 5 + 1)) for g in ("a", "b", None) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, seq long, size_mb double")
    packed = packing.pack_next_fit(df, 8.0, group=["g"], block_rows=4)
    want = brute_next_fit([float(i % 5 + 1) for i in range(20)], 8.0)
    for g in ("a", "b", None):
        mine = packed.filter(F.col("g").eqNullSafe(F.lit(g)))
        assert sorted(pairs(mine, "seq", "batch_id")) == want


def test_run_plan_and_oversized_years(table):
    files = listed(table, ("2004 a", "6"), ("2004 b", "6"), ("2005 a", "3"), ("2006 a", "5"), ("2004 c", "2"))
    plan = manifest.run_plan(files, None, 8.0).orderBy("partition_id")
    assert pairs(plan, "partition_id", "batch_id") == [("2005", 1), ("2006", 1)]
    large = manifest.batch_oversized_years(files, 8.0).orderBy("seq")
    assert pairs(large, "file", "batch_id") == [("f0", 1), ("f1", 2), ("f4", 2)]
