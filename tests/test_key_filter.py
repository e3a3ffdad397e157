"""Joins behind a filter of the keys: same rows, less sent."""

from __future__ import annotations

import random

import pytest
from helpers import pairs
from pyspark.sql import functions as F

from pharmavane.operators import key_filter, star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(spark, job):
    """Bytes that a job wrote to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def total():
        none = gateway.new_array(gateway.jvm.double, 0)
        stages = store.stageList(None, False, False, none, None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = total()
    job()
    return total() - before


@pytest.mark.parametrize("max_words", [1 << 22, 512])
def test_no_key_is_stopped_and_few_others_pass(spark, max_words):
    n = 4000 if max_words > 512 else 7000  # the second is short of bits
    keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
    made = key_filter.build(keys, "k", 0, max_words)
    assert made.blocks.select(F.size("_filter_words")).distinct().collect() == [(512,)]
    rows = made.mark(spark.range(2 * n).select(F.col("id").cast("string").alias("k"), "id"), "k", "held")
    seen = {r["in"]: r.share for r in rows.groupBy((F.col("id") < n).alias("in")).agg(F.avg(F.col("held").cast("int")).alias("share")).collect()}
    assert seen[True] == 1.0
    assert seen[False] < (0.05 if max_words > 512 else 0.5)


def test_where_a_filter_does_not_pay(spark):
    keys = spark.range(5000).withColumnRenamed("id", "k")
    assert key_filter.build(keys, "k") is None
    assert key_filter.build(keys, "k", 0, max_words=100) is None
    assert key_filter.build(keys.limit(0), "k", 0) is not None


@pytest.mark.parametrize("seed", range(3))
def test_random_rows_with_nulls_and_repeats(spark, seed):
    rng = random.Random(seed)
    ids = [None, *[f"p{k}" for k in range(60)]]
    child = spark.createDataFrame([(k, rng.choice(ids), "x") for k in range(200)], "n long, patientid string, words string")
    parent = spark.createDataFrame([(rng.choice(ids), k) for k in range(50)], "patientid string, block long")
    for ours, plain in (
        (star.orphans(child, parent, filter_from=0), child.join(parent, "patientid", "left_anti")),
        (star.having(child, parent, filter_from=0), child.join(parent, "patientid", "left_semi")),
        (star.having(parent, child, filter_from=0), parent.join(child, "patientid", "left_semi")),
    ):
        assert ours.columns == plain.columns
        assert sorted(pairs(ours, *ours.columns), key=repr) == sorted(pairs(plain, *plain.columns), key=repr)


def test_empty_sides(spark):
    some = spark.createDataFrame([("p", 1), (None, 2)], "patientid string, n long")
    none = some.limit(0)
    assert star.orphans(some, none, filter_from=0).count() == 2
    assert star.orphans(none, some, filter_from=0).count() == 0
    assert star.having(some, none, filter_from=0).count() == 0


def test_rows_of_the_child_are_not_shuffled(spark, tmp_path):
    wide = F.concat_ws("-", *[F.sha2((F.col("id") * k).cast("string"), 256) for k in range(1, 6)])
    child = spark.range(30_000).select((F.col("id") % 10_000).cast("string").alias("patientid"), wide.alias("text"))
    child.write.parquet(f"{tmp_path}/child")
    spark.range(10, 10_000).select(F.col("id").cast("string").alias("patientid")).write.parquet(f"{tmp_path}/parent")
    child, parent = spark.read.parquet(f"{tmp_path}/child"), spark.read.parquet(f"{tmp_path}/parent")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = shuffled(spark, lambda: star.orphans(child, parent, filter_from=0).write.parquet(f"{tmp_path}/ours"))
        plain = shuffled(spark, lambda: star.orphans(child, parent).write.parquet(f"{tmp_path}/plain"))
        ours = plan(star.orphans(child, parent, filter_from=0))
        parent.filter("patientid < '12'").write.parquet(f"{tmp_path}/wanted")  # else the planner infers the bound
        wanted = spark.read.parquet(f"{tmp_path}/wanted")
        exact = plan(star.having(child, wanted, filter_from=0))
        sent_whole = shuffled(spark, lambda: star.having(child, wanted).write.parquet(f"{tmp_path}/whole"))
        sent_passed = shuffled(spark, lambda: star.having(child, wanted, filter_from=0).write.parquet(f"{tmp_path}/passed"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("ours", "plain")]
    assert sorted(pairs(found[0], "patientid", "text")) == sorted(pairs(found[1], "patientid", "text"))
    assert found[0].count() == 30
    assert sent < plain / 3
    assert "text" in ours
    assert not any("BroadcastExchange" not in line and "Exchange" in line and "text" in line for line in ours.splitlines())
    assert exact.index("SortMergeJoin") < exact.index("BroadcastHashJoin")  # the filter lies below the exact join
    assert sent_passed < sent_whole / 3
