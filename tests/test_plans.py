"""Physical plans: pruning, pushdown, no Python, skewed joins split."""

from __future__ import annotations

import contextlib
import os
import re

import pytest
from pyspark.sql import functions as F

from pharmavane.operators import clean, questions, star
from pharmavane.plans import fixtures as fx

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    tables = {}
    for name, make in (("patient", fx.raw_patient), ("drug", fx.raw_drug), ("reaction", fx.raw_reaction)):
        make(spark, SF).write.parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return tables


def test_cleaning_is_one_compiled_pass(spark, raw):
    for name, cleaner in clean.CLEANERS.items():
        text = plan(cleaner(raw[name]))
        assert "Exchange" not in text and "Python" not in text
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(
            cleaner(raw[name])._jdf.queryExecution().executedPlan()
        )
        # Larger methods are not compiled by the JVM.
        assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000


def test_exact_start_is_pushed_down(raw):
    text = plan(questions.rows_with_start(raw["drug"], "10041227"))
    assert "EqualTo(drugstartdate,10041227)" in text


def test_flagship_reads_only_its_columns(spark, raw):
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__maxMetadataStringLength="1000"
    ):
        text = plan(questions.top_serious_meds(clean.clean_patient(raw["patient"]), clean.clean_drug(raw["drug"])))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(len(s.split(",")) for s in schemas) == [2, 5]
    assert "TakeOrderedAndProject" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_hot_report_is_split(spark, tmp_path):
    drug = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("patientid"),
        F.sha2(F.col("id").cast("string"), 256).alias("medicinalproduct"),
    )
    drug.select("patientid").distinct().write.parquet(f"{tmp_path}/patient")
    patient = spark.read.parquet(f"{tmp_path}/patient").withColumn("serious", F.lit(True))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    ):
        joined = star.report_drugs(patient, drug.repartition(8))
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
