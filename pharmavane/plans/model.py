"""Job: cleaned tables to the star schema, as tables of a database.

    spark-submit --py-files pharmavane.zip jobs/model.py --cleaned C --database staging [--years 2004,2005]

With years, only these are read: their facts and patients replace the earlier ones, and
the other dimensions gain the rows they lack.
"""

from __future__ import annotations

from argparse import ArgumentParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.functions.names import year_list
from pharmavane.operators import star
from pharmavane.session import build_session, run_scope
from pharmavane.sources import tables

_DATES = {"fact_drug": ("date_key", "first_start", "last_end"), "fact_reaction": ("date_key",)}
FACTS = ("dim_patient", "fact_drug", "fact_reaction")
TASK_ROWS = 1_000_000  # rows that a task sorts; a bucket of more is written by several tasks


def _dates(spark: SparkSession, database: str, years: list[str]) -> DataFrame:
    """The first and last date of the facts; a report may have reactions alone."""
    ends = []
    for fact, columns in _DATES.items():
        rows = spark.table(f"{database}.{fact}")
        rows = rows.filter(F.col("year").isin(years)) if years else rows
        for column in columns:
            ends.append(rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    span = ends[0]
    for end in ends[1:]:
        span = span.unionByName(end)
    return span


def _modelled(
    spark: SparkSession, cleaned: str, years: str | None, buckets: int
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The tables by year, spread by report, and the dimensions with their keys, of the given years."""
    patient, drug, reaction = (
        tables.read_years(spark, f"{cleaned}/{entity}", years) for entity in ("patient", "drug", "reaction")
    )

    def tasks(rows: DataFrame) -> int:  # the count reads no column
        return buckets * max(1, -(-rows.count() // (buckets * TASK_ROWS)))

    facts = {
        "dim_patient": star.dim_patient(patient.repartition(tasks(patient), "patientid")),
        "fact_drug": star.fact_drug(patient, drug, ("year",), tasks(drug)),
        "fact_reaction": star.fact_reaction(patient, reaction, ("year",), tasks(reaction)),
    }
    return facts, {"drug": star.dim_drug(drug), "reaction": star.dim_reaction(reaction)}


def build_model(
    spark: SparkSession, cleaned: str, database: str, buckets: int = 512, years: str | None = None
) -> None:
    """Facts and the patient dimension are bucketed alike by report, and kept by year.

    With ``years`` (and a model that is there) only these years are read and replaced. A report
    and its rows are of one year. The dimensions of drugs, reactions and dates only grow then:
    a value that no fact has any more stays until the next whole build.
    """
    with run_scope(spark):
        _build(spark, cleaned, database, buckets, years)


def _build(spark: SparkSession, cleaned: str, database: str, buckets: int, years: str | None) -> None:
    spark.sql(f"create database if not exists {database}")
    picked = year_list(years)
    there = all(spark.catalog.tableExists(f"{database}.{name}") for name in (*FACTS, "dim_drug", "dim_reaction", "dim_date"))
    grows = picked and there
    facts, dims = _modelled(spark, cleaned, years, _buckets(spark, f"{database}.dim_patient") if grows else buckets)
    if not grows:
        for name, table in facts.items():
            tables.write_model_table(table, f"{database}.{name}", "patientid", buckets, spread=True)
        for name, table in dims.items():
            table.write.mode("overwrite").saveAsTable(f"{database}.dim_{name}")
        dates = star.dim_date(_dates(spark, database, []), "lo", "hi")
        dates.write.mode("overwrite").saveAsTable(f"{database}.dim_date")
        return
    for name, table in facts.items():
        tables.replace_model_years(table, f"{database}.{name}", "patientid", picked, _buckets(spark, f"{database}.{name}"), spread=True)
    for name, table in dims.items():
        tables.append_new(table, f"{database}.dim_{name}", f"{name}_key")
    known = spark.table(f"{database}.dim_date").agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))
    dates = star.dim_date(_dates(spark, database, picked).unionByName(known), "lo", "hi")
    tables.append_new(dates, f"{database}.dim_date", "date_key")


def _buckets(spark: SparkSession, name: str) -> int:
    said = {row.col_name: row.data_type for row in spark.sql(f"describe extended {name}").collect()}
    return int(said["Num Buckets"])


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--cleaned", required=True, help="folder of the cleaned tables")
    parser.add_argument("--database", required=True, help="database of the modelled tables")
    parser.add_argument("--years", default="", help="comma-separated years to replace; all if empty")
    parser.add_argument("--buckets", type=int, default=512)
    args = parser.parse_args(argv)
    build_model(build_session("pharmavane-model"), args.cleaned, args.database, args.buckets, args.years)


if __name__ == "__main__":
    main()
