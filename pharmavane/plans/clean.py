"""Job: raw tables to cleaned tables, one plan per entity over all its years.

    spark-submit --py-files pharmavane.zip jobs/clean.py --raw R --out O [--only_years 2004,2005]
"""

from __future__ import annotations

from argparse import ArgumentParser

from pyspark.sql import SparkSession

from pharmavane.functions import codes
from pharmavane.functions.names import year_list
from pharmavane.operators import clean as cleaning
from pharmavane.operators import quality
from pharmavane.session import build_session, run_scope
from pharmavane.sources import tables

DOSE_FACTORS = {"parity": codes.DOSE_TO_MG, "standard": codes.DOSE_TO_MG_STANDARD}


def clean(
    spark: SparkSession,
    raw: str,
    out: str,
    years: str | None = None,
    dose_factors: dict = codes.DOSE_TO_MG,
    quarantine: str | None = None,
) -> None:
    """Clean the three tables, with their lineage columns.

    ``quarantine`` is a folder for rows with values that do not convert, whole and
    with the names of the columns. Such rows are also cleaned, the bad values null,
    so that counts of reports do not depend on one bad field.

    A year is replaced as a whole, also where it has no row, or no bad row, any more.
    """
    with run_scope(spark):
        picked = year_list(years)
        scanned = spark.createDataFrame([(y,) for y in picked], "year string") if picked else None
        types = {"patient": quality.PATIENT_TYPES, "drug": quality.DRUG_TYPES}
        for entity, cleaner in cleaning.CLEANERS.items():
            rows = tables.read_entity(spark, raw, entity, years, lineage=True)
            options = (dose_factors,) if entity == "drug" else ()
            # Lineage and year are carried beside the cleaned columns.
            cleaned = cleaner(rows, *options, keep=(*tables.LINEAGE.names, "year"))
            tables.replace_partitions(cleaned, f"{out}/{entity}", scanned)
            if quarantine and entity in types:
                _, bad = quality.split_bad(rows, types[entity])
                tables.replace_partitions(bad, f"{quarantine}/{entity}", scanned)


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw tables")
    parser.add_argument("--out", required=True, help="folder of the cleaned tables")
    parser.add_argument("--only_years", default="", help="comma-separated years; all if empty")
    parser.add_argument("--dose-factors", choices=sorted(DOSE_FACTORS), default="parity")
    parser.add_argument("--quarantine", help="folder for rows with values that do not convert")
    args = parser.parse_args(argv)
    spark = build_session("pharmavane-clean")
    clean(
        spark, args.raw, args.out, args.only_years, DOSE_FACTORS[args.dose_factors], args.quarantine
    )


if __name__ == "__main__":
    main()
