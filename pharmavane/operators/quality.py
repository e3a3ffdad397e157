"""Typed dates, lineage columns and quarantine of bad values."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.functions import casts, decode
from pharmavane.schemas import SERIOUSNESS_FLAGS

# Expected types of the raw text columns, where it is not text.
PATIENT_TYPES = {
    "patientonsetage": "int",
    "patientonsetageunit": "int",
    "patientsex": "int",
    "patientweight": "float",
    "serious": "int",
    **dict.fromkeys(SERIOUSNESS_FLAGS, "int"),
    "receivedate": "date",
    "receiptdate": "date",
    "safetyreportid": "int",
}
DRUG_TYPES = {
    "drugstructuredosagenumb": "float",
    "drugtreatmentduration": "int",
    "drugrecurreadministration": "int",
    "drugstartdate": "date",
    "drugenddate": "date",
}


def typed_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """``yyyyMMdd`` texts as dates, completed where month or day is missing."""
    return df.withColumns({n: decode.partial_date(F.col(n)) for n in columns})


def with_lineage(
    df: DataFrame, batch_id: Column | str | int, source: Column | None = None
) -> DataFrame:
    """Add ingestion time, source file and batch.

    The source is the file the row was read from, unless given.
    """
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file_path": F.col("_metadata.file_path") if source is None else source,
            "batch_id": batch_id if isinstance(batch_id, Column) else F.lit(batch_id),
        }
    )


def _parsed(df: DataFrame, name: str, kind: str) -> Column:
    if kind == "int":
        return casts.to_int(df, name)
    if kind == "date":
        return decode.partial_date(F.col(name))
    return F.col(name).try_cast(kind)


def _bad(df: DataFrame, types: dict[str, str]) -> dict[str, Column]:
    """Per column, whether its value is present but does not convert.

    A column the table lacks counts as bad on every row.
    """
    return {
        name: F.col(name).isNotNull() & _parsed(df, name, kind).isNull()
        if name in df.columns
        else F.lit(True)
        for name, kind in types.items()
    }


def _names(bad: dict[str, Column]) -> Column:
    named = F.array(*[F.when(is_bad, F.lit(name)) for name, is_bad in bad.items()])
    return F.array_except(named, F.array(F.lit(None).cast("string")))


def tag_bad(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add ``bad_columns``, the names of the columns that do not convert."""
    return df.withColumn("bad_columns", _names(_bad(df, types)))


def split_bad(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Good rows as they were, and bad rows with ``bad_columns``; no row is lost."""
    bad = _bad(df, types)
    any_bad = reduce(or_, bad.values())
    return df.filter(~any_bad), df.filter(any_bad).withColumn("bad_columns", _names(bad))


def write_split(df: DataFrame, types: dict[str, str], path: str) -> None:
    """Both kinds in one pass: ``quarantined=false`` and ``quarantined=true``."""
    (
        tag_bad(df, types)
        .withColumn("quarantined", F.size("bad_columns") > 0)
        .write.mode("overwrite")
        .partitionBy("quarantined")
        .parquet(path)
    )


def check_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [n for n in columns if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
