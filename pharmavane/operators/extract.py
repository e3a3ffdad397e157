"""Parsed safety reports to the three raw tables.

Reports come in as rows ``(source_file, pos, report struct)``; the surrogate
key is a hash of file and position, so separate plans over the same input
give the three tables equal keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.schemas import (
    DRUG_COLUMNS,
    PATIENT_COLUMNS,
    REACTION_COLUMNS,
    REPORT_LEVEL_COLUMNS,
    REPORT_SCHEMA,
)


def report_key(source_file: Column, pos: Column) -> Column:
    return F.sha2(F.concat_ws("|", source_file, pos.cast("string")), 256)


def parse_reports(df: DataFrame, text: str = "report_json", file: str = "source_file") -> DataFrame:
    """Add the parsed ``report`` struct and the ``patientid`` key.

    ``file`` names the column that stands for the file in the key; with the path below the
    landing folder, keys outlive a move. A text of another shape gives a report with nulls in place; see ``split_unparsed``.
    """
    return df.withColumn("report", F.from_json(text, REPORT_SCHEMA)).withColumn(
        "patientid", report_key(F.col(file), F.col("pos"))
    )


def _kind(value: Column, path: str) -> Column:
    """The type of a part of a JSON value: its name, null where the part is missing."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def misshapen(text: Column) -> Column:
    """Whether a text is not one JSON object of the report's shape.

    The patient must be an object, drugs and reactions arrays of objects, each of
    them may be missing or null; what an array of mixed entries holds is no shape.
    """
    value = F.try_parse_json(text)

    def is_none(kind: Column) -> Column:
        return kind.isNull() | (kind == "VOID")

    patient = _kind(value, "$.patient")
    wrong = value.isNull() | ~F.schema_of_variant(value).startswith("OBJECT")
    wrong = wrong | ~(is_none(patient) | patient.startswith("OBJECT"))
    for entries in ("drug", "reaction"):
        kind = _kind(value, f"$.patient.{entries}")
        listed = kind.startswith("ARRAY<OBJECT") | (kind == "ARRAY<VOID>")
        wrong = wrong | ~(is_none(kind) | listed)
    return F.coalesce(wrong, F.lit(True))


def split_unparsed(df: DataFrame, text: str = "report_json") -> tuple[DataFrame, DataFrame]:
    """Texts that hold one report, and those that do not, whole."""
    broken = misshapen(F.col(text))
    return df.filter(~broken), df.filter(broken)


def extract_patient(reports: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per report. Report-level fields win over copies under the patient.

    ``keep`` carries columns of the report row along, here and below.
    """

    def field(name: str) -> Column:
        nested = F.col(f"report.patient.{name}")
        if name in REPORT_LEVEL_COLUMNS:
            nested = F.coalesce(F.col(f"report.{name}"), nested)
        return nested.alias(name)

    return reports.select("patientid", *[field(n) for n in PATIENT_COLUMNS[1:]], *keep)


def _entries(reports: DataFrame, path: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per entry of an array; none for an empty, missing or null one.

    The outer form keeps the optimiser from testing the array's size in a
    filter of its own, which would parse every report a second time.
    """
    entries = reports.select("patientid", *keep, F.explode_outer(path).alias("entry"))
    return entries.filter(F.col("entry").isNotNull())


def extract_drug(reports: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per drug entry; a report without drugs gives none."""
    paths = {"activesubstancename": "activesubstance.activesubstancename"}
    return _entries(reports, "report.patient.drug", keep).select(
        "patientid",
        *[F.col(f"entry.{paths.get(n, n)}").alias(n) for n in DRUG_COLUMNS[1:]],
        *keep,
    )


def extract_reaction(reports: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per reaction entry; a report without reactions gives none."""
    return _entries(reports, "report.patient.reaction", keep).select(
        "patientid", *[F.col(f"entry.{n}").alias(n) for n in REACTION_COLUMNS[1:]], *keep
    )


EXTRACTORS = {
    "patient": extract_patient,
    "drug": extract_drug,
    "reaction": extract_reaction,
}
