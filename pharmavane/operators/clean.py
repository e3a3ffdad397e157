"""Raw tables to typed, decoded, unit-normalised tables.

Each cleaner has a cast step and a transform step, one projection each, with
no shuffle and no Python in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pharmavane.functions import casts, codes, decode
from pharmavane.schemas import AGE, DOSE, DURATION, SERIOUSNESS_FLAGS


def cast_patient(df: DataFrame) -> DataFrame:
    ints = [
        "patientonsetage", "patientonsetageunit", "patientsex", "serious",
        *SERIOUSNESS_FLAGS, "safetyreportid",
    ]
    strings = ["patientid", "patientagegroup", "receivedate", "receiptdate"]
    return df.withColumns(
        {n: casts.to_string(n) for n in strings}
        | {n: casts.to_int(df, n) for n in ints}
        | {"patientweight": casts.to_float("patientweight")}
    )


def transform_patient(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    c = F.col
    return df.select(
        "patientid",
        decode.age_group(c("patientagegroup")).alias("patientagegroup"),
        decode.sex(c("patientsex")).alias("patientsex"),
        decode.valid_weight(c("patientweight")).alias("patientweight"),
        decode.serious(c("serious")).alias("serious"),
        *[decode.flag(c(n)).alias(n) for n in SERIOUSNESS_FLAGS],
        "receivedate",
        "receiptdate",
        "safetyreportid",
        decode.age_years(c("patientonsetage"), c("patientonsetageunit")).alias(AGE),
        *keep,
    )


def cast_drug(df: DataFrame) -> DataFrame:
    strings = [
        "patientid", "medicinalproduct", "activesubstancename", "drugindication",
        "drugadministrationroute", "drugstartdate", "drugenddate", "drugdosagetext",
        "drugstructuredosageunit", "drugtreatmentdurationunit",
    ]
    ints = ["drugtreatmentduration", "drugrecurreadministration"]
    return df.withColumns(
        {n: casts.to_string(n) for n in strings}
        | {n: casts.to_int(df, n) for n in ints}
        | {"drugstructuredosagenumb": casts.to_float("drugstructuredosagenumb")}
    ).withColumnRenamed("drugtreatmentduration", "drugtreatmentdurationnumb")


def transform_drug(
    df: DataFrame, dose_factors: dict = codes.DOSE_TO_MG, keep: tuple[str, ...] = ()
) -> DataFrame:
    c = F.col
    return df.select(
        "patientid",
        "medicinalproduct",
        "activesubstancename",
        "drugindication",
        decode.route(c("drugadministrationroute")).alias("drugadministrationroute"),
        decode.partial_date(c("drugstartdate")).alias("drugstartdate"),
        decode.partial_date(c("drugenddate")).alias("drugenddate"),
        "drugdosagetext",
        decode.dose_mg(
            c("drugstructuredosagenumb"), c("drugstructuredosageunit"), dose_factors
        ).alias(DOSE),
        decode.duration_days(
            c("drugtreatmentdurationnumb"), c("drugtreatmentdurationunit")
        ).alias(DURATION),
        decode.recurrence(c("drugrecurreadministration")).alias(
            "drug_reaction_after_readministration"
        ),
        *keep,
    )


def cast_reaction(df: DataFrame) -> DataFrame:
    names = ["patientid", "reactionmeddrapt", "reactionoutcome"]
    return df.withColumns({n: casts.to_string(n) for n in names})


def transform_reaction(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        "patientid",
        "reactionmeddrapt",
        decode.outcome(F.col("reactionoutcome")).alias("reactionoutcome"),
        *keep,
    )


def clean_patient(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast and transform. ``keep`` carries other columns along, such as the year."""
    return df.transform(cast_patient).transform(transform_patient, keep)


def clean_drug(
    df: DataFrame, dose_factors: dict = codes.DOSE_TO_MG, keep: tuple[str, ...] = ()
) -> DataFrame:
    return df.transform(cast_drug).transform(transform_drug, dose_factors, keep)


def clean_reaction(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.transform(cast_reaction).transform(transform_reaction, keep)


CLEANERS = {"patient": clean_patient, "drug": clean_drug, "reaction": clean_reaction}


def clean_entity(df: DataFrame, entity: str) -> DataFrame:
    """Clean a table by entity name; a name without a cleaner passes through."""
    return df.transform(CLEANERS[entity]) if entity in CLEANERS else df


def clean_path(df: DataFrame, path: str) -> DataFrame:
    """Clean a table by where it lies: the last path segment names the entity."""
    return clean_entity(df, path.rstrip("/").split("/")[-1])
