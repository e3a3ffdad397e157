"""The safety questions. Inputs are cleaned tables; counts are of reports.

Every count first brings the rows to one per group and report, which spreads
a frequent drug or year over all tasks by report, and then counts with
partial sums. Windows run over the small grouped results only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.functions import decode
from pharmavane.operators.star import older, report_id, serious_only
from pharmavane.schemas import AGE, SERIOUSNESS_FLAGS

EVENT_TYPES = {
    "seriousnessdeath": "death",
    "seriousnesshospitalization": "hospitalization",
    "seriousnessdisabling": "disability",
    "seriousnesslifethreatening": "life_threatening",
    "seriousnessother": "other",
}


def top_serious_meds(
    patient: DataFrame,
    drug: DataFrame,
    k: int = 10,
    min_age: float = 65,
    name: str = "medicinalproduct",
) -> DataFrame:
    """The k drugs in most serious reports of the older population."""
    reports = serious_only(older(patient, min_age)).select("patientid", report_id().alias("_report"))
    return (
        drug.filter(F.col(name).isNotNull())
        .select("patientid", name)
        .join(reports, "patientid")
        .groupBy(name)
        .agg(F.count_distinct("_report").alias("n_reports"))
        .orderBy(F.desc("n_reports"), name)
        .limit(k)
    )


def _drug_reports(patient: DataFrame, drug: DataFrame, name: str, values: dict) -> DataFrame:
    """One row per drug and report, with flags true where any row has them."""
    rows = patient.select("patientid", report_id().alias("_report"), *[
        v.alias(k) for k, v in values.items()
    ])
    return (
        drug.filter(F.col(name).isNotNull())
        .select("patientid", name)
        .join(rows, "patientid")
        .groupBy(name, "_report")
        .agg(*[F.max(k).alias(k) for k in values])
    )


def event_types_wide(
    patient: DataFrame, drug: DataFrame, min_age: float = 65, name: str = "medicinalproduct"
) -> DataFrame:
    """Per drug, the reports with each event type, one column per type."""
    flags = {label: F.col(flag) for flag, label in EVENT_TYPES.items()}
    return (
        _drug_reports(older(patient, min_age), drug, name, flags)
        .groupBy(name)
        .agg(*[F.count_if(t).alias(t) for t in flags])
    )


def event_types_by_drug(
    patient: DataFrame, drug: DataFrame, min_age: float = 65, name: str = "medicinalproduct"
) -> DataFrame:
    """Per drug and event type, the number of reports, where there are any.

    The rows are turned after the counting: one row per drug, not per report.
    """
    wide = event_types_wide(patient, drug, min_age, name)
    long = wide.unpivot(name, list(EVENT_TYPES.values()), "event_type", "n_reports")
    return long.filter(F.col("n_reports") > 0)


def event_type_rank(
    patient: DataFrame, drug: DataFrame, min_age: float = 65, name: str = "medicinalproduct"
) -> DataFrame:
    """Share and rank of each event type within its drug (at most five rows a drug)."""
    counts = event_types_by_drug(patient, drug, min_age, name)
    whole = Window.partitionBy(name)
    return counts.select(
        name,
        "event_type",
        "n_reports",
        (F.col("n_reports").cast("double") / F.sum("n_reports").over(whole)).alias("share"),
        F.rank().over(whole.orderBy(F.desc("n_reports"))).alias("event_rank"),
    )


def yearly_trend(
    patient: DataFrame,
    drug: DataFrame | None = None,
    product: str | None = None,
    name: str = "medicinalproduct",
) -> DataFrame:
    """Reports and serious reports per year received, and the change on the year before.

    The change is null where the year before has no reports, not one against an
    earlier year.

    With ``drug`` and ``product``, only reports that list the product. The
    window runs over one row per year.
    """
    reports = patient
    if drug is not None and product is not None:
        listed = drug.filter(F.col(name) == product).select("patientid").distinct()
        reports = patient.join(listed, "patientid", "left_semi")
    year = decode.year_of_text(F.col("receivedate"))
    per_year = (
        reports.select(year.alias("year"), report_id().alias("_report"), "serious")
        .filter(F.col("year").isNotNull())
        .groupBy("year", "_report")
        .agg(F.max("serious").alias("serious"))
        .groupBy("year")
        .agg(F.count("*").alias("n_reports"), F.count_if("serious").alias("n_serious"))
    )
    before = Window.orderBy("year").rangeBetween(-1, -1)
    return per_year.select(
        "year",
        "n_reports",
        "n_serious",
        (F.col("n_reports") - F.max("n_reports").over(before)).alias("change_reports"),
        (F.col("n_serious") - F.max("n_serious").over(before)).alias("change_serious"),
    )


def rolling_serious_share(
    patient: DataFrame, drug: DataFrame, years: int = 3, name: str = "medicinalproduct"
) -> DataFrame:
    """Per drug and year, the serious share of its reports over the last years."""
    values = {"year": decode.year_of_text(F.col("receivedate")), "serious": F.col("serious")}
    rows = patient.select(
        "patientid", report_id().alias("_report"), *[v.alias(k) for k, v in values.items()]
    ).filter(F.col("year").isNotNull())
    per_year = (
        drug.filter(F.col(name).isNotNull())
        .select("patientid", name)
        .join(rows, "patientid")
        .groupBy(name, "year", "_report")
        .agg(F.max("serious").alias("serious"))
        .groupBy(name, "year")
        .agg(F.count("*").alias("n_reports"), F.count_if("serious").alias("n_serious"))
    )
    span = Window.partitionBy(name).orderBy("year").rangeBetween(-(years - 1), 0)
    return per_year.withColumns(
        {
            "rolling_reports": F.sum("n_reports").over(span),
            "rolling_serious": F.sum("n_serious").over(span),
        }
    ).withColumn(
        "serious_share", F.col("rolling_serious").cast("double") / F.col("rolling_reports")
    )


def age_band_risk(patient: DataFrame) -> DataFrame:
    """Reports, serious reports and each event type by age band, with shares."""
    flags = {label: F.col(flag) for flag, label in EVENT_TYPES.items()}
    reports = (
        patient.select(
            decode.age_band(F.col(AGE)).alias("age_band"),
            report_id().alias("_report"),
            "serious",
            *[v.alias(k) for k, v in flags.items()],
        )
        .filter(F.col("age_band").isNotNull())
        .groupBy("age_band", "_report")
        .agg(*[F.max(c).alias(c) for c in ["serious", *flags]])
    )
    return (
        reports.groupBy("age_band")
        .agg(
            F.count("*").alias("n_reports"),
            F.count_if("serious").alias("n_serious"),
            *[F.count_if(t).alias(t) for t in flags],
        )
        .withColumn("serious_share", F.col("n_serious").cast("double") / F.col("n_reports"))
        .withColumn("death_share", F.col("death").cast("double") / F.col("n_reports"))
    )


def age_group_counts(patient: DataFrame) -> DataFrame:
    return patient.groupBy("patientagegroup").count()


def start_years(raw_drug: DataFrame) -> DataFrame:
    """The distinct years in which raw start dates fall, ascending."""
    return (
        raw_drug.select("drugstartdate")
        .filter(F.col("drugstartdate").isNotNull())
        .groupBy(decode.year_of_text(F.col("drugstartdate")).alias("year"))
        .count()
        .select("year")
        .distinct()
        .orderBy(F.asc("year"))
    )


def start_year_counts(raw_drug: DataFrame) -> DataFrame:
    year = decode.year_of_text(F.col("drugstartdate"))
    return raw_drug.filter(F.col("drugstartdate").isNotNull()).groupBy(year.alias("year")).count()


def rows_with_start(raw_drug: DataFrame, text: str) -> DataFrame:
    """Raw rows with one exact start date text, such as a typing error."""
    start = F.col("drugstartdate")
    return raw_drug.filter(start.isNotNull() & (start == F.lit(text)))
