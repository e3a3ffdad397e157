"""Star schema over the cleaned tables: dimensions, facts, key checks.

Keys of the drug and reaction dimensions are hashes of the natural key, so a
fact computes them from its own columns and needs no join with a dimension
that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.functions import codes, decode
from pharmavane.operators import key_filter
from pharmavane.operators.skew import join_small, split_heavy, stage
from pharmavane.schemas import AGE, DOSE, SERIOUSNESS_FLAGS

DRUG_KEY = ["medicinalproduct", "activesubstancename", "drugadministrationroute"]
REACTION_KEY = ["reactionmeddrapt"]
HEAVY_REPORT = 100_000  # rows from which a report is merged where its rows lie, before they meet


_UNIT_SEPARATOR, _NULL_MARK = "\x1f", "\x1e"


def natural_key(columns: list[str]) -> Column:
    """SHA-256 of the columns, joined and null-marked by characters no name holds."""
    parts = [F.coalesce(F.col(c), F.lit(_NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(_UNIT_SEPARATOR, *parts), 256)


def report_id() -> Column:
    """What counts as one report: its report id, or the row where it has none."""
    return F.coalesce(
        F.concat(F.lit("report:"), F.col("safetyreportid").cast("string")),
        F.concat(F.lit("row:"), F.col("patientid")),
    )


def older(patient: DataFrame, min_age: float = 65) -> DataFrame:
    return patient.filter(F.col(AGE) >= min_age)


def serious_only(patient: DataFrame) -> DataFrame:
    return patient.filter(F.col("serious"))


def report_drugs(patient: DataFrame, drug: DataFrame) -> DataFrame:
    """Patient rows with their drug rows. A hot report is split by AQE."""
    return patient.join(drug, "patientid")


def report_reactions(patient: DataFrame, reaction: DataFrame) -> DataFrame:
    return patient.join(reaction, "patientid")


def orphans(child: DataFrame, parent: DataFrame, filter_from: int = key_filter.FILTER_FROM) -> DataFrame:
    """Rows of ``child`` whose report is not in ``parent``; those without a report are among them.

    From ``filter_from`` reports on, a filter of the parent's keys tells most orphans where
    they lie. Of the other rows only the distinct keys meet the parent's in a shuffle; what
    is missing there, the few keys that passed wrongly, goes back to the rows. So rows of
    ``child`` are sent nowhere unless those few keys are too many to be broadcast.
    """
    keys = parent.select("patientid")
    columns = ["patientid", *[c for c in child.columns if c != "patientid"]]
    held = key_filter.build(keys, "patientid", filter_from)
    if held is None:
        return child.join(keys, "patientid", "left_anti").select(*columns)
    rows = held.mark(child, "patientid", "_held")
    passed = held.mark(child.select("patientid"), "patientid", "_held").filter("_held").select("patientid")
    lost = stage(passed.distinct().join(keys, "patientid", "left_anti"), "lost")
    rows = join_small(rows, lost.withColumn("_lost", F.lit(True)), "patientid", "left")
    return rows.filter("NOT _held OR _lost").select(*columns)


def having(parent: DataFrame, child: DataFrame, filter_from: int = key_filter.FILTER_FROM) -> DataFrame:
    """Rows of ``parent`` with at least one row in ``child``.

    Child keys are made distinct first, so a report with many rows costs one. From
    ``filter_from`` of them on, a filter stops most parents without one before the shuffle.
    """
    keys = child.select("patientid")
    columns = ["patientid", *[c for c in parent.columns if c != "patientid"]]
    held = key_filter.build(keys, "patientid", filter_from)
    if held is None:
        return parent.join(keys.distinct(), "patientid", "left_semi").select(*columns)
    passed = held.mark(parent, "patientid", "_held").filter("_held")
    # A semi join would be pushed below the filter; an inner one with distinct keys is not.
    return passed.join(keys.distinct(), "patientid").select(*columns)


def route_dimension(spark: SparkSession) -> DataFrame:
    entries = F.create_map(*[F.lit(x) for pair in codes.ROUTES.items() for x in pair])
    return spark.range(1).select(F.explode(entries).alias("route_code", "route"))


def with_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join with a dimension, which is broadcast only if it proves small."""
    return join_small(fact, dim, key, "left")


def dim_patient(patient: DataFrame) -> DataFrame:
    return patient.withColumn("age_band", decode.age_band(F.col(AGE)))


def dim_drug(drug: DataFrame) -> DataFrame:
    return drug.select(*DRUG_KEY).distinct().select(natural_key(DRUG_KEY).alias("drug_key"), "*")


def dim_reaction(reaction: DataFrame) -> DataFrame:
    named = reaction.select(*REACTION_KEY).distinct()
    return named.select(natural_key(REACTION_KEY).alias("reaction_key"), "*")


def dim_date(fact: DataFrame, *dates: str) -> DataFrame:
    """A calendar over the range of one or more date columns; empty for no dates."""
    lows, highs = [F.min(d) for d in dates], [F.max(d) for d in dates]
    span = fact.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
    )
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key")
    )
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
    )


def _patient_keys(patient: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return patient.select(
        "patientid",
        *keep,
        report_id().alias("report_id"),
        decode.partial_date(F.col("receivedate")).alias("date_key"),
        decode.age_band(F.col(AGE)).alias("age_band"),
        "serious",
        *SERIOUSNESS_FLAGS,
    )


def _fact(
    patient: DataFrame, mentions: DataFrame, natural: list[str], key: str, merge: list[Column],
    keep: tuple[str, ...], tasks: int | None,
) -> DataFrame:
    """Mentions merged by report and key, with the report's columns; ``merge`` may be applied twice.

    With ``tasks`` the rows are sent once, by report over so many tasks, for the merge, the
    join and what follows; reports of very many rows are merged before that.
    """
    person = _patient_keys(patient, keep)
    if tasks:
        mentions, heavy = split_heavy(mentions, "patientid", HEAVY_REPORT)
        if heavy is not None:
            mentions = mentions.unionByName(heavy.groupBy("patientid", *natural).agg(*merge))
        mentions, person = (rows.repartition(tasks, "patientid") for rows in (mentions, person))
    merged = mentions.groupBy("patientid", natural_key(natural).alias(key)).agg(*merge)
    return merged.join(person, "patientid")


def fact_drug(
    patient: DataFrame, drug: DataFrame, keep: tuple[str, ...] = (), tasks: int | None = None
) -> DataFrame:
    """One row per report and drug; ``keep`` carries columns of the patient along, here and below.

    Mentions are merged before the join, so a report that repeats a drug, or
    holds very many rows, reaches the join as its distinct drugs. With ``tasks``
    the rows come out spread by report over so many tasks.
    """
    mentions = drug.select(
        "patientid",
        *DRUG_KEY,
        F.lit(1).cast("long").alias("n_mentions"),
        F.col("drugstartdate").alias("first_start"),
        F.col("drugenddate").alias("last_end"),
        F.col(DOSE).alias("max_dose_mg"),
    )
    ends = [F.min("first_start").alias("first_start"), F.max("last_end").alias("last_end"), F.max("max_dose_mg").alias("max_dose_mg")]
    return _fact(patient, mentions, DRUG_KEY, "drug_key", [F.sum("n_mentions").alias("n_mentions"), *ends], keep, tasks)


def fact_reaction(
    patient: DataFrame, reaction: DataFrame, keep: tuple[str, ...] = (), tasks: int | None = None
) -> DataFrame:
    """One row per report and reaction term."""
    fatal = F.col("reactionoutcome").eqNullSafe(codes.OUTCOMES["5"])
    counts = {"n_mentions": F.lit(1), "n_fatal": fatal.cast("int")}
    mentions = reaction.select("patientid", *REACTION_KEY, *[c.cast("long").alias(n) for n, c in counts.items()])
    return _fact(patient, mentions, REACTION_KEY, "reaction_key", [F.sum(n).alias(n) for n in counts], keep, tasks)
