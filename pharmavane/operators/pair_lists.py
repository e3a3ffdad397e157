"""Pairs of items within reports, kept as lists.

All pairs of a report are quadratic in it; its list of items says the same and is not.
A report has one sorted list, or several of bounded length where it has very many
items. Pairs are made from the lists only for what is asked: one item, or a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.operators import star
from pharmavane.operators.skew import join_small

LIST_ITEMS = 200  # items that a list holds on average at most


def report_lists(patient: DataFrame, entries: DataFrame, item: str = "medicinalproduct", list_items: int = LIST_ITEMS) -> DataFrame:
    """``report, part, parts, items, n_rows``: the distinct items of every report.

    ``items`` is sorted, without nulls; ``n_rows`` counts the entries behind it. The lists
    of a report are disjoint; a report of up to ``list_items`` items has one. Repeated
    entries merge before the shuffle, and one that joins no patient is left out.
    """
    known = patient.select("patientid", star.report_id().alias("report"))
    named = entries.select("patientid", F.col(item).alias("item")).filter("item IS NOT NULL")
    merged = named.groupBy("patientid", "item").agg(F.count("*").alias("n"))
    listed = merged.join(known, "patientid").groupBy("report", "item").agg(F.sum("n").alias("n"))
    sizes = listed.groupBy("report").agg(F.count("*").alias("size")).filter(F.col("size") > list_items)
    parts = sizes.select("report", F.ceil(F.col("size") / list_items).cast("int").alias("parts"))
    spread = join_small(listed, parts, "report", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int").alias("part")
    return spread.groupBy("report", "parts", part).agg(
        F.sort_array(F.collect_list("item")).alias("items"), F.sum("n").alias("n_rows")
    ).select("report", "part", "parts", "items", "n_rows")


def pairs_with(lists: DataFrame, item: str) -> DataFrame:
    """``report, other``: what each report lists beside ``item``.

    Only lists that hold the item are opened; the other lists of a long report follow
    through its name.
    """
    holds = F.array_contains("items", item)
    others: Column = F.explode(F.array_remove("items", item)).alias("other")
    short = lists.filter((F.col("parts") == 1) & holds)
    long = lists.filter(F.col("parts") > 1)
    beside = long.join(long.filter(holds).select("report"), "report", "left_semi")
    return short.select("report", others).unionByName(beside.select("report", others))


def all_pairs(lists: DataFrame) -> DataFrame:
    """``report, a, b`` with ``a < b``: every pair of every report, made as they are read.

    As many rows as the reports have pairs; filter the lists first. Two lists of one
    report meet by their numbers, so no task makes more than the pairs of two lists.
    """
    later = lists.select("report", F.col("part").alias("other_part"), F.col("items").alias("others"))
    own = lists.select("report", F.col("part").alias("other_part"), "part", "items", F.col("items").alias("others"))
    met = lists.filter("parts > 1").select("report", "part", "items").join(later, "report").filter("part < other_part")
    both = own.unionByName(met)
    first = both.select("report", "part", "other_part", "others", F.explode("items").alias("x"))
    pairs = first.select("report", "x", (F.col("part") == F.col("other_part")).alias("same"), F.explode("others").alias("y"))
    wanted = pairs.filter("x <> y AND (NOT same OR x < y)")
    return wanted.select("report", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def pair_counts(lists: DataFrame, item: str) -> DataFrame:
    """``other, n_reports``: with how many reports each item stands beside ``item``."""
    return pairs_with(lists, item).groupBy("other").agg(F.count("*").alias("n_reports"))
