"""Disproportionality: drug pairs, and drugs with reactions.

Both count how many reports name two items together. Ordinary reports become
one sorted item list each; equal lists merge into one with a weight before any
pair is formed, and a list is at most ``basket_limit`` long, so the pairs grow
linearly with the rows. Reports above the limit go another, equally exact way
that forms only pairs which can still reach the minimum support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.operators.skew import split_heavy, stage
from pharmavane.operators.star import report_id

BASKET_LIMIT = 200
_SALTS = 32


def report_items(patient: DataFrame, child: DataFrame, item: str, side: str) -> DataFrame:
    """Distinct ``(report, side, item)`` of the reports in ``patient``."""
    reports = patient.select("patientid", report_id().alias("report"))
    named = child.filter(F.col(item).isNotNull()).select("patientid", F.col(item).alias("item"))
    return (
        named.join(reports, "patientid")
        .select("report", F.lit(side).alias("side"), "item")
        .distinct()
    )


def _light_pairs(items: DataFrame, within: bool) -> DataFrame:
    """Pair counts over reports of bounded length, from weighted item lists."""

    def listed(side: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("item"))))

    baskets = (
        items.groupBy("report")
        .agg(listed("a").alias("xs"), listed("b").alias("ys"))
        .filter(F.size("xs") > 1 if within else (F.size("xs") > 0) & (F.size("ys") > 0))
        .groupBy("xs", "ys")
        .agg(F.count("*").alias("w"))
    )
    if within:
        firsts = baskets.select("w", "xs", F.posexplode("xs").alias("i", "a"))
        rest = F.slice("xs", F.col("i") + 2, F.size("xs"))
        pairs = firsts.select("w", "a", F.explode(rest).alias("b"))
    else:
        firsts = baskets.select("w", "ys", F.explode("xs").alias("a"))
        pairs = firsts.select("w", "a", F.explode("ys").alias("b"))
    return pairs.groupBy("a", "b").agg(F.sum("w").alias("n"))


def _distinct_baskets(items: DataFrame) -> DataFrame:
    """One report of each group with equal item sets, weighted by the group's size.

    Sets are compared by a 128-bit fingerprint that does not depend on order.
    """
    prints = items.groupBy("report").agg(
        F.count("*").alias("_n"),
        F.bit_xor(F.xxhash64("side", "item")).alias("_p"),
        F.bit_xor(F.xxhash64("item", F.lit(1), "side")).alias("_q"),
    )
    kept = prints.groupBy("_n", "_p", "_q").agg(
        F.min("report").alias("report"), F.count("*").alias("w")
    )
    return items.join(kept.select("report", "w"), "report")


def _heavy_pairs(
    items: DataFrame, light: DataFrame, within: bool, min_n: int
) -> list[DataFrame]:
    """Counts of the pairs in very long reports that can reach ``min_n``.

    A pair no ordinary report has needs ``min_n`` long reports, so both items
    are in that many: only such (dense) items are paired with each other, in
    salted parts. A pair with another (sparse) item must be among the ordinary
    pairs; each of those looks up the fewer than ``min_n`` reports of that item.
    """
    right_side = "a" if within else "b"
    weighted = _distinct_baskets(items)
    support = weighted.groupBy("side", "item").agg((F.sum("w") >= min_n).alias("dense"))
    rows = stage(weighted.join(support, ["side", "item"]), "long_reports")
    left = rows.filter(F.col("side") == "a").select("report", F.col("item").alias("a"), "w", "dense")
    right = rows.filter(F.col("side") == right_side).select(
        "report", F.col("item").alias("b"), F.col("dense").alias("b_dense")
    )

    salt = F.pmod(F.xxhash64("a"), F.lit(_SALTS))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)).cast("array<bigint>"))
    dense = (
        left.filter("dense")
        .withColumn("salt", salt)
        .join(right.filter("b_dense").withColumn("salt", every_salt), ["report", "salt"])
    )
    if within:
        dense = dense.filter(F.col("a") < F.col("b"))
    by_left = (
        light.select("a", "b")
        .join(left.filter(~F.col("dense")), "a")
        .join(right, ["report", "b"])
    )
    by_right = (
        light.select("a", "b")
        .join(right.filter(~F.col("b_dense")), "b")
        .join(left.filter("dense"), ["report", "a"])
    )
    return [
        found.groupBy("a", "b").agg(F.sum("w").alias("n")) for found in (dense, by_left, by_right)
    ]


def pair_counts(
    items: DataFrame, within: bool, min_n: int, basket_limit: int = BASKET_LIMIT
) -> DataFrame:
    """``(a, b, n)``: pairs of items in at least ``min_n`` reports together.

    ``items`` is a stored table of distinct ``(report, side, item)``; pairs are
    of side 'a' with side 'b', or of side 'a' within itself with ``a < b``.
    """
    ordinary, heavy = split_heavy(items, "report", basket_limit)
    counts = _light_pairs(ordinary, within)
    if heavy is not None:
        light = stage(counts, "pairs")
        counts = light
        for more in _heavy_pairs(heavy, light, within, min_n):
            counts = counts.unionByName(more)
        counts = counts.groupBy("a", "b").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_n)


def two_by_two(counts: DataFrame, n_a: Column, n_b: Column, total: Column) -> dict[str, Column]:
    """Expected count, observed/expected, PRR and ROR; null for a zero divisor.

    With a = both, b = first only, c = second only, d = neither:
    PRR = (a/(a+b)) / (c/(c+d)), ROR = ad/bc.
    """
    a = F.col("n_reports").cast("double")
    x, y, t = n_a.cast("double"), n_b.cast("double"), total.cast("double")
    expected = x * y / t
    return {
        "expected": expected,
        "observed_expected": F.try_divide(a, expected),
        "prr": F.try_divide(F.try_divide(a, x), F.try_divide(y - a, t - x)),
        "ror": F.try_divide(a * (t - x - y + a), (x - a) * (y - a)),
    }


def _signal(
    patient: DataFrame, items: DataFrame, within: bool, names: tuple[str, str], min_n: int,
    basket_limit: int,
) -> DataFrame:
    total = patient.agg(F.count_distinct(report_id())).scalar()
    support = items.groupBy("side", "item").agg(F.count("*").alias("n"))
    n_first = support.filter(F.col("side") == "a").select(
        F.col("item").alias("a"), F.col("n").alias("n_first")
    )
    n_second = support.filter(F.col("side") == ("a" if within else "b")).select(
        F.col("item").alias("b"), F.col("n").alias("n_second")
    )
    pairs = pair_counts(items, within, min_n, basket_limit).withColumnRenamed("n", "n_reports")
    table = pairs.join(n_first, "a").join(n_second, "b").withColumn("n_total", total)
    measures = two_by_two(table, F.col("n_first"), F.col("n_second"), F.col("n_total"))
    return table.select(
        F.col("a").alias(names[0]),
        F.col("b").alias(names[1]),
        "n_reports",
        "n_first",
        "n_second",
        "n_total",
        *[m.alias(k) for k, m in measures.items()],
    )


def drug_pair_signal(
    patient: DataFrame,
    drug: DataFrame,
    min_n: int = 3,
    name: str = "medicinalproduct",
    basket_limit: int = BASKET_LIMIT,
) -> DataFrame:
    """Drug pairs in at least ``min_n`` reports, against chance."""
    items = stage(report_items(patient, drug, name, "a"), "items")
    return _signal(patient, items, True, ("drug_a", "drug_b"), min_n, basket_limit)


def drug_reaction_signal(
    patient: DataFrame,
    drug: DataFrame,
    reaction: DataFrame,
    min_n: int = 3,
    name: str = "medicinalproduct",
    basket_limit: int = BASKET_LIMIT,
) -> DataFrame:
    """Drugs with reaction terms in at least ``min_n`` reports, against chance."""
    drugs = report_items(patient, drug, name, "a")
    terms = report_items(patient, reaction, "reactionmeddrapt", "b")
    items = stage(drugs.unionByName(terms), "items")
    return _signal(patient, items, False, ("drug", "reaction"), min_n, basket_limit)


def drug_pairs(
    patient: DataFrame,
    drug: DataFrame,
    min_n: int = 3,
    name: str = "medicinalproduct",
    basket_limit: int = BASKET_LIMIT,
) -> DataFrame:
    """Pairs of drugs in at least ``min_n`` reports together, ``drug_a < drug_b``, with counts.

    ``min_n=1`` also lists pairs of a single report, quadratic in its length.
    """
    items = stage(report_items(patient, drug, name, "a"), "items")
    pairs = pair_counts(items, True, min_n, basket_limit)
    return pairs.select(F.col("a").alias("drug_a"), F.col("b").alias("drug_b"), F.col("n").alias("n_reports"))
