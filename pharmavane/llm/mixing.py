"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a budget of words. Whole passes over the source come first; what
remains is fitted by choosing how many documents of each exact length to take once
more: an even share of every length, then a bounded-knapsack dynamic program over
the documents left for the last stretch. The documents of a length are those with
the smallest seeded hashes, so a rerun takes the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import column, count_words, staged

GROUP_ROWS = 4096  # documents of one source and length that are ranked together


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, their sum nearest to ``budget``.

    The last stretch, four times the longest length, is left to the dynamic program,
    so a budget within it is met as nearly as any choice can. Before it the same
    share of every length is taken, rounded down, and then single documents, longest
    first, up to that stretch. In it reachable sums are a bit set; ``last`` remembers by which block of equal documents a sum was first
    reached, which gives the counts back. Of two sums equally near the smaller wins.
    """
    total = int((lengths * counts).sum())
    if budget >= total or not len(lengths):
        return counts.copy()
    longest = int(lengths.max())
    even = max(0, budget - 4 * longest)
    taken = np.array([int(c) * even // total for c in counts], np.int64)
    left = budget - int((lengths * taken).sum())
    for k in np.argsort(-lengths, kind="stable"):
        spare = left - 4 * longest
        if spare < 0:
            break
        more = min(int(counts[k] - taken[k]), spare // int(lengths[k]))
        taken[k] += more
        left -= more * int(lengths[k])
    limit = left + longest
    mask, reached = (1 << (limit + 1)) - 1, 1
    last = np.full(limit + 1, -1, np.int64)
    blocks: list[tuple[int, int]] = []  # index of the length, documents in the block
    for k, length in enumerate(map(int, lengths)):
        free, size = min(int(counts[k] - taken[k]), limit // length), 1
        while free > 0 and not reached >> left & 1:
            size = min(size, free)
            new = (reached << size * length) & mask & ~reached
            if new:
                flags = np.frombuffer(new.to_bytes(limit // 8 + 1, "little"), np.uint8)
                last[np.flatnonzero(np.unpackbits(flags, count=limit + 1, bitorder="little"))] = len(blocks)
                blocks.append((k, size))
                reached |= new
            free, size = free - size, 2 * size
    at = next(s for d in range(limit + 1) for s in (left - d, left + d) if 0 <= s <= limit and reached >> s & 1)
    while at:
        k, size = blocks[last[at]]
        taken[k] += size
        at -= size * int(lengths[k])
    return taken


def water_level(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Add ``target`` to ``source, source_size, weight``.

    The targets share ``share`` times all words by weight; none passes ``cap`` times
    its source, and what is above goes to the others by weight until none is above.
    Each round is two sums over the table; a source that is capped stays capped.
    """
    if share > cap:
        raise ValueError("the share of all words cannot exceed the cap of each source")
    level, capped = 0.0, -1
    most = F.lit(cap) * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while total:
        above = F.lit(level) * F.col("weight") >= most
        full, open_weight, n = sources.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight").cast("double"))), F.lit(0.0)),
            F.count_if(above),
        ).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (share * total - full) / open_weight
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), most))


def source_weights(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``source, source_size, weight``: weights repeat over sources in code point order.

    Null is a source and comes last. Positions are counted over a sorted table, in
    as many tasks as it has partitions.
    """
    sums = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = sums.orderBy(F.col("source").asc_nulls_last())
    placed = ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], float(weights[x[1] % len(weights)])))
    return sizes.sparkSession.createDataFrame(placed, "source string, source_size long, weight double")


def _ranked(rows: DataFrame, seed: int) -> DataFrame:
    """Add ``rank`` (from 1) by seeded hash within each source and length.

    A group of ``n`` documents is cut by hash ranges into pieces of about
    ``GROUP_ROWS``; a rank is that within the piece and the rows of the pieces
    before, so no group is sorted in one task.
    """
    key = ["source", "size"]
    pieces = F.ceil(F.col("n") / GROUP_ROWS)
    high = F.shiftright(F.col("order"), 11) + (1 << 52)  # 0 to 2^53: exact as a double
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "uid"))
    rows = rows.withColumn("piece", F.floor(high / float(1 << 53) * pieces))
    counts = rows.filter(F.col("n") > GROUP_ROWS).groupBy(*key, "piece").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("piece").alias("p"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
    )
    within = F.row_number().over(Window.partitionBy(*key, "piece").orderBy("order", "doc_id", "uid", "twin"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("piece") == F.col("p"))
    found = rows.withColumn("within", within).join(starts, same, "left")
    return found.withColumn("rank", F.col("within") + F.coalesce("start", F.lit(0)))


def plan_mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size: Column | None = None,
    twin: Column | None = None,
) -> DataFrame:
    """``doc_id, uid, twin, size, source, source_size, target, copies, taken`` of every row.

    ``size`` is the number of words unless given; ``copies`` says how often the mix
    takes the row, ``taken`` is their size. A row is taken the whole passes its
    target allows, and once more if it is chosen. Null texts and texts without words
    have size 0 and no copies; ``uid`` is a hash of the text that tells apart rows
    with one id, ``twin`` (0 unless given) those with one text too; equal rows are chosen
    among each other arbitrarily, with the same sum. An empty table gives no rows; further columns are left out.

    The table of lengths has a row for each length of a source: the lengths of a
    source are fewer than the root of twice its words, and one task fits them.
    """
    size = count_words(docs[text_col]) if size is None else size
    sized = staged(
        docs.select(
            docs[id_col].cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("uid"),
            (F.lit(0).cast("long") if twin is None else twin).alias("twin"),
            docs[source_col].cast("string").alias("source"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    lengths = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    targets = staged(water_level(staged(source_weights(lengths, weights), "sources"), share, cap), "targets")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size")
        sizes, counts = part["size"].to_numpy(np.int64), part["n"].to_numpy(np.int64)
        target, whole = float(part["target"].iloc[0]), int(part["source_size"].iloc[0])
        passes = int(target // whole) if whole else 0
        real = sizes > 0
        extra = np.zeros(len(part), np.int64)
        extra[real] = fit_counts(sizes[real], counts[real], round(target - passes * whole))
        return part.assign(passes=np.where(real, passes, 0), extra=extra)

    known = targets.select(F.col("source").alias("s"), "source_size", "target")
    # The join of a length table with its sources: both are small beside the rows.
    fitted = lengths.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s").groupBy("source").applyInPandas(
        fit, "source string, size long, n long, source_size long, target double, passes long, extra long"
    )
    fitted = staged(fitted, "fitted")
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.size") == F.col("r.size"))
    rows = sized.alias("l").join(fitted.alias("r"), same).select("l.*", "n", "source_size", "target", "passes", "extra")
    ranked = _ranked(staged(rows, "rows"), seed)
    copies = (F.col("passes") + F.when(F.col("rank") <= F.col("extra"), F.lit(1)).otherwise(F.lit(0))).alias("copies")
    found = ranked.select("doc_id", "uid", "twin", "size", "source", "source_size", "target", copies)
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def _row_keys(*parts: Column) -> dict[str, Column]:
    """128 bits of what identifies a row, so that null parts join like any other."""
    return {"_k1": F.xxhash64(*parts), "_k2": F.xxhash64(F.lit(1), *parts)}


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the plan takes it.

    Rows are matched by all their columns. Of rows equal in all of them one stands for
    all the copies that the plan gives them together, so nothing of a row is lost.
    """
    others = [column(c) for c in docs.columns if c not in (id_col, text_col, source_col)]
    twin = F.xxhash64(F.to_json(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(others)]))) if others else F.lit(0).cast("long")
    plan = plan_mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, twin=twin, **options)
    keys = _row_keys(F.col("doc_id"), F.col("uid"), F.col("source"), F.col("twin"))
    plan = plan.withColumns(keys).groupBy("_k1", "_k2").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    plan = staged(plan.filter("_copies > 0"), "copies")
    uid = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    keys = _row_keys(docs[id_col].cast("long"), uid, docs[source_col].cast("string"), twin)
    whole = F.struct(*map(column, docs.columns)).alias("row")
    keyed = docs.select(whole, *[key.alias(name) for name, key in keys.items()])
    taken = keyed.join(plan.filter("_rows = 1"), ["_k1", "_k2"])
    repeated = plan.filter("_rows > 1")
    if not repeated.isEmpty():
        taken = taken.unionByName(keyed.join(repeated, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]))
    times = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return taken.select("row", times).select("row.*")
