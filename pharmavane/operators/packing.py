"""Next-fit packing of an ordered table into size-bounded batches.

A batch takes rows in order until the next row would pass the cap; that row
opens the next batch. The running size restarts at every break, so a running
``sum`` window cannot express it and each row depends on the one before.

The order is cut into blocks of bounded length, and all blocks are summarised at
once: for every running size that a block may be entered with, where its first break
falls, and so what it ends with. Only rows of the block's first batch can be that
break, so a summary is as short as a batch. Summaries of neighbours compose, and by
doubling each block learns in logarithmically many rounds what it is entered with.
Then all blocks are packed from there, row by row. A block that ends with something
else than the next was told, which only rounding of sums can bring about, has the next
packed again until none differs; so the result is exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.operators.ordering import BLOCK_ROWS, block_of
from pharmavane.operators.skew import same_keys, stage
from pharmavane.session import shared_dir


def _size(name: str):
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def oversized(df: DataFrame, cap: float, size: str = "size_mb") -> DataFrame:
    """Rows larger than the cap by themselves; a missing size counts as 0."""
    return df.filter(_size(size) > cap)


def _next_fit(sizes: np.ndarray, run: float, cap: float) -> tuple[list[int], float]:
    """Breaks up to each row, and the running size after the last."""
    labels, breaks = [], 0
    for size in sizes.tolist():
        if run + size > cap:
            breaks, run = breaks + 1, size
        else:
            run = run + size
        labels.append(breaks)
    return labels, float(run)


class Summary:
    """What a run of rows makes of the running size it is entered with.

    Entered with more than ``limits[i]`` (falling), and not more than the limit before, the
    rows end with ``outs[i]`` after ``breaks[i]`` breaks; with less than any limit nothing
    breaks and ``total`` is added.
    """

    def __init__(self, limits: np.ndarray, outs: np.ndarray, breaks: np.ndarray, total: float):
        keep = np.ones(len(limits), bool)  # pieces that end alike are one, with the lower limit
        keep[:-1] = (outs[1:] != outs[:-1]) | (breaks[1:] != breaks[:-1])
        self.limits, self.outs, self.breaks, self.total = limits[keep], outs[keep], breaks[keep], total

    @staticmethod
    def of_rows(sizes: np.ndarray, cap: float) -> Summary:
        n, upto = len(sizes), np.cumsum(sizes)
        # A batch that row i opens breaks at row ends[i].
        ends = np.searchsorted(upto, cap + upto - sizes, "right")
        ends = np.maximum(ends, np.arange(n) + 1).tolist()
        breaks, last = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            j = ends[i]
            breaks[i], last[i] = (1 + breaks[j], last[j]) if j < n else (1, i)
        limits = cap - upto
        first = int(np.searchsorted(-limits, 0, "right")) + 1  # nothing is entered with less than 0
        start = np.array(last[:first], np.int64)
        limits, outs = limits[:first], upto[-1] - upto[start] + sizes[start]
        lower = np.ones(len(limits), bool)  # rows without size break nothing
        lower[1:] = limits[1:] < limits[:-1]
        return Summary(limits[lower], outs[lower], np.array(breaks[:first])[lower], float(upto[-1]))

    def enter(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(-self.limits, -np.asarray(run, float), "right")
        whole = at == len(self.limits)
        outs, breaks = np.append(self.outs, 0.0)[at], np.append(self.breaks, 0)[at]
        return np.where(whole, run + self.total, outs), breaks

    def then(self, after: Summary) -> Summary:
        """The summary of these rows and those of ``after`` behind them."""
        outs, more = after.enter(self.outs)
        low = self.limits[-1] if len(self.limits) else np.inf
        shifted = after.limits - self.total
        own = (shifted < low) & (low >= 0)
        # Of the pieces below zero only the first can be entered.
        own &= np.concatenate([[True], shifted[:-1] >= 0])[: len(shifted)]
        return Summary(
            np.append(self.limits, shifted[own]), np.append(outs, after.outs[own]),
            np.append(self.breaks + more, after.breaks[own]), self.total + after.total,
        )


_SUMMARY = "limits array<double>, outs array<double>, breaks array<long>, total double"


def _packed(found: list[Summary]) -> pd.DataFrame:
    return pd.DataFrame(
        {"limits": [s.limits for s in found], "outs": [s.outs for s in found], "breaks": [s.breaks for s in found], "total": [s.total for s in found]}
    )


def _unpacked(table: pd.DataFrame) -> list[Summary | None]:
    columns = [table["limits"], table["outs"], table["breaks"], table["total"]]
    return [
        None if a is None else Summary(np.asarray(a, float), np.asarray(b, float), np.asarray(c, np.int64), d)
        for a, b, c, d in zip(*columns)
    ]


def _entered(sizes: DataFrame, group: list[str], cap: float) -> DataFrame:
    """``sizes`` with ``run_in``: the running size that each block is entered with."""

    @F.pandas_udf(_SUMMARY)
    def summarise(rows: pd.Series) -> pd.DataFrame:
        return _packed([Summary.of_rows(np.asarray(s, float), cap) for s in rows])

    @F.pandas_udf(_SUMMARY)
    def joined(before: pd.DataFrame, after: pd.DataFrame) -> pd.DataFrame:
        return _packed([b if a is None else a.then(b) for a, b in zip(_unpacked(before), _unpacked(after))])

    @F.pandas_udf("double")
    def left(summary: pd.DataFrame) -> pd.Series:
        return pd.Series([float(s.enter(np.zeros(1))[0][0]) for s in _unpacked(summary)])

    keys = [*group, "_block"]
    in_order = Window.partitionBy(*group).orderBy("_block")
    placed = sizes.select(*keys, F.row_number().over(in_order).alias("_nth"))
    most = placed.agg(F.max("_nth")).first()[0] or 0
    if most < 2:
        return sizes.withColumn("run_in", F.lit(0.0))
    # A row for each block, however many rows the block has.
    known = sizes.select(*keys, summarise("_sizes").alias("_upto"))
    place = [*group, "_nth"]
    state = known.alias("k").join(placed.alias("p"), same_keys("k", "p", keys)).select("k.*", "p._nth").checkpoint()
    reach = 1
    while reach < most - 1:
        earlier = state.select(*group, (F.col("_nth") + reach).alias("_nth"), F.col("_upto").alias("_before"))
        state = (
            state.alias("s")
            .join(earlier.alias("e"), same_keys("s", "e", place), "left")
            .select(*[F.col(f"s.{c}") for c in [*keys, "_nth"]], F.col("s._upto"), F.col("e._before"))
        )
        state = state.select(*keys, "_nth", joined("_before", "_upto").alias("_upto")).checkpoint()
        reach *= 2
    ends = state.select(*group, (F.col("_nth") + 1).alias("_nth"), left("_upto").alias("_run"))
    starts = placed.alias("p").join(ends.alias("e"), same_keys("p", "e", place), "left")
    starts = starts.select(*[F.col(f"p.{k}").alias(k) for k in keys], F.coalesce("e._run", F.lit(0.0)).alias("run_in"))
    return sizes.alias("s").join(starts.alias("t"), same_keys("s", "t", keys)).select("s.*", "t.run_in")


def pack_next_fit(
    df: DataFrame,
    cap: float,
    size: str = "size_mb",
    seq: str = "seq",
    group: list[str] = [],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows within the cap, with a 1-based ``batch_id`` per group.

    ``seq`` is a whole number, unique within the group, giving the order.
    Oversized rows are left out; ``oversized`` has them. Groups are packed in
    parallel, and so are the blocks of one group.
    """

    @F.pandas_udf("run_out double, breaks long")
    def fold(sizes: pd.Series, run: pd.Series) -> pd.DataFrame:
        packed = [_next_fit(s, r, cap) for s, r in zip(sizes, run)]
        return pd.DataFrame(
            {"run_out": [run for _, run in packed], "breaks": [p[-1] for p, _ in packed]}
        )

    @F.pandas_udf("array<long>")
    def label(sizes: pd.Series, run: pd.Series) -> pd.Series:
        return pd.Series([_next_fit(s, r, cap)[0] for s, r in zip(sizes, run)])

    shared_dir(df.sparkSession)
    keys = [*group, "_block"]
    # At most block_rows rows meet in one array, since seq is unique.
    blocks = stage(
        df.filter(_size(size) <= cap)
        .withColumn("_block", block_of(seq, block_rows))
        .groupBy(*keys)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        F.col(seq).alias("_seq"),
                        _size(size).alias("_size"),
                        F.struct(*df.columns).alias("_row"),
                    )
                )
            ).alias("_rows")
        ),
        "blocks",
    )
    sizes = blocks.select(*keys, F.col("_rows._size").alias("_sizes"))

    def folded(table: DataFrame) -> DataFrame:
        return table.withColumn("_fold", fold("_sizes", "run_in")).select(
            *keys, "run_in", "_fold.run_out", "_fold.breaks"
        )

    in_order = Window.partitionBy(*group).orderBy("_block")
    state = folded(_entered(sizes, group, cap)).checkpoint()
    while True:
        due = state.withColumn("due", F.lag("run_out", 1, 0.0).over(in_order))
        moved = due.filter(F.col("due") != F.col("run_in")).select(
            *keys, F.col("due").alias("run_in")
        )
        if moved.isEmpty():
            break
        again = folded(
            sizes.alias("s")
            .join(moved.alias("m"), same_keys("s", "m", keys))
            .select("s.*", "m.run_in")
        )
        kept = due.filter(F.col("due") == F.col("run_in")).drop("due")
        state = kept.unionByName(again).checkpoint()

    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = state.select(
        *keys, "run_in", F.coalesce(F.sum("breaks").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        blocks.alias("b")
        .join(starts.alias("s"), same_keys("b", "s", keys))
        .select("b._rows", "s._before", label("b._rows._size", "s.run_in").alias("_labels"))
        .select("_before", F.explode(F.arrays_zip("_rows", "_labels")).alias("_item"))
        .select(
            "_item._rows._row.*",
            (F.col("_before") + F.col("_item._labels") + 1).cast("int").alias("batch_id"),
        )
    )
