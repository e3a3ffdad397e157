"""Running positions and totals without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def block_of(seq: str, block_rows: int) -> Column:
    return F.floor(F.col(seq) / F.lit(block_rows)).cast("long")


def with_ordinal(
    df: DataFrame,
    group: list[str],
    seq: str = "seq",
    name: str = "ordinal",
    where: Column | None = None,
    total: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """1-based position of each row within its group, by ``seq``.

    ``seq`` is a whole number, unique within the group. Rows are numbered
    within blocks of at most ``block_rows`` positions and shifted by the count
    of the blocks before, so no task sorts more than a block; only the block
    counts of a group meet in one task.

    With ``where``, only rows that satisfy it are numbered and kept; ``total``
    names a column for the size of the whole group, other rows included.
    """
    counted = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    # A struct key is never null and pairs null groups with each other.
    blocks = df.withColumn("_block", block_of(seq, block_rows)).withColumn(
        "_key", F.struct(*group, "_block")
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.withColumn("_counted", counted)
        .groupBy("_key", *group, "_block")
        .agg(F.count_if("_counted").alias("_rows"), F.count("*").alias("_all"))
        .select(
            "_key",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_all").over(whole).alias("_size"),
        )
    )
    within = Window.partitionBy("_key").orderBy(seq)
    numbered = blocks.filter(counted).withColumn("_at", F.row_number().over(within))
    out = numbered.join(offsets, "_key").withColumn(name, F.col("_at") + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_size"))
    return out.drop("_key", "_block", "_at", "_before", "_size")
