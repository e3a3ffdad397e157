"""Shards by jump consistent hashing, with gapless positions inside each shard.

The shard of a row depends on its key and the number of shards alone, without a
ring table; with one more shard a row stays or moves to the new one. Keys are
hashed first, so text keys and composite keys work alike; null is a key too.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import staged

# Fixed: the multiplier of the published jump hash.
_STEP = np.uint64(2862933555777941757)
_LOCAL = (1 << 33) - 1  # low bits of monotonically_increasing_id


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; all keys jump together until each has landed."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        moved = state[open_] * _STEP + np.uint64(1)
        state[open_] = moved
        room = (at[open_] + 1) * (float(1 << 31) / ((moved >> np.uint64(33)).astype(float) + 1))
        further = room < shards
        open_ = open_[further]
        at[open_] = room[further].astype(np.int64)
    return at


def with_shard(df: DataFrame, key: Sequence[str], shards: int, column: str = "shard") -> DataFrame:
    """Add the shard of each row under ``shards`` shards."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return df.withColumn(column, place(F.xxhash64(*[df[k] for k in key])))


def with_slot(df: DataFrame, order: Sequence[str], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add each row's position in its shard, 0, 1, 2 ... in the order given.

    One range exchange sorts by shard and order; positions are those within the
    stored partitions, shifted by the counts of the partitions before. Rows equal
    in all of ``order`` get neighbouring positions in either order. No shard is
    ever in one task, and equal orders (all null, say) only cost an uneven sort.
    """
    by = [F.col(shard), *[F.col(c).asc_nulls_last() for c in order]]
    placed = staged(
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id()),
        "shards",
    )
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND(_LOCAL)
    runs = placed.groupBy(F.col(shard).alias("_shard"), part.alias("_part")).agg(
        F.min(local).alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "_shard", "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
    )
    # At most one row for each stored partition and shard it touches, whatever the rows.
    found = placed.join(F.broadcast(starts), (F.col(shard) == F.col("_shard")) & (part == F.col("_part")))
    return found.select(*df.columns, (F.col("_start") + local).cast("long").alias(slot))


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    ``size`` is the UTF-8 length plus 1, ``text_crc32`` the checksum, null text
    counting as empty; ``grown_shard`` is the shard when one more is appended.
    Null ids share one shard, repeated rows get a slot each, an empty table gives
    no rows, and further columns of ``docs`` are left out.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = with_shard(rows, ["doc_id"], shards)
    rows = with_shard(rows, ["doc_id"], shards + 1, "grown_shard")
    rows = with_slot(rows, ["doc_id", "text_crc32", "size"])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key: Sequence[str]) -> None:
    """Write whole rows to one folder a shard, sorted by key inside each file.

    The range exchange splits a shard over as many files as its size needs.
    """
    placed = with_shard(docs, key, shards)
    by = [F.col("shard"), *[F.col(c) for c in key]]
    placed.repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy("shard").parquet(path)
