"""Keeping hot keys out of single tasks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.session import scratch_path

# A table is sent to every executor only if it was counted to be within both.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table used several times to the shared folder and read it back."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heavy_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows. Counts combine before the shuffle."""
    return df.groupBy(key).count().filter(F.col("count") > limit).select(key)


def small_size(df: DataFrame) -> int | None:
    """The number of rows of a table that is small enough to broadcast, else None.

    Counts and measures at most one row more than the limit.
    """
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum(width)).first()
    return seen[0] if seen[0] <= BROADCAST_ROWS and (seen[1] or 0) <= BROADCAST_BYTES else None


def split_heavy(df: DataFrame, key: str, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of heavy keys (None if there are none).

    The heavy keys are broadcast only after counting that they are few; a long
    list is joined by shuffle, where adaptive execution splits skewed keys.
    """
    keys = heavy_keys(df, key, limit)
    found = small_size(keys)
    if found == 0:
        return df, None
    if found is not None:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def join_small(df: DataFrame, small: DataFrame, key: str, how: str) -> DataFrame:
    """Join with a table that is broadcast only if counting shows it to be small.

    A larger one is left to the planner, which has the sizes at run time.
    """
    if small_size(small) is not None:
        small = F.broadcast(small)
    return df.join(small, key, how)


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Equality of two aliased tables on all keys, matching null to null."""
    return reduce(
        and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )
