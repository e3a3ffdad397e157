"""Operators over the list of source files.

Input rows are ``(seq, display_name, file, size_mb)``, one per file, as
``sources.index.index_files`` gives them; ``seq`` is the position in the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pharmavane.functions import names
from pharmavane.operators.ordering import with_ordinal
from pharmavane.operators.packing import oversized, pack_next_fit

LIST_ROWS = 10_000


def _exact_sum(size) -> F.Column:
    """Sum of sizes, the same in any order of addition, to two decimals."""
    return F.round(F.sum(size.cast("decimal(20,6)")), 2).cast("double")


def with_partition(files: DataFrame) -> DataFrame:
    """Add the year key, and the size as a number with -1 for a missing one."""
    return files.withColumns(
        {
            "partition_id": names.year_token(F.col("display_name")),
            "part_size_mb": names.size_or_default(F.col("size_mb")),
        }
    )


def by_year(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Files, total size and first position per year.

    A missing size does not lower the sum; ``unsized`` counts those files.
    ``keep`` carries columns that are constant over the list.
    """
    known = F.when(F.col("part_size_mb") >= 0, F.col("part_size_mb"))
    return (
        with_partition(files)
        .groupBy("partition_id")
        .agg(
            F.count("*").alias("count"),
            F.coalesce(_exact_sum(known), F.lit(0.0)).alias("size_mb"),
            F.count_if(F.col("part_size_mb") < 0).alias("unsized"),
            F.min("seq").alias("seq"),
            *[F.max(c).alias(c) for c in keep],
        )
    )


def file_lists(files: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """The files of each year in input order, as lists of at most ``list_rows``.

    A year with more files has several lists, numbered from 0, so no array
    grows with the data.
    """
    placed = with_ordinal(with_partition(files), ["partition_id"])
    return (
        placed.withColumn("list_no", F.floor((F.col("ordinal") - 1) / F.lit(list_rows)))
        .groupBy("partition_id", "list_no")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "file"))).alias("_files"))
        .select("partition_id", "list_no", F.col("_files.file").alias("files"))
    )


def total_size(files: DataFrame) -> DataFrame:
    known = names.size_or_default(F.col("size_mb"))
    return files.agg(_exact_sum(F.when(known >= 0, known)).alias("total_size_mb"))


def select_years(manifest: DataFrame, years: str | None) -> DataFrame:
    """Rows of the listed years; None or '' keeps all."""
    picked = names.year_list(years)
    return manifest.filter(F.col("partition_id").isin(picked)) if picked else manifest


def with_display_prefix(files: DataFrame, prefix: str) -> DataFrame:
    return files.filter(F.col("display_name").startswith(prefix))


def part_names(files: DataFrame, succeeded: str = "succeeded") -> DataFrame:
    """Output names of the files read with success.

    The number advances over successes only; the total counts every file of
    the year.
    """
    numbered = with_ordinal(
        with_partition(files), ["partition_id"], where=F.col(succeeded), total="_total"
    )
    name = names.part_name(F.col("ordinal"), F.col("_total"))
    return numbered.withColumn("part_name", name).drop("_total")


def run_plan(files: DataFrame, years: str | None = None, cap_mb: float = 13_000) -> DataFrame:
    """Years to read, packed into batches of at most ``cap_mb`` in input order."""
    return pack_next_fit(select_years(by_year(files), years), cap_mb)


def batch_oversized_years(files: DataFrame, cap_mb: float) -> DataFrame:
    """Files of the years that exceed the cap, packed file by file within the year.

    A file of unknown size counts as 0, so it never makes room for others.
    """
    large = oversized(by_year(files), cap_mb).select("partition_id")
    rows = with_partition(files).join(large, "partition_id", "left_semi")
    return pack_next_fit(rows, cap_mb, size="size_mb", group=["partition_id"])


def batch_summary(batches: DataFrame, size: str = "size_mb", group: list[str] = []) -> DataFrame:
    return batches.groupBy(*group, "batch_id").agg(
        F.count("*").alias("n_items"), _exact_sum(F.col(size)).alias("total_size_mb")
    )
