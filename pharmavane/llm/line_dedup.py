"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches of ascending id. The hashes of all lines seen so far lie
in runs sorted by hash, no hash in two of them. A batch is reduced to one row for
each hash, merge-anti-joined with the runs, and the hashes that remain become a run
of their own; as soon as ``fanout`` runs of a level exist, they are merged into one
of the next level, so there are never more than ``fanout`` times the logarithm of
the number of batches. The first document with a line keeps it; later ones lose it.

DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.llm.common import SPACES, carried, lower_ascii, narrow, restored, staged

LAST = (1 << 63) - 1  # stands for a null id, so that it comes after all others
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z lower-cased."""
    return lower_ascii(F.trim(line, F.lit(SPACES)))


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``rank, body, at, h1, h2`` of every line whose key is long enough.

    ``rank`` orders documents, ``body`` tells apart rows of one id, ``at`` is the
    line's position; the two hashes have independent seeds, 128 bits in all.
    """
    rank = F.coalesce("doc_id", F.lit(LAST)).alias("rank")
    lines = docs.select(rank, F.xxhash64("text").alias("body"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keys = lines.select("rank", "body", "at", line_key(F.col("line")).alias("key"))
    keys = keys.filter(F.length("key") >= min_chars)
    return keys.select("rank", "body", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class SortedRuns:
    """Runs of ``h1, h2``, by level."""

    def __init__(self, fanout: int):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def add(self, hashes: DataFrame) -> None:
        """Write a run; merge full levels upwards."""
        level = 0
        run = staged(hashes.sortWithinPartitions(*HASH), "run-0")
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            level += 1
            placed = merged.repartition(*HASH).sortWithinPartitions(*HASH)
            run = staged(placed, f"run-{level}")

    def all(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, runs) if runs else None


def dropped_lines(lines: DataFrame, bounds: list[int], fanout: int) -> DataFrame | None:
    """``rank, body, at`` of the lines that an earlier document holds too.

    ``bounds`` are the last ranks of all batches but the final one. Within a batch
    the smallest rank owns a hash no run holds; a hash in a run is owned before.
    Lines are joined only with hashes that drop any of them; the join is left to
    the planner, which splits a line that a third of all documents share.
    """
    runs, dropped = SortedRuns(fanout), []
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("rank") > low)
        if high is not None:
            batch = batch.filter(F.col("rank") <= high)
        held = batch.groupBy(*HASH).agg(F.min("rank").alias("owner"), F.max("rank").alias("last"))
        seen = runs.all()
        if seen is None:
            held = held.withColumn("old", F.lit(False))
        else:
            held = held.join(seen.withColumn("old", F.lit(True)), HASH, "left")
        held = staged(held.withColumn("old", F.coalesce("old", F.lit(False))), "batch")
        if high is not None:
            runs.add(held.filter(~F.col("old")).select(*HASH))
        worth = held.filter(F.col("old") | (F.col("last") > F.col("owner"))).select(*HASH, "owner", "old")
        lost = batch.join(worth, HASH).filter(F.col("old") | (F.col("rank") > F.col("owner")))
        dropped.append(lost.select("rank", "body", "at"))
    return reduce(DataFrame.unionByName, dropped)


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """The ids that cut the table into about equal batches, by quantiles of all ids."""
    cuts = [k / batches for k in range(1, batches)]
    if not cuts:
        return []
    found = docs.agg(F.percentile_approx("doc_id", cuts, 1000).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def _without_lines(texts: DataFrame, min_chars: int, batches: int, fanout: int) -> DataFrame:
    """``texts`` with shortened ``text``, and ``n_lines, n_dropped``."""
    bare = texts.select("doc_id", "text")
    lines = staged(keyed_lines(bare, min_chars), "lines")
    lost = dropped_lines(lines, batch_bounds(bare, batches), fanout)
    # Positions of one document row at most; equal rows give each position twice.
    lost = lost.groupBy("rank", "body").agg(F.collect_set("at").alias("gone"))
    rows = texts.withColumns({"rank": F.coalesce("doc_id", F.lit(LAST)), "body": F.xxhash64("text")})
    rows = rows.join(lost, ["rank", "body"], "left")
    # Runs of kept lines lie between neighbouring dropped positions.
    rows = rows.select(*texts.columns, F.split("text", "\n").alias("_lines"), F.sort_array("gone").alias("_gone"))
    gone, count = F.col("_gone"), F.size("_lines")
    gaps = F.transform(
        F.arrays_zip(
            F.concat(F.array(F.lit(-1)), gone).alias("after"), F.concat(gone, F.array(count)).alias("upto")
        ),
        lambda gap: F.slice("_lines", gap["after"] + 2, gap["upto"] - gap["after"] - 1),
    )
    kept = F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return rows.select(
        *[c for c in texts.columns if c != "text"], kept.alias("text"), count.cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: texts without lines of earlier documents.

    Lines are cut at \\n; a null or empty text is one empty line. Keys shorter than
    ``min_chars`` code points never drop. All lines of the first document with a key
    stay, its repeats too. Null ids come after all others and count as one document;
    so do rows that repeat an id. Other columns are left out; an empty table gives no
    rows. The number of batches changes the work, never the rows.
    """
    return _without_lines(narrow(docs, id_col, text_col), min_chars, batches, fanout)


def shorten(
    docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2,
    id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars",
) -> DataFrame:
    """All rows and columns of ``docs``, texts without the lines that drop.

    ``length_col``, if there, is counted anew; null text becomes empty.
    """
    rows = _without_lines(carried(docs, id_col, text_col), min_chars, batches, fanout)
    return restored(rows, docs.columns, id_col, text_col, {length_col: F.length("text").cast("long")})
