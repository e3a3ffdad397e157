"""The download index: nested JSON listing the files of each dataset."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.operators.skew import join_small, stage
from pharmavane.schemas import INDEX_ENTRY_SCHEMA, INDEX_SCHEMA
from pharmavane.sources.reports import Cursor, TooLong, array_entries, members, streams

_PATH = ("results", "drug", "event")  # where an index lists its files
_ROWS_PER_BATCH = 2000
_SCANNED = pa.schema([("source_file", pa.string()), ("seq", pa.int64()), ("entry_json", pa.string()), ("error", pa.string())])


def _listed(cursor: Cursor, level: int = 0) -> Iterator[tuple[int | None, str]]:
    """The entries of ``partitions`` with their positions, and ``total_records`` without one."""
    for name in members(cursor):
        first = cursor.peek()
        if level < len(_PATH):
            if name == _PATH[level] and first == b"{":
                yield from _listed(cursor, level + 1)
            else:
                cursor.skip()
        elif name == "partitions" and first == b"[":
            cursor.take(b"[")
            for seq, entry in enumerate(array_entries(cursor)):
                if isinstance(entry, TooLong):
                    raise entry
                yield seq, entry
        elif name == "total_records" and first not in (b'"', b"{", b"["):
            yield None, str(json.loads(cursor.scalar()) or "")
        else:
            cursor.skip()


def _scan_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for files in batches:
        for path, content in zip(files.column(0), files.column(1)):
            path = path.as_py()
            try:
                for stream in streams(content.as_buffer().to_pybytes()):
                    cursor = Cursor(stream)
                    for seq, text in _listed(cursor):
                        yield path, seq, text, None
                    if cursor.peek():
                        raise ValueError("text after the end")
            except Exception as fault:
                yield path, None, None, f"{type(fault).__name__}: {fault}"


def _scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _scan_rows(batches)
    while batch := list(islice(rows, _ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), _SCANNED.types)], schema=_SCANNED)


def read_index_files(spark: SparkSession, path: str) -> DataFrame:
    """The files that a landed index lists, as ``index_files`` gives them.

    An index is scanned entry by entry like a report file, so no row and no task holds its
    array parsed; entries come as rows with their position. Raises ``ValueError`` if the index
    is broken, empty, or has no ``results``.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    scanned = stage(files.mapInArrow(_scan_batches, "source_file string, seq long, entry_json string, error string"), "index")
    fault = scanned.filter("error IS NOT NULL").first()
    if fault:
        raise ValueError(f"index {fault.source_file} cannot be read: {fault.error}")
    if scanned.isEmpty():
        raise ValueError("index is empty or has no 'results'")
    total = scanned.filter("seq IS NULL").groupBy("source_file").agg(F.max(F.col("entry_json").try_cast("long")).alias("total_records"))
    entries = scanned.filter("seq IS NOT NULL").withColumn("entry", F.from_json("entry_json", INDEX_ENTRY_SCHEMA))
    return join_small(entries, total, "source_file", "left").select("total_records", "seq", "entry.*")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """An index with all its entries in one row, for a small one."""
    return spark.read.schema(INDEX_SCHEMA).json(path, multiLine=True)


def parse_index(df: DataFrame, text: str = "index_json") -> DataFrame:
    """Add ``results`` parsed from an index text."""
    parsed = F.from_json(text, INDEX_SCHEMA)
    return df.withColumn("results", parsed["results"])


def check_index(index: DataFrame) -> DataFrame:
    """Raise ``ValueError`` if the index is empty or has no ``results``."""
    if "results" not in index.columns:
        raise ValueError("index has no 'results'")
    if index.filter(F.col("results").isNotNull()).isEmpty():
        raise ValueError("index is empty or has no 'results'")
    return index


def index_files(index: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per listed file: ``seq``, ``display_name``, ``file``, ``size_mb``.

    ``keep`` carries columns of the index row along, such as a dataset name;
    ``seq`` is the position within one index document.
    """
    event = F.col("results.drug.event")
    return index.select(
        *keep,
        event["total_records"].alias("total_records"),
        F.posexplode(event["partitions"]).alias("seq", "entry"),
    ).select(*keep, "total_records", F.col("seq").cast("long").alias("seq"), "entry.*")
