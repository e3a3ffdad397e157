"""Report files of any size: plain JSON in splits, gzipped JSON as a stream.

Spark's text reader cuts a file at its commas, so a plain file has as many tasks as splits
and no task holds more than a stretch of it. Where a split stands is found in two short
scans of all splits. The first gives the parity of a split's quotes, and what it does to the
depth if it starts outside of a string and if inside; running sums over the splits of a
file, one row each, tell the start of every split. From there the second counts what starts
in it. The last scan then cuts the reports with their positions in the file; one that lies
across splits is put together from its pieces. A gzipped file is one split: it is streamed
once, from a start that is known.

Rows are those of ``reports.scan_report_files``.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import islice
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pharmavane.operators.skew import stage
from pharmavane.sources.reports import _STEP, LONG_REPORT, MAX_REPORT, SCANNED, Layout, marks, within_strings

_BLANK = b" \t\r\n"
_OPEN, _COMMA, _CLOSE = 1, 0, -1
_BATCH_ROWS = 2000
_AUTHORITY = re.compile("^([A-Za-z0-9+.-]+):///")
_START = {"inside": "int", "depth": "long", "listed": "boolean", "entries": "long", "seen": "boolean", "last": "boolean", "missing": "long"}
_MEASURED = "source_file string, start long, quotes int, outside long, within long, bytes long, size long"
_COUNTED = "source_file string, start long, entered long, opened long, listed boolean, found boolean"
_CUT = "source_file string, start long, pos long, report_json string, bytes long, whole boolean, error string"


def _pieces(spark: SparkSession, paths: list[str], longest: int | None) -> DataFrame:
    """``source_file, start, size, piece``: the text between commas, in order within a split.

    The file is named by its address, special characters written as %XX.
    """
    reader = spark.read.option("lineSep", ",")
    if longest:
        reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", str(longest))
    meta = F.col("_metadata")
    return reader.text(paths).select(
        meta["file_path"].alias("source_file"),
        meta["file_block_start"].alias("start"), meta["file_size"].alias("size"), F.col("value").cast("binary").alias("piece"),
    )


def _plain_path(address: str) -> str:
    """The path as the reader of whole files names it; once for a split, since a piece is a few bytes."""
    return _AUTHORITY.sub(r"\1:/", unquote(address))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, bytes]]:
    """``source_file, start, row, text`` of the stretches of a batch that belong to one split."""
    paths, starts = batch.column("source_file").dictionary_encode(), batch.column("start").to_numpy()
    codes = paths.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    pieces, bounds = batch.column("piece"), [0, *cuts.tolist(), batch.num_rows]
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces), pa.scalar(b",", pieces.type))
    for low, text in zip(bounds, texts):
        yield paths.dictionary[int(codes[low])].as_py(), int(starts[low]), low, text.as_py()


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, dict, Iterator[bytes]]]:
    """The splits of a partition: file, start, further columns of the first row, and the text in stretches.

    A split but the first of a file starts with the comma that ends the one before, so the
    texts of all splits are the file's. Rows of a split follow each other.
    """
    stretches = (
        (path, start, text, {c: batch.column(c)[row].as_py() for c in batch.schema.names if c != "piece"})
        for batch in batches if batch.num_rows for path, start, row, text in _runs(batch)
    )
    held = next(stretches, None)

    def one(path: str, start: int) -> Iterator[bytes]:
        nonlocal held
        first = start == 0
        while held and held[:2] == (path, start):
            yield held[2] if first else b"," + held[2]
            first, held = False, next(stretches, None)

    while held:
        path, start, _, row = held
        texts = one(path, start)
        yield path, start, row, texts
        for _ in texts:  # what a fault left unread
            pass


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while batch := list(islice(rows, _BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), schema.types)], schema=schema)


def _mapped(df: DataFrame, rows: Callable[[Iterable[pa.RecordBatch]], Iterator[tuple]], columns: str) -> DataFrame:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(rows(batches), schema)

    return df.mapInArrow(run, columns)


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """What a split does to the state: parity of quotes, depth from outside and from within a string."""
    for path, start, row, texts in _splits(batches):
        parity, change, length = 0, [0, 0], 0
        for text in texts:
            data = np.frombuffer(text, np.uint8)
            within, step = within_strings(data), _STEP[data]
            out = int(step[within == 0].sum(dtype=np.int64))
            change[parity] += out
            change[parity ^ 1] += int(step.sum(dtype=np.int64)) - out
            parity, length = parity ^ int(within[-1]) if len(within) else parity, length + len(text)
        yield path, start, parity, change[0], change[1], length, row["size"]


class _Walk:
    """A way through a split: the borders of what lies in the values of the file's object."""

    def __init__(self, inside: int, depth: int, start: int):
        self.inside, self.depth, self.at_start, self.ended = inside, depth, start == 0, False
        if depth <= 0 < start:
            raise ValueError("text after the end")

    def borders(self, text: bytes) -> Iterator[tuple[int, int, bool]]:
        """Place, kind, and for an opening whether it is that of the ``results`` array."""
        if self.ended and text.strip(_BLANK):
            raise ValueError("text after the end")
        if self.at_start and text.strip(_BLANK):
            if text.lstrip(_BLANK)[:1] != b"{":
                raise ValueError("no object")
            self.at_start = False
        inside, before = self.inside, self.depth
        places, step, depth, self.inside = marks(text, inside)
        depth = depth + before
        low = np.flatnonzero(depth <= 0)
        if len(low):
            self.ended = True
            if depth[low[0]] < 0 or text[int(places[low[0]]) + 1:].strip(_BLANK):
                raise ValueError("text after the end")
        self.depth = int(depth[-1]) if len(depth) else before
        chosen = np.flatnonzero(((depth == 2) & (step >= 0)) | ((depth == 1) & (step < 0)))
        for k in chosen.tolist():
            place, kind = int(places[k]), int(step[k])
            yield place, kind, kind == _OPEN and self._is_results(text, int(places[k - 1]) + 1 if k else 0, place, inside)

    @staticmethod
    def _is_results(text: bytes, start: int, place: int, inside: int) -> bool:
        name = text[start:place].strip(_BLANK)
        if start == 0 and inside:  # the end of a name with a comma
            return False
        if name[-1:] != b":":
            raise ValueError("a value without a name")
        if json.loads(name[:-1]) != "results":
            return False
        if text[place:place + 1] != b"[":
            raise ValueError("results is no array")
        return True


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Entries that start in the array a split is in at its start, and in ``results`` arrays it opens."""
    for path, start, row, texts in _splits(batches):
        entered = opened = 0
        listed, now, fresh, found = None, None, -1, False
        try:
            walk = _Walk(row["inside"], row["depth"], start)
            for text in texts:
                for place, kind, results in walk.borders(text):
                    if kind == _OPEN:
                        listed, now, found = results, results, found or results
                        opened, fresh = opened + results, place + 1
                    elif kind == _COMMA:
                        entered, opened, fresh = entered + (now is None), opened + bool(now), -1
                    else:
                        empty = fresh >= 0 and not text[fresh:place].strip(_BLANK)
                        opened, now, fresh = opened - bool(now and empty), False, -1
                fresh = -1
        except ValueError:
            pass  # the last scan meets the same and reports it
        yield path, start, entered, opened, listed, found


def _check(text: bytes) -> str:
    found = list(Layout(text + b",").entries())
    if len(found) != 1:
        raise ValueError("more than one value in place of an entry")
    return found[0]


class _Held:
    """The text of an entry that is not at its end; nothing of one that is too long."""

    def __init__(self, longest: int):
        self.parts, self.length, self.longest = [], 0, longest

    def add(self, text: bytes) -> None:
        self.length += len(text)
        if self.length > self.longest:
            self.parts = []
        else:
            self.parts.append(text)

    def text(self) -> bytes | None:
        return b"".join(self.parts) if self.length <= self.longest else None


def _cut_split(row: dict, start: int, texts: Iterator[bytes], longest: int) -> Iterator[tuple]:
    """``pos, text, bytes, whole`` of the entries in a split; parts of those that pass its ends are not whole."""
    walk = _Walk(row["inside"], row["depth"], start)
    check = codecs.getincrementaldecoder("utf-8")().decode
    listed, seen, pos = row["listed"], row["seen"], row["entries"] - 1
    held = _Held(longest) if listed else None  # of the entry that the split, or a stretch, is in
    begun = False  # whether it starts in this split

    def finish(rest: bytes) -> tuple:
        held.add(rest)
        text = held.text()
        if not begun or text is None:
            return pos, None if text is None else text.decode(), held.length, begun
        return pos, _check(text), held.length, True

    def sized(entry: str) -> tuple:
        return pos, entry if len(entry) <= longest else None, len(entry), True

    for text in texts:
        check(text)
        run = end = None  # from where to where entries lie that are whole in this stretch
        count = 0  # their number
        for place, kind, results in walk.borders(text):
            if kind == _OPEN:
                listed = listed or results
                if results:
                    seen, run, end, count = True, place + 1, place + 1, 0
                    pos += 1
                continue
            if not listed:
                continue
            if held is not None:
                yield finish(text[:place])
                held, run, count, pos = None, place + 1, 0, pos + 1
            else:
                count += 1
            end = place + 1
            if kind == _CLOSE:
                if text[place:end] != b"]":
                    raise ValueError("an array that does not end as one")
                if run < end:
                    empty = count == 1 and text[run - 1:run] == b"[" and not text[run:place].strip(_BLANK)
                    for entry in () if empty else Layout(text[run:end]).entries():
                        yield sized(entry)
                        pos += 1
                pos, listed, run = pos - 1, False, None
        if not listed:
            continue
        if held is not None:
            held.add(text)
            continue
        for entry in Layout(text[run:end]).entries():
            yield sized(entry)
            pos += 1
        held, begun = _Held(longest), True
        held.add(text[end:])
    check(b"", True)
    if held is not None:
        done = held.text()
        yield pos, None if done is None else done.decode(), held.length, False
    if row["last"]:
        if row["missing"]:
            raise ValueError(f"a comma at the end, or more than {longest} bytes without one")
        if not walk.ended or walk.inside:
            raise ValueError("the end inside a value")
        if not seen:
            raise ValueError("no results array")


def _too_long(pos: int, longest: int) -> str:
    return f"{LONG_REPORT} at position {pos}: a value of more than {longest} bytes"


def _cut(longest: int, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for address, start, row, texts in _splits(batches):
        path = _plain_path(address)
        try:
            for pos, text, length, whole in _cut_split(row, start, texts, longest):
                yield path, start, pos, text, length, whole, _too_long(pos, longest) if whole and text is None else None
        except Exception as fault:
            yield path, start, 0, None, 0, True, f"{type(fault).__name__}: {fault}"


def _rejoined(longest: int, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for path, pos, text in zip(*(batch.column(c).to_pylist() for c in ("source_file", "pos", "text"))):
            try:
                yield (path, pos, None, _too_long(pos, longest)) if text is None else (path, pos, _check(text.encode()), None)
            except Exception as fault:
                yield path, 0, None, f"{type(fault).__name__}: {fault}"


def _plain_starts(pieces: DataFrame) -> DataFrame:
    """The state at the start of each split: one row of some 60 bytes for each split."""
    before = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source_file")

    def sum_before(x: Column | str) -> Column:
        return F.coalesce(F.sum(x).over(before), F.lit(0))

    splits = stage(_mapped(pieces, _measure, _MEASURED), "splits")
    splits = splits.withColumn("inside", F.pmod(sum_before("quotes"), F.lit(2)).cast("int"))
    splits = splits.withColumn("depth", sum_before(F.when(F.col("inside") == 0, F.col("outside")).otherwise(F.col("within"))))
    splits = splits.withColumn("missing", F.col("size") - F.sum("bytes").over(whole))
    splits = splits.withColumn("last", F.col("start") == F.max("start").over(whole))
    placed = splits.select("source_file", "start", "inside", "depth", "missing", "last")
    counted = _mapped(pieces.join(F.broadcast(placed), ["source_file", "start"]), _count, _COUNTED)
    known = placed.join(stage(counted, "counted").withColumnRenamed("listed", "opens"), ["source_file", "start"])
    listed = (F.col("depth") >= 2) & F.coalesce(F.last("opens", ignorenulls=True).over(before), F.lit(False))
    seen = F.coalesce(F.max("found").over(before), F.lit(False))
    known = known.withColumn("listed", listed).withColumn("seen", seen)
    entries = sum_before(F.col("opened") + F.when(F.col("listed"), F.col("entered")).otherwise(F.lit(0)))
    return known.select("source_file", "start", *_start_columns(entries))


def _start_columns(entries: Column) -> list[Column]:
    return [(entries if name == "entries" else F.col(name)).cast(kind).alias(name) for name, kind in _START.items()]


def scan_large_files(spark: SparkSession, plain: list[str], zipped: list[str], longest: int = MAX_REPORT) -> DataFrame:
    """Rows ``(source_file, pos, report_json, error)`` of plain and of gzipped JSON files, of any size.

    The table of split starts is sent to every task: 60 bytes for each split of 128 MB, so
    48 MB for 100 TB. A plain file with more than ``longest`` bytes without a comma, or
    with a comma at its end, is a fault; in a gzipped one such a stretch must fit a task.
    Files without a byte give no row.
    """
    cut = []
    if plain:
        pieces = _pieces(spark, plain, longest)
        starts = stage(_plain_starts(pieces), "starts")
        cut.append(_mapped(pieces.join(F.broadcast(starts), ["source_file", "start"]), partial(_cut, longest), _CUT))
    if zipped:
        first = {"inside": 0, "depth": 0, "listed": False, "entries": 0, "seen": False, "last": True, "missing": 0}
        states = {name: F.lit(first[name]).cast(kind) for name, kind in _START.items()}
        cut.append(_mapped(_pieces(spark, zipped, None).withColumns(states), partial(_cut, longest), _CUT))
    if not cut:
        return spark.createDataFrame([], SCANNED)
    rows = stage(cut[0] if len(cut) == 1 else cut[0].unionByName(cut[1]), "cut")
    whole = rows.filter("whole").select("source_file", "pos", "report_json", "error")
    broken = F.col("error").isNotNull() & ~F.col("error").startswith(LONG_REPORT)
    parts = rows.filter("NOT whole")
    # A report has parts only where it passes an end of a split; those of one that fits are few.
    fits = F.sum("bytes") <= longest
    sizes = parts.groupBy("source_file", "pos").agg(fits.alias("fits"))
    parts = parts.join(sizes, ["source_file", "pos"]).withColumn("report_json", F.when(F.col("fits"), F.col("report_json")))
    text = F.sort_array(F.collect_list(F.when(F.col("fits"), F.struct("start", "report_json"))))
    joined = parts.groupBy("source_file", "pos").agg(F.first("fits").alias("fits"), text.alias("text")).select(
        "source_file", "pos", F.when(F.col("fits"), F.array_join(F.col("text.report_json"), "")).alias("text")
    )
    joined = stage(_mapped(joined, partial(_rejoined, longest), SCANNED), "joined")
    # Several splits may meet the fault of a file; it is one row.
    faults = whole.filter(broken).unionByName(joined.filter(broken)).groupBy("source_file").agg(F.min("error").alias("error"))
    faults = faults.select("source_file", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("report_json"), "error")
    sound = F.coalesce(~broken, F.lit(True))
    return whole.filter(sound).unionByName(joined.filter(sound)).unionByName(faults)
