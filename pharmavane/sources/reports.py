"""Scans of landed report files: zipped, gzipped or plain JSON.

A file is one JSON object with a top-level ``results`` array, so it cannot be
split; parallelism is the number of files. Inside a task the text is read
piecewise and sent on report by report in one pass, so a task holds the compressed
file and one report, never a whole decompressed file, however broken it is.

Where a report ends is told by the marks of a piece alone: quotes, brackets and
commas, found for all its bytes at once. No report is parsed in Python, but those of files
of a few KB, where that costs less; whether one is valid JSON is for the reader of its text.
"""

from __future__ import annotations

import codecs
import gzip
import io
import json
import re
import zipfile
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pharmavane.operators.extract import report_key
from pharmavane.schemas import REPORT_FILE_SCHEMA

_CHUNK = 1 << 20
_ROWS_PER_BATCH = 2000
_PROBE = 1 << 19  # bytes of an unfinished value after which its start is looked at more closely
_STRUCTURE = re.compile(rb'["\[\]{}]')
_IN_STRING = re.compile(rb'[^"\\]*')
_STRING = re.compile(rb'"(?:[^"\\]|\\.)*"', re.DOTALL)
_SCALAR = re.compile(rb"[^\s,\]}]+")
_BLANK = b" \t\r\n"
_SPACE = re.compile(rb"[ \t\r\n]*")
_HEAD = re.compile(r'[ \t\r\n]*\{[ \t\r\n]*"results"[ \t\r\n]*:[ \t\r\n]*\[[ \t\r\n]*')
_NEXT = re.compile(r"[ \t\r\n]*([,\]])[ \t\r\n]*")
_TAIL = re.compile(r"\}[ \t\r\n]*")
_UNFINISHED = 10  # characters of a literal or escape that may be cut by the end of a piece
MAX_REPORT = 1 << 26  # bytes of one report; a longer one is a fault, not its file
LONG_REPORT = "long report"  # how the error of such a report begins
_SHORT = 1 << 13  # bytes of a file up to which parsing it costs less than the marks of a piece

SCANNED = "source_file string, pos long, report_json string, error string"
_SCANNED = pa.schema([("source_file", pa.string()), ("pos", pa.int64()), ("report_json", pa.string()), ("error", pa.string())])

_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_STEP = np.zeros(256, np.int8)  # what a mark does to the depth
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARK = _STEP != 0
_MARK[_COMMA] = True


class TooLong(ValueError):
    """A value that a task would not hold."""


def streams(content: bytes) -> Iterator[io.BufferedIOBase]:
    """The JSON texts of a file: every member of a zip, in order."""
    if content[:2] == b"PK":
        archive = zipfile.ZipFile(io.BytesIO(content))
        members = [m for m in archive.infolist() if not m.is_dir()]
        if not members:
            raise ValueError("no member in the archive")
        for member in members:
            yield archive.open(member)
    elif content[:2] == b"\x1f\x8b":
        yield gzip.open(io.BytesIO(content))
    else:
        yield io.BytesIO(content)


class Cursor:
    """A place in a text that is read piecewise; what lies behind it is let go."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.check = stream, codecs.getincrementaldecoder("utf-8")().decode
        self.text, self.at, self.ended = b"", 0, False

    def more(self) -> bool:
        """Read a piece; pieces grow with what is held, so that little is read twice."""
        if self.ended:
            return False
        self.text, self.at = self.text[self.at:], 0
        piece = self.stream.read(max(_CHUNK, len(self.text)))
        self.ended = not piece
        self.check(piece, self.ended)
        self.text += piece
        return True

    def peek(self) -> bytes:
        """The next character that is no white space; nothing at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at:self.at + 1]
            if not self.more():
                return b""

    def take(self, wanted: bytes) -> bytes:
        found = self.peek()
        if not found or found not in wanted:
            raise ValueError(f"{found.decode(errors='replace') or 'the end'} in place of one of {wanted.decode()}")
        self.at += 1
        return found

    def name(self) -> str:
        """The next value, which is a string."""
        if self.peek() != b'"':
            self.take(b'"')
        while not (found := _STRING.match(self.text, self.at)):
            if len(self.text) - self.at > MAX_REPORT or not self.more():
                raise ValueError("a name without end")
        self.at = found.end()
        return json.loads(found[0])

    def scalar(self) -> str:
        """The text of the next value, which is no string, array or object."""
        self.peek()
        while True:
            found = _SCALAR.match(self.text, self.at)
            if found and found.end() < len(self.text) or not self.more():
                break
        if not found:
            raise ValueError("no value")
        self.at = found.end()
        return found[0].decode()

    def _skip_string(self) -> None:
        self.at += 1
        while True:
            self.at = _IN_STRING.match(self.text, self.at).end()
            if self.at + 1 < len(self.text) or self.text[self.at:self.at + 1] == b'"':
                closed = self.text[self.at] == _QUOTE
                self.at += 1 if closed else 2
                if closed:
                    return
            elif not self.more():
                raise ValueError("a string without end")

    def skip(self) -> None:
        """Pass over the next value, holding none of it."""
        first, depth = self.peek(), 0
        if not first or first not in b'"[{':
            while True:
                found = _SCALAR.match(self.text, self.at)
                self.at = found.end() if found else self.at
                if self.at < len(self.text) or not self.more():
                    return
        while True:
            found = _STRUCTURE.search(self.text, self.at)
            if not found:
                self.at = len(self.text)
                if not self.more():
                    raise ValueError("the end inside a value")
                continue
            self.at = found.start()
            if found[0] == b'"':
                self._skip_string()
            else:
                self.at += 1
                depth += 1 if found[0] in b"[{" else -1
            if not depth:
                return


def within_strings(data: np.ndarray) -> np.ndarray:
    """1 for bytes inside of a string, its first quote included, 0 outside; the text starts outside."""
    quote = data == _QUOTE
    back = data == _BACKSLASH
    if back.any():  # a quote after an odd number of backslashes is a character of its string
        at = np.flatnonzero(quote)
        at = at[at > 0]
        at = at[back[at - 1]]
        other = np.flatnonzero(~back)
        before = np.searchsorted(other, at) - 1  # the last character before the backslashes
        run = at - 1 - np.where(before >= 0, other[before], -1)
        quote[at[run % 2 == 1]] = False
    return np.cumsum(quote, dtype=np.uint8) & 1  # the parity of quotes outlives the overflow


def marks(text: bytes, inside: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of the brackets and commas outside of strings, what each does to the depth, and the depth after it.

    The text starts at depth 0, and outside of a string unless ``inside`` is 1; the last value
    returned says the same of its end.
    """
    data = np.frombuffer(text, np.uint8)
    within = within_strings(data) ^ np.uint8(inside)
    places = np.flatnonzero(_MARK[data] & (within == 0))
    step = _STEP[data[places]]
    return places, step, np.cumsum(step, dtype=np.int64), int(within[-1]) if len(within) else inside


class Layout:
    """The whole entries of an array in a text that starts inside it, at the start of an entry."""

    def __init__(self, text: bytes):
        places, step, depth, _ = marks(text)
        ends = np.flatnonzero(depth < 0)
        self.closed = int(places[ends[0]]) if len(ends) else None
        if len(ends):
            places, step, depth = (x[: ends[0]] for x in (places, step, depth))
        level = depth == 0
        self.stops = places[level & (step == 0)].tolist()
        if self.closed is not None:
            self.stops.append(self.closed)
        self.returns = places[level & (step < 0)]
        self.text = text

    def entries(self) -> Iterator[str]:
        counts = np.searchsorted(self.returns, self.stops).tolist()
        start = met = 0
        for stop, count in zip(self.stops, counts):
            entry = self.text[start:stop].strip(_BLANK)
            one = count - met == 1 and entry[:1] in (b"{", b"[") and entry[-1:] in (b"}", b"]")
            one = one and self.text[self.returns[met] + 1:stop].strip(_BLANK) == b""
            if not one:
                if count > met or not entry:
                    raise ValueError(f"no value, or more than one, in place of an entry: {entry[:40].decode(errors='replace')}")
                json.loads(entry)  # a string, number or literal
            yield entry.decode()
            start, met = stop + 1, count


_PARSE = json.JSONDecoder().raw_decode


def _look_closer(text: bytes) -> None:
    """Raise if the start of an unfinished value cannot be JSON, so that no more of it is held."""
    start = codecs.getincrementaldecoder("utf-8")().decode(text)
    try:
        _PARSE(start)
    except json.JSONDecodeError as fault:
        if not fault.msg.startswith("Unterminated string") and fault.pos < len(start) - _UNFINISHED:
            raise


def array_entries(cursor: Cursor) -> Iterator[str | TooLong]:
    """The entries of the array that the cursor is in, up to behind its end.

    One of more than ``MAX_REPORT`` bytes is passed over and comes as ``TooLong``.
    """
    if cursor.peek() == b"]":
        cursor.at += 1
        return
    looked = False
    while True:
        layout = Layout(cursor.text[cursor.at:])
        yield from layout.entries()
        if layout.closed is not None:
            cursor.at += layout.closed + 1
            return
        if layout.stops:
            cursor.at += layout.stops[-1] + 1
            looked = False
        held = len(cursor.text) - cursor.at
        if held > MAX_REPORT:
            cursor.skip()
            yield TooLong(f"a value of more than {MAX_REPORT} bytes")
            if cursor.take(b",]") == b"]":
                return
            looked = False
            continue
        if held > _PROBE and not looked:
            cursor.peek()
            _look_closer(cursor.text[cursor.at:])
            looked = True
        if not cursor.more():
            cursor.peek()
            if cursor.at < len(cursor.text):
                cursor.skip()
            cursor.take(b",]")


def members(cursor: Cursor) -> Iterator[str]:
    """The names of an object's members; the cursor is at the value of each, which must be passed."""
    cursor.take(b"{")
    mark = b"," if cursor.peek() != b"}" else cursor.take(b"}")
    while mark == b",":
        name = cursor.name()
        cursor.take(b":")
        yield name
        mark = cursor.take(b",}")


def _results(cursor: Cursor) -> Iterator[str | TooLong]:
    """The entries of the top-level ``results`` array; the text is read to its end."""
    seen = False
    for name in members(cursor):
        if name != "results":
            cursor.skip()
        else:
            seen = True
            cursor.take(b"[")
            yield from array_entries(cursor)
    if cursor.peek():
        raise ValueError("text after the end")
    if not seen:
        raise ValueError("no results array")


def _entries(content: bytes) -> Iterator[str | TooLong]:
    for stream in streams(content):
        yield from _results(Cursor(stream))


def iter_reports(content: bytes) -> Iterator[str]:
    """The texts of the entries of all ``results`` arrays of a file, in order.

    Raises where the file turns out to be broken, after the reports before that, and
    at a report that is too long. A text that brackets and strings mark off is given
    as it is, valid JSON or not.
    """
    for entry in _entries(content):
        if isinstance(entry, TooLong):
            raise entry
        yield entry


def _short_entries(content: bytes) -> list[str] | None:
    """The entries of a short plain file of valid JSON that holds ``results`` alone; None for any other.

    Gives what ``_entries`` gives, without the fixed cost of its arrays.
    """
    if len(content) > min(_SHORT, MAX_REPORT):
        return None
    try:
        text = content.decode()
        head, found = _HEAD.match(text), []
        at = head.end() if head else len(text)
        while at < len(text):
            _, end = _PARSE(text, at)
            found.append(text[at:end])
            mark = _NEXT.match(text, end)
            if not mark:
                break
            at = mark.end()
            if mark[1] == "]":
                return found if _TAIL.fullmatch(text, at) else None
    except (ValueError, RecursionError):
        pass  # for the cursor to tell
    return None


def _scan_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for files in batches:
        for path, content in zip(files.column(0), files.column(1)):
            path = path.as_py()
            try:
                content = content.as_buffer().to_pybytes()
                short = _short_entries(content)
                for pos, report in enumerate(_entries(content) if short is None else short):
                    if isinstance(report, TooLong):
                        yield path, pos, None, f"{LONG_REPORT} at position {pos}: {report}"
                    else:
                        yield path, pos, report, None
            except Exception as fault:
                yield path, 0, None, f"{type(fault).__name__}: {fault}"


def _scan_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _scan_rows(batches)
    while batch := list(islice(rows, _ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), _SCANNED.types)], schema=_SCANNED)


def scan_report_files(files: DataFrame) -> DataFrame:
    """Rows ``(source_file, pos, report_json, error)`` from ``(path, content)`` rows.

    A file that cannot be read to its end gives a row with ``error`` set; the run
    goes on. ``split_scanned`` leaves out the reports before the fault. A report of
    more than ``MAX_REPORT`` bytes gives such a row by itself.
    """
    return files.select("path", "content").mapInArrow(_scan_batches, SCANNED)


def read_report_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return scan_report_files(files)


def split_scanned(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reports of whole files, and one row per unreadable file or too long report.

    Unreadable files are one row each, so the anti-join is small beside the reports;
    store ``scanned`` first where files are large.
    """
    faults = scanned.filter(F.col("error").isNotNull()).select("source_file", "error")
    good = scanned.filter(F.col("error").isNull()).drop("error")
    broken = faults.filter(~F.col("error").startswith(LONG_REPORT)).select("source_file")
    return good.join(broken, "source_file", "left_anti").select(*good.columns), faults


def read_report_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parsed reports from plain or gzipped JSON files with Spark's own reader.

    Gives ``(source_file, pos, report, patientid)`` like ``parse_reports``.
    The reader holds one file's array at a time; ``read_report_files`` is the
    one for large files.
    """
    files = spark.read.schema(REPORT_FILE_SCHEMA).json(path, multiLine=True)
    named = files.select(F.col("_metadata.file_path").alias("source_file"), "results")
    reports = named.select("source_file", F.posexplode("results").alias("pos", "report"))
    return reports.withColumn("patientid", report_key(F.col("source_file"), F.col("pos")))
