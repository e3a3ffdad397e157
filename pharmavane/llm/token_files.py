"""Token ids in files of bit-plane shuffled, compressed blocks.

A file holds whole documents in id order. Its ids are cut into blocks of a fixed
number; a block is transposed into byte planes (or bit planes), so that the high
bytes of all its ids lie together, and each plane is compressed with zstandard.
A chunk index of plane lengths and a table of documents make any document readable
without the rest. Spark's writer commits the files, one row of a Parquet table
each, so a lost executor leaves no half-written file behind.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import staged
from pharmavane.session import scratch_path

MAGIC = b"planes01"
HEADER = struct.Struct("<8sQIIBBQ")  # magic, ids, documents, ids a block, width, bits, table bytes
LEVEL = 3


def _planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The transposed block: plane k holds byte (or bit) k of every id."""
    width = ids.dtype.itemsize
    grid = ids.view(np.uint8).reshape(-1, width)
    if not bits:
        return [grid[:, k].tobytes() for k in range(width)]
    lanes = np.unpackbits(grid, axis=1, bitorder="little")
    return [np.packbits(lanes[:, k], bitorder="little").tobytes() for k in range(8 * width)]


def _block(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    grid = np.empty((n, width), np.uint8)
    if bits:
        lanes = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        grid[:] = np.packbits(np.stack(lanes, axis=1), axis=1, bitorder="little")
    else:
        for k, plane in enumerate(planes):
            grid[:, k] = np.frombuffer(plane, np.uint8)
    return grid.reshape(-1).view(f"<u{width}")


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block: int, bits: bool = False) -> bytes:
    """The bytes of one file."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    width = ids.dtype.itemsize
    table = np.zeros(len(doc_ids), [("id", "<i8"), ("known", "u1"), ("n", "<u8")])
    table["id"] = [0 if i is None else i for i in doc_ids]
    table["known"] = [i is not None for i in doc_ids]
    table["n"] = lengths
    chunks = [squeeze(p) for at in range(0, len(ids), block) for p in _planes(ids[at : at + block], bits)]
    index = squeeze(np.array([len(c) for c in chunks], "<u4").tobytes())
    documents = squeeze(table.tobytes())
    head = HEADER.pack(MAGIC, len(ids), len(doc_ids), block, width, bits, len(documents))
    return b"".join([head, struct.pack("<Q", len(index)), documents, index, *chunks])


class TokenFile:
    """Random access to one file."""

    def __init__(self, data: bytes):
        self.data, self.spread = data, zstandard.ZstdDecompressor().decompress
        magic, self.n_ids, n_docs, self.block, self.width, self.bits, table = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        (index,) = struct.unpack_from("<Q", data, HEADER.size)
        at = HEADER.size + 8
        kinds = [("id", "<i8"), ("known", "u1"), ("n", "<u8")]
        self.table = np.frombuffer(self.spread(data[at : at + table]), kinds, n_docs)
        sizes = np.frombuffer(self.spread(data[at + table : at + table + index]), "<u4").astype(np.int64)
        self.ends = np.cumsum(sizes) + at + table + index
        self.starts = self.ends - sizes
        self._last: tuple[int, np.ndarray] | None = None

    def _ids_of(self, block: int) -> np.ndarray:
        if self._last is None or self._last[0] != block:
            n = self.width * (8 if self.bits else 1)
            planes = [self.spread(self.data[self.starts[k] : self.ends[k]]) for k in range(block * n, block * n + n)]
            ids = min(self.block, self.n_ids - block * self.block)
            self._last = block, _block(planes, ids, self.width, self.bits)
        return self._last[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of a range; only its blocks are decompressed."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        parts = [self._ids_of(b) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block].astype("<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, first position and token ids of each document."""
        at = 0
        for row in self.table:
            n = int(row["n"])
            yield (int(row["id"]) if row["known"] else None), at, self.ids(at, at + n)
            at += n


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# Python also splits at these four; the tokenizer may not, so their texts go whole.
_ODD = "\x1c\x1d\x1e\x1f"
REMEMBERED, SHORT = 1 << 20, 32


class WordIds:
    """Packed ids of words between white space; the tokenizer drops white space.

    Holds for tokenizers that end each word of letters by a token of its own kind
    and never join letters with points. Words are cut into letters and points; the
    unknown letter runs of a text are encoded in one call and cut where words end.
    Other words are encoded as they are. At most ``REMEMBERED`` runs and words stay.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        vocab = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocab.values()) < 1 << 16 else "<u4"
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _parts(self, word: str) -> tuple[str, str]:
        """Letters and points of a word, or the word and nothing."""
        run = word.rstrip(string.punctuation)
        if not run.isalpha():
            return word, ""
        return run.lower() if run.isascii() else run, word[len(run) :]

    def _learn(self, new: set[str]) -> None:
        """Encode what is not known: runs of letters together, anything else alone."""
        runs = [run for run in new if run.isalpha()]
        if runs:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(runs):
                data = ids.astype(self.kind).tobytes()
                ends = (ends * int(self.kind[-1])).tolist()
                self.known.update(zip(runs, [data[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                self.known.update((run, self._whole(run)) for run in runs)
        self.known.update((word, self._whole(word)) for word in new if not word.isalpha())

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, packed in the width of the vocabulary."""
        known = self.known
        for text in texts:
            if any(c in text for c in _ODD):
                yield self._whole(text)
                continue
            words = text.split()
            found = list(map(known.get, words))
            if None in found:
                gaps = [(k, self._parts(words[k])) for k, ids in enumerate(found) if ids is None]
                new = {part for _, parts in gaps for part in parts if part and part not in known}
                if new:
                    self._learn(new)
                for k, (run, points) in gaps:
                    found[k] = known[run] + known[points] if points else known[run]
                for word in [word for word in new if len(word) > SHORT]:
                    del known[word]
                if len(known) > REMEMBERED:
                    known.clear()
            yield b"".join(found)


@cache
def _words(path: str) -> WordIds:
    return WordIds(path)


def encode(docs: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, width, ids``: packed little-endian ids of ``width`` bytes each."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        end = b"" if end_id is None else np.array([end_id], words.kind).tobytes()
        for batch in batches:
            packed = [ids + end for ids in words.encode([t or "" for t in batch.column(1).to_pylist()])]
            width = pa.array([int(words.kind[-1])] * len(packed), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), width, pa.array(packed, pa.binary())], ["doc_id", "width", "ids"]
            )

    return rows.mapInArrow(run, "doc_id long, width int, ids binary")


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int | None = None, path: str | None = None,
    file_ids: int = 1 << 20, block_ids: int = 1 << 16, bits: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> str:
    """Encode documents, append ``end_id`` to each, write files in ascending id order.

    Null texts are empty and null ids come last; repeated rows are written each;
    an empty table gives no file. Ids are encoded once and stored, then one range
    exchange puts documents in order; it also splits equal ids by content. A file
    closes at ``file_ids`` ids or after the one document that passes them.
    Returns the path: a table of ``part, file, first, n_ids, payload``.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    ids = staged(encode(docs, tokenizer, end_id, id_col, text_col).withColumn("crc", F.crc32("ids")), "ids")
    by = [F.col("doc_id").asc_nulls_last(), F.col("crc")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, held, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            data = pack(doc_ids, lengths, np.concatenate(held), block_ids, bits)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "file": file, "first": first, "n_ids": total, "payload": data}], schema=FILE_SCHEMA
            )

        for batch in batches:
            for doc_id, width, packed in zip(*[c.to_pylist() for c in batch.columns]):
                got = np.frombuffer(packed, f"<u{width}")
                doc_ids.append(doc_id)
                lengths.append(len(got))
                held.append(got)
                total += len(got)
                if total >= file_ids:
                    yield close()
                    file, first = file + 1, first + total
                    doc_ids, lengths, held, total = [], [], [], 0
        if doc_ids:
            yield close()

    FILE_SCHEMA = pa.schema([
        ("part", pa.int32()), ("file", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary()),
    ])
    ordered = ids.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "width", "ids")
    ordered.mapInArrow(run, "part int, file int, first long, n_ids long, payload binary").write.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, an array) of every document.

    ``start`` counts the ids of all documents before it, over all files.
    """
    files = spark.read.parquet(path)
    # One row for each task that wrote, so the table stays small whatever the ids.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids_of"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids_of").over(before), F.lit(0)).alias("offset"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(*[batch.column(k) for k in range(3)]):
                rows = [
                    (part.as_py(), doc_id, first.as_py() + at, len(found), zlib.crc32(found.tobytes()))
                    + ((found,) if ids else ())
                    for doc_id, at, found in TokenFile(data.as_py()).documents()
                ]
                columns = list(zip(*rows))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["part", "doc_id", "at", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)])

    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    rows = files.select("part", "first", "payload").mapInArrow(run, schema)
    found = rows.join(F.broadcast(parts), "part")
    more = ["ids"] if ids else []
    return found.select("doc_id", (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *more)
