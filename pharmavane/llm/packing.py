"""Best-fit packing by minimum bin slack.

Documents are encoded and cut into pieces, and pieces are packed into sequences of
bounded length. Only the number of pieces of every length matters for that: a table with
one row for each length up to the bound, whatever the corpus. For each sequence the
longest piece left opens it, and a subset-sum over the lengths left, kept as bit sets,
finds the fullest combination that goes with it. The combination is taken as often as
the pieces last, then removed; so the number of steps follows the lengths, not the
pieces. Where that misses the least number of sequences possible, it is tried again with
a little slack allowed, which saves short pieces for later. Pieces are ranked within
their length, and the rank tells sequence and place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import staged
from pharmavane.llm.token_files import WordIds
from pharmavane.operators.skew import same_keys, small_size

CAPACITY = 2048
SLACKS = (0, 1, 4, 16, 64)  # ids that a sequence may lack without a search for a fuller one
_RANKS = 40  # bits of a rank within a length


def fullest(counts: list[int], room: int, slack: int = 0) -> dict[int, int]:
    """How many of each length fill ``room`` best; longer lengths are preferred.

    ``counts[n]`` pieces of length ``n`` are left. Bit ``s`` of a set tells whether the
    lengths seen so far can sum to ``s``; multiples of a length come in powers of two.
    With ``slack`` the search ends at a sum that leaves at most so much.
    """
    mask = (1 << (room + 1)) - 1
    target = mask ^ ((1 << max(0, room - slack)) - 1)
    reach, steps = 1, []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left, power = min(counts[length], room // length), 1
        while left > 0 and not reach & target:
            take = min(power, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, power = left - take, power * 2
        if reach & target:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def plan_sequences(counts: list[int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(sequences, pieces of each length in one)`` of the slack that needs fewest sequences."""
    total = sum(n * c for n, c in enumerate(counts))
    least = max(-(-total // capacity), sum(counts[capacity // 2 + 1 :]))
    best, fewest = [], None
    for slack in SLACKS:
        plan = _plan(counts, capacity, slack)
        needed = sum(times for times, _ in plan)
        if fewest is None or needed < fewest:
            best, fewest = plan, needed
        if fewest == least:
            break
    return best


def _plan(counts: list[int], capacity: int, slack: int) -> list[tuple[int, dict[int, int]]]:
    """One run over the lengths until no piece is left."""
    counts, plan = [*counts], []
    longest = len(counts) - 1
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return plan
        counts[longest] -= 1
        pattern = fullest(counts, capacity - longest, slack)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            counts[length] -= times * n
        plan.append((times, pattern))


class Places:
    """Sequence and offset of the piece of a length and rank."""

    def __init__(self, plan: list[tuple[int, dict[int, int]]]):
        rows, used, sequence = [], {}, 0
        for times, pattern in plan:
            offset = 0
            for length in sorted(pattern, reverse=True):
                n = pattern[length]
                start = used.get(length, 0)
                rows.append((length << _RANKS | start, start, sequence, n, offset))
                used[length] = start + times * n
                offset += n * length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        self.keys, self.start, self.first, self.n, self.offset = table

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, length << _RANKS | rank, "right") - 1
        nth, slot = np.divmod(rank - self.start[at], self.n[at])
        return self.first[at] + nth, self.offset[at] + slot * length


@cache
def _words(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int | None, capacity: int, ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, at``: the pieces of all documents.

    ``part`` is the task that cut a piece and ``at`` its position among the task's pieces of
    that length; store the table before it is read twice. ``ids`` adds the ids of a piece as
    little-endian unsigned 32-bit integers.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "at"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, at long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = _words(tokenizer), TaskContext.get().partitionId()
        met = [0] * (capacity + 1)
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            found: list[tuple] = []
            for doc_id, packed in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).to_pylist())):
                whole = np.frombuffer(packed, words.kind).astype("<u4").tobytes() + end
                for piece, start in enumerate(range(0, len(whole), 4 * capacity)):
                    own = whole[start : start + 4 * capacity]
                    n = len(own) // 4
                    found.append((doc_id, piece, start // 4, n, zlib.crc32(own), part, met[n]) + ((own,) if ids else ()))
                    met[n] += 1
            columns = [*zip(*found)] or [()] * (len(names) + ids)
            types = kinds + [pa.binary()] * ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names + ["ids"] * ids)

    return rows.mapInArrow(run, schema + ", ids binary" * ids)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int | None = 0, capacity: int = CAPACITY, ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece.

    A document is its token ids and ``end_id``; one of more than ``capacity`` ids is cut into
    pieces of that length, the last may be shorter. A sequence holds at most ``capacity`` ids,
    its pieces lie gapless from 0. Null texts are empty; without ``end_id`` empty documents give
    no piece; null ids and repeated rows are packed like others; other columns are left out; an
    empty table gives no rows. ``sequences`` puts the ids of each sequence together.
    """
    if capacity < 1:
        raise ValueError("a sequence holds at least one id")
    pieces = staged(cut_pieces(docs, tokenizer, end_id, capacity, ids, id_col, text_col), "pieces")
    keys = ["part", "length"]
    sizes = staged(pieces.groupBy(*keys).agg(F.count("*").alias("n")), "lengths")
    counts = [0] * (capacity + 1)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row.length] = row.n
    places = Places(plan_sequences(counts, capacity))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    if small_size(shifts) is not None:
        shifts = F.broadcast(shifts)
    ranked = pieces.alias("p").join(shifts.alias("s"), same_keys("p", "s", keys)).select("p.*", (F.col("at") + F.col("shift")).alias("rank"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            found = {c: batch.column(c) for c in names} | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([*found.values()], [*found])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * ids + "sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, pieces, ids`` of every sequence, from pieces with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))  # at most ``capacity`` entries
    whole = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    pieces = F.transform("parts", lambda part: F.struct(part["doc_id"].alias("doc_id"), part["piece"].alias("piece"), part["offset"].alias("offset")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length")).select(
        "sequence_id", "length", pieces.alias("pieces"), whole.alias("ids")
    )
