"""Hard negatives by an inverted multi-index with certified windows.

Vectors of whole numbers are cut into halves, and each half has a codebook of its own;
a pair of codewords is a cell. A row's score with an anchor is the sum of two half
products, and each half product lies within (norm of the anchor's half) x (radius of
the codeword) of the product with the codeword. So two sorted lists of half bounds give
the cells in order of the largest score they can hold, by a heap over pairs of places.

An anchor's windows are ranges of scores of which the first ``k`` rows are wanted. It
visits the first cells, which gives every window a score to beat, and then every cell
whose bounds still meet an open window: the end is certified, not assumed, and what is
found is exact whatever the codebooks. Positives are one window without ends over rows
of the anchor's label; each positive gives a window for negatives.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import staged
from pharmavane.operators.skew import join_small

SAMPLE = 20_000  # rows that the codebooks are fitted on, those of smallest hash
CODEWORDS = 64  # of each half, at most
CELL_ROWS = 256  # rows that a cell holds on average, while there are fewer codewords than that
FIRST_ROWS = 4096  # rows in the cells an anchor visits first
RACK_ROWS, RACKS = 8192, 512  # rows of neighbouring cells that are searched in one task; racks before they grow
LARGEST_RACK = 1 << 20
ANCHORS = 1 << 16  # anchors that a task holds
PART, RUN = 1024, 1024  # anchors, and rows, that are multiplied at a time
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_KINDS = {2: "<i2", 4: "<i4", 8: "<i8"}


def _whole_numbers(column: pa.ListArray, scale: float) -> list[bytes | None]:
    """Each vector as packed whole numbers with their width before them; None takes no part."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), "<f8")
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(scale * flat)
    ends = np.cumsum(lengths)
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    top = np.abs(flat)
    packed: list[bytes | None] = []
    for start, end in zip((ends - lengths).tolist(), ends.tolist()):
        if start == end or faults[end] > faults[start]:
            packed.append(None)
            continue
        most = top[start:end].max()
        if most >= 1 << 62:
            raise OverflowError("a component is too large for whole numbers; use a smaller scale")
        width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
        packed.append(bytes([width]) + flat[start:end].astype(_KINDS[width]).tobytes())
    return packed


def _matrix(packed: list[bytes]) -> np.ndarray:
    """Rows of one length as 64-bit whole numbers."""
    widths = {v[0] for v in packed}
    if len(widths) == 1:
        width = widths.pop()
        joined = np.frombuffer(b"".join([v[1:] for v in packed]), _KINDS[width])
        return joined.reshape(len(packed), -1).astype("<i8")
    return np.array([np.frombuffer(v, _KINDS[v[0]], offset=1) for v in packed], "<i8")


def _dims(packed: list[bytes]) -> np.ndarray:
    return np.array([(len(v) - 1) // v[0] for v in packed], np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of ``a`` with rows of ``b``."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most >= 1 << 63:
        raise OverflowError("a score may not fit 64 bits; use a smaller scale")
    return a @ b.T


def _codebook(points: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Codewords of one half: means of the points nearest to them, from spread starts."""
    points = np.unique(points, axis=0).astype(float)
    if len(points) <= words:
        return points
    means = points[np.linspace(0, len(points) - 1, words).astype(int)]
    for _ in range(rounds):
        near = _nearest(points, means)
        counts = np.bincount(near, minlength=words)
        sums = np.zeros_like(means)
        np.add.at(sums, near, points)
        means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], means)
    return means


def _nearest(points: np.ndarray, means: np.ndarray) -> np.ndarray:
    return ((means**2).sum(axis=1)[None, :] - 2 * points @ means.T).argmin(axis=1)


class Codebooks:
    """Two codebooks for each length of vectors; a length that the sample lacks has one codeword."""

    def __init__(self, sample: list[bytes], words: int):
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        dims = _dims(sample)
        for dim in set(dims.tolist()):
            rows = _matrix([v for v, d in zip(sample, dims) if d == dim])
            self.of[dim] = _codebook(rows[:, : dim // 2], words), _codebook(rows[:, dim // 2 :], words)

    def halves(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        return self.of.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def place(self, rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The codeword of each half of each row, and its distance."""
        dim = rows.shape[1]
        at, far = [], []
        for half, means in zip((rows[:, : dim // 2], rows[:, dim // 2 :]), self.halves(dim)):
            near = _nearest(half.astype(float), means)
            at.append(near)
            far.append(np.linalg.norm(half - means[near], axis=1))
        return at, far


class Cells:
    """The directory: rows of every cell, radii of every codeword, and the racks that hold a cell.

    It has one entry for a pair of codewords of a vector length, so its size is bounded by
    the square of ``CODEWORDS`` and does not grow with the rows.
    """

    def __init__(self, books: Codebooks, found: list[tuple], rack_rows: int, first_rows: int):
        self.books, self.first_rows = books, first_rows
        total = sum(n for *_, n, _, _ in found)
        size = min(max(rack_rows, -(-total // RACKS)), LARGEST_RACK)
        self.cells: list[tuple[int, int, int]] = []
        self.rack: list[tuple[int, int]] = []  # first rack of a cell, and how many
        self.racks, held = 0, size
        self.rows: dict[int, np.ndarray] = {}
        self.number: dict[int, np.ndarray] = {}
        self.radius: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k, (dim, i, j, n, r1, r2) in enumerate(sorted(found)):
            if dim not in self.rows:
                shape = tuple(len(means) for means in books.halves(dim))
                self.rows[dim], self.number[dim] = np.zeros(shape, np.int64), np.full(shape, -1)
                self.radius[dim] = np.zeros(shape[0]), np.zeros(shape[1])
            self.cells.append((dim, i, j))
            self.rows[dim][i, j], self.number[dim][i, j] = n, k
            for radius, at, r in zip(self.radius[dim], (i, j), (r1, r2)):
                radius[at] = max(radius[at], r)
            if n > size:  # a cell with very many rows is spread over racks of its own
                parts = -(-n // size)
                self.rack.append((self.racks, parts))
                self.racks, held = self.racks + parts, size
            else:
                if held + n > size:
                    self.racks, held = self.racks + 1, 0
                held += n
                self.rack.append((self.racks - 1, 1))

    def in_order(self, anchor: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """Largest and least possible score, number and rows of the cells, by largest score."""
        dim = len(anchor)
        if dim not in self.rows:
            return
        bounds = []
        for half, means, radius in zip((anchor[: dim // 2], anchor[dim // 2 :]), self.books.halves(dim), self.radius[dim]):
            middle, reach = means @ half, np.linalg.norm(half) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-3  # rounding of the bounds themselves
            order = np.argsort(-(middle + reach + slack), kind="stable")
            bounds.append((order, (middle + reach + slack)[order], (middle - reach - slack)[order]))
        (o1, up1, low1), (o2, up2, low2) = bounds
        rows, number = self.rows[dim][np.ix_(o1, o2)].tolist(), self.number[dim][np.ix_(o1, o2)].tolist()
        up1, low1, up2, low2 = (x.tolist() for x in (up1, low1, up2, low2))
        heap = [(-(up1[0] + up2[0]), 0, 0)]
        while heap:
            bound, p, q = heapq.heappop(heap)
            if q == 0 and p + 1 < len(up1):
                heapq.heappush(heap, (-(up1[p + 1] + up2[0]), p + 1, 0))
            if q + 1 < len(up2):
                heapq.heappush(heap, (-(up1[p] + up2[q + 1]), p, q + 1))
            if rows[p][q]:
                yield -bound, low1[p] + low2[q], number[p][q], rows[p][q]

    def visits(self, anchor: np.ndarray, lo: list[int], hi: list[int], beat: list[int] | None) -> list[int]:
        """Cells to visit: the first ones, or with ``beat`` the rest that an open window needs.

        A cell is of use to a window if its largest score reaches the least one wanted
        and its least score does not pass the largest one wanted.
        """
        found, rows = [], 0
        ends = [*zip(lo, hi)]
        least = min(lo if beat is None else beat, default=_MOST)
        for up, low, cell, n in self.in_order(anchor):
            if up < least:
                break
            use = any(up >= a and low <= b for a, b in ends)
            if rows < self.first_rows:
                if not use:
                    continue
                rows += n
                if beat is None:
                    found.append(cell)
            elif beat is None:
                break
            elif use and any(up >= a and low <= b for a, b in zip(beat, hi)):
                found.append(cell)
        return found


def _pack(vectors: DataFrame, scale: float) -> DataFrame:
    """``vec_id, label, is_anchor, v`` of the rows that take part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column(3)
            if isinstance(vector, pa.ChunkedArray):
                vector = vector.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(_whole_numbers(vector, scale), pa.binary())], ["vec_id", "label", "is_anchor", "v"]
            )

    packed = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    packed = packed.mapInArrow(run, "vec_id long, label long, is_anchor boolean, v binary")
    return staged(packed.filter("v IS NOT NULL"), "vectors")


def _place(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Rows with their cell and the distances of their halves from its codewords."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(3).to_pylist()
            dims = _dims(packed)
            for dim in set(dims.tolist()):
                own = np.flatnonzero(dims == dim)
                (i, j), (r1, r2) = books.place(_matrix([packed[k] for k in own]))
                part = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(x, pa.int32()) for x in (np.full(len(own), dim), i, j)], pa.array(r1), pa.array(r2)],
                    ["vec_id", "label", "is_anchor", "v", "dim", "i", "j", "r1", "r2"],
                )

    return rows.mapInArrow(run, "vec_id long, label long, is_anchor boolean, v binary, dim int, i int, j int, r1 double, r2 double")


_ASKED = "rack int, block int, kind int, cell int, aid long, vec_id long, label long, v binary, lo array<long>, hi array<long>, beat array<long>, cells array<int>"


def _ask(anchors: DataFrame, cells: Cells, first: bool) -> DataFrame:
    """Anchors at every rack that holds cells they visit, with these cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a in batch.to_pylist():
                racks: dict[int, list[int]] = {}
                for cell in cells.visits(_matrix([a["v"]])[0], a["lo"], a["hi"], None if first else a["beat"]):
                    start, parts = cells.rack[cell]
                    for rack in range(start, start + parts):
                        racks.setdefault(rack, []).append(cell)
                rows += [
                    {**a, "rack": rack, "kind": 0, "cell": -1, "cells": own, "beat": a["lo"] if first else a["beat"]}
                    for rack, own in racks.items()
                ]
            yield pa.RecordBatch.from_pylist(rows, schema=_ASKED_ARROW)

    return anchors.select("aid", "block", "vec_id", "label", "v", "lo", "hi", "beat").mapInArrow(run, _ASKED)


_ASKED_ARROW = pa.schema([
    *[(c, pa.int32()) for c in ("rack", "block", "kind", "cell")], *[(c, pa.int64()) for c in ("aid", "vec_id", "label")],
    ("v", pa.binary()), *[(c, pa.list_(pa.int64())) for c in ("lo", "hi", "beat")], ("cells", pa.list_(pa.int32())),
])
_FOUND = pa.schema([("aid", pa.int64()), ("w", pa.int32()), ("score", pa.int64()), ("found_id", pa.int64())])


def _first(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first rows of each key, by falling score and rising id, each once."""
    order = np.lexsort((ids, -score, key))
    key, score, ids = key[order], score[order], ids[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
    order, key = order[fresh], key[fresh]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
    rank = np.arange(len(key)) - np.repeat(starts, np.diff([*starts, len(key)]))
    return order[rank < k]


class _Search:
    """The anchors of one rack and block, and the best rows found for their windows so far."""

    def __init__(self, asked: list[dict], same_label: bool, k: int):
        self.k, self.same, self.asked = k, same_label, asked
        self.windows = max(len(a["lo"]) for a in asked)

        def padded(name: str, fill: int) -> np.ndarray:
            return np.array([a[name] + [fill] * (self.windows - len(a[name])) for a in asked], np.int64)

        self.beat, self.hi = padded("beat", 1), padded("hi", 0)
        self.ids = np.array([a["vec_id"] for a in asked], np.int64)
        self.labels = np.array([a["label"] for a in asked], np.int64)
        self.of_cell: dict[int, list[int]] = {}
        for at, a in enumerate(asked):
            for cell in a["cells"]:
                self.of_cell.setdefault(cell, []).append(at)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def visit(self, cell: int, ids: np.ndarray, labels: np.ndarray, packed: list[bytes]) -> None:
        """Score rows of one cell, hence of one length, with the anchors that visit it."""
        asking = np.array(self.of_cell.get(cell, []), np.int64)
        rows = _matrix(packed)
        for start in range(0, len(asking), PART):
            own = asking[start : start + PART]
            scores = _products(_matrix([self.asked[a]["v"] for a in own]), rows)
            fits = (self.labels[own][:, None] == labels[None, :]) == self.same
            if self.same:  # another row, not the anchor
                fits &= self.ids[own][:, None] != ids[None, :]
            for w in range(self.windows):
                within = fits & (scores >= self.beat[own, w][:, None]) & (scores <= self.hi[own, w][:, None])
                a, r = np.nonzero(within)
                if len(a):
                    new = own[a] * self.windows + w, scores[a, r], ids[r]
                    keep = _first(*new, self.k)
                    self.held.append(tuple(x[keep] for x in new))
                    self.size += len(keep)
        if self.size > 1 << 20:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Keep the best of each window, and let later rows beat the last of them."""
        if not self.held:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        key, score, ids = (np.concatenate(x) for x in zip(*self.held))
        keep = _first(key, score, ids, self.k)
        key, score, ids = key[keep], score[keep], ids[keep]
        full, counts = np.unique(key, return_counts=True)
        last = score[np.cumsum(counts) - 1][counts == self.k]
        full = full[counts == self.k]
        self.beat.ravel()[full] = np.maximum(self.beat.ravel()[full], last)
        self.held, self.size = [(key, score, ids)], len(key)
        return self.held[0]

    def result(self) -> pa.RecordBatch:
        key, score, ids = self.settle()
        aid = np.array([a["aid"] for a in self.asked], np.int64)[key // self.windows]
        return pa.RecordBatch.from_arrays(
            [pa.array(aid), pa.array(key % self.windows, pa.int32()), pa.array(score), pa.array(ids)], schema=_FOUND
        )


def _search(asked: DataFrame, index: DataFrame, blocks: int, same_label: bool, k: int) -> DataFrame:
    """``aid, w, score, found_id``: the best rows of each window in the visited cells of each rack.

    Anchors come before the rows of their rack, so a task holds the anchors of one rack
    and block, and rows pass by.
    """
    anchor_only = ["lo", "hi", "beat"]
    rows = index.select("rack", "cell", "vec_id", "label", "v").withColumn("kind", F.lit(1)).withColumn("aid", F.lit(-1).cast("long"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    for name in anchor_only:
        rows = rows.withColumn(name, F.lit(None).cast("array<long>"))
    rows = rows.withColumn("cells", F.lit(None).cast("array<int>"))
    both = asked.unionByName(rows).repartition("rack", "block").sortWithinPartitions("rack", "block", "kind", "cell")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked_here, search = None, [], None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("rack", "block", "kind", "cell")], axis=1)
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(place)]):
                if start == stop:
                    continue
                rack, block, kind, cell = place[start].tolist()
                if now != (rack, block):
                    if search:
                        yield search.result()
                    now, asked_here, search = (rack, block), [], None
                if kind == 0:
                    asked_here += batch.slice(start, stop - start).to_pylist()
                    continue
                if search is None and asked_here:
                    search = _Search(asked_here, same_label, k)
                if search is None or cell not in search.of_cell:
                    continue
                for at in range(start, stop, RUN):
                    part = batch.slice(at, min(RUN, stop - at))
                    search.visit(
                        cell, part.column("vec_id").to_numpy(), part.column("label").to_numpy(), part.column("v").to_pylist()
                    )
        if search:
            yield search.result()

    return both.mapInArrow(run, "aid long, w int, score long, found_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every window, numbered."""
    order = Window.partitionBy("aid", "w").orderBy(F.desc("score"), "found_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _windows(anchors: DataFrame, index: DataFrame, cells: Cells, blocks: int, same_label: bool, k: int) -> DataFrame:
    """The first ``k`` rows of every window of ``anchors`` (``lo``, ``hi``: arrays), in two rounds of visits."""
    asked = _ask(anchors.withColumn("beat", F.col("lo")), cells, first=True)
    early = staged(_best(_search(asked, index, blocks, same_label, k), k), "early")
    last = early.filter(f"rank = {k}").groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("last"))
    beat = F.transform("lo", lambda lo, w: F.greatest(lo, F.coalesce(F.col("last")[w], lo)))
    again = anchors.join(last, "aid", "left").withColumn("beat", beat)
    late = _search(_ask(again, cells, first=False), index, blocks, same_label, k)
    return staged(_best(early.drop("rank").unionByName(late), k), "found")


def hard_negatives(
    vectors: DataFrame, anchors: str = "vec_id % 100 = 0", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: float = 256, codewords: int = CODEWORDS, sample: int = SAMPLE,
    first_rows: int = FIRST_ROWS, rack_rows: int = RACK_ROWS, task_anchors: int = ANCHORS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale x)``; a score is the product of two rows, exact in 64 bits.
    Anchors are the rows for which the SQL condition ``anchors`` on ``vec_id`` and ``label``
    holds. The positives of an anchor are its first ``positives`` other rows of its label; for
    each, the first ``negatives`` rows of another label with a score of ``low`` to ``high`` per
    cent of the positive's are given. Higher scores come first, then smaller ids.

    Rows with a null id, label or vector, an empty vector, or a component that is null or not
    finite (also once scaled) take no part. Vectors of different lengths are not compared. Rows
    that repeat another whole count once; a row with an anchor's id is no other row. Labels are
    whole numbers. Components or scores that pass 64 bits raise ``OverflowError``. Other columns
    are left out; an empty table gives no rows.

    The codebooks are fitted on at most ``sample`` rows, those with the smallest hashes; every
    row is indexed, and results do not depend on the codebooks. ``first_rows``, ``rack_rows`` and
    ``task_anchors`` set how the work is dealt, not what it finds.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("long").alias("label"), vectors[vector_col].alias("vector")
    )
    rows = _pack(rows.select("vec_id", "label", F.coalesce(F.expr(anchors), F.lit(False)).alias("is_anchor"), "vector"), scale)
    total = rows.count()
    words = min(codewords, max(1, math.ceil(math.sqrt(total / CELL_ROWS))))
    hashed = rows.select("v", F.xxhash64("vec_id", "label", "v").alias("hash"))
    books = Codebooks([r.v for r in hashed.orderBy("hash", "v").limit(sample).select("v").toLocalIterator()], words)
    placed = staged(_place(rows, books), "placed")
    found = placed.groupBy("dim", "i", "j").agg(F.count("*"), F.max("r1"), F.max("r2")).collect()
    cells = Cells(books, [tuple(r) for r in found], rack_rows, first_rows)

    spark = vectors.sparkSession
    directory = spark.createDataFrame(
        [(*cell, k, *cells.rack[k]) for k, cell in enumerate(cells.cells)], "dim int, i int, j int, cell int, start int, parts int"
    )
    key = F.struct("dim", "i", "j").alias("place")
    index = join_small(placed.withColumn("place", key), directory.select(key, "cell", "start", "parts"), "place", "inner")
    rack = F.col("start") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int")
    index = index.select("vec_id", "label", "is_anchor", "v", "cell", rack.alias("rack"))

    chosen = placed.filter("is_anchor").select("vec_id", "label", "v").distinct()
    chosen = staged(chosen.withColumn("aid", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-chosen.count() // task_anchors))
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("aid"), F.lit(blocks)).cast("int"))
    all_scores = chosen.withColumn("lo", F.array(F.lit(_LEAST))).withColumn("hi", F.array(F.lit(_MOST)))
    positive = _windows(all_scores, index, cells, blocks, True, positives)

    hundredth = F.col("score").cast("decimal(20,0)") / 100
    ends = positive.select(
        "aid", F.struct("rank", F.ceil(hundredth * low).cast("long").alias("lo"), F.floor(hundredth * high).cast("long").alias("hi")).alias("end")
    )
    ends = ends.groupBy("aid").agg(F.sort_array(F.collect_list("end")).alias("ends"))  # at most ``positives`` entries
    open_ = chosen.join(ends, "aid").withColumn("lo", F.col("ends.lo")).withColumn("hi", F.col("ends.hi")).drop("ends")
    negative = _windows(open_, index, cells, blocks, False, negatives)

    pairs = negative.select("aid", (F.col("w") + 1).alias("p"), "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    of_pair = positive.select("aid", F.col("rank").alias("p"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = pairs.join(of_pair, ["aid", "p"]).join(chosen.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
