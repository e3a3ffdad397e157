"""Near-duplicate vectors: sign hashing in several tables, exact check, components.

Vectors that are equal collapse first. Each table hashes a vector to the signs of
its products with random planes; vectors of one bucket are compared exactly, by
cosine in double precision. The numbers of planes and tables follow from the number
of vectors and the wanted chance to find a pair at the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pharmavane.llm.common import staged
from pharmavane.llm.components import components, local_roots

BUCKET = 32  # distinct vectors that a bucket holds on average
BLOCK = 512  # vectors that a task compares with as many others


def plan_tables(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    """Planes of a table and number of tables.

    Two vectors at the threshold lie on the same side of a plane with probability
    ``1 - angle / pi``; tables are added until one of them agrees in all planes
    with probability ``recall``.
    """
    planes = min(40, max(4, math.ceil(math.log2(max(2, vectors) / BUCKET))))
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _normals(dim: int, planes: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, planes * tables))


def signatures(unit: np.ndarray, planes: int, tables: int, seed: int) -> np.ndarray:
    """The bucket of each row in each table."""
    signs = unit @ _normals(unit.shape[1], planes, tables, seed) > 0
    return signs.reshape(len(unit), tables, planes) @ (1 << np.arange(planes, dtype=np.int64))


def _matrix(packed: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision from packed ones."""
    rows = np.array([np.frombuffer(v, kind) for v in packed], "<f8")
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _packed(embedding, known: bool, kind: str) -> bytes | None:
    """A vector as bytes of its own precision; null if it can link with nothing."""
    if not known or embedding is None or None in embedding:
        return None
    vector = np.array(embedding, kind) + 0.0  # one zero
    top = np.abs(vector).max(initial=0)
    if not np.isfinite(top) or not top > 0:
        return None
    return (vector / top if kind == "<f8" else vector).tobytes()  # doubles scaled: no overflow in squares


def _pack_rows(vectors: DataFrame, kind: str) -> DataFrame:
    """``vec_id, v, key``: packed vectors, and a digest that only equal ones share."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            packed = [_packed(embedding, vec_id is not None, kind) for vec_id, embedding in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "v"])

    rows = vectors.mapInArrow(pack, "vec_id long, v binary")
    return staged(rows.withColumn("key", F.sha2("v", 256)), "vectors")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = 0.9999, seed: int = 1,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    A link is a pair of rows with cosine at or above ``threshold``; equal vectors
    are linked, rows that repeat an id too. Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without an id, link with nothing;
    without an id ``component_id`` is null and ``kept`` false. Vectors of different
    lengths are not compared. Other columns are left out; an empty table gives no
    rows.

    A bucket of any size is compared whole, in pairs of blocks of at most about
    ``BLOCK`` vectors. Tasks return a count and one edge for each vector, never
    pairs: a pair is counted in the first table where it meets, and edges lead to
    the smallest id of the group found there.
    """
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    rows = _pack_rows(vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("v")), kind)
    reps = staged(
        rows.filter("v IS NOT NULL").groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v")
        ),
        "classes",
    )
    distinct = reps.count()
    planes, tables = plan_tables(distinct, threshold, recall)

    def hash_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, data = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_dim: dict[int, list[int]] = {}
            for k, v in enumerate(data):
                by_dim.setdefault(len(v) // int(kind[-1]), []).append(k)
            for dim, picked in by_dim.items():
                codes = signatures(_matrix([data[k] for k in picked], kind), planes, tables, seed)
                at = np.tile(np.arange(tables), len(picked))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([ids[k] for k in picked], tables), pa.int64()), pa.array(at, pa.int32()),
                     pa.array(np.full(len(at), dim), pa.int32()), pa.array(codes.ravel(), pa.int64())],
                    ["rep", "tab", "dim", "code"],
                )

    bucket = ["tab", "dim", "code"]
    placed = staged(reps.select("rep", "v").mapInArrow(hash_batch, "rep long, tab int, dim int, code long"), "buckets")
    sizes = placed.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")
    spread = placed.join(sizes, bucket).withColumn("blocks", blocks).withColumn("own", own)
    # Block i meets every block j: the pair (smaller, larger) is one task.
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("rep", *bucket, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = spread.join(reps.select("rep", "n", "v"), "rep")

    def compare(group: pa.Table) -> pa.Table:
        i, j, tab = (group.column(c)[0].as_py() for c in ("i", "j", "tab"))
        ids, n, own = (group.column(c).to_numpy() for c in ("rep", "n", "own"))
        unit = _matrix(group.column("v").to_pylist(), kind)
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        if i != j:  # pairs within a block belong to the task (i, i)
            near &= own[:, None] != own[None, :]
        met = np.flatnonzero(near.any(axis=1))
        if not len(met):
            return _RESULT.empty_table()
        near, ids, n = near[np.ix_(met, met)], ids[met], n[met]
        fresh = near
        if tab:
            codes = signatures(unit[met], planes, tables, seed)
            fresh = near.copy()
            for t in range(tab):
                fresh &= codes[:, t][:, None] != codes[:, t][None, :]
        roots = local_roots(near, ids)
        return pa.table([pa.array(ids), pa.array(fresh @ n), pa.array(roots)], schema=_RESULT)

    found = staged(
        full.groupBy(*bucket, "i", "j").applyInArrow(compare, "rep long, links long, root long"), "links"
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = reps.join(links, "rep", "left").join(groups.withColumnRenamed("vertex", "rep"), "rep", "left")
    known = known.select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    result = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


_RESULT = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
