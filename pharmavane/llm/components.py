"""Connected components of a graph too large for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pharmavane.llm.common import staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie neighbours of every vertex to the smallest vertex among them and itself.

    With ``larger`` only the neighbours above the vertex are tied, and all
    neighbours count; without it those below are tied, with the vertex itself. The
    smallest neighbour combines before the shuffle, and the join back is one that
    adaptive execution splits where a vertex has very many edges. It is never a
    broadcast one, since the table of the smallest grows with the vertices and would
    pass through the driver in every round.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    if larger:
        both = edges.unionByName(turned)
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        low = both.join(least.hint("merge"), "a").filter(F.col("b") > F.col("a"))
        return low.select(F.least("a", "m").alias("a"), "b").filter("a < b").distinct()
    least = turned.groupBy("a").agg(F.min("b").alias("m"))  # every edge has b > a
    low = turned.join(least.hint("merge"), "a")
    ties = low.select(F.col("m").alias("a"), "b").unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return ties.filter("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` of every vertex with an edge; ``edges`` has ``a, b`` (long).

    The component is its smallest vertex. Alternating large and small stars halve
    the depth of every tree, so the rounds grow with the logarithm of the longest
    path; each round is stored, and the end is a round that changes nothing.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = staged(ordered.filter("a < b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == seen:
            break
        seen = state
        now = staged(_star(staged(_star(now, larger=True), "edges"), larger=False), "edges")
    roots = now.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("vertex"), F.col("a").alias("component")).unionByName(roots)


def local_roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row of a link matrix reaches."""
    roots = ids
    while len(ids):
        least = np.minimum(roots, np.where(near, roots[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == roots).all():
            break
        roots = least
    return roots
