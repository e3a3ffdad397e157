"""Hard negatives against plain search over all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pharmavane.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label long, rank int, cell int, aid long"


def brute(rows, scale=256, positives=5, negatives=10, low=30, high=90, every=10):
    part = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.add((vec_id, label, tuple(math.floor(scale * x) for x in vector)))
    part = sorted(part)
    found = set()
    for vec_id, label, vector in part:
        if vec_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, lab) for i, lab, v in part if len(v) == len(vector)]
        same = sorted({(s, i) for s, i, lab in scored if lab == label and i != vec_id})[:positives]
        for ps, positive in same:
            within = sorted({(s, i) for s, i, lab in scored if lab != label and -low * ps <= -100 * s <= -high * ps})[:negatives]
            found |= {(vec_id, positive, rank, i, -ps, -s) for rank, (s, i) in enumerate(within, 1)}
    return found


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA).repartition(parts)


def hostile():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 8))
    rows = []
    for k in range(500):
        vector = centres[k % 6] + 0.4 * rng.standard_normal(8)
        rows.append((k, (vector / np.linalg.norm(vector)).tolist(), int(k % 4)))
    rows += [(k, rows[3][1], k % 3) for k in range(500, 700)]  # ties
    rows += [rows[20], rows[20], (20, rows[21][1], 2)]  # repeats, and an anchor's id again
    rows += [(700, None, 1), (None, rows[0][1], 1), (710, rows[0][1], None), (720, [], 1), (730, [None] * 8, 1)]
    rows += [(740, [math.nan] + [0.0] * 7, 1), (750, [math.inf] + [0.0] * 7, 1), (760, [0.0] * 8, 1), (761, [0.0] * 8, 2), (762, [0.0] * 8, 1)]
    rows += [(k, [0.1 * k, -0.2, 0.3], k % 2) for k in range(770, 800)] + [(800, [900.0] * 8, 0), (801, [-900.0] * 8, 1)]
    return rows


@pytest.mark.parametrize(
    "options",
    [{}, {"codewords": 5, "first_rows": 8, "rack_rows": 16, "task_anchors": 7}, {"sample": 20, "codewords": 3, "first_rows": 1}, {"sample": 0}],
)
def test_against_all_rows(spark, options):
    rows = hostile()
    found = hn.hard_negatives(frame(spark, rows), "vec_id % 10 = 0", **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_random_tables(spark):
    for seed in range(3):
        rng = np.random.default_rng(seed)
        rows = [(k, rng.integers(-3, 4, 5).astype(float).tolist(), int(rng.integers(0, 3))) for k in range(300)]
        got = hn.hard_negatives(frame(spark, rows), "vec_id % 10 = 0", scale=1, codewords=6, first_rows=20, rack_rows=30, negatives=3)
        assert {tuple(r) for r in got.collect()} == brute(rows, scale=1, negatives=3)


def test_one_label_no_anchor_and_empty(spark):
    rows = [(k, [1.0, 0.5 * k], 1) for k in range(20)]
    assert hn.hard_negatives(frame(spark, rows), "vec_id % 10 = 0").collect() == []
    assert hn.hard_negatives(frame(spark, rows), "vec_id = 1000").collect() == []
    assert hn.hard_negatives(frame(spark, rows[:1]).limit(0), "vec_id % 10 = 0").collect() == []


def test_cells_come_by_falling_bound_and_hold_what_they_promise():
    rng = np.random.default_rng(1)
    rows = np.floor(256 * rng.standard_normal((3000, 10))).astype(np.int64)
    packed = [bytes([8]) + row.tobytes() for row in rows]
    books = hn.Codebooks(packed[:500], 7)
    (i, j), (r1, r2) = books.place(rows)
    found = {}
    for k in range(len(rows)):
        n, a, b = found.get((i[k], j[k]), (0, 0, 0))
        found[i[k], j[k]] = n + 1, max(a, r1[k]), max(b, r2[k])
    cells = hn.Cells(books, [(10, int(p), int(q), *v) for (p, q), v in found.items()], 8192, 100)
    anchor = rows[0]
    scores = rows @ anchor
    met, last = set(), math.inf
    for up, low, cell, n in cells.in_order(anchor):
        _, p, q = cells.cells[cell]
        own = scores[(i == p) & (j == q)]
        assert up <= last + 1e-6 and low <= own.min() and own.max() <= up and n == len(own)
        last = up
        met.add(cell)
    assert len(met) == len(cells.cells)


def test_far_cells_are_left_out(spark):
    """Clusters that point away are not visited, and the end is still certified."""
    rng = np.random.default_rng(2)
    centres = np.eye(16)[:8] * 2
    rows = np.floor(256 * (np.repeat(centres, 400, axis=0) + 0.01 * rng.standard_normal((3200, 16)))).astype(np.int64)
    packed = [bytes([8]) + row.tobytes() for row in rows]
    books = hn.Codebooks(packed, 8)
    (i, j), (r1, r2) = books.place(rows)
    found = {}
    for k in range(len(rows)):
        n, a, b = found.get((i[k], j[k]), (0, 0, 0))
        found[i[k], j[k]] = n + 1, max(a, r1[k]), max(b, r2[k])
    cells = hn.Cells(books, [(16, int(p), int(q), *v) for (p, q), v in found.items()], 8192, 100)
    first = cells.visits(rows[0], [-(1 << 63)], [(1 << 63) - 1], None)
    beat = int(np.sort(rows[:400] @ rows[0])[-5])
    rest = cells.visits(rows[0], [-(1 << 63)], [(1 << 63) - 1], [beat])
    assert sum(cells.rows[16].ravel()) == 3200 and len(first) + len(rest) < len(cells.cells) / 2


def test_components_too_large_for_the_scale(spark):
    with pytest.raises(Exception, match="smaller scale"):
        hn.hard_negatives(frame(spark, [(10, [1e300], 1), (11, [1.0], 1)]), "vec_id % 10 = 0").collect()
