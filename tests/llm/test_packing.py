"""Best-fit packing against the tokenizer library and a plain first-fit packer."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pharmavane.llm import packing, queries

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(docs, capacity):
    model, found = Tokenizer.from_file(WORD_BPE), []
    for row in docs.collect():
        ids = np.array([*model.encode(row.text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            found.append((row.doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
    return found


def first_fit_decreasing(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        at = next((k for k, room in enumerate(left) if room >= n), None)
        if at is None:
            left.append(capacity - n)
        else:
            left[at] -= n
    return len(left)


def check(rows, expected, capacity):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(expected)
    of_sequence = defaultdict(list)
    for r in rows:
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for held in of_sequence.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    lengths = [n for *_, n, _ in expected]
    assert math.ceil(sum(lengths) / capacity) <= len(of_sequence) <= first_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("capacity", [17, 256, 2048])
def test_pieces_and_sequences(hostile, capacity):
    rows = packing.pack_documents(hostile, WORD_BPE, 0, capacity).collect()
    check(rows, pieces_of(hostile, capacity), capacity)


def test_sequences_hold_the_ids(hostile):
    packed = packing.pack_documents(hostile.repartition(5), WORD_BPE, 0, 100, ids=True)
    rows = packed.collect()
    own = {(r.sequence_id, r.offset): bytes(r.ids) for r in rows}
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    for s in packing.sequences(packed).collect():
        parts = [own[s.sequence_id, p.offset] for p in s.pieces]
        assert bytes(s.ids) == b"".join(parts) and len(s.ids) == 4 * s.length <= 400


def test_empty_tables_and_texts(spark, empty):
    assert packing.pack_documents(empty, WORD_BPE).collect() == []
    docs = spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id long, text string")
    rows = packing.pack_documents(docs, WORD_BPE, 0, 2).collect()
    assert Counter((r.doc_id, r.piece, r.length) for r in rows) == Counter({(1, 0, 1): 2, (None, 0, 1): 1})
    assert len({r.sequence_id for r in rows}) == 2
    assert packing.pack_documents(docs, WORD_BPE, None, 2).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(docs, WORD_BPE, 0, 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(40, 60))
def test_fullest_is_the_best_sum(lengths, room):
    counts = [0] * 41
    for n in lengths:
        counts[n] += 1
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    chosen = packing.fullest(counts, room)
    assert sum(n * m for n, m in chosen.items()) == max(sums)
    assert all(m <= counts[n] for n, m in chosen.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 10**9)), max_size=30))
def test_plan_uses_every_piece_once(held):
    counts = [0] * 51
    for n, m in held:
        counts[n] = m
    plan, used = packing.plan_sequences(counts, 50), [0] * 51
    for times, pattern in plan:
        assert sum(n * m for n, m in pattern.items()) <= 50
        for n, m in pattern.items():
            used[n] += times * m
    assert used == counts and len(plan) < 2000


def test_steps_follow_lengths_not_pieces():
    rng = np.random.default_rng(3)
    plan = packing.plan_sequences([0, *rng.integers(0, 10**9, 2048).tolist()], 2048)
    assert len(plan) < 40_000


@pytest.mark.parametrize("most", [1, 2, 3])
def test_no_more_sequences_than_first_fit(most):
    """Lengths whose counts do not match, where no plan reaches the least sum."""
    rng = np.random.default_rng(most)
    counts = [0, *rng.integers(0, most + 1, 1024).tolist()]
    lengths = [n for n, c in enumerate(counts) for _ in range(c)]
    assert sum(times for times, _ in packing.plan_sequences(counts, 1024)) <= first_fit_decreasing(lengths, 1024)


def test_hot_length(spark):
    """A third of all rows have one length; tasks rank them apart."""
    docs = spark.range(0, 3000, 1, 7).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', repeat('word ', CAST(id % 50 AS INT))) AS text")
    check(packing.pack_documents(docs, WORD_BPE, 0, 64).collect(), pieces_of(docs, 64), 64)


def test_registered_query(spark, hostile, tmp_path):
    hostile.select("doc_id", "text").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op11_packing"](spark, str(tmp_path)).collect()
    check(rows, pieces_of(hostile, 2048), 2048)
