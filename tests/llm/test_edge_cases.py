"""Every operator on the hostile table, against plain Python; and on an empty one."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pharmavane.llm import bpe, components, licenses, line_dedup, mixing, ngram_join, quality, sharding, token_files

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(docs):
    return [(r.doc_id, r.text or "", r.source) for r in docs.collect()]


def multiset(rows):
    return Counter(tuple(r) for r in rows)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_bpe(hostile):
    model = Tokenizer.from_file(BYTE_BPE)
    expected = []
    for doc_id, text, _ in rows_of(hostile):
        ids = model.encode(text, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        back = model.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), packed, back))
    found = bpe.encode_documents(hostile, BYTE_BPE, ids=True, decoded=True).collect()
    assert multiset((*r[:4], bytes(r[4]), r[5]) for r in found) == multiset(expected)


@pytest.mark.parametrize("file_ids, block_ids, bits", [(1 << 20, 1 << 16, False), (300, 64, True)])
def test_token_files(spark, hostile, file_ids, block_ids, bits):
    path = token_files.write_token_files(hostile, WORD_BPE, 2, file_ids=file_ids, block_ids=block_ids, bits=bits)
    found = token_files.read_token_files(spark, path, ids=True).orderBy("start").collect()
    model, start = Tokenizer.from_file(WORD_BPE), 0
    texts = defaultdict(list)
    for doc_id, text, _ in rows_of(hostile):
        texts[doc_id].append([*model.encode(text, add_special_tokens=False).ids, 2])
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda i: (i is None, i or 0))
    for r in found:
        assert r.start == start and r.ids in texts[r.doc_id]
        texts[r.doc_id].remove(r.ids)
        assert r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert not any(texts.values())


def test_line_dedup(hostile):
    seen, docs = {}, rows_of(hostile)
    rank = {None: 1 << 70}
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc_id, text, _ in docs:
        for line in text.split("\n"):
            place = rank.get(doc_id, doc_id)
            seen[key(line)] = min(seen.get(key(line), place), place)
    expected = []
    for doc_id, text, _ in docs:
        lines = text.split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or seen[key(x)] == rank.get(doc_id, doc_id)]
        expected.append((doc_id, "\n".join(stay), len(lines), len(lines) - len(stay)))
    for batches, fanout in ((1, 2), (5, 2), (7, 3)):
        found = line_dedup.dedup_lines(hostile, batches=batches, fanout=fanout)
        assert multiset(found.select("doc_id", "text", "n_lines", "n_dropped").collect()) == multiset(expected)
    kept = line_dedup.shorten(hostile)
    assert kept.columns == hostile.columns
    assert multiset(kept.select("doc_id", "text").collect()) == multiset(e[:2] for e in expected)


def test_runs_are_levelled(spark):
    runs = line_dedup.SortedRuns(2)
    for k in range(5):
        runs.add(spark.range(k * 10, k * 10 + 10).selectExpr("id AS h1", "id AS h2"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.all().count() == 50


def stats(text):
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(k, k + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(hostile):
    rule = quality.Rule((quality.Condition("symbols_per_word", True, 0.02),), 0, 1)
    found = quality.judge(hostile, [rule]).drop("text")
    expected = []
    for doc_id, text, _ in rows_of(hostile):
        counts = stats(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        expected.append((doc_id, *counts, failed, not failed and not counts[2] / counts[0] > 0.02))
    assert multiset(found.collect()) == multiset(expected)
    kept = quality.keep_good(hostile, [rule])
    assert kept.columns == hostile.columns and kept.count() == sum(e[-1] for e in expected)


def brute_components(docs, percent=80):
    sets = []
    for doc_id, text, _ in docs:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = {doc_id: doc_id for doc_id, _, _ in docs if doc_id is not None}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, (a, _, _) in enumerate(docs):
        for j, (b, _, _) in enumerate(docs[:i]):
            both = len(sets[i] & sets[j])
            if None not in (a, b) and both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(doc_id, len(s), None if doc_id is None else find(doc_id)) for (doc_id, _, _), s in zip(docs, sets)]


def test_ngram_join(monkeypatch, hostile):
    expected = multiset(brute_components(rows_of(hostile)))
    assert multiset(ngram_join.jaccard_components(hostile).collect()) == expected
    for name, value in (("SEGMENT", 50), ("BLOCK", 4), ("BLOCK_SHINGLES", 900), ("COLUMNS", 7)):
        monkeypatch.setattr(ngram_join, name, value)
    assert multiset(ngram_join.jaccard_components(hostile).collect()) == expected
    kept = ngram_join.keep_one(hostile)
    gone = {e[0] for e in expected if e[0] != e[2]}
    assert kept.columns == hostile.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, _ in rows_of(hostile) if i not in gone)


def test_ngram_join_gathers_no_table_in_the_driver(monkeypatch, hostile):
    """What the planner takes for small is merged all the same; only the filter of ids is broadcast."""
    plans, held = [], []

    def recorded(df, name, staged=components.staged):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    def built(keys, key, build=ngram_join.key_filter.build, **limits):
        held.append(build(keys, key, **limits))
        return held[-1]

    monkeypatch.setattr(components, "staged", recorded)
    monkeypatch.setattr(ngram_join, "staged", recorded)
    monkeypatch.setattr(ngram_join.key_filter, "build", built)
    found = ngram_join.jaccard_components(hostile)
    assert multiset(found.collect()) == multiset(brute_components(rows_of(hostile)))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    broadcast = [line for plan in plans for line in plan.splitlines() if "BroadcastExchange" in line]
    assert len(broadcast) == 1 == sum(made is not None for made in held)
    assert sum(plan.count("SortMergeJoin") for plan in plans) > 10


def test_a_shingle_of_many_documents_is_cut_by_document(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SEGMENT", 200)
    passage = " ".join(f"p{k}" for k in range(12))
    docs = [(k, f"{passage} {' '.join(f'd{k // 2}w{j}' for j in range(30))}{' more' * (k % 2)}", "a") for k in range(600)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    texts = table.selectExpr("doc_id", "cast(text as binary) as text")
    sets = texts.mapInArrow(ngram_join._read_sets(80), "doc_id long, n long, node long, prefix binary")
    pieces = ngram_join._overfull(sets, "prefix", 20)
    assert pieces
    segments = ngram_join._cut(sets, "n", "prefix", 20, int, pieces)
    sizes = segments.selectExpr("fragment", "piece", "octet_length(hashes) / 8 AS n").groupBy("fragment", "piece").sum("n")
    held = [r[2] for r in sizes.collect()]
    assert len(held) > 20 and max(held) <= ngram_join.OVERFULL * 200
    assert multiset(ngram_join.jaccard_components(table).collect()) == multiset(brute_components(docs))


def test_mixing(monkeypatch, hostile):
    found = mixing.plan_mix(hostile).collect()
    again = mixing.plan_mix(hostile.repartition(7)).collect()
    key = ["doc_id", "size", "source_size", "target", "taken"]
    assert multiset([r[k] for k in key] for r in found) == multiset([r[k] for k in key] for r in again)
    sizes = Counter()
    for _, text, source in rows_of(hostile):
        sizes[source] += len(WORD.findall(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    left = 1.5 * sum(sizes.values())
    while open_ and left > 1e-9:  # the excess is shared again and again
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - 2 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    longest = {s: max(r.size for r in found if r.source == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in order)
    mixed = mixing.mix(hostile)
    assert mixed.columns == hostile.columns
    words = Counter()
    for _, text, source in rows_of(mixed):
        words[source] += len(WORD.findall(text))
    assert words == +taken
    monkeypatch.setattr(mixing, "GROUP_ROWS", 3)
    pieces = mixing.plan_mix(hostile).collect()
    assert multiset((r.doc_id, r.size, r.taken) for r in pieces) == multiset((r.doc_id, r.size, r.taken) for r in found)


def test_sharding(hostile):
    found = sharding.shard_documents(hostile, 8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _ in rows_of(hostile)
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len({r.shard for r in found if r.doc_id == i}) == 1 for i in {r.doc_id for r in found})


def test_licenses(hostile):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for r in licenses.scan_licenses(hostile.unionByName(hostile.limit(1).selectExpr(
        "999L AS doc_id", "'see the MIT. License! (GNU general-PUBLIC license v3)' AS text",
        *[f"`{c}`" for c in hostile.columns[2:]]
    ))).join(hostile.select("doc_id", "text"), "doc_id", "left").collect():
        text = r.text if r.doc_id != 999 else "see the MIT. License! (GNU general-PUBLIC license v3)"
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        if r.doc_id is None:
            continue
        places = {k: label for phrase, label in phrases.items() for k in range(len(words))
                  if words[k : k + len(phrase.split())] == phrase.split()}
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(set(places.values())))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_empty_tables(spark, empty):
    found = [
        bpe.encode_documents(empty, BYTE_BPE), line_dedup.dedup_lines(empty), quality.judge(empty, []),
        ngram_join.jaccard_components(empty), mixing.plan_mix(empty), sharding.shard_documents(empty),
        licenses.scan_licenses(empty), mixing.mix(empty), ngram_join.keep_one(empty),
    ]
    assert [df.count() for df in found] == [0] * len(found)
    path = token_files.write_token_files(empty, WORD_BPE, 2)
    assert token_files.read_token_files(spark, path).count() == 0
