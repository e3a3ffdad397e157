"""The pipeline and the queries without SQL on a small written fixture, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from test_edge_cases import BYTE_BPE, WORD, WORD_BPE, brute_components, lower, multiset, stats
from tokenizers import Tokenizer

import corpus_pipeline
from pharmavane.llm import mixing, queries
from pharmavane.session import shared_dir

SHARED = "this same line is in many documents of the fixture"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def fixture():
    """Documents ``id -> (text, source)``, and the ids of those that are bad."""
    rng = random.Random(11)
    docs, bad = {}, set()

    def words(n):
        return [rng.choice("abcdefgh") + str(rng.randrange(3000)) for _ in range(n)]

    for k in range(90):
        lines = [" ".join(words(40 + 4 * k)), rng.choice(["", SHARED, f"  {SHARED.upper()}\t", "short"]), " ".join(words(25))]
        docs[k] = "\n".join(lines), "abc"[k % 3]
    for k in range(90, 150):
        docs[k] = " ".join(w + "%#$" for w in words(50 + k)), "abc"[k % 3]
        bad.add(k)
    for k in range(150, 170):  # near copies, by one word, of documents before and of each other
        copied = docs[(k - 150) // 2 * 3][0].split(" ")
        copied[rng.randrange(30)] = f"new{k}"
        docs[k] = " ".join(copied) + f" {' '.join(words(k % 4))}", "c"
    docs[170], docs[171], docs[172] = ("too few words", "a"), ("", "b"), ("again and again " * 40, "b")
    docs[173] = docs[10][0] + " see the MIT. License! (GNU general-PUBLIC license v3) é 日本", "b"
    docs[174] = None, "a"
    return docs, bad


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    docs, bad = fixture()
    folder = str(tmp_path_factory.mktemp("chain"))
    rows = [(k, t, s, len(t or "")) for k, (t, s) in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k not in bad)) for k in docs if k % 5 or k in bad]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder, {k: (t or "", s) for k, (t, s) in docs.items()}, bad


def good(docs, bad):
    failed = {k: (c := stats(t))[0] < 20 or 100 * c[4] > 30 * c[0] for k, (t, _) in docs.items()}
    return failed, {k: d for k, d in docs.items() if not failed[k] and k not in bad}


def without_lines(docs):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))
    owner, out = {}, {}
    for k in sorted(docs):
        lines = docs[k][0].split("\n")
        for line in lines:
            owner.setdefault(key(line), k)
        out[k] = "\n".join(x for x in lines if len(key(x)) < 10 or owner[key(x)] == k), docs[k][1]
    return out


def without_copies(docs):
    found = brute_components([(k, t, s) for k, (t, s) in docs.items()])
    return {k: docs[k] for k, _, component in found if k == component}


def copies(docs):
    """How often the mix takes each document, and the targets; lengths are distinct, so no hash decides."""
    sizes = {k: len(WORD.findall(t)) for k, (t, _) in docs.items()}
    whole = Counter()
    for k, (_, source) in docs.items():
        whole[source] += sizes[k]
    weight = dict(zip(sorted(whole), (5, 2, 1)))
    target, left, open_ = dict.fromkeys(whole, 0.0), 1.5 * sum(whole.values()), set(whole)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - 2 * whole[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * whole[s]:
                target[s] = 2.0 * whole[s]
                open_.discard(s)
    times = {}
    for s in whole:
        own = sorted((k for k in docs if docs[k][1] == s and sizes[k]), key=sizes.get)
        assert len({sizes[k] for k in own}) == len(own)
        passes = int(round(target[s], 6) // whole[s])
        lengths = np.array([sizes[k] for k in own], np.int64)
        extra = mixing.fit_counts(lengths, np.ones(len(own), np.int64), round(target[s] - passes * whole[s]))
        times |= {k: passes + int(n) for k, n in zip(own, extra)}
    return times, sizes, whole, target


def encoded(k, text):
    model = Tokenizer.from_file(BYTE_BPE) if not hasattr(encoded, "model") else encoded.model
    encoded.model = model
    ids = model.encode(text, add_special_tokens=False).ids
    back = model.decode(ids, skip_special_tokens=False)
    return k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_pipeline_keeps_the_rows_of_a_plain_chain(spark, written, tmp_path):
    folder, docs, bad = written
    _, docs = good(docs, bad)
    n = [len(docs)]
    docs = without_lines(docs)
    n.append(sum("this same line" in lower(t) for t, _ in docs.values()))
    docs = without_copies(docs)
    n.append(len(docs))
    times, *_ = copies(docs)
    assert n[0] > n[2] and n[1] == 1 and {1, 2} <= set(times.values())
    expected = [encoded(k, docs[k][0]) for k, m in times.items() for _ in range(m)]
    there = {path for path in Path(shared_dir(spark)).rglob("*") if path.is_file()}
    corpus_pipeline.write(spark, folder, f"{tmp_path}/encoded")
    assert {path for path in Path(shared_dir(spark)).rglob("*") if path.is_file()} == there
    assert multiset(spark.read.parquet(f"{tmp_path}/encoded").collect()) == multiset(expected)


def test_queries_without_sql(spark, written):
    folder, docs, bad = written
    run = {name.split("_")[0]: query for name, query in queries.QUERIES.items()}
    texts = [(k, t, s) for k, (t, s) in docs.items()]
    assert multiset(run["op3"](spark, folder).collect()) == multiset(encoded(k, t) for k, t, _ in texts)
    assert multiset(run["op7"](spark, folder).collect()) == multiset(brute_components(texts))

    failed, kept = good(docs, bad)
    expected = [(k, *stats(t), failed[k], k in kept) for k, t, _ in texts]
    assert multiset(run["op5"](spark, folder).collect()) == multiset(expected)

    model, start = Tokenizer.from_file(WORD_BPE), 0
    for r in sorted(run["op8"](spark, folder).collect(), key=lambda r: r.start):
        ids = [*model.encode(docs[r.doc_id][0], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)

    slots, found = defaultdict(list), run["op9"](spark, folder).collect()
    assert multiset((r.doc_id, r.size, r.text_crc32) for r in found) == multiset(
        (k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t, _ in texts
    )
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    for r in run["op10"](spark, folder).collect():
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", lower(docs[r.doc_id][0]))
        at = {i: PHRASES[p] for p in PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()}
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(set(at.values()))))


def test_mixing_query(spark, written):
    folder, docs, _ = written
    sums, found = Counter(), queries.QUERIES["op1_mixing"](spark, folder).collect()
    sizes = {k: len(WORD.findall(t)) for k, (t, _) in docs.items()}
    whole = Counter()
    for k, (_, source) in docs.items():
        whole[source] += sizes[k]
    assert multiset((r.doc_id, r.size, r.source_size) for r in found) == multiset((k, sizes[k], whole[docs[k][1]]) for k in docs)
    for r in found:
        assert r.taken in (0, r.size, 2 * r.size)
        sums[docs[r.doc_id][1]] += r.taken
    target = {docs[r.doc_id][1]: r.target for r in found}
    assert abs(sum(target.values()) - 1.5 * sum(whole.values())) < 1e-6
    assert all(abs(sums[s] - target[s]) <= max(sizes.values()) for s in target)
