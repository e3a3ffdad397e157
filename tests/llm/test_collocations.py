"""Phrase collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from pharmavane.llm import collocations


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]+", lower(text)):
        words = re.findall("[^\x20\x09]+", piece)
        if words:
            yield words


def phrases(rows):
    counts, whole = Counter(), Counter()
    for lang, text in rows:
        for words in pieces(text or ""):
            whole[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang or "und", tuple(words[i : i + n])] += 1
    return counts, whole


def brute(rows, least, top, covered):
    counts, whole = phrases(rows)
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    ranked = {}
    for (lang, words), a in found.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= covered * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in found.items()
        )
        if inside:
            continue
        score, _, left, right = min(
            (2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]])
            for k in range(1, len(words))
        )
        ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, whole[lang], -score)
        for lang, rows_ in ranked.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1)
    }


def written(seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "São", "paulo", "x y", "a\x1cb", "日本", "–", "rare"]
    ends = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "!? ", " . . "]
    rows = []
    for k in range(120):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(1, 60)))
        rows.append((rng.choice(["en", "de", None]), text))
    passage = "new york city of the rare new york is one city of many. and " * 8
    rows += [("en", passage)] * 40 + [("en", f"start {k} {passage}") for k in range(20)]
    rows += [("en", None), ("en", ""), (None, " .,; \n\t "), ("en", "same " * 3000), ("fr", "une")]
    rows += [("en", " ".join(f"u{k}" for k in range(9000)))]
    return rows


@pytest.mark.parametrize("least, trigger, bits", [(5, 24, 1 << 28), (5, 2, 1 << 10), (30, 10**6, 1 << 10), (1, 5, 1 << 12)])
def test_collocations(spark, least, trigger, bits):
    rows = written() if least > 1 else written()[:40]
    docs = spark.createDataFrame([(lang, text, 1, "c", 2) for lang, text in rows], "lang string, text string, freq int, chunk string, rank int")
    found = collocations.collocations(docs.repartition(3), least, 50, 80, trigger, bits)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows_found = [tuple(r) for r in found.collect()]
    assert len(rows_found) == len(set(rows_found)) and set(rows_found) == brute(rows, least, 50, 80)


def test_chunks_cover_a_text_once():
    texts = [(text or "").encode() for _, text in written()]
    for trigger, longest in ((3, 4096), (10**9, 7)):
        of, cut = collocations.chunks(texts, trigger, longest)
        joined = {k: [] for k in range(len(texts))}
        for k, chunk in zip(of.tolist(), cut.to_pylist()):
            symbols = chunk.split(" ")
            held = joined[k]
            assert not held or held[-3:] == symbols[:3]
            held += symbols[3 if held else 0 :]
            assert len(symbols) > 3 and (longest > 7 or len(symbols) <= 10)
        for text, held in zip(texts, joined.values()):
            expected = [" ".join(words) for words in pieces(text.decode())]
            assert held == ([*" . ".join(expected).split(" "), ".", ".", "."] if expected else [])


def test_equal_passages_share_chunks(spark):
    passage = " ".join(f"word{k}" for k in range(400))
    docs = spark.createDataFrame([("en", f"{k} other {k} words before {passage} and {k} after") for k in range(50)], "lang string, text string")
    freq = [r.freq for r in collocations.parse(docs).collect()]
    assert sum(f >= 50 for f in freq) >= 8  # the inner chunks of the passage are said once each


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).collect() == []


def test_large_counts_are_exact(spark):
    """Products of these counts pass 64 bits."""
    big = 9_000_000_000_000_000
    dictionary = spark.createDataFrame(
        [("en", "a b c . . .", big), ("en", "a b . . .", 1), ("en", "c . . .", 3)], "lang string, chunk string, freq long"
    )
    counts = {(r.phrase): r.f for r in collocations.count_phrases(dictionary, 1).collect()}
    assert counts == {"": 3 * big + 5, "a": big + 1, "b": big + 1, "c": big + 3, "a b": big + 1, "b c": big, "a b c": big}
