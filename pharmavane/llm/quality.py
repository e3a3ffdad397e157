"""Quality rules as a learned decision list.

Statistics of each text are columns. From a labelled sample of them, sequential
covering grows conjunctions of thresholds that single out bad documents, prunes
each on rows it was not grown on, and keeps it if it is still precise there. The
list becomes one ordered conditional expression over the statistics.

DataFrame operations only; the sample is bounded by ``max_rows``, so the covering
itself runs over a fixed number of rows, as bit sets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pharmavane.llm.common import carried, narrow, restored, words

WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _left(text: Column, pattern: str) -> Column:
    """The number of characters that remain without the runs of ``pattern``."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def with_statistics(texts: DataFrame) -> DataFrame:
    """Add the counts that rules speak of to ``doc_id, text`` (and ``rest``, if there).

    ``n_repeat_words`` counts words inside a window of eight words found twice or
    more in the text. Windows are compared by the hash of their words' hashes; the
    arrays are bound one step at a time, since a step looks up the one before it
    for each of its entries.
    """
    text, given = F.col("text"), texts.columns
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    found = texts.select(
        "*",
        F.transform(words(text), lambda w: F.xxhash64(w)).alias("_h"),
        lines.alias("_lines"),
        _left(text, "[ \\t-\\r]+").alias("word_chars"),
        _left(text, "[^#*$%&|<>]+").alias("n_symbols"),
        _left(text, "[^A-Z]+").alias("n_upper"),
        _left(text, "[^!?]+").alias("n_marks"),
    )
    size = F.size("_h")
    whole = F.transform("_h", lambda h, i: F.xxhash64(h, *[F.get("_h", i + k) for k in range(1, WINDOW)]))
    found = found.select(
        *given, "word_chars", "n_symbols", "n_upper", "n_marks",
        size.cast("long").alias("n_words"),
        F.size(F.array_distinct("_h")).cast("long").alias("n_distinct"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(size >= WINDOW, F.slice(whole, 1, F.greatest(size - WINDOW + 1, F.lit(0)))).alias("_w"),
    )
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    by_hash = F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = found.withColumn("_s", F.when(repeats, by_hash)).drop("_w")
    twice = F.filter(
        F.transform("_s", lambda e, k: F.when(
            F.coalesce(F.get("_s", k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get("_s", k + 1)["h"] == e["h"], F.lit(False)), e["i"])),
        lambda i: i.isNotNull(),
    )
    found = found.withColumn("_at", F.sort_array(twice)).drop("_s")
    steps = F.zip_with(
        "_at", F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(0))),
        lambda at, after: F.least(F.coalesce(after - at, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda a, b: a + b), F.lit(0))
    # Always true, but not known before the rows are: a filter on the counts then stays
    # above them, where pushed down it would compute each step anew for every entry.
    bound = F.when(F.monotonically_increasing_id() >= 0, covered)
    return found.withColumn("n_repeat_words", bound.cast("long")).drop("_at")


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _share(count: str, of: str) -> Column:
    return F.col(count) / F.greatest(F.col(of), F.lit(1))


def features() -> dict[str, Column]:
    """What thresholds are set on."""
    return {
        "words": F.col("n_words").cast("double"),
        "symbols_per_word": _share("n_symbols", "n_words"),
        "marks_per_word": _share("n_marks", "n_words"),
        "upper_share": _share("n_upper", "word_chars"),
        "chars_per_word": _share("word_chars", "n_words"),
        "distinct_share": _share("n_distinct", "n_words"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "words_per_line": _share("n_words", "n_lines"),
    }


class Condition(NamedTuple):
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


class Rule(NamedTuple):
    conditions: tuple[Condition, ...]
    good: int  # of the rows held back, those it would reject
    bad: int

    def column(self) -> Column:
        whole = F.lit(True)
        for condition in self.conditions:
            whole = whole & condition.column()
        return whole


def verdict(rules: list[Rule]) -> Column:
    """The decision list: the first rule that holds rejects, the default keeps."""
    decided = F.when(F.lit(False), F.lit(True))
    for rule in rules:
        decided = decided.when(rule.column(), F.lit(False))
    return decided.otherwise(F.lit(True))


def _bits(flags: Sequence[bool]) -> int:
    return int.from_bytes(np.packbits(np.asarray(flags, bool), bitorder="little").tobytes(), "little")


def _flags(bits: int, n: int) -> np.ndarray:
    packed = np.frombuffer(bits.to_bytes(-(-n // 8), "little"), np.uint8)
    return np.unpackbits(packed, count=n, bitorder="little").astype(bool)


def _candidates(table: dict[str, np.ndarray], cuts: int, among: int | None = None) -> dict[Condition, int]:
    """Threshold conditions and the set of rows where each holds.

    Thresholds lie midway between the neighbouring values at ``cuts`` quantiles; at
    those of the rows ``among`` only, if given, on either side of the value.
    """
    found = {}
    for name, values in table.items():
        order = np.unique(values)
        ranked = np.sort(values if among is None else values[_flags(among, len(values))])
        picks = ranked[[len(ranked) * k // cuts for k in range(among is None, cuts)]]
        after = np.searchsorted(order, picks, "right")
        if among is None:
            after = np.append(after, 1)
        else:
            greatest = np.searchsorted(order, ranked[-1])
            after = np.concatenate([after, np.searchsorted(order, picks), [greatest, greatest + 1]])
        for k in np.unique(after[(after > 0) & (after < len(order))]):
            threshold = float((order[k - 1] + order[k]) / 2)
            above = _bits(values > threshold)
            found[Condition(name, True, threshold)] = above
            found[Condition(name, False, threshold)] = ((1 << len(values)) - 1) & ~above
    return found


def learn(
    table: dict[str, list[float]], bad: list[bool], held_back: list[bool],
    max_conditions: int = 4, max_rules: int | None = None, precision: float = 0.97, cuts: int = 40,
) -> list[Rule]:
    """Sequential covering over columns of statistics.

    A rule grows by information gain on the rows not held back until it covers no
    good one, loses its last conditions while that helps on the rows held back, and
    is taken if its smoothed precision over all rows left is at least
    ``precision`` and no held back row speaks against it as clearly. Covered
    rows are then removed. Thresholds lie at quantiles of all rows and of the bad ones
    not covered yet, so that a kind of few rows has its own.

    The bad rows of a refused rule, as grown, are set aside, and no rule grows on them again; they
    count in what is measured. The more rules were refused, the more bad rows held back
    must speak for one, so that trying often does not let one in by chance. The end is
    when no bad row is left to grow on; every turn covers or sets aside at least one, so
    there is an end. ``max_rules`` ends it sooner, for a short list. ``max_conditions`` keeps
    a rule readable: one that covers good rows with as many is pruned and judged as it is.
    """
    if not any(bad) or all(bad):
        return []
    columns = {name: np.asarray(values, float) for name, values in table.items()}
    common = _candidates(columns, cuts)
    wrong, back = _bits(bad), _bits(held_back)
    left = (1 << len(bad)) - 1
    aside, refused = 0, 0  # bad rows of refused rules, and how many these were
    rules: list[Rule] = []
    while (max_rules is None or len(rules) < max_rules) and left & wrong & ~back & ~aside:
        candidates = common | _candidates(columns, cuts, left & wrong & ~aside)
        grow, prune = left & ~back & ~aside, left & back
        chosen, covered = [], grow
        while len(chosen) < max_conditions and covered & ~wrong:
            p, n = (covered & wrong).bit_count(), (covered & ~wrong).bit_count()
            if not p:
                break
            before, best = math.log2(p / (p + n)), (1e-9, None, 0)
            for condition, rows in candidates.items():
                q = (covered & rows & wrong).bit_count()
                if q:
                    m = (covered & rows & ~wrong).bit_count()
                    gain = q * (math.log2(q / (q + m)) - before)
                    if gain > best[0]:
                        best = gain, condition, rows
            if best[1] is None:
                break
            chosen.append(best[1])
            covered &= best[2]
        if not chosen:
            break

        def score(k: int) -> float:
            rows = prune
            for condition in chosen[:k]:
                rows &= candidates[condition]
            p, n = (rows & wrong).bit_count(), (rows & ~wrong).bit_count()
            return (p - n) / (p + n) if p + n else -1.0

        size = max(range(1, len(chosen) + 1), key=lambda k: (score(k), -k))
        whole = left
        for condition in chosen[:size]:
            whole &= candidates[condition]
        p, n = (whole & wrong).bit_count(), (whole & ~wrong).bit_count()
        p_back, n_back = (whole & prune & wrong).bit_count(), (whole & prune & ~wrong).bit_count()
        share = (prune & wrong).bit_count() / max(1, prune.bit_count())
        by_chance = refused and (refused + 1) * share**p_back > 1 - precision
        if (p + 1) / (p + n + 2) < precision and n or p < 3 or n_back > (1 - precision) * (p_back + n_back) or by_chance:
            for condition in chosen[size:]:
                whole &= candidates[condition]
            aside |= whole & wrong
            refused += 1
            continue
        rules.append(Rule(tuple(chosen[:size]), n_back, p_back))
        left &= ~whole
        if not left & wrong:
            break
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Features of at most ``max_rows`` labelled documents that pass the base.

    Those with the smallest hashes of their ids are taken, alike in every run. A
    document that is labelled both ways counts as good; null labels do not count.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality"))
    known = known.dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.withColumn("_order", F.xxhash64("doc_id", F.lit(7))).orderBy("_order", "doc_id").limit(max_rows)
    texts = narrow(docs, id_col, text_col)
    # At most max_rows rows of two numbers.
    texts = texts.join(F.broadcast(known), "doc_id")
    found = with_statistics(texts.select("doc_id", "text")).filter(~base_failed())
    shown = found.select("doc_id", *[column.alias(name) for name, column in features().items()])
    return shown.join(F.broadcast(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """The decision list of a labelled sample; no labels, or one class alone, give none."""
    rows = labelled_statistics(docs, labels, max_rows, id_col, text_col)
    # Bounded by max_rows, a few numbers each; repeated ids beyond it are cut alike.
    rows = rows.dropDuplicates(["doc_id"]).orderBy("_order").limit(max_rows).collect()
    table = {name: [row[name] for row in rows] for name in features()}
    return learn(table, [row["quality"] == 0 for row in rows], [row["_order"] % 3 == 0 for row in rows])


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, text, counts, ``base_failed`` and ``kept`` of every document.

    A null or empty text has no words and fails the base. Null and repeated ids are
    judged row by row; other columns are left out. One pass without a shuffle.
    """
    found = with_statistics(narrow(docs, id_col, text_col)).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules))
    return found.select("doc_id", "text", *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; null text becomes empty."""
    found = with_statistics(carried(docs, id_col, text_col))
    kept = found.filter(~base_failed() & verdict(rules))
    return restored(kept, docs.columns, id_col, text_col)
