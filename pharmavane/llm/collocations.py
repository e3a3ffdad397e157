"""Phrase collocations by prefix-free parsing.

A document is a stream of symbols: its words, and one mark where a piece ends. A
window of three symbols whose hash falls on a trigger ends a chunk and opens the
next, so chunks overlap by that window, and equal passages are cut alike wherever
they stand. Equal chunks collapse into a dictionary with the frequency of each in
the parse. Phrases are counted once inside each distinct chunk and weighted by its
frequency; one that starts in the closing window belongs to the next chunk, so
overlaps count once. The stream ends with a window of marks, where no phrase starts.

Phrases are counted level by level: a phrase can reach the least count only if its
words (then its pairs of words) do, and a bit filter of fixed largest size tells
which do. It lets false ones through, never the reverse, so counts are exact at any
filter size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pharmavane.llm.common import staged
from pharmavane.llm.shingles import scramble

LONGEST = 4  # words of a phrase
OVERLAP = LONGEST - 1  # symbols that neighbouring chunks share
TRIGGER = 24  # one window in so many ends a chunk
LONGEST_CHUNK = 4096  # symbols after which a chunk ends without a trigger
PARSE_BYTES = 8 << 20  # text that a task cuts at a time; a longer one alone
GROUP_BYTES = 12 << 20  # text of chunks that a task counts at a time
REMEMBERED = 1 << 20  # words that a task knows at most
FILTER_BITS = 1 << 28  # largest filter, 32 MB
MARK = b"."  # one of the ends of pieces, so no word holds it

# Fixed by the contract: A-Z lower-cased, tab as blank, the ends of pieces.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_SYMBOLS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + MARK * len(_ENDS))


class _Hashes(dict):
    """64-bit hashes of the words met."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = _hash(word)
        return found

    def of(self, names: pa.Array) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, names.cast(pa.large_binary()).to_pylist()), np.uint64, len(names))


def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _numbered(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of all entries, the entries that the numbers stand for, and the length of each list."""
    entries = lists.flatten().dictionary_encode()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return entries.indices.to_numpy(zero_copy_only=False).astype(np.int64), entries.dictionary, sizes


def streams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The symbols of some texts one after the other, the text of each, and what they stand for.

    A text gives its words, a mark after each piece, and marks that fill the last window;
    one without words gives nothing. Symbol 0 is the mark.
    """
    offsets = np.cumsum([0, *map(len, texts)])
    data = b"".join(texts).translate(_SYMBOLS)
    said = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
    ids, names, sizes = _numbered(pc.ascii_split_whitespace(pc.replace_substring(said, MARK.decode(), f" {MARK.decode()} ")))
    names = pa.concat_arrays([pa.array([MARK.decode()], pa.large_string()), names])
    text, ids = np.repeat(np.arange(len(texts)), sizes), ids + 1
    for extra in (MARK.decode(), ""):
        at = pc.index(names.slice(1), extra).as_py() + 1
        if at and extra:
            ids[ids == at] = 0
        elif at:
            ids, text = ids[ids != at], text[ids != at]
    mark = ids == 0
    after = np.ones(len(ids), bool)  # a mark before, or no symbol
    after[1:] = mark[:-1] | (text[1:] != text[:-1])
    ids, text = ids[~(mark & after)], text[~(mark & after)]
    last = np.ones(len(ids), bool)
    last[:-1] = text[1:] != text[:-1]
    ids, text = ids[(ids != 0) | ~last], text[(ids != 0) | ~last]
    counts = np.bincount(text, minlength=len(texts))
    filled = np.where(counts > 0, counts + OVERLAP, 0)
    symbols = np.zeros(int(filled.sum()), np.int64)
    shift = np.cumsum(filled) - filled - (np.cumsum(counts) - counts)
    symbols[np.arange(len(ids)) + shift[text]] = ids
    return symbols, np.repeat(np.arange(len(texts)), filled), names


def chunks(texts: list[bytes], trigger: int = TRIGGER, longest: int = LONGEST_CHUNK) -> tuple[np.ndarray, pa.Array]:
    """The chunks of some texts, each as its symbols joined by blanks, and the text of each."""
    symbols, text, names = streams(texts)
    if not len(symbols):
        return np.empty(0, np.int64), pa.array([], pa.string())
    hashes = np.fromiter(map(zlib.crc32, names.cast(pa.large_binary()).to_pylist()), np.uint64, len(names))[symbols]
    state = hashes[: len(hashes) - OVERLAP + 1]
    for k in range(1, OVERLAP):
        state = scramble(state) ^ hashes[k : len(hashes) - OVERLAP + 1 + k]
    opens = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    ends = np.append(opens[1:], len(symbols)) - OVERLAP  # where the last window of each text starts
    cut = np.zeros(len(symbols), bool)
    cut[: len(state)] = scramble(state) % np.uint64(trigger) == 0
    for k in range(OVERLAP):
        cut[ends + k] = False
    cut[opens] = True
    starts = np.flatnonzero(cut)
    of = np.searchsorted(opens, starts, "right") - 1
    stops = np.minimum(np.append(starts[1:], len(symbols)), ends[of])
    long = np.flatnonzero(stops - starts > longest)
    if len(long):
        more = np.concatenate([np.arange(starts[k] + longest, stops[k], longest) for k in long])
        starts = np.sort(np.concatenate([starts, more]))
        of = np.searchsorted(opens, starts, "right") - 1
        stops = np.minimum(np.append(starts[1:], len(symbols)), ends[of])
    sizes = stops - starts + OVERLAP
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), names.take(pa.array(symbols[places])))
    return text[starts], pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """``lang, chunk, freq``: the distinct chunks of all texts, and how often each is parsed."""
    rows = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sizes = np.cumsum([len(text) for text in texts])
            starts = [0, *(np.flatnonzero(np.diff(sizes // PARSE_BYTES)) + 1).tolist(), len(texts)]
            for start, stop in zip(starts, starts[1:]):
                of, cut = chunks(texts[start:stop], trigger)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of + start)), cut], ["lang", "chunk"])

    return rows.mapInArrow(run, "lang string, chunk string").groupBy("lang", "chunk").agg(F.count("*").alias("freq"))


def _slots(of_words: list[np.ndarray], bits: int) -> np.ndarray:
    """The filter's bit for phrases, given the hash of each of their words in order."""
    state = np.full(len(of_words[0]), len(of_words), np.uint64)
    for found in of_words:
        state = scramble(state ^ found)
    return (state & np.uint64(bits - 1)).astype(np.int64)


class _Filter:
    """Which phrases of a length may reach the least count, in one language or another."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, 8 * len(bits)

    def has(self, of_words: list[np.ndarray]) -> np.ndarray:
        slot = _slots(of_words, self.size)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def _filter(frequent: DataFrame, largest: int) -> Broadcast:
    """The filter of all ``lang, phrase`` rows: its size follows their number up to ``largest`` bits."""
    spark = frequent.sparkSession
    size, wanted = 1 << 10, 16 * frequent.count()
    while size < min(largest, wanted):
        size *= 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([_hash(x.encode()) for x in batch.column(0).to_pylist()], np.uint64)
            words = [[_hash(w) for w in p.split(b" ")] for p in batch.column(1).cast(pa.binary()).to_pylist()]
            if words:
                slot = _slots([langs, *np.array(words, np.uint64).T], size)
                yield pa.RecordBatch.from_arrays([pa.array(slot >> 3), pa.array(1 << (slot & 7))], ["at", "bit"])

    hit = frequent.select("lang", "phrase").mapInArrow(run, "at long, bit long")
    # At most one row for each byte of the filter, whatever the number of phrases.
    found = hit.groupBy("at").agg(F.bit_or("bit").cast("short").alias("byte")).toArrow()
    bits = np.zeros(size // 8, np.uint8)
    bits[found.column("at").to_numpy()] = found.column("byte").to_numpy()
    return spark.sparkContext.broadcast(bits)


def _totals(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their total weights."""
    order = np.argsort(codes)
    codes = codes[order]
    starts = _starts(codes)
    return codes[starts], np.add.reduceat(weights[order], starts)


def _starts(ordered: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _phrases(ids: np.ndarray, at: np.ndarray, n: int, names: int, weights: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The words of the distinct phrases of ``n`` words that start ``at`` places, and their weights.

    Phrases of chunks that are parsed once, nearly all, are counted by a plain sort. While
    numbers of ``n`` words fit 63 bits they are packed into one; else each word is appended to
    the rank of the words before.
    """
    used = np.zeros(names, bool)
    for k in range(n):
        used[ids[at + k]] = True
    back = np.flatnonzero(used)
    compact = np.cumsum(used) - 1
    base = len(back)
    tails = []  # words before the last, where a rank stands for them
    code, span = compact[ids[at]], base
    for k in range(1, n):
        if span * base >= 1 << 63:
            known, code = np.unique(code, return_inverse=True)
            tails.append((k, known))
            span = len(known)
        code, span = code * base + compact[ids[at + k]], span * base
    once = weights == 1
    plain = np.sort(code[once])
    starts = _starts(plain)
    found = [(plain[starts], np.diff([*starts, len(plain)]))] if len(plain) else []
    if not once.all():
        found.append(_totals(code[~once], weights[~once]))
    for codes, total in found:
        columns: list[np.ndarray] = []
        ranks = [*tails]
        for k in range(n - 1, 0, -1):
            codes, last = np.divmod(codes, base)
            columns.insert(0, back[last])
            if ranks and ranks[-1][0] == k:
                codes = ranks.pop()[1][codes]
        yield [back[codes], *columns], total


def _count(dictionary: DataFrame, lengths: tuple[int, ...], known: Broadcast | None) -> DataFrame:
    """``lang, phrase, f`` of phrases of these lengths whose parts the filter of the level before has.

    ``known`` filters the words of pairs, and the pairs of longer phrases; the first level
    has none, and also counts all words of a language, under the empty phrase.
    """
    part_words = max(1, min(lengths) - 1)

    def count_group(lang: str, texts: pa.Array, freq: np.ndarray, known_hashes: _Hashes) -> Iterator[pa.RecordBatch]:
        ids, names, sizes = _numbered(pc.split_pattern(texts, " "))
        words = ids != pc.index(names, MARK.decode()).as_py()
        ends = np.cumsum(sizes)
        owned = np.ones(len(ids), bool)  # the closing window is the next chunk's
        for k in range(1, OVERLAP + 1):
            owned[ends - k] = False
        weight = np.repeat(freq, sizes)

        def emit(columns: list[np.ndarray], total: np.ndarray) -> pa.RecordBatch:
            taken = [names.take(pa.array(c)) for c in columns]
            phrase = pc.binary_join_element_wise(*taken, pa.scalar(" ", pa.large_string())) if len(taken) > 1 else taken[0]
            named = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(total), np.int32)))
            return pa.RecordBatch.from_arrays([named, phrase.cast(pa.string()), pa.array(total, pa.int64())], ["lang", "phrase", "f"])

        if lengths == (1,):
            start = words & owned
            total = int(weight[start].sum())
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([""]), pa.array([total])], ["lang", "phrase", "f"])
        else:
            hashes, filter_ = known_hashes.of(names), _Filter(known.value)
            of_lang = np.uint64(_hash(lang.encode()))
            whole = words.copy()
            for k in range(1, part_words):
                whole[:-k] &= words[k:]
                whole[-k:] = False
            at = np.flatnonzero(whole)
            start = np.zeros(len(ids), bool)  # where a part starts that may be frequent
            start[at] = filter_.has([np.full(len(at), of_lang), *[hashes[ids[at + k]] for k in range(part_words)]])
        parts = start
        for n in lengths:
            start = parts & owned
            for k in range(1, n - part_words + 1):
                start[:-k] &= parts[k:]
                start[-k:] = False
            at = np.flatnonzero(start)
            if len(at):
                for columns, total in _phrases(ids, at, n, len(names), weight[at]):
                    yield emit(columns, total)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = _Hashes(), [], 0

        def groups() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            for lang in pc.unique(table.column("lang")).to_pylist():
                own = table.filter(pc.equal(table.column("lang"), lang))
                chunk = own.column("chunk").cast(pa.large_string()).combine_chunks()
                yield from count_group(lang, chunk, own.column("freq").to_numpy(), hashes)

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                yield from groups()
                held, size = [], 0
        if size:
            yield from groups()

    return dictionary.select("lang", "chunk", "freq").mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(
        F.sum("f").alias("f")
    )


def count_phrases(
    dictionary: DataFrame, least: int, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """``lang, phrase, m, f``: phrases of ``m`` = 1 to 4 words that occur ``least`` times or more.

    The row of the empty phrase (``m`` = 0) has the number of all words of a language.
    """
    if not 1 <= filter_bits <= 1 << 32 or filter_bits & (filter_bits - 1):
        raise ValueError("the filter's size is a power of two")
    levels, known = [], None
    for lengths in ((1,), (2,), (3, 4)):
        counted = _count(dictionary, lengths, known)
        m = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1)
        levels.append(staged(counted.filter(f"f >= {least} OR phrase = ''").withColumn("m", m.cast("int")), "phrases"))
        if 4 not in lengths:
            known = _filter(levels[-1].filter("m > 0"), max(filter_bits, 1 << 10))
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, trigger: int = TRIGGER,
    filter_bits: int = FILTER_BITS, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to 4 words of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut that scores lowest
    (the first of equals), ``n`` all words of the language; ``score`` is the whole part of
    2,000,000 ``a / (l + r)``. Phrases with ``a`` below ``least`` are no candidates. One
    whose words stand within a longer candidate of at least ``covered`` per cent of its
    count is left out. Sums of counts are kept in 64 bits, products in 38 digits.

    Null texts are empty, a null language is ``und``; repeated rows count each; other
    columns are left out; an empty table gives no rows.
    """
    dictionary = staged(parse(docs, text_col, lang_col, trigger), "chunks")
    counts = staged(count_phrases(dictionary, least, filter_bits), "counts")
    whole = counts.filter("m = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("m > 0")
    candidates = phrases.filter("m > 1").select("lang", "phrase", "m", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    cut = candidates.select("lang", "phrase", "a", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cut = cut.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
    cut = cut.withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("m") - F.col("k")), " "))
    for side, name in (("left", "l"), ("right", "r")):
        part = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cut = cut.join(part, ["lang", side])
    score = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best")
    )

    # Every shorter candidate inside a longer one, with the largest count of those around it.
    around = candidates.filter("m > 2").select("lang", "phrase", "a", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("w"))
    around = around.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("w") + 1)).alias("at"))
    inner = around.select("lang", F.array_join(F.slice(words, F.col("at"), F.col("w")), " ").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))

    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        f"longer IS NULL OR CAST(longer AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {int(covered)}"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(whole, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"),
    )
