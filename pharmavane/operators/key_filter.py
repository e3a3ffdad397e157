"""A Bloom filter of join keys as a small table, so that a join need not shuffle what cannot match.

The filter is an array of 64-bit words. A key sets a few bits of one word; words are
built by an aggregation, which combines before its shuffle, and kept in blocks. A row is
tested by a broadcast join with its block, within compiled code. The filter is never
larger than ``MAX_WORDS`` words, 32 MB, so it may be broadcast. It lets some keys pass
that are not there and stops none that is: an exact join of the rest must follow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fewer keys are left to the planner, which broadcasts the keys themselves.
FILTER_FROM = 1_000_000
MAX_WORDS = 1 << 22
BLOCK_WORDS = 512
KEYS_PER_WORD = 4  # 16 bits a key: about 2 keys of 100 pass wrongly
MOST_PER_WORD = 16  # 4 bits a key; with fewer most rows would pass


@dataclass(frozen=True)
class KeyFilter:
    blocks: DataFrame  # _filter_block, _filter_words
    n_words: int
    n_bits: int  # set by one key

    def word(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n_words)).cast("int")

    def mask(self, key: str) -> Column:
        """A word with the bits of one key, from a second hash."""
        hashed = F.xxhash64(F.lit(1), key)
        mask = F.lit(0).cast("long")
        for k in range(self.n_bits):
            place = F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
        return mask

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with a column ``name``: false where the key is surely not there, or null.

        The rows stay where they are; nothing but the filter is sent.
        """
        at = self.word(key)
        marked = rows.withColumn("_filter_block", F.floor(at / BLOCK_WORDS).cast("int"))
        marked = marked.join(F.broadcast(self.blocks), "_filter_block")
        held = F.get("_filter_words", at % BLOCK_WORDS).bitwiseAND(self.mask(key)) == self.mask(key)
        marked = marked.withColumn(name, held & F.col(key).isNotNull())
        return marked.drop("_filter_block", "_filter_words")


def build(keys: DataFrame, key: str, filter_from: int = FILTER_FROM, max_words: int = MAX_WORDS) -> KeyFilter | None:
    """The filter of a column; None where it would not pay.

    That is below ``filter_from`` distinct keys, and above ``MOST_PER_WORD`` times
    ``max_words`` (67 million by default), which a filter of bounded size cannot tell apart.
    Null keys are in no filter.
    """
    keys = keys.select(key).filter(F.col(key).isNotNull())
    found = keys.agg(F.approx_count_distinct(key)).first()[0]
    if found < filter_from or found > MOST_PER_WORD * max_words:
        return None
    n_words = min(max_words, max(1, found // KEYS_PER_WORD))
    n_words = -(-n_words // BLOCK_WORDS) * BLOCK_WORDS
    made = KeyFilter(keys, n_words, 4 if found <= 2 * KEYS_PER_WORD * n_words else 2)
    bits = keys.select(made.word(key).alias("word"), made.mask(key).alias("bits"))
    # One empty word for each place, so that the blocks have no gaps.
    places = keys.sparkSession.range(n_words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(places).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    blocks = words.groupBy(F.floor(F.col("word") / BLOCK_WORDS).cast("int").alias("_filter_block")).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("_filter_words")
    )
    return KeyFilter(blocks, n_words, made.n_bits)
