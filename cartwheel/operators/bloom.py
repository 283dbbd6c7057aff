"""Leaving out rows whose key is surely not in a set, before they are shuffled.

A Bloom filter in blocks of 64 bits: a key sets three bits of one word. The words that have a bit
are a small table, bounded whatever the number of keys, that is broadcast and looked up by the
number of the word. No key of the set is lost; of the others a few pass, more of them when
the keys are many for the words, so an exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the most words of a filter (16 bytes each).
BITS_PER_KEY = 12
MOST_WORDS = 1 << 20


def _word_and_mask(key: Column, words: int) -> tuple[Column, Column]:
    """The word of a key, and the three bits it sets there."""
    first, second = F.xxhash64(key), F.xxhash64(F.lit("bits"), key)

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return F.pmod(first, F.lit(words)), bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))


def words_for(keys: int) -> int:
    """Words of a filter for so many keys: a power of two, at most :data:`MOST_WORDS`."""
    wanted = max(1, keys * BITS_PER_KEY // 64)
    return min(MOST_WORDS, 1 << (wanted - 1).bit_length())


def key_filter(keys: DataFrame, column: str, words: int) -> DataFrame:
    """word and bits: the filter for the values of a column. Added up in each task first."""
    word, mask = _word_and_mask(F.col(column), words)
    return keys.where(F.col(column).isNotNull()).select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(
        F.bit_or("mask").alias("bits"))


def may_match(rows: DataFrame, column: str, bits: DataFrame, words: int) -> DataFrame:
    """The rows whose key may be in the set of ``bits``; a NULL key is in none. Columns stay."""
    word, mask = _word_and_mask(F.col(f"r.`{column}`"), words)
    met = (word == F.col("b.word")) & (F.col("b.bits").bitwiseAND(mask) == mask)
    return rows.alias("r").join(F.broadcast(bits).alias("b"), met, "left_semi").where(F.col(column).isNotNull())
