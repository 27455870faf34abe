"""A Bloom filter as a small table: most rows need not be shuffled to a large list.

The filter has a fixed number of words of 64 bits, whatever the length of the list. A key sets a
few bits of one word. The words are a table, so they are built by one aggregation, are broadcast
within a known bound and are looked up by a hash join in generated code: no Python, no collect.

Bits are never missing, so a row whose bits are not all set is not in the list. A row whose bits
happen to be set goes the long way and finds out there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 4
# A row of the broadcast table is a number and a word; 65,536 of them are a few megabytes.
WORDS = 1 << 16
MOST_WORDS = 1 << 20
_WORD, _BITS, _LIKELY = "_filter_word", "_filter_bits", "_likely"


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a key in its word: six bits of another hash each."""
    spread = F.xxhash64(key, F.lit(1))
    places = [
        F.shiftright(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BITS_PER_KEY)
    ]
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    return reduce(Column.bitwiseOR, bits)


def filter_words(listed: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """The filter over a column of a list: at most ``words`` rows. Null keys are left out."""
    if not 0 < words <= MOST_WORDS:
        raise ValueError(f"a filter has from 1 to {MOST_WORDS} words")
    keyed = listed.filter(F.col(key).isNotNull()).select(
        _word(F.col(key), words).alias(_WORD), _mask(F.col(key)).alias(_BITS)
    )
    return keyed.groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS))


def split_likely(
    rows: DataFrame, filtered: DataFrame, key: str, words: int = WORDS
) -> tuple[DataFrame, DataFrame]:
    """Rows that may be in the list, and rows that cannot be. Null keys cannot."""
    marked = rows.withColumn(_WORD, _word(F.col(key), words)).join(
        F.broadcast(filtered), _WORD, "left"
    )
    mask = _mask(F.col(key))
    likely = F.coalesce(F.col(_BITS).bitwiseAND(mask) == mask, F.lit(False)) & F.col(key).isNotNull()
    marked = marked.withColumn(_LIKELY, likely)
    hidden = (_WORD, _BITS, _LIKELY)
    return (
        marked.filter(F.col(_LIKELY)).drop(*hidden),
        marked.filter(~F.col(_LIKELY)).drop(*hidden),
    )
