"""A Bloom filter of a key set, as columns.

Every key sets ``BITS`` bits of one 64-bit word; the words of a key set are a
small table that is broadcast. A row whose bits are not all set in its word
cannot be among the keys, so a scan drops it before any exchange; rows that
pass still meet the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^19 words of 16 bytes: a broadcast of 8 MB, whatever the number of keys. Of
# ten million keys it lets a quarter of the other rows through, of a million one in a thousand.
WORDS = 1 << 19
BITS = 3


def _word(cols: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(words))


def _mask(cols: list[str]) -> Column:
    """``BITS`` bits chosen by a hash independent of the word's."""
    h = F.xxhash64(*cols, F.lit("bits"))
    out = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def build(keys: DataFrame, cols: list[str], words: int = WORDS) -> DataFrame:
    """(_word, _bits) of the key set, combined map-side; at most ``words`` rows."""
    return keys.groupBy(_word(cols, words).alias("_word")).agg(F.bit_or(_mask(cols)).alias("_bits"))


def marked(rows: DataFrame, keys: DataFrame, cols: list[str], words: int = WORDS) -> DataFrame:
    """``rows`` with ``_maybe``: false where the key is certainly not in ``keys``."""
    tagged = rows.withColumn("_word", _word(cols, words)).withColumn("_mask", _mask(cols))
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
    return (tagged.join(F.broadcast(build(keys, cols, words)), "_word", "left")
            .withColumn("_maybe", hit).drop("_word", "_mask", "_bits"))
