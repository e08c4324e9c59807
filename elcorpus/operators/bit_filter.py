"""A bounded filter of wanted keys, applied before anything is shuffled.

The keys' hashes set bits in at most ``2**WORD_BITS`` words of 64 bits
(PROBES bits of one word a key).  That table is broadcast - its size does not
depend on the number of keys - and rows whose bits are not all set are
dropped where they are read.  No wanted row is ever dropped; of the others
some pass, the more the fuller the filter is, and the join that follows
decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 18
PROBES = 3


def _word(key: Column, word_bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << word_bits)).cast("int")


def _mask(key: str) -> Column:
    """The key's bits within its word."""
    places = " | ".join(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({key}, 'bits'), {6 * i}), 64L) as int))" for i in range(PROBES))
    return F.expr(places)


def bit_words(keys: DataFrame, key: str, word_bits: int = WORD_BITS) -> DataFrame:
    """(word, set_bits): the filter of the column ``key``, at most
    ``2**word_bits`` rows."""
    rows = keys.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull())
    return rows.select(_word(F.col("_k"), word_bits).alias("_word"), _mask("_k").alias("_mask")) \
               .groupBy("_word").agg(F.bit_or("_mask").alias("_set"))


def maybe_among(rows: DataFrame, keys: DataFrame, key: str, word_bits: int = WORD_BITS) -> DataFrame:
    """The rows whose ``key`` may be among those of ``keys``: every one that
    is, and a few more.  One broadcast join, no exchange of ``rows``."""
    # a semi join: Catalyst would move the deciding semi join below an inner one
    words = F.broadcast(bit_words(keys, key, word_bits))
    asked = rows.withColumn("_ask", _word(F.col(key), word_bits)).withColumn("_bits", _mask(key))
    met = (F.col("_ask") == F.col("_word")) & (F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return asked.join(words, met, "left_semi").drop("_ask", "_bits")
