"""Bloom filters of key sets, tested where a table is scanned.

A semi-join with a key set too large to broadcast shuffles the whole probed table.
A filter of the keys is small whatever their number (``MOST_BITS``), so it travels
as a scalar subquery into the filter above the scan: rows whose key is in no
key's places are gone before the shuffle. False positives are removed by the
semi-join that follows, so a full filter costs time, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key (two places each: about 3 % false positives), and bits at most (8 MB).
BITS_PER_KEY, MOST_BITS = 12, 1 << 26
#: Key sets up to this size are left to a broadcast join (16 bytes a key: 8 MB).
BROADCAST_KEYS = 500_000


def _places(key: Column, bits: int) -> list[Column]:
    h = F.xxhash64(key.cast("string"))
    return [h.bitwiseAND(F.lit(bits - 1).cast("long")), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1).cast("long"))]


def bits_for(n: int) -> int:
    """A power of two of about ``BITS_PER_KEY`` bits for each of ``n`` keys."""
    return min(MOST_BITS, max(1 << 10, 1 << (BITS_PER_KEY * max(1, n) - 1).bit_length()))


def bloom(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row ``bits``: the filter of a column's values as an array of 64-bit words.

    Places are or-ed by word where the keys are read, so at most ``bits / 64`` rows
    of each task are shuffled; the words of the whole filter make one row.
    """
    word = lambda p: F.shiftright(p, 6).alias("w")
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    places = keys.where(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column), bits))).alias("p"))
    words = places.groupBy(word(F.col("p"))).agg(F.bit_or(bit).alias("b"))
    none = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    whole = words.unionByName(none).groupBy("w").agg(F.bit_or("b").alias("b"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).getField("b").alias("bits"))


def may_be_in(column: str, filter_row: DataFrame, bits: int) -> Column:
    """Whether the filter may hold the column's value (false for NULL)."""
    words = filter_row.scalar()

    def hit(p: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        return F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")).bitwiseAND(bit) != 0

    first, second = (hit(p) for p in _places(F.col(column), bits))
    return F.col(column).isNotNull() & first & second


def semi_join(rows: DataFrame, keys: DataFrame, column: str, n_keys: int | None = None, broadcast_keys: int | None = None) -> DataFrame:
    """``rows`` whose ``column`` is among the keys' (same name).

    ``n_keys``: how many keys there are, about, where that is known. More than
    ``BROADCAST_KEYS`` are tested as a Bloom filter at the scan of ``rows`` first.
    """
    limit = BROADCAST_KEYS if broadcast_keys is None else broadcast_keys
    if n_keys is not None and n_keys > limit:
        bits = bits_for(n_keys)
        rows = rows.where(may_be_in(column, bloom(keys, column, bits), bits))
    return rows.join(keys.select(column).distinct(), column, "left_semi")
