"""A bit filter of a table's keys, tested inside column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64


@dataclass(frozen=True)
class KeyFilter:
    """Which hashes a table of keys may hold: no key is missed, others may pass.

    ``words`` are the bits in words of 64. A key sets one bit, so of other values
    the share of set bits passes.
    """

    words: tuple[int, ...]

    def may_hold(self, key_hash: Column) -> Column:
        """Whether a key with this hash (``xxhash64``) may be in the table; null for a null."""
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        place = F.shiftright(key_hash, 6).bitwiseAND(F.lit(len(self.words) - 1))
        bit = F.call_function("shiftrightunsigned", F.get(table, place.cast("int")), key_hash.bitwiseAND(F.lit(63)).cast("int"))
        return bit.bitwiseAND(F.lit(1)) == 1


def key_filter(keys: DataFrame, key: str, bits_each: int = 16, most_bits: int = 1 << 22) -> KeyFilter:
    """The filter of a column's values; its job brings at most ``most_bits / 64`` words to the driver.

    The bits are ``bits_each`` for each set one, rounded up to a power of two, or
    ``most_bits``; a longer table lets more values pass, never fewer. Nulls set
    no bit, an empty table lets nothing pass.
    """
    if most_bits < WORD_BITS or most_bits & (most_bits - 1):
        raise ValueError(f"most_bits must be a power of two from {WORD_BITS} on, got {most_bits}")
    h = F.xxhash64(F.col(key))
    place = F.shiftright(h, 6).bitwiseAND(F.lit(most_bits // WORD_BITS - 1)).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))
    found = keys.where(F.col(key).isNotNull()).groupBy(place).agg(F.bit_or(bit).alias("bits")).collect()
    wanted = bits_each * sum((row["bits"] & (2**64 - 1)).bit_count() for row in found)
    size = min(most_bits, max(WORD_BITS, 1 << max(0, wanted - 1).bit_length())) // WORD_BITS
    words = [0] * size
    for row in found:
        words[row["place"] % size] |= row["bits"]
    return KeyFilter(tuple(words))
