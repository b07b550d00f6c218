"""Bit arrays that travel inside a plan as one array literal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_array(rows: DataFrame, bits: list[Column], size: int) -> Column:
    """The array with these bits of all rows set; `size` is a power of two, 64 at least.

    At most size / 64 longs reach the driver, however many rows there are.
    """
    bit = rows.select(F.explode(F.array(*bits)).alias("bit"))
    mask = F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")
    longs = [0] * (size >> 6)
    for word, value in bit.groupBy(F.shiftright("bit", 6)).agg(mask).collect():
        longs[word] = value
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def is_set(longs: Column, bit: Column) -> Column:
    word = F.element_at(longs, (F.shiftright(bit, 6) + 1).cast("int"))
    return F.getbit(word, bit.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1


def below(value: Column, size: int) -> Column:
    """A bit number from a hash, for an array of `size` bits."""
    return value.bitwiseAND(F.lit(size - 1).cast("long"))
