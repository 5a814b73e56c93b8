"""Sets of numbers from 1 as words of 64 bits, one row each.

Words without a number have no row, so a set never has more rows than numbers, and where numbers lie
close 64 of them share one. Aggregates over words hold one long per group, so they spill and merge
like any sum; 4 KB bitmaps of rare codes would be almost all zeros.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket of 32,768 numbers, and word in it.
PLACE = ("balde", "palavra")


def word(number: str) -> list[Column]:
    """``balde``, ``palavra`` and ``bits``: the number's word, and the one bit of the number in it."""
    at = F.bitmap_bit_position(number)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    return [F.bitmap_bucket_number(number).cast("int").alias(PLACE[0]),
            F.floor(at / 64).cast("short").alias(PLACE[1]), bit.alias("bits")]


def size(bits: str | Column) -> Column:
    """How many numbers the words of a group hold."""
    return F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("long")
