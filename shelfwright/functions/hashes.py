"""64-bit image hashes as integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwright.functions.fields import col


def hash_value(hexadecimal: Column | str) -> Column:
    """Signed 64-bit integer of a 16-digit hexadecimal string."""
    return F.conv(col(hexadecimal), 16, -10).cast("bigint")


def hash_text(value: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(col(value)), 16, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def unit_at(h: Column, index: int, width: int) -> Column:
    return F.shiftright(h, width * index).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def equal_units(a: Column, b: Column, width: int, count: int) -> Column:
    """Bit mask of the `width`-bit units at which two values agree."""
    x = a.bitwiseXOR(b)
    mask = F.lit(0)
    for i in range(count):
        mask = mask + F.when(unit_at(x, i, width) == 0, 1 << i).otherwise(0)
    return mask
