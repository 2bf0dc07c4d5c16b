"""Placing records by address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_hash(text: str | Column) -> Column:
    """32-bit signed hash ``h = 31 * h + unit`` over the UTF-16 units of a string."""
    column = F.col(text) if isinstance(text, str) else text

    def add(acc: Column, unit: Column) -> Column:
        return (acc * 31 + unit).bitwiseAND(F.lit(0xFFFFFFFF))

    def step(acc: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        above = point - 0x10000
        pair = add(add(acc, F.lit(0xD800) + F.shiftright(above, 10)), F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF)))
        return F.when(char == "", acc).when(point < 0x10000, add(acc, point)).otherwise(pair)

    unsigned = F.aggregate(F.split(column, ""), F.lit(0).cast("bigint"), step)
    # Bit 31 is the sign; moving it to the top and back keeps the one fold in the expression.
    return F.shiftright(F.shiftleft(unsigned, 32), 32).cast("int")


def topic_of(hashed: Column, topics: int) -> Column:
    return F.pmod(hashed, F.lit(topics))


def partition_of(hashed: Column, topics: int, partitions: int) -> Column:
    """Independent of :func:`topic_of`, so a topic fills all its partitions."""
    return F.pmod(F.floor(hashed / topics), F.lit(partitions)).cast("int")
