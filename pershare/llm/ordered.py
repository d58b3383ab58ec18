"""Places of rows in one order over a whole table, without a task that holds them all.

Rows are dealt by ranges of the order and sorted where they lie. The table is written with each row's place in its
range; a range's offset is the number of rows in the ranges before it, so only as many counts as there are ranges meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, partitions, stored

#: Bits of monotonically_increasing_id() that number the rows of one partition.
ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rows' numbers from 1 on in the order given; ties in any order, each row has a number of its own."""
    at, part, before = (free_name(df, c) for c in ("at", "part", "before"))
    tie = free_name(df, "tie")
    dealt = df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(partitions(df.sparkSession), *order, F.col(tie))
    placed = stored(dealt.sortWithinPartitions(*order, tie).drop(tie).withColumn(at, F.monotonically_increasing_id()), "placed")
    of = F.shiftright(at, ROW_BITS)
    sizes = placed.groupBy(of.alias(part)).agg(F.count("*").alias("n"))
    # one row for each range
    offsets = sizes.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias(before))
    found = placed.withColumn(part, of).join(F.broadcast(offsets), part)
    return found.withColumn(name, F.col(before) + F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1).drop(at, part, before)
