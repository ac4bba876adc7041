"""Rows in ranges of an order: what a window over a whole group would see, without one task holding the group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import scratch_root

PART = "_part"


def in_ranges(df: DataFrame, order: list[str], pieces: int, part: str = PART) -> DataFrame:
    """Rows cut into ``pieces`` ranges of about equally many rows along ``order``, with the number of their range.

    The rows are checkpointed: cuts are drawn from a sample of the rows, and every reader has to see the same ones. Rows that are
    equal in all of ``order`` share a range, so that the order should end in a key or the rows be distinct in it.
    """
    scratch_root(df.sparkSession)
    return df.repartitionByRange(max(1, pieces), *order).withColumn(part, F.spark_partition_id()).checkpoint()


def border_rows(rows: DataFrame, group: list[str], order: list[str], values: list[str], n: int, after: bool = False,
                part: str = PART) -> DataFrame:
    """For each group and range, the group's ``n`` rows that come just before the range (``after``: just behind it).

    Each range reports at most ``n`` rows of a group, and the ``n`` neighbouring ranges that hold rows of it hold enough of them.
    """
    sides = [F.col(c).asc() if after else F.col(c).desc() for c in order]
    ends = (rows.select(*group, part, *order, *values)
                .withColumn("_rn", F.row_number().over(Window.partitionBy(*group, part).orderBy(*sides))).filter(F.col("_rn") <= n)
                .groupBy(*group, part).agg(F.collect_list(F.struct(*order, *values)).alias("_end")))
    near = Window.partitionBy(*group).orderBy(part).rowsBetween(*((1, n) if after else (-n, -1)))
    carried = F.sort_array(F.flatten(F.collect_list("_end").over(near)), asc=after)
    return (ends.withColumn("_row", F.slice(carried, 1, n)).select(*group, part, F.explode("_row").alias("_row"))
                .select(*group, part, "_row.*"))


def running_sums(df: DataFrame, group: str, order: list[str], amount: str, name: str, pieces: int) -> DataFrame:
    """Add the sum of ``amount`` over all rows of the group up to and including each row, in ranges of the order."""
    rows = in_ranges(df, [group, *order], pieces)
    totals = rows.groupBy(group, PART).agg(F.sum(amount).alias("_total"))
    upto = (Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(group).orderBy(PART).rowsBetween(*upto)
    offsets = totals.select(group, PART, (F.sum("_total").over(ahead) - F.col("_total")).alias("_offset"))
    inner = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(*upto)
    # One row for each range and group that begins in it.
    return (rows.join(F.broadcast(offsets), [group, PART])
                .withColumn(name, F.col("_offset") + F.sum(amount).over(inner)).drop(PART, "_offset"))
