"""Dense numbers for rows without gathering them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_INSIDE = (1 << 33) - 1  # monotonically_increasing_id: partition above, position within it below


def place() -> Column:
    """To be taken once, while the rows are stored: partition and position of a row."""
    return F.monotonically_increasing_id()


def numbered(stored: DataFrame, name: str, start: int = 0, place_column: str = "place") -> DataFrame:
    """``stored`` with a number from ``start`` without gaps for each row, by partition and position.

    Only the counts of the partitions, one row for each, are summed up and sent to all tasks; the rows
    are neither sorted nor shuffled and keep their partitioning.
    """
    part = F.shiftright(place_column, 33)
    counts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("part", (F.coalesce(before, F.lit(0)) + start).alias("first"))
    number = F.col("first") + F.col(place_column).bitwiseAND(F.lit(_INSIDE))
    return stored.withColumn("part", part).join(F.broadcast(firsts), "part").withColumn(name, number).drop("part", "first")
