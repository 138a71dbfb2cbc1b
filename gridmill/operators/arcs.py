"""The smallest arc of longitudes around intervals that may lie on both sides of the antimeridian."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_west(lon: Column) -> Column:
    """The longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def arc_length(west: Column, east: Column) -> Column:
    """Degrees from west eastward to east; bounds past 180 and bounds whose east is less wrap."""
    span = east - west
    return F.when(span >= 360, F.lit(360.0)).when(span < 0, span + 360).otherwise(span)


def enclosing_arc(
    intervals: DataFrame,
    keys: list[str],
    west: str = "west",
    east: str = "east",
    full_circle: bool = True,
) -> DataFrame:
    """Per key the columns ``west, east`` of the smallest arc around all intervals.

    The arc leaves out the widest gap between intervals ordered by their west ends; of equal gaps the
    one whose eastern end comes first. If it crosses the antimeridian its east is less than its west.
    Without a gap it is the whole circle, -180 to 180; or else, if ``full_circle`` is false, the arc
    that overlaps itself least: it begins with an interval and goes once around to where the last of
    the others ends, past its own west.
    """
    start, length = normal_west(F.col(west)), arc_length(F.col(west), F.col(east))
    # Every interval once more a turn to the west, so that those that wrap cover what they reach.
    turns = F.explode(F.array(F.lit(-360.0), F.lit(0.0))).alias("turn")
    placed = (
        intervals.where(f"`{west}` IS NOT NULL AND `{east}` IS NOT NULL")
        .select(*keys, start.alias("a"), length.alias("n"))
        .distinct()
        .select(*keys, "a", "n", turns)
        .select(*keys, "turn", (F.col("a") + F.col("turn")).alias("from"), "n")
        .withColumn("to", F.col("from") + F.col("n"))
    )
    before = Window.partitionBy(*keys).orderBy("from", "to").rowsBetween(
        Window.unboundedPreceding, -1
    )
    gaps = placed.withColumn("end", F.max("to").over(before)).where("turn = 0")
    gap = F.col("from") - F.col("end")
    best = gaps.groupBy(*keys).agg(
        F.max(F.struct(F.round(gap, 9).alias("gap"), (-F.col("from")).alias("order"), "from", "end")).alias("g")
    )
    open_ = F.col("g.gap") > 0 if full_circle else F.lit(True)
    # The end lies up to a turn before the start.
    end = F.when(F.col("g.end") <= -180, F.col("g.end") + 360).otherwise(F.col("g.end"))
    return best.select(
        *keys,
        F.when(open_, F.col("g.from")).otherwise(-180.0).alias("west"),
        F.when(open_, end).otherwise(180.0).alias("east"),
    )


def arc_middle(west: Column, east: Column) -> Column:
    """The longitude in the middle of an arc, in (-180, 180]."""
    middle = west + arc_length(west, east) / 2
    return F.when(middle > 180, middle - 360).otherwise(middle)
