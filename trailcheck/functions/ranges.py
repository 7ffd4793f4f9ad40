"""Range join with a table of intervals given by the user (buckets of lengths, prices, times).

An interval table has ``lower`` and ``upper`` (bigint, both inclusive; a null ``upper`` is open) and ``label``.
``interval_faults`` lists what is wrong with one: gaps, overlaps, empty intervals.  ``in_intervals`` gives every value
its interval by an equi-join: an interval of w values lies on the level of floor(log2 w), where bins are 2^level wide,
so it touches at most three bins there; a value asks one bin on each level that the table has.  However unequal the
intervals are, neither side grows by more than its levels, there are at most 64 of them, and no theta join is left
to the planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LOWEST, HIGHEST = -(1 << 62), (1 << 62) - 1
TOP_LEVEL = 61


def interval_faults(intervals: DataFrame) -> DataFrame:
    """lower, upper, label and fault of every interval that is empty, overlaps the next one or leaves a gap before it.

    Neighbours are compared in one sorted pass over the interval table.
    """
    after = F.lead("lower").over(Window.orderBy(F.col("lower").asc_nulls_first(), F.col("upper").asc_nulls_last()))
    fault = (F.when(F.col("lower").isNull() | (F.col("lower") < LOWEST) | (F.col("upper") > HIGHEST), "bounds beyond 62 bits")
             .when(F.col("upper") < F.col("lower"), "empty")
             .when(after.isNull(), F.lit(None))
             .when(F.col("upper").isNull() | (after <= F.col("upper")), "overlaps the next")
             .when(after > F.col("upper") + 1, "gap before the next"))
    return intervals.select("lower", "upper", "label", fault.alias("fault")).filter(F.col("fault").isNotNull())


def checked_intervals(intervals: DataFrame) -> DataFrame:
    """``intervals`` if they have no fault; raises and names the first ones otherwise (one small job)."""
    faults = [f"{r.label!r}: {r.fault}" for r in interval_faults(intervals).orderBy("lower").limit(5).collect()]
    if faults:
        raise ValueError("the intervals do not partition their span: " + "; ".join(faults))
    return intervals


def _level(width: Column) -> Column:
    """floor(log2(width)) of a positive whole number, from its digits in binary."""
    return F.least(F.length(F.bin(width)) - 1, F.lit(TOP_LEVEL))


def in_intervals(rows: DataFrame, value: str, intervals: DataFrame, outer: bool = False) -> DataFrame:
    """``rows`` with the label of the interval that holds ``value``; with ``outer`` those without one too, label null.

    Intervals that overlap give a row for each.  ``rows`` should be a histogram where values repeat.
    """
    upper = F.coalesce("upper", F.lit(HIGHEST))
    spans = intervals.select(F.col("lower").alias("_lower"), upper.alias("_upper"), "label",
                             _level(upper - F.greatest("lower", F.lit(LOWEST)) + 1).alias("_level"))
    first, last = F.expr("shiftright(_lower, _level)"), F.expr("shiftright(_upper, _level)")
    binned = spans.select("*", F.explode(F.sequence(first, last)).alias("_bin"))
    levels = spans.agg(F.coalesce(F.collect_set("_level"), F.array()).alias("l")).scalar()  # at most 62
    asking = rows.withColumn("_level", F.explode(levels)).withColumn("_bin", F.expr(f"shiftright(`{value}`, _level)"))
    met = asking.join(binned, ["_level", "_bin"]).filter((F.col(value) >= F.col("_lower")) & (F.col(value) <= F.col("_upper")))
    found = met.select(*rows.columns, "label")
    if not outer:
        return found
    labels = found.select(F.col(value).alias("_value"), "label").distinct()
    return rows.join(labels, rows[value] == labels["_value"], "left").select(*[rows[c] for c in rows.columns], "label")


def interval_counts(rows: DataFrame, value: str, intervals: DataFrame) -> DataFrame:
    """label, row_count and value_sum of every interval, those without rows too; values are counted before the join."""
    hist = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    per = in_intervals(hist, "_v", intervals).groupBy("label").agg(
        F.sum("_n").alias("_rows"), F.sum(F.col("_n").cast("decimal(38,0)") * F.col("_v")).alias("_sum"))
    return intervals.select("label").join(per, "label", "left").select(
        "label", F.coalesce("_rows", F.lit(0)).cast("bigint").alias("row_count"), F.coalesce("_sum", F.lit(0)).cast("bigint").alias("value_sum"))
