"""What differs between two runs of a table: fingerprints by key range first, rows only where they differ.

Level 1 deals both tables into ``ranges`` of a hash of the key and takes a count and two order-free sums of row hashes a
range; equal ranges are settled there.  Level 2 groups only the rows of ranges that differ, whole row by whole row, so
the rows listed are exact and never rest on a hash being unequal.  Two ranges with equal fingerprints and unequal
rows would need equal counts and equal sums of 124 bits of their MD5s.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

RANGES = 4_096


def _range_of(keys: Sequence[str], ranges: int) -> Column:
    text = F.concat_ws(",", *[F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in keys])
    return F.pmod(F.xxhash64(text), F.lit(ranges)).cast("int")


def range_fingerprints(df: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """range, rows and two sums of row hashes; an empty range has no row."""
    digest = F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    part = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    return df.groupBy(_range_of(keys, ranges).alias("range")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum(part[0]).cast("string").alias("sum_a"), F.sum(part[1]).cast("string").alias("sum_b"))


def differing_ranges(a: DataFrame, b: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """The ranges whose fingerprints differ: at most ``ranges`` rows."""
    both = range_fingerprints(a, keys, ranges).withColumn("_run", F.lit("a")).unionByName(
        range_fingerprints(b, keys, ranges).withColumn("_run", F.lit("b")))
    per = both.groupBy("range").agg(F.count(F.lit(1)).alias("runs"), F.count_distinct("rows", "sum_a", "sum_b").alias("kinds"))
    return per.filter((F.col("runs") < 2) | (F.col("kinds") > 1)).select("range")


def table_difference(a: DataFrame, b: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """Rows that one run has more often than the other: their columns, ``run`` (a or b) and ``copies`` (how many more).

    Columns are matched by name; nulls equal nulls.
    """
    columns = a.columns
    differ = F.broadcast(differing_ranges(a, b, keys, ranges))  # at most ``ranges`` numbers
    count = lambda df, name: (df.select(*columns).withColumn("range", _range_of(keys, ranges)).join(differ, "range", "left_semi").drop("range")
                              .groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_run", F.lit(name)))
    n = lambda name: F.coalesce(F.max(F.when(F.col("_run") == name, F.col("_n"))), F.lit(0))
    more = count(a, "a").unionByName(count(b, "b")).groupBy(*columns).agg((n("a") - n("b")).alias("_more")).filter(F.col("_more") != 0)
    return more.select(*columns, F.when(F.col("_more") > 0, "a").otherwise("b").alias("run"), F.abs("_more").cast("bigint").alias("copies"))
