"""Order-insensitive table fingerprints (S11): hashes identify content, no statistic is computed from one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

def _row_text(cols: Sequence[str]) -> Column:
    """All fields of a row, each as its length and text; a null is a dash, so no text reads like it."""
    field = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat_ws(",", *[field(F.col(c).cast("string")) for c in cols])


def table_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count, and the sum and xor of the first 32 bits of every row's MD5."""
    h = F.conv(F.substring(F.md5(_row_text(df.columns).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"),
                  F.coalesce(F.bit_xor(h), F.lit(0)).cast("bigint").alias("hash_xor"))
