"""Scalar column helpers: guarded shares, epoch conversion, calendar days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from trailcheck.contracts import DAY_MS


def share(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator as DOUBLE, 0.0 when the denominator is 0 or null."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since the epoch (floor), independent of the session time zone.

    TIMESTAMP_NTZ values are read as UTC wall clock; TIMESTAMP values are
    instants; DATE values start at UTC midnight.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    elif isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(col)
    elif isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint") * F.lit(DAY_MS)
    else:
        return col.cast("bigint")
    # exact integer floor division: subtract the remainder, then divide a multiple
    return ((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("bigint")


def day_index(ms: Column) -> Column:
    """UTC day number (days since 1970-01-01) of an epoch-ms value."""
    return F.floor(ms / F.lit(DAY_MS)).cast("bigint")


def utc_date_text(ms: Column) -> Column:
    """'YYYY-MM-DD' of the UTC calendar day holding an epoch-ms value."""
    return F.date_from_unix_date(day_index(ms).cast("int")).cast("string")
