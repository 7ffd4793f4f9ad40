"""Declared CSV sources: scan, header contract, null tokens, tagging."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from trailcheck.contracts import EXPECTED_COLUMNS, INTEGER_COLUMNS, text_schema
from trailcheck.functions.parsing import normalize_nulls, parse_integer
from trailcheck.sources.order import with_row_order


class InputContractError(ValueError):
    """A declared input does not match its contract."""


def _files(spark: SparkSession, path: str) -> list:
    """The files that a scan of ``path`` (a file, folder or pattern) reads, by path: a listing, no content."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs, found = where.getFileSystem(conf), []
    for status in fs.globStatus(where) or []:
        if status.isFile():
            found.append(status.getPath())
            continue
        rest = fs.listFiles(status.getPath(), True)
        while rest.hasNext():
            found.append(rest.next().getPath())
    return sorted((f for f in found if f.getName()[:1] not in "._"), key=str)


def _first_line(spark: SparkSession, file) -> str | None:
    """The first line of a file, unpacked if its name says that it is packed; nothing else of it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        unpacked = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(unpacked, "UTF-8")).readLine()
    finally:
        stream.close()


def check_headers(spark: SparkSession, path: str, source: str) -> None:
    """The first line of every file must name the declared columns: same names, same case, same order; a byte-order
    mark is allowed.  The driver reads one line a file."""
    expected, files = list(EXPECTED_COLUMNS[source]), _files(spark, path)
    if not files:
        raise InputContractError(f"no file of {source} at {path}")
    for file in files:
        line = (_first_line(spark, file) or "").lstrip("\ufeff")
        seen = next(csv.reader([line]), [])
        if seen != expected:
            raise InputContractError(f"header of {source} in {file.getName()} should be {expected}, but is {seen}")


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field holds a line break: some line has an odd number of quotes.  A split scan of the lines."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def scan_source(spark: SparkSession, path: str, source: str, multi_line: bool | None = None, ordered: bool = False) -> DataFrame:
    """S01+S02+S03: read a declared CSV (a file, folder or pattern) as all-text columns.

    The header of every file is compared before any row is read.  Doubled quotes stand for one, a backslash is an
    ordinary character, missing fields of a short row are null.  Types are never inferred; missing-value tokens become
    null.  Files are split among tasks, unless quoted fields hold line breaks: then a file is one task.  ``multi_line``
    says so (True, False) or leaves it to be found out (None, one more scan of the lines).  ``ordered`` adds the rows'
    order, see :mod:`trailcheck.sources.order`.
    """
    check_headers(spark, path, source)
    if multi_line is None:
        multi_line = has_broken_lines(spark, path)
    df = (spark.read.schema(text_schema(source)).options(quote='"', escape='"', multiLine=multi_line, header=True, enforceSchema=True, mode="PERMISSIVE").csv(path))
    columns = df.columns
    return normalize_nulls(with_row_order(df) if ordered else df, columns)


def typed_source(text: DataFrame, source: str) -> DataFrame:
    """Text columns of a declared source -> typed: declared integer columns go through the integer rule (A01b; text
    that is no integer becomes null), the others stay text.  Columns beyond the declared ones are kept as they are."""
    whole = set(INTEGER_COLUMNS[source])
    return text.select(*[parse_integer(F.col(c)).alias(c) if c in whole else F.col(c) for c in text.columns])


def check_columns(df: DataFrame, source: str) -> DataFrame:
    """S02 for already-typed tables (e.g. Parquet): exact column list, in order."""
    expected = list(EXPECTED_COLUMNS[source])
    if df.columns != expected:
        raise InputContractError(f"unexpected columns for {source}: expected {expected}, observed {df.columns}")
    return df


def tag_and_union(parts: Mapping[str, DataFrame], tag: str = "_source_name") -> DataFrame:
    """Stack same-shape parts, each tagged with its source name."""
    frames = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
