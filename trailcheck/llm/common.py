"""Helpers the training-data operators share: tables, shared scratch space, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; deleted when the JVM of the driver ends.

    Where that setting is unset (as in tests), the context's checkpoint folder or one beside the session's tables serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return fs.makeQualified(where).toString()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files when they end, not when the driver next collects garbage.

    For queries whose result is written or collected at once; Spark would run a stage again whose files were asked for later.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stored(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: lineage and shuffle files end here."""
    spark = df.sparkSession
    path = f"{at or shared_dir(spark, name)}/{name}"
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove scratch files that no later step reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once a session."""
    context = spark.sparkContext
    if getattr(context, "_trailcheck_shipped", False):
        return
    import tempfile
    import zipfile

    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="trailcheck-")) / "trailcheck_package.zip"  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._trailcheck_shipped = True


def fields(df: DataFrame, columns: Iterable[str], more: str = "") -> StructType:
    """The named columns of ``df`` as they are typed there, then those of the DDL text ``more``.

    A StructType, not its text: the names inside a struct column may need quoting, which ``simpleString`` leaves out.
    """
    return StructType([*(df.schema[c] for c in columns), *(_parse_datatype_string(more).fields if more else ())])


def map_batches(df: DataFrame, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]]) -> DataFrame:
    """``mapInArrow`` with per-task state: ``make()`` runs once a task and returns the batch function.

    The function takes its columns by place and yields dicts of column lists or arrays; empty batches are left out.
    Where it has an attribute ``end``, that runs after the last batch and yields such dicts too.
    """
    ship(df.sparkSession)
    schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(schema)

    def columns(out: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [v if isinstance(v, pa.Array) and v.type == f.type else pa.array(v, type=f.type)
             for f, v in ((f, out[f.name]) for f in target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            if batch.num_rows:
                yield from map(columns, each(batch))
        yield from map(columns, getattr(each, "end", tuple)())

    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))).mapInArrow(run, schema)  # names that need no quoting


def texts(column: pa.Array) -> Iterator[str]:
    """Texts of a column, null as empty, one Python string at a time."""
    for x in column:
        yield x.as_py() or ""


#: Cells of the membership bitmap: its size, and so what is broadcast, is fixed.
BITMAP_BITS = 1 << 22


def maybe_among(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """A table with ``df``'s rows and the flag ``__maybe``: false only for rows whose id is surely not in ``ids``.

    ``ids`` (one column) is hashed into a bitmap of fixed size, which is broadcast; rows that it rules out
    need not be shuffled to a join.
    """
    cell = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(BITMAP_BITS))
    word = lambda c: F.shiftright(cell(c), 6).cast("int")
    bits = ids.select(word(F.col(ids.columns[0])).alias("__word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(cast(`{ids.columns[0]}` as long)), {BITMAP_BITS}L) & 63 as int))").alias("bit"))
    table = bits.groupBy("__word").agg(F.bit_or("bit").alias("__bits"))
    met = df.withColumn("__word", word(F.col(id_col))).join(F.broadcast(table), "__word", "left")
    shift = f"cast(pmod(xxhash64(cast(`{id_col}` as long)), {BITMAP_BITS}L) & 63 as int)"
    return met.withColumn("__maybe", F.expr(f"coalesce((shiftrightunsigned(__bits, {shift}) & 1L) = 1L, false)")).drop("__word", "__bits")
