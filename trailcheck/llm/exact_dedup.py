"""Exact deduplication through an extendible-hash index on shared files (operator 7).

1. The directory doubles until no bucket is overfull.  A bucket is a prefix of the 64-bit hash, as short as the distinct
   hashes under it allow; only hashes are counted, no texts.  A bucket holds ``BUCKET_CLASSES`` or, in tables with more
   hashes than the largest directory times that, ``ROOM`` times the mean of a cell, so that the directory, which is
   broadcast, has at most 2^``MAX_DEPTH`` rows and buckets still split as far as they should.
2. Every text goes to the owner of its key range: (bucket, hash).  An owner compares the bytes of the texts that meet
   there and chains those that differ; copies collapse in each task before the shuffle, so a group that holds a third
   of all rows sends one text a task.  A chain of one link, which is every chain but for collisions of the hash, is
   settled there; the texts of longer chains are told apart link by link, each link with its smallest id and copies.
3. The index files hold bucket, hash, place in the chain, text, its digest, smallest id and number of copies.
4. Every document looks its bucket up in the directory and its link up in the index, by hash and SHA-256.  Two links
   of a chain with one digest fail the job.  A hot link on the document side is a skewed join, whose partitions Spark
   splits.

Only built-in expressions run on the executors.

Defined cases: a null text counts as empty; empty texts are copies of one another; rows that share the smallest
doc_id of their text all stay, as they are one document; a null doc_id is larger than any other, and where a class
has no other its rows stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailcheck.llm.common import delete, documents, shared_dir, stored

MAX_DEPTH = 16
BUCKET_CLASSES = 2_000
ROOM = 4  # a cell of the largest directory may hold so many times the mean


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _prefix(hashed: Column, depth: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - depth)


def _hashed(df: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return rows.select("id", "norm", hash_of(F.col("norm")).alias("hash"))


def directory(hashes: DataFrame, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """(cell, bucket, depth) for every cell of ``MAX_DEPTH`` hash bits that has hashes; ``hashes`` may repeat.

    A cell's bucket starts at depth 0; the directory doubles, and the bucket splits by one more bit, while
    the distinct hashes under its prefix are more than a bucket holds.
    """
    cells = hashes.select("hash").distinct().groupBy(_prefix(F.col("hash"), MAX_DEPTH).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {MAX_DEPTH} - depth)"))
    counts = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("n"))
    total = counts.where("depth = 0").select("n").scalar()
    holds = F.greatest(F.lit(bucket_classes), F.ceil(total * ROOM / 2**MAX_DEPTH))
    fits = counts.where((F.col("n") <= holds) | (F.col("depth") == MAX_DEPTH))
    chosen = levels.join(F.broadcast(fits.select("depth", "prefix")), ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return chosen.select("cell", F.expr(f"shiftleft(shiftright(cell, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)").alias("bucket"), "depth")


def _placed(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """``rows`` with the bucket of their hash."""
    return rows.withColumn("cell", _prefix(F.col("hash"), MAX_DEPTH)).join(F.broadcast(pages.select("cell", "bucket")), "cell").drop("cell")


def build_index(rows: DataFrame, pages: DataFrame, at: str) -> DataFrame:
    """(bucket, hash, chain, norm, digest, keep_id, group_size) of (id, norm, hash): one row for each distinct text.

    ``collect_set`` is the comparison of bytes: it keeps a text only if it differs from every one under its hash.
    """
    sums = [F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    placed = _placed(rows, pages)
    met = stored(placed.groupBy("bucket", "hash").agg(F.collect_set("norm").alias("links"), *sums), "owned", at)
    one = met.where(F.size("links") == 1).select("bucket", "hash", F.lit(0).alias("chain"), F.col("links")[0].alias("norm"), "keep_id", "group_size")
    clashing = met.where(F.size("links") > 1).select("bucket", "hash", F.array_sort("links").alias("links"))
    if not clashing.isEmpty():  # hashes that collide: each of their rows finds its link
        found = placed.join(clashing, ["bucket", "hash"]).withColumn("chain", F.array_position("links", F.col("norm")).cast("int") - 1)
        linked = found.groupBy("bucket", "hash", "chain").agg(F.first("norm").alias("norm"), *sums)
        one = one.unionByName(linked)
    index = one.select("bucket", "hash", "chain", "norm", F.sha2("norm", 256).alias("digest"), "keep_id", "group_size")
    if not clashing.isEmpty():
        same = F.lag("digest").over(Window.partitionBy("bucket", "hash").orderBy("digest")) == F.col("digest")
        index = index.withColumn("digest", F.when(F.coalesce(same, F.lit(False)), F.raise_error(F.lit("two texts share hash and digest"))).otherwise(F.col("digest")))
    index = stored(index, "index", at)
    delete(rows.sparkSession, f"{at}/owned")  # its texts are in the index
    return index


def _index(df: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Directory and index of ``df``, in the shared folder."""
    at = shared_dir(df.sparkSession, "exact-dedup")
    rows = _hashed(df, id_col, text_col, hash_of)
    pages = stored(directory(rows), "directory", at)
    return pages, build_index(rows, pages, at)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                 hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The columns ``keep`` of every row (the id where none are named) with keep_id, group_size, kept, text_sha256."""
    pages, index = _index(df, id_col, text_col, hash_of)
    norm = normalised(F.col(text_col))
    carried = df.select(F.struct(*(keep or [id_col])).alias("row"), F.col(id_col).alias("id"), hash_of(norm).alias("hash"), F.sha2(norm, 256).alias("digest"))
    found = _placed(carried, pages).join(index.select("bucket", "hash", "digest", "keep_id", "group_size"), ["bucket", "hash", "digest"])
    return found.select("row.*", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def kept_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The rows of ``df`` that stay, with its columns and no others."""
    pages, index = _index(df, id_col, text_col, hash_of)
    repeated = index.where("group_size > 1").select("bucket", "hash", "digest", "keep_id")
    norm = normalised(F.col(text_col))
    looked = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), hash_of(norm).alias("hash"), F.sha2(norm, 256).alias("digest"))
    found = _placed(looked, pages).join(repeated, ["bucket", "hash", "digest"], "left")
    return found.where(F.col("keep_id").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).select("row.*")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


ORACLE = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, sha256(norm) as text_sha256
from n window w as (partition by norm)
"""
