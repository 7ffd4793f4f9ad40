"""Conflict-constrained best-fit packing of documents into fixed contexts (operator 1).

Every row is numbered where its length is stored.  Rows are dealt into shards of about ``SHARD_ROWS`` by a hash of that
number and packed shard by shard, longest first.  A shard keeps its open bins in order of what is left in them; each bin carries one bitmap of its sources and
one of its duplicate clusters.  The search starts at the tightest bin that the document fits into and goes on to the
next ones until neither bitmap shares a bit with the document; without such a bin a new one opens.  So no bin
holds two documents of one source or of one duplicate cluster.

Only ids, lengths, sources and clusters move; texts are encoded where they are read.  A hot source or cluster
spreads over all shards, and so do rows without an id and rows that are alike.  A document longer than a bin fills bins of its own with
pieces of ``capacity`` tokens, and the rest is packed like a document; documents without tokens are placed too.

Defined cases: a null text has length 0; a null source conflicts with nothing; texts equal but for case and white space are one cluster, empty
texts are none; ties go by id, then cluster, then source; repeated rows are packed each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.bpe import PATTERN, vocabulary_path
from trailcheck.llm.common import documents, fields, map_batches, ship, stored, texts

CAPACITY = 4096
SHARD_ROWS = 2_000


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item (length, source bitmap, cluster bitmap), placed in the order given."""
    order: list[tuple[int, int]] = []  # (what is left, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    places = []
    for length, source, cluster in items:
        at = bisect_left(order, (length, -1))
        while at < len(order) and (sources[order[at][1]] & source or clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            left, box = order.pop(at)
            sources[box] |= source
            clusters[box] |= cluster
        else:
            left, box = capacity, len(sources)
            sources.append(source)
            clusters.append(cluster)
        places.append((box, capacity - left))
        insort(order, (left - length, box))
    return places


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that occurs twice or more; others, and nulls, cannot conflict."""
    codes, kinds = pd.factorize(values.where(values.duplicated(keep=False)))
    return [1 << int(c) if c >= 0 else 0 for c in codes]


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "id", "piece", "cluster", "source"], ascending=[False, True, True, True, True], kind="stable", na_position="last")
    items = list(zip(rows["length"].astype(int), _bits(rows["source"]), _bits(rows["cluster"])))
    places = best_fit(items, capacity)
    shard = int(rows["shard"].iloc[0])
    return pd.DataFrame({"id": rows["id"].to_numpy(), "piece": rows["piece"].to_numpy(), "n_tokens": rows["length"].to_numpy(),
                         "bin_id": [(shard << 32) + b for b, _ in places], "bin_offset": [o for _, o in places]})


def pack(df: DataFrame, id_col: str, length_col: str, source_col: str, cluster_col: str, row_col: str, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, piece, n_tokens, bin_id, bin_offset) of every document, one row a piece.

    ``df`` is a stored table, as it is read several times; ``row_col`` is a number that no two of its rows share.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(length_col), F.lit(0)).cast("long").alias("length"),
                     F.col(source_col).cast("string").alias("source"), F.col(cluster_col).cast("long").alias("cluster"), F.col(row_col).alias("row"))
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    full = F.floor(F.col("length") / capacity).cast("int")
    rest = rows.withColumn("piece", full).withColumn("length", F.col("length") % capacity).where((F.col("length") > 0) | (F.col("piece") == 0))
    own = rows.withColumn("piece", F.explode(F.expr(f"sequence(0, cast(length div {capacity} as int))"))).where(F.col("piece") < full)
    # a full piece is a bin of its own; its number, row * 2^31 + piece below zero, is no other's and apart from those of the shards
    number = F.col("row").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("piece")
    alone = own.select("id", "piece", F.lit(capacity).cast("long").alias("n_tokens"), (-1 - number).cast("decimal(38,0)").alias("bin_id"), F.lit(0).cast("long").alias("bin_offset"))
    packed = rest.drop("row").groupBy("shard").applyInPandas(lambda pdf: pack_shard(pdf, capacity), "id long, piece int, n_tokens long, bin_id long, bin_offset long")
    return packed.withColumn("bin_id", F.col("bin_id").cast("decimal(38,0)")).unionByName(alone)


def token_lengths(df: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with n_tokens, the length of the text in a vocabulary of ranks (tiktoken layout)."""
    kept = df.select(*keep, F.col(text_col).cast("string").alias("__text"))

    def make():
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("lengths", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def each(batch: pa.RecordBatch):
            yield {**{k: batch.column(i) for i, k in enumerate(keep)}, "n_tokens": [len(encoding.encode_ordinary(t)) for t in texts(batch.column(len(keep)))]}

        return each

    return map_batches(kept, fields(df, keep, "n_tokens long"), make)


def pack_documents(df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, n_tokens, bin_id, bin_offset) of a table with the columns of ``documents``."""
    norm = F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")))
    rows = df.select("doc_id", "source", F.when(norm != "", F.xxhash64(norm)).alias("cluster"), "text")
    sized = token_lengths(rows, vocabulary_path("byte_bpe_50k.tiktoken"), ["doc_id", "source", "cluster"])
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "lengths")
    return pack(sized, "doc_id", "n_tokens", "source", "cluster", "row", capacity).withColumnRenamed("id", "doc_id")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
