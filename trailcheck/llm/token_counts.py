"""Token counts by an exact length histogram (operator 10).

Documents are encoded and grouped by encoded length; counts are added up in
each task before the shuffle, so the shuffle carries one row per task and
distinct length whatever the skew.  Suffix sums over the histogram answer every
question about the corpus at every context limit without another look at the
documents: totals, quantiles, and the tokens left when documents are cut at a
limit.  The sums run inside blocks of ``BLOCK`` neighbouring lengths and then
over the blocks' totals, so no task sorts the whole histogram.

Defined cases: a null or empty text has length 0 and counts as a document;
repeated rows count each; an empty table gives an empty histogram, total 0 and
null quantiles; very long texts are encoded whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailcheck.llm.bpe import count_tokens, vocabulary_path
from trailcheck.llm.common import documents, stored

BLOCK = 1024


def length_histogram(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length."""
    return count_tokens(df, path, [], text_col).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with documents and tokens from each length on.

    ``docs_from`` and ``tokens_from`` count documents of at least this length and their tokens;
    ``docs_to`` counts documents of at most this length; ``truncated_total`` is the corpus' tokens when every
    document is cut at this length, ``tokens_cut`` what that loses; ``n_all`` and ``tokens_all`` are the totals.
    """
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    totals = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per BLOCK lengths: bounded by the longest document, not by the number of documents
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = totals.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
                          F.sum("d").over(every).alias("n_all"), F.sum("t").over(every).alias("tokens_all"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    sums = h.withColumn("d_in", F.sum("n_docs").over(inside)).withColumn("t_in", F.sum("tokens").over(inside)).join(carry, "block")
    docs_from, tokens_from = F.col("d_in") + F.col("d_after"), F.col("t_in") + F.col("t_after")
    truncated = F.col("tokens_all") - tokens_from + docs_from * F.col("n_tokens")
    return sums.select("n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"),
                       (F.col("n_all") - docs_from + F.col("n_docs")).alias("docs_to"), truncated.alias("truncated_total"),
                       (F.col("tokens_all") - truncated).alias("tokens_cut"), "n_all", "tokens_all")


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, total, truncated_total, n_cut) for any limits, from the suffix sums."""
    spark = sums.sparkSession
    asked = F.broadcast(spark.createDataFrame([(int(x),) for x in limits], "context_limit long"))
    # of all lengths over the limit, the smallest has the suffix sums that the limit needs
    first = asked.join(sums.select("n_tokens", "docs_from", "tokens_from"), F.col("n_tokens") > F.col("context_limit"), "left")
    best = first.groupBy("context_limit").agg(F.min_by(F.struct("docs_from", "tokens_from"), "n_tokens").alias("s"))
    total = sums.agg(F.coalesce(F.max("tokens_all"), F.lit(0)).alias("total"))
    cut = F.coalesce(F.col("s.tokens_from") - F.col("s.docs_from") * F.col("context_limit"), F.lit(0))
    return best.join(F.broadcast(total)).select("context_limit", "total", (F.col("total") - cut).alias("truncated_total"), F.coalesce("s.docs_from", F.lit(0)).alias("n_cut"))


def quantiles(sums: DataFrame, fractions: list[float]) -> DataFrame:
    """(fraction, n_tokens): the smallest length that at least this fraction of the documents do not exceed."""
    asked = F.broadcast(sums.sparkSession.createDataFrame([(float(x),) for x in fractions], "fraction double"))
    met = asked.join(sums.select("n_tokens", "docs_to", "n_all"), F.col("docs_to") >= F.col("fraction") * F.col("n_all"), "left")
    return met.groupBy("fraction").agg(F.min("n_tokens").alias("n_tokens"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: the sums and their carry both read the histogram, and must not encode the documents twice
    return suffix_sums(stored(length_histogram(documents(spark, sf_dir), vocabulary_path()), "histogram"))
