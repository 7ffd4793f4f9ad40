"""Hard-negative mining with cover trees over norm-augmented candidates (operator 13).

An anchor's positives are the ``K`` highest inner products among the other rows of its label; for each of them its
negatives are the highest products of other labels inside the window [``FLOOR`` % of the positive's, the positive's].

Candidates are quantised, written once, and dealt by label and a salt, so that a hot label spreads; every task builds
cover trees over up to ``TREE_ROWS`` rows of one label as they stream by (``cover_tree``).  Positives ask only the trees of
their label, negatives only those of other labels.  The anchors are a stated query set: they are taken in blocks of at
most ``BLOCK_BYTES``, each broadcast to all tasks, so a block's size is bounded whatever the table's.  A tree's best-first
descent leaves out nodes whose bounds miss the windows, or what the task has already found for an anchor.  Each task
returns at most K rows a window; Spark ranks those of all tasks.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; shorter vectors count
as zero in the components that they lack, so a vector without components scores 0; a positive with a score below 0 has
an empty window; ties go to the smaller id, null ids last; a null id is no anchor; a row given twice is two rows, and the
copy of an anchor is a row other than the anchor; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailcheck.llm.common import map_batches, shared_dir, stored
from trailcheck.llm.cover_tree import CoverTree

K = 5
FLOOR = 80
TREE_ROWS = 4_096
BLOCK_BYTES = 16 << 20
SALTS = 64
LEAST, MOST = -(1 << 62), 1 << 62


def _ranked(window: np.ndarray, score: np.ndarray, row: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of every window: higher scores first, then smaller ids."""
    order = np.lexsort((row, ident, -score, window))
    w = window[order]
    start = np.concatenate([[True], w[1:] != w[:-1]])
    rank = np.arange(len(w)) - np.maximum.accumulate(np.where(start, np.arange(len(w)), 0))
    return order[rank < k]


class _Best:
    """The k best entries of every window so far; ``low`` is the least score that can still enter."""

    def __init__(self, low: np.ndarray, k: int) -> None:
        self.low, self.k, self.held, self.late = low.copy(), k, [np.zeros(0, np.int64)] * 4, []
        self.waiting = 0

    def add(self, window: np.ndarray, score: np.ndarray, row: np.ndarray, ident: np.ndarray) -> None:
        self.late.append((window, score, row, ident))
        self.waiting += len(window)
        if self.waiting > 4 * self.k * len(self.low):
            self.settle()

    def settle(self) -> None:
        if not self.late:
            return
        all_ = [np.concatenate(x) for x in zip(self.held, *self.late)]
        best = _ranked(*all_, self.k)
        self.held, self.late, self.waiting = [x[best] for x in all_], [], 0
        last = self.held[0][self.k - 1 :]
        full = last == self.held[0][: len(last)]  # k entries of one window
        window, score = last[full], self.held[1][self.k - 1 :][full]
        self.low[window] = np.maximum(self.low[window], score)


def _search(candidates: DataFrame, block: dict[str, np.ndarray], radius: float, width: int, same_label: bool) -> DataFrame:
    """window (number in the block), score, vec_id of the K best candidates of every window, by task."""
    held = candidates.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_BYTES of vectors
    none = MOST

    def make():
        b = held.value
        norms = np.sqrt((b["vectors"] ** 2).sum(1))
        best = _Best(b["low"], K)
        label, rows = None, []

        def tree() -> None:
            """Search the tree over the rows gathered."""
            if not rows:
                return
            which = np.flatnonzero((b["label"] == label) if same_label else (b["label"] != label))
            if len(which):
                vectors = np.zeros((len(rows), width))
                for k, (_, _, v) in enumerate(rows):
                    vectors[k, : len(v)] = v
                row, ident = (np.array([x[i] for x in rows], np.int64) for i in (0, 1))
                low, high = best.low[which], b["high"][which]

                def take(members: np.ndarray, queries: np.ndarray, scores: np.ndarray) -> None:
                    of = which[queries]
                    good = (scores >= best.low[of][:, None]) & (scores <= b["high"][of][:, None]) & (row[members][None, :] != b["row"][of][:, None])
                    q, m = np.nonzero(good)
                    if len(q):
                        best.add(of[q], scores[q, m], row[members][m], ident[members][m])
                        low[:] = best.low[which]

                CoverTree(vectors, radius).search(b["vectors"][which], norms[which], low, high, take)
                best.settle()
            rows.clear()

        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            nonlocal label
            vectors = batch.column(3)
            for k, (row, ident, of) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                if rows and (of != label or len(rows) >= TREE_ROWS):
                    tree()
                label = of
                rows.append((row, none if ident is None else ident, vectors[k].values.to_numpy()))
            yield from ()

        def end() -> Iterator[dict]:
            tree()
            window, score, _, ident = best.held
            yield {"window": window, "score": score, "vec_id": [None if x == none else x for x in ident.tolist()]}

        each.end = end
        return each

    return map_batches(candidates.select("row", "vec_id", "label", "v"), "window long, score long, vec_id long", make)


def _first(found: DataFrame, *keys: str) -> DataFrame:
    """Rows with rank (from 1), the first K of every key: higher scores first, then smaller ids."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)


def hard_negatives(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; the vectors are arrays of whole numbers.

    ``anchor`` tells the anchors by the columns of ``df``.
    """
    spark = df.sparkSession
    at = shared_dir(spark, "negatives")
    named = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), anchor.alias("is_anchor"))
    named = named.where("label IS NOT NULL AND v IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("vec_id", "v"), F.lit(SALTS)))
    dealt = named.repartition("label", "salt").sortWithinPartitions("label", "salt", "vec_id")
    rows = stored(dealt.withColumn("row", F.monotonically_increasing_id()), "candidates", at)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    size = rows.agg(F.max(square).alias("square"), F.max(F.size("v")).alias("width"), F.count_if("is_anchor").alias("anchors")).first()
    radius, width = float(size["square"] or 0) ** 0.5, size["width"] or 0
    blocks = max(1, -(-(size["anchors"] or 0) * 8 * (width + 1) // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("row"), F.lit(blocks))
    asking = rows.where("is_anchor AND vec_id IS NOT NULL")

    def block_of(found: list) -> dict[str, np.ndarray]:
        vectors = np.zeros((len(found), width))
        for k, r in enumerate(found):
            vectors[k, : len(r["v"])] = r["v"]
        return {"vectors": vectors, "label": np.array([r["label"] for r in found], np.int64), "row": np.array([r["row"] for r in found], np.int64)}

    out = None
    for k in range(blocks):
        anchors = sorted(asking.where(part == k).collect(), key=lambda r: r["row"])  # a block of bounded size
        block = block_of(anchors)
        n = len(anchors)
        block |= {"low": np.full(n, LEAST), "high": np.full(n, MOST)}
        positives = _first(_search(rows, block, radius, width, True), "window")
        best = positives.select("window", "rank", "score", "vec_id").collect()  # at most K an anchor of the block
        asked = sorted((r["window"], r["rank"], r["score"], r["vec_id"]) for r in best if r["score"] >= 0)
        of = np.array([w for w, *_ in asked], np.int64)
        score = [s for _, _, s, _ in asked]
        windows = {"vectors": block["vectors"][of], "label": block["label"][of], "row": block["row"][of],
                   "low": np.array([-(-FLOOR * s // 100) for s in score], np.int64), "high": np.array(score, np.int64)}
        negatives = _first(_search(rows, windows, radius, width, False), "window")
        names = [(i, anchors[w]["vec_id"], p, s) for i, (w, _, s, p) in enumerate(asked)]
        told = spark.createDataFrame(names, "window long, anchor_id long, positive_id long, positive_score long")
        met = negatives.join(F.broadcast(told), "window").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                                                                 "positive_score", F.col("score").alias("negative_score"))
        done = stored(met, f"block-{k}", at)
        out = done if out is None else out.unionByName(done)
    return out


def quantised(vector: Column) -> Column:
    """Whole numbers floor(256 * x) of the components as doubles; null where a component is null or not finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False))), F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = given.select("vec_id", label.alias("label"), quantised(F.col("embedding")).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
