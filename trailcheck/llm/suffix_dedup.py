"""Removal of repeated byte strings by longest-previous-factor arrays (operator 6).

A byte goes if some string of ``LENGTH`` bytes that covers it starts earlier too: in a document of smaller id, or further
left in the same one.  Strings are judged on the input texts and never cross documents.  A document is an id with a text,
told by a hash of the text, which also orders the texts of one id.

*Anchors.*  The ``GRAM``-byte hash that is smallest among those inside a string is its anchor; equal strings have equal
anchors, and neighbouring starts share one, so a document falls into runs of starts of about 35 bytes, and
the strings of a run are a chunk of bytes.

1. Anchors are counted over the corpus.  Those met once need no further look; the others make a bitmap of fixed size.
2. Runs whose anchor passes the bitmap are grouped by chunk; copies collapse in each task before the shuffle.  All but
   the first run of a chunk go whole.  Hot chunks are pre-aggregated here, and the join back is one that Spark splits.
3. First runs whose anchor has several chunks are dealt by anchor, with their bytes.  A task puts the strings of its
   chunks in suffix order, takes the common prefixes of neighbours, and finds for every string the
   nearest neighbours to both sides that start earlier (previous and next smaller positions).  The longer of the two
   common prefixes is the longest previous factor; where it reaches ``LENGTH`` the string is a later copy.
   An anchor with more than ``HOT_CHUNKS`` chunks, such as a short line in very many documents, is not given to one
   task: its chunks are cut into pieces, and equal pieces are grouped, pre-aggregated in each task.
4. The spans of removed starts meet the texts of the documents that have any.

Defined cases: a null or empty text has nothing to remove; texts under ``LENGTH`` bytes stay whole; rows alike
in id and text are one document and all keep the same bytes; other texts under one id, or without an id, are documents of
their own; a null id comes before all others; very long texts
are whole (positions are 32-bit); an empty table gives an empty result; other columns are ignored, or kept as they are by ``without_repeats``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import delete, documents, fields, map_batches, maybe_among, shared_dir, ship, stored

LENGTH = 100
GRAM = 32
BITMAP_BITS = 1 << 25
HOT_CHUNKS = 100
PIECE = 8
TASK_CHUNKS = 4_000
NULL_ID = -(1 << 63)
_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def anchor_runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first start, last start) of every run of starts that share an anchor."""
    parts = []
    for at in range(0, max(0, len(text) - LENGTH + 1), _BLOCK - LENGTH):
        h = np.frombuffer(text, np.uint8, min(len(text) - at, _BLOCK - 1), at).astype(np.uint64) + np.uint64(1)
        size, factor = 1, _BASE
        while size < GRAM:  # hashes of twice as many bytes from those of neighbours
            h = h[:-size] * factor + h[size:]
            factor, size = np.uint64(int(factor) ** 2 % (1 << 64)), 2 * size
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        low = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
        window, size = LENGTH - GRAM + 1, 1
        while 2 * size <= window:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < window:
            low = np.minimum(low[: len(low) - (window - size)], low[window - size :])
        low = low[: _BLOCK - LENGTH]
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        place = (low[starts] & np.uint64(_BLOCK - 1)).astype(np.int64)
        ends = np.concatenate([starts[1:], [len(low)]]) - 1
        parts.append((h[place].view(np.int64), place + at, starts + at, ends + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def longest_previous(rows: np.ndarray, order_of: np.ndarray) -> np.ndarray:
    """Longest previous factor, up to the rows' width, of strings given as rows of bytes; order_of ranks their starts.

    In suffix order, the earlier start with the longest common prefix is the nearest smaller rank to the left or the
    right.  Pointers jump over larger ranks; a jump's common prefix is the least of those it passes.  Jumps end where
    the common prefix falls below the width, as shorter factors remove nothing.
    """
    n, width = rows.shape
    packed = np.ascontiguousarray(rows + np.uint8(1)).view(f"S{width}").ravel()  # no zero bytes: UTF-8 ends below 255
    order = np.argsort(packed, kind="stable")
    text, rank = rows[order], order_of[order]
    same = text[1:] == text[:-1]
    common = np.where(same.all(1), width, np.argmin(same, 1))  # of neighbours

    def nearest(rank: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Common prefix with the nearest smaller rank to the left; 0 without one."""
        to, length = np.arange(n) - 1, np.concatenate([[0], common])
        live = np.flatnonzero((to >= 0) & (length >= width))
        live = live[rank[to[live]] > rank[live]]
        while len(live):
            over = to[live]
            length[live] = np.minimum(length[live], length[over])
            to[live] = to[over]
            live = live[(to[live] >= 0) & (length[live] >= width)]
            live = live[rank[to[live]] > rank[live]]
        return np.where((to >= 0) & (rank[np.maximum(to, 0)] < rank), length, 0)

    found = np.maximum(nearest(rank, common), nearest(rank[::-1], common[::-1])[::-1])
    out = np.empty(n, np.int64)
    out[order] = found
    return out


def _document(id_col: str, text_col: str) -> list[Column]:
    """(doc, told): the id and the hash of the text, which together name a document."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("told")]


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(*_document(id_col, text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Words of the bitmap of the column ``h``: a fixed number, whatever the number of keys."""
    cell = F.pmod(F.col("h"), F.lit(BITMAP_BITS))
    words = keys.select(F.shiftright(cell, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(h, {BITMAP_BITS}L) & 63 as int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def _passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    cell = h.view(np.uint64) & np.uint64(BITMAP_BITS - 1)
    return (bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def _each_text(rows: DataFrame, schema: str, take: Callable[[int, int, bytes], dict | None]) -> DataFrame:
    """Rows that ``take`` makes of every text of at least ``LENGTH`` bytes, gathered into batches of bounded size."""
    names = [x.split()[0] for x in schema.split(", ")]

    def make():
        def each(batch: pa.RecordBatch):
            out, held = {k: [] for k in names}, 0
            for doc, told, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (found := take(doc, told, text.as_py())) is not None:
                    for k in names:
                        out[k].append(found[k])
                    held += len(found[names[0]])
                if held > 50_000:
                    yield _joined(out)
                    out, held = {k: [] for k in names}, 0
            if held:
                yield _joined(out)

        return each

    return map_batches(rows.where(F.octet_length("text") >= LENGTH), schema, make)


def _joined(out: dict[str, list]) -> dict:
    return {k: np.concatenate(v) if isinstance(v[0], np.ndarray) else [x for some in v for x in some] for k, v in out.items()}


def repeated_starts(df: DataFrame, id_col: str, text_col: str, at: str) -> DataFrame:
    """(doc, told, first, last): ranges of starts whose string of ``LENGTH`` bytes also starts earlier."""
    import xxhash

    spark, rows = df.sparkSession, _rows(df, id_col, text_col)
    ship(spark)
    met = _each_text(rows, "h long", lambda doc, told, text: {"h": anchor_runs(text)[0]})
    several = met.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    seen = spark.sparkContext.broadcast(_bitmap(several))

    def runs(doc: int, told: int, text: bytes) -> dict | None:
        h, place, first, last = anchor_runs(text)
        some = _passes(seen.value, h)
        if not some.any():
            return None
        h, place, first, last = h[some], place[some], first[some], last[some]
        digest = xxhash.xxh3_64_intdigest
        chunks = [digest(text[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())]
        return {"h": h, "chunk": np.array(chunks, np.uint64).view(np.int64), "shape": ((place - first) * 128 + (last - first) % 128).astype(np.int32),
                "doc": np.full(len(h), doc), "told": np.full(len(h), told), "first": first.astype(np.int32), "last": last.astype(np.int32)}

    found = stored(_each_text(rows, "h long, chunk long, shape int, doc long, told long, first int, last int", runs), "runs", at)
    key = ["h", "chunk", "shape"]
    classes = stored(found.groupBy(*key).agg(F.min(F.struct("doc", "told", "first")).alias("lead"), F.count(F.lit(1)).alias("n")), "chunks", at)
    copies = found.join(classes.where("n > 1").select(*key, "lead"), key).where(F.struct("doc", "told", "first") != F.col("lead")).select("doc", "told", "first", "last")
    several = stored(classes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "anchors", at)
    open_ = spark.sparkContext.broadcast(_bitmap(several.select("h")))

    def chunks(doc: int, told: int, text: bytes) -> dict | None:
        h, place, first, last = anchor_runs(text)
        some = _passes(open_.value, h)
        if not some.any():
            return None
        first, last = first[some], last[some]
        return {"h": h[some], "shape": (place[some] - first).astype(np.int32), "doc": np.full(len(first), doc), "told": np.full(len(first), told), "first": first.astype(np.int32),
                "bytes": [text[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())]}

    pieces = _each_text(rows, "h long, shape int, doc long, told long, first int, bytes binary", chunks)
    firsts = pieces.groupBy("h", "shape", "bytes").agg(F.min(F.struct("doc", "told", "first")).alias("lead"))
    firsts = stored(firsts.join(several, "h").select("h", "n", "shape", "bytes", "lead.doc", "lead.told", "lead.first"), "first-chunks", at)
    for more in (_by_suffix_order(firsts.where(F.col("n") <= HOT_CHUNKS)), *_by_pieces(firsts.where(F.col("n") > HOT_CHUNKS), at)):
        copies = copies.unionByName(more)
    return copies


def _windows(pieces: list[bytes], firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of the chunks as rows of bytes, with chunk and start of each."""
    sizes = np.array([len(x) for x in pieces])
    text = np.frombuffer(b"".join(pieces), np.uint8)
    count = sizes - LENGTH + 1
    base = np.repeat(np.cumsum(sizes) - sizes, count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.lib.stride_tricks.sliding_window_view(text, LENGTH)[base + inside], np.repeat(np.arange(len(pieces)), count), np.repeat(firsts, count) + inside


def _spans(docs: np.ndarray, told: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
    """Starts as ranges of neighbouring ones."""
    order = np.lexsort((starts, told, docs))
    docs, told, starts = docs[order], told[order], starts[order]
    new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (told[1:] != told[:-1]) | (starts[1:] > starts[:-1] + 1)])) if len(docs) else np.zeros(0, np.int64)
    last = np.concatenate([new[1:], [len(docs)]]) - 1 if len(new) else new
    return pd.DataFrame({"doc": docs[new], "told": told[new], "first": starts[new].astype(np.int32), "last": starts[last].astype(np.int32)})


def _by_suffix_order(firsts: DataFrame) -> DataFrame:
    shards = max(1, -(-firsts.count() // TASK_CHUNKS))

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h", kind="stable")
        h = pdf["h"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        out, pieces, docs, told, starts = [], pdf["bytes"].tolist(), pdf["doc"].to_numpy(), pdf["told"].to_numpy(), pdf["first"].to_numpy().astype(np.int64)
        a = 0
        while a < len(pdf):  # some anchors at a time: bounds the rows of bytes held at once
            b = cuts[cuts > a + 800]
            b = int(b[0]) if len(b) else len(pdf)
            rows, owner, start = _windows(pieces[a:b], starts[a:b])
            doc, text = docs[a:b][owner], told[a:b][owner]
            rank = np.empty(len(doc), np.int64)
            rank[np.lexsort((start, text, doc))] = np.arange(len(doc))
            gone = longest_previous(rows, rank) >= LENGTH
            out.append(_spans(doc[gone], text[gone], start[gone]))
            a = b
        return pd.concat(out)

    return firsts.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard").applyInPandas(find, "doc long, told long, first int, last int")


def _by_pieces(firsts: DataFrame, at: str) -> list[DataFrame]:
    """Ranges of later copies among the chunks of hot anchors, by pieces of ``PIECE`` starts and then of one.

    A piece holds the starts whose distance to the anchor lies in one block, so equal pieces are dealt alike whatever
    surrounds them.  All but the first of equal pieces go whole.  The strings of a block have most of their bytes in
    common; first pieces that share those with another first piece are cut into single starts.
    """
    found, rows = [], firsts.select("h", F.col("shape").alias("off"), "doc", "told", "first", "bytes")
    schema = "h long, off int, doc long, told long, first int, bytes binary"
    if rows.isEmpty():
        return found
    for size in (PIECE, 1):
        def make(size: int = size):
            def each(batch: pa.RecordBatch):
                for at in range(0, batch.num_rows, 2_000):
                    out = {k: [] for k in ("h", "off", "doc", "told", "first", "bytes")}
                    part = batch.slice(at, 2_000)
                    for h, off, doc, told, first, text in zip(*(part.column(k).to_pylist() for k in range(6))):
                        a, n = 0, len(text) - LENGTH + 1
                        while a < n:  # starts a to b - 1 lie in one block of distances to the anchor
                            b = min(n, off - (off - a) // size * size + 1)
                            for k, v in zip(out, (h, off - a, doc, told, first + a, text[a : b - 1 + LENGTH])):
                                out[k].append(v)
                            a = b
                    yield out

            return each

        pieces = stored(map_batches(rows, schema, make), f"pieces-{size}", at)
        leads = pieces.groupBy("h", "off", "bytes").agg(F.min(F.struct("doc", "told", "first")).alias("lead"), F.count(F.lit(1)).alias("n"))
        later = pieces.join(leads.where("n > 1"), ["h", "off", "bytes"]).where(F.struct("doc", "told", "first") != F.col("lead"))
        found.append(later.select("doc", "told", "first", (F.col("first") + F.octet_length("bytes") - LENGTH).alias("last")))
        block = F.floor(F.col("off") / size)
        common = F.expr(f"substring(bytes, cast(off - off div {size} * {size} + 1 as int), {LENGTH - size + 1})")
        alike = leads.select("h", "off", "lead.doc", "lead.told", "lead.first", "bytes", block.alias("block"), common.alias("common"))
        rows = alike.join(alike.groupBy("h", "block", "common").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), ["h", "block", "common"]).select("h", "off", "doc", "told", "first", "bytes")
    return found


def removed_spans(starts: DataFrame) -> DataFrame:
    """(doc, told, spans): the maximal removed byte ranges [start, end) of every document that has any."""
    return starts.distinct().groupBy("doc", "told").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("starts"))


def _merged(starts: list[dict]) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for x in starts:
        a, b = x["first"], x["last"] + LENGTH
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])]


def _with_spans(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(row, text, starts) of documents with removed starts, and the rows of the others."""
    at = shared_dir(df.sparkSession, "suffix-dedup")
    steps = f"{at}/steps"
    spans = stored(removed_spans(repeated_starts(df, id_col, text_col, steps)), "spans", at)
    delete(df.sparkSession, steps)  # runs, chunks and pieces: the spans hold all that they gave
    held = df.select(F.struct("*").alias("row"), *_document(id_col, text_col)).withColumn("key", F.xxhash64("doc", "told"))
    flagged = maybe_among(held, "key", spans.select(F.xxhash64("doc", "told").alias("key")))
    met = flagged.where("__maybe").join(spans, ["doc", "told"], "left")
    return met.select("row", F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"), "starts"), flagged.where("not __maybe").select("row")


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans, kept) of every row: removed byte ranges and the remaining bytes."""
    met, clear = _with_spans(df.select(id_col, text_col), id_col, text_col)
    row = f"row.`{id_col}`"

    def make():
        def each(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts, spans = part.column(1).to_pylist(), [_merged(x or []) for x in part.column(2).to_pylist()]
                yield {"doc_id": part.column(0), "spans": [[{"start": a, "end": b} for a, b in s] for s in spans], "kept": [b"".join(_kept(t, s)) for t, s in zip(texts, spans)]}

        return each

    cut = map_batches(met.select(F.col(row).cast("long"), "text", "starts"), "doc_id long, spans array<struct<start: int, end: int>>, kept binary", make)
    none = F.array().cast("array<struct<start: int, end: int>>")
    return cut.unionByName(clear.select(F.col(row).cast("long").alias("doc_id"), none.alias("spans"), F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("kept")))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """``df`` with the removed bytes cut out of its texts; documents of which nothing is left go.

    A character that a cut splits goes with it.  ``size_col`` is set to the new number of code points.
    """
    met, clear = _with_spans(df, id_col, text_col)

    def make():
        def each(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                spans = [_merged(x or []) for x in part.column(2).to_pylist()]
                texts = ["".join(x.decode("utf-8", "ignore") for x in _kept(t, s)) for t, s in zip(part.column(1).to_pylist(), spans)]
                yield {"row": part.column(0), "cut": texts, "touched": [bool(s) for s in spans]}

        return each

    cut = map_batches(met, fields(met, ["row"], "cut string, touched boolean"), make).where("not touched or cut != ''")
    new = {text_col: F.when(F.col("touched"), F.col("cut")).otherwise(F.col(f"row.`{text_col}`"))}
    if size_col:
        new[size_col] = F.when(F.col("touched"), F.char_length("cut")).otherwise(F.col(f"row.`{size_col}`")).cast(df.schema[size_col].dataType)
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in df.columns]).unionByName(clear.select("row.*"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(documents(spark, sf_dir))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))
    return out.select("doc_id", (F.octet_length("kept") + lost).alias("n_bytes"), lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
