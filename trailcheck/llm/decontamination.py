"""Benchmark decontamination by a broadcast hash set of normalised test n-grams (operator 12).

The words of a text are its runs of digits, ASCII letters (lower-cased) and characters beyond ASCII.  A window is
``WINDOW`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.  The windows are
hashed into a set which is broadcast with the words that occur in it; every document is scanned once: its words become
numbers of those words (0: not among them), the rolling hash of each run of words is looked up in a bitmap and then in
the set, and what is found there is verified word by word.  Hits are spans of words; they can be cut out of the text,
or the document dropped.

Size of the broadcast: the pairs of window and item are counted first.  At most ``PASS_PAIRS`` of them are broadcast at
a time; a larger benchmark is dealt into as many parts by a hash, and every part scans the documents that the part
before returned with its hits, so no rows are shuffled and no window is left out.

Defined cases: a null text has no words; an item without words has no windows; items with the same text are all hit;
an item given twice counts once; a null item_id is the empty text; repeated documents are scanned each; very long texts
are scanned whole; an empty benchmark hits nothing; an empty table gives an empty result; the documents' other columns
pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import documents, fields, map_batches, shared_dir, stored

WINDOW = 10
PASS_PAIRS = 400_000
BITMAP_BITS = 22
#: Bytes of words stay, letters in lower case; all others end a word.  Bytes of characters beyond ASCII stay too.
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class WindowSet:
    """Windows by length: sorted hashes, their word numbers, and the items of each; the numbers of the words."""

    vocabulary: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    items: list[str]
    bitmap: np.ndarray


def _hashes(numbers: np.ndarray, length: int) -> np.ndarray:
    """Rolling hash of each run of ``length`` numbers."""
    n = len(numbers) - length + 1
    out = np.zeros(n, np.uint64)
    x = numbers.astype(np.uint64)
    for k in range(length):
        out *= _MULTIPLIER
        out += x[k : k + n]
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIER
    return out ^ (out >> np.uint64(32))


def window_set(rows: list[tuple[bytes, str]]) -> WindowSet:
    """The set of the windows (words joined by a space) in ``rows``, with their items."""
    vocabulary: dict[bytes, int] = {}
    place = {x: k for k, x in enumerate(sorted({item for _, item in rows}))}
    having: dict[bytes, set[int]] = {}
    for window, item in rows:
        having.setdefault(window, set()).add(place[item])
    grouped: dict[int, list[tuple[list[int], set[int]]]] = {}
    for window, items in having.items():
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in window.split(b" ")]
        grouped.setdefault(len(numbers), []).append((numbers, items))
    by_length, bitmap = {}, np.zeros(1 << BITMAP_BITS, bool)
    for length, some in grouped.items():
        grams = np.array([numbers for numbers, _ in some], np.int32)
        hashes = np.array([_hashes(g, length)[0] for g in grams], np.uint64)
        order = np.argsort(hashes, kind="stable")
        sizes = np.array([len(some[k][1]) for k in order], np.int64)
        by_length[length] = (hashes[order], grams[order], np.concatenate([[0], np.cumsum(sizes)]), np.array([i for k in order for i in sorted(some[k][1])], np.int64))
        bitmap[hashes >> np.uint64(64 - BITMAP_BITS)] = True
    return WindowSet(vocabulary, by_length, sorted(place), bitmap)


def hits(numbers: np.ndarray, known: WindowSet) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans [start, end) of words that windows cover, and the items of those windows."""
    covered, found = np.zeros(len(numbers) + 1, np.int32), set()
    for length, (hashes, grams, starts, items) in known.by_length.items():
        if len(numbers) < length:
            continue
        h = _hashes(numbers, length)
        at = np.flatnonzero(known.bitmap[h >> np.uint64(64 - BITMAP_BITS)])
        if not len(at):
            continue
        low, high = np.searchsorted(hashes, h[at], "left"), np.searchsorted(hashes, h[at], "right")
        while len(at := at[keep := low < high]):  # further windows of equal hash, if any
            low, high = low[keep], high[keep]
            equal = (grams[low] == numbers[at[:, None] + np.arange(length)]).all(1)
            np.add.at(covered, at[equal], 1)
            np.add.at(covered, at[equal] + length, -1)
            for k in np.unique(low[equal]):
                found.update(items[starts[k] : starts[k + 1]].tolist())
            low = low + 1
    inside = np.diff(np.concatenate([[0], (np.cumsum(covered[:-1]) > 0).astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist())), found


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """Distinct pairs of window (its words joined by a space) and item."""

    def make():
        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            for item, text in zip(batch.column(0), batch.column(1)):
                words, name = words_of(text.as_py() or b""), item.as_py() or ""
                if words:
                    grams = list({b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))})
                    yield {"window": grams, "item": [name] * len(grams)}

        return each

    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string").cast("binary"))
    return map_batches(rows, "window binary, item string", make).distinct()


def _scan(rows: DataFrame, known: WindowSet, go_on: bool) -> DataFrame:
    """row, n_words and the spans and items of ``rows`` grown by what ``known`` finds; the text too where more is to come."""
    held = rows.sparkSession.sparkContext.broadcast(known)  # at most PASS_PAIRS pairs

    def make():
        m = held.value
        number = m.vocabulary.get

        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            out = {"n_words": [], "spans": [], "items": []}
            for text, spans, items in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text.as_py() or b"")
                numbers = np.fromiter((number(w, 0) for w in words), np.int32, len(words))
                new, found = hits(numbers, m) if len(words) else ([], set())
                out["n_words"].append(len(words))
                out["spans"].append(_merged([*spans, *({"start": a, "end": b} for a, b in new)]))
                out["items"].append(sorted({*items, *(m.items[i] for i in found)}))
            yield {"row": batch.column(0), "text": batch.column(1), **out}

        return each

    kept = ["row", "text"] if go_on else ["row"]
    schema = fields(rows, kept, "n_words long, spans array<struct<start:int,end:int>>, items array<string>")
    return map_batches(rows.select("row", "text", "spans", "items"), schema, make)


def _merged(spans: list[dict]) -> list[dict]:
    """Spans in order, those that touch or overlap as one."""
    out: list[dict] = []
    for x in sorted(spans, key=lambda s: s["start"]):
        if out and x["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], x["end"])
        else:
            out.append(dict(x))
    return out


def scanned(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
            keep: list[str] | None = None, window: int = WINDOW, pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """row (a struct of the columns ``keep``, all by default, so no names clash), n_words, spans, items.

    The spans are those of the words that benchmark windows cover; the items are the sorted ids of the items hit.
    """
    pairs = stored(benchmark_windows(benchmark, item_col, item_text_col, window), "windows", shared_dir(df.sparkSession, "benchmark"))
    parts = max(1, -(-pairs.count() // pass_pairs))
    out = df.select(F.struct(*(F.col(f"`{c}`") for c in (keep or df.columns))).alias("row"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for k in range(parts):
        part = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == k).collect()  # about pass_pairs rows
        out = _scan(out, window_set([(bytes(r.window), r.item) for r in part]), k + 1 < parts)
    return out


def without_spans(found: DataFrame, text_col: str) -> DataFrame:
    """Rows of ``scanned`` with the column clean: the text without the words hit and what stands between them."""

    def make():
        def each(batch: pa.RecordBatch) -> Iterator[dict]:
            clean = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py()
                if spans:
                    at = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
                    for x in reversed(spans):
                        data = data[: at[x["start"]][0]] + data[at[x["end"] - 1][1] :]
                clean.append(None if data is None else data.decode("utf-8", "replace"))
            yield {"row": batch.column(0), "clean": clean}

        return each

    rows = found.select("row", F.col("row").getField(text_col).cast("string").cast("binary"), "spans")
    return map_batches(rows, fields(found, ["row"], "clean string"), make)


def uncontaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", cut_spans: bool = False, **names: str) -> DataFrame:
    """The rows of ``df``: those without a hit, or with ``cut_spans`` all of them with their hits cut out of the text."""
    found = scanned(df, benchmark, text_col, **names)
    if not cut_spans:
        return found.where(F.size("spans") == 0).select("row.*")
    cut = without_spans(found, text_col)
    return cut.select(*(F.col("clean").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scanned(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


_WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH i AS (SELECT DISTINCT coalesce(cast(item_id AS varchar), '') AS item, {_WORDS_SQL} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS gram
      FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS k FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS_SQL} AS w FROM documents),
r AS (SELECT rn, size, k, array_to_string(w[k:k + size - 1], ' ') AS gram
      FROM (SELECT rn, w, size, unnest(generate_series(1, len(w) - size + 1)) AS k FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size)),
h AS (SELECT DISTINCT rn, size, k, item FROM r JOIN g USING (size, gram)),
n AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(generate_series(k, k + size - 1)) AS p FROM h) GROUP BY rn),
t AS (SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rn, item FROM h) GROUP BY rn)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rn) LEFT JOIN t USING (rn)
"""
