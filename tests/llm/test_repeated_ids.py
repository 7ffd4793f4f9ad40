"""Rows given twice, several texts under one id and texts without an id: each text is judged by itself."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailcheck.llm import packing, suffix_dedup
from trailcheck.llm.common import stored
from trailcheck.llm.shingle_join import first_of_each, linked_components

DDL = "doc_id bigint, text string, source string, n_chars int"


def words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, len(t or "")) for i, t in rows], DDL).repartition(3).cache()


def edited(text: list[str]) -> list[str]:
    return [*text[:-1], "edited"]


def test_shingle_join_takes_one_set_a_class(spark):
    shared = words(1, 100)  # A and B have half of their shingles in common
    a, b, c = shared + words(2, 80), shared + words(3, 80), words(4, 150)
    texts = {k: " ".join(t) for k, t in {"a": a, "a2": edited(a), "b": b, "b2": edited(b), "c": c, "c2": edited(c), "d": words(5, 50)}.items()}
    # id 20 has a near copy of A and a text of its own; C has no id, and its near copies have one and none
    rows = [(10, "a"), (10, "a"), (11, "a2"), (12, "b"), (12, "b"), (13, "b2"), (20, "a2"), (20, "d"), (None, "c"), (None, "c"), (30, "c2")]
    expected = {"a": 10, "a2": 10, "b": 12, "b2": 12, "c": 30, "c2": 30, "d": 20}
    docs = table(spark, [(i, texts[k]) for i, k in rows])
    key = lambda r: tuple(-1 if x is None else x for x in r)
    found = sorted(((r.id, r.component_id) for r in linked_components(docs).collect()), key=key)
    assert found == sorted(((i, expected[k]) for i, k in rows), key=key)
    kept = sorted((r.doc_id, r.text) for r in first_of_each(docs).collect())
    assert kept == sorted((i, texts[k]) for i, k in rows if i == expected[k])


@pytest.mark.parametrize("hot", [1, 10_000])
def test_suffix_dedup_cuts_only_the_text_it_looked_at(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CHUNKS", hot)
    text = lambda seed, n: " ".join(words(seed, n))
    passage = text(11, 40)
    rows = [(None, "a" * 3000), (None, text(12, 500)), (None, passage + text(13, 30)), (None, text(14, 7) + passage), (5, "b" * 2000 + text(15, 20)),
            (5, text(16, 400)), (5, text(16, 400)), (6, text(17, 9) + passage), (7, text(18, 50)), (7, text(18, 50) + text(19, 50))]
    docs = table(spark, rows)
    hashed = {r.text: r.told for r in docs.select("text", F.xxhash64("text").alias("told")).collect()}
    seen, expected = set(), {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]])):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        expected[i, t] = bytes(np.frombuffer(raw, np.uint8)[~gone])
    assert sum(passage.encode() in x for x in expected.values()) == 1
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    found = sorted(((r.doc_id, bytes(r.kept)) for r in suffix_dedup.removed(docs).collect()), key=key)
    assert found == sorted(((i, expected[i, t]) for i, t in rows), key=key)
    left = sorted(((r.doc_id, r.text.encode()) for r in suffix_dedup.without_repeats(docs, size_col="n_chars").collect()), key=key)
    assert left == [x for x in found if x[1]]


def test_full_pieces_of_every_row_have_bins_of_their_own(spark):
    long, other = " ".join(words(21, 4000)), " ".join(words(22, 4000))
    found = packing.pack_documents(table(spark, [(None, long), (None, other), (1, long), (1, long), (2, None)])).collect()
    bins = Counter()
    for r in found:
        bins[r.bin_id] += r.n_tokens
    full = [r for r in found if r.n_tokens == packing.CAPACITY]
    assert len(full) >= 8 and max(bins.values()) <= packing.CAPACITY
    assert Counter(r.bin_id for r in full).most_common(1)[0][1] == 1


def test_rows_alike_spread_over_the_shards(spark):
    rows = spark.range(2_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("source"),
                                     F.lit(None).cast("long").alias("cluster"), F.col("id").alias("row"))
    out = packing.pack(stored(rows, "alike"), "doc_id", "n", "source", "cluster", "row", shard_rows=100)
    shards = Counter(int(r.bin_id) >> 32 for r in out.collect())  # a decimal, as numbers of full pieces need
    assert sum(shards.values()) == 2_000 and len(shards) == 20 and max(shards.values()) < 200
