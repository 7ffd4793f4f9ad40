"""Rejection of languages never learned, the whole pipeline against brute force, and sets that share a template."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from trailcheck.llm import language_id, shingle_join
from trailcheck.llm.common import shared_dir
from trailcheck.llm.components import components

SYLLABLES = {"aa": "the and ing ter wood rain stone light ou th", "bb": "der und ung keit wald regen stein licht ch ei", "cc": "que les tion ment eau pluie bois é ai ou"}
NAMES = "doc_id bigint, text string, lang string, source string, n_chars int, `my col-x` struct<`a b`:int>, `row` string"


def prose(draw: random.Random, lang: str, n: int) -> str:
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))


def test_a_language_never_learned_is_rejected(spark):
    draw = random.Random(1)
    rows = [(k, prose(draw, lang, draw.choice([2, 5, 12, 40, 90])), lang) for k, lang in enumerate(["aa", "bb"] * 700)]
    strange = [(10_000 + k, prose(draw, "cc", 60), None) for k in range(200)] + [(20_000, "Ελληνικά λόγια " * 30, None), (20_001, "日本語 の 文章 " * 30, None)]
    table = spark.createDataFrame(rows + strange, "doc_id bigint, text string, lang string")
    model = language_id.train(table)
    assert all(s > 0 and f > 0 for s, f in model.thresholds)
    found = {r.doc_id: r for r in language_id.predict(table, model, ["doc_id"]).collect()}
    known = [found[i] for i, _, _ in rows]
    assert sum(r.rejected for r in known) <= len(known) // 500
    assert sum(found[i].rejected for i, _, _ in strange) >= 0.95 * len(strange)
    kept = language_id.accepted_documents(table, model)
    assert kept.columns == table.columns and kept.count() == sum(not r.rejected for r in found.values())


def table() -> list[tuple]:
    draw, out = random.Random(7), []
    shared = prose(draw, "aa", 60)
    for k in range(40):
        out.append((k, prose(draw, "aa" if k % 2 else "bb", draw.choice([3, 30, 80])), "aa" if k % 2 else "bb", f"s{k % 3}"))
    base = prose(draw, "bb", 120)
    for k in range(5):
        words = base.split()
        words[3 * k] = "edit"
        out.append((100 + k, " ".join(words), "bb", "hot"))
        out.append((200 + k, base.replace(" ", " \n"), "bb", "hot"))
        out.append((300 + k, f"{prose(draw, 'aa', 25)} {shared} {prose(draw, 'aa', 25)}", "aa", None))
    out += [(400, None, None, None), (401, "", "aa", "s1"), (402, "12 34", "aa", "s1"), (403, prose(draw, "aa", 20_000), "aa", "s2")]
    return [(i, t, lang, s, len(t or ""), (i % 5,), "r") for i, t, lang, s in out]


def stages_by_hand(rows: dict[int, str | None]) -> dict[int, str]:
    """What is left after language ID (letters; no band has enough scores here), exact dedup, shingle join and suffix dedup."""
    left = {i: t for i, t in rows.items() if t and any(c.isalpha() for c in t)}
    first: dict[str, int] = {}
    for i in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[i]), i)
    left = {i: left[i] for i in first.values()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in left.items() for w in [t.lower().split()]}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and group[b] < group[a]:
                    group[a], changed = group[b], True
    left = {i: t for i, t in left.items() if group[i] == i}
    seen, out = set(), {}
    for i in sorted(left):
        data = left[i].encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        if kept or not data:
            out[i] = kept.decode("utf-8", "ignore")
    return out


def test_whole_pipeline(spark, tmp_path):
    rows = table()
    spark.createDataFrame(rows, NAMES).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    docs, given = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        if name == "best_fit_packing":
            given = {r.doc_id: r for r in docs.collect()}
            break
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert {i: r.text for i, r in given.items()} == stages_by_hand({r[0]: r[1] for r in rows})
    assert all(r.n_chars == len(r.text) and r["my col-x"]["a b"] == i % 5 for i, r in given.items())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(given)
    bins, whole = defaultdict(int), Counter()
    for r in pieces:
        bins[r.bin_id] += r.n_tokens
        whole[r.doc_id] += 1
    assert max(bins.values()) <= 4096 and whole[403] > 1
    for box in bins:
        held = [given[r.doc_id].source for r in pieces if r.bin_id == box and given[r.doc_id].source]
        assert len(held) == len(set(held))


def test_full_pieces_have_bins_of_their_own(spark):
    from trailcheck.llm import packing

    rows = spark.createDataFrame([(1, 4096 * 3, "s", None, (1 << 62) + k) for k in range(3)], "id bigint, length bigint, source string, cluster bigint, row bigint")
    found = packing.pack(rows, "id", "length", "source", "cluster", "row").collect()
    assert len({r.bin_id for r in found}) == len(found) == 9


@pytest.mark.parametrize("n", [300])
def test_sets_that_share_a_template_never_meet(spark, n):
    """76 % of every set is shared by all, so none link; no pair is formed for the shingles that all have."""
    template = [f"t{k}" for k in range(380)]
    rows = [(k, " ".join(template + [f"u{k}_{j}" for j in range(116 + k % 7)])) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    at = shared_dir(spark, "template")
    told, packed = shingle_join.shingle_classes(docs, "doc_id", "text", at)
    from pyspark.sql import functions as F

    classes = told.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("least"), F.min("key").alias("key"), F.first("n").alias("n"))
    sets, _ = shingle_join.candidate_sets(docs, "doc_id", "text", classes, shingle_join.missing_counts(packed), at)
    none = spark.createDataFrame([], "a bigint, b bigint")
    open_rows = shingle_join._unsettled(sets, components(none, at, "none"), at)
    assert shingle_join._prefix_pairs(open_rows).count() == 0
    assert {r.component_id for r in shingle_join.linked_components(docs).collect()} == set(range(n))
