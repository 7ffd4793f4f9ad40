"""Conversation repair, decontamination and hard negatives against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from trailcheck.llm import conversation_repair, decontamination, hard_negatives
from trailcheck.llm.queries import QUERIES

WHITE = r"[\x20\x09-\x0D]"


def conversations() -> list[tuple]:
    draw, out = random.Random(3), []
    texts = ["yes.", "no!", "why?", "cut off", "  ", "", "a\n.", "long " * 30 + ".", None]
    for conv in range(90):
        turn = 0
        for _ in range(draw.randint(1, 7)):
            out.append((conv, turn, draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), draw.choice(texts) if draw.random() < 0.6 else f"t{turn} of {conv}."))
            turn += draw.choice([1, 1, 1, 2])
    out += [(None, 0, "user", "who?"), (None, 1, "assistant", "me."), (200, None, "user", "x."), (200, None, "user", "x."), (200, 4, "assistant", "y."), (201, 3, "user", None), (202, 0, "user", "same."), (202, 0, "user", "same.")]
    out += [(300, t, "user" if t % 2 else "assistant", f"turn {t % 40}" + "." * (t % 3)) for t in range(700)]
    return out


def damaged(rows: list[tuple]) -> dict:
    out = defaultdict(list)
    text = lambda x: " " if x is None else str(x)
    for conv, turn, role, body in rows:
        role, body, fault = text(role), text(body), zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        some = out[conv]
        if fault:
            body = "" if fault == 1 else re.sub("[.!?]", "", body) if fault == 2 else body
            some.extend([(turn, "user" if fault == 4 else role, body)] * (2 if fault == 3 else 1))
    return out


def repaired(rows: list[tuple]) -> tuple:
    """By relaxing (cost, audit) of every (place, state) from the front until nothing gets lighter."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, body in rows:
        solid = re.sub(WHITE, "", body)
        faults.append("b" if not solid else "d" if (role, body) in seen else "." if solid[-1] in ".!?" else "t")
        seen.add((role, body))
    best = {(0, ""): (0, "", ())}
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    for place in range(len(rows) + 1):
        for _ in range(3):  # inserts
            for state in ("", "s", "u", "a"):
                if (place, state) in best:
                    cost, audit, made = best[place, state]
                    for c, to in step[state].items():
                        if c != "s":
                            new = (cost + 3, audit + "I", (*made, ("user" if c == "u" else "assistant", "")))
                            if (place, to) not in best or new < best[place, to]:
                                best[place, to] = new
        if place == len(rows):
            break
        _, role, body = rows[place]
        for state in ("", "s", "u", "a"):
            if (place, state) not in best:
                continue
            cost, audit, made = best[place, state]
            news = [(state, (cost + 4, audit + "D", made))]
            if faults[place] in ".t":
                more = cost + 3 * (faults[place] == "t")
                for c, to in step[state].items():
                    if role[:1] == c:
                        news.append((to, (more, audit + "K", (*made, (role, body)))))
                    if c != "s":
                        news.append((to, (more + 3, audit + "R", (*made, ("user" if c == "u" else "assistant", body)))))
            for to, new in news:
                if (place + 1, to) not in best or new < best[place + 1, to]:
                    best[place + 1, to] = new
    cost, audit, made = min(best[len(rows), s] for s in ("", "a") if (len(rows), s) in best)
    turns = [t for t, *_ in rows if t is not None]
    pairs = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(c) for c in "bdt"), pairs, cost, audit, hashlib.sha256("\n".join(f"{r}:{b}" for r, b in made).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("segment", [conversation_repair.SEGMENT, 3])
def test_conversation_repair(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rows = conversations()
    spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    expected = {conv: repaired(some) for conv, some in damaged(rows).items()}
    assert found == expected


def test_no_rows_after_damage(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(conv, 0, "user", "x.")], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    row = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).first()
    assert tuple(row[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def documents() -> tuple[list[tuple], list[tuple]]:
    draw = random.Random(8)
    word = lambda: draw.choice(["rain", "Stone", "été", "日本", "x1", "the", "and"])
    items = [(k, draw.choice([" ", ", ", "\n"]).join(word() for _ in range(draw.choice([1, 4, 10, 14, 30])))) for k in range(20)]
    items += [(20, items[3][1]), (3, items[3][1]), (21, ""), (22, None), (None, "unnamed item of seven words only, yes"), (100, "9 lives"), (23, "same " * 25)]
    docs = [(k, " ".join(word() for _ in range(draw.choice([0, 1, 5, 60])))) for k in range(40)]
    docs += [(50 + k, f"{docs[k][1]} {t.upper() if t and k % 2 else t}; {docs[k][1]}") for k, (_, t) in enumerate(items)]
    docs += [(90, None), (91, ""), (None, "9 LIVES"), (92, "rain " * 30_000 + "9-lives"), (93, "same\x85 " + "same " * 40), (93, "9 lives")]
    return docs, items


def words(text: str | None) -> list[str]:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def leaks(text: str | None, items: list[tuple], size: int = 10) -> tuple:
    w, hit, names = words(text), set(), set()
    for item, body in items:
        x = words(body)
        n = min(size, len(x))
        grams = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                names.add("" if item is None else str(item))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("pass_pairs", [decontamination.PASS_PAIRS, 60])
def test_decontamination(spark, tmp_path, monkeypatch, pass_pairs):
    monkeypatch.setattr(decontamination.scanned, "__defaults__", (*decontamination.scanned.__defaults__[:-1], pass_pairs))
    docs, items = documents()
    spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id bigint, text string, spans string, `my col-x` string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: (r[0] is None, r)
    found = sorted((tuple(r) for r in QUERIES["op12_decontamination"](spark, str(tmp_path)).collect()), key=key)
    assert found == sorted(((i, *leaks(t, items)) for i, t in docs), key=key)


def test_decontamination_empty_and_cut(spark, tmp_path):
    docs, items = documents()
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, `my col-x` string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = decontamination.uncontaminated(table, bench)
    assert clean.columns == table.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in docs if not leaks(t, items)[-1])
    cut = {(r.doc_id, len(r.text or "")): r.text for r in decontamination.uncontaminated(table, bench, cut_spans=True).collect()}
    assert len(cut) >= len({i for i, _ in docs})
    left = {r.doc_id: r.text for r in decontamination.uncontaminated(table, bench, cut_spans=True).where("doc_id IN (50, 92)").collect()}
    assert left[92] == "rain " * 30_000
    nothing = decontamination.scanned(table, bench.where("false")).agg({"n_words": "sum"}).first()[0]
    assert nothing == sum(len(words(t)) for _, t in docs)
    assert decontamination.scanned(table.where("false"), bench).count() == 0


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(decontamination, "_hashes", lambda numbers, length: np.full(len(numbers) - length + 1, 7, np.uint64))
    known = decontamination.window_set([(b"a b", "1"), (b"b c", "2"), (b"c d", "3")])
    number = [known.vocabulary.get(w, 0) for w in b"b c x a b c".split()]
    assert decontamination.hits(np.array(number, np.int32), known) == ([(0, 2), (3, 6)], {0, 1})


def vectors() -> list[tuple]:
    draw, out = np.random.default_rng(4), []
    base = draw.standard_normal((12, 8))
    for k in range(900):
        v = base[k % 12] * (k % 3 + 1) + draw.standard_normal(8) * (0.0 if k % 10 == 0 else 0.3)
        out.append((k, [float(np.float32(x)) for x in v], None if k % 41 == 0 else k % 4))
    out += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 8, 1), (2003, [float("inf")] * 8, 2), (2004, [], 1), (2100, [0.5] * 3, 2), (None, out[5][1], 3), (700, out[700][1], 0), (2200, [0.0] * 8, 0),
            (2300, [3e5] * 8, 1), (2301, [2.9e5] * 8, 1), (2302, [2.8e5] * 8, 2)]
    return out


def mined(rows: list[tuple]) -> list[tuple]:
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        kept.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        score = [(sum(x * y for x, y in zip(v, w)), j, of) for j, w, of in kept]
        positives = sorted(((s, j) for b, (s, j, of) in enumerate(score) if of == label and b != a), key=order)[:5]
        for s, j in positives:
            fit = sorted(((t, n) for t, n, of in score if of != label and 80 * s <= 100 * t <= 100 * s), key=order)[:5]
            out += [(i, j, r + 1, n, s, t) for r, (t, n) in enumerate(fit)]
    return out


@pytest.mark.parametrize("rows_a_tree,block", [(hard_negatives.TREE_ROWS, hard_negatives.BLOCK_BYTES), (70, 300)])
def test_hard_negatives(spark, tmp_path, monkeypatch, rows_a_tree, block):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", rows_a_tree)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", block)
    rows = vectors()
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, row int").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = [tuple(r) for r in QUERIES["op13_hard_negatives"](spark, str(tmp_path)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == sorted(mined(rows), key=key)


@pytest.mark.parametrize("name,table,schema", [("op11_conversation_repair", "conversations", "conv_id bigint, turn bigint, role string, text string"),
                                               ("op13_hard_negatives", "embeddings", "vec_id bigint, embedding array<float>, label int")])
def test_empty(spark, tmp_path, name, table, schema):
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
