"""The training-data operators against brute force, on a small table of awkward rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import islice

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trailcheck.llm import exact_dedup, packing, spot_signatures, suffix_dedup, warc
from trailcheck.llm.bpe import RankArrayBPE, vocabulary_path
from trailcheck.llm.common import documents
from trailcheck.llm.language_id import fold  # noqa: F401
from trailcheck.llm.queries import ORACLES, QUERIES
from trailcheck.llm.token_counts import length_histogram, quantiles, suffix_sums, truncated_totals

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, h int, id string, row int, n bigint"
OTHER_TABLES = {"op11_conversation_repair", "op12_decontamination", "op13_hard_negatives"}
SYLLABLES = {"en": "the and ing ter wood rain stone light ", "de": "der und ung keit wald regen stein licht "}


def rows() -> list[tuple]:
    draw, out = random.Random(5), []

    def prose(lang: str, n: int) -> str:
        parts = SYLLABLES[lang].split()
        return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))

    shared = prose("en", 60)
    for k in range(60):
        lang = "de" if k % 3 == 0 else "en"
        out.append((3 * k + 1, prose(lang, draw.choice([1, 3, 40, 120])), lang, f"s{k % 4}"))
    base = out[7][1] + " " + prose("en", 150)
    for k in range(12):  # near copies, exact copies, one passage in many documents
        words = base.split()
        words[draw.randrange(len(words))] = f"edit{k}"
        out.append((500 + k, " ".join(words), "en", "hot"))
        out.append((600 + k, base.replace(" ", "\n\t "), "en", "hot"))
        out.append((700 + k, f"{prose('en', 20)} {shared} {prose('en', 20)}", "en", None))
    out += [(900, None, None, None), (901, "", "en", "s1"), (902, " \n", "en", "s1"), (903, "12 34 !?", "en", "s2"), (904, "ÉÉ ß 日本 \x85 \x1c<|endoftext|> it's", "de", "s2"),
            (905, "a" * 3000, "en", "s3"), (906, "ab" * 2000, "en", "s3"), (907, prose("en", 9000), "en", "s3"), (908, "the rain", "en", "s0"), (909, "the rain", "en", "s0")]
    return [(i, t, lang, src, len(t or ""), 1, "x", 2, 3) for i, t, lang, src in out]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("llm"))
    table = rows()
    spark.createDataFrame(table, SCHEMA).repartition(5).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, f"http://h/{k % 3}\r\nX: y" if k else None, None if k == 1 else "" if k == 2 else f"<p>{k % 4}é</p>", k) for k in range(12)], "page_id bigint, url string, html string, payload int").write.parquet(f"{at}/pages.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/none/documents.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{at}/none/pages.parquet")
    return at, {r[0]: r[1] or "" for r in table}


def result(spark, data, name):
    return {r[0]: r for r in QUERIES[name](spark, data[0]).collect()}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_TABLES))
def test_empty_table(spark, data, name):
    assert QUERIES[name](spark, f"{data[0]}/none").count() == 0


def test_packing(spark, data):
    found = QUERIES["op1_best_fit_packing"](spark, data[0]).collect()
    source = {r[0]: r[3] for r in rows()}
    bins, total = defaultdict(list), Counter()
    for r in found:
        bins[r.bin_id].append(r)
        total[r.doc_id] += r.n_tokens
    assert set(total) == set(data[1])
    for box in bins.values():
        assert sum(r.n_tokens for r in box) <= packing.CAPACITY
        known = [source[r.doc_id] for r in box if source[r.doc_id] is not None]
        texts = [" ".join(data[1][r.doc_id].split()).lower() for r in box if data[1][r.doc_id].strip()]
        assert len(known) == len(set(known)) and len(texts) == len(set(texts))


def test_best_fit_is_tightest():
    draw = random.Random(1)
    items = [(draw.randint(0, 50), 1 << draw.randint(0, 5), 1 << draw.randint(0, 9)) for _ in range(300)]
    left, src, dup, expected = [], [], [], []
    for length, s, c in items:
        fit = [(left[b], b) for b in range(len(left)) if left[b] >= length and not src[b] & s and not dup[b] & c]
        if not fit:
            left.append(100), src.append(0), dup.append(0)
            fit = [(100, len(left) - 1)]
        b = min(fit)[1]
        expected.append((b, 100 - left[b]))
        left[b] -= length
        src[b] |= s
        dup[b] |= c
    assert packing.best_fit(items, 100) == expected


def plain_signatures(text: str, anchors: list[str]) -> set:
    """The signatures of a text as tuples of words, by the definition."""
    words = re.findall(r"\w{1,32}", text.lower())
    if not words:
        return {text} if text else set()
    found, since = set(), None
    for k, w in enumerate(words):
        if w in anchors:
            found.add((w, *islice((x for x in islice(words, k, None) if x not in anchors), spot_signatures.CHAIN), None))
            since = k
        elif since is None or k - since > spot_signatures.REACH:
            found.add((w,))
    return found


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spot_signatures(spark, data):
    found, order = result(spark, data, "op2_spot_signatures"), sorted(data[1], reverse=True)
    counts = Counter(w for t in data[1].values() for w in re.findall(r"\w+", t.lower()) if len(w) <= spot_signatures.ANCHOR_LETTERS)
    anchors = sorted(counts, key=lambda w: (-counts[w], w))[: spot_signatures.ANCHORS]
    plain = {i: plain_signatures(t, anchors) for i, t in data[1].items()}
    for k, i in enumerate(order):
        text, after = data[1][i], order[(k + 1) % len(order)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + data[1][after][:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(r.fingerprint) == 8 * len(plain[i]) and r.fingerprint == "".join(sorted(re.findall("." * 8, r.fingerprint)))
        assert r.near_edited == jaccard(plain[i], plain_signatures(edited, anchors))
        assert r.near_next == jaccard(plain[i], plain[after])
        assert r.near_edited > 0 or len(text) <= 300
    assert found[908].fingerprint == found[909].fingerprint
    assert {i: s for i, s in plain.items() if not s}.keys() == {i for i, r in found.items() if not r.fingerprint}


@pytest.mark.parametrize("least", [0.75, 0.4, 1.0])
def test_similar_fingerprints_against_all_pairs(spark, least):
    draw, sets = random.Random(4), []
    for _ in range(12):
        base = draw.sample(range(1 << 32), draw.choice([1, 4, 9, 40, 600]))
        sets += [sorted({*draw.sample(base, max(1, int(len(base) * draw.choice([1, 0.9, 0.75, 0.5])))), *([7] if draw.random() < 0.8 else [])}) for _ in range(9)]
    sets += [[], [], [7], [7]]
    written = [spot_signatures.written(np.array(s, np.uint32)) for s in sets]
    table = [(None if k == 3 else k // 2, len(s), w) for k, (s, w) in enumerate(zip(sets, written))]
    found = spark.createDataFrame(table, "doc_id long, n_signatures long, fingerprint string").repartition(4)
    different = {hashlib.sha256(w.encode()).hexdigest(): set(s) for s, w in zip(sets, written) if s}
    keys = sorted(different, key=lambda k: (len(different[k]), k))
    want = {(a, b): jaccard(different[a], different[b]) for n, a in enumerate(keys) for b in keys[n + 1 :]}
    pairs = spot_signatures.similar_pairs(found, least).collect()
    assert len(pairs) == len({(r.first_key, r.second_key) for r in pairs})
    assert {(r.first_key, r.second_key): r.likeness for r in pairs} == {p: x for p, x in want.items() if x >= least}
    ids = {r.key: r.doc_id for r in spot_signatures.classes(found).collect()}
    assert all((r.first_id, r.second_id) == (ids[r.first_key], ids[r.second_key]) for r in pairs)
    assert spot_signatures.similar_pairs(found.limit(0), least).collect() == []


def test_bpe_and_token_files(spark, data):
    byte, word = (Tokenizer.from_file(vocabulary_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    found, files, start = result(spark, data, "op3_bpe_round_trip"), result(spark, data, "op4_token_files"), 0
    for i in sorted(data[1]):
        ids = byte.encode(data[1][i], add_special_tokens=False).ids
        assert tuple(found[i])[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(byte.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        ids = [*word.encode(data[1][i], add_special_tokens=False).ids, 1]
        assert tuple(files[i])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_long_words_merge_alike():
    codec, draw = RankArrayBPE(vocabulary_path()), random.Random(2)
    for _ in range(200):
        word = bytes(draw.choice(b"thereandin  ab") for _ in range(draw.randint(1, 200)))
        assert codec.encode_word(word) == codec._encode_long(word)
    assert codec.decode(array("I", codec.encode_word("é".encode())).tobytes()) == "é"


def test_warc(spark, data):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{data[0]}/pages.parquet").collect()}
    last = {h: max(i for i in pages if pages[i] == h) for h in pages.values()}
    found = result(spark, data, "op5_warc_archive")
    for i, html in pages.items():
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        first = last[html] == i
        assert tuple(found[i]) == (i, len(html.encode()), digest, "response" if first else "revisit", None if first else last[html])
    archive = warc.write_archive(spark.read.parquet(f"{data[0]}/pages.parquet"), "page_id", "url", "html")
    records = {r.id: bytes(r.record) for r in warc.reconstruct(archive).collect()}
    for i, raw in records.items():
        head, _, block = raw.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert block == (pages[i].encode() if last[pages[i]] == i else b"") + b"\r\n\r\n" and size == len(block) - 4 and b"\r\nX: y" not in head


@pytest.mark.parametrize("hot", [1, 10_000])
def test_suffix_dedup(spark, data, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CHUNKS", hot)
    found, seen = result(spark, data, "op6_suffix_dedup"), set()
    for i in sorted(data[1]):
        text = data[1][i].encode()
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - 99):
            if text[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(text[p : p + 100])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        assert tuple(found[i])[1:] == (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def test_exact_dedup(spark, data):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in data[1].items()}
    groups = defaultdict(list)
    for i, t in norm.items():
        groups[t].append(i)
    found = result(spark, data, "op7_exact_dedup")
    assert "op7_exact_dedup" in ORACLES
    for i, t in norm.items():
        assert tuple(found[i])[1:] == (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())


def test_exact_dedup_chains(spark, data):
    """Texts whose hashes collide are told apart by their bytes."""
    docs = documents(spark, data[0])
    few = lambda norm: F.pmod(F.length(norm), F.lit(3)).cast("long")
    found = sorted(map(tuple, exact_dedup.exact_groups(docs, hash_of=few).collect()))
    assert found == sorted(map(tuple, exact_dedup.exact_groups(docs).collect()))
    kept = sorted(r["doc_id"] for r in exact_dedup.kept_documents(docs, hash_of=few).collect())
    assert kept == sorted(r[0] for r in found if r[3])


def test_exact_dedup_directory(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("hash"))
    pages = exact_dedup.directory(hashes.union(hashes), bucket_classes=100)
    placed = hashes.withColumn("cell", F.shiftrightunsigned("hash", 64 - exact_dedup.MAX_DEPTH)).join(pages, "cell")
    sizes = [(r["depth"], r["n"]) for r in placed.groupBy("bucket", "depth").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(n for _, n in sizes) == 3000 and max(n for _, n in sizes) <= 100 and min(d for d, _ in sizes) >= 4


def _components(texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    for _ in sets:
        old = dict(least)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    least[a] = min(least[a], least[b])
        if old == least:
            break
    return {i: (len(sets[i]), least[i]) for i in sets}


def test_shingle_join(spark, data):
    found = result(spark, data, "op8_shingle_join")
    assert {i: tuple(r)[1:] for i, r in found.items()} == _components(data[1])


def test_language_id(spark, data):
    found, lang = result(spark, data, "op9_language_id"), {r[0]: r[2] for r in rows()}
    for i in (900, 901, 902, 903):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in found.items())
    long = [i for i, t in data[1].items() if len(t.split()) >= 40]
    assert np.mean([found[i].lang_pred == lang[i] for i in long]) > 0.95


def test_token_counts(spark, data):
    byte = Tokenizer.from_file(vocabulary_path())
    lengths = [len(byte.encode(t, add_special_tokens=False).ids) for t in data[1].values()]
    sums = suffix_sums(length_histogram(documents(spark, data[0]), vocabulary_path())).cache()
    for r in sums.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_from, r.tokens_from, r.docs_to) == (lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(x <= n for x in lengths))
        assert r.truncated_total == sum(min(x, n) for x in lengths) and r.tokens_all == sum(lengths) and r.tokens_cut == r.tokens_all - r.truncated_total
    for r in truncated_totals(sums, [0, 10, 512, 10**6]).collect():
        assert (r.total, r.truncated_total, r.n_cut) == (sum(lengths), sum(min(x, r.context_limit) for x in lengths), sum(x > r.context_limit for x in lengths))
    for r in quantiles(sums, [0.0, 0.5, 0.9, 1.0]).collect():
        assert r.n_tokens == min(x for x in lengths if sum(y <= x for y in lengths) >= r.fraction * len(lengths))


def test_pipeline_stages(spark, data):
    docs = documents(spark, data[0])
    for name, stage in corpus_pipeline.STAGES[1:]:
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        after = stage(spark, docs, data[0])
        if name == "best_fit_packing":
            assert {r.doc_id for r in after.collect()} == set(before)
            break
        assert after.columns == docs.columns
        kept = {r.doc_id: r for r in after.collect()}
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
            assert set(kept) == set(first.values())
        if name == "shingle_join":
            assert set(kept) == {i for i, (_, c) in _components(before).items() if i == c}
        if name == "suffix_dedup":
            assert all(r.n_chars == len(r.text or "") and len(r.text or "") <= len(before[i]) for i, r in kept.items())
        docs = spark.createDataFrame(after.collect(), docs.schema)
