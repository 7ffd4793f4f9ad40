"""The language model learns from every labelled document, and no other, however the rows are stored."""

from __future__ import annotations

import random
import zlib

import numpy as np

from trailcheck.llm import language_id

DDL = "doc_id bigint, text string, lang string"


def rows(n: int) -> list[tuple]:
    draw, out = random.Random(5), []
    for k in range(n):
        lang = "aa" if k % 3 else "bb"
        parts = ("the and ing ter wood" if k % 3 else "der und ung keit wald").split()
        words = ["".join(draw.choice(parts) for _ in range(2)) for _ in range(draw.choice([2, 8, 30]))]
        out.append((k, " ".join([*words, f"{chr(0x4E00 + k)}{chr(0x4E00 + (k * 7) % n)}"]), lang))  # no other text has that word
    return out


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SHARD_ROWS", 200)
    table = rows(2_000)
    df = spark.createDataFrame([*table, (5_000, None, "aa"), (5_001, "12 34", "cc"), (5_002, "ὅδε λόγος", None), (None, "ὅδε λόγος", "aa")], DDL)
    model = language_id.train(df)
    assert model.languages == ("aa", "bb") and model.scores.shape[1] == 2
    texts = {i: text for i, text, _ in table}
    missed = [i for i, text in texts.items() if zlib.crc32(str(i).encode()) % 4 != 2 and not all(model.met[b].all() for b in language_id.Words(text).buckets())]
    assert not missed
    assert not model.met[next(language_id.Words("ὅδε λόγος").buckets())].all()
    again = language_id.train(df.repartition(7))
    assert np.array_equal(again.scores, model.scores) and np.array_equal(again.bias, model.bias) and again.temperature == model.temperature and again.thresholds == model.thresholds
    found = language_id.predict(df, model, ["doc_id", "lang"]).where("lang in ('aa', 'bb') and doc_id < 5000").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.99


def test_every_labelled_document_is_calibrated_on(spark):
    """One badly scored text among many decides the least familiarity of its band, wherever its id lies."""
    plain = [(k, text.rsplit(" ", 1)[0], lang) for k, text, lang in rows(2_000)]
    plain = [(k, text, lang) for k, text, lang in plain if zlib.crc32(str(k).encode()) % 4 != 2]
    where = next(k for k in range(3_000, 4_000) if zlib.crc32(str(k).encode()) % 4 != 2)
    odd = "theand ingter woodthe andthe " * 2 + "漢字 仮名"
    usual = language_id.train(spark.createDataFrame(plain, DDL)).thresholds
    lower = language_id.train(spark.createDataFrame([*plain, (where, odd, "aa")], DDL)).thresholds
    band = language_id.band_of(10)
    assert lower[band][1] < 0.95 <= usual[band][1]


def test_words_and_subwords():
    words = language_id.Words("Wood, wood_1 ÀB x")
    assert len(words) == 4  # wood, wood, àb, x
    per_word = [np.sort(next(words.buckets(k, 1))) for k in range(4)]
    assert [len(b) for b in per_word] == [1 + 5 + 4 + 3, 13, 1 + 3 + 2, 1 + 2] and np.array_equal(per_word[0], per_word[1])
    assert np.array_equal(np.sort(next(words.buckets())), np.sort(np.concatenate(per_word)))
    assert not len(language_id.Words("12 _ ⅷ")) and not len(language_id.Words(""))


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "wood der und ungkeit ὅδε " * 400
    at, n = language_id.Words(text).counted()
    monkeypatch.setattr(language_id, "BLOCK", 50)
    long = language_id.Words(text)
    assert max(map(len, long.buckets())) < 400
    assert all(np.array_equal(a, b) for a, b in zip((at, n), long.counted()))
