"""Passes of the language ID over a text: windows are cut out of what is hashed once, spans are looked up together."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from trailcheck.llm import language_id


def _text(words: int, seed: int = 0) -> str:
    draw = random.Random(seed)
    return "".join("".join(draw.choices("abcdeéſ中İΣ", k=draw.randint(1, 9))) + draw.choice([" ", ", ", "_", "1", "\n\n"]) for _ in range(words))


def test_windows_are_those_of_the_words_alone():
    text = _text(300)
    words = language_id.Words(text)
    runs = language_id._LETTERS.findall(text.lower())
    assert len(words) == len(runs)
    for first, size in ((0, 1), (0, 300), (7, 6), (250, 25), (len(runs) - 1, 1)):
        alone = language_id.Words(" ".join(runs[first : first + size]))
        assert np.array_equal(next(words.buckets(first, size)), next(alone.buckets()))
        assert all(np.array_equal(a, b) for a, b in zip(words.counted(first, size), alone.counted()))


def test_spans_are_scored_in_one_lookup(monkeypatch):
    draw = np.random.default_rng(3)
    model = language_id.Model(("aa", "bb"), draw.standard_normal((language_id.BUCKETS, 2)).astype(np.float32), draw.random(language_id.BUCKETS) < 0.5,
                              np.array([0.5, -0.5]), 1.0, ((0.0, 0.0),) * len(language_id.BANDS))
    scorer, words, spans = language_id.Scorer(model), language_id.Words(_text(80, 1)), [(3, 1), (10, 3), (0, 8), (40, 25)]
    apart = [scorer.logits(words, *span) for span in spans]

    def same(found):
        return all(np.allclose(a[0], b[0], rtol=1e-12) and abs(a[1] - b[1]) < 1e-12 for a, b in zip(apart, found, strict=True))

    assert same(scorer.several(words, spans))
    monkeypatch.setattr(language_id, "SUMMED_BUCKETS", 50)
    assert same(language_id.Scorer(model).several(words, spans))


def test_power_tables_outlive_a_long_text():
    language_id._powers.cache_clear()
    for text in ("ab cd", "ab " * 30_000, "ab cd"):
        language_id.Words(text)
    assert language_id._powers.cache_info().misses == 2


def test_scoring_a_short_text_copies_no_table():
    draw, taught = np.random.default_rng(4), np.array([True, False, True])
    scores = draw.standard_normal((language_id.BUCKETS, 3)).astype(np.float32)[:, taught]  # as ``train`` leaves out a language without any word
    scorer = language_id.Scorer(language_id.Model(("aa", "cc"), scores, draw.random(language_id.BUCKETS) < 0.5, np.array([0.5, -0.5]), 1.0,
                                                  ((0.0, 0.0),) * len(language_id.BANDS)))
    words, spans = language_id.Words("wood der und"), [(0, 1), (1, 2)]
    tracemalloc.start()
    try:
        z, familiarity = scorer.logits(words)
        scorer.several(words, spans)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < scorer.table.nbytes // 8
    buckets = next(words.buckets())
    assert np.allclose(z, scores[buckets].astype(float).mean(0) + [0.5, -0.5]) and abs(familiarity - scorer.model.met[buckets].mean()) < 1e-12
