"""Descent on one text in very many copies stays bounded; finished steps leave no scratch tables behind."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np

from trailcheck.llm import common, language_id, suffix_dedup


def test_copies_in_all_languages_do_not_drive_the_model_up():
    draw, shard = random.Random(1), language_id._Shard(0, 4, 2_400, 1)
    with np.errstate(all="ignore"):
        for k in range(1_200):
            text = "of " * 800 if k % 2 else " ".join(draw.choice(["onndble", "wh", "esthtion", "ering", "of"]) for _ in range(300))
            shard.add(k, draw.randrange(4), language_id.Words(text))
        assert np.isfinite(shard.weights).all() and np.isfinite(shard.embedding).all() and np.abs(shard.weights).max() <= 32
        found = shard.result()
    assert (np.abs(found["weighted"]) <= 32_768 * found["times"] * language_id.FIXED_POINT).all()


def test_steps_of_the_suffix_dedup_go(spark, monkeypatch, tmp_path):
    made = []
    monkeypatch.setattr(suffix_dedup, "shared_dir", lambda s, name: made.append(str(tmp_path / name)) or made[-1])
    draw = random.Random(2)
    line = "".join(draw.choice("abcdefgh ") for _ in range(300))
    rows = [(k, f"{k} {line} {'x' * k}") for k in range(5)]
    left = {r.doc_id: r.text for r in suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert line in left[0] and not any(line in left[k] for k in range(1, 5))
    assert (Path(made[0]) / "spans").exists() and not (Path(made[0]) / "steps").exists()


def test_stored_tables_drop_their_shuffles_and_restore_the_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name, None), []
    with common.shuffles_dropped(spark):
        seen.append(spark.conf.get(name))
    df = spark.range(1_000).groupBy("id").count()
    assert common.stored(df, "some").count() == df.count() == 1_000
    assert seen == ["true"] and spark.conf.get(name, None) == before
