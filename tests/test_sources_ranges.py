"""Split CSV scans, headers of every file, row order, given intervals, and differences of tables, on small files."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trailcheck.functions import ranges as R
from trailcheck.operators import difference as D
from trailcheck.operators import hierarchy as T
from trailcheck.operators.derived import history_features
from trailcheck.plans import audit as AU
from trailcheck.sources.order import row_numbers, with_row_order
from trailcheck.sources.scan import InputContractError, scan_source


def test_a_plain_file_is_split_and_keeps_its_order(spark, tmp_path):
    path = tmp_path / "tree.csv"
    path.write_text("categoryid,parentid\n" + "".join(f"{k % 500},{k}\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        scan = scan_source(spark, str(path), "category_tree", ordered=True)
        assert scan.rdd.getNumPartitions() > 4
        numbered = row_numbers(scan)
        assert {(r.row_number, r.parentid) for r in numbered.collect()} == {(k, str(k)) for k in range(20_000)}
        nodes = T.tree_nodes_base(scan.select(F.col("categoryid").cast("bigint"), F.col("parentid").cast("bigint"), "_row_order"), "_row_order")
        assert {(r.categoryid, r.parentid, r.copies) for r in nodes.collect()} == {(k, k, 40) for k in range(500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_breaks_in_fields_are_found(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('timestamp,itemid,property,value\n1,2,a,"two\nlines"\n3,4,b,"a ""quoted"" word"\n')
    rows = [tuple(r) for r in scan_source(spark, str(path), "item_properties_part1").collect()]
    assert rows == [("1", "2", "a", "two\nlines"), ("3", "4", "b", 'a "quoted" word')]
    split = scan_source(spark, str(path), "item_properties_part1", multi_line=False)
    assert split.count() == 3  # as asked


@pytest.mark.parametrize("second", ["categoryid,Parentid\n3,4\n", "parentid,categoryid\n3,4\n", "categoryid\n3\n", ""])
def test_the_header_of_every_file_is_checked(spark, tmp_path, second):
    (tmp_path / "a.csv").write_text("﻿categoryid,parentid\n1,\n")
    assert scan_source(spark, str(tmp_path), "category_tree").count() == 1
    (tmp_path / "b.csv").write_text(second)
    with pytest.raises(InputContractError):
        scan_source(spark, str(tmp_path), "category_tree")


def test_no_file_is_an_error(spark, tmp_path):
    with pytest.raises(InputContractError):
        scan_source(spark, str(tmp_path), "category_tree")


def test_audit_inputs_keep_the_first_parent(spark, tmp_path):
    files = {"events": "timestamp,visitorid,event,itemid,transactionid\n7,1,view,5,\n", "item_properties_part1": "timestamp,itemid,property,value\n",
             "item_properties_part2": "timestamp,itemid,property,value\n", "category_tree": "categoryid,parentid\n2,9\n1,\n2,1\n3,2\n3,1\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    inp = AU.csv_inputs(spark, {name: str(tmp_path / f"{name}.csv") for name in files})
    assert inp.tree.columns == ["categoryid", "parentid"]
    nodes = {r.categoryid: r.parentid for r in T.tree_nodes(inp.tree_rows, "_row_order").collect()}
    assert nodes == {1: None, 2: 9, 3: 2}


INTERVALS = "lower bigint, upper bigint, label string"


def test_values_in_given_intervals(spark):
    draw = random.Random(1)
    cuts = sorted({draw.randrange(-(1 << 40), 1 << 40) for _ in range(60)} | set(range(-20, 20)) | {1 << 50})
    given = [(a, b - 1, f"i{a}") for a, b in zip(cuts, cuts[1:])] + [(cuts[-1], None, "rest")]
    intervals = R.checked_intervals(spark.createDataFrame(given, INTERVALS))
    values = [*cuts, *(c - 1 for c in cuts), *(draw.randrange(-(1 << 41), 1 << 41) for _ in range(500)), (1 << 61)]
    rows = spark.createDataFrame([(v,) for v in values] * 2 + [(None,)], "v bigint")
    where = lambda v: next((name for a, b, name in given if a <= v and (b is None or v <= b)), None)
    expected = Counter(where(v) for v in values * 2)
    found = {r.label: r.row_count for r in R.interval_counts(rows, "v", intervals).collect()}
    assert found == {name: expected.get(name, 0) for _, _, name in given}
    labelled = R.in_intervals(rows.where("v IS NOT NULL").distinct(), "v", intervals, outer=True)
    assert {r.v: r.label for r in labelled.collect()} == {v: where(v) for v in values}


def test_faults_of_intervals(spark):
    bad = spark.createDataFrame([(0, 4, "a"), (4, 6, "b"), (9, 12, "c"), (13, 11, "d"), (14, None, "e"), (20, 30, "f")], INTERVALS)
    assert {(r.label, r.fault) for r in R.interval_faults(bad).collect()} == {
        ("a", "overlaps the next"), ("b", "gap before the next"), ("d", "empty"), ("e", "overlaps the next")}
    with pytest.raises(ValueError, match="overlaps"):
        R.checked_intervals(bad)
    assert R.interval_counts(spark.createDataFrame([(1,)], "v bigint"), "v", spark.createDataFrame([], INTERVALS)).count() == 0


@pytest.mark.parametrize("ranges", [1, 7, D.RANGES])
def test_difference_lists_changed_rows(spark, ranges):
    rows = [(k, f"v{k}", None if k % 5 == 0 else k * 0.5) for k in range(300)] + [(7, "v7", 3.5)] * 2
    a = spark.createDataFrame(rows, "id bigint, name string, x double")
    changed = [r for r in rows if r[0] not in (3, 10)] + [(3, "new", 1.5), (None, None, None), (10, "v10", 0.0)]
    changed.remove((7, "v7", 3.5))
    b = spark.createDataFrame(changed, "id bigint, name string, x double").select("x", "id", "name")
    found = {(r.id, r.name, r.x, r.run): r.copies for r in D.table_difference(a, b, ["id"], ranges).collect()}
    assert found == {(3, "v3", 1.5, "a"): 1, (3, "new", 1.5, "b"): 1, (10, "v10", None, "a"): 1, (10, "v10", 0.0, "b"): 1, (None, None, None, "b"): 1, (7, "v7", 3.5, "a"): 1}
    assert D.table_difference(a, a, ["id"], ranges).count() == 0


def test_difference_regroups_only_ranges_that_differ(spark):
    rows = [(k, k % 7) for k in range(2_000)]
    a, b = (spark.createDataFrame(x, "id bigint, y bigint") for x in (rows, [*rows[:-1], (1_999, 99)]))
    assert D.differing_ranges(a, b, ["id"], 256).count() == 1


def test_history_features_with_copies_and_a_hot_key(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(0, 5) * 43_200_000, 1 if draw.random() < 0.6 else draw.randrange(4), draw.choice(["view", "transaction"]), draw.randrange(3), None) for _ in range(200)]
    rows += [(86_400_000, 1, "view", 1, None)] * 60 + [(None, 1, "view", 1, None)]
    log = spark.createDataFrame(rows, "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string")
    valid = [r for r in rows if r[0] is not None]
    expected = Counter()
    for t, v, e, i, _ in valid:
        before = [r for r in valid if r[0] < t]
        expected[(t, v, e, i, sum(r[1] == v for r in before), len({r[0] // 86_400_000 for r in before if r[1] == v}), sum(r[3] == i for r in before),
                  sum(r[1] == v and r[3] == i for r in before))] += 1
    assert Counter(map(tuple, history_features(log).collect())) == expected
