"""Parsing, null tokens, duplicates, coverage, CSV contract, hashing."""

import pytest
from pyspark.sql import functions as F

from conftest import LOG_DDL, PROPS_DDL
from trailcheck.functions import hashing
from trailcheck.functions.parsing import invalid_integer, normalize_nulls, parse_integer
from trailcheck.operators import quality as Q

VALID = {"1": 1, "1.0": 1, "1e3": 1000, " 12 ": 12, "+5": 5, "-3": -3, "007": 7}
INVALID = ["1.5", "inf", "0x10", "12abc", "5d", "True", "9223372036854775808"]


def test_parse_integer_rules(spark):
    df = spark.createDataFrame([(k,) for k in list(VALID) + INVALID + [None]], "t string")
    out = {r.t: (r.v, r.bad) for r in df.select("t", parse_integer(F.col("t")).alias("v"),
                                                  invalid_integer(F.col("t")).alias("bad")).collect()}
    for k, v in VALID.items():
        assert out[k] == (v, False), k
    for k in INVALID:
        assert out[k] == (None, True), k
    assert out[None] == (None, False)  # missing is not invalid (R4)


def test_identifier_text_keeps_leading_zeros(spark):
    df = spark.createDataFrame([("0012",)], "transactionid string")
    assert normalize_nulls(df).collect()[0].transactionid == "0012"


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("",), ("#N/A",), ("x",)], "c string")
    assert [r.c for r in normalize_nulls(df).collect()] == [None, None, None, None, "x"]


def test_duplicates_across_parts(spark):
    a, b, c, n = ("9", "70", "hue", "red"), ("9", "70", "hue", "blue"), ("9", "71", "hue", "red"), (None, "70", "hue", None)
    first, second = [a] * 3 + [b] + [n] * 2, [a] * 2 + [c] * 2 + [n]
    rows = [(*r, "item_properties_part1") for r in first] + [(*r, "item_properties_part2") for r in second]
    text = "timestamp string, itemid string, property string, value string, _source_name string"
    events = [("5", "3", "view", "8", None)] * 4 + [("5", "3", "view", "8", "t")]
    log_text = "timestamp string, visitorid string, event string, itemid string, transactionid string"
    tree = spark.createDataFrame([(6, None)] * 3 + [(6, 2), (2, None)], "categoryid bigint, parentid bigint")
    out = {r.duplicate_scope: (r.exact_duplicate_row_count, r.exact_distinct_shared_row_count)
           for r in Q.exact_duplicates(spark.createDataFrame(events, log_text), spark.createDataFrame(rows, text), tree,
                                       [f.split()[0] for f in log_text.split(", ")],
                                       ["timestamp", "itemid", "property", "value"]).collect()}
    assert out == {"item_properties_part1_file_internal": (3, None), "item_properties_part2_file_internal": (2, None),
                   "item_properties_cross_file": (3, 2), "item_properties_combined": (7, None),
                   "events_file_internal": (3, None), "category_tree_file_internal": (2, None)}


def test_profile_counts_missing_and_invalid_separately(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", None), (None, "b"), ("2.5", "c")], "timestamp string, v string")
    spec = Q.SourceSpec("s", ("timestamp", "v"), ("timestamp",), "timestamp")
    r = Q.source_profile([(raw, spec)]).collect()[0]
    assert r.rows_read == 4 and r.missing_count__timestamp == 1 and r.invalid_parse_count__timestamp == 2
    assert r.missing_count__v == 1 and r.timestamp_min_ms == 1 and r.timestamp_max_ms == 1


def test_coverage_uses_records_not_values(spark):
    events = spark.createDataFrame([(1, 1, "view", 1, None), (1, 1, "view", 2, None)], LOG_DDL)
    props = spark.createDataFrame([(1, 2, "categoryid", None, "part1"), (1, 3, "x", "v", "part1")], PROPS_DDL)
    a3 = Q.entity_coverage(events, props).collect()[0]
    assert (a3.event_item_count, a3.property_item_count, a3.overlap_item_count) == (2, 2, 1)
    a4 = Q.attribute_coverage(events, props).collect()[0]
    assert (a4.union_item_count, a4.items_with_categoryid_count) == (3, 1)
    assert a4.event_item_category_coverage == 0.5


def test_csv_header_contract(spark, tmp_path):
    from trailcheck.sources.scan import scan_source

    good = tmp_path / "good.csv"
    good.write_text("categoryid,parentid\n1,\n2,1\n3,NA\n")
    rows = scan_source(spark, str(good), "category_tree").collect()
    assert [(r.categoryid, r.parentid) for r in rows] == [("1", None), ("2", "1"), ("3", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text("parentid,categoryid\n1,2\n")
    with pytest.raises(Exception):
        scan_source(spark, str(bad), "category_tree").collect()


def test_fingerprint_is_order_insensitive(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    b = spark.createDataFrame([(2, None), (1, "x")], "a bigint, b string").repartition(3)
    fa, fb = hashing.table_fingerprint(a, "t").collect()[0], hashing.table_fingerprint(b, "t").collect()[0]
    assert (fa.rows, fa.hash_sum, fa.hash_xor) == (fb.rows, fb.hash_sum, fb.hash_xor)


def test_fraction_beyond_nine_digits_is_no_integer(spark):
    df = spark.createDataFrame([("1.0000000001",), ("1e-12",), ("1.0",), ("9007199254740993",), ("0.0",)], "t string")
    assert [r[0] for r in df.select(parse_integer(df.t)).collect()] == [None, None, 1, 9007199254740993, 0]


def test_std_beyond_decimal_sums(spark):
    from trailcheck.functions.stats import distribution_summary

    df = spark.createDataFrame([("m", 0, 10**9), ("m", 10**10, 10**9)], "metric string, value bigint, w bigint")
    assert abs(distribution_summary(df, "metric", "value", "w").first()["std"] - 5.0e9) < 10


def test_csv_dialect_and_header(spark, tmp_path):
    import pytest

    from trailcheck.sources.scan import InputContractError, scan_source

    good = tmp_path / "tree.csv"
    good.write_text('\ufeffcategoryid,parentid\n"4 ""b"" 2","x\\"\n7\n"two\nlines",9\n')
    rows = {tuple(r) for r in scan_source(spark, str(good), "category_tree").collect()}
    assert rows == {('4 "b" 2', "x\\"), ("7", None), ("two\nlines", "9")}
    bad = tmp_path / "bad.csv"
    bad.write_text("CategoryId,parentid\n1,2\n")
    with pytest.raises(InputContractError):
        scan_source(spark, str(bad), "category_tree")
