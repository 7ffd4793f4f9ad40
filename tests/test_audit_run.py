"""End-to-end audit on a handful of rows: evidence written with its scope,
index complete, matrices only for a full run."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import LOG_DDL, PROPS_DDL, TREE_DDL
from trailcheck.contracts import EXPECTED_COLUMNS, INTEGER_COLUMNS, LIMITED_SCOPE
from trailcheck.operators import evidence as EV
from trailcheck.operators.quality import SourceSpec
from trailcheck.plans import audit as AU
from trailcheck.plans import catalog as C
from trailcheck.sources import fixtures as fx


def _inputs(spark, scope):
    log = spark.createDataFrame([(1000, 1, "view", 10, None), (2000, 1, "addtocart", 10, None),
                                 (3000, 1, "transaction", 10, "t1"), (4000, 2, "view", 11, None),
                                 (5000, 2, "view", 10, None), (5000, 3, None, 12, None)], LOG_DDL)
    props = spark.createDataFrame([(1000, 10, "categoryid", "1", "part1"), (1000, 11, "available", "1", "part2"),
                                   (2000, 10, "categoryid", "2", "part2"), (None, 12, "888", "x", "part1")], PROPS_DDL)
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2)], TREE_DDL)
    ev_text = fx.as_text(log, list(EXPECTED_COLUMNS["events"]))
    pr_text = fx.tag_parts_text(props)
    cols = list(EXPECTED_COLUMNS["item_properties_part1"])

    def spec(n):
        return SourceSpec(n, EXPECTED_COLUMNS[n], INTEGER_COLUMNS[n],
                          "timestamp" if "timestamp" in EXPECTED_COLUMNS[n] else None)

    raw = [(ev_text, spec("events")),
           (pr_text.filter(F.col("_source_name") == "item_properties_part1").select(*cols),
            spec("item_properties_part1")),
           (pr_text.filter(F.col("_source_name") == "item_properties_part2").select(*cols),
            spec("item_properties_part2")),
           (fx.as_text(tree, ["categoryid", "parentid"]), spec("category_tree"))]
    return AU.AuditInputs(log=log, props=props, tree=tree, raw_sources=raw, events_text=ev_text,
                          props_text=pr_text, scope=scope)


def test_full_run_writes_evidence_and_matrices(spark):
    out = tempfile.mkdtemp(prefix="tc-audit-")
    res = AU.run_audit(_inputs(spark, "full"), out)
    index = {r.evidence_id: r.row_count for r in spark.read.parquet(res["index_path"]).collect()}
    assert len(index) == 20 and index[C.B04] == 1 and index[C.A06] == 3
    assert index == {eid: spark.read.parquet(f"{out}/evidence/{eid}").count() for eid in index}
    b04 = spark.read.parquet(f"{out}/evidence/{C.B04}").collect()[0]
    assert b04.data_scope == "full" and b04.transaction_event_count == 1
    assert b04.with_strictly_prior_view_count == 1
    mods = spark.read.parquet(res["matrices"]["modules"])
    assert mods.count() == 30
    feats = {r.feature_name: r.coverage_value for r in spark.read.parquet(res["matrices"]["features"]).collect()}
    pairs = spark.read.parquet(res["pair_history_path"])
    assert {(r.itemid, r.property): r.record_count for r in pairs.collect()} == {
        (10, "categoryid"): 2, (11, "available"): 1, (12, "888"): 1}
    assert feats["visitor_identifier"] == "6" and feats["historical_interaction_counts"] == "1"


def test_observed_metrics_are_those_of_the_written_tables(spark):
    nothing = spark.createDataFrame([], "k string, n bigint, x double")
    some = spark.createDataFrame([("b", 2, None), ("a", None, 0.5), ("c", 3, 1.5)], "k string, n bigint, x double").repartition(3)
    evidence = [EV.Evidence(C.A03, nothing, ("k",)), EV.Evidence(C.A04, some, ("k",)), EV.Evidence(C.B01, some.groupBy("x").agg(F.sum("n").alias("n")), ())]
    index, metrics = AU.write_evidence(evidence, tempfile.mkdtemp(prefix="tc-observed-"), "full")
    assert {r.evidence_id: r.row_count for r in index.collect()} == {C.A03: 0, C.A04: 3, C.B01: 3}
    got = {(r.evidence_id, r.metric): r.value for r in metrics.collect()}
    assert (got[C.A04, "n"], got[C.A04, "x"], got[C.A03, "n"], got[C.A03, "row_count"]) == ("2", "0.5", None, "0")
    again = EV.evidence_metrics(evidence[:2]).collect()
    assert {(r.evidence_id, r.metric): r.value for r in again} == {k: v for k, v in got.items() if k[0] != C.B01}


def test_limited_run_withholds_matrices(spark):
    out = tempfile.mkdtemp(prefix="tc-audit-")
    res = AU.run_audit(_inputs(spark, LIMITED_SCOPE), out)
    assert isinstance(res["matrices"], str) and res["matrices"].startswith("withheld")
    row = spark.read.parquet(f"{out}/evidence/{C.B01}").select("data_scope").distinct().collect()
    assert [r.data_scope for r in row] == [LIMITED_SCOPE]
    with pytest.raises(EV.PartialRunError):
        AU.feature_and_module_matrices(_inputs(spark, LIMITED_SCOPE))


def test_csv_files_give_the_typed_inputs(spark, tmp_path):
    files = {"events": "timestamp,visitorid,event,itemid,transactionid\n7.0,1,view,5,\n8,x,view,5.5,\n9,1,transaction,5,t\n",
             "item_properties_part1": 'timestamp,itemid,property,value\n7,5,size,"two ""by"" two"\n',
             "item_properties_part2": "timestamp,itemid,property,value\n1e3,5,size,\n,6\n",
             "category_tree": "categoryid,parentid\n1,\n2,1.0\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    inp = AU.csv_inputs(spark, {name: str(tmp_path / f"{name}.csv") for name in files})
    assert sorted(map(tuple, inp.log.collect())) == [
        (7, 1, "view", 5, None), (8, None, "view", None, None), (9, 1, "transaction", 5, "t")]
    assert sorted(map(tuple, inp.props.collect()), key=str) == [
        (1000, 5, "size", None, "item_properties_part2"), (7, 5, "size", 'two "by" two', "item_properties_part1"),
        (None, 6, None, None, "item_properties_part2")]
    assert sorted(map(tuple, inp.tree.collect())) == [(1, None), (2, 1)]
    assert {r[1].name for r in inp.raw_sources} == set(files)
    assert AU.B.prior_behavior(inp.log).first().with_strictly_prior_view_count == 1
    with pytest.raises(ValueError):
        AU.csv_inputs(spark, {"events": "nowhere"})
