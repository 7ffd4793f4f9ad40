"""The full audit as one plan: inputs -> evidence tables -> metrics -> matrices.

Inputs are lazily evaluated DataFrames.  With ``materialize=True`` the parsed
inputs are first written as Parquet under the session's shared checkpoint
folder and read back, so ~20 evidence plans share one parse of the raw text
and any lost executor recomputes from that table, not from the CSV.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from trailcheck.contracts import EXPECTED_COLUMNS, FULL_SCOPE, INTEGER_COLUMNS
from trailcheck.operators import behavior as B
from trailcheck.operators import evidence as EV
from trailcheck.operators import hierarchy as T
from trailcheck.operators import history as H
from trailcheck.operators import quality as Q
from trailcheck.operators import splits as S
from trailcheck.plans import catalog as C
from trailcheck.session import stored
from trailcheck.sources.order import ROW_ORDER
from trailcheck.sources.scan import scan_source, tag_and_union, typed_source


@dataclass
class AuditInputs:
    log: DataFrame                     # parsed behaviour log
    props: DataFrame                   # parsed attribute history with _source_name
    tree: DataFrame                    # parsed category tree
    raw_sources: Sequence[tuple[DataFrame, Q.SourceSpec]]  # text sources for A01 / A02
    events_text: DataFrame             # raw text of the log (A02 compares text)
    props_text: DataFrame              # raw text of both property parts with _source_name
    scope: str = FULL_SCOPE
    tree_rows: DataFrame | None = None  # the category tree with the order of its rows, where the source has one
    same_text: bool = False            # the raw sources of the log and the parts hold the rows of events_text and props_text


materialize = stored


def evidence_plan(inp: AuditInputs, cached: list[DataFrame] | None = None
                  ) -> list[tuple[str, Callable[[], DataFrame], tuple]]:
    """(evidence id, constructor, key order) for every table of one audit run.

    Intermediates shared by several tables are persisted; they are appended
    to ``cached`` so the caller can release them once the tables are done.
    """
    log, props, tree = inp.log, inp.props, inp.tree
    src_order = F.when(F.col("source") == "events", 0).otherwise(1)
    made: dict[str, DataFrame] = {}
    locks = {name: threading.Lock() for name in ("nodes", "events", "properties")}

    def once(name: str, make: Callable[[], DataFrame]) -> DataFrame:  # shared by two tables, also across threads
        with locks[name]:
            if name not in made:
                made[name] = make()
            return made[name]

    def tree_nodes() -> DataFrame:  # one walk for A05 and A06
        return once("nodes", lambda: T.tree_nodes(tree) if inp.tree_rows is None else T.tree_nodes(inp.tree_rows, ROW_ORDER))

    # one grouping of the texts for A01 and A02
    event_columns, property_columns = list(EXPECTED_COLUMNS["events"]), list(EXPECTED_COLUMNS["item_properties_part1"])

    def event_rows() -> DataFrame:
        return once("events", lambda: materialize(Q.counted_events(inp.events_text, event_columns), "event_rows"))

    def property_rows() -> DataFrame:
        return once("properties", lambda: materialize(Q.counted_properties(inp.props_text, property_columns), "property_rows"))

    def counted(raw: DataFrame, spec: Q.SourceSpec) -> tuple[DataFrame, Q.SourceSpec]:
        copies = {"events": "n", "item_properties_part1": "n1", "item_properties_part2": "n2"}.get(spec.name)
        if not inp.same_text or copies is None:
            return raw, spec
        rows = event_rows() if spec.name == "events" else property_rows()
        return rows.filter(F.col(copies) > 0), replace(spec, copies=copies)

    # intermediates read by several evidence tables: computed once, kept
    # (memory and disk) for the duration of the audit
    shared = {
        "users": B.user_sequences(log), "items": B.item_metrics(log),
        "tx": B.transaction_priors(log), "flags": Q.item_flags(log, props),
        "pairs": H.pair_history(props, wide=materialize(H.wide_pairs(props), "wide_pairs")),
    }
    for df in shared.values():
        df.persist(StorageLevel.MEMORY_AND_DISK)
        if cached is not None:
            cached.append(df)
    users, items, tx, flags, pairs = (shared[k] for k in ("users", "items", "tx", "flags", "pairs"))
    return [
        (C.A01, lambda: Q.source_profile([counted(*s) for s in inp.raw_sources]), (src_order, "source")),
        (C.A02, lambda: Q.exact_duplicates(inp.events_text, inp.props_text, tree, event_columns, property_columns,
                                           event_rows=event_rows(), property_rows=property_rows()), ("duplicate_scope",)),
        (C.B01, lambda: B.event_distribution(log), ("event",)),
        (C.B02, lambda: B.daily_trend(log), ("date_utc", "event")),
        (C.B03, lambda: B.behavior_combinations(log), ("behavior_combination",)),
        (C.B04, lambda: B.prior_behavior(log, tx), ()),
        (C.B05, lambda: B.prior_intervals(log, tx), ("metric",)),
        (C.C01, lambda: users, ("visitorid",)),
        (C.C02, lambda: B.sequence_distribution(log, users), ("metric",)),
        (C.C03, lambda: B.length_buckets(log, users), ("sequence_length_bucket",)),
        (C.D01, lambda: items, ("itemid",)),
        (C.D02, lambda: B.item_concentration(log, items), ("metric", "top_item_percentage")),
        (C.F01, lambda: S.time_split_comparison(log), ("scheme", "split")),
        (C.E01, lambda: H.property_profile(props, pairs=pairs), ("property",)),
        (C.E02, lambda: H.property_change(props, pairs), ("property",)),
        (C.E03, lambda: H.special_properties(props, pairs), ("property",)),
        (C.A03, lambda: Q.entity_coverage(log, props, flags), ()),
        (C.A04, lambda: Q.attribute_coverage(log, props, flags), ()),
        (C.A06, tree_nodes, ("categoryid",)),
        (C.A05, lambda: T.tree_summary(tree, detail=tree_nodes()), ()),
    ]


def audit_metrics(inp: AuditInputs) -> DataFrame:
    """Long metrics of every evidence table, each computed once.

    The metrics are tiny (a row for every numeric column of the evidence tables) and become rows of a literal table.  Building a table's
    plan and running its metrics job happen together in one pooled task, so
    plan analysis, the iterative tree walk and the small jobs of the other
    tables overlap instead of queueing on the driver.
    """
    cached: list[DataFrame] = []
    plan = evidence_plan(inp, cached)
    ids = [eid for eid, _, _ in plan]
    if len(set(ids)) != len(ids):
        raise ValueError("two evidence tables share a name")

    def run(item):
        eid, make, keys = item
        ev = EV.Evidence(eid, make(), keys)
        return EV.metric_rows(ev, ev.frame.agg(*EV.metric_aggregates(ev)).first().asDict())

    # A06 first: A05 waits on its walk
    try:
        with ThreadPoolExecutor(max_workers=min(8, len(plan))) as pool:
            parts = list(pool.map(run, sorted(plan, key=lambda x: x[0] != C.A06)))
    finally:
        for df in cached:
            df.unpersist()
    return inp.log.sparkSession.createDataFrame([r for p in parts for r in p], EV.METRICS_DDL)


def feature_and_module_matrices(inp: AuditInputs, metrics: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """G01 then H01 (G01 is registered as evidence first, R26).

    A limited run is refused before any evidence is computed (R30).  ``metrics`` may pass those of evidence that
    is already written, which is then not computed again.
    """
    if inp.scope != FULL_SCOPE:
        raise EV.PartialRunError("matrices are built from runs over all rows only")
    spark = inp.log.sparkSession
    metrics = metrics if metrics is not None else audit_metrics(inp)
    features = EV.feature_matrix(C.feature_rules_df(spark), metrics, inp.scope)
    metrics2 = metrics.unionByName(EV.table_metrics(EV.feature_matrix_evidence(features)))
    modules = EV.module_matrix(C.module_rules_df(spark), metrics2, inp.scope)
    return features, modules


def write_evidence(evidence: Sequence[EV.Evidence], out_dir: str, scope: str) -> tuple[DataFrame, DataFrame]:
    """S07 + S08: each annotated table to ``out_dir/<evidence id>`` (Parquet); returns the index and the metrics, which
    are observed while the tables are written: one job a table, and no table is read again."""
    paths = {e.evidence_id: f"{out_dir.rstrip('/')}/{e.evidence_id}" for e in evidence}
    if len(paths) != len(evidence):
        raise ValueError("two evidence tables share a name")

    def write(e: EV.Evidence) -> list[tuple]:
        seen = Observation()
        observed = EV.Evidence(e.evidence_id, e.frame.observe(seen, *EV.metric_aggregates(e)), e.keys)
        EV.annotate(observed, scope).write.mode("overwrite").parquet(paths[e.evidence_id])
        return EV.metric_rows(e, seen.get)

    # independent small jobs (the plans are already built): submit them together
    with ThreadPoolExecutor(max_workers=min(8, len(evidence))) as pool:
        rows = [r for found in pool.map(write, evidence) for r in found]
    metrics = evidence[0].frame.sparkSession.createDataFrame(rows, EV.METRICS_DDL)
    return EV.evidence_index(metrics, paths), metrics


def source_spec(source: str) -> Q.SourceSpec:
    """What A01 profiles of a declared source."""
    columns = EXPECTED_COLUMNS[source]
    return Q.SourceSpec(source, columns, INTEGER_COLUMNS[source], "timestamp" if "timestamp" in columns else None)


def csv_inputs(spark: SparkSession, paths: Mapping[str, str], scope: str = FULL_SCOPE) -> AuditInputs:
    """Audit inputs from the declared CSV files: ``paths`` maps each source of ``EXPECTED_COLUMNS`` to its path.

    Headers are checked at once.  The text of each source is written to the shared checkpoint folder as Parquet in
    one split pass over the CSV, and both the text checks and the typed tables read that.  The tree keeps the order of
    its rows: a category named twice has its first row's parent (R16).
    """
    if set(paths) != set(EXPECTED_COLUMNS):
        raise ValueError(f"one path for each of {sorted(EXPECTED_COLUMNS)} is needed, given {sorted(paths)}")
    text = {name: scan_source(spark, paths[name], name, ordered=name == "category_tree") for name in EXPECTED_COLUMNS}
    text = {name: materialize(df, name) for name, df in text.items()}
    parts = [name for name in EXPECTED_COLUMNS if name.startswith("item_properties")]
    tree_rows = typed_source(text["category_tree"], "category_tree")
    return AuditInputs(
        log=typed_source(text["events"], "events"),
        props=tag_and_union({name: typed_source(text[name], name) for name in parts}),
        tree=tree_rows.drop(ROW_ORDER), tree_rows=tree_rows,
        raw_sources=[(df, source_spec(name)) for name, df in text.items()],
        events_text=text["events"], props_text=tag_and_union({name: text[name] for name in parts}), scope=scope, same_text=True)


def fixture_inputs(spark: SparkSession, sf_dir: str, scope: str = FULL_SCOPE,
                   materialized: bool = True) -> AuditInputs:
    """Audit inputs drawn from the driver's tables (see sources.fixtures).

    With ``materialized`` the parsed log, property history, tree and raw id
    text are written once to the shared checkpoint folder; every evidence
    plan (and the text views for A01/A02) then reads those narrow tables
    instead of re-scanning and re-parsing the sources.
    """
    from trailcheck.sources import fixtures as fx

    log, props, tree, raw = (fx.log(spark, sf_dir), fx.props(spark, sf_dir), fx.tree_func(spark, sf_dir),
                             fx.raw_ids(spark, sf_dir))
    if materialized:
        with ThreadPoolExecutor(max_workers=4) as pool:
            log, props, tree, raw = pool.map(lambda a: materialize(*a), [(log, "log"), (props, "props"),
                                                                          (tree, "tree"), (raw, "raw_ids")])
    events_text = fx.as_text(log, list(EXPECTED_COLUMNS["events"]))
    props_text = fx.tag_parts_text(props)
    cols = list(EXPECTED_COLUMNS["item_properties_part1"])
    raw_sources = [
        (events_text, source_spec("events")),
        (props_text.filter(F.col("_source_name") == "item_properties_part1").select(*cols),
         source_spec("item_properties_part1")),
        (props_text.filter(F.col("_source_name") == "item_properties_part2").select(*cols),
         source_spec("item_properties_part2")),
        (fx.as_text(tree, list(EXPECTED_COLUMNS["category_tree"])), source_spec("category_tree")),
        (raw, Q.SourceSpec("raw_ids", ("row_key", "raw_value"), ("raw_value",))),
    ]
    return AuditInputs(log=log, props=props, tree=tree, raw_sources=raw_sources, events_text=events_text,
                       props_text=props_text, scope=scope, same_text=True)


def run_audit(inp: AuditInputs, out_dir: str) -> dict[str, object]:
    """End-to-end audit: every evidence table annotated and written as Parquet
    under ``out_dir/evidence/<id>``, the evidence index, and — for a full run
    only — the feature and module matrices (``out_dir/matrices/...``), whose
    metrics come from the written evidence.  The pair aggregate (S06) goes to
    ``out_dir/pair_history``; a run whose length buckets do not add up to its
    users (R27) stops.

    A limited run (``scope`` other than full) writes the evidence with its
    scope label and withholds the matrices (R30).  Returns the index rows and
    the matrix paths (or the reason they were withheld).
    """
    base, spark = out_dir.rstrip("/"), inp.log.sparkSession
    cached: list[DataFrame] = []
    try:
        evidence = [EV.Evidence(eid, make(), keys) for eid, make, keys in evidence_plan(inp, cached)]
        index, metrics = write_evidence(evidence, f"{base}/evidence", inp.scope)
        H.pair_history(inp.props).write.mode("overwrite").parquet(f"{base}/pair_history")
    finally:
        for df in cached:
            df.unpersist()
    index.write.mode("overwrite").parquet(f"{base}/evidence_index")
    users, buckets = (spark.read.parquet(f"{base}/evidence/{eid}") for eid in (C.C01, C.C03))
    if not B.reconcile_length_buckets(inp.log, users, buckets).isEmpty():
        raise ValueError("length buckets and users count different users or events")
    result: dict[str, object] = {"scope": inp.scope, "index_path": f"{base}/evidence_index",
                                 "pair_history_path": f"{base}/pair_history"}
    if inp.scope != FULL_SCOPE:
        result["matrices"] = "withheld: formal conclusions need a full-scope run"
        return result
    features, modules = feature_and_module_matrices(inp, metrics)
    features.write.mode("overwrite").parquet(f"{base}/matrices/feature_feasibility")
    modules.write.mode("overwrite").parquet(f"{base}/matrices/module_feasibility")
    result["matrices"] = {"features": f"{base}/matrices/feature_feasibility",
                          "modules": f"{base}/matrices/module_feasibility"}
    return result
