"""One callable per registered query: (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables through the fixture views of
:mod:`trailcheck.sources.fixtures`, so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from trailcheck.functions.parsing import normalize_nulls
from trailcheck.functions import hashing as HS
from trailcheck.functions import ranges as RG
from trailcheck.operators import behavior as B
from trailcheck.operators import derived as X
from trailcheck.operators import difference as DF
from trailcheck.operators import evidence as EV
from trailcheck.plans import audit as AU
from trailcheck.plans import catalog as CAT
from trailcheck.operators import hierarchy as T
from trailcheck.operators import history as H
from trailcheck.operators import rules as RU
from trailcheck.operators import splits as S
from trailcheck.operators import quality as Q
from trailcheck.sources.order import ROW_ORDER, row_numbers
from trailcheck.sources.scan import tag_and_union
from trailcheck.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def _on(fixture: Callable[[SparkSession, str], DataFrame], op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(fixture(spark, sf_dir))


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["prior_behavior"] = _on(fx.log, B.prior_behavior)
    q["strict_prior_ties"] = _on(fx.tie_log, B.prior_behavior)
    q["prior_intervals"] = _on(fx.log, B.prior_intervals)
    q["prior_intervals_ties"] = _on(fx.tie_log, B.prior_intervals)
    q["event_distribution"] = _on(fx.log, B.event_distribution)
    q["daily_trend"] = _on(fx.log, B.daily_trend)
    q["behavior_combinations"] = _on(fx.pair_log, B.behavior_combinations)
    q["user_sequences"] = _on(fx.log, B.user_sequences)
    q["sequence_distribution"] = _on(fx.log, B.sequence_distribution)
    q["length_buckets"] = _on(fx.order_log, B.length_buckets)
    q["length_buckets_star"] = _on(fx.star_log, B.length_buckets)
    q["item_metrics"] = _on(fx.log, B.item_metrics)
    q["top_share"] = _on(fx.star_log, B.top_share)
    q["gini"] = _on(fx.star_log, B.gini)

    # ---- quality
    q["source_profile"] = lambda spark, d: Q.source_profile(audit_sources(spark, d))
    q["parse_integer"] = lambda spark, d: Q.parsed_ids(fx.raw_ids(spark, d), "row_key", "raw_value")
    q["normalized_nulls"] = lambda spark, d: normalize_nulls(fx.raw_ids(spark, d), ["raw_value"])
    q["exact_duplicates"] = lambda spark, d: Q.exact_duplicates(
        fx.events_text(spark, d), fx.props_text(spark, d), fx.tree_func(spark, d),
        ["timestamp", "visitorid", "event", "itemid", "transactionid"], ["timestamp", "itemid", "property", "value"])
    q["entity_coverage"] = lambda spark, d: Q.entity_coverage(fx.log_items(spark, d), fx.props(spark, d))
    q["attribute_coverage"] = lambda spark, d: Q.attribute_coverage(fx.log_items(spark, d), fx.props(spark, d))
    q["tagged_union"] = lambda spark, d: _tagged_props(spark, d)
    # ---- attribute history
    q["pair_history"] = _on(fx.props, H.pair_history)
    q["property_profile"] = _on(fx.props, H.property_profile)
    q["property_change"] = _on(fx.props, H.property_change)
    q["special_properties"] = _on(fx.props, H.special_properties)
    q["special_record_counts"] = _on(fx.props, H.special_record_counts)
    q["property_parts_profile"] = _on(fx.props, H.property_parts_profile)
    q["asof_attribute"] = lambda spark, d: H.asof_attribute(fx.star_log(spark, d), fx.props(spark, d), "categoryid")
    # ---- temporal splits
    q["split_by_rows"] = _on(fx.pair_log, S.split_by_rows)
    q["split_last_7d"] = _on(fx.pair_log, lambda lg: S.split_by_days(lg, 7))
    q["split_last_14d"] = _on(fx.pair_log, lambda lg: S.split_by_days(lg, 14))
    q["split_boundaries"] = _on(fx.pair_log, S.split_boundaries)
    q["cold_vs_prior_splits"] = _on(fx.pair_log, S.cold_vs_prior_splits)
    # ---- category tree
    q["tree_nodes_func"] = _on(fx.tree_func, T.tree_nodes)
    q["tree_summary_func"] = _on(fx.tree_func, T.tree_summary)
    q["tree_nodes_heap"] = _on(fx.tree_heap, T.tree_nodes)
    q["tree_summary_heap"] = _on(fx.tree_heap, T.tree_summary)
    q["tree_nodes_first_row"] = lambda spark, d: T.tree_nodes(fx.tree_lines(spark, d), ROW_ORDER)
    q["tree_row_numbers"] = lambda spark, d: row_numbers(fx.tree_lines(spark, d))
    q["price_intervals"] = lambda spark, d: RG.interval_counts(fx.order_cents(spark, d), "cents", square_intervals(spark))
    q["table_difference"] = lambda spark, d: DF.table_difference(
        B.item_metrics(fx.log_items(spark, d)), B.item_metrics(fx.log_items(spark, d).filter((F.col("visitorid") % 211 != 0) | (F.col("event") != "view"))), ["itemid"])
    # ---- evidence layer
    q["evidence_annotation"] = lambda spark, d: EV.annotate(
        EV.Evidence(CAT.B01, B.event_distribution(fx.log(spark, d))), "full")
    q["evidence_index"] = lambda spark, d: EV.evidence_index(AU.audit_metrics(AU.fixture_inputs(spark, d)))
    q["feature_matrix"] = lambda spark, d: AU.feature_and_module_matrices(AU.fixture_inputs(spark, d))[0]
    q["module_matrix"] = lambda spark, d: AU.feature_and_module_matrices(AU.fixture_inputs(spark, d))[1]
    q["evidence_traceability"] = _traceability
    q["rule_evaluation"] = _rule_evaluation
    q["row_accounting"] = lambda spark, d: EV.row_accounting(audit_sources(spark, d))
    # one run is written and read back, the other computed anew
    q["rerun_equivalence"] = lambda spark, d: EV.tables_equal(
        "item_metrics", AU.materialize(B.item_metrics(fx.log(spark, d)), "item_metrics"),
        B.item_metrics(fx.log(spark, d)))
    q["table_fingerprint"] = lambda spark, d: HS.table_fingerprint(fx.log(spark, d), "events")
    # ---- analytics demanded by the specification
    q["pair_order_patterns"] = _on(fx.log, X.pair_order_patterns)
    q["short_history_removal_impact"] = _on(fx.pair_log, X.short_history_removal_impact)
    q["low_frequency_share"] = _on(fx.order_log, X.low_frequency_share)
    q["new_item_cohorts"] = _on(fx.log, X.new_item_cohorts)
    q["long_tail_by_universe"] = lambda spark, d: X.long_tail_by_universe(fx.log_items(spark, d), fx.props(spark, d))
    q["history_features"] = _on(fx.order_log, X.history_features)
    q["category_depth_coverage"] = lambda spark, d: T.category_depth_coverage(fx.props(spark, d),
                                                                              fx.tree_heap(spark, d))
    q["trend_hourly"] = _on(fx.log, lambda lg: X.trend_at_granularity(lg, "hour"))
    q["trend_weekly"] = _on(fx.order_log, lambda lg: X.trend_at_granularity(lg, "week"))
    return q


def _traceability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13 over both shipped catalogues."""
    return EV.traced_citations(CAT.feature_rules_df(spark), CAT.module_rules_df(spark), AU.audit_metrics(AU.fixture_inputs(spark, sf_dir)))


#: A sample rule table: (rule, position, evidence, metric, comparison, threshold, template).
SAMPLE_RULES = (
    ("enough events", 0, CAT.D01, "row_count", ">=", "10", "{rows} items"),
    ("enough events", 1, CAT.B04, "transaction_event_count", ">", "100", "{value} purchases of over {threshold}"),
    ("purchases follow views", 0, CAT.B04, "with_strictly_prior_view_share", ">=", "0.99", "share {value}, wanted {threshold}"),
    ("carts before purchases", 0, CAT.B04, "with_strictly_prior_addtocart_count", "<=", f"{CAT.B04}.transaction_event_count", "{value} of {threshold}"),
    ("more items than kinds", 0, CAT.D01, "row_count", ">", f"{CAT.B01}.row_count", "{value} items, {threshold} kinds of event"),
    ("overlap", 0, CAT.A03, "overlap_item_count", "!=", "0", "{metric} is {value}"),
    ("overlap", 1, CAT.A03, "no_such_column", ">", "0", "{metric} is {value}"),
    ("no such table", 0, "Z99_NOWHERE", "row_count", "present", None, "{evidence_id}"),
    ("threshold nowhere", 0, CAT.A03, "event_item_count", "<", f"{CAT.A03}.nothing", "{value} under {threshold}"),
    ("summary", 0, CAT.B04, "summary", "present", None, "{evidence_id}[{value}]"),
    ("every kind known", 0, CAT.B01, "row_count", "=", "3", "{rows} kinds"),
    ("not a number", 0, CAT.B04, "summary", "<", "5", "{value}"),
)


def _rule_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's rule table against the evidence it cites, which is computed here and nothing else."""
    log = fx.log_items(spark, sf_dir)
    evidence = [EV.Evidence(CAT.B01, B.event_distribution(log), ("event",)), EV.Evidence(CAT.B04, B.prior_behavior(log)),
                EV.Evidence(CAT.D01, B.item_metrics(log), ("itemid",)), EV.Evidence(CAT.A03, Q.entity_coverage(log, fx.props(spark, sf_dir)))]
    rules = spark.createDataFrame(list(SAMPLE_RULES), "rule_id string, position int, evidence_id string, metric string, comparison string, threshold string, template string")
    return RU.evaluate_rules(rules, RU.with_summaries(EV.evidence_metrics(evidence)))


def square_intervals(spark: SparkSession, n: int = 10_000) -> DataFrame:
    """A user's table of ``n`` intervals between square numbers, the last one open."""
    i = F.col("id")
    return spark.range(n).select((i * i).alias("lower"), F.when(i < n - 1, (i + 1) * (i + 1) - 1).alias("upper"), F.concat(F.lit("from "), i * i).alias("label"))


def audit_sources(spark: SparkSession, sf_dir: str):
    """The five raw text sources profiled by A01, with their declared specs."""
    from trailcheck.contracts import EXPECTED_COLUMNS, INTEGER_COLUMNS

    def spec(name):
        return Q.SourceSpec(name, EXPECTED_COLUMNS[name], INTEGER_COLUMNS[name],
                            "timestamp" if "timestamp" in EXPECTED_COLUMNS[name] else None)

    pt = fx.props_text(spark, sf_dir)
    cols = list(EXPECTED_COLUMNS["item_properties_part1"])
    return [
        (fx.events_text(spark, sf_dir), spec("events")),
        (pt.filter(F.col("_source_name") == "item_properties_part1").select(*cols), spec("item_properties_part1")),
        (pt.filter(F.col("_source_name") == "item_properties_part2").select(*cols), spec("item_properties_part2")),
        (fx.tree_text(spark, sf_dir), spec("category_tree")),
        (fx.raw_ids(spark, sf_dir), Q.SourceSpec("raw_ids", ("row_key", "raw_value"), ("raw_value",))),
    ]


def _tagged_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.props(spark, sf_dir)
    parts = {name: p.filter(F.col("_source_name") == name).drop("_source_name") for name in ("part1", "part2")}
    return tag_and_union(parts)
