"""Rule evaluation over evidence metrics (the generic form of G01 and H01).

A rule table is an ordinary DataFrame, one row a *condition*:

=============  =====================================================================================================
``rule_id``     the rule it belongs to (text)
``position``    its place in the rule (int); texts are joined in this order
``evidence_id`` the cited evidence table
``metric``      the cited metric of it; ``row_count`` for the rows, ``summary`` for its first two numeric columns
``comparison``  one of ``COMPARISONS``; ``present`` asks only that the metric resolves
``threshold``   a number as text, or ``evidence_id.metric`` of another metric; null for ``present``
``template``    text for the report; ``{value}``, ``{threshold}``, ``{metric}``, ``{rows}`` and ``{evidence_id}`` are filled in
=============  =====================================================================================================

Further columns of a rule table are the caller's.  Metrics are the long table of :mod:`trailcheck.operators.evidence`.
All rules are evaluated by one join (two where thresholds cite metrics) and one aggregate; no rule is a driver loop.

A condition is ``unresolved`` where its metric or threshold does not exist, where its evidence table is empty (but for
``row_count``), or where one of them is no number; otherwise it is ``pass`` or ``fail``.  A metric without any value
reads as 0, as in the coverage column of the feature matrix.  A rule is unresolved if any condition is, else it fails
if any fails, else it passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COMPARISONS = (">=", ">", "<=", "<", "=", "!=", "present")
PASS, FAIL, UNRESOLVED = "pass", "fail", "unresolved"
ROW_COUNT, SUMMARY = "row_count", "summary"


def with_summaries(metrics: DataFrame) -> DataFrame:
    """``metrics`` and a ``summary`` metric an evidence table: ``c1=v1,c2=v2`` of its first two numeric columns that
    have a value (R25), or ``rows=N`` where it has none."""
    first = F.col("col_order").between(0, 1) & F.col("value").isNotNull()
    pairs = F.array_sort(F.collect_list(F.when(first, F.struct("col_order", "metric", "value"))))  # two at most
    text = F.array_join(F.transform(pairs, lambda x: F.concat(x["metric"], F.lit("="), x["value"])), ",")
    summaries = metrics.groupBy("evidence_id", "row_count").agg(text.alias("_text")).select(
        "evidence_id", F.lit(SUMMARY).alias("metric"),
        F.when(F.col("_text") == "", F.concat(F.lit("rows="), F.col("row_count").cast("string"))).otherwise(F.col("_text")).alias("value"),
        F.lit(-2).alias("col_order"), "row_count")
    return metrics.select("evidence_id", "metric", "value", "col_order", "row_count").unionByName(summaries)


def _cited(metrics: DataFrame, prefix: str) -> DataFrame:
    """Each metric as a condition reads it: its text, and its number where it is one."""
    text = F.when(F.col("metric") == ROW_COUNT, F.col("row_count").cast("string")).otherwise(
        F.coalesce("value", F.lit("0")))
    usable = F.col("metric").isin(ROW_COUNT, SUMMARY) | (F.col("row_count") > 0)
    return metrics.select(F.col("evidence_id").alias(f"{prefix}evidence"), F.col("metric").alias(f"{prefix}metric"),
                          F.when(usable, text).alias(f"{prefix}text"), F.col("row_count").alias(f"{prefix}rows"))


def evaluate_conditions(rules: DataFrame, metrics: DataFrame) -> DataFrame:
    """``rules`` with value, threshold_value, outcome, reason and text for every condition."""
    compared = F.col("comparison")
    value = _cited(metrics, "_v_")
    other = _cited(metrics, "_t_")
    met = (rules.join(value, (F.col("evidence_id") == F.col("_v_evidence")) & (F.col("metric") == F.col("_v_metric")), "left")
           .withColumn("_number", F.expr("try_cast(threshold AS double)"))
           .withColumn("_t_id", F.when(F.col("_number").isNull(), F.substring_index("threshold", ".", 1)))
           .withColumn("_t_name", F.when(F.col("_number").isNull(), F.substring(
               F.col("threshold"), F.length("_t_id") + 2, F.length("threshold"))))
           .join(other, (F.col("_t_id") == F.col("_t_evidence")) & (F.col("_t_name") == F.col("_t_metric")), "left"))
    x = F.expr("try_cast(_v_text AS double)")
    t = F.coalesce("_number", F.expr("try_cast(_t_text AS double)"))
    tests = {">=": x >= t, ">": x > t, "<=": x <= t, "<": x < t, "=": x == t, "!=": x != t}
    holds: Column = F.lit(None).cast("boolean")
    for name, test in tests.items():
        holds = F.when(compared == name, test).otherwise(holds)
    reason = (F.when(~compared.isin(*COMPARISONS) | compared.isNull(), "unknown comparison")
              .when(F.col("_v_evidence").isNull(), "no such metric")
              .when(F.col("_v_text").isNull(), "empty evidence table")
              .when(compared == "present", F.lit(None))
              .when(F.col("threshold").isNull(), "no threshold")
              .when(F.col("_number").isNull() & F.col("_t_evidence").isNull(), "no such threshold")
              .when(x.isNull() | t.isNull(), "not a number"))
    outcome = F.when(reason.isNotNull(), UNRESOLVED).when(compared == "present", PASS).when(holds, PASS).otherwise(FAIL)
    shown = {"value": F.col("_v_text"), "threshold": F.coalesce(F.col("_t_text"), F.col("threshold")), "metric": F.col("metric"),
             "rows": F.col("_v_rows").cast("string"), "evidence_id": F.col("evidence_id")}
    text: Column = F.col("template")
    for name, c in shown.items():
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(c, F.lit("?")))
    return met.select(*[rules[c] for c in rules.columns], F.col("_v_text").alias("value"),
                      F.coalesce(F.col("_t_text"), F.col("threshold")).alias("threshold_value"),
                      outcome.alias("outcome"), reason.alias("reason"), text.alias("text"))


def evaluate_rules(rules: DataFrame, metrics: DataFrame, separator: str = "; ") -> DataFrame:
    """One row a rule: rule_id, outcome, number of conditions that pass, fail or do not resolve, and its text.

    The text joins the conditions' texts in order of position; a rule has as many as its author wrote.
    """
    done = evaluate_conditions(rules, metrics)
    texts = F.array_sort(F.collect_list(F.struct("position", F.coalesce("text", F.lit("")).alias("text"))))
    count = lambda o: F.count_if(F.col("outcome") == o).cast("bigint")
    per = done.groupBy("rule_id").agg(count(PASS).alias("passed"), count(FAIL).alias("failed"), count(UNRESOLVED).alias("unresolved"),
                                      F.array_join(F.transform(texts, lambda x: x["text"]), separator).alias("text"))
    outcome = F.when(F.col("unresolved") > 0, UNRESOLVED).when(F.col("failed") > 0, FAIL).otherwise(PASS)
    return per.select("rule_id", outcome.alias("outcome"), "passed", "failed", "unresolved", "text")


def unresolved_conditions(rules: DataFrame, metrics: DataFrame) -> DataFrame:
    """The conditions that do not resolve, with the reason."""
    return evaluate_conditions(rules, metrics).filter(F.col("outcome") == UNRESOLVED)
