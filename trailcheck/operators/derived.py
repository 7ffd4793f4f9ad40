"""Analytics the audit specification asks for beyond the implemented tables
(X01-X05, X09, X11).  Same conventions as :mod:`behavior`: exact counts,
grouped aggregates with partial aggregation, bucketed prefix windows for
"strictly earlier" questions, histograms for order statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trailcheck.contracts import DAY_MS, DAY_SCHEMES, EXPECTED_EVENTS
from trailcheck.functions.columns import day_index, share, utc_date_text
from trailcheck.functions.ordering import strict_prior
from trailcheck.operators.behavior import gini, item_metrics, top_share, user_sequences, valid_events

# parameters (not reference constants): thresholds reported by X02 / X03
HISTORY_THRESHOLDS: tuple[int, ...] = (2, 3, 5, 10, 20)
LOW_FREQUENCY_THRESHOLDS: tuple[int, ...] = (2, 5, 10)


def pair_order_patterns(log: DataFrame) -> DataFrame:
    """Per (visitor, item) the order of the first view / cart / transaction.

    The label lists the event types present by first-occurrence time, joined
    by '<' (strictly later) or '=' (same millisecond; names in code-point
    order), e.g. ``view<addtocart=transaction``.  Output: pattern, pair_count.
    """
    v = valid_events(log).filter(F.col("event").isin(*EXPECTED_EVENTS))
    firsts = v.groupBy("visitorid", "itemid").agg(
        *[F.min(F.when(F.col("event") == e, F.col("timestamp"))).alias(e) for e in EXPECTED_EVENTS])
    seq = F.array_sort(F.filter(F.array(*[F.struct(F.col(e).alias("ts"), F.lit(e).alias("name"))
                                          for e in EXPECTED_EVENTS]), lambda x: x["ts"].isNotNull()))
    label = F.array_join(F.transform(seq, lambda x, i: F.concat(
        F.when(i == 0, F.lit("")).when(x["ts"] == F.get(seq, i - 1)["ts"], F.lit("="))
        .otherwise(F.lit("<")), x["name"])), "")
    return firsts.groupBy(label.alias("pattern")).agg(F.count(F.lit(1)).cast("bigint").alias("pair_count"))


def short_history_removal_impact(log: DataFrame, thresholds: Sequence[int] = HISTORY_THRESHOLDS) -> DataFrame:
    """Users and events kept when users with fewer than k valid events are dropped."""
    lengths = user_sequences(log).select(F.col("total_behavior_length").alias("n"))
    hist = lengths.groupBy("n").agg(F.count(F.lit(1)).cast("bigint").alias("users"))
    aggs = [F.sum("users").alias("_u"), F.sum(F.col("users") * F.col("n")).alias("_e")]
    for k in thresholds:
        aggs += [F.sum(F.when(F.col("n") >= k, F.col("users")).otherwise(0)).alias(f"_u{k}"),
                 F.sum(F.when(F.col("n") >= k, F.col("users") * F.col("n")).otherwise(0)).alias(f"_e{k}")]
    agg = hist.agg(*aggs)
    rows = [F.struct(F.lit(k).cast("bigint").alias("min_user_events"),
                     F.coalesce(F.col(f"_u{k}"), F.lit(0)).cast("bigint").alias("users_kept"),
                     share(F.col(f"_u{k}"), F.col("_u")).alias("user_share_kept"),
                     F.coalesce(F.col(f"_e{k}"), F.lit(0)).cast("bigint").alias("events_kept"),
                     share(F.col(f"_e{k}"), F.col("_e")).alias("event_share_kept")) for k in thresholds]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def low_frequency_share(log: DataFrame, thresholds: Sequence[int] = LOW_FREQUENCY_THRESHOLDS) -> DataFrame:
    """Items with no transaction, and items with fewer than k events."""
    items = item_metrics(log)
    aggs = [F.count(F.lit(1)).cast("bigint").alias("item_count"),
            F.count_if(F.col("transaction_event_count") == 0).cast("bigint").alias("no_transaction_item_count")]
    aggs += [F.count_if(F.col("total_behavior_count") < k).cast("bigint").alias(f"items_below_{k}_events_count")
             for k in thresholds]
    agg = items.agg(*aggs)
    out = [F.col("item_count"), F.col("no_transaction_item_count"),
           share("no_transaction_item_count", "item_count").alias("no_transaction_item_share")]
    for k in thresholds:
        c = f"items_below_{k}_events_count"
        out += [F.col(c), share(c, "item_count").alias(f"items_below_{k}_events_share")]
    return agg.select(*out)


def new_item_cohorts(log: DataFrame, schemes: Sequence[int] = DAY_SCHEMES) -> DataFrame:
    """Items first seen at or after each day-scheme cutoff (validation and test start).

    Among items active at or after the cutoff, how many had no earlier event.
    """
    items = item_metrics(log)
    max_ts = valid_events(log).select(F.max("timestamp")).scalar()
    cut_cols, rows = [], []
    for d in schemes:
        for label, mult in (("test_start", 1), ("validation_start", 2)):
            name = f"last_{d}d_{label}"
            cutoff = max_ts - F.lit(mult * d * DAY_MS)
            cut_cols += [F.count_if(F.col("last_timestamp_ms") >= cutoff).alias(f"_a_{name}"),
                         F.count_if(F.col("first_timestamp_ms") >= cutoff).alias(f"_n_{name}")]
            rows.append((name, cutoff))
    agg = items.agg(*cut_cols)
    structs = [F.struct(F.lit(name).alias("cutoff"), cutoff.alias("cutoff_ms"),
                        F.col(f"_a_{name}").cast("bigint").alias("active_item_count"),
                        F.col(f"_n_{name}").cast("bigint").alias("new_item_count"),
                        share(F.col(f"_n_{name}"), F.col(f"_a_{name}")).alias("new_item_share"))
               for name, cutoff in rows]
    return agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def long_tail_by_universe(log: DataFrame, props: DataFrame) -> DataFrame:
    """Top shares and Gini over three item universes with zero-filled counts:
    event items, property items, and their union."""
    totals = valid_events(log).groupBy("itemid").agg(F.count(F.lit(1)).cast("bigint").alias("total_behavior_count"))
    ev_items = log.filter(F.col("itemid").isNotNull()).select("itemid", F.lit(True).alias("e"), F.lit(False).alias("p"))
    pr_items = props.filter(F.col("itemid").isNotNull()).select("itemid", F.lit(False).alias("e"), F.lit(True).alias("p"))
    flags = ev_items.unionByName(pr_items).groupBy("itemid").agg(F.bool_or("e").alias("e"), F.bool_or("p").alias("p"))
    filled = flags.join(totals, "itemid", "left").select(
        "itemid", "e", "p", F.coalesce("total_behavior_count", F.lit(0)).cast("bigint").alias("total_behavior_count"))
    out = None
    for name, cond in (("event_items", F.col("e")), ("property_items", F.col("p")), ("union_items", F.lit(True))):
        items = filled.filter(cond)
        part = top_share(log, items).unionByName(gini(log, items)).select(F.lit(name).alias("universe"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def history_features(log: DataFrame, bucket_ms: int = 3_600_000) -> DataFrame:
    """Per valid event, leakage-safe history counts strictly before its timestamp:
    the user's events and active UTC days, the item's events, the pair's events.

    Each count is a bucketed prefix sum over distinct instants (copies at one
    instant collapse first); user events and active days are one pass.  Equal
    events meet as one row with their number before the answers are joined, and
    are repeated at the end, so copies of an event never travel to a join.
    """
    v = valid_events(log).groupBy("timestamp", "visitorid", "event", "itemid").agg(F.count(F.lit(1)).cast("bigint").alias("_n"))

    def prior_count(keys: list[str], name: str) -> DataFrame:
        inst = v.groupBy(*keys, "timestamp").agg(F.sum("_n").cast("bigint").alias("_w"))
        return strict_prior(inst, keys, "timestamp", {name: ("sum", "_w")}, bucket_ms).drop("_w")

    item = prior_count(["itemid"], "item_prior_event_count")
    pair = prior_count(["visitorid", "itemid"], "pair_prior_event_count")
    # a day is active before t when its first event is earlier than t
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    day_first = (v.groupBy("visitorid", day_index(F.col("timestamp")).alias("_d")).agg(F.min("timestamp").alias("timestamp"))
                 .select("visitorid", "timestamp", zero.alias("_w"), one.alias("_first")))
    inst = (v.select("visitorid", "timestamp", F.col("_n").alias("_w"), zero.alias("_first")).unionByName(day_first)
            .groupBy("visitorid", "timestamp").agg(F.sum("_w").cast("bigint").alias("_w"), F.sum("_first").cast("bigint").alias("_first")))
    user = strict_prior(inst, ["visitorid"], "timestamp", {"user_prior_event_count": ("sum", "_w"),
                                                           "user_prior_active_day_count": ("sum", "_first")}, bucket_ms).drop("_w", "_first")
    met = (v.join(user, ["visitorid", "timestamp"], "left").join(item, ["itemid", "timestamp"], "left")
           .join(pair, ["visitorid", "itemid", "timestamp"], "left"))
    return met.withColumn("_copy", F.explode(F.sequence(one, F.col("_n")))).select(
        "timestamp", "visitorid", "event", "itemid", "user_prior_event_count",
        "user_prior_active_day_count", "item_prior_event_count", "pair_prior_event_count")


def trend_at_granularity(log: DataFrame, granularity: str) -> DataFrame:
    """X11: event counts per UTC ``hour``, ``day`` or ``week`` (Monday start) x event.

    Periods are rendered as 'YYYY-MM-DD HH:00:00' text computed from epoch ms,
    independent of the session time zone.
    """
    ts = F.col("timestamp")
    d = day_index(ts)
    if granularity == "hour":
        hour = F.floor(F.pmod(ts, F.lit(DAY_MS)) / F.lit(3_600_000)).cast("int")
        period = F.concat(utc_date_text(ts), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))
    elif granularity == "day":
        period = F.concat(utc_date_text(ts), F.lit(" 00:00:00"))
    elif granularity == "week":
        monday = d - F.pmod(d + F.lit(3), F.lit(7))
        period = F.concat(F.date_from_unix_date(monday.cast("int")).cast("string"), F.lit(" 00:00:00"))
    else:
        raise ValueError("granularity must be hour, day or week")
    valid = log.filter(ts.isNotNull() & F.col("event").isNotNull())
    return (valid.groupBy(period.alias("period_start_utc"), F.col("event"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("event_count"))
            .select(F.lit(granularity).alias("granularity"), "*"))
