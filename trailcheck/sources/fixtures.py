"""Audit-shaped views over the driver's parquet tables.

The audit consumes a behaviour log, an attribute history and a category tree.
The driver ships TPC-H-like tables plus an ``events`` stream, so each view
below maps those tables onto one audit shape (see FIXTURES.md for the same
views in SQL).  All views are lazy projections: Catalyst prunes the parquet
scan to the columns used and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trailcheck.functions.columns import epoch_ms
from trailcheck.sources.order import ROW_ORDER, with_row_order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; the session's split size decides how many tasks read it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (timestamp ms, visitorid, event, itemid, transactionid)."""
    ev = table(spark, sf_dir, "events")
    event = (F.when(F.col("event_type") == "click", "addtocart")
             .when(F.col("event_type") == "purchase", "transaction")
             .otherwise(F.col("event_type")))
    return ev.select(
        epoch_ms(ev, "ts").alias("timestamp"),
        F.col("user_id").cast("bigint").alias("visitorid"),
        event.alias("event"),
        F.get_json_object("props", "$.k").cast("bigint").alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("transactionid"),
    )


def pair_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log with visitor = visitor*1000 + item: many short, single-pair users."""
    lg = log(spark, sf_dir)
    return lg.select("timestamp", (F.col("visitorid") * 1000 + F.col("itemid")).alias("visitorid"),
                     "event", "itemid", "transactionid")


def log_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log with items spread (x37) so property coverage is partial."""
    lg = log(spark, sf_dir)
    return lg.select("timestamp", "visitorid", "event", (F.col("itemid") * 37).alias("itemid"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    event = (F.when(F.col("o_orderstatus") == "P", "view")
             .when(F.col("o_orderstatus") == "O", "addtocart").otherwise("transaction"))
    return o.select(epoch_ms(o, "o_orderdate").alias("timestamp"), F.col("o_custkey").alias("visitorid"),
                    event.alias("event"), (F.col("o_orderkey") % 1000).alias("itemid"))


def star_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to orders: day-grain timestamps, many ties."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    event = (F.when(F.col("l_returnflag") == "N", "view")
             .when(F.col("l_returnflag") == "A", "addtocart").otherwise("transaction"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(epoch_ms(li, "l_shipdate").alias("timestamp"), F.col("o_custkey").alias("visitorid"),
                    event.alias("event"), (F.col("l_partkey") % 400).alias("itemid"))


def tie_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star_log(spark, sf_dir)
    return s.select("timestamp", (F.col("visitorid") % 50).alias("visitorid"), "event",
                    (F.col("itemid") % 20).alias("itemid"))


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> attribute history with two parts, nulls and junk values.

    One scan of lineitem emits up to three property rows per line through an
    exploded array (instead of three unioned scans).
    """
    li = table(spark, sf_dir, "lineitem")
    ts0 = epoch_ms(li, "l_shipdate")
    rec = lambda name, value: F.struct(F.lit(name).alias("property"), value.cast("string").alias("value"))
    records = F.array(
        rec("available", F.when(F.col("l_linestatus") == "O", "1").otherwise("0")),
        rec("790", F.round(F.col("l_discount") * 100).cast("int")),
        F.when(F.col("l_partkey") % 7 != 0,
               rec("categoryid", F.when(F.col("l_partkey") % 10 < 8, F.col("l_partkey") % 50))),
    )
    base = li.select(ts0.alias("ts0"), "l_partkey", "l_suppkey", "l_linenumber",
                     F.explode(records).alias("r")).filter(F.col("r").isNotNull())
    drop_ts = (F.col("l_linenumber") == 6) & (F.col("l_suppkey") % 10 == 0)
    drop_item = (F.col("l_linenumber") == 7) & (F.col("l_suppkey") % 10 == 0)
    return base.select(
        F.when(drop_ts, F.lit(None).cast("bigint")).otherwise(F.col("ts0")).alias("timestamp"),
        F.when(drop_item, F.lit(None).cast("bigint")).otherwise(F.col("l_partkey")).alias("itemid"),
        F.col("r.property").alias("property"),
        F.when(drop_item, F.concat(F.lit("x"), F.col("l_suppkey").cast("string"))).otherwise(F.col("r.value")).alias("value"),
        F.when(F.col("l_linenumber") <= 3, "part1").otherwise("part2").alias("_source_name"),
    )


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> (row_key, raw_value): last URL segment as untrusted id text."""
    p = table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").cast("string").alias("row_key"),
                    F.nullif(F.regexp_extract("url", "/([^/]*)$", 1), F.lit("")).alias("raw_value"))


def tree_func(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> functional graph with roots, missing parents and cycles."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("categoryid"),
                    F.when(F.col("p_partkey") % 97 == 0, F.lit(None).cast("bigint"))
                    .otherwise((F.col("p_partkey") * 7 + 3) % 2100).alias("parentid"))


def tree_heap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> binary heap (one root, every node resolves)."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("categoryid"),
                    F.when(F.col("p_partkey") == 0, F.lit(None).cast("bigint"))
                    .otherwise(F.floor((F.col("p_partkey") - 1) / 2).cast("bigint")).alias("parentid"))


def tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> a tree whose categories are named many times, with the order of the rows."""
    li = with_row_order(table(spark, sf_dir, "lineitem"))
    parent = F.when(F.col("l_suppkey") % 13 != 0, (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 2100)
    return li.select((F.col("l_partkey") % 2000).alias("categoryid"), parent.alias("parentid"), ROW_ORDER)


def order_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> cents, the price in whole cents."""
    return table(spark, sf_dir, "orders").select(F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


# ------------------------------------------------------------ raw text sources
PART_NAMES = {"part1": "item_properties_part1", "part2": "item_properties_part2"}


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns as the text a CSV scan would yield."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def tag_parts_text(p: DataFrame) -> DataFrame:
    """Property history as text, tagged with the declared part names."""
    tag = F.when(F.col("_source_name") == "part1", PART_NAMES["part1"]).otherwise(PART_NAMES["part2"])
    return p.select(*[F.col(c).cast("string").alias(c) for c in ["timestamp", "itemid", "property", "value"]],
                    tag.alias("_source_name"))


def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log as the text a CSV scan would yield."""
    return as_text(log(spark, sf_dir), ["timestamp", "visitorid", "event", "itemid", "transactionid"])


def props_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute history as text, tagged with the declared part name."""
    return tag_parts_text(props(spark, sf_dir))


def tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(tree_func(spark, sf_dir), ["categoryid", "parentid"])
