"""Input contracts and fixed values.

FIXED VALUES — these must equal the audited system's conventions for results
to agree; they are stated here once, in natural order, and imported elsewhere.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: declared source columns, in header order -----------------
EXPECTED_COLUMNS: dict[str, tuple[str, ...]] = {
    "events": ("timestamp", "visitorid", "event", "itemid", "transactionid"),
    "item_properties_part1": ("timestamp", "itemid", "property", "value"),
    "item_properties_part2": ("timestamp", "itemid", "property", "value"),
    "category_tree": ("categoryid", "parentid"),
}

# integer-typed columns per source (parsed from text, see functions.parsing)
INTEGER_COLUMNS: dict[str, tuple[str, ...]] = {
    "events": ("timestamp", "visitorid", "itemid"),
    "item_properties_part1": ("timestamp", "itemid"),
    "item_properties_part2": ("timestamp", "itemid"),
    "category_tree": ("categoryid", "parentid"),
}

# --- fixed values: text tokens that the CSV scan reads as missing -----------
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: event vocabulary and labels ------------------------------
EXPECTED_EVENTS: tuple[str, ...] = ("view", "addtocart", "transaction")
MISSING_LABEL = "<missing>"

# --- fixed values: sequence-length buckets (lower, upper inclusive, label) --
SEQUENCE_BUCKETS: tuple[tuple[int, int | None, str], ...] = (
    (1, 1, "1"),
    (2, 4, "2-4"),
    (5, 9, "5-9"),
    (10, 19, "10-19"),
    (20, 49, "20-49"),
    (50, 99, "50-99"),
    (100, None, "100+"),
)

# --- fixed values: distribution percentiles ---------------------------------
PERCENTILES: tuple[tuple[str, float], ...] = (
    ("P25", 0.25), ("P50", 0.50), ("P75", 0.75), ("P90", 0.90), ("P95", 0.95), ("P99", 0.99),
)

# --- fixed values: long-tail top shares and split fractions ------------------
TOP_ITEM_FRACTIONS: tuple[float, ...] = (0.01, 0.05, 0.10, 0.20)
TOP_SHARE_RULE = "ceil; ties resolved by ascending itemid"
ALL_ITEMS_RULE = "all event-observed items"
ROW_SPLIT_TRAIN = 0.70
ROW_SPLIT_VALIDATION = 0.85
DAY_MS = 86_400_000
DAY_SCHEMES: tuple[int, ...] = (7, 14)
ROW_SCHEME = "chronological_70_15_15_by_ordered_rows"
SPLITS: tuple[str, ...] = ("train", "validation", "test")


def day_scheme_name(days: int) -> str:
    return f"last_{days}d_test_previous_{days}d_validation"


# --- fixed values: explicitly named item properties -------------------------
SPECIAL_PROPERTIES: tuple[str, ...] = ("categoryid", "available")
EXPLICIT_STATUS = "explicit_dataset_property"
HASHED_STATUS = "unverified_hashed_property"
DUPLICATE_METHOD = "stable_partition_then_exact_original_field_comparison"

# --- fixed values: interval metric names ------------------------------------
PRIOR_VIEW_METRIC = "most_recent_prior_view_interval_ms"
PRIOR_CART_METRIC = "most_recent_prior_addtocart_interval_ms"

# --- fixed values: per-user metrics summarised by the sequence distribution -
USER_METRICS: tuple[str, ...] = (
    "total_behavior_length", "view_length", "distinct_item_count", "active_day_count",
    "lifecycle_ms", "transaction_event_count", "addtocart_event_count",
)

# --- fixed values: evidence scopes ------------------------------------------
FULL_SCOPE = "full"
LIMITED_SCOPE = "smoke_non_evidentiary"


def text_schema(source: str) -> T.StructType:
    """All-string schema of a declared source (the scan never infers types)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in EXPECTED_COLUMNS[source]])


LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.StringType()),
])

PROPS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("property", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("_source_name", T.StringType()),
])

TREE_SCHEMA = T.StructType([
    T.StructField("categoryid", T.LongType()),
    T.StructField("parentid", T.LongType()),
])
