"""trailcheck — Spark-native audit of behaviour logs and item-attribute histories.

Every operator is a plain function over DataFrames that returns a DataFrame
(an *evidence table*).  Heavy work runs as ordinary Spark jobs: grouped
aggregates, windows, range-partitioned order statistics and joins, all with
built-in expressions (no Python UDF).
"""

from trailcheck.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
