import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from trailcheck.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


LOG_DDL = "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid string"
PROPS_DDL = "timestamp bigint, itemid bigint, property string, value string, _source_name string"
TREE_DDL = "categoryid bigint, parentid bigint"
