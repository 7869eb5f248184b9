"""Size guards: bounded broadcast."""

import contextlib
import io

from pyspark.sql import functions as F

from tierlake.sources.tables import broadcast_if_bounded


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_only_within_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(10_000).withColumnRenamed("id", "k")
        small = spark.range(100).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(big.join(broadcast_if_bounded(small, 1000), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(broadcast_if_bounded(small, 10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
