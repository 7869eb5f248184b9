"""Catalog DDL text and session helpers."""

from tierlake.plans import catalog
from tierlake.session import checkpoint_dir


def test_ddl_order_and_shape():
    stmts = catalog.ddl("db", "s3://b/silver/", "s3://b/gold/")
    assert stmts[0] == "CREATE DATABASE IF NOT EXISTS `db`"
    creates = [s for s in stmts if s.startswith("CREATE TABLE")]
    repairs = [s for s in stmts if s.startswith("MSCK REPAIR TABLE")]
    assert len(creates) == 5 and len(repairs) == 5 and stmts.index(repairs[0]) > stmts.index(creates[-1])
    trade = [s for s in creates if "gold_trade_balance_by_country" in s][0]
    assert "PARTITIONED BY (year, month)" in trade and "LOCATION 's3://b/gold/gold_trade_balance_by_country'" in trade
    assert "`trade_balance_value` DOUBLE" in trade and "USING parquet" in trade
    silver = creates[0]
    assert "`silver`" in silver and "LOCATION 's3://b/silver'" in silver and "`ingested_at_utc` TIMESTAMP" in silver


def test_ddl_is_idempotent(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/silver")
    for t in catalog.GOLD_COLUMNS:
        os.makedirs(f"{tmp_dir}/gold/{t}")
    for _ in range(2):
        catalog.register_tables(spark, "idem_db", f"{tmp_dir}/silver", f"{tmp_dir}/gold")
    names = {r["tableName"] for r in catalog.show_tables(spark, "idem_db").collect()}
    assert {"silver", "gold_monthly_global_production", "gold_trade_balance_by_country"} <= names


def test_checkpoint_dir_is_read_from_session(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first
