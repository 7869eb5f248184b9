"""Catalog registration: database, external partitioned tables, partition discovery.

Statements are idempotent (``IF NOT EXISTS``); ``MSCK REPAIR TABLE`` adds
the ``year=/month=`` directories present under each location. Works with the
in-memory catalog or a Hive metastore alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import checkpoint_dir

PARTITION_SPEC = "year INT, month INT"

# Catalog view of Silver: a fixed subset of its columns. Silver keeps raw
# text as read (numbers are typed by role in Gold), so value is a string here.
SILVER_COLUMNS = (
    ("country", "STRING"),
    ("area", "STRING"),
    ("product", "STRING"),
    ("flow", "STRING"),
    ("unit", "STRING"),
    ("value", "STRING"),
    ("source_file_name", "STRING"),
    ("ingested_at_utc", "TIMESTAMP"),
)

GOLD_COLUMNS = {
    "gold_monthly_global_production": (("metric_name", "STRING"), ("total_production", "DOUBLE")),
    "gold_country_production_trend": (("country", "STRING"), ("production_value", "DOUBLE")),
    "gold_top_producers_by_month": (
        ("country", "STRING"), ("production_value", "DOUBLE"), ("producer_rank", "INT"),
    ),
    "gold_trade_balance_by_country": (
        ("country", "STRING"), ("imports_value", "DOUBLE"), ("exports_value", "DOUBLE"),
        ("trade_balance_value", "DOUBLE"),
    ),
}

SILVER_TABLE = "silver"


def _q(name: str) -> str:
    return f"`{name}`"


def create_database_sql(db: str) -> str:
    return f"CREATE DATABASE IF NOT EXISTS {_q(db)}"


def create_table_sql(db: str, table: str, columns, location: str) -> str:
    cols = ",\n  ".join(f"{_q(c)} {t}" for c, t in columns)
    return (
        f"CREATE TABLE IF NOT EXISTS {_q(db)}.{_q(table)} (\n  {cols},\n  year INT,\n  month INT\n)\n"
        f"USING parquet\nPARTITIONED BY (year, month)\nLOCATION '{location.rstrip('/')}'"
    )


def repair_sql(db: str, table: str) -> str:
    return f"MSCK REPAIR TABLE {_q(db)}.{_q(table)}"


def ddl(db: str, silver_uri: str, gold_uri: str, silver_table: str = SILVER_TABLE) -> list[str]:
    """All statements in order: database, 5 tables, 5 repairs."""
    tables = [(silver_table, SILVER_COLUMNS, silver_uri)] + [
        (t, cols, f"{gold_uri.rstrip('/')}/{t}") for t, cols in GOLD_COLUMNS.items()
    ]
    stmts = [create_database_sql(db)]
    stmts += [create_table_sql(db, t, cols, loc) for t, cols, loc in tables]
    stmts += [repair_sql(db, t) for t, _, _ in tables]
    return stmts


def table_names(silver_table: str = SILVER_TABLE) -> list[str]:
    return [silver_table, *GOLD_COLUMNS]


def register_tables(spark: SparkSession, db: str, silver_uri: str, gold_uri: str,
                    silver_table: str = SILVER_TABLE) -> list[str]:
    """Run :func:`ddl`. Call it after the layers are written: ``MSCK REPAIR
    TABLE`` lists each table location, which must exist."""
    stmts = ddl(db, silver_uri, gold_uri, silver_table)
    for s in stmts:
        spark.sql(s)
    return stmts


def catalog_rows(spark: SparkSession, db: str, tables: list[str]) -> DataFrame:
    """``table_name, row_count`` as the catalog sees the tables: only rows of registered partitions."""
    return spark.sql("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {_q(db)}.{_q(t)}" for t in tables))


def catalog_partitions(spark: SparkSession, db: str, tables: list[str]) -> DataFrame:
    """``table_name, year, month`` of every registered partition (``SHOW PARTITIONS``; one row a directory)."""
    out = None
    for t in tables:
        spec = F.col("partition")
        part = show_partitions(spark, db, t).select(
            F.lit(t).alias("table_name"),
            F.regexp_extract(spec, "year=([0-9]+)", 1).cast("int").alias("year"),
            F.regexp_extract(spec, "month=([0-9]+)", 1).cast("int").alias("month"))
        out = part if out is None else out.unionByName(part)
    return out


def repair_round_trip(spark: SparkSession, db: str, silver_uri: str, gold_uri: str,
                      silver_table: str = SILVER_TABLE) -> DataFrame:
    """Register the layers in ``db`` and report what partition discovery finds.

    Creates the database and the external tables, counts their rows (none: no
    partition is registered yet), repairs them and counts again. One row per
    table: ``table_name, rows_before, partitions, rows_after``. The counts are
    checkpointed, so the result stays valid when the database is dropped.
    """
    checkpoint_dir(spark)
    stmts = ddl(db, silver_uri, gold_uri, silver_table)
    repairs = [s for s in stmts if s.startswith("MSCK")]
    for s in stmts:
        if s not in repairs:
            spark.sql(s)
    tables = table_names(silver_table)
    before = catalog_rows(spark, db, tables).withColumnRenamed("row_count", "rows_before").checkpoint()
    for s in repairs:
        spark.sql(s)
    after = catalog_rows(spark, db, tables).withColumnRenamed("row_count", "rows_after").checkpoint()
    partitions = catalog_partitions(spark, db, tables).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("partitions"))
    return before.join(partitions, "table_name", "left").join(after, "table_name").select(
        "table_name", "rows_before", F.coalesce("partitions", F.lit(0)).alias("partitions"), "rows_after").checkpoint()


def drop_database(spark: SparkSession, db: str) -> None:
    """Drop the database and its catalog entries; external data stays."""
    spark.sql(f"DROP DATABASE IF EXISTS {_q(db)} CASCADE")


def show_tables(spark: SparkSession, db: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {_q(db)}")


def show_partitions(spark: SparkSession, db: str, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_q(db)}.{_q(table)}")
