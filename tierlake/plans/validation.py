"""Validation queries over the Gold tables (DataFrame and SQL forms).

Each function is the DataFrame form of one validation statement; the
``*_SQL`` templates are the same statements for ``spark.sql`` against
catalog tables (``{db}`` is the database name). A ``(year, month)``
predicate on a partitioned Gold table becomes a ``PartitionFilters`` entry
in the scan, so only that month's directory is listed and read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.operators.gold import GOLD_TABLES


def _month(df: DataFrame, year: int, month: int) -> DataFrame:
    return df.where((F.col("year") == year) & (F.col("month") == month))


def production_for_month(monthly: DataFrame, year: int, month: int) -> DataFrame:
    return _month(monthly, year, month).select("year", "month", "metric_name", "total_production").orderBy(
        "year", "month"
    )


def trend_top_for_month(trend: DataFrame, year: int, month: int, limit: int = 50) -> DataFrame:
    """Largest producers of a month; ``country`` breaks ties so the limit is deterministic."""
    return (
        _month(trend, year, month)
        .select("year", "month", "country", "production_value")
        .orderBy(F.col("production_value").desc(), F.col("country").asc())
        .limit(limit)
    )


def top_producers_for_month(top: DataFrame, year: int, month: int) -> DataFrame:
    return (
        _month(top, year, month)
        .select("year", "month", "country", "production_value", "producer_rank")
        .orderBy("producer_rank")
    )


def trade_top_abs_for_month(trade: DataFrame, year: int, month: int, limit: int = 50) -> DataFrame:
    return (
        _month(trade, year, month)
        .select("year", "month", "country", "imports_value", "exports_value", "trade_balance_value")
        .orderBy(F.abs(F.col("trade_balance_value")).desc(), F.col("country").asc())
        .limit(limit)
    )


def production_sum(monthly: DataFrame, year: int | None = None, month: int | None = None,
                   exact_scale: int | None = None) -> DataFrame:
    """``SUM(total_production)``, over one month or over all partitions."""
    df = monthly if year is None else _month(monthly, year, month)
    v = F.col("total_production")
    total = F.sum(v) if exact_scale is None else F.sum(v.cast(f"decimal(38,{exact_scale})")).cast("double")
    return df.agg(total.alias("total_production_sum"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table, as one ``UNION ALL``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# SQL forms for the catalog (Spark SQL); {db}, {year}, {month} are filled in.
# The statements' columns, filters, orders and limits are the source project's.
PRODUCTION_FOR_MONTH_SQL = """
SELECT year, month, metric_name, total_production
FROM {db}.gold_monthly_global_production
WHERE year = {year} AND month = {month}
ORDER BY year, month"""

TREND_TOP_FOR_MONTH_SQL = """
SELECT year, month, country, production_value
FROM {db}.gold_country_production_trend
WHERE year = {year} AND month = {month}
ORDER BY production_value DESC, country
LIMIT 50"""

TOP_PRODUCERS_FOR_MONTH_SQL = """
SELECT year, month, country, production_value, producer_rank
FROM {db}.gold_top_producers_by_month
WHERE year = {year} AND month = {month}
ORDER BY producer_rank ASC"""

TRADE_TOP_ABS_FOR_MONTH_SQL = """
SELECT year, month, country, imports_value, exports_value, trade_balance_value
FROM {db}.gold_trade_balance_by_country
WHERE year = {year} AND month = {month}
ORDER BY ABS(trade_balance_value) DESC, country
LIMIT 50"""

PRODUCTION_SUM_FILTERED_SQL = """
SELECT SUM(total_production) AS total_production_sum
FROM {db}.gold_monthly_global_production
WHERE year = {year} AND month = {month}"""

PRODUCTION_SUM_ALL_SQL = """
SELECT SUM(total_production) AS total_production_sum
FROM {db}.gold_monthly_global_production"""


def row_counts_sql(db: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {db}.{t}" for t in GOLD_TABLES
    )


VALIDATION_SQL = {
    "production_for_month": PRODUCTION_FOR_MONTH_SQL,
    "trend_top_for_month": TREND_TOP_FOR_MONTH_SQL,
    "top_producers_for_month": TOP_PRODUCERS_FOR_MONTH_SQL,
    "trade_top_abs_for_month": TRADE_TOP_ABS_FOR_MONTH_SQL,
}


def explain_text(spark, sql: str) -> str:
    """Physical plan text of a statement (``EXPLAIN``)."""
    return spark.sql(f"EXPLAIN {sql}").first()[0]


def pruning_evidence(spark, db: str, year: int, month: int,
                     table: str = "gold_monthly_global_production") -> dict:
    """Proof that a month predicate prunes partitions.

    Compares the plans of the filtered and unfiltered ``SUM`` (the filtered
    scan carries ``PartitionFilters``) and the number of data files each
    actually reads (from ``_metadata.file_path``).
    """
    fq = PRODUCTION_SUM_FILTERED_SQL.format(db=db, year=year, month=month)
    aq = PRODUCTION_SUM_ALL_SQL.format(db=db)
    filtered_plan, all_plan = explain_text(spark, fq), explain_text(spark, aq)
    files = "SELECT COUNT(DISTINCT _metadata.file_path) AS n FROM `{db}`.`{t}`{w}"
    where = f" WHERE year = {year} AND month = {month}"
    return {
        "filtered_has_partition_filters": "PartitionFilters: [" in filtered_plan
        and "PartitionFilters: []" not in filtered_plan,
        "unfiltered_has_partition_filters": "PartitionFilters: []" not in all_plan,
        "filtered_files": spark.sql(files.format(db=db, t=table, w=where)).first()["n"],
        "all_files": spark.sql(files.format(db=db, t=table, w="")).first()["n"],
        "filtered_plan": filtered_plan,
    }


def run_validation(spark, db: str, year: int, month: int, output_uri: str | None = None) -> dict[str, DataFrame]:
    """Run the validation statements; with ``output_uri`` each result is also
    stored under ``<output_uri>/<name>/`` as CSV with a header."""
    results = {name: spark.sql(sql.format(db=db, year=year, month=month)) for name, sql in VALIDATION_SQL.items()}
    results["production_sum_filtered"] = spark.sql(PRODUCTION_SUM_FILTERED_SQL.format(db=db, year=year, month=month))
    results["production_sum_all"] = spark.sql(PRODUCTION_SUM_ALL_SQL.format(db=db))
    results["row_counts"] = spark.sql(row_counts_sql(db))
    if output_uri:
        for name, df in results.items():
            df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{output_uri.rstrip('/')}/{name}")
    return results


# The measure column of each stored result.
RESULT_MEASURES = {
    "production_for_month": "total_production",
    "trend_top_for_month": "production_value",
    "top_producers_for_month": "production_value",
    "trade_top_abs_for_month": "trade_balance_value",
    "production_sum_filtered": "total_production_sum",
    "production_sum_all": "total_production_sum",
    "row_counts": "row_count",
}


def register_views(spark, tables: dict[str, DataFrame]) -> str:
    """Expose Gold DataFrames as global temporary views under their table
    names, so the catalog SQL above runs unchanged; returns the view database."""
    db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    for name, df in tables.items():
        df.createOrReplaceGlobalTempView(name)
    return db
