"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the star-schema tables of ``sf_dir`` whole, through the
observation feed (``sources.observations``), and runs the library's own
operators on it. Sums use ``exact_scale=2`` (values carry two decimals) so
results are reproducible bit for bit; ``plans.oracle`` holds the matching
DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.flows import is_export, is_import, is_production
from tierlake.functions.periods import period_struct
from tierlake.functions.text import blank_to_null, parse_int, parse_number, upper_text
from tierlake.operators import gold, quality
from tierlake.operators.silver import invalid_partition, to_silver
from tierlake.plans import validation
from tierlake.session import checkpoint_dir
from tierlake.sources.observations import observations, raw_feed
from tierlake.sources.tables import table

EXACT_SCALE = 2
# The validation month (the test data spans 1995-01 .. 2001-11).
CHECK_YEAR, CHECK_MONTH = 1998, 6
CHECK_PERIOD = (CHECK_YEAR, CHECK_MONTH)


def _base(spark: SparkSession, d: str, period: tuple[int, int] | None = None) -> DataFrame:
    return gold.base_frame(observations(spark, d, period))


def _cube(spark: SparkSession, d: str, period: tuple[int, int] | None = None) -> DataFrame:
    return gold.flow_cube(_base(spark, d, period), exact_scale=EXACT_SCALE)



def q_monthly_global_production(spark, d):
    return gold.monthly_global_production(_cube(spark, d))


def q_country_production_trend(spark, d):
    return gold.country_production_trend(_cube(spark, d))


def q_top_producers_by_month(spark, d):
    return gold.top_producers_by_month(gold.country_production_trend(_cube(spark, d)))


def q_trade_balance_by_country(spark, d):
    return gold.trade_balance_join(_base(spark, d), exact_scale=EXACT_SCALE)


def q_trade_balance_single_pass(spark, d):
    return gold.trade_balance_by_country(_cube(spark, d))


# Month-scoped validation: the month reaches the fact scan as a ship-date
# range (the feed's counterpart of partition pruning on stored Gold tables).

def q_production_one_month(spark, d):
    monthly = gold.monthly_global_production(_cube(spark, d, CHECK_PERIOD))
    return validation.production_for_month(monthly, CHECK_YEAR, CHECK_MONTH)


def q_trend_top50_month(spark, d):
    trend = gold.country_production_trend(_cube(spark, d, CHECK_PERIOD))
    return validation.trend_top_for_month(trend, CHECK_YEAR, CHECK_MONTH)


def q_top_producers_month(spark, d):
    top = gold.top_producers_by_month(gold.country_production_trend(_cube(spark, d, CHECK_PERIOD)))
    return validation.top_producers_for_month(top, CHECK_YEAR, CHECK_MONTH)


def q_trade_top50_abs_month(spark, d):
    trade = gold.trade_balance_by_country(_cube(spark, d, CHECK_PERIOD))
    return validation.trade_top_abs_for_month(trade, CHECK_YEAR, CHECK_MONTH)


def q_production_sum_filtered(spark, d):
    monthly = gold.monthly_global_production(_cube(spark, d, CHECK_PERIOD))
    return validation.production_sum(monthly, CHECK_YEAR, CHECK_MONTH, EXACT_SCALE)


def q_production_sum_all(spark, d):
    return validation.production_sum(q_monthly_global_production(spark, d), exact_scale=EXACT_SCALE)


def q_gold_row_counts(spark, d):
    return validation.row_counts(_gold_materialized(spark, d))


def q_flow_classes(spark, d):
    flows = observations(spark, d).select("flow").distinct()
    up = upper_text("flow")
    return flows.select(
        "flow",
        up.alias("flow_upper"),
        F.coalesce(is_production(up), F.lit(False)).alias("is_production"),
        F.coalesce(is_import(up), F.lit(False)).alias("is_import"),
        F.coalesce(is_export(up), F.lit(False)).alias("is_export"),
    )


# Period spellings for the parse round trip (Spark datetime patterns).
PERIOD_FORMATS = {
    "dash_month": "yyyy-MM",
    "slash_short_month": "yyyy/M",
    "compact": "yyyyMM",
    "abbr_name_year": "MMM yyyy",
    "year_full_name": "yyyy MMMM",
    "timestamp": "yyyy-MM-dd HH:mm:ss",
    "dotted_date": "yyyy.MM.dd",
}


def q_period_parse(spark, d):
    """Every ship date spelled 7 ways and parsed back to (year, month)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    spelled = F.array(*[
        F.struct(F.lit(name).alias("period_format"), F.date_format("l_shipdate", fmt).alias("period_text"))
        for name, fmt in PERIOD_FORMATS.items()
    ])
    rows = li.select("l_orderkey", "l_linenumber", F.inline(spelled))
    ym = period_struct("period_text")
    return rows.select("l_orderkey", "l_linenumber", "period_format",
                       ym.getField("year").alias("year"), ym.getField("month").alias("month"))


def _text_variants(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    plain = c["c_acctbal"].cast("decimal(18,2)").cast("string")
    texts = {
        "segment": F.col("c_mktsegment"),
        "padded_lower": F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")),
        "name": F.col("c_name"),
        "blank": F.lit(""),
        "spaces": F.lit("   "),
    }
    numbers = {
        "plain": plain,
        "padded": F.concat(F.lit(" "), plain, F.lit("  ")),
        "thousands": F.regexp_replace(plain, r"^([0-9]+)([0-9]{3})[.]", "$1,$2."),
        "exponent": F.concat(plain, F.lit("e0")),
        "garbage": F.lit("n/a"),
        "beyond_double": F.lit("1e400"),
        "nan": F.lit("NaN"),
        "suffix_d": F.concat(plain, F.lit("d")),
    }
    return c, texts, numbers


def _variants(c, mapping):
    arr = F.array(*[F.struct(F.lit(k).alias("variant"), v.alias("text")) for k, v in mapping.items()])
    return c.select("c_custkey", F.inline(arr))


def q_canonical_text(spark, d):
    c, texts, _ = _text_variants(spark, d)
    return _variants(c, texts).select("c_custkey", "variant", "text", blank_to_null("text").alias("cleaned"),
                                      upper_text("text").alias("upper_text"))


def q_numeric_text(spark, d):
    c, _, numbers = _text_variants(spark, d)
    return _variants(c, numbers).select("c_custkey", "variant", "text", parse_number("text").alias("value"))


def q_year_text(spark, d):
    """Year texts to int: digits with an optional plain fraction; no comma, no exponent."""
    c = table(spark, d, "customer").select("c_custkey")
    year = (F.lit(1900) + F.col("c_custkey") % 200).cast("string")
    years = {
        "plain": year,
        "padded": F.concat(F.lit(" "), year, F.lit(" ")),
        "fraction": F.concat(year, F.lit(".0")),
        "comma": F.concat(F.left(year, F.lit(2)), F.lit(","), F.right(year, F.lit(2)), F.lit(".9")),
        "exponent": F.lit("2e3"),
        "blank": F.lit(" "),
        "too_long": F.concat(year, F.lit("00000000")),
    }
    return _variants(c, years).select("c_custkey", "variant", "text", parse_int("text").alias("year"))


def _silver_feed(spark, d):
    return to_silver(raw_feed(spark, d))


def q_silver_partition_counts(spark, d):
    return _silver_feed(spark, d).groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


def q_silver_csv_roundtrip(spark, d):
    """Raw feed -> CSV files with two header layouts -> Silver -> counts and totals per month.

    Lines with a ``Year`` text are written with the feed's column order, the
    others with the reverse order plus an extra column, into one folder under
    the shared checkpoint folder. Reading them back must map values by
    header name. Spark names the files ``part-…csv``, so rows whose only
    period was the file name have none.
    """
    import uuid

    from tierlake.sources.raw_csv import read_raw_csv

    feed = raw_feed(spark, d).drop("source_file_name")
    raw_dir = f"{checkpoint_dir(spark).rstrip('/')}/tierlake-raw-{uuid.uuid4().hex}"
    cols = feed.columns
    has_year = F.col("Year") != ""
    feed.where(has_year).select(*cols).write.option("header", True).mode("append").csv(raw_dir)
    feed.where(~has_year).select(*reversed(cols), F.lit("n/a").alias("Note")) \
        .write.option("header", True).mode("append").csv(raw_dir)
    silver = to_silver(read_raw_csv(spark, raw_dir))
    value = parse_number("obs_value").cast(f"decimal(28,{EXACT_SCALE})")
    return silver.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(value).cast("double").alias("value_total"))


def q_silver_gold_mixed_headers(spark, d):
    """Observations -> CSV with other role names per run -> two Silver runs -> stored Silver -> stored Gold.

    Even months are written as ``country, flow, product, value`` and odd ones
    as ``ref_area, flow_breakdown, energy_product, obs_value``; monthly
    production over the stored tables must count all rows of both.
    """
    import uuid

    from tierlake.plans.medallion import run_gold, run_silver

    root = f"{checkpoint_dir(spark).rstrip('/')}/tierlake-mixed-{uuid.uuid4().hex}"
    feed = observations(spark, d)
    other = {"country": "ref_area", "flow": "flow_breakdown", "product": "energy_product", "value": "obs_value"}
    for i, names in enumerate(({}, other)):
        feed.where(F.col("month") % 2 == i).withColumnsRenamed(names).write.option("header", True).csv(f"{root}/raw{i}")
        run_silver(spark, f"{root}/raw{i}", f"{root}/silver")
    run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=EXACT_SCALE)
    cols = q_monthly_global_production(spark, d).columns
    return spark.read.parquet(f"{root}/gold/gold_monthly_global_production").select(*cols)


def q_invalid_partition_counts(spark, d):
    return _silver_feed(spark, d).agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(invalid_partition()).alias("gate_invalid_rows"),
        F.count_if(invalid_partition(check_year_range=False)).alias("quality_invalid_rows"),
    )


def _gold(spark, d):
    return gold.gold_tables(_cube(spark, d))


def _gold_materialized(spark, d):
    """All four tables over one checkpointed cube: the star-schema joins run
    once although four outputs read the cube (each prunes different columns,
    so Spark could not reuse one exchange for them)."""
    checkpoint_dir(spark)
    return gold.gold_tables(_cube(spark, d).checkpoint())


def q_duplicate_month_keys(spark, d):
    m = quality.grouped_measures(_gold(spark, d)["gold_monthly_global_production"], ["metric_name", "year", "month"])
    return m.select(F.col("rows").alias("row_count"), F.col("dup_groups").alias("duplicate_groups"))


def q_duplicate_rank_keys(spark, d):
    m = quality.grouped_measures(_gold(spark, d)["gold_top_producers_by_month"], ["year", "month", "producer_rank"])
    return m.select(F.col("rows").alias("row_count"), F.col("dup_groups").alias("duplicate_groups"))


def q_rank_range_violations(spark, d):
    top = _gold(spark, d)["gold_top_producers_by_month"]
    return top.agg(F.count(F.lit(1)).alias("row_count"),
                   F.count_if(quality.rank_out_of_range()).alias("invalid_ranks"))


def q_trade_formula_mismatches(spark, d):
    trade = _gold(spark, d)["gold_trade_balance_by_country"]
    return trade.agg(F.count(F.lit(1)).alias("row_count"),
                     F.count_if(quality.formula_mismatch()).alias("mismatches"))


def _sql_month(spark, d, template: str) -> DataFrame:
    """A validation statement as SQL text, over views of the month's Gold tables."""
    db = validation.register_views(spark, gold.gold_tables(_cube(spark, d, CHECK_PERIOD)))
    return spark.sql(template.format(db=db, year=CHECK_YEAR, month=CHECK_MONTH))


def q_sql_top_producers_month(spark, d):
    return _sql_month(spark, d, validation.TOP_PRODUCERS_FOR_MONTH_SQL)


def q_sql_trade_top50_abs_month(spark, d):
    return _sql_month(spark, d, validation.TRADE_TOP_ABS_FOR_MONTH_SQL)


def q_sql_production_sum_filtered(spark, d):
    return _sql_month(spark, d, validation.PRODUCTION_SUM_FILTERED_SQL)


def q_sql_gold_row_counts(spark, d):
    db = validation.register_views(spark, _gold_materialized(spark, d))
    return spark.sql(validation.row_counts_sql(db))


def q_pruning_file_counts(spark, d):
    """Partition layout and pruning: monthly Gold is written as
    ``year=/month=`` partitions (one file each) under the shared checkpoint
    folder and read back. The month predicate is a ``PartitionFilters``
    entry of the scan (asserted in the plan tests), so one data file is read
    for the month and one per month without it."""
    import uuid

    from tierlake.operators.layout import write_partitioned

    path = f"{checkpoint_dir(spark).rstrip('/')}/tierlake-gold-{uuid.uuid4().hex}"
    write_partitioned(gold.monthly_global_production(_cube(spark, d)), path, files_per_partition=1)
    stored = spark.read.parquet(path)
    month = stored.where((F.col("year") == CHECK_YEAR) & (F.col("month") == CHECK_MONTH))

    def files(df, scope):
        return df.agg(F.count_distinct(F.col("_metadata.file_path")).alias("data_files")) \
            .select(F.lit(scope).alias("scope"), "data_files")

    return files(month, "one_month").unionByName(files(stored, "all_months"))


def q_quality_checks(spark, d):
    """The 22 checks over Silver (the observation feed) and the derived Gold tables."""
    checks = quality.checks_for_frames(spark, observations(spark, d), _gold_materialized(spark, d))
    return checks.select("check_name", "status", "actual")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "monthly_global_production": q_monthly_global_production,
    "country_production_trend": q_country_production_trend,
    "top_producers_by_month": q_top_producers_by_month,
    "trade_balance_by_country": q_trade_balance_by_country,
    "trade_balance_single_pass": q_trade_balance_single_pass,
    "production_one_month": q_production_one_month,
    "trend_top50_month": q_trend_top50_month,
    "top_producers_month": q_top_producers_month,
    "trade_top50_abs_month": q_trade_top50_abs_month,
    "production_sum_filtered": q_production_sum_filtered,
    "production_sum_all": q_production_sum_all,
    "gold_row_counts": q_gold_row_counts,
    "flow_classes": q_flow_classes,
    "period_parse": q_period_parse,
    "canonical_text": q_canonical_text,
    "numeric_text": q_numeric_text,
    "year_text": q_year_text,
    "silver_partition_counts": q_silver_partition_counts,
    "invalid_partition_counts": q_invalid_partition_counts,
    "silver_csv_roundtrip": q_silver_csv_roundtrip,
    "silver_gold_mixed_headers": q_silver_gold_mixed_headers,
    "sql_top_producers_month": q_sql_top_producers_month,
    "sql_trade_top50_abs_month": q_sql_trade_top50_abs_month,
    "sql_production_sum_filtered": q_sql_production_sum_filtered,
    "sql_gold_row_counts": q_sql_gold_row_counts,
    "pruning_file_counts": q_pruning_file_counts,
    "duplicate_month_keys": q_duplicate_month_keys,
    "duplicate_rank_keys": q_duplicate_rank_keys,
    "rank_range_violations": q_rank_range_violations,
    "trade_formula_mismatches": q_trade_formula_mismatches,
    "quality_checks": q_quality_checks,
}
