"""Registered queries over the jobs' effects: catalog, stored layers, gates, reports, results.

Like :mod:`tierlake.plans.registry`, every query reads the star-schema tables
of ``sf_dir`` whole through the observation feed. What a job writes goes to a
new folder under the shared checkpoint folder and is read back, so the rows
returned are those of the stored result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators import gold, quality
from tierlake.operators.layout import file_bounds, month_changes, partition_counts, stored_months, write_partitioned
from tierlake.operators.silver import gate_verdict, to_silver
from tierlake.plans import catalog, validation
from tierlake.plans.medallion import run_gold
from tierlake.plans.registry import (
    CHECK_MONTH, CHECK_YEAR, EXACT_SCALE, _base, _cube, _gold_materialized,
)
from tierlake.session import checkpoint_dir
from tierlake.sources.observations import observations, packed_observations, raw_feed, unpacked
from tierlake.sources.raw_csv import FILE_COLUMN, read_raw_csv
from tierlake.sources.storage import Storage

# The first batch of the incremental loads ends with this month, the second one starts with the other.
FIRST_UNTIL, SECOND_FROM = 1998 * 100 + 6, 1998 * 100 + 1
# The month that takes a third of all rows and more in the layout query, and its file contract.
FILES_PER_MONTH, ROWS_PER_FILE = 2, 2_000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tierlake-{name}-{uuid.uuid4().hex}"


def _period():
    return F.col("year") * 100 + F.col("month")


def _stored_layers(spark: SparkSession, d: str, root: str) -> tuple[str, str]:
    """Silver and Gold written under ``root``: the observation feed and the four tables of it."""
    silver, golden = f"{root}/silver", f"{root}/gold"
    write_partitioned(observations(spark, d), silver)
    run_gold(spark, silver, golden, exact_scale=EXACT_SCALE)
    return silver, golden


def q_catalog_repair(spark, d):
    """Stored layers as external tables: rows before and after partition discovery, and the partitions found."""
    db = f"tierlake_{uuid.uuid4().hex}"
    silver, golden = _stored_layers(spark, d, _folder(spark, "catalog"))
    try:
        return catalog.repair_round_trip(spark, db, silver, golden)
    finally:
        catalog.drop_database(spark, db)


def q_catalog_partitions(spark, d):
    """``SHOW PARTITIONS`` of the stored layers after discovery, as rows."""
    db = f"tierlake_{uuid.uuid4().hex}"
    silver, golden = _stored_layers(spark, d, _folder(spark, "catalog"))
    try:
        catalog.register_tables(spark, db, silver, golden)
        return catalog.catalog_partitions(spark, db, catalog.table_names())
    finally:
        catalog.drop_database(spark, db)


def q_silver_overwrite(spark, d):
    """Two overlapping batches and a re-run of the second one: what each of the three writes did to each month."""
    path = _folder(spark, "overwrite")
    feed = packed_observations(spark, d)
    # A batch holds whole months; rows without one are in neither.
    counts = [c for c in partition_counts(unpacked(feed)) if None not in c]
    first = feed.where(_period() <= FIRST_UNTIL).withColumn("batch", F.lit("first"))
    second = feed.where(_period() >= SECOND_FROM).withColumn("batch", F.lit("second"))
    label = F.concat_ws("+", F.array_sort(F.collect_set("batch"))).alias("batches")
    months, out = None, None
    in_first = [c for c in counts if c[0] * 100 + c[1] <= FIRST_UNTIL]
    in_second = [c for c in counts if c[0] * 100 + c[1] >= SECOND_FROM]
    for n, (batch, stats) in enumerate(((first, in_first), (second, in_second), (second, in_second)), 1):
        write_partitioned(batch, path, stats, unpack=unpacked)
        after = stored_months(spark, path, label).checkpoint()  # the next write replaces the files
        before = after.limit(0) if months is None else months
        step = month_changes(before, after).join(after.select("year", "month", "batches"), ["year", "month"]).select(
            F.lit(n).alias("write_no"), "year", "month", "change", "rows_before", "rows_after", "batches")
        out = step if out is None else out.unionByName(step)
        months = after
    return out


def q_salted_layout(spark, d):
    """A third of all rows moved to one month: files within bounds and the rows' totals, month by month."""
    path = _folder(spark, "salted")
    hot = F.col("product").endswith("1") | F.col("product").endswith("2") | F.col("product").endswith("3")
    rows = observations(spark, d).withColumns({
        "year": F.when(hot, F.lit(CHECK_YEAR)).otherwise(F.col("year")),
        "month": F.when(hot, F.lit(CHECK_MONTH)).otherwise(F.col("month"))})
    stats = partition_counts(rows)
    write_partitioned(rows, path, stats, FILES_PER_MONTH, ROWS_PER_FILE)
    values = gold.base_frame(spark.read.parquet(path)).groupBy("year", "month").agg(
        F.sum(F.col("value").cast(f"decimal(28,{EXACT_SCALE})")).cast("double").alias("value_total"))
    return file_bounds(spark, path, stats, FILES_PER_MONTH, ROWS_PER_FILE).join(values, ["year", "month"], "left").select(
        "year", "month", "row_count", "salts", "within_bounds", "value_total")


def q_gold_published(spark, d):
    """Gold of the first batch, then of all rows, both through staging and one publishing step: rows and
    production, imports and exports of the live tables by year."""
    root = _folder(spark, "publish")
    feed = observations(spark, d)
    write_partitioned(feed.where(_period() <= FIRST_UNTIL), f"{root}/silver")
    run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=EXACT_SCALE)
    write_partitioned(feed.where(_period() >= SECOND_FROM), f"{root}/silver")
    run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=EXACT_SCALE)
    measures = {
        "gold_monthly_global_production": "total_production", "gold_country_production_trend": "production_value",
        "gold_top_producers_by_month": "production_value", "gold_trade_balance_by_country": "trade_balance_value",
    }
    out = None
    for name, measure in measures.items():
        part = spark.read.parquet(f"{root}/gold/{name}").groupBy("year").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(measure).cast("decimal(38,2)")).cast("double").alias("total")).select(
            F.lit(name).alias("table_name"), "year", "row_count", "total")
        out = part if out is None else out.unionByName(part)
    return out


def q_silver_gate(spark, d):
    """The Silver gate over the raw feed as a row: invalid rows and the first five files that hold some."""
    return gate_verdict(to_silver(raw_feed(spark, d))).withColumn(
        "sample_files", F.array_join("sample_files", "|"))


def q_gold_gates(spark, d):
    """The Gold gates on the whole base and on three damaged ones: empty, without production, without trade."""
    base = _base(spark, d)
    checkpoint_dir(spark)
    flow = F.col("flow")
    inputs = {
        "whole": base,
        "empty": base.where(F.col("year") < 0),
        "no_production": base.where(~flow.contains("PROD")),
        "no_trade": base.where(~flow.contains("IMP") & ~flow.contains("EXP")),
    }
    out = None
    for name, rows in inputs.items():
        cube = gold.flow_cube(rows, exact_scale=EXACT_SCALE).checkpoint()
        part = gold.gate_verdicts(rows, cube).select(
            F.lit(name).alias("input"), "gate", "status", "measure", F.array_join("sample_flows", "|").alias("sample_flows"))
        out = part if out is None else out.unionByName(part)
    return out


def q_quality_report(spark, d):
    """The JSON report of the checks and of one failed record with long details, stored as text and read back."""
    path = _folder(spark, "report")
    checks = quality.checks_for_frames(spark, observations(spark, d), _gold_materialized(spark, d))
    flows = observations(spark, d).agg(F.max("flow").alias("flow"))
    long = flows.select(
        F.lit(1_000).alias("ordinal"), F.lit("länge").alias("check_name"), F.lit("FAIL").alias("status"),
        F.lit(quality.SEVERITY).alias("severity"), F.lit("≤ 1000").alias("expected"),
        F.lit(None).cast("string").alias("actual"), F.rpad("flow", 1_500, "é").alias("details"))
    report = quality.report_frame(checks.unionByName(long), "prüfung", "batch", "2024-01-01T00:00:00Z",
                                  {"raw_uri": None, "silver_uri": "s", "gold_uri": "g", "reports_uri": path})
    quality.write_report(report, path)
    lines = spark.read.text(path).select(F.col("value").contains('"raw_uri":null').alias("nulls_kept"))
    stored = quality.read_reports(spark, path).select(
        "dataset_name", "mode", "generated_at_utc", "summary.*", F.col("input_paths")["gold_uri"].alias("gold_uri"),
        F.posexplode("checks").alias("position", "c")).select("*", "c.*").drop("c")
    kept = lines.select(F.col("nulls_kept")).first()["nulls_kept"]  # the report's one line
    return stored.withColumns({"nulls_kept": F.lit(kept), "details_chars": F.char_length("details")}).drop("details")


def q_unreadable_tables(spark, d):
    """Stored layers with three damages: a table that is missing, one with a damaged footer, one with a damaged
    page. The checks of the other tables go on."""
    root = _folder(spark, "damaged")
    silver, golden = _stored_layers(spark, d, root)
    storage = Storage(spark)
    storage.delete(f"{golden}/gold_country_production_trend")
    footer = f"{golden}/gold_top_producers_by_month/year={CHECK_YEAR}/month={CHECK_MONTH}"
    storage.write(f"{footer}/part-damaged.parquet", b"PAR1 no footer here PAR1")
    page = f"{golden}/gold_trade_balance_by_country/year={CHECK_YEAR}/month={CHECK_MONTH}"
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(page)
    name = stored.select("path", "content").orderBy("path").first()  # one month's file of the balance
    content = bytearray(name["content"])
    content[4:64] = b"\xff" * 60  # the first page's header
    storage.write(name["path"], bytes(content))
    return quality.checks_for_paths(spark, silver, golden).select("check_name", "status")


def _damaged_frames(spark, d) -> dict[str, tuple[DataFrame, dict[str, DataFrame]]]:
    silver, tables = observations(spark, d), _gold_materialized(spark, d)
    monthly, trend, top, trade = (tables[t] for t in gold.GOLD_TABLES)
    names = gold.GOLD_TABLES
    hit = F.col("year") == 1996
    first = monthly.where((F.col("year") == CHECK_YEAR) & (F.col("month") == CHECK_MONTH))
    leader = top.where(hit & (F.col("producer_rank") == 1))
    values = (
        silver.withColumn("month", F.when(hit, F.lit(13)).otherwise(F.col("month"))),
        (monthly.unionByName(first), trend,
         top.unionByName(leader.withColumn("producer_rank", F.lit(11))).unionByName(leader),
         trade.withColumn("trade_balance_value", F.when(hit, F.lit(float("nan"))).otherwise(F.col("trade_balance_value")))))
    columns = (
        silver.drop("month"),
        (monthly.drop("metric_name"), trend.drop("year"), top.drop("producer_rank"), trade.drop("exports_value")))
    empty = (silver.where(F.col("year") < 0), tuple(t.where(F.col("year") < 0) for t in (monthly, trend, top, trade)))
    return {k: (s, dict(zip(names, g))) for k, (s, g) in {"values": values, "columns": columns, "empty": empty}.items()}


def q_quality_failures(spark, d):
    """The checks on damaged tables: wrong values (month 13, rank 11, repeated keys, NaN balances), lost columns,
    no rows."""
    out = None
    for variant, (silver, tables) in _damaged_frames(spark, d).items():
        part = quality.checks_for_frames(spark, silver, tables).select(
            F.lit(variant).alias("variant"), "check_name", "status", "actual")
        out = part if out is None else out.unionByName(part)
    return out


def q_header_names(spark, d):
    """CSV files with two clashing headers through Silver: values per source group and resulting column.

    Part files are renamed ``<group>-<n>.csv``, so that the lineage column names the group.
    """
    root = _folder(spark, "headers")
    storage = Storage(spark)
    feed = observations(spark, d)
    number = F.col("value")
    groups = {
        "clash": feed.where(F.col("month") % 2 == 0).select(
            F.col("country").alias("Country"), number.alias("Obs Value"), F.col("flow").alias("obs-value"),
            F.col("product").alias("OBS_VALUE_2"), F.col("unit").alias("%%"), F.col("year"), F.col("month")),
        "plain": feed.where(F.col("month") % 2 == 1).select(
            F.col("month").alias(" Month "), F.col("year").alias("YEAR"), number.alias("Obs.Value"),
            F.col("flow").alias("%%"), F.col("unit").alias("##"), F.col("country").alias("country!")),
    }
    for group, rows in groups.items():
        rows.write.option("header", True).csv(f"{root}/{group}")
        parts = [n for n, _ in storage.children(f"{root}/{group}") if n.endswith(".csv")]
        for i, part in enumerate(parts):  # names only, one rename a written file
            storage.move(f"{root}/{group}/{part}", f"{root}/raw/{group}-{i}.csv")
    silver = to_silver(read_raw_csv(spark, f"{root}/raw"))
    group = F.regexp_extract(FILE_COLUMN, "/([a-z]+)-[0-9]+[.]csv$", 1).alias("source_group")
    names = [c for c in silver.columns if c != "header_roles"]
    counts = silver.groupBy(group).agg(F.count(F.lit(1)).alias("row_count"), *[F.count(F.col(c)).alias(c) for c in names])
    return counts.unpivot(["source_group", "row_count"], names, "column_name", "value_count")


def q_validation_results(spark, d):
    """All validation statements stored under one prefix as CSV and read back: rows and summed measure of each."""
    root = _folder(spark, "results")
    db = validation.register_views(spark, _gold_materialized(spark, d))
    validation.run_validation(spark, db, CHECK_YEAR, CHECK_MONTH, root)
    stored = spark.read.option("recursiveFileLookup", "true")
    out = None
    for name, measure in validation.RESULT_MEASURES.items():
        rows = stored.option("header", True).csv(f"{root}/{name}")
        part = rows.agg(F.count(F.lit(1)).alias("row_count"),
                        F.sum(F.col(measure).cast("decimal(38,2)")).cast("double").alias("total")).select(
            F.lit(name).alias("statement"), "row_count", "total")
        out = part if out is None else out.unionByName(part)
    return out


JOB_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "catalog_repair": q_catalog_repair,
    "catalog_partitions": q_catalog_partitions,
    "silver_overwrite": q_silver_overwrite,
    "salted_layout": q_salted_layout,
    "gold_published": q_gold_published,
    "silver_gate": q_silver_gate,
    "gold_gates": q_gold_gates,
    "quality_report": q_quality_report,
    "unreadable_tables": q_unreadable_tables,
    "quality_failures": q_quality_failures,
    "header_names": q_header_names,
    "validation_results": q_validation_results,
}
