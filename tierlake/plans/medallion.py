"""The medallion jobs in order: Silver -> Gold -> catalog -> validation -> quality.

Each job is a plain function over a caller-owned session; they hand data to
each other only through parquet, like separate applications would.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tierlake.operators import gold as G
from tierlake.operators.layout import DEFAULT_MAX_ROWS_PER_FILE, partition_counts, write_partitioned
from tierlake.operators.publish import publish, staging_folder
from tierlake.operators.quality import QualityResult, derive_reports_uri, run_quality
from tierlake.operators.silver import SilverSummary, build_silver
from tierlake.plans.catalog import register_tables
from tierlake.plans.validation import run_validation
from tierlake.session import checkpoint_dir
from tierlake.sources.storage import Storage


def run_silver(spark: SparkSession, raw_uri: str, silver_uri: str, files_per_partition: int = 1,
               max_rows_per_file: int | None = DEFAULT_MAX_ROWS_PER_FILE, full_refresh: bool = False,
               shuffle: bool = True) -> SilverSummary:
    return build_silver(spark, raw_uri, silver_uri, files_per_partition, max_rows_per_file, full_refresh, shuffle)


@dataclass
class GoldSummary:
    rows: dict[str, int]
    partitions: dict[str, int]
    silver_rows: int = 0
    dropped_rows: int = 0  # Silver rows without a valid period or a numeric value


def run_gold(spark: SparkSession, silver_uri: str, gold_uri: str, files_per_partition: int = 1,
             patterns: G.FlowPatterns = G.FlowPatterns(), exact_scale: int | None = None,
             top_n: int = G.TOP_N) -> GoldSummary:
    """Silver parquet -> four Gold tables under ``gold_uri/<table>``.

    Silver is scanned once into the flow cube, which is checkpointed to the
    shared checkpoint folder (small, and a lost executor cannot force a
    second Silver scan). Gates run on the cube; every table is sized before
    the first write, so an empty table stops the job before anything is
    written. All four tables are written to a staging folder and then published
    together (:mod:`tierlake.operators.publish`): a run that fails leaves the
    old Gold as it was.
    """
    checkpoint_dir(spark)
    silver = spark.read.option("mergeSchema", "true").parquet(silver_uri.rstrip("/"))
    if not silver.columns:
        raise G.GoldInputError(f"{silver_uri} has no columns")
    read, used = Observation("silver_rows"), Observation("base_rows")
    layouts = G.header_layouts(silver)
    base = G.base_frame(silver.observe(read, F.count(F.lit(1)).alias("rows")), layouts=layouts).observe(used, F.count(F.lit(1)).alias("rows"))
    cube = G.flow_cube(base, patterns, exact_scale).checkpoint()
    G.check_gates(base, cube)
    tables = G.gold_tables(cube, top_n)
    stats = {name: partition_counts(df) for name, df in tables.items()}
    for name, st in stats.items():
        if not st:
            raise G.GoldInputError(f"{name} would be empty")
    staging = staging_folder(gold_uri)
    try:
        for name, df in tables.items():
            write_partitioned(df, f"{staging}/{name}", stats[name], files_per_partition)
    except Exception:
        Storage(spark).delete(staging)
        raise
    publish(spark, staging, gold_uri, list(tables))
    return GoldSummary(
        rows={n: sum(r for _, _, r in st) for n, st in stats.items()},
        partitions={n: len(st) for n, st in stats.items()},
        silver_rows=read.get["rows"],
        dropped_rows=read.get["rows"] - used.get["rows"],
    )


def run_all(spark: SparkSession, raw_uri: str, silver_uri: str, gold_uri: str, db: str,
            reports_uri: str | None = None, validation_year: int | None = None,
            validation_month: int | None = None, validation_output_uri: str | None = None,
            dataset_name: str = "unknown_dataset", files_per_partition: int = 1,
            exact_scale: int | None = None) -> QualityResult:
    run_silver(spark, raw_uri, silver_uri, files_per_partition)
    run_gold(spark, silver_uri, gold_uri, files_per_partition, exact_scale=exact_scale)
    register_tables(spark, db, silver_uri, gold_uri)
    if validation_year is not None:
        for df in run_validation(spark, db, validation_year, validation_month, validation_output_uri).values():
            if validation_output_uri is None:
                df.collect()
    reports = derive_reports_uri(raw_uri, gold_uri, reports_uri)
    return run_quality(spark, silver_uri, gold_uri, reports, dataset_name=dataset_name, raw_uri=raw_uri)
