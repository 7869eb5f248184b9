"""Silver layer: raw rows + lineage columns + typed ``year``/``month`` partitions.

The gate (no row may lack a valid period) and the write sizing come from
one narrow aggregate, :func:`file_partition_stats`, grouped by source file
and *valid* partition (all invalid rows of a file fall into one NULL group).
It is checkpointed; only the month totals (at most 201 x 12 + 1 rows)
and up to 5 example files are collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.columns import normalize_columns
from tierlake.functions.periods import with_partition_columns
from tierlake.session import checkpoint_dir
from tierlake.sources.raw_csv import FILE_COLUMN, read_raw_csv

MIN_YEAR, MAX_YEAR = 1900, 2100
INGESTED_COLUMN = "ingested_at_utc"


class SilverGateError(ValueError):
    """Some rows have no valid (year, month)."""


def to_silver(raw: DataFrame) -> DataFrame:
    """Normalised raw columns + ``source_file_name`` + ``ingested_at_utc`` +
    ``year``/``month`` (replacing raw columns of those names in place).

    ``raw`` must carry ``source_file_name`` (the CSV reader adds it).
    """
    df = normalize_columns(raw)
    if FILE_COLUMN not in df.columns:
        df = df.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))
    df = df.withColumn(INGESTED_COLUMN, F.current_timestamp())
    return with_partition_columns(df, FILE_COLUMN)


def invalid_partition(year: Column | str = "year", month: Column | str = "month",
                      check_year_range: bool = True) -> Column:
    """Row-level test: NULL year/month, month outside 1..12 and, for the
    Silver gate, year outside 1900..2100 (the quality check omits the year
    range)."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    bad = y.isNull() | m.isNull() | (m < 1) | (m > 12)
    if check_year_range:
        bad = bad | (y < MIN_YEAR) | (y > MAX_YEAR)
    return bad


def file_partition_stats(silver: DataFrame) -> DataFrame:
    """``source_file_name, year, month, rows``: one row per (file, valid
    month), plus one NULL row per file for its invalid rows. Small (about one
    row per file when files are monthly); one shuffle of partial counts."""
    ok = ~invalid_partition()
    return silver.groupBy(
        F.col(FILE_COLUMN), F.when(ok, F.col("year")).alias("year"), F.when(ok, F.col("month")).alias("month")
    ).agg(F.count(F.lit(1)).alias("rows"))


@dataclass
class SilverSummary:
    rows: int
    partitions: int
    invalid_rows: int
    stats: list  # [(year, month, rows)] for valid partitions
    invalid_files: list = field(default_factory=list)  # up to 5 files with invalid rows


def summarize(silver: DataFrame) -> SilverSummary:
    """One narrow pass over the raw files (only the columns that feed
    ``year``/``month`` are read), kept as a small per-file table in the shared
    checkpoint folder; the month totals and the gate's example files are read from it, not from the raw files again."""
    checkpoint_dir(silver.sparkSession)
    per_file = file_partition_stats(silver).checkpoint()
    stats = per_file.groupBy("year", "month").agg(F.sum("rows").alias("rows")).collect()
    valid = [(r["year"], r["month"], r["rows"]) for r in stats if r["year"] is not None]
    invalid = sum(r["rows"] for r in stats if r["year"] is None)
    files = []
    if invalid:
        files = [r[FILE_COLUMN] for r in
                 per_file.where(F.col("year").isNull()).select(FILE_COLUMN).orderBy(FILE_COLUMN).limit(5).collect()]
    return SilverSummary(
        rows=sum(r[2] for r in valid) + invalid, partitions=len(valid), invalid_rows=invalid, stats=valid,
        invalid_files=files,
    )


def gate_verdict(silver: DataFrame, sample: int = 5) -> DataFrame:
    """The Silver gate as data: one row ``gate, status, row_count, invalid_rows, sample_files``.

    ``sample_files`` are the first ``sample`` names of files with invalid
    rows, in order: each task keeps that many, whatever the number of files.
    One narrow pass over the rows; the per-file table is checkpointed.
    """
    checkpoint_dir(silver.sparkSession)
    per_file = file_partition_stats(silver).checkpoint()
    bad = F.col("year").isNull()
    files = per_file.where(bad).select(FILE_COLUMN).orderBy(FILE_COLUMN).limit(sample)
    totals = per_file.select("rows", F.when(bad, F.col("rows")).otherwise(0).alias("invalid"), F.lit(None).cast("string").alias("file"))
    both = totals.unionByName(files.select(F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("invalid"),
                                           F.col(FILE_COLUMN).alias("file")))
    return both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_rows"),
        F.array_sort(F.collect_list("file")).alias("sample_files"),  # at most `sample` names; nulls are left out
    ).select(F.lit("silver_partitions_valid").alias("gate"),
             F.when(F.col("invalid_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
             "row_count", "invalid_rows", "sample_files")


def check_gate(summary: SilverSummary) -> None:
    """Raise with the invalid-row count and up to 5 example files."""
    if summary.invalid_rows == 0:
        return
    raise SilverGateError(
        f"Invalid rows: {summary.invalid_rows} have no year from {MIN_YEAR} to {MAX_YEAR} with a month; "
        f"some are in {summary.invalid_files}"
    )


def build_silver(spark: SparkSession, raw_uri: str, silver_uri: str, files_per_partition: int = 1,
                 max_rows_per_file: int | None = 5_000_000, full_refresh: bool = False,
                 shuffle: bool = True) -> SilverSummary:
    """Raw CSV prefix -> Silver parquet partitioned by ``year``/``month``.

    Two passes over the raw files: a column-pruned stats pass (gate +
    per-partition sizes) and the write. Nothing is written when the gate
    fails. Re-runs replace only the months present in the input unless
    ``full_refresh``.

    The write is hash-partitioned (and salted) as in
    :func:`~tierlake.operators.layout.write_partitioned`, whatever the raw
    files hold: at least ``files_per_partition`` files a month are planned, and
    more for a month over ``max_rows_per_file`` rows. ``shuffle=False``
    writes one file per input split and month instead, without a shuffle.
    """
    from tierlake.operators.layout import write_partitioned

    silver = to_silver(read_raw_csv(spark, raw_uri))
    summary = summarize(silver)
    check_gate(summary)
    write_partitioned(silver, silver_uri, summary.stats, files_per_partition, max_rows_per_file,
                      dynamic=not full_refresh, shuffle=shuffle)
    return summary
