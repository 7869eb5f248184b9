"""Partitioned parquet sinks with file-count control.

``write_partitioned`` lays a frame out as ``year=Y/month=M/`` directories.

* ``files_per_partition = k``: every month is spread over up to ``k``
  files. Hashing by ``(year, month)`` alone would put a whole month into one
  task whatever ``k`` is, so a salt ``pmod(xxhash64(row), k)`` joins the
  shuffle key when ``k > 1``.
* ``max_rows_per_file``: a month with more rows gets proportionally more
  salts, so a month holding a third of all rows is written by many tasks,
  not one; ``maxRecordsPerFile`` ends a file at that many rows.
* A task takes several salts (about ``ROWS_PER_TASK`` rows): neighbouring ones
  of a large month, so that it opens few directories, and of small months
  one each. The shuffle has as many blocks as the rows need, not one per file
  and input task.

The salt is a hash of the row, not a random number, so a task re-run after
an executor loss sends every row to the same place again. Per-month salt
counts come from the stats the caller already computed (bounded: one row
per directory written) and reach the rows through a broadcast join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("year", "month")
# Default cap per file (and so per write task): a month larger than this is
# spread over several tasks instead of landing whole in one.
DEFAULT_MAX_ROWS_PER_FILE = 5_000_000
# Rows that a write task takes about, where months are small.
ROWS_PER_TASK = 500_000


def partition_counts(df: DataFrame) -> list[tuple[int, int, int]]:
    """``(year, month, rows)`` per partition (one row per output directory)."""
    return [(r["year"], r["month"], r["rows"]) for r in
            df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("rows")).collect()]


def salts_for(rows: int, files_per_partition: int, max_rows_per_file: int | None) -> int:
    salts = max(1, files_per_partition)
    if max_rows_per_file:
        salts = max(salts, math.ceil(rows / max_rows_per_file))
    return salts


def _tasks(spark, stats: list[tuple[int, int, int]]) -> int:
    """Write tasks for so many rows, where files don't ask for fewer."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(sum(n for _, _, n in stats) / ROWS_PER_TASK))


def _salt_plan(spark, stats, plan: list[tuple[int, int, int]], files_per_partition: int) -> tuple[int, DataFrame]:
    """The number of write tasks, and ``_first`` and ``_step`` of each month's salts in the numbering of all salts.

    The salts of months with no more than ``files_per_partition`` come first, one of each month in turn, so that
    a month's lie apart; those of a larger month are neighbours. Tasks take equal ranges of the numbers.
    """
    small = [p for p in plan if p[2] <= files_per_partition]
    large = [p for p in plan if p[2] > files_per_partition]
    firsts = itertools.accumulate((s for _, _, s in large), initial=len(small) * max(1, files_per_partition))
    rows = [(*p, i, len(small)) for i, p in enumerate(small)] + [(*p, first, 1) for p, first in zip(large, firsts)]
    salts = spark.createDataFrame(rows, "year int, month int, _salts int, _first int, _step int")
    return min(sum(s for _, _, s in plan), _tasks(spark, stats)), F.broadcast(salts)


def write_partitioned(df: DataFrame, path: str, stats: list[tuple[int, int, int]] | None = None,
                      files_per_partition: int = 1, max_rows_per_file: int | None = DEFAULT_MAX_ROWS_PER_FILE,
                      dynamic: bool = True, shuffle: bool = True,
                      unpack: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Write ``df`` partitioned by year/month; returns the number of write tasks
    (0 when written straight from its own partitions).

    ``dynamic=True`` replaces only the partitions present in ``df``.
    ``max_rows_per_file=None`` gives exactly the ``files_per_partition`` plan.
    ``shuffle=False`` writes each input partition's rows as they are (no
    exchange): right when every input partition holds a single month, as
    with monthly source files. ``unpack`` makes the table's rows of ``df``'s,
    which may hold several rows of one month each, after the shuffle; the
    stats count the unpacked rows.
    """
    if stats is None:
        stats = partition_counts(df if unpack is None else unpack(df))
    if not stats:
        raise ValueError(f"No rows to write for {path}.")
    spark = df.sparkSession
    plan = [(y, m, salts_for(n, files_per_partition, max_rows_per_file)) for y, m, n in stats]
    total = max(1, sum(s for _, _, s in plan))
    cols = df.columns
    if not shuffle:
        out, total = df, 0
    elif all(s == 1 for _, _, s in plan):
        # A task may take several small months (each is still one file); large ones get a task each.
        total = min(total, _tasks(spark, stats))
        out = df.repartition(total, *PARTITION_COLUMNS)
    else:
        total, salts = _salt_plan(spark, stats, plan, files_per_partition)
        row_hash = F.xxhash64(*[F.col(c) for c in cols if c not in PARTITION_COLUMNS])
        # Left join: a row whose partition is missing from the stats (or is
        # NULL, which an equi-join never matches) keeps one salt, never drops.
        out = (
            df.join(salts, list(PARTITION_COLUMNS), "left")
            .withColumn("_salt", F.coalesce(F.col("_first") + F.col("_step") * F.pmod(row_hash, F.col("_salts")), F.lit(0)))
            .repartitionById(total, F.floor(F.col("_salt") * total / sum(s for _, _, s in plan)).cast("int"))
            .select(*cols)
        )
    out = out if unpack is None else unpack(out)
    # Count what the write actually sees (a counter in the write stage, no
    # extra pass) and compare it with the stats the plan was sized from.
    observed = Observation("tierlake_write")
    out = out.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*PARTITION_COLUMNS)
    )
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path.rstrip("/"))
    written = observed.get["rows"]
    expected = sum(n for _, _, n in stats)
    if written != expected:
        raise RuntimeError(f"Wrote {written} rows to {path} but the partition stats counted {expected}; "
                           "the input changed between the two passes.")
    return total


def stored_months(spark, path: str, *extra) -> DataFrame:
    """``year, month, row_count, files, content`` of a stored table, plus the ``extra`` aggregates.

    ``content`` is the sum of the rows' hashes, equal for equal rows in any
    order and number of files. One pass with partial sums per month.
    """
    df = spark.read.parquet(path.rstrip("/"))
    data = [F.col(c) for c in df.columns if c not in PARTITION_COLUMNS]
    return df.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
        F.sum(F.xxhash64(*data).cast("decimal(38,0)")).alias("content"), *extra)


def month_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a write did to each month, from :func:`stored_months` taken before and after it.

    ``year, month, change, rows_before, rows_after`` with ``change`` one of
    ``added``, ``removed``, ``replaced`` (other rows) and ``unchanged`` (the
    same rows, in whatever files). Take ``before`` from a checkpoint: the write
    replaces the files it would be read from.
    """
    keys = list(PARTITION_COLUMNS)
    old = before.select(*keys, F.col("row_count").alias("rows_before"), F.col("content").alias("old"))
    new = after.select(*keys, F.col("row_count").alias("rows_after"), F.col("content").alias("new"))
    same = (F.col("rows_before") == F.col("rows_after")) & (F.col("old") == F.col("new"))
    change = (F.when(F.col("rows_before").isNull(), "added").when(F.col("rows_after").isNull(), "removed")
              .when(same, "unchanged").otherwise("replaced"))
    return old.join(new, keys, "full_outer").select(*keys, change.alias("change"), "rows_before", "rows_after")


def file_bounds(spark, path: str, stats: list[tuple[int, int, int]], files_per_partition: int,
                max_rows_per_file: int) -> DataFrame:
    """Whether a salted write kept its file contract, per month.

    ``year, month, row_count, salts, files, largest_file`` and ``within_bounds``:
    no file has more than ``max_rows_per_file`` rows, there are as many files
    as that needs at least, and at most one per salt plus those that the cap
    on a file's rows adds.
    """
    plan = [(y, m, salts_for(n, files_per_partition, max_rows_per_file), math.ceil(n / max_rows_per_file)) for y, m, n in stats]
    salts = F.broadcast(spark.createDataFrame(plan, "year int, month int, salts int, needed int"))  # a row a directory
    per_file = spark.read.parquet(path.rstrip("/")).groupBy(
        *PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    months = per_file.groupBy(*PARTITION_COLUMNS).agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("files"), F.max("n").alias("largest_file"))
    ok = ((F.col("largest_file") <= max_rows_per_file) & (F.col("files") >= F.col("needed"))
          & (F.col("files") <= F.col("salts") + F.col("needed")))
    return months.join(salts, list(PARTITION_COLUMNS)).select(
        *PARTITION_COLUMNS, "row_count", "salts", "files", "largest_file", ok.alias("within_bounds"))


def data_files(spark, path: str) -> DataFrame:
    """``file_path, year, month`` of every parquet file actually read for ``path``."""
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_path"), *PARTITION_COLUMNS).distinct()
