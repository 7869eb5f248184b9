"""File-count control, dynamic partition overwrite and pruning on the written layout."""

import os

from pyspark.sql import functions as F

from tierlake.operators.layout import write_partitioned


def _files(path):
    out = {}
    for dp, _, fs in os.walk(path):
        n = len([f for f in fs if f.endswith(".parquet")])
        if n:
            out[os.path.relpath(dp, path)] = n
    return out


def _frame(spark, rows_per_month=1200):
    return spark.range(12 * rows_per_month).select(
        F.lit(2023).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        F.col("id").cast("double").alias("value"),
    )


def test_one_file_per_partition(spark, tmp_dir):
    write_partitioned(_frame(spark), f"{tmp_dir}/k1")
    files = _files(f"{tmp_dir}/k1")
    assert len(files) == 12 and set(files.values()) == {1}


def test_k_files_per_partition(spark, tmp_dir):
    write_partitioned(_frame(spark), f"{tmp_dir}/k3", files_per_partition=3)
    files = _files(f"{tmp_dir}/k3")
    assert len(files) == 12 and max(files.values()) <= 3 and sum(files.values()) > 12


def test_hot_partition_split_by_size(spark, tmp_dir):
    df = _frame(spark, 100).unionByName(
        spark.range(6000).select(F.lit(2023).cast("int").alias("year"), F.lit(6).cast("int").alias("month"),
                                 F.col("id").cast("double").alias("value")))
    write_partitioned(df, f"{tmp_dir}/hot", max_rows_per_file=1000)
    files = _files(f"{tmp_dir}/hot")
    assert files["year=2023/month=6"] >= 4 and files["year=2023/month=1"] == 1
    assert spark.read.parquet(f"{tmp_dir}/hot").count() == 7200


def test_dynamic_overwrite_replaces_only_present_months(spark, tmp_dir):
    path = f"{tmp_dir}/dyn"
    write_partitioned(_frame(spark), path)
    june = _frame(spark).where("month = 6").withColumn("value", F.lit(-1.0))
    write_partitioned(june, path)
    df = spark.read.parquet(path)
    assert df.count() == 12 * 1200
    assert df.where("month = 6 AND value = -1").count() == 1200
    assert df.where("month = 5 AND value = -1").count() == 0


def test_month_filter_reads_one_file(spark, tmp_dir):
    write_partitioned(_frame(spark), f"{tmp_dir}/prune")
    df = spark.read.parquet(f"{tmp_dir}/prune")
    one = df.where("year = 2023 AND month = 6").select(F.col("_metadata.file_path")).distinct().count()
    every = df.select(F.col("_metadata.file_path")).distinct().count()
    assert (one, every) == (1, 12)


def test_salted_write_keeps_rows_with_null_partition(spark, tmp_dir):
    df = _frame(spark, 100).unionByName(
        spark.range(50).select(F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"),
                               F.col("id").cast("double").alias("value")))
    write_partitioned(df, f"{tmp_dir}/nulls", files_per_partition=3)
    back = spark.read.parquet(f"{tmp_dir}/nulls")
    assert back.count() == 1250 and back.where("year IS NULL").count() == 50


def test_stale_stats_are_detected(spark, tmp_dir):
    import pytest
    df = _frame(spark, 10)
    stats = [(2023, m, 10) for m in range(1, 13)]
    stats[0] = (2023, 1, 9)
    with pytest.raises(RuntimeError, match="Wrote 120 rows"):
        write_partitioned(df, f"{tmp_dir}/stale", stats)


def test_salted_write_takes_tasks_by_rows_not_by_files(spark, tmp_dir):
    """A task writes the files of several salts; a large month's rows go to all of its share of the tasks."""
    cores = spark.sparkContext.defaultParallelism
    df = _frame(spark, 50).unionByName(
        spark.range(20_000).select(F.lit(2023).cast("int").alias("year"), F.lit(6).cast("int").alias("month"),
                                   F.col("id").cast("double").alias("value")))
    tasks = write_partitioned(df, f"{tmp_dir}/salts", files_per_partition=2, max_rows_per_file=100)
    assert tasks == min(cores, 222)  # 222 salts
    rows = spark.read.parquet(f"{tmp_dir}/salts").groupBy("month", F.col("_metadata.file_path").alias("file")).count().collect()
    assert sum(r["count"] for r in rows) == 20_600 and max(r["count"] for r in rows) <= 100
    june = [r for r in rows if r["month"] == 6]
    assert 201 <= len(june) <= 201 + cores
    assert all(sum(r["month"] == m for r in rows) <= 2 for m in range(1, 13) if m != 6)


def test_packed_rows_are_unpacked_after_the_shuffle(spark, tmp_dir):
    """Salts, bounds and stats are those of the unpacked rows; only the packed ones are shuffled."""
    packed = spark.range(3000).select(
        F.array(*[F.struct((F.col("id") * 3 + i).alias("value")) for i in range(3)]).alias("rows"),
        F.lit(2023).alias("year"), F.when(F.col("id") < 2500, 6).otherwise(7).cast("int").alias("month"))

    def unpack(df):
        return df.select(F.inline("rows"), "year", "month")

    write_partitioned(packed, f"{tmp_dir}/packed", max_rows_per_file=1000, unpack=unpack)
    write_partitioned(packed, f"{tmp_dir}/plain", files_per_partition=1, unpack=unpack)
    back = spark.read.parquet(f"{tmp_dir}/packed")
    assert sorted(back.collect()) == sorted(spark.read.parquet(f"{tmp_dir}/plain").collect()) == sorted(unpack(packed).collect())
    files = back.groupBy("month", F.col("_metadata.file_path").alias("file")).count().collect()
    assert max(r["count"] for r in files) <= 1000 and sum(r["month"] == 6 for r in files) >= 8
    assert _files(f"{tmp_dir}/plain") == {"year=2023/month=6": 1, "year=2023/month=7": 1}


def test_overwrite_query_counts_once_and_shuffles_packed_rows(spark, monkeypatch):
    from tests.conftest import SF001
    from tierlake.plans import job_queries
    calls = []
    counts, write = job_queries.partition_counts, job_queries.write_partitioned
    monkeypatch.setattr(job_queries, "partition_counts", lambda df: calls.append("count") or counts(df))
    monkeypatch.setattr(job_queries, "write_partitioned",
                        lambda df, path, stats=None, **kw: calls.append(stats is not None and "rows" in df.columns) or write(df, path, stats, **kw))
    assert job_queries.q_silver_overwrite(spark, SF001).count() > 0
    assert calls == ["count", True, True, True]
