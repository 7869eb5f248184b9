"""Staged publishing: Gold changes whole or not at all; what writes changed; gates and reports as rows."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tierlake.operators import gold as G
from tierlake.operators import layout, publish, quality, silver
from tierlake.plans import medallion
from tierlake.plans.catalog import drop_database, repair_round_trip
from tierlake.sources.observations import observations
from tierlake.sources.storage import Storage


def _silver(spark, path, factor=1):
    rows = observations(spark, SF001).where("year = 1996 and month <= 3").withColumn(
        "value", (F.regexp_replace(F.trim("value"), ",", "").try_cast("double") * factor).cast("string"))
    layout.write_partitioned(rows, path)


def _gold(spark, root):
    return {t: sorted(map(tuple, spark.read.parquet(f"{root}/gold/{t}").collect()), key=str) for t in G.GOLD_TABLES}


@pytest.fixture()
def published(spark, tmp_dir):
    _silver(spark, f"{tmp_dir}/silver")
    medallion.run_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold", exact_scale=2)
    old = _gold(spark, tmp_dir)
    _silver(spark, f"{tmp_dir}/silver", 2)
    return tmp_dir, old


def _folders(spark, root):
    return [n for n, _ in Storage(spark).children(f"{root}/gold")]


def test_failed_write_leaves_old_gold(spark, published, monkeypatch):
    root, old = published
    calls = []

    def write(*args, **kwargs):
        calls.append(args[1])
        if len(calls) == 3:
            raise RuntimeError("lost")
        return layout.write_partitioned(*args, **kwargs)

    monkeypatch.setattr(medallion, "write_partitioned", write)
    with pytest.raises(RuntimeError, match="lost"):
        medallion.run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=2)
    assert _gold(spark, root) == old and _folders(spark, root) == sorted(G.GOLD_TABLES)
    monkeypatch.undo()
    medallion.run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=2)
    new = _gold(spark, root)
    assert all(new[t] != old[t] and len(new[t]) == len(old[t]) for t in G.GOLD_TABLES)
    assert _folders(spark, root) == sorted(G.GOLD_TABLES)


@pytest.mark.parametrize("fails_at", [1, 2, 8, 15])
def test_failed_move_is_taken_back(spark, published, monkeypatch, fails_at):
    root, old = published
    move, calls = Storage.move, []

    def failing(self, source, target):
        calls.append(source)
        if len(calls) == fails_at:
            raise OSError("no rename")
        move(self, source, target)

    monkeypatch.setattr(Storage, "move", failing)
    with pytest.raises(OSError, match="no rename"):
        medallion.run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=2)
    assert _gold(spark, root) == old and _folders(spark, root) == sorted(G.GOLD_TABLES)


def test_unfinished_rollback_keeps_the_months(spark, published, monkeypatch):
    root, old = published
    move, calls = Storage.move, []

    def failing(self, source, target):
        calls.append(source)
        if len(calls) >= 2:
            raise OSError("no rename")
        move(self, source, target)

    monkeypatch.setattr(Storage, "move", failing)
    with pytest.raises(RuntimeError, match="_replaced"):
        medallion.run_gold(spark, f"{root}/silver", f"{root}/gold", exact_scale=2)
    staging = next(n for n in _folders(spark, root) if n.startswith("_staging"))
    assert Storage(spark).exists(f"{root}/gold/{staging}/_replaced/{G.GOLD_TABLES[0]}/year=1996/month=1")


def test_publish_keeps_other_months(spark, tmp_dir):
    rows = spark.range(60).select(F.lit(2020).alias("year"), (F.col("id") % 3 + 1).cast("int").alias("month"), "id")
    layout.write_partitioned(rows, f"{tmp_dir}/live/t")
    staging = publish.staging_folder(f"{tmp_dir}/live")
    layout.write_partitioned(rows.where("month = 2").withColumn("id", F.col("id") + 100), f"{staging}/t")
    assert publish.publish(spark, staging, f"{tmp_dir}/live", ["t"]) == 1
    got = {r["month"]: r["s"] for r in spark.read.parquet(f"{tmp_dir}/live/t").groupBy("month").agg(F.sum("id").alias("s")).collect()}
    want = {m: sum(i for i in range(60) if i % 3 + 1 == m) + (2000 if m == 2 else 0) for m in (1, 2, 3)}
    assert got == want


def test_month_changes(spark, tmp_dir):
    rows = spark.range(40).select(F.lit(2020).alias("year"), (F.col("id") % 4 + 1).cast("int").alias("month"), "id")
    layout.write_partitioned(rows, f"{tmp_dir}/t")
    before = layout.stored_months(spark, f"{tmp_dir}/t").checkpoint()
    new = rows.where("month = 2").unionByName(rows.where("month = 3").withColumn("id", F.col("id") + 1)).unionByName(
        rows.where("month = 1").withColumn("month", F.lit(7)))
    layout.write_partitioned(new, f"{tmp_dir}/t", files_per_partition=2)
    Storage(spark).delete(f"{tmp_dir}/t/year=2020/month=4")
    changes = layout.month_changes(before, layout.stored_months(spark, f"{tmp_dir}/t"))
    assert {r["month"]: r["change"] for r in changes.collect()} == {
        1: "unchanged", 2: "unchanged", 3: "replaced", 4: "removed", 7: "added"}


def test_file_bounds_see_a_broken_contract(spark, tmp_dir):
    rows = spark.range(100).select(F.lit(2020).alias("year"), F.lit(1).alias("month"), "id")
    layout.write_partitioned(rows, f"{tmp_dir}/t", max_rows_per_file=100)
    stats = [(2020, 1, 100)]
    assert layout.file_bounds(spark, f"{tmp_dir}/t", stats, 1, 100).first()["within_bounds"]
    assert not layout.file_bounds(spark, f"{tmp_dir}/t", stats, 1, 50).first()["within_bounds"]


def test_repair_counts_survive_the_database(spark, published):
    root, _ = published
    got = repair_round_trip(spark, "repair_db", f"{root}/silver", f"{root}/gold")
    drop_database(spark, "repair_db")
    rows = {r["table_name"]: r for r in got.collect()}
    assert set(rows) == {"silver", *G.GOLD_TABLES}
    assert all(r["rows_before"] == 0 and r["partitions"] == 3 and r["rows_after"] > 0 for r in rows.values())


def test_silver_gate_sample_is_bounded_and_ordered(spark):
    rows = spark.createDataFrame([(f"f{i:02d}.csv", 2020, i % 3 and 13) for i in range(30)], "source_file_name string, year int, month int")
    got = silver.gate_verdict(rows).first()
    assert (got["status"], got["row_count"], got["invalid_rows"]) == ("FAIL", 30, 30)
    assert got["sample_files"] == [f"f{i:02d}.csv" for i in range(5)]
    good = silver.gate_verdict(rows.withColumn("month", F.lit(1))).first()
    assert (good["status"], good["invalid_rows"], good["sample_files"]) == ("PASS", 0, [])
    assert silver.gate_verdict(rows.limit(0)).first()["row_count"] == 0


def test_gold_gate_sample_is_bounded(spark):
    rows = spark.createDataFrame([(2020, 1, "A", f"FLOW {i:03d}", "P", 1.0) for i in range(60)] + [(2020, 1, "A", None, "P", 1.0)],
                                 "year int, month int, country string, flow string, product string, value double")
    got = {r["gate"]: r for r in G.gate_verdicts(rows, G.flow_cube(rows)).collect()}
    assert got["production_present"]["sample_flows"] == [f"FLOW {i:03d}" for i in range(20)]
    assert [got[g]["status"] for g in ("base_not_empty", "production_present", "trade_present")] == ["PASS", "FAIL", "FAIL"]


def test_reports_are_read_back_strictly(spark, tmp_dir):
    checks = spark.createDataFrame([(0, "é", "PASS", "error", "x", None, "d" * 3000)], "ordinal int, check_name string, "
                                   "status string, severity string, expected string, actual string, details string")
    quality.write_report(quality.report_frame(checks, "ünï", "batch", "t", {"raw_uri": None}), f"{tmp_dir}/r/1")
    got = quality.read_reports(spark, f"{tmp_dir}/r").first()
    assert got["dataset_name"] == "ünï" and got["input_paths"] == {"raw_uri": None} and got["summary"]["passed_checks"] == 1
    assert got["checks"][0]["actual"] is None and got["checks"][0]["details"] == "d" * 1000
    line = spark.read.text(f"{tmp_dir}/r/1").first()["value"]
    assert '"actual":null' in line and json.loads(line)["checks"][0]["check_name"] == "é"
    spark.createDataFrame([("no report",)], "value string").write.text(f"{tmp_dir}/r/2")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        quality.read_reports(spark, f"{tmp_dir}/r").collect()


def test_a_table_is_scanned_once(spark):
    tables = G.gold_tables(G.flow_cube(G.base_frame(observations(spark, SF001)), exact_scale=2))
    plan = quality.checks_for_frames(spark, observations(spark, SF001), {G.GOLD_TABLES[3]: tables[G.GOLD_TABLES[3]]})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # one scan of lineitem for Silver, one for the table
    assert sum("l_orderkey" in line and "Relation [" in line for line in text.split("\n")) == 2
