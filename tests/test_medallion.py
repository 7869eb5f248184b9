"""CSV -> Silver -> Gold -> catalog -> validation -> quality, in a temp folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tierlake.operators import quality as Q
from tierlake.operators.silver import SilverGateError
from tierlake.plans import catalog, medallion, validation

HEADER_A = "Country,Product,Flow,Unit,Year,Month,Value"
HEADER_C = "Value,Month,Year,Unit,Flow,Product,Country,Extra Col"


def _write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    raw.mkdir()
    _write(raw / "a.csv", HEADER_A, [
        ("A", "Crude", "Production", "KBD", "2023", "6", "100"),
        ("B", "Crude", "Production", "KBD", "2023", "6", "\"1,150\""),
        ("A", "Crude", "Imports", "KBD", "2023", "Jun", "30"),
        ("", "Crude", "Production", "KBD", "2023", "7", "7"),
    ])
    _write(raw / "c.csv", HEADER_C, [
        ("20", "7", "2023", "KBD", "Exports", "Crude", "B", "x"),
        ("50", "July", "2023", "KBD", "Production", "Crude", "A", "y"),
        ("n/a", "7", "2023", "KBD", "Production", "Crude", "A", "z"),
    ])
    # no period column at all: the file name gives the month
    _write(raw / "202305.csv", "Country,Product,Flow,Unit,Value", [
        ("C", "Crude", "Production", "KBD", "5"), ("C", "Crude", "Imports", "KBD", "1"),
    ])
    (raw / "notes.txt").write_text("not a csv")
    return root


def test_round_trip(spark, lake):
    raw, silver, gold = str(lake / "raw"), str(lake / "silver"), str(lake / "gold")
    s = medallion.run_silver(spark, raw, silver)
    assert (s.rows, s.partitions, s.invalid_rows) == (9, 3, 0)
    sdf = spark.read.parquet(silver)
    assert {"country", "value", "extra_col", "source_file_name", "ingested_at_utc", "year", "month"} <= set(sdf.columns)
    # header drift: values mapped by name, not position
    row = sdf.where(F.col("source_file_name").endswith("c.csv") & (F.col("flow") == "Exports")).first()
    assert (row["country"], row["value"], row["extra_col"], row["year"], row["month"]) == ("B", "20", "x", 2023, 7)
    may = sdf.where((F.col("year") == 2023) & (F.col("month") == 5)).count()
    assert may == 2

    g = medallion.run_gold(spark, silver, gold)
    assert g.rows == {"gold_monthly_global_production": 3, "gold_country_production_trend": 4,
                      "gold_top_producers_by_month": 4, "gold_trade_balance_by_country": 3}
    monthly = {(r["year"], r["month"]): r["total_production"]
               for r in spark.read.parquet(f"{gold}/gold_monthly_global_production").collect()}
    assert monthly == {(2023, 6): 1250.0, (2023, 7): 57.0, (2023, 5): 5.0}

    catalog.register_tables(spark, "lake_db", silver, gold)
    assert catalog.show_partitions(spark, "lake_db", "gold_trade_balance_by_country").count() == 3
    assert spark.table("lake_db.silver").count() == 9
    ev = validation.pruning_evidence(spark, "lake_db", 2023, 6)
    assert ev["filtered_has_partition_filters"] and ev["filtered_files"] == 1 and ev["all_files"] == 3
    res = validation.run_validation(spark, "lake_db", 2023, 6, str(lake / "validation"))
    assert [tuple(r) for r in res["top_producers_for_month"].collect()] == [
        (2023, 6, "B", 1150.0, 1), (2023, 6, "A", 100.0, 2)]
    assert os.path.isdir(lake / "validation" / "row_counts")

    r = Q.run_quality(spark, silver, gold, str(lake / "reports"), dataset_name="test")
    assert (r.total, r.passed, r.failed) == (22, 22, 0)
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(r.report_path) for f in fs if f.startswith("part-")]
    assert len(files) == 1
    doc = json.loads(open(files[0]).read())
    assert doc["summary"] == {"total_checks": 22, "passed_checks": 22, "failed_checks": 0}
    assert [c["check_name"] for c in doc["checks"]][:3] == ["silver_readable", "silver_non_empty",
                                                            "silver_has_partition_columns"]


def test_gate_blocks_write(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write(raw / "bad.csv", HEADER_A, [("A", "Crude", "Production", "KBD", "1800", "6", "1"),
                                       ("A", "Crude", "Production", "KBD", "2023", "13", "1")])
    with pytest.raises(SilverGateError, match="Invalid rows: 2"):
        medallion.run_silver(spark, str(raw), str(tmp_path / "silver"))
    assert not (tmp_path / "silver").exists()


def test_one_file_per_month(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for month in (1, 2, 3):
        _write(raw / f"2024{month:02d}.csv", "Country,Product,Flow,Unit,Value",
               [(c, "Crude", "Production", "KBD", str(i)) for i, c in enumerate("ABCDEFGH")])
    _write(raw / "extra.csv", HEADER_C, [("9", "3", "2024", "KBD", "Exports", "Crude", "A", "x")])
    s = medallion.run_silver(spark, str(raw), str(tmp_path / "silver"))
    assert (s.rows, s.partitions) == (25, 3)
    per_dir = {}
    for dp, _, fs in os.walk(tmp_path / "silver"):
        n = len([f for f in fs if f.endswith(".parquet")])
        if n:
            per_dir[os.path.basename(dp)] = n
    assert sorted(per_dir) == ["month=1", "month=2", "month=3"]
    # one file per month, however many raw files hold rows of it (March has two)
    assert set(per_dir.values()) == {1}
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 25


def test_headers_that_differ_keep_all_rows(spark, tmp_path):
    """Two runs with other role names: each row is read by its own file's header, over stored Silver."""
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    for n, (header, rows) in enumerate([
        ("Country,Flow,Product,Value,Year,Month", [("A", "Production", "Crude", "100", "2023", "6"), ("B", "Imports", "Crude", "5", "2023", "6")]),
        ("ref_area,flow_breakdown,energy_product,obs_value,year,month", [("C", "Production", "Crude", "900", "2023", "7"),
                                                                         ("D", "Production", "Crude", "x", "2023", "7")]),
    ]):
        raw = tmp_path / f"raw{n}"
        raw.mkdir()
        _write(raw / "a.csv", header, rows)
        medallion.run_silver(spark, str(raw), silver)
    g = medallion.run_gold(spark, silver, gold)
    assert (g.silver_rows, g.dropped_rows) == (4, 1)
    rows = spark.read.parquet(f"{gold}/gold_monthly_global_production").collect()
    assert {(r["month"], r["total_production"]) for r in rows} == {(6, 100.0), (7, 900.0)}


def test_blank_first_line_and_odd_numbers(spark, tmp_path):
    raw, silver, gold = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "gold")
    raw.mkdir()
    (raw / "a.csv").write_text("\n" + "Country,Flow,Product,Value,Year,Month\nA,Production,Crude,7,2023,6\nB,Production,Crude,1e400,2023,6\nA,Imports,Crude,1,2023.0,6\n")
    (raw / "empty.csv").write_text("")
    s = medallion.run_silver(spark, str(raw), silver)
    assert s.rows == 3
    g = medallion.run_gold(spark, silver, gold, exact_scale=2)
    assert g.dropped_rows == 1
    assert spark.read.parquet(f"{gold}/gold_monthly_global_production").first()["total_production"] == 7.0
