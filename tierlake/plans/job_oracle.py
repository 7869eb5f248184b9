"""DuckDB SQL equivalents of the queries in :mod:`tierlake.plans.job_queries`.

Plain SQL over the star-schema tables: what the stored layers, gates and
reports must hold, derived without any file.
"""

from __future__ import annotations

from tierlake.plans.oracle import (
    _DUPS, _FORMULA_BAD, _GOLD_COLUMNS, _RANK_BAD, BASE, CHECK_MONTH, CHECK_YEAR, OBSERVATIONS, ORACLE_SQL, SILVER_FEED, M, _cols,
    _status, _with,
)

FIRST_UNTIL, SECOND_FROM = 199806, 199801
FILES_PER_MONTH, ROWS_PER_FILE = 2, 2000

JOB_ORACLE_SQL: dict[str, str] = {}

_TABLES = {"silver": "obs", **{t: v for t, (v, _) in _GOLD_COLUMNS.items()}}

JOB_ORACLE_SQL["catalog_repair"] = _with("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 0::BIGINT AS rows_before, "
    f"(SELECT COUNT(*) FROM (SELECT DISTINCT year, month FROM {v})) AS partitions, COUNT(*) AS rows_after FROM {v}"
    for t, v in _TABLES.items()))
JOB_ORACLE_SQL["catalog_partitions"] = _with("\nUNION ALL\n".join(
    f"SELECT DISTINCT '{t}' AS table_name, year, month FROM {v}" for t, v in _TABLES.items()))

# Months before the second batch stay, months of both are replaced, later ones are added; the re-run changes nothing.
JOB_ORACLE_SQL["silver_overwrite"] = "WITH " + OBSERVATIONS + f""",
m AS (SELECT year, month, year * 100 + month AS p, COUNT(*) AS n FROM obs GROUP BY year, month)
SELECT 1 AS write_no, year, month, 'added' AS change, NULL::BIGINT AS rows_before, n AS rows_after, 'first' AS batches
FROM m WHERE p <= {FIRST_UNTIL}
UNION ALL
SELECT 2, year, month, CASE WHEN p < {SECOND_FROM} THEN 'unchanged' WHEN p <= {FIRST_UNTIL} THEN 'replaced' ELSE 'added' END,
       CASE WHEN p <= {FIRST_UNTIL} THEN n END, n, CASE WHEN p < {SECOND_FROM} THEN 'first' ELSE 'second' END FROM m
UNION ALL
SELECT 3, year, month, 'unchanged', n, n, CASE WHEN p < {SECOND_FROM} THEN 'first' ELSE 'second' END FROM m"""

JOB_ORACLE_SQL["salted_layout"] = "WITH " + OBSERVATIONS + f""",
moved AS (
  SELECT CASE WHEN regexp_matches(product, '[123]$') THEN {CHECK_YEAR} ELSE year END AS year,
         CASE WHEN regexp_matches(product, '[123]$') THEN {CHECK_MONTH} ELSE month END AS month,
         CASE WHEN value <> 'n/a' THEN CAST(replace(TRIM(value), ',', '') AS DECIMAL(28,2)) END AS value
  FROM obs)
SELECT year, month, COUNT(*) AS row_count,
       CAST(greatest({FILES_PER_MONTH}, ceil(COUNT(*) / {ROWS_PER_FILE})) AS INTEGER) AS salts, true AS within_bounds,
       CAST(SUM(value) AS DOUBLE) AS value_total
FROM moved GROUP BY year, month"""

_MEASURES = {"gold_monthly_global_production": "total_production", "gold_country_production_trend": "production_value",
             "gold_top_producers_by_month": "production_value", "gold_trade_balance_by_country": "trade_balance_value"}
JOB_ORACLE_SQL["gold_published"] = _with("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, year, COUNT(*) AS row_count, CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE) AS total "
    f"FROM {_GOLD_COLUMNS[t][0]} GROUP BY year" for t, c in _MEASURES.items()))

JOB_ORACLE_SQL["silver_gate"] = "WITH " + SILVER_FEED.replace(
    "SELECT l.l_returnflag AS f,", "SELECT l.l_shipdate, o.o_orderpriority, l.l_returnflag AS f,").replace(
    "SELECT\n    CAST(CASE", """SELECT
    CASE WHEN f = 'A' AND s = 'F' THEN 'file:/lake/raw/' || strftime(l_shipdate, '%Y%m') || '.csv'
         ELSE 'file:/lake/raw/feed-' || lower(o_orderpriority) || '.csv' END AS file,
    CAST(CASE""", 1) + """,
marked AS (SELECT *, year IS NULL OR month IS NULL OR month < 1 OR month > 12 OR year < 1900 OR year > 2100 AS bad FROM silver)
SELECT 'silver_partitions_valid' AS gate, CASE WHEN COUNT(*) FILTER (WHERE bad) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  COUNT(*) AS row_count, COUNT(*) FILTER (WHERE bad) AS invalid_rows,
  COALESCE((SELECT string_agg(file, '|' ORDER BY file) FROM (SELECT DISTINCT file FROM marked WHERE bad ORDER BY file LIMIT 5)), '')
    AS sample_files
FROM marked"""

_INPUTS = {
    "whole": "true",
    "empty": "false",
    "no_production": "NOT COALESCE(contains(flow, 'PROD'), true)",
    "no_trade": "NOT COALESCE(contains(flow, 'IMP') OR contains(flow, 'EXP'), true)",
}
_PRODUCES, _TRADES = "regexp_matches(flow, 'PROD')", "regexp_matches(flow, 'IMP|EXP')"


def _gate_sql(name: str, keep: str) -> str:
    rows = f"(SELECT * FROM base WHERE {keep})"
    groups = f"(SELECT DISTINCT country, year, month FROM {rows} {{w}})"
    counts = {
        "base_not_empty": groups.format(w=""),
        "production_present": groups.format(w=f"WHERE {_PRODUCES}"),
        "trade_present": groups.format(w=f"WHERE {_TRADES}"),
    }
    flows = f"(SELECT string_agg(flow, '|' ORDER BY flow) FROM (SELECT DISTINCT flow FROM {rows} WHERE flow IS NOT NULL ORDER BY flow LIMIT 20))"
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS input, '{gate}' AS gate, {_status('COUNT(*) > 0')} AS status, COUNT(*) AS measure, "
        + (f"CASE WHEN COUNT(*) > 0 THEN '' ELSE COALESCE({flows}, '') END" if gate == "production_present" else "''")
        + f" AS sample_flows FROM {source}" for gate, source in counts.items())


JOB_ORACLE_SQL["gold_gates"] = _with("\nUNION ALL\n".join(_gate_sql(n, k) for n, k in _INPUTS.items()))

# Expected texts of the checks, in report order.
_EXPECTED = [("silver_readable", "Parquet path readable"), ("silver_non_empty", "> 0 rows"),
             ("silver_has_partition_columns", "columns year and month exist"),
             ("silver_valid_year_month_values", "0 invalid partition rows"),
             ("silver_has_partitions", "> 0 distinct year-month partitions")]
_EXPECTED += [(f"{t}_readable", "Parquet path readable") for t in _GOLD_COLUMNS]
_EXPECTED.append(("gold_tables_available", "4 readable gold tables"))
for _t in _GOLD_COLUMNS:
    _EXPECTED += [(f"{_t}_non_empty", "> 0 rows"), (f"{_t}_has_partition_columns", "columns year and month exist")]
_EXPECTED += [("gold_monthly_global_production_unique_key", "0 duplicate (metric_name, year, month)"),
              ("gold_top_producers_rank_range", "producer_rank between 1 and 10"),
              ("gold_top_producers_unique_rank_per_month", "0 duplicate ranks per (year, month)"),
              ("gold_trade_balance_formula_consistent", "exports_value - imports_value = trade_balance_value")]

JOB_ORACLE_SQL["quality_report"] = f"""
WITH checked AS ({ORACLE_SQL['quality_checks']}),
expected(position, check_name, expected) AS (VALUES {', '.join(f"({i}, '{n}', '{e}')" for i, (n, e) in enumerate(_EXPECTED))}),
records AS (
  SELECT position, check_name, status, expected, actual, 0 AS details_chars FROM checked JOIN expected USING (check_name)
  UNION ALL SELECT {len(_EXPECTED)}, 'länge', 'FAIL', '≤ 1000', NULL, 1000)
SELECT 'prüfung' AS dataset_name, 'batch' AS mode, '2024-01-01T00:00:00Z' AS generated_at_utc, 'g' AS gold_uri,
       (SELECT COUNT(*) FROM records) AS total_checks,
       (SELECT COUNT(*) FROM records WHERE status = 'PASS') AS passed_checks,
       (SELECT COUNT(*) FROM records WHERE status = 'FAIL') AS failed_checks,
       CAST(position AS INTEGER) AS position, check_name, status, 'error' AS severity, expected, actual, true AS nulls_kept,
       CAST(details_chars AS INTEGER) AS details_chars
FROM records"""

# The missing table, the one with a damaged footer and the one with a damaged page are not readable: their other
# checks are left out and one table remains.
_LOST = ("gold_country_production_trend", "gold_top_producers_by_month", "gold_trade_balance_by_country")
JOB_ORACLE_SQL["unreadable_tables"] = f"""
WITH checked AS ({ORACLE_SQL['quality_checks']})
SELECT check_name, CASE WHEN check_name IN ('gold_tables_available', {', '.join(f"'{t}_readable'" for t in _LOST)})
                        THEN 'FAIL' ELSE status END AS status
FROM checked
WHERE check_name IN ('gold_tables_available', {', '.join(f"'{t}_readable'" for t in _LOST)})
   OR NOT ({' OR '.join(f"check_name LIKE '{p}%'" for p in (*_LOST, 'gold_top_producers', 'gold_trade_balance'))})"""

_SILVER = ["country", "flow", "product", "unit", "year", "month", "value"]


def _rows(variant: str, source: str, checks: list[tuple[str, str, str]]) -> list[str]:
    return [f"SELECT '{variant}' AS variant, '{n}' AS check_name, {s} AS status, {a} AS actual FROM {source}" for n, s, a in checks]


def _failures_sql() -> str:
    views = BASE + f""",
bad_obs AS (SELECT country, flow, product, unit, year, CASE WHEN year = 1996 THEN 13 ELSE month END AS month, value FROM obs),
bad_monthly AS (SELECT * FROM monthly UNION ALL SELECT * FROM monthly WHERE {M}),
leader AS (SELECT * FROM top WHERE year = 1996 AND producer_rank = 1),
bad_top AS (SELECT * FROM top UNION ALL SELECT * REPLACE (11 AS producer_rank) FROM leader UNION ALL SELECT * FROM leader),
bad_trade AS (SELECT * REPLACE (CASE WHEN year = 1996 THEN 'NaN'::DOUBLE ELSE trade_balance_value END AS trade_balance_value) FROM trade)"""
    out: list[str] = []
    one = "(SELECT 1)"
    count = ("COUNT(*) > 0", "CAST(COUNT(*) AS VARCHAR)")
    variants = {
        "values": ("bad_obs", {"gold_monthly_global_production": "bad_monthly", "gold_country_production_trend": "trend",
                               "gold_top_producers_by_month": "bad_top", "gold_trade_balance_by_country": "bad_trade"}),
        "columns": ("obs", {t: v for t, (v, _) in _GOLD_COLUMNS.items()}),
        "empty": ("(SELECT * FROM obs WHERE false)", {t: f"(SELECT * FROM {v} WHERE false)" for t, (v, _) in _GOLD_COLUMNS.items()}),
    }
    lost = {"silver": "month", "gold_monthly_global_production": "metric_name", "gold_country_production_trend": "year",
            "gold_top_producers_by_month": "producer_rank", "gold_trade_balance_by_country": "exports_value"}
    for variant, (silver, tables) in variants.items():
        gone = lost if variant == "columns" else {}
        out += _rows(variant, one, [("silver_readable", "'PASS'", "'read_ok'"), ("gold_tables_available", "'PASS'", "'4'"),
                                    *[(f"{t}_readable", "'PASS'", "'read_ok'") for t in tables]])
        out += _rows(variant, silver, [("silver_non_empty", _status(count[0]), count[1])])
        for t, columns in {"silver": _SILVER, **{t: c for t, (_, c) in _GOLD_COLUMNS.items()}}.items():
            left = [c for c in columns if c != gone.get(t)]
            ok = "'PASS'" if {"year", "month"} <= set(left) else "'FAIL'"
            out += _rows(variant, one, [(f"{t}_has_partition_columns", ok, _cols(left))])
        if "silver" not in gone:
            bad = "COUNT(*) FILTER (WHERE month > 12 OR month < 1)"
            months = "COUNT(DISTINCT year * 100 + month)"
            out += _rows(variant, silver, [
                ("silver_valid_year_month_values", _status(f"{bad} = 0"), f"CAST({bad} AS VARCHAR)"),
                ("silver_has_partitions", _status(f"{months} > 0"), f"CAST({months} AS VARCHAR)")])
        for t, v in tables.items():
            out += _rows(variant, v, [(f"{t}_non_empty", _status(count[0]), count[1])])
        if gone:
            continue
        dups = [("gold_monthly_global_production_unique_key", "gold_monthly_global_production", "metric_name, year, month"),
                ("gold_top_producers_unique_rank_per_month", "gold_top_producers_by_month", "year, month, producer_rank")]
        for name, t, keys in dups:
            out += _rows(variant, f"({_DUPS.format(t=tables[t], k=keys)})",
                         [(name, _status("duplicate_groups = 0"), "CAST(duplicate_groups AS VARCHAR)")])
        for name, t, bad in (("gold_top_producers_rank_range", "gold_top_producers_by_month", _RANK_BAD),
                             ("gold_trade_balance_formula_consistent", "gold_trade_balance_by_country", _FORMULA_BAD)):
            n = f"COUNT(*) FILTER (WHERE {bad})"
            out += _rows(variant, tables[t], [(name, _status(f"{n} = 0"), f"CAST({n} AS VARCHAR)")])
    return "WITH " + views + "\n" + "\nUNION ALL\n".join(out)


JOB_ORACLE_SQL["quality_failures"] = _failures_sql()

# A CSV writer spells blank text as "" and a reader takes it as null; values with a trailing blank stay.
JOB_ORACLE_SQL["header_names"] = "WITH " + OBSERVATIONS + """,
g AS (SELECT *, CASE WHEN month % 2 = 0 THEN 'clash' ELSE 'plain' END AS source_group, NULLIF(country, '') AS named FROM obs),
c AS (SELECT source_group, COUNT(*) AS n, COUNT(named) AS named FROM g GROUP BY source_group),
v AS (
  SELECT source_group, n, named, unnest(['country', 'obs_value', 'obs_value_2', 'obs_value_2_2', 'col', 'col_2', 'year', 'month',
                                         'source_file_name', 'ingested_at_utc']) AS column_name FROM c)
SELECT source_group, n AS row_count, column_name,
       CASE WHEN column_name = 'country' THEN named
            WHEN column_name IN ('obs_value_2', 'obs_value_2_2') AND source_group = 'plain' THEN 0
            WHEN column_name = 'col_2' AND source_group = 'clash' THEN 0 ELSE n END AS value_count
FROM v"""

_RESULTS = {
    "production_for_month": ("production_one_month", "total_production"),
    "trend_top_for_month": ("trend_top50_month", "production_value"),
    "top_producers_for_month": ("top_producers_month", "production_value"),
    "trade_top_abs_for_month": ("trade_top50_abs_month", "trade_balance_value"),
    "production_sum_filtered": ("production_sum_filtered", "total_production_sum"),
    "production_sum_all": ("production_sum_all", "total_production_sum"),
    "row_counts": ("gold_row_counts", "row_count"),
}
JOB_ORACLE_SQL["validation_results"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS statement, COUNT(*) AS row_count, CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE) AS total "
    f"FROM ({ORACLE_SQL[q]})" for n, (q, c) in _RESULTS.items())
