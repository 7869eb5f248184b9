"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's
tables, ``UNION ALL`` for the observation rows, ``JOIN`` for the source jobs'
full-outer trade balance. Types are cast to the Spark result types
(``INTEGER`` year/month/rank, ``DOUBLE`` measures, ``BIGINT`` counts).
"""

from __future__ import annotations

CHECK_YEAR, CHECK_MONTH = 1998, 6

PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

OBSERVATIONS = r"""
lines AS (
  SELECT l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_returnflag, l.l_shipdate,
         o.o_orderpriority, c.c_nationkey, cn.n_name AS cust_nation,
         s.s_nationkey, s.s_acctbal, sn.n_name AS supp_nation
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
),
shaped AS (
  SELECT *,
    CASE WHEN s_acctbal < 0 THEN '' ELSE supp_nation END AS supp_country,
    cust_nation || ' ' AS cust_country,
    CASE l_returnflag WHEN 'R' THEN 'Products transferred' WHEN 'A' THEN 'Refinery output'
         ELSE 'Production' END AS produced,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Expected stock' ELSE 'Exports' END AS exported,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Import/Export balance' ELSE 'imports' END AS imported,
    'PART#' || CAST(l_partkey AS VARCHAR) AS product,
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month,
    CASE WHEN l_discount = 0 THEN 'n/a'
         WHEN l_quantity >= 40 THEN regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),
                                                   '^([0-9]+)([0-9]{3})[.]', '\1,\2.')
         WHEN l_returnflag = 'N' THEN ' ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' '
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS value
  FROM lines
),
obs AS (
  SELECT supp_country AS country, produced AS flow, product, 'USD' AS unit, year, month, value FROM shaped
  UNION ALL
  SELECT supp_country, exported, product, 'USD', year, month, value FROM shaped WHERE s_nationkey <> c_nationkey
  UNION ALL
  SELECT cust_country, imported, product, 'USD', year, month, value FROM shaped WHERE s_nationkey <> c_nationkey
)"""

BASE = OBSERVATIONS + rf""",
base0 AS (
  SELECT year, month,
         NULLIF(TRIM(country), '') AS country,
         UPPER(NULLIF(TRIM(flow), '')) AS flow,
         CASE WHEN regexp_matches(replace(TRIM(value), ',', ''), '{PLAIN_NUMBER}')
              THEN TRY_CAST(replace(TRIM(value), ',', '') AS DOUBLE) END AS value
  FROM obs
),
base AS (
  SELECT * FROM base0 WHERE year IS NOT NULL AND month BETWEEN 1 AND 12 AND value IS NOT NULL
),
flowcube AS (
  SELECT country, year, month,
    SUM(CASE WHEN regexp_matches(flow, 'PROD|PRODUCTION') THEN CAST(value AS DECIMAL(28,2)) END) AS production_value,
    SUM(CASE WHEN regexp_matches(flow, 'IMPORT|IMP') THEN CAST(value AS DECIMAL(28,2)) END) AS imports_value,
    SUM(CASE WHEN regexp_matches(flow, 'EXPORT|EXP') THEN CAST(value AS DECIMAL(28,2)) END) AS exports_value
  FROM base GROUP BY country, year, month
),
monthly AS (
  SELECT 'global_production' AS metric_name, CAST(SUM(production_value) AS DOUBLE) AS total_production, year, month
  FROM flowcube WHERE production_value IS NOT NULL GROUP BY year, month
),
trend AS (
  SELECT country, CAST(production_value AS DOUBLE) AS production_value, year, month
  FROM flowcube WHERE country IS NOT NULL AND production_value IS NOT NULL
),
top AS (
  SELECT country, production_value, producer_rank, year, month FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year, month
                                      ORDER BY production_value DESC, country ASC) AS INTEGER) AS producer_rank
    FROM trend) WHERE producer_rank <= 10
),
imp AS (
  SELECT country, year, month, SUM(CAST(value AS DECIMAL(28,2))) AS imports_value
  FROM base WHERE regexp_matches(flow, 'IMPORT|IMP') GROUP BY country, year, month
),
exp AS (
  SELECT country, year, month, SUM(CAST(value AS DECIMAL(28,2))) AS exports_value
  FROM base WHERE regexp_matches(flow, 'EXPORT|EXP') GROUP BY country, year, month
),
trade AS (
  SELECT COALESCE(imp.country, exp.country) AS country,
         CAST(COALESCE(imports_value, 0) AS DOUBLE) AS imports_value,
         CAST(COALESCE(exports_value, 0) AS DOUBLE) AS exports_value,
         CAST(COALESCE(exports_value, 0) - COALESCE(imports_value, 0) AS DOUBLE) AS trade_balance_value,
         COALESCE(imp.year, exp.year) AS year, COALESCE(imp.month, exp.month) AS month
  FROM imp FULL OUTER JOIN exp
    ON imp.country = exp.country AND imp.year = exp.year AND imp.month = exp.month
  WHERE COALESCE(imp.country, exp.country) IS NOT NULL
)"""


def _with(body: str) -> str:
    return "WITH " + BASE + "\n" + body


M = f"year = {CHECK_YEAR} AND month = {CHECK_MONTH}"

ORACLE_SQL: dict[str, str] = {
    "monthly_global_production": _with("SELECT * FROM monthly"),
    "country_production_trend": _with("SELECT * FROM trend"),
    "top_producers_by_month": _with("SELECT * FROM top"),
    "trade_balance_by_country": _with("SELECT * FROM trade"),
    "trade_balance_single_pass": _with("SELECT * FROM trade"),
    "production_one_month": _with(
        f"SELECT year, month, metric_name, total_production FROM monthly WHERE {M} ORDER BY year, month"),
    "trend_top50_month": _with(
        f"SELECT year, month, country, production_value FROM trend WHERE {M} "
        "ORDER BY production_value DESC, country LIMIT 50"),
    "top_producers_month": _with(
        f"SELECT year, month, country, production_value, producer_rank FROM top WHERE {M} ORDER BY producer_rank"),
    "trade_top50_abs_month": _with(
        f"SELECT year, month, country, imports_value, exports_value, trade_balance_value FROM trade WHERE {M} "
        "ORDER BY ABS(trade_balance_value) DESC, country LIMIT 50"),
    "production_sum_filtered": _with(
        f"SELECT CAST(SUM(CAST(total_production AS DECIMAL(38,2))) AS DOUBLE) AS total_production_sum "
        f"FROM monthly WHERE {M}"),
    "production_sum_all": _with(
        "SELECT CAST(SUM(CAST(total_production AS DECIMAL(38,2))) AS DOUBLE) AS total_production_sum FROM monthly"),
    "gold_row_counts": _with(
        "SELECT 'gold_monthly_global_production' AS table_name, COUNT(*) AS row_count FROM monthly "
        "UNION ALL SELECT 'gold_country_production_trend', COUNT(*) FROM trend "
        "UNION ALL SELECT 'gold_top_producers_by_month', COUNT(*) FROM top "
        "UNION ALL SELECT 'gold_trade_balance_by_country', COUNT(*) FROM trade"),
    "flow_classes": "WITH " + OBSERVATIONS + """
SELECT flow, UPPER(NULLIF(TRIM(flow), '')) AS flow_upper,
       COALESCE(regexp_matches(UPPER(NULLIF(TRIM(flow), '')), 'PROD|PRODUCTION'), false) AS is_production,
       COALESCE(regexp_matches(UPPER(NULLIF(TRIM(flow), '')), 'IMPORT|IMP'), false) AS is_import,
       COALESCE(regexp_matches(UPPER(NULLIF(TRIM(flow), '')), 'EXPORT|EXP'), false) AS is_export
FROM (SELECT DISTINCT flow FROM obs)""",
}

# --- text, numbers, periods -------------------------------------------------

_PERIOD_FORMAT_NAMES = ("dash_month", "slash_short_month", "compact", "abbr_name_year", "year_full_name",
                        "timestamp", "dotted_date")

ORACLE_SQL["period_parse"] = "\nUNION ALL\n".join(
    f"SELECT l_orderkey, l_linenumber, '{n}' AS period_format, CAST(year(l_shipdate) AS INTEGER) AS year, "
    f"CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem" for n in _PERIOD_FORMAT_NAMES
)

_TEXT_VARIANTS = {
    "segment": "c_mktsegment",
    "padded_lower": "'  ' || lower(c_mktsegment) || ' '",
    "name": "c_name",
    "blank": "''",
    "spaces": "'   '",
}
ORACLE_SQL["canonical_text"] = (
    "WITH v AS (" + " UNION ALL ".join(
        f"SELECT c_custkey, '{k}' AS variant, {e} AS text FROM customer" for k, e in _TEXT_VARIANTS.items())
    + ")\nSELECT c_custkey, variant, text, NULLIF(TRIM(text), '') AS cleaned, "
      "UPPER(NULLIF(TRIM(text), '')) AS upper_text FROM v"
)

_NUMBER_VARIANTS = {
    "plain": "plain",
    "padded": "' ' || plain || '  '",
    "thousands": r"regexp_replace(plain, '^([0-9]+)([0-9]{3})[.]', '\1,\2.')",
    "exponent": "plain || 'e0'",
    "garbage": "'n/a'",
    "beyond_double": "'1e400'",
    "nan": "'NaN'",
    "suffix_d": "plain || 'd'",
}
ORACLE_SQL["numeric_text"] = (
    "WITH c AS (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS plain FROM customer),\n"
    "v AS (" + " UNION ALL ".join(
        f"SELECT c_custkey, '{k}' AS variant, {e} AS text FROM c" for k, e in _NUMBER_VARIANTS.items())
    + f")\nSELECT c_custkey, variant, text, CASE WHEN regexp_matches(replace(TRIM(text), ',', ''), "
      f"'{PLAIN_NUMBER}') THEN CASE WHEN isfinite(TRY_CAST(replace(TRIM(text), ',', '') AS DOUBLE)) "
      f"THEN TRY_CAST(replace(TRIM(text), ',', '') AS DOUBLE) END END AS value FROM v"
)

_YEAR_VARIANTS = {
    "plain": "y",
    "padded": "' ' || y || ' '",
    "fraction": "y || '.0'",
    "comma": "left(y, 2) || ',' || right(y, 2) || '.9'",
    "exponent": "'2e3'",
    "blank": "' '",
    "too_long": "y || '00000000'",
}
ORACLE_SQL["year_text"] = (
    "WITH c AS (SELECT c_custkey, CAST(1900 + c_custkey % 200 AS VARCHAR) AS y FROM customer),\n"
    "v AS (" + " UNION ALL ".join(
        f"SELECT c_custkey, '{k}' AS variant, {e} AS text FROM c" for k, e in _YEAR_VARIANTS.items())
    + ")\nSELECT c_custkey, variant, text, CASE WHEN regexp_matches(TRIM(text), '^[+-]?[0-9]+([.][0-9]*)?$') "
      "THEN TRY_CAST(split_part(TRIM(text), '.', 1) AS INTEGER) END AS year FROM v"
)

# --- Silver partition derivation on the raw feed ------------------------------

SILVER_FEED = """
feed AS (
  SELECT l.l_returnflag AS f, l.l_linestatus AS s, l.l_quantity AS q,
         CAST(year(l.l_shipdate) AS INTEGER) AS y, CAST(month(l.l_shipdate) AS INTEGER) AS m
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation sn ON su.s_nationkey = sn.n_nationkey
),
silver AS (
  SELECT
    CAST(CASE WHEN f = 'N' AND s = 'O' THEN (CASE WHEN q = 50 THEN y - 200 ELSE y END)
              WHEN f = 'R' AND s = 'O' AND q = 49 THEN NULL ELSE y END AS INTEGER) AS year,
    CAST(CASE WHEN f = 'N' AND s = 'F' AND q = 50 THEN 13
              WHEN f = 'R' AND s = 'O' AND q = 49 THEN NULL ELSE m END AS INTEGER) AS month
  FROM feed
)"""

ORACLE_SQL["silver_partition_counts"] = (
    "WITH " + SILVER_FEED + "\nSELECT year, month, COUNT(*) AS row_count FROM silver GROUP BY year, month")
ORACLE_SQL["invalid_partition_counts"] = "WITH " + SILVER_FEED + """
SELECT COUNT(*) AS silver_rows,
  COUNT(*) FILTER (WHERE year IS NULL OR month IS NULL OR month < 1 OR month > 12 OR year < 1900 OR year > 2100)
    AS gate_invalid_rows,
  COUNT(*) FILTER (WHERE year IS NULL OR month IS NULL OR month < 1 OR month > 12) AS quality_invalid_rows
FROM silver"""

# --- quality measures and the 22 checks --------------------------------------

_DUPS = ("SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count, "
         "COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k})")
_RANK_BAD = "producer_rank IS NULL OR producer_rank < 1 OR producer_rank > 10"
_FORMULA_BAD = ("abs((COALESCE(exports_value, 0) - COALESCE(imports_value, 0)) - COALESCE(trade_balance_value, 0))"
                " > 1e-6")

ORACLE_SQL["duplicate_month_keys"] = _with(_DUPS.format(t="monthly", k="metric_name, year, month"))
ORACLE_SQL["duplicate_rank_keys"] = _with(_DUPS.format(t="top", k="year, month, producer_rank"))
ORACLE_SQL["rank_range_violations"] = _with(
    f"SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {_RANK_BAD}) AS invalid_ranks FROM top")
ORACLE_SQL["trade_formula_mismatches"] = _with(
    f"SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {_FORMULA_BAD}) AS mismatches FROM trade")


def _cols(names: list[str]) -> str:
    return "'[" + ", ".join(f"''{n}''" for n in sorted(names)) + "]'"


_GOLD_COLUMNS = {
    "gold_monthly_global_production": ("monthly", ["metric_name", "total_production", "year", "month"]),
    "gold_country_production_trend": ("trend", ["country", "production_value", "year", "month"]),
    "gold_top_producers_by_month": ("top", ["country", "production_value", "producer_rank", "year", "month"]),
    "gold_trade_balance_by_country": ("trade", ["country", "imports_value", "exports_value",
                                                "trade_balance_value", "year", "month"]),
}


def _status(ok: str) -> str:
    return f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END"


def _quality_sql() -> str:
    rows = [
        "SELECT 'silver_readable' AS check_name, 'PASS' AS status, 'read_ok' AS actual",
        f"SELECT 'silver_non_empty', {_status('n > 0')}, CAST(n AS VARCHAR) FROM sm",
        f"SELECT 'silver_has_partition_columns', 'PASS', "
        f"{_cols(['country', 'flow', 'product', 'unit', 'year', 'month', 'value'])}",
        f"SELECT 'silver_valid_year_month_values', {_status('bad = 0')}, CAST(bad AS VARCHAR) FROM sm",
        f"SELECT 'silver_has_partitions', {_status('parts > 0')}, CAST(parts AS VARCHAR) FROM sm",
    ]
    rows += [f"SELECT '{t}_readable', 'PASS', 'read_ok'" for t in _GOLD_COLUMNS]
    rows.append("SELECT 'gold_tables_available', 'PASS', '4'")
    for t, (view, cols) in _GOLD_COLUMNS.items():
        rows.append(f"SELECT '{t}_non_empty', {_status('COUNT(*) > 0')}, CAST(COUNT(*) AS VARCHAR) FROM {view}")
        rows.append(f"SELECT '{t}_has_partition_columns', 'PASS', {_cols(cols)}")
    dm = _DUPS.format(t="monthly", k="metric_name, year, month")
    dr = _DUPS.format(t="top", k="year, month, producer_rank")
    rows += [
        f"SELECT 'gold_monthly_global_production_unique_key', {_status('duplicate_groups = 0')}, "
        f"CAST(duplicate_groups AS VARCHAR) FROM ({dm})",
        f"SELECT 'gold_top_producers_rank_range', {_status('c = 0')}, CAST(c AS VARCHAR) "
        f"FROM (SELECT COUNT(*) FILTER (WHERE {_RANK_BAD}) AS c FROM top)",
        f"SELECT 'gold_top_producers_unique_rank_per_month', {_status('duplicate_groups = 0')}, "
        f"CAST(duplicate_groups AS VARCHAR) FROM ({dr})",
        f"SELECT 'gold_trade_balance_formula_consistent', {_status('c = 0')}, CAST(c AS VARCHAR) "
        f"FROM (SELECT COUNT(*) FILTER (WHERE {_FORMULA_BAD}) AS c FROM trade)",
    ]
    sm = """,
sm AS (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE year IS NULL OR month IS NULL OR month < 1 OR month > 12) AS bad,
         (SELECT COUNT(*) FROM (SELECT DISTINCT year, month FROM obs)) AS parts
  FROM obs
)"""
    return "WITH " + BASE + sm + "\n" + "\nUNION ALL\n".join(rows)


ORACLE_SQL["quality_checks"] = _quality_sql()

# CSV round trip: the feed's file names are gone (Spark names the files), so
# lines whose only period was the file name have no year/month.
ORACLE_SQL["silver_csv_roundtrip"] = """
WITH feed AS (
  SELECT l.l_returnflag AS f, l.l_linestatus AS s, l.l_quantity AS q, l.l_discount, l.l_extendedprice,
         CAST(year(l.l_shipdate) AS INTEGER) AS y, CAST(month(l.l_shipdate) AS INTEGER) AS m
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation sn ON su.s_nationkey = sn.n_nationkey
),
silver AS (
  SELECT
    CAST(CASE WHEN f = 'N' AND s = 'O' THEN (CASE WHEN q = 50 THEN y - 200 ELSE y END)
              WHEN (f = 'R' AND s = 'O' AND q = 49) OR (f = 'A' AND s = 'F') THEN NULL ELSE y END AS INTEGER) AS year,
    CAST(CASE WHEN f = 'N' AND s = 'F' AND q = 50 THEN 13
              WHEN (f = 'R' AND s = 'O' AND q = 49) OR (f = 'A' AND s = 'F') THEN NULL ELSE m END AS INTEGER) AS month,
    CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS value
  FROM feed
)
SELECT year, month, COUNT(*) AS row_count, CAST(SUM(value) AS DOUBLE) AS value_total
FROM silver GROUP BY year, month"""

# The same validation statements run as SQL text in Spark (views over Gold).
ORACLE_SQL["sql_top_producers_month"] = ORACLE_SQL["top_producers_month"]
ORACLE_SQL["sql_trade_top50_abs_month"] = ORACLE_SQL["trade_top50_abs_month"]
ORACLE_SQL["sql_production_sum_filtered"] = _with(
    f"SELECT SUM(total_production) AS total_production_sum FROM monthly WHERE {M}")
ORACLE_SQL["sql_gold_row_counts"] = ORACLE_SQL["gold_row_counts"]

# One file per written partition: a month reads its one file, all months read
# one file per month.
ORACLE_SQL["pruning_file_counts"] = _with(
    f"SELECT 'one_month' AS scope, COUNT(*) AS data_files FROM monthly WHERE {M} "
    "UNION ALL SELECT 'all_months', COUNT(*) FROM monthly")

# Every row counts in its month, whichever header its file had: the same rows as without files.
ORACLE_SQL["silver_gold_mixed_headers"] = ORACLE_SQL["monthly_global_production"]
