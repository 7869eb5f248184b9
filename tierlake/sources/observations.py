"""Observation feed derived from the star-schema tables.

The medallion jobs consume long-format observations
``(country, flow, product, unit, year, month, value)``. The test tables are a
TPC-H style star schema, so this module turns every line item into
observations, period = month of ``l_shipdate``:

* the supplier's nation produces the line (flow text by return flag:
  ``R`` -> ``Products transferred``, ``A`` -> ``Refinery output``, else
  ``Production``), value = extended price;
* when supplier and customer nations differ, the supplier's nation exports
  it (``Expected stock`` for ``1-URGENT`` orders, else ``Exports``) and the
  customer's nation imports it (``Import/Export balance`` for ``5-LOW``
  orders, else ``imports``).

Raw text is deliberately messy the way source files are: suppliers with a
negative balance have a blank country, customer-side country text has a
trailing blank, values with no discount read ``n/a``, quantities of 40 or
more carry a thousands comma and ``N``-flag values are padded. Every row
keeps its real value; the Gold rules decide what counts.

Plan at scale: ``orders ⋈ customer`` first (orders shuffled by customer
key), then ``lineitem ⋈ orders`` as a sort-merge join on the order key (one
shuffle of the fact table; orders grow with it, so they are never
broadcast, and AQE's skew-join handling splits a hot order key), then
``⋈ supplier`` (broadcast only while supplier is within a checked row
bound, else a shuffle join). Nations are a fixed 25-row
dimension. All observation rows of a line come from one ``inline`` over a
small array, so the fact table is scanned once, not once per flow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.sources.tables import broadcast_if_bounded, table

# Row bounds below which a dimension is broadcast (checked with a count).
NATION_MAX_ROWS = 10_000
SUPPLIER_MAX_ROWS = 2_000_000


def _plain_value(price: Column) -> Column:
    return price.cast("decimal(18,2)").cast("string")


def value_text(price: Column, discount: Column, quantity: Column, returnflag: Column) -> Column:
    plain = _plain_value(price)
    return (
        F.when(discount == 0, F.lit("n/a"))
        .when(quantity >= 40, F.regexp_replace(plain, r"^([0-9]+)([0-9]{3})[.]", "$1,$2."))
        .when(returnflag == "N", F.concat(F.lit(" "), plain, F.lit(" ")))
        .otherwise(plain)
    )


def ship_month_range(year: int, month: int) -> Column:
    """``l_shipdate`` in one calendar month, as a half-open range of literals:
    unlike ``year(l_shipdate) = y`` it reaches the parquet reader as a pushed
    filter, so row groups of other months are skipped."""
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    lo = F.lit(f"{year:04d}-{month:02d}-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{ny:04d}-{nm:02d}-01 00:00:00").cast("timestamp_ntz")
    d = F.col("l_shipdate")
    return (d >= lo) & (d < hi)


def trade_lines(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    """One row per line item with supplier and customer nation attached
    (only ship month ``period = (year, month)`` when given)."""
    nation = broadcast_if_bounded(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), NATION_MAX_ROWS
    )
    customer = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nation.withColumnRenamed("n_name", "cust_nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_nationkey", "cust_nation")
    )
    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderpriority", "c_nationkey", "cust_nation")
    )
    supplier = broadcast_if_bounded(
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_nationkey", "s_acctbal")
        .join(nation.withColumnRenamed("n_name", "supp_nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_nationkey", "s_acctbal", "supp_nation"),
        SUPPLIER_MAX_ROWS,
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    if period is not None:
        lines = lines.where(ship_month_range(*period))
    # Orders grow with the fact table: the fact join is always a shuffle
    # (sort-merge) join on the order key, never a broadcast of orders, and
    # AQE splits the partition of a hot order key.
    return (
        lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def observations(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    """Silver-shaped observations: text roles, int ``year``/``month`` partitions.

    ``period = (year, month)`` restricts the feed to one month the way a
    partition filter restricts a Silver scan."""
    return unpacked(packed_observations(spark, sf_dir, period))


def unpacked(packed: DataFrame) -> DataFrame:
    """The observations of packed rows; further columns follow."""
    return packed.select(F.inline("rows"), *(c for c in packed.columns if c != "rows"))


def packed_observations(spark: SparkSession, sf_dir: str, period: tuple[int, int] | None = None) -> DataFrame:
    """One row per line item with its observations' countries and flows in the array ``rows``."""
    lines = trade_lines(spark, sf_dir, period)
    supp_country = F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.col("supp_nation"))
    cust_country = F.concat(F.col("cust_nation"), F.lit(" "))
    produced = (
        F.when(F.col("l_returnflag") == "R", F.lit("Products transferred"))
        .when(F.col("l_returnflag") == "A", F.lit("Refinery output"))
        .otherwise(F.lit("Production"))
    )
    exported = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Expected stock")).otherwise(F.lit("Exports"))
    imported = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Import/Export balance")).otherwise(F.lit("imports"))

    def obs(country: Column, flow: Column) -> Column:
        return F.struct(country.alias("country"), flow.alias("flow"))

    local = F.array(obs(supp_country, produced))
    cross = F.array(obs(supp_country, produced), obs(supp_country, exported), obs(cust_country, imported))
    rows = F.when(F.col("s_nationkey") != F.col("c_nationkey"), cross).otherwise(local)
    return lines.select(
        rows.alias("rows"),
        F.concat(F.lit("PART#"), F.col("l_partkey").cast("string")).alias("product"),
        F.lit("USD").alias("unit"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        value_text(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity"), F.col("l_returnflag")).alias("value"),
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-file-shaped text rows (as a CSV read would give them) for the Silver path.

    One production row per line item with source-style headers (``Ref
    Area``, ``Energy Product``, ``FLOW_BREAKDOWN``, ``Unit``, ``Year``,
    ``Month``, ``TIME_PERIOD``, ``OBS_VALUE``) and a ``source_file_name``.
    The period is spelled differently per (return flag, line status):

    * ``N/O``: Year + numeric Month; quantity 50 shifts the year back 200
      years (passes the quality check, fails the Silver gate);
    * ``N/F``: Year + month name (``Jun``, ``Sept`` for September);
      quantity 50 gives month ``13``;
    * ``R/O``: ``TIME_PERIOD`` ``yyyy-MM``; quantity 49 gives ``Q2 yyyy``
      (no period anywhere: an invalid row);
    * ``R/F``: ``TIME_PERIOD`` ``MMMM yyyy``;
    * ``A/O``: Year ``x`` (unusable) and ``TIME_PERIOD`` ``yyyy/MM/dd``;
    * ``A/F``: nothing but the file name ``…/yyyyMM.csv``.
    """
    lines = trade_lines(spark, sf_dir)
    flag, status, qty = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    d = F.col("l_shipdate")

    def combo(f: str, s: str) -> Column:
        return (flag == f) & (status == s)

    y = F.year(d)
    year_text = (
        F.when(combo("N", "O"), F.when(qty == 50, y - 200).otherwise(y).cast("string"))
        .when(combo("N", "F"), y.cast("string"))
        .when(combo("A", "O"), F.lit("x"))
        .otherwise(F.lit(""))
    )
    month_name = F.when(F.month(d) == 9, F.lit("Sept")).otherwise(F.date_format(d, "MMM"))
    month_text = (
        F.when(combo("N", "O"), F.month(d).cast("string"))
        .when(combo("N", "F"), F.when(qty == 50, F.lit("13")).otherwise(month_name))
        .otherwise(F.lit(""))
    )
    period_text = (
        F.when(combo("R", "O"), F.when(qty == 49, F.concat(F.lit("Q2 "), y.cast("string")))
               .otherwise(F.date_format(d, "yyyy-MM")))
        .when(combo("R", "F"), F.date_format(d, "MMMM yyyy"))
        .when(combo("A", "O"), F.date_format(d, "yyyy/MM/dd"))
        .otherwise(F.lit(""))
    )
    file_name = F.when(combo("A", "F"), F.concat(F.lit("file:/lake/raw/"), F.date_format(d, "yyyyMM"), F.lit(".csv"))) \
        .otherwise(F.concat(F.lit("file:/lake/raw/feed-"), F.lower(F.col("o_orderpriority")), F.lit(".csv")))
    return lines.select(
        F.col("supp_nation").alias("Ref Area"),
        F.concat(F.lit("PART#"), F.col("l_partkey").cast("string")).alias("Energy Product"),
        F.lit("Production").alias("FLOW_BREAKDOWN"),
        F.lit("USD").alias("Unit"),
        year_text.alias("Year"),
        month_text.alias("Month"),
        period_text.alias("TIME_PERIOD"),
        value_text(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity"), flag).alias("OBS_VALUE"),
        file_name.alias("source_file_name"),
    )
