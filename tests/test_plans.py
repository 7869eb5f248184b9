"""Physical-plan properties that matter at scale."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_month_query_pushes_ship_date_range(spark):
    plan = _plan(E.queries()["production_one_month"](spark, SF001))
    scan = plan[plan.index("(1) Scan parquet"):]
    pushed = scan[scan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_top_n_uses_window_group_limit(spark):
    plan = _plan(E.queries()["top_producers_by_month"](spark, SF001))
    assert plan.count("WindowGroupLimit") >= 2  # partial before the shuffle, final after


def test_fact_join_is_shuffle_join_and_cube_is_partial(spark):
    plan = _plan(E.queries()["monthly_global_production"](spark, SF001))
    assert "SortMergeJoin Inner" in plan
    tree = plan.split("\n\n")[0]
    assert tree.count("HashAggregate") >= 2


def test_single_pass_trade_has_no_outer_join(spark):
    single = _plan(E.queries()["trade_balance_single_pass"](spark, SF001)).split("\n\n")[0]
    joined = _plan(E.queries()["trade_balance_by_country"](spark, SF001)).split("\n\n")[0]
    assert "FullOuter" not in single and "FullOuter" in joined
    assert single.count("Exchange") < joined.count("Exchange")


def test_projection_is_pruned(spark):
    plan = _plan(E.queries()["monthly_global_production"](spark, SF001))
    scan = plan[plan.index("(1) Scan parquet"):]
    schema = scan[scan.index("ReadSchema"):].split("\n")[0]
    assert "l_tax" not in schema and "l_linenumber" not in schema


def test_stored_month_read_is_partition_pruned(spark):
    plan = _plan(E.queries()["pruning_file_counts"](spark, SF001))
    filters = [line for line in plan.split("\n") if line.startswith("PartitionFilters: [")]
    assert any("= 1998" in f and "= 6" in f for f in filters)
