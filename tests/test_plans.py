"""Plan shape guards: no registered query may plan a cartesian product or a
nested-loop join, and scans read only the columns a query needs."""

import pytest

from basketlens.plans import catalog as entry

SF = "/root/testdata/sf0.001"


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_no_cross_or_nested_loop_join(spark, capsys, key):
    plan = _plan(entry.queries()[key](spark, SF), capsys)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_clv_reads_only_needed_columns(spark, capsys):
    plan = _plan(entry.queries()["customer_lifetime_value"](spark, SF), capsys)
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    customer = [s for s in schemas if "c_custkey" in s]
    assert customer and all("c_acctbal" not in s and "c_nationkey" not in s for s in customer)


def test_top_products_is_a_top_k_not_a_full_sort(spark, capsys):
    plan = _plan(entry.queries()["card_top_products"](spark, SF), capsys)
    assert "TakeOrderedAndProject" in plan


def test_null_order_ids_are_spread_not_piled(spark, capsys):
    """V2's item/order join shuffles on the struct key, not the raw order id."""
    plan = _plan(entry.queries()["product_performance"](spark, SF), capsys)
    assert "_jk" in plan


def test_summary_uses_no_expand(spark, capsys):
    plan = _plan(entry.queries()["daily_sales_summary"](spark, SF), capsys)
    assert "Expand" not in plan
