"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as registered
from storelens.catalog.registry import ENTRIES
from storelens.plans import orders, sales
from storelens.sources.star import Star

BATCH = [name for name in ENTRIES if not name.startswith("stream_")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_row_at_a_time_python(spark, sf_dir, name):
    text = plan(registered.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_items_are_summed_before_they_meet_products(spark, sf_dir):
    text = plan(sales.weight_freight_correlation(Star(spark, sf_dir)))
    join = next(i for i, line in enumerate(text.splitlines()) if "Join" in line)
    below = "\n".join(text.splitlines()[join:])
    assert "partial_sum" in below and below.count("lineitem") == 1


def test_delivered_freight_reads_the_items_once(spark, sf_dir):
    text = plan(sales.freight_of_orders_delivered_in(Star(spark, sf_dir), 1997))
    assert text.count("/lineitem.parquet") == 1


def test_year_filter_reaches_the_scan(spark, sf_dir):
    text = plan(orders.orders_placed_in_year(Star(spark, sf_dir), 1997))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(sales.best_seller(Star(spark, sf_dir)))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in text


def test_items_are_summed_before_the_seller_join(spark, sf_dir):
    text = plan(sales.top_sellers_per_state(Star(spark, sf_dir)))
    lines = text.split("\n")
    join = min(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_sum" in line for line in lines[join:])
    assert "TakeOrderedAndProject" in plan(sales.best_seller(Star(spark, sf_dir)))
