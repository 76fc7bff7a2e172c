"""Plans: what is read, what is shuffled, what is broadcast."""

import pytest

import __spark_entry__
from tillstream.operators import dau, orders, search, wide
from tillstream.plans import catalog, flows
from tillstream.sources import shop

QUERIES = {name: fn for name, fn in __spark_entry__.queries().items() if name in catalog.QUERIES}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_allocation_shuffles_lines_once(spark, sf_dir, no_broadcast):
    heads, lines = shop.order_heads(spark, sf_dir), shop.order_lines(spark, sf_dir)
    heads = heads.selectExpr("id", "feight_fee_c as original_total_c", "feight_fee_c as final_total_c")
    text = plan(wide.allocated_pairs(heads, lines))
    exchanges = {part.split("plan_id")[0].strip(" +-:") for part in text.split("\n") if "Exchange hashpartitioning(" in part}
    # one exchange for the lines and one for the orders, on the order id, and those of the orders and their customers
    assert "order_detail_id" not in "".join(exchanges)


def test_a_day_is_selected_before_anything_is_summed(spark, sf_dir):
    text = plan(QUERIES["sales_day_total"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1995-06-19" in text


def test_no_broadcast_without_a_known_size(spark, sf_dir, no_broadcast):
    for name in ("order_wide", "first_order_flag", "order_line_outer", "dim_sku", "trademark_sales", "order_user"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "BroadcastHashJoin" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", [n for n in QUERIES if "stream" not in n])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text


@pytest.mark.parametrize("name", ["first_order_flag", "order_wide", "dau_first_visit", "order_line_outer", "sliding_window_sales"])
def test_no_window_without_partitions(spark, sf_dir, name):
    assert "Exchange SinglePartition" not in plan(QUERIES[name](spark, sf_dir))


def test_groups_are_cut_down_before_the_shuffle(spark, sf_dir):
    assert plan(flows.daily_active(spark, sf_dir)).count("WindowGroupLimit") == 2
    assert plan(orders.first_orders_only(shop.order_heads(spark, sf_dir))).count("WindowGroupLimit") == 2
    assert "partial_min" in plan(orders.earliest_order_ids(shop.order_heads(spark, sf_dir)))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(search.by_id(shop.documents(spark, sf_dir), 3).select("id"))
    assert "EqualTo(doc_id,3)" in text and "ReadSchema: struct<doc_id:bigint>" in text
    days = dau.active_total(flows.daily_active(spark, sf_dir), "2024-01-15")
    text = plan(days)
    # the day's filter comes before the window over devices and days
    assert text.index("WindowGroupLimit") < text.rindex("2024-01-15")


def test_pages_are_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["search_page"](spark, sf_dir))
