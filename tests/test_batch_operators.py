"""Batch operators on hand-made rows, and on rows where one key holds a third of everything."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tillstream.operators import dau, dedup, lookups, orders, sales, search, wide
from tillstream.sources.tables import latest_per_key


def make_orders(spark, data):
    return spark.createDataFrame(data, "id long, user_id long, create_time string")


def test_first_order_flag(spark):
    got = orders.flag_first_orders(
        make_orders(
            spark,
            [
                (1, 10, "2020-01-02 00:00:00"), (2, 10, "2020-01-01 00:00:00"), (4, 10, "2020-01-01 00:00:00"),
                (3, 11, "2020-01-01 00:00:00"), (5, 12, "2020-01-01 00:00:00"),
            ],
        ),
        spark.createDataFrame([("11",)], "user_id string"),
    )
    assert {r.id: r.if_first_order for r in got.collect()} == {1: "0", 2: "1", 4: "0", 3: "0", 5: "1"}
    assert rows(orders.new_consumers(got), "user_id") == [("10",), ("12",)]


def test_first_order_flag_with_a_hot_user(spark):
    rng = random.Random(1)
    data = [(i, 1 if i % 3 == 0 else rng.randrange(2, 400), f"2020-01-{rng.randrange(1, 29):02d} 00:00:00") for i in range(3000)]
    first = {}
    for i, user, at in data:
        first[user] = min(first.get(user, (at, i)), (at, i))
    got = orders.flag_first_orders(make_orders(spark, data), spark.createDataFrame([("5",)], "user_id string"))
    flagged = {r.id for r in got.collect() if r.if_first_order == "1"}
    assert flagged == {i for user, (_, i) in first.items() if user != 5}
    assert got.count() == len(data)


def test_single_order_users(spark):
    df = make_orders(spark, [(1, 1, "a"), (2, 1, "b"), (3, 2, "a")])
    assert rows(orders.single_order_users(df)) == [(2,)]


def test_lookups_keep_unmatched_rows(spark):
    row = spark.createDataFrame([(1, 5, 6), (2, 99, 98)], "id long, province_id long, user_id long")
    provinces = spark.createDataFrame([("5", "n", "a", "i")], "id string, name string, area_code string, iso_code string")
    users = spark.createDataFrame([("6", "20-29", "F")], "id string, age_group string, gender string")
    got = rows(lookups.with_user(lookups.with_province(row, provinces), users))
    assert got == [(1, 5, 6, "n", "a", "i", "20-29", "F"), (2, 99, 98, None, None, None, None, None)]


def test_sku_lookup_defaults(spark):
    lines = spark.createDataFrame([(1, 7), (2, 8)], "id long, sku_id long")
    skus = spark.createDataFrame(
        [("7", "70", "x", "71", "s", "t_m", "c")],
        "id string, spu_id string, tm_id string, category3_id string, spu_name string, tm_name string, category3_name string",
    )
    got = {r.id: r for r in lookups.with_sku(lines, skus).collect()}
    assert (got[1].spu_id, got[1].tm_id, got[1].category3_id, got[1].tm_name) == (70, 0, 71, "t_m")
    assert (got[2].spu_id, got[2].tm_id, got[2].category3_id, got[2].tm_name) == (0, 0, 0, None)


def make_sides(spark, lines, discount=137):
    """Orders whose totals fit the given (order, line, price, number) rows."""
    totals = {}
    for order, _, price, number in set(lines):
        totals[order] = totals.get(order, 0) + price * number
    heads = [(o, "2020-01-01 10:00:00", t, max(t - discount, 0)) for o, t in totals.items()]
    return (
        spark.createDataFrame(heads, "id long, create_time string, original_total_c long, final_total_c long"),
        spark.createDataFrame(lines, "order_id long, id long, order_price_c long, sku_num long"),
        {o: f for o, _, _, f in heads},
    )


def brute_allocation(lines, finals):
    by_order = {}
    for order, line, price, number in sorted(set(lines)):
        by_order.setdefault(order, []).append((line, price * number))
    result = {}
    for order, items in by_order.items():
        original, final = sum(a for _, a in items), finals[order]
        left = final
        for line, amount in items[:-1]:
            share = 0 if original == 0 else (2 * final * amount + original) // (2 * original)
            result[order, line] = share
            left -= share
        result[order, items[-1][0]] = left
    return result


def random_lines(count=1500, hot_share=3, seed=3):
    """A third of the lines belongs to order 1, and a line of it comes many times."""
    rng = random.Random(seed)
    lines = []
    for i in range(count):
        order = 1 if i % hot_share == 0 else rng.randrange(2, 200)
        lines.append((order, rng.randrange(1, 2**61), rng.randrange(0, 10_000), rng.randrange(1, 20)))
    return lines + [lines[0]] * 100


def test_allocation_of_a_heavy_order(spark):
    lines = random_lines() + [(500, 1, 0, 3), (500, 2, 0, 1), (501, 9, 100, 1)]
    heads, details, finals = make_sides(spark, lines)
    got = wide.allocated_pairs(heads, details)
    assert {(r.order_id, r.order_detail_id): r.final_detail_c for r in got.collect()} == brute_allocation(lines, finals)
    assert got.count() == len(set(lines))
    paid = {r.order_id: r.paid for r in got.groupBy("order_id").agg(F.sum("final_detail_c").alias("paid")).collect()}
    assert paid == finals


@pytest.mark.parametrize("clustered", [False, True])
def test_running_sums(spark, clustered):
    lines = random_lines(count=900)
    if clustered:  # ids next to each other, and one far away
        lines = [(o, 10**6 + k, p, n) for k, (o, _, p, n) in enumerate(lines)] + [(1, 2**61, 5, 1)]
    heads, details, finals = make_sides(spark, lines)
    got = wide.running_sums(wide.allocated_pairs(heads, details), blocks=16).collect()
    amounts = {(o, i): p * n for o, i, p, n in lines}
    shares = brute_allocation(lines, finals)
    sums, want = {}, {}
    for key in sorted(amounts):
        origin, split = sums.get(key[0], (0, 0))
        sums[key[0]] = want[key] = (origin + amounts[key], split + shares[key])
    assert {(r.order_id, r.order_detail_id): (r.origin_sum_c, r.split_sum_c) for r in got} == want


def test_match_sides(spark):
    heads = spark.createDataFrame([(1, "a"), (2, "b")], "id long, order_status string")
    lines = spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, None)], "order_detail_id long, order_id long")
    got = rows(wide.match_sides(heads, lines), "order_detail_id", "id", "side")
    assert got == [(10, 1, "both"), (11, 1, "both"), (12, None, "line_only"), (13, None, "line_only"), (None, 2, "order_only")]


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "k string, v int")
    assert rows(latest_per_key(df, ["k"], ["v"])) == [("a", 3), ("b", 1)]
    assert rows(dedup.first_per_key(df, ["k"], ["v"])) == [("a", 1), ("b", 1)]


def test_daily_active_counts(spark):
    data = [("2024-01-02", "9"), ("2024-01-02", "9"), ("2024-01-02", "10"), ("2024-01-01", "9")]
    df = spark.createDataFrame(data, "dt string, hr string")
    assert dau.active_total(df, "2024-01-02").first().value == 3
    assert dau.active_total(df, "1999-01-01").first().value == 0
    assert rows(dau.active_by_hour(df, "2024-01-02")) == [("10", 1), ("9", 2)]
    assert rows(dau.active_two_days(df, "2024-01-02")) == [("10", None, 1), ("9", 1, 2)]
    with pytest.raises(ValueError):
        dau.active_two_days(df, "2024-13-01")


def test_trademarks_with_underscores_and_without_name(spark):
    df = spark.createDataFrame([(1, "a_b", 10), (1, "a_b", 5), (0, None, 7)], "tm_id long, tm_name string, final_detail_c long")
    assert rows(sales.trademark_sales(df)) == [(0, None, 0.07), (1, "a_b", 0.15)]


def test_sliding_sums_equal_spark_windows(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:%02d" % s, v) for s, v in [(1, 10), (4, 20), (7, 5), (59, 1)]], "t string, v long")
    df = df.withColumn("t", F.to_timestamp("t"))
    direct = df.groupBy(F.window("t", "20 seconds", "5 seconds")).agg(F.sum("v"), F.count("v"))
    want = rows(direct.select("window.start", "sum(v)", "count(v)", "window.end"))
    assert rows(sales.sliding_sums(df, "t", "v"), "window_start", "amount", "n", "window_end") == want
    with pytest.raises(ValueError):
        sales.sliding_sums(df, "t", "v", 20, 7)


def test_search(spark):
    docs = spark.createDataFrame(
        [(1, "Red River", 8.0, [(3, "zhang")]), (2, "red sea", 9.0, [(4, "li")]), (3, "blue", 9.0, [(3, "zhang")]), (4, None, 1.0, None)],
        "id long, name string, score double, actor_list array<struct<id:long,name:string>>",
    )
    assert rows(search.by_id(docs, 2), "id") == [(2,)]
    assert rows(search.match(docs, "RED x"), "id") == [(1,), (2,)]
    assert rows(search.term(docs, "zhang"), "id") == [(1,), (3,)]
    assert rows(search.match_and_term(docs, "red", "zhang"), "id") == [(1,)]
    assert [r.id for r in search.page(docs, 0, 2).collect()] == [2, 3]
    assert [r.id for r in search.page(docs, 1, 2, descending=False).collect()] == [1, 2]
    assert search.total_hits(docs).first().total == 4
