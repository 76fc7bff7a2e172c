import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from tillstream.functions import clock, money, text


def test_shop_time_crosses_midnight_before_utc(spark):
    # 2020-10-23 15:59:59.999 UTC, and one millisecond later
    df = spark.createDataFrame([(1603468799999,), (1603468800000,)], "ts long")
    got = rows(df.select(clock.shop_date(F.col("ts")), clock.shop_hour(F.col("ts"))))
    assert got == [("2020-10-23", "23"), ("2020-10-24", "0")]


def test_date_parts_of_text_keep_padding(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",)], "t string")
    got = df.select(
        clock.text_date(F.col("t")), clock.text_hour(F.col("t")), clock.hour_of(F.col("t")),
        clock.padded_hour(clock.hour_of(F.col("t"))),
    ).first()
    assert tuple(got) == ("2020-01-02", "03", 3, "03")


def test_previous_day(spark):
    assert clock.previous_day("2024-03-01") == "2024-02-29"
    with pytest.raises(ValueError):
        clock.previous_day("2024-3-x")
    df = spark.createDataFrame([("2024-01-01",)], "d string")
    assert df.select(clock.previous_day_column(F.col("d"))).first()[0] == "2023-12-31"
    with pytest.raises(Exception, match="CAST|PARSE"):
        spark.createDataFrame([("no date",)], "d string").select(clock.previous_day_column(F.col("d"))).collect()


def test_processing_time_is_one_value_per_query(spark):
    assert spark.range(1000).repartition(4).select(clock.processing_time().alias("t")).distinct().count() == 1


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.125,)], "x double")
    got = [r[0] for r in df.select(money.round_half_up(F.col("x"))).collect()]
    assert got == [math.floor(x * 100 + 0.5) / 100 for x in (1.005, 2.675, 0.125, -0.125)]
    assert got[0] == 1.0


def _share(final, amount, original):
    return 0 if original == 0 else (2 * final * amount + original) // (2 * original)


def test_share_is_exact_for_any_size(spark):
    big = 3_000_000_000_000_000
    cases = [
        (100, 1, 3), (100, 2, 3), (0, 5, 10), (7, 10, 10), (-100, 1, 3), (-1, 1, 2), (5, 0, 0),
        (big, big // 7, big), (2 * 10**18, 10**7, 2 * 10**18 + 1), (10**17, 10**16 + 3, 10**17 + 9),
    ]
    df = spark.createDataFrame(cases, "f long, a long, o long")
    got = {(r.f, r.a, r.o): r.s for r in df.withColumn("s", money.paid_share(F.col("f"), F.col("a"), F.col("o"))).collect()}
    assert got == {c: _share(*c) for c in cases}


@given(st.lists(st.tuples(st.integers(1, 10**7), st.integers(1, 50)), min_size=1, max_size=30), st.integers(0, 4900))
def test_remainder_is_less_than_a_cent_per_line(lines, discount):
    amounts = [p * n for p, n in lines]
    original = sum(amounts)
    final = max(original - discount, 0)
    assert abs(final - sum(_share(final, a, original) for a in amounts)) <= len(amounts)


def test_tokens_and_highlight(spark):
    df = spark.createDataFrame([("The the thé other-THE",), ("breathe",), ("",), (None,)], "t string")
    hits = [r[0] for r in df.select(text.has_any_token(F.col("t"), "The, THE")).collect()]
    assert hits == [True, False, False, None]
    marked = df.select(text.highlight(F.col("t"), "the")).first()[0]
    assert marked == "<em>The</em> <em>the</em> thé other-<em>THE</em>"
    with pytest.raises(ValueError):
        text.query_tokens("...") or text.has_any_token(F.col("t"), "...")
