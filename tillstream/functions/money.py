"""Money arithmetic (FN8, FN16 and the share of §2.11), exact in integer cents."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1


def round_half_up(amount: Column) -> Column:
    """Two decimals, halves up: the floor of ``x * 100 + 0.5``, which differs from ``round(x, 2)`` at 1.005."""
    return F.floor(amount * 100 + F.lit(0.5)) / 100


def to_cents(amount: Column) -> Column:
    """Whole cents, halves up; NULL for amounts that are no number or beyond the cents a long holds."""
    usable = ~F.isnan(amount) & (F.abs(amount) < LONG_MAX / 1000)
    return F.floor(F.when(usable, amount) * 100 + F.lit(0.5)).cast("long")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / 100


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _floor_div(n: Column, d: Column) -> Column:
    """Floor of ``n / d`` for d > 0. ``div`` cuts towards zero, so negative numbers are turned first."""
    return F.when(n >= 0, F.call_function("div", n, d)).otherwise(-F.call_function("div", d - 1 - n, d))


def paid_share(final_c: Column, amount_c: Column, original_c: Column) -> Column:
    """``final * amount / original`` in cents, halves up; 0 when the original total is 0.

    The product of two order-sized amounts leaves the long range only for enormous orders. Those rows take
    a decimal path; the others stay on machine integers.
    """
    final_c, amount_c, original_c = (c.cast("long") for c in (final_c, amount_c, original_c))
    room = F.lit(LONG_MAX // 4)
    narrow = (original_c <= room) & (F.abs(amount_c) <= F.call_function("div", room, F.greatest(F.abs(final_c), F.lit(1))))
    small = _floor_div(final_c * amount_c * 2 + original_c, original_c * 2)
    wide_final, wide_amount, wide_original = (c.cast("decimal(19,0)") for c in (final_c, amount_c, original_c))
    product = (wide_final * wide_amount).cast("decimal(38,0)")
    twice = (product + product + wide_original).cast("decimal(38,0)")
    big = _floor_div(twice, (wide_original + wide_original).cast("decimal(38,0)"))
    return F.when(original_c == 0, F.lit(0).cast("long")).when(narrow, small).otherwise(big).cast("long")
