"""Exact arithmetic on counters: clamped deltas, rounded ratios, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for a 64-bit counter times any rounding factor used here.
WIDE = "decimal(38,0)"
_LONG_HEADROOM = 2**61


def non_negative_delta(current: Column, previous: Column) -> Column:
    """``current - previous``, with 0 for a counter reset and NULL when either side is unknown.

    ``greatest`` skips NULLs in Spark, so an unknown delta needs the explicit guard.
    """
    delta = current - previous
    return F.when(delta.isNotNull(), F.greatest(delta, F.lit(0)))


def safe_ratio(num: Column, den: Column | None = None, scale: int = 1, digits: int = 0, times: int = 1) -> Column:
    """``times * num / den / scale`` rounded half away from zero to ``digits`` decimals, as a double.

    NULL when ``den`` is 0 or NULL. ``num`` and ``den`` are integers, so the rounding is done
    on integers; doubles would fall on either side of a tie. Values near the end of the 64-bit
    range take the slower decimal route.
    """
    power = 10**digits
    den = F.lit(1).cast("bigint") if den is None else F.when(den != 0, den)
    most_num, most_den = _LONG_HEADROOM // (2 * power * times), _LONG_HEADROOM // scale
    fits_long = num.between(-most_num, most_num) & den.between(-most_den, most_den)
    steps = F.when(fits_long, _rounded_quotient(num, den, power * times, scale)).otherwise(
        _rounded_quotient(num.cast(WIDE), den.cast(WIDE), power * times, scale)
    )
    return steps / float(power)


def _rounded_quotient(num: Column, den: Column, power: int, scale: int) -> Column:
    dividend, divisor = num * (2 * power), den * scale
    size = F.abs(divisor)
    steps = F.call_function("div", F.abs(dividend) + size, size * 2).cast("double")
    return F.signum(num) * F.signum(den) * steps


def rounded_mean(total: Column, n: Column) -> Column:
    """Integer mean rounded half away from zero, for non-negative totals."""
    return F.when(n != 0, F.call_function("div", total * 2 + n, n * 2))


def weighted_score(base: Column, extra: Column, weight: int = 50) -> Column:
    """``base + weight * extra``, a missing ``extra`` counting as 0."""
    return base + F.coalesce(extra, F.lit(0)) * weight
