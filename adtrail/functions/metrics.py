"""Guarded ratio metrics and exact money sums, as column expressions.

Ratios are 0.0 (not NULL) when the denominator is not positive; infinite
results also become 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.schemas import MONEY_TYPE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num / den * scale`` when ``den > 0``, else 0.0; +-inf -> 0.0."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    r = num / den
    if scale != 1.0:
        r = r * F.lit(float(scale))
    r = F.when(F.abs(r) == F.lit(float("inf")), F.lit(0.0)).otherwise(r)
    return F.when(den > 0, r).otherwise(F.lit(0.0))


def ctr(clicks: Column | str = "clicks", impressions: Column | str = "impressions") -> Column:
    """Click-through rate in percent (MTH1)."""
    return guarded_ratio(clicks, impressions, 100.0)


def cpc(spend: Column | str = "spend_usd", clicks: Column | str = "clicks") -> Column:
    """Cost per click (MTH2)."""
    return guarded_ratio(spend, clicks)


def cpm(spend: Column | str = "spend_usd", impressions: Column | str = "impressions") -> Column:
    """Cost per thousand impressions (MTH3)."""
    return guarded_ratio(spend, impressions, 1000.0)


def total_interactions(clicks: Column | str = "clicks",
                       emails_sent: Column | str = "emails_sent",
                       sessions: Column | str = "sessions") -> Column:
    """Row sum of the three interaction counts (MTH4); NULL instead of an
    overflow error on absurd inputs."""
    return F.try_add(F.try_add(_col(clicks), _col(emails_sent)), _col(sessions))


def roi_percent(revenue: Column | str, spend: Column | str) -> Column:
    """(revenue - spend) / spend * 100 when spend > 0, else 0.0 (MTH7)."""
    rev, sp = _col(revenue).cast("double"), _col(spend).cast("double")
    return F.when(sp > 0, (rev - sp) / sp * F.lit(100.0)).otherwise(F.lit(0.0))


def money_sum(c: Column | str) -> Column:
    """Sum of a money column as double. Where every amount is exactly a
    ``MONEY_TYPE`` the sum is exact and independent of the order in which tasks
    combine partial sums; otherwise it is the plain sum of doubles, so no
    amount is cut or lost."""
    amount = _col(c).cast("double")
    exact = _col(c).try_cast(MONEY_TYPE)
    held = F.coalesce(exact.cast("double") == amount, F.lit(False))
    total = F.try_sum(exact).cast("double")
    return F.when(F.count_if(amount.isNotNull() & ~held) == 0, F.coalesce(total, F.sum(amount))).otherwise(F.sum(amount))


def count_sum(c: Column | str) -> Column:
    """Sum of an integer count column as bigint."""
    return F.sum(_col(c).cast("bigint")).cast("bigint")


def nan_skipping_mean(c: Column | str) -> Column:
    """Mean that ignores NULL and NaN; NULL on empty input (AG14)."""
    c = _col(c).cast("double")
    return F.avg(F.when(~F.isnan(c), c))
