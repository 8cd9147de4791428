"""Score component expressions (pure Column arithmetic, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleeper.config import ScoreParams


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(x: Column | str) -> Column:
    # NaN never reaches the tier test: it becomes NULL here.
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def quality_score(positive: Column | str, total: Column | str) -> Column:
    """positive / total, with a total of 0 treated as 1."""
    t = _d(total)
    return _d(positive) / F.when(t == 0, F.lit(1.0)).otherwise(t)


def obscurity_score(total: Column | str, max_total: Column | str) -> Column:
    """1 - total / max_total (max_total already floored at 1)."""
    return F.lit(1.0) - _d(total) / _d(max_total)


def price_score(price: Column | str, cap: float = 60.0) -> Column:
    """0 -> 1.0; else max(0, 1 - price / cap); unknown price -> 0.0."""
    p = _d(price)
    return F.when(p == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - p / F.lit(float(cap))))


def round_half_even(x: Column | str, digits: int = 4) -> Column:
    """Multiply, round half to even, divide: the binary-float rounding that
    pandas/numpy ``round(digits)`` performs (Spark's ``round`` rounds the decimal
    form half-up instead, which differs near ties)."""
    m = float(10 ** digits)
    return F.rint(_c(x) * F.lit(m)) / F.lit(m)


def weighted_score(q: Column | str, o: Column | str, p: Column | str,
                   params: ScoreParams = ScoreParams()) -> Column:
    raw = (F.lit(params.w_quality) * _c(q) + F.lit(params.w_obscurity) * _c(o)
           + F.lit(params.w_price) * _c(p))
    return round_half_even(raw, params.digits)


def tier(score: Column | str, params: ScoreParams = ScoreParams()) -> Column:
    s = _c(score)
    return (F.when(s >= params.tier_s, F.lit("S"))
            .when(s >= params.tier_a, F.lit("A"))
            .otherwise(F.lit("B")))
