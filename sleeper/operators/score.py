"""Hidden-gem scoring (quality, obscurity, price -> weighted score -> tier)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeper.config import ScoreParams
from sleeper.functions import scores as S

SCORE_COLUMNS = ["quality_score", "obscurity_score", "price_score", "hidden_gem_score", "tier"]


def max_total(df: DataFrame, total: str = "total_resenas"):
    """Global max of ``total`` (NULLs skipped) floored at 1, as a scalar subquery.

    The aggregate runs partial-then-final and yields one value, which every row
    reads; no window over an unpartitioned frame and no join.
    """
    return df.select(F.greatest(F.max(total), F.lit(1))).scalar()


def score_items(df: DataFrame, params: ScoreParams = ScoreParams(), by: list[str] | None = None,
                total: str = "total_resenas", positive: str = "resenas_positivas",
                price: str = "precio", maximum: int | None = None) -> DataFrame:
    """Add the score columns.

    ``by=None`` normalises obscurity by the global max (one snapshot). With
    ``by=["run"]`` every run is normalised by its own max: the per-run maxima are
    a partial+final aggregate with one row per run, joined back on the run key
    (AQE turns that join into a broadcast once it sees how small that side is). A
    ``maximum`` that is known already is taken as it is, and the rows are read once.
    """
    if maximum is not None:
        out = df.withColumn("_max_total", F.lit(max(maximum, 1)))
    elif by:
        mx = df.groupBy(*by).agg(F.greatest(F.max(total), F.lit(1)).alias("_max_total"))
        mx = mx.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_max_total")
        cond = None
        for c in by:  # null-safe: rows of a NULL run are scored against that group's max
            eq = df[c].eqNullSafe(mx[f"_by_{c}"])
            cond = eq if cond is None else cond & eq
        out = df.join(mx, cond, "inner").drop(*[f"_by_{c}" for c in by])
    else:
        out = df.withColumn("_max_total", max_total(df, total))
    out = out.withColumns({
        "quality_score": S.quality_score(positive, total),
        "obscurity_score": S.obscurity_score(total, "_max_total"),
        "price_score": S.price_score(price, params.price_cap),
    })
    out = out.withColumn("hidden_gem_score",
                         S.weighted_score("quality_score", "obscurity_score", "price_score", params))
    return out.withColumn("tier", S.tier("hidden_gem_score", params)).drop("_max_total")
