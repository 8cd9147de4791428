"""Keyed upsert of a snapshot into a target table, as a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, key: str | list[str],
           update_cols: list[str] | None = None) -> DataFrame:
    """Insert new keys; for existing keys take ``update_cols`` from ``updates``.

    ``update_cols=None`` updates every column; ``["nombre"]`` updates only the
    name and leaves every other column as it was. One full outer join on the
    key (both sides hash-partitioned on it; keys are unique per side).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in target.columns if c not in keys]
    upd = set(cols if update_cols is None else update_cols)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols if c in updates.columns],
                       F.lit(True).alias("_in_u"))
    j = t.join(u, on=keys, how="full_outer")
    out = []
    for c in cols:
        old = F.col(f"_t_{c}")
        new = F.col(f"_u_{c}") if c in updates.columns else old
        matched = new if c in upd else old
        out.append(F.when(F.col("_in_u").isNull(), old)
                    .when(F.col("_in_t").isNull(), new)
                    .otherwise(matched).alias(c))
    return j.select(*keys, *out)
