"""Column mapping (rename + cast, unlisted columns dropped)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Mapping = list[tuple[str, str, str, str]]  # (source, source type, target, target type)


def apply_mapping(df: DataFrame, mapping: Mapping, keep: list[str] | None = None) -> DataFrame:
    """Select, rename and cast in one projection.

    ``try_cast`` keeps one bad value from aborting the job (it becomes NULL and
    the data-quality rules catch it). A listed source column that is missing
    from ``df`` comes out as a typed NULL column. ``keep`` passes extra columns
    (lineage) through unchanged.
    """
    present = set(df.columns)
    cols = []
    for src, _src_type, dst, dst_type in mapping:
        c = F.col(src) if src in present else F.lit(None)
        cols.append(c.try_cast(dst_type).alias(dst))
    return df.select(*cols, *[F.col(k) for k in (keep or []) if k in present])
