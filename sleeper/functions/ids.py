"""Item ids from HTML and loose values (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The search-result attribute and the chart link pattern.
SEARCH_ID_ATTRIBUTE = r'data-ds-appid="([^"]+)"'
CHART_LINK_PATTERN = r"/app/(\d+)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(value: Column | str) -> Column:
    """Integer or NULL. '12 ' -> 12, '3.7' -> NULL, 3.7 (double) -> 3, 'x' -> NULL."""
    return _c(value).try_cast("bigint")


def ids_from_attribute_html(html: Column | str, pattern: str = SEARCH_ID_ATTRIBUTE) -> Column:
    """Ids from ``data-ds-appid="..."`` attributes, as array<bigint>.

    A value is either one id or a bracketed list ``[a, b]``. Tokens are trimmed,
    anything that is not all digits is dropped, order and duplicates are kept.
    """
    raw = F.regexp_extract_all(_c(html), F.lit(pattern), 1)

    def tokens(v: Column) -> Column:
        t = F.trim(v)
        bracketed = t.startswith("[") & t.endswith("]")
        inner = F.regexp_replace(t, r"^\[+|\]+$", "")
        return F.when(bracketed, F.split(inner, ",")).otherwise(F.array(t))

    flat = F.flatten(F.transform(raw, tokens))
    # one pass: all-digit tokens become bigint, anything else (or an overflow) NULL; then drop NULLs
    as_ids = F.transform(flat, lambda t: F.when(F.trim(t).rlike("^[0-9]+$"), F.trim(t).try_cast("bigint")))
    return F.filter(as_ids, lambda v: v.isNotNull())


def ids_from_links(html: Column | str, pattern: str = CHART_LINK_PATTERN) -> Column:
    """Ids captured by group 1 of ``pattern`` (default ``/app/(\\d+)``), in page order."""
    return F.transform(F.regexp_extract_all(_c(html), F.lit(pattern), 1),
                       lambda t: t.try_cast("bigint"))


def links(html: Column | str, pattern: str) -> Column:
    """Raw group-1 captures of ``pattern`` in page order (array<string>)."""
    return F.regexp_extract_all(_c(html), F.lit(pattern), 1)
