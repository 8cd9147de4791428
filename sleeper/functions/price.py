"""Localised price text -> decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleeper.schemas import PRICE_TYPE


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# From the first digit on: digits with separators (points, commas, apostrophes, spaces) between them.
_NUMBER = r"[0-9](?:[0-9.,'’\s\u00a0\u2009\u202f]*[0-9])?"
_MINUS = r"^\s*[-\u2212]|[-\u2212]\s*$"


def parse_price(text: Column | str, is_free: Column | str | None = None) -> Column:
    """Parse ``$9.99``, ``5,99€``, ``Mex$ 1,299.00``, ``1.299,00€``, ``S/.35.50``, ``4,99 pуб.``, ``-5.00``.

    The price is the first number of the text; separators at its ends belong to the
    currency's name, except that a point or comma before one or two digits that no
    letter or slash precedes (``$.99``) begins a fraction. Inside, a last point or
    comma followed by one or two digits is the fraction, every other separator groups
    thousands. A minus sign counts at the start of the text or next to the number.
    Unparseable text (``Free``, empty) gives NULL, or 0.00 when the payload flags the
    item as free.
    """
    t = F.coalesce(_c(text), F.lit(""))
    number = F.regexp_extract(t, _NUMBER, 0)
    before = F.regexp_extract(t, r"^[^0-9]*", 0)
    bare = number.rlike(r"^[0-9]{1,2}$") & before.rlike(r"(?:^|[^\p{L}/.,])[.,]$")
    number = F.when(bare, F.concat(F.lit("0."), number)).otherwise(number)
    frac = F.regexp_extract(number, r"[.,]([0-9]{1,2})$", 1)
    whole = F.regexp_replace(F.regexp_replace(number, r"[.,][0-9]{1,2}$", ""), r"[^0-9]", "")
    value = F.when(frac != "", F.concat(whole, F.lit("."), frac)).otherwise(whole)
    parsed = F.when(before.rlike(_MINUS), F.concat(F.lit("-"), value)).otherwise(value).try_cast(PRICE_TYPE)
    if is_free is None:
        return parsed
    free = F.coalesce(_c(is_free), F.lit(False))
    return F.when(parsed.isNull() & free, F.lit(0).cast(PRICE_TYPE)).otherwise(parsed)
