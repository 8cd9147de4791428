"""Text helpers: normalisation, review labels, slugs, list joins."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Review labels that pass the quality gate, and the wider set
# admitted when "very positive" is allowed (Spanish and English forms).
TARGET_LABELS = ("extremadamente positivas", "overwhelmingly positive")
WIDER_LABELS = ("muy positivas", "very positive")
# List separator and the slug used for empty names.
LIST_SEPARATOR = " | "
EMPTY_SLUG = "sin_nombre"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _folded(c: str) -> str:
    """NFKD of one sign without combining marks. Marks go wherever they stand, so no order of theirs matters
    and a text folds sign by sign."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


# Hangul syllables decompose by arithmetic into a leading sign, a vowel and perhaps a trailing one.
_HANGUL, _HANGUL_END, _VOWELS, _TRAILING = 0xAC00, 0xD7A3, 21, 28


@dataclass(frozen=True)
class _Decomposition:
    """What folding does to signs, derived from the Unicode database: ``one`` turns into ``to``, sign by sign (those
    beyond its length vanish), ``many`` into the texts of the same place in ``texts``; ``around`` are a
    few ranges of a character class that have all of ``many`` and the Hangul syllables."""

    one: str
    to: str
    many: str
    texts: tuple[str, ...]
    around: str


@cache
def _decomposition() -> _Decomposition:
    one, gone, many = [], [], []
    for c in range(0x110000):
        if _HANGUL <= c <= _HANGUL_END or 0xD800 <= c <= 0xDFFF:
            continue
        sign = chr(c)
        text = _folded(sign)
        if text != sign:
            (gone if not text else one if len(text) == 1 else many).append((sign, text))
    points = sorted([ord(a) for a, _ in many] + [_HANGUL, _HANGUL_END])
    ranges = [[points[0], points[0]]]
    for c in points:
        if c == _HANGUL_END or c - ranges[-1][1] <= 128:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    around = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    return _Decomposition("".join(a for a, _ in one + gone), "".join(b for _, b in one), "".join(a for a, _ in many),
                          tuple(b for _, b in many), around)


def _fold_one(sign: Column) -> Column:
    """A sign that becomes several, or a text that none of them is part of."""
    d = _decomposition()
    at = F.when(F.length(sign) == 1, F.instr(F.lit(d.many), sign)).otherwise(0)
    n = F.ascii(sign) - _HANGUL
    lead, vowel, trail = ("".join(map(chr, range(a, a + k))) for a, k in ((0x1100, 19), (0x1161, _VOWELS), (0x11A8, _TRAILING - 1)))
    jamo = F.concat(
        F.substring(F.lit(lead), F.floor(n / (_VOWELS * _TRAILING)).cast("int") + 1, 1),
        F.substring(F.lit(vowel), F.floor(n % (_VOWELS * _TRAILING) / _TRAILING).cast("int") + 1, 1),
        F.when(n % _TRAILING > 0, F.substring(F.lit(trail), (n % _TRAILING).cast("int"), 1)).otherwise(F.lit("")))
    return F.when(at > 0, F.get(F.lit(list(d.texts)), at - 1)).when(
        (F.length(sign) == 1) & n.between(0, _HANGUL_END - _HANGUL), jamo).otherwise(sign)


def normalize_text(text: Column | str) -> Column:
    """NFKD, combining marks dropped, lower-cased, stripped; NULL/empty -> ''.

    Spark has no NFKD expression. Signs that turn into one or none are translated all at
    once; texts with signs that turn into several are cut at these, and each is looked up (Hangul
    syllables are reckoned). All of it stays in the JVM, and ASCII texts take none of
    these steps. The decompositions are those of Python's Unicode database.
    """
    d = _decomposition()
    t = F.coalesce(_c(text), F.lit(""))

    # an ASCII sign is told by one comparison, not by all ranges
    around, others = f"[\\x{{80}}-\\x{{10ffff}}&&[{d.around}]]", f"[\\x00-\\x7f[^{d.around}]]+"

    def fold(single: Column) -> Column:
        cut = F.regexp_extract_all(single, F.lit(f"{around}|{others}"), F.lit(0))
        return F.when((F.octet_length(single) > F.length(single)) & single.rlike(around),
                      F.array_join(F.transform(cut, _fold_one), "")).otherwise(single)

    # the array of one holds the translated text, which is read several times
    folded = F.get(F.transform(F.array(F.translate(t, d.one, d.to)), fold), F.lit(0))
    plain = F.octet_length(t) == F.length(t)
    return F.btrim(F.lower(F.when(plain, t).otherwise(folded)), F.lit(_space()))


@cache
def _space() -> str:
    """What Python's str.strip() takes off."""
    return "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def strip_edges(text: Column | str) -> Column:
    return F.btrim(_c(text), F.lit(_space()))


def equals_folded(text: Column | str, values: tuple[str, ...] | list[str]) -> Column:
    """Case- and accent-insensitive membership test, JVM-side (ICU collation)."""
    t = F.collate(strip_edges(F.coalesce(_c(text), F.lit(""))), "UNICODE_CI_AI")
    return t.isin(*[F.collate(F.lit(v), "UNICODE_CI_AI") for v in values])


def is_target_label(desc: Column | str, allow_very_positive: bool = False) -> Column:
    labels = TARGET_LABELS + (WIDER_LABELS if allow_very_positive else ())
    return equals_folded(desc, labels)


def slug(text: Column | str) -> Column:
    """Letters, digits, space, '_' and '-' kept; trimmed; spaces -> '_'; '' -> 'sin_nombre'."""
    kept = F.regexp_replace(_c(text), r"[^\p{L}\p{N} _-]", "")
    cleaned = F.replace(F.trim(kept), F.lit(" "), F.lit("_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(EMPTY_SLUG))


def join_list(values: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Join non-null, non-empty elements with ``sep``; NULL list -> ''."""
    kept = F.filter(_c(values), lambda v: v.isNotNull() & (v != ""))
    return F.coalesce(F.array_join(kept, sep), F.lit(""))


def split_list(text: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Inverse of :func:`join_list`; empty pieces are dropped."""
    parts = F.split(_c(text), re.escape(sep))
    return F.filter(parts, lambda v: v.isNotNull() & (v != ""))


def pluck(values: Column | str, field: str) -> Column:
    """``[x.field for x in values]`` over an array of structs."""
    return F.transform(_c(values), lambda x: x.getField(field))
