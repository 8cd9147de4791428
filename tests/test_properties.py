"""Randomised checks of the parsers: values are rendered to text, and parsing must give them back."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from sleeper.functions import ids_from_attribute_html, parse_price


# A token is rendered text and the id it stands for (None: no id). What a page must yield
# follows from the tokens it was made of, so the page is never parsed here.
token = st.one_of(
    st.integers(0, 10**9).map(lambda n: (str(n), n)),
    st.integers(0, 10**6).map(lambda n: (f"  {n} ", n)),
    st.integers(2**63, 2**70).map(lambda n: (str(n), None)),
    st.sampled_from([("abc", None), ("x1", None), ("12a", None), ("-5", None), ("1.5", None), (" ", None)]))
single = token.map(lambda t: (t[0], [t[1]]))
several = st.lists(token, max_size=4).map(lambda ts: ("[" + ",".join(t for t, _ in ts) + "]", [n for _, n in ts]))
page = st.lists(st.one_of(single, several), max_size=6).map(lambda values: (
    "".join(f'<li class="row" data-ds-appid="{text}">x</li>' for text, _ in values),
    [n for _, ids in values for n in ids if n is not None]))


@settings(max_examples=20, deadline=None)
@given(st.lists(page, min_size=1, max_size=8))
def test_ids_are_those_a_page_was_made_of(spark, pages):
    df = spark.createDataFrame([(i, html) for i, (html, _) in enumerate(pages)], "i int, html string")
    got = {r["i"]: r["ids"] for r in df.select("i", ids_from_attribute_html("html").alias("ids")).collect()}
    for i, (html, ids) in enumerate(pages):
        assert got[i] == ids, html


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 99_999_999), min_size=1, max_size=20), st.sampled_from(range(4)))
def test_price_formats_round_trip(spark, cents_list, style):
    def render(c: int) -> str:
        whole, frac = divmod(c, 100)
        grouped = f"{whole:,}"
        if style == 0:
            return f"${grouped}.{frac:02d}"
        if style == 1:
            return grouped.replace(",", ".") + f",{frac:02d}€"
        if style == 2:
            return f"S/.{whole}.{frac:02d}"
        return f"Mex$ {grouped}.{frac:02d}"

    df = spark.createDataFrame([(i, render(c)) for i, c in enumerate(cents_list)], "i int, t string")
    got = {r["i"]: r["p"] for r in df.select("i", parse_price("t").alias("p")).collect()}
    for i, c in enumerate(cents_list):
        assert got[i] == Decimal(c) / 100, render(c)
