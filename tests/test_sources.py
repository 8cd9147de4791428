"""Paging semantics of the page scans (SRC-4, SRC-5): stop at the first page without
ids, page caps, and which total is reported."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sleeper.sources import payloads as P

from conftest import rows


def test_chart_pages_stop_at_first_empty_page_per_session(spark):
    pages = spark.createDataFrame([
        (1, 1, '<a href="/app/10/">a</a><a href="/app/11">b</a>'),
        (1, 2, "<p>no apps here</p>"),
        (1, 3, '<a href="/app/12">c</a>'),          # after the stop: not read
        (2, 1, '<a href="/app/20">d</a>'),
        (2, 2, '<a href="/app/21">e</a><a href="/app/20">f</a>'),
    ], "session_id long, page_idx int, html string")
    got = rows(P.chart_page_links(pages, r"/app/(\d+)"), "session_id", "page_idx", "pos", "value")
    assert got == [(1, 1, 0, 10), (1, 1, 1, 11), (2, 1, 0, 20), (2, 2, 0, 21), (2, 2, 1, 20)]
    capped = rows(P.chart_page_links(pages, r"/app/(\d+)", max_pages=1), "session_id", "value")
    assert capped == [(1, 10), (1, 11), (2, 20)]


def page(total, ids):
    html = "".join(f'<div data-ds-appid="{i}"></div>' for i in ids)
    return json.dumps({"total_count": total, "results_html": html})


def test_search_pages_stop_and_reported_total(spark):
    pages = spark.createDataFrame([
        (1, 0, page("0", ["1", "[2, 3]"])),
        (1, 1, page("120", ["3", "4"])),
        (1, 2, page("99", [])),                      # empty: paging stops here (inclusive)
        (1, 3, page("77", ["5"])),
        (2, 0, page("0", ["7"])),
        (2, 1, page("0", [])),                       # stops before any non-zero total
        (2, 2, page("50", ["8"])),
        (3, 0, json.dumps({"total_count": "15"})),   # no results_html: an empty page
    ], "session_id long, page_idx int, payload string")
    ids, totals = P.search_page_ids(pages)
    assert rows(ids, "session_id", "page_idx", "pos", "appid") == [
        (1, 0, 0, 1), (1, 0, 1, 2), (1, 0, 2, 3), (1, 1, 0, 3), (1, 1, 1, 4), (2, 0, 0, 7)]
    assert rows(totals, "session_id", "reported_total") == [(1, 120), (3, 15)]
    ids_cap, _ = P.search_page_ids(pages, max_pages=1)
    assert rows(ids_cap, "session_id", "appid") == [(1, 1), (1, 2), (1, 3), (2, 7)]


def test_ranked_list_head_and_non_integer_ids(spark):
    payload = json.dumps({"response": {"ranks": [{"appid": "5", "rank": 1}, {"appid": "x", "rank": 2},
                                                 {"appid": "9", "rank": 3}]}})
    df = spark.createDataFrame([(1, payload)], "list_id long, payload string")
    assert rows(P.parse_ranks(df, list_cols=["list_id"]), "pos", "appid") == [(0, 5), (2, 9)]
    assert rows(P.parse_ranks(df, limit=2, list_cols=["list_id"]), "pos", "appid") == [(0, 5)]


def test_pages_without_a_session_are_kept(spark):
    pages = spark.createDataFrame([(None, 1, '<a href="/app/3">x</a>'), (None, 2, '<a href="/app/4">y</a>')],
                                  "session_id long, page_idx int, html string")
    assert rows(P.chart_page_links(pages, r"/app/(\d+)"), "value") == [(3,), (4,)]
    sp = spark.createDataFrame([(None, 0, page("9", ["6"]))], "session_id long, page_idx int, payload string")
    ids, totals = P.search_page_ids(sp)
    assert rows(ids, "appid") == [(6,)]
    assert rows(totals, "reported_total") == [(9,)]


def test_page_fed_lists_grow_with_the_tables(spark):
    from sleeper.plans import queries as Q
    from sleeper.plans import workload as W

    from conftest import SF_ORACLE

    n = {t: W.table(spark, SF_ORACLE, t).count() for t in ("part", "supplier", "customer")}
    got = {r["source"]: r["n"] for r in Q.session_sources(spark, SF_ORACLE).tagged.groupBy("source").agg(
        F.count_distinct("appid").alias("n")).collect()}
    assert got["store"] >= n["part"] / 2 and got["charts"] >= n["supplier"] / 2 and got["top_list"] >= n["customer"] / 2


def test_a_total_without_ids_is_kept(spark):
    """A session that lists nothing still reports a total; a total behind the stop does not count."""
    from sleeper.sources import payloads as P

    empty, some = "<p></p>", '<a data-ds-appid=\\"7\\"></a>'
    rows = [(1, 0, f'{{"total_count": "5", "results_html": "{empty}"}}'),
            (2, 0, f'{{"total_count": 0, "results_html": "{some}"}}'), (2, 1, f'{{"total_count": 9, "results_html": "{empty}"}}'),
            (2, 2, f'{{"total_count": 4, "results_html": "{some}"}}'),
            (3, 0, f'{{"results_html": "{empty}"}}'), (3, 1, f'{{"total_count": 8, "results_html": "{some}"}}'),
            (None, 0, '{"total_count": 6}')]
    pages = spark.createDataFrame(rows, "session_id int, page_idx int, payload string")
    ids, totals = P.session_first(pages)
    assert sorted(totals.collect(), key=str) == sorted([(1, 5), (2, 9), (None, 6)], key=str)
    assert [tuple(r) for r in ids.collect()] == [(2, 7, 0, 0, 9)]


def test_no_task_of_the_search_pages_grows_with_them(spark, monkeypatch):
    """Pages and ids are dealt by their number: small sessions by session, a large one's by id; the ids are those
    that reading the pages in order gives."""
    n, ids_a_page = 600, 4
    listed = [(s, p, [(s * 7 + p * i) % 90 for i in range(ids_a_page)]) for s in range(n) for p in range(2)]
    listed += [(-1, p, [p * 3 + i for i in range(ids_a_page)] if p != 380 else []) for p in range(400)]
    listed += [(None, 0, [5, 5, 6]), (None, 0, [6, 4])]
    pages = spark.createDataFrame([(s, p, page("9", map(str, x))) for s, p, x in listed],
                                  "session_id long, page_idx int, payload string")
    want = {}
    for s, p, x in sorted(listed, key=lambda r: (r[0] is None, r[0], r[1])):
        if s != -1 or p < 380:
            for i, a in enumerate(x):
                want[s, a] = min(want.get((s, a), (p, i)), (p, i))
    monkeypatch.setattr(P, "ROWS_A_TASK", 250, raising=False)
    got = P.session_first_ids(pages)
    assert sorted(((r[0], r[1]), (r[2], r[3])) for r in got.where("session_id is not null").collect()) == \
        sorted((k, v) for k, v in want.items() if k[0] is not None)
    assert {(r[1], r[2], r[3], r[4]) for r in got.where("session_id is null").collect()} == {(5, 0, 0, 9), (6, 0, 0, 9), (4, 0, 1, 9)}
    most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < len(want) / 8
    assert sum(len(x) for _, _, x in listed) == P.search_page_ids(pages)[0].count() + sum(
        len(x) for s, p, x in listed if s == -1 and p > 380)
