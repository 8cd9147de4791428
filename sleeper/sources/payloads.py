"""Scans over landed raw payloads (JSON text and HTML pages).

Every reader takes a DataFrame of landed payloads and returns typed columns;
a missing or unparseable payload is the data form of a failed fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeper import schemas as T
from sleeper.functions.ids import ids_from_attribute_html, links, safe_int

def details_columns(payload: Column, key: Column) -> list[Column]:
    """[details_ok, details] from a details payload (a map keyed by the id string).

    Malformed text parses to NULL for a map, so ``details_ok`` is false for a
    missing or unparseable payload (a failed fetch); ``details`` is NULL when the
    lookup failed or ``success`` is false (an absent item).
    """
    m = F.from_json(payload, T.DETAILS_PAYLOAD)
    e = F.try_element_at(m, key.cast("string"))
    return [m.isNotNull().alias("details_ok"), F.when(e.getField("success"), e.getField("data")).alias("details")]


def reviews_columns(payload: Column) -> list[Column]:
    """[reviews_ok, summary]. A struct schema parses malformed text into a struct
    of NULLs, so the schema carries a corrupt-record field and ``reviews_ok`` is
    false when the payload is missing or did not parse, from the same parse.
    Sample reviews in the payload are not read. Counts and score may be sent as
    numbers or as texts."""
    p, ok = _parsed(payload, T.REVIEWS_PAYLOAD)
    s = p.getField("query_summary")
    summary = F.struct(*[loose_int(s.getField(n)).alias(n) for n in T.REVIEWS_NUMBERS],
                       s.getField("review_score_desc").alias("review_score_desc"))
    return [ok.alias("reviews_ok"), F.when(ok & s.isNotNull(), summary).alias("summary")]


def _parsed(payload: Column, schema: str) -> tuple[Column, Column]:
    """(struct, did it parse): a corrupt-record field tells malformed text from missing fields."""
    p = F.from_json(payload, schema[:-1] + ",_corrupt_record:string>", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return p, payload.isNotNull() & p.getField("_corrupt_record").isNull()


def loose_int(text: Column) -> Column:
    """A number sent as 120, "120" or 120.0 as an int (a fraction is cut off a number, not off a
    text); NULL for anything else."""
    number = F.coalesce(safe_int(text), F.when(text.rlike(r"^-?[0-9]+\.[0-9]+$"), text.try_cast("double").try_cast("bigint")))
    return number.try_cast("int")


def players_column(payload: Column) -> Column:
    """The player count only when ``result == 1``, else NULL."""
    r = F.from_json(payload, T.PLAYERS_PAYLOAD).getField("response")
    ok = F.coalesce(safe_int(r.getField("result")), F.lit(0)) == 1
    return F.when(ok, safe_int(r.getField("player_count")).cast("int")).alias("players")


def parse_details(df: DataFrame, key: str = "appid") -> DataFrame:
    """(key, details_ok, details) from landed (key, payload) rows."""
    return df.select(F.col(key), *details_columns(F.col("payload"), F.col(key)))


def parse_reviews(df: DataFrame, key: str = "appid") -> DataFrame:
    """(key, reviews_ok, summary) from landed (key, payload) rows."""
    return df.select(F.col(key), *reviews_columns(F.col("payload")))


def latest_payloads(keys: DataFrame, raws: dict[str, DataFrame], key: str = "appid",
                    order_by: list[str] | None = None) -> DataFrame:
    """(key, <kind>...): the latest landed payload text of each kind for ``keys``.

    ``raws`` maps a kind (e.g. "details") to a landed (key, payload[, order cols])
    table. The tables are tagged and unioned, semi-joined to the wanted keys (Spark
    broadcasts these if it measures them to be small), and reduced by ONE aggregate: per key, each
    kind's latest payload (by ``order_by`` columns when present, then a content
    hash, so a re-fetched item never duplicates a row). One shuffle for all
    kinds, on narrow (key, text) rows; parsing happens afterwards, only for the
    selected payloads.
    """
    k = keys.select(key)
    tagged = None
    for kind, raw in raws.items():
        order = [F.col(c) for c in (order_by or []) if c in raw.columns]
        t = raw.select(F.col(key), F.lit(kind).alias("_kind"), F.col("payload"),
                       F.struct(*order, F.xxhash64("payload").alias("_h")).alias("_order"))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    mine = tagged.join(k, key, "left_semi")
    return mine.groupBy(key).agg(*[
        # max_by skips NULL orderings, so each column only sees rows of its kind
        F.max_by("payload", F.when(F.col("_kind") == kind, F.col("_order"))).alias(kind)
        for kind in raws])


def parse_ranks(df: DataFrame, limit: int = 0, list_cols: list[str] | None = None) -> DataFrame:
    """Ranked list payloads -> (list cols..., pos, appid, rank); first ``limit`` entries
    when ``limit > 0``. Entries whose id is not an integer are dropped."""
    ranks = F.from_json(F.col("payload"), T.RANKS_PAYLOAD).getField("response").getField("ranks")
    ex = df.select(*(list_cols or []), F.posexplode(ranks).alias("pos", "entry"))
    if limit > 0:
        ex = ex.where(F.col("pos") < limit)
    out = ex.select(*(list_cols or []), "pos", safe_int(F.col("entry.appid")).alias("appid"),
                    F.col("entry.rank").alias("rank"))
    return out.where(F.col("appid").isNotNull())


CORRUPT_PAGE = "a results page did not parse"

#: Pages and ids that one task of the search pages sorts or aggregates.
ROWS_A_TASK = 200_000
#: Bytes of a row group of parsed pages, and of what a task reads for their sessions' rules.
PAGE_BYTES = 8 << 20


def search_pages(df: DataFrame, max_pages: int | None = None, session: str = "session_id",
                 page: str = "page_idx") -> DataFrame:
    """Results pages parsed once: (session, page, ok, ids, total). Ids come from ``data-ds-appid``
    attributes of ``results_html`` (missing HTML is a page without ids); ``ok`` is false for
    text that does not parse."""
    p, ok = _parsed(F.col("payload"), T.SEARCH_PAYLOAD)
    pages = df if max_pages is None else df.where(F.col(page) < max_pages)
    return pages.select(
        session, page, ok.alias("ok"),
        F.coalesce(ids_from_attribute_html(p.getField("results_html")), F.array().cast("array<bigint>"))
         .alias("ids"),
        F.coalesce(safe_int(p.getField("total_count")), F.lit(0)).alias("total"))


def place(page: str, pos: str) -> Column:
    """Page and place on it in one number."""
    return F.col(page).cast("long") * (1 << 32) + F.col(pos)


def _refuse_corrupt(sessions: DataFrame, stop: str, bad: str, on_corrupt: str) -> None:
    """A corrupt page up to a session's stop is a failed fetch that ends the run; with
    ``on_corrupt="report"`` it is left out (see :func:`corrupt_pages`). It never is the end of the results."""
    reached = F.col(bad).isNotNull() & (F.col(stop).isNull() | (F.col(bad) <= F.col(stop)))
    if on_corrupt != "report" and sessions.where(reached).head(1):
        raise ValueError(CORRUPT_PAGE)


def corrupt_pages(df: DataFrame, session: str = "session_id", page: str = "page_idx") -> DataFrame:
    """(session, page) of results pages that do not parse, read or not."""
    return df.where(~_parsed(F.col("payload"), T.SEARCH_PAYLOAD)[1]).select(session, page)


def _session_rules(pages: DataFrame, session: str, page: str, on_corrupt: str) -> DataFrame:
    """(_s, _stop, _total, _n, _ids): per session the first page without ids, the reported total and the numbers
    of pages and ids, from an aggregate over pages, whose ids are counted only. The total is that of the first page
    that reports one (the smaller if two pages share an index), ids or not, unless it lies behind the stop.

    Scan and shuffle are cut by the number of pages, so that no task's aggregate grows with the input.
    """
    rules = pages.groupBy(F.struct(session).alias("_s")).agg(
        F.min(F.when(F.col("ok") & (F.size("ids") == 0), F.col(page))).alias("_stop"),
        F.min(F.when(~F.col("ok"), F.col(page))).alias("_bad"),
        F.min(F.when(F.col("total") > 0, F.struct(F.col(page).alias("page"), "total"))).alias("_first"),
        F.count(F.lit(1)).alias("_n"), F.sum(F.size("ids")).alias("_ids"))
    read = F.col("_stop").isNull() | (F.col("_first.page") <= F.col("_stop"))
    from sleeper.session import materialize, setting

    spark = pages.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pages.count() // ROWS_A_TASK))
    with setting(spark, spark__sql__files__maxPartitionBytes=str(PAGE_BYTES), spark__sql__shuffle__partitions=str(parts),
                 spark__sql__adaptive__advisoryPartitionSizeInBytes=str(PAGE_BYTES)):
        rules = materialize(rules.select("_s", "_stop", "_bad", F.when(read, F.col("_first.total")).alias("_total"),
                                         "_n", "_ids"), "session_rules")
    _refuse_corrupt(rules, "_stop", "_bad", on_corrupt)
    return rules


def _read_pages(df: DataFrame, max_pages: int | None, session: str, page: str,
                on_corrupt: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(pages of hot sessions, pages of the others, rules of all, parts): every page is parsed once, and those
    behind the stop go before their ids are listed.

    A hot session has so large a share of all pages (see :mod:`sleeper.operators.skew`) that its pages stay where
    they are and its rule is broadcast. The others are dealt by session, into ``parts`` of about ROWS_A_TASK pages and ids.
    """
    from sleeper.operators.skew import HOT_SHARE
    from sleeper.session import materialize

    pages = materialize(search_pages(df, max_pages, session, page), "parsed_pages", **{"parquet.block.size": PAGE_BYTES})
    rules = _session_rules(pages, session, page, on_corrupt)
    total = rules.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("pages"), F.coalesce(F.sum("_ids"), F.lit(0)).alias("ids")).first()
    parts, floor = max(1, -(-(total["pages"] + total["ids"]) // ROWS_A_TASK)), max(1, int(total["pages"] * HOT_SHARE))
    listed = pages.where(F.size("ids") > 0).select(F.struct(session).alias("_s"), page, "ids")
    rule = rules.select("_s", "_stop", "_total")
    hot, cold = F.broadcast(rule.where(rules["_n"] > floor)), rule.where(rules["_n"] <= floor)
    rest = listed.join(hot.select("_s"), "_s", "left_anti").repartition(parts, "_s").join(cold.repartition(parts, "_s"), "_s")
    hot, cold = (x.where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).select("_s", page, "ids", "_total")
                 for x in (listed.join(hot, "_s"), rest))
    return hot, cold, rules, parts


def _totals(rules: DataFrame, session: str) -> DataFrame:
    return rules.where(F.col("_total").isNotNull()).select(F.col(f"_s.{session}").alias(session),
                                                           F.col("_total").alias("reported_total"))


def session_first(df: DataFrame, max_pages: int | None = None, session: str = "session_id",
                  page: str = "page_idx", on_corrupt: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Each session's distinct ids at their first place, (session, appid, first_page, first_pos, reported_total),
    and (session, reported_total) of every session that reports one, also of those that list no ids.

    Paging stops at a session's first page without ids. ``on_corrupt``: see :func:`_refuse_corrupt`.
    """
    hot, cold, rules, parts = _read_pages(df, max_pages, session, page, on_corrupt)
    group = ["_s", "_total", "appid"]  # a session has one total: it rides along as part of the group

    def places(kept: DataFrame, *more: str) -> DataFrame:
        each = kept.select("_s", "_total", *more, page, F.posexplode("ids").alias("pos", "appid"))
        return each.where(F.col("appid").isNotNull()).groupBy(*group, *more).agg(F.min(place(page, "pos")).alias("place"))

    # the others lie by session already; the ids of a hot one meet in two steps: where groups of its pages lie, then by id
    dealt = hot.withColumn("_deal", F.pmod(F.xxhash64(page), F.lit(parts))).repartition(parts, "_s", "_deal")
    met = places(dealt, "_deal").repartition(parts, "_s", "appid").groupBy(*group).agg(F.min("place").alias("place"))
    first = met.unionByName(places(cold))
    ids = first.select(
        F.col(f"_s.{session}").alias(session), "appid",
        F.shiftright("place", 32).cast(df.schema[page].dataType).alias("first_page"),
        F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("first_pos"), F.col("_total").alias("reported_total"))
    return ids, _totals(rules, session)


def session_first_ids(df: DataFrame, max_pages: int | None = None, session: str = "session_id",
                      page: str = "page_idx", on_corrupt: str = "fail") -> DataFrame:
    """The ids of :func:`session_first`."""
    return session_first(df, max_pages, session, page, on_corrupt)[0]


def search_page_ids(df: DataFrame, max_pages: int | None = None, session: str = "session_id",
                    page: str = "page_idx", on_corrupt: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Search-result pages -> ((session, page, pos, appid), (session, reported_total)), all ids of the pages
    that are read; see :func:`session_first`."""
    hot, cold, rules, _ = _read_pages(df, max_pages, session, page, on_corrupt)
    ids = hot.unionByName(cold).select(F.col(f"_s.{session}").alias(session), page, F.posexplode("ids").alias("pos", "appid"))
    return ids, _totals(rules, session)


def chart_page_links(df: DataFrame, pattern: str, max_pages: int | None = None,
                     session: str = "session_id", page: str = "page_idx",
                     html: str = "html", as_ids: bool = True) -> DataFrame:
    """Chart/listing pages -> (session, page, pos, value), stopping at the first page
    whose HTML has no match of ``pattern``. ``as_ids`` casts captures to bigint.

    The HTML is read once; only the links are written, aggregated and joined. The
    stop is a per-session aggregate joined back (null-safe: pages of a NULL session
    form their own session).
    """
    from sleeper.session import materialize

    pages = df if max_pages is None else df.where(F.col(page) <= max_pages)
    pages = materialize(pages.select(session, page, links(F.col(html), pattern).alias("vals")), "page_links")
    stop = pages.groupBy(session).agg(F.min(F.when(F.size("vals") == 0, F.col(page))).alias("_stop"))
    stop = stop.withColumnRenamed(session, "_session")
    kept = pages.join(stop, pages[session].eqNullSafe(stop["_session"])).where(
        F.col("_stop").isNull() | (F.col(page) <= F.col("_stop")))
    out = kept.select(session, page, F.posexplode("vals").alias("pos", "value"))
    if as_ids:
        out = out.withColumn("value", F.col("value").try_cast("bigint"))
    return out
