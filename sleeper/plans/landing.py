"""Render the driver tables as landed raw payloads (JSON text / HTML).

The extract jobs start from landed payloads; these builders produce them from
the driver tables with ``to_json`` / string functions, one payload per row of
the source table (no grouping, so no payload grows with a hot key). Fixed
rules land some payloads truncated (a failed fetch: the text does not parse)
or mark items absent; every source row is landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeper.plans import workload as W


def item_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part ⟕ per-part lineitem aggregate (shared by the review and player payloads)."""
    part = W.table(spark, sf_dir, "part")
    stats = W.line_stats(W.table(spark, sf_dir, "lineitem"))
    return part.join(stats, part.p_partkey == stats.l_partkey, "left")


def details_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(appid, payload): a map keyed by the id string -> {success, data{...}}.

    Truncated (unparseable) payload for p_partkey % 101 = 5 (failed fetch);
    success=false for p_partkey % 13 = 0; no ``name`` key for p_partkey % 17 = 0;
    free (is_free, no price_overview) for p_partkey % 97 = 3.
    """
    p = W.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    no_meta = F.col("p_size") % 10 == 0
    data = F.struct(
        F.when(F.col("p_type") == "PROMO", F.lit("dlc")).otherwise(F.lit("game")).alias("type"),
        F.when(key % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"),
        F.array(F.col("p_brand")).alias("developers"),
        F.array(F.col("p_brand"), F.lit("")).alias("publishers"),
        F.array(F.struct(F.col("p_type").alias("description")),
                F.struct(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("description"))).alias("genres"),
        F.struct(F.concat(F.lit("1 Jan, "), (F.lit(1990) + F.col("p_size") % 10).cast("string"))
                 .alias("date")).alias("release_date"),
        (key % 97 == 3).alias("is_free"),
        F.when(key % 97 == 3, F.lit(None)).otherwise(
            F.struct(W.price_text(F.col("p_retailprice"), key % 6).alias("final_formatted"))).alias("price_overview"),
        F.when(no_meta, F.lit(None)).otherwise(F.struct(
            (F.col("p_size") * 3 - 20).cast("int").alias("score"),
            F.concat(F.lit("https://example.org/item/"), key.cast("string")).alias("url"))).alias("metacritic"),
        F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("short_description"),
    )
    entry = F.struct((key % 13 != 0).alias("success"), data.alias("data"))
    payload = F.to_json(F.create_map(key.cast("string"), entry))
    payload = F.when(key % 101 == 5, F.substring(payload, 1, 12)).otherwise(payload)
    return p.select(key.alias("appid"), payload.alias("payload"))


def reviews_payloads(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    """(appid, payload) review summaries; truncated for p_partkey % 103 = 9."""
    s = stats if stats is not None else item_stats(spark, sf_dir)
    tot = F.coalesce(F.col("total_resenas"), F.lit(0))
    pos = F.coalesce(F.col("resenas_positivas"), F.lit(0))
    neg = F.coalesce(F.col("resenas_negativas"), F.lit(0))
    s = s.withColumns({"total_resenas": tot, "resenas_positivas": pos, "resenas_negativas": neg})
    summary = F.struct(
        F.col("total_resenas").alias("total_reviews"),
        F.col("resenas_positivas").alias("total_positive"),
        F.col("resenas_negativas").alias("total_negative"),
        W.review_score().alias("review_score"),
        W.review_label(spanish=(F.col("p_size") % 2 == 0)).alias("review_score_desc"),
    )
    payload = F.to_json(F.struct(F.lit(1).alias("success"), summary.alias("query_summary")))
    payload = F.when(F.col("p_partkey") % 103 == 9, F.substring(payload, 1, 12)).otherwise(payload)
    return s.select(F.col("p_partkey").alias("appid"), payload.alias("payload"))


def players_payloads(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    """(appid, payload) player counts = open lines; result 42 (no data) when none."""
    s = stats if stats is not None else item_stats(spark, sf_dir)
    n = F.coalesce(F.col("open_lines"), F.lit(0))
    resp = F.struct(F.when(n > 0, F.lit(1)).otherwise(F.lit(42)).alias("result"),
                    n.alias("player_count"))
    return s.select(F.col("p_partkey").alias("appid"), F.to_json(F.struct(resp.alias("response"))).alias("payload"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(session_id, page_idx, payload): one result page per lineitem row.

    Session = order, page = line number. The page lists the part id, a
    bracketed ``[supplier, part]`` pair and a non-numeric id. Lines with
    return flag 'N' and status 'O' render a page without ids (end of results).
    total_count is the line quantity ('0' on line 1). The pages lie as many files would, dealt
    by session and page (the numbers they are rendered from are, not the pages).
    """
    li = W.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity").repartition(
        "l_orderkey", "l_linenumber")
    empty = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    full = F.concat(
        F.lit('<div class="row" data-ds-appid="'), F.col("l_partkey").cast("string"), F.lit('"></div>'),
        F.lit('<div data-ds-appid="[ '), F.col("l_suppkey").cast("string"), F.lit(", "),
        F.col("l_partkey").cast("string"), F.lit(' ]"></div>'),
        F.lit('<div data-ds-appid="n'), F.col("l_linenumber").cast("string"), F.lit('"></div>'))
    html = F.when(empty, F.lit('<div data-ds-appid="none"></div>')).otherwise(full)
    total = F.when(F.col("l_linenumber") == 1, F.lit("0")).otherwise(
        F.col("l_quantity").cast("bigint").cast("string"))
    payload = F.to_json(F.struct(total.alias("total_count"), html.alias("results_html")))
    return li.select(F.col("l_orderkey").alias("session_id"), F.col("l_linenumber").alias("page_idx"),
                     payload.alias("payload"))


def ranks_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_id, list_page, payload): a ranked list per lineitem row:
    [part (rank 1), supplier (rank 2), a non-integer id (rank 3)], dealt as :func:`search_pages`."""
    li = W.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(
        "l_orderkey", "l_linenumber")
    ranks = F.array(
        F.struct(F.col("l_partkey").cast("string").alias("appid"), F.lit(1).alias("rank")),
        F.struct(F.col("l_suppkey").cast("string").alias("appid"), F.lit(2).alias("rank")),
        F.struct(F.concat(F.lit("x"), F.col("l_linenumber").cast("string")).alias("appid"),
                 F.lit(3).alias("rank")))
    payload = F.to_json(F.struct(F.struct(ranks.alias("ranks")).alias("response")))
    return li.select(F.col("l_orderkey").alias("list_id"), F.col("l_linenumber").alias("list_page"),
                     payload.alias("payload"))


# ---------------------------------------------------------------------------
# one run's landed pages
# ---------------------------------------------------------------------------

STORE_PAGE_SIZE, STORE_STOP, STORE_CORRUPT = 50, 20, 23


def store_pages(spark: SparkSession, sf_dir: str, session_pages: int | None = None) -> DataFrame:
    """(session_id, page_idx, payload): the parts as one session of store pages, or as sessions of
    ``session_pages`` pages each, of which every third, from the first on, has the stop below.

    Each page lists STORE_PAGE_SIZE parts (a bounded group) in descending order of
    their key. Page STORE_STOP has no ids, so what lies behind it is never read;
    page STORE_CORRUPT, behind it, does not parse. The reported total is the number
    of parts, '0' on the first page.
    """
    part = W.table(spark, sf_dir, "part").select("p_partkey")
    page = F.floor(F.col("p_partkey") / STORE_PAGE_SIZE).cast("int").alias("page_idx")
    pages = part.groupBy(page).agg(F.sort_array(F.collect_list("p_partkey"), asc=False).alias("keys"))
    pages = pages.withColumn("session_id", F.lit(0).cast("long"))
    if session_pages:
        pages = pages.withColumns({"session_id": F.floor(F.col("page_idx") / session_pages),
                                   "page_idx": F.col("page_idx") % session_pages})
    stops = F.col("session_id") % 3 == 0
    rows = F.transform("keys", lambda k: F.concat(F.lit('<a data-ds-appid="'), k.cast("string"), F.lit('"></a>')))
    html = F.when(stops & (F.col("page_idx") == STORE_STOP), F.lit("<p>no results</p>")).otherwise(F.array_join(rows, ""))
    total = F.when(F.col("page_idx") == 0, F.lit("0")).otherwise(part.select(F.count(F.lit(1))).scalar().cast("string"))
    payload = F.to_json(F.struct(total.alias("total_count"), html.alias("results_html")))
    payload = F.when(stops & (F.col("page_idx") == STORE_CORRUPT), F.substring(payload, 1, 20)).otherwise(payload)
    return pages.select("session_id", "page_idx", payload.alias("payload"))


def chart_pages(spark: SparkSession, sf_dir: str, sessions: int = 1, session_pages: int | None = None) -> DataFrame:
    """(session_id, page_idx from 1 on, html): a page per supplier that links to the supplier's key and the
    next; keys that leave 36 over 37 have a page without links. Suppliers are dealt to ``sessions`` in turn, or
    ``session_pages`` make a session, whose number grows with the table."""
    s = W.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    link = lambda k: F.concat(F.lit('<td><a href="/app/'), k.cast("string"), F.lit('">x</a></td>'))
    html = F.when(key % 37 == 36, F.lit("<p>nothing</p>")).otherwise(F.concat(link(key), link(key + 1)))
    session, page = key % sessions, F.floor(key / sessions)
    if session_pages:
        session, page = F.floor(key / session_pages), key % session_pages
    return s.select(session.cast("long").alias("session_id"), (page + 1).cast("int").alias("page_idx"), html.alias("html"))


def top_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payload): one ranked list of the first 150 customers (a bounded group); entry n names the part of
    three times its customer's key, every tenth entry repeats part 3, entries that leave 7 over 20 name none."""
    c = W.table(spark, sf_dir, "customer").where(F.col("c_custkey") < 150).select("c_custkey")
    k = F.col("c_custkey")
    appid = F.when(k % 20 == 7, F.lit("none")).when(k % 10 == 0, F.lit("3")).otherwise((k * 3).cast("string"))
    entry = F.struct(k.alias("k"), appid.alias("appid"), k.cast("int").alias("rank"))
    entries = c.agg(F.sort_array(F.collect_list(entry)).alias("e"))
    ranks = F.transform("e", lambda e: F.struct(e["appid"].alias("appid"), e["rank"].alias("rank")))
    return entries.select(F.to_json(F.struct(F.struct(ranks.alias("ranks")).alias("response"))).alias("payload"))


TOP_LIST_ENTRIES = 150


def top_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_id, payload): the entries of :func:`top_list` for all customers, in a list (a bounded group) for each
    block of TOP_LIST_ENTRIES; an entry's rank is its customer's place in the block."""
    k = F.col("c_custkey")
    appid = F.when(k % 20 == 7, F.lit("none")).when(k % 10 == 0, F.lit("3")).otherwise((k * 3).cast("string"))
    entry = F.struct(k.alias("k"), appid.alias("appid"), (k % TOP_LIST_ENTRIES).cast("int").alias("rank"))
    lists = W.table(spark, sf_dir, "customer").groupBy(F.floor(k / TOP_LIST_ENTRIES).alias("list_id")).agg(
        F.sort_array(F.collect_list(entry)).alias("e"))
    ranks = F.transform("e", lambda e: F.struct(e["appid"].alias("appid"), e["rank"].alias("rank")))
    return lists.select("list_id", F.to_json(F.struct(F.struct(ranks.alias("ranks")).alias("response"))).alias("payload"))
