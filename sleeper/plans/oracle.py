"""DuckDB SQL oracles for the registered queries.

Each string recomputes a query's expected result from the driver's tables with
plain SQL, independently of the Spark code: parsers are checked against the
values the synthetic text was rendered from, the funnel stop rule against a
running window, dedup against ``row_number``.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# shared CTE fragments
# ---------------------------------------------------------------------------

R4 = "(CASE WHEN abs(({x}) * 10000.0 - trunc(({x}) * 10000.0)) = 0.5 " \
     "THEN 2 * round(({x}) * 10000.0 / 2) ELSE round(({x}) * 10000.0) END) / 10000.0"


def r4(x: str) -> str:
    """numpy-style round(x, 4): multiply, round half to even, divide."""
    return R4.format(x=x)


CATALOG = """
catalog AS (
  SELECT p.p_partkey AS appid, p.p_name AS nombre,
         concat_ws(' | ', p.p_type, split_part(p.p_name, ' ', 1)) AS generos,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS precio,
         CAST(coalesce(s.total_resenas, 0) AS INTEGER) AS total_resenas,
         CAST(coalesce(s.resenas_positivas, 0) AS INTEGER) AS resenas_positivas,
         CAST(coalesce(s.resenas_negativas, 0) AS INTEGER) AS resenas_negativas,
         CAST(floor(CAST(10 AS DOUBLE) * coalesce(s.resenas_positivas, 0)
                    / nullif(coalesce(s.total_resenas, 0), 0)) AS INTEGER) AS puntuacion
  FROM part p LEFT JOIN (
    SELECT l_partkey, count(*) AS total_resenas,
           count(*) FILTER (WHERE l_returnflag <> 'R') AS resenas_positivas,
           count(*) FILTER (WHERE l_returnflag = 'R') AS resenas_negativas
    FROM lineitem GROUP BY l_partkey) s ON p.p_partkey = s.l_partkey
)"""


def scored(src: str, name: str, cap: float = 1000.0, s: float = 0.55, a: float = 0.50,
           by: str | None = None) -> str:
    """CTE ``name`` = ``src`` plus the score columns (max per ``by`` or global)."""
    if by:
        mx = f"(SELECT {by}, greatest(max(total_resenas), 1) AS max_total FROM {src} GROUP BY {by})"
        join = f"JOIN {mx} m USING ({by})"
    else:
        mx = f"(SELECT greatest(max(total_resenas), 1) AS max_total FROM {src})"
        join = f"CROSS JOIN {mx} m"
    q = ("CAST(c.resenas_positivas AS DOUBLE) / CASE WHEN CAST(c.total_resenas AS DOUBLE) = 0 "
         "THEN CAST(1 AS DOUBLE) ELSE CAST(c.total_resenas AS DOUBLE) END")
    o = "CAST(1 AS DOUBLE) - CAST(c.total_resenas AS DOUBLE) / CAST(m.max_total AS DOUBLE)"
    p = (f"CASE WHEN CAST(c.precio AS DOUBLE) = 0 THEN CAST(1 AS DOUBLE) ELSE "
         f"greatest(CAST(0 AS DOUBLE), coalesce(CAST(1 AS DOUBLE) - CAST(c.precio AS DOUBLE) "
         f"/ CAST({cap} AS DOUBLE), CAST(0 AS DOUBLE))) END")
    return f"""
{name}_parts AS (
  SELECT c.*, {q} AS quality_score, {o} AS obscurity_score, {p} AS price_score
  FROM {src} c {join}
),
{name}_raw AS (
  SELECT *, {r4('CAST(0.5 AS DOUBLE) * quality_score + CAST(0.3 AS DOUBLE) * obscurity_score + CAST(0.2 AS DOUBLE) * price_score')} AS hidden_gem_score
  FROM {name}_parts
),
{name} AS (
  SELECT *, CASE WHEN hidden_gem_score >= {s} THEN 'S' WHEN hidden_gem_score >= {a} THEN 'A'
                 ELSE 'B' END AS tier
  FROM {name}_raw
)"""


SNAPSHOTS = """
per_year AS (
  SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS run, count(*) AS total_resenas,
         count(*) FILTER (WHERE l_returnflag <> 'R') AS resenas_positivas,
         count(*) FILTER (WHERE l_returnflag = 'R') AS resenas_negativas,
         count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines,
         min(l_shipdate) AS first_ship
  FROM lineitem GROUP BY 1, 2
),
cum AS (
  SELECT l_partkey, run, open_lines,
         sum(total_resenas) OVER w AS total_resenas,
         sum(resenas_positivas) OVER w AS resenas_positivas,
         sum(resenas_negativas) OVER w AS resenas_negativas,
         min(first_ship) OVER w AS first_ship
  FROM per_year
  WINDOW w AS (PARTITION BY l_partkey ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
snapshots AS (
  SELECT CAST(p.p_partkey AS INTEGER) AS appid,
         CASE WHEN p.p_partkey % 199 = 7 THEN NULL ELSE p.p_name END AS nombre,
         CAST(nullif(c.open_lines, 0) AS INTEGER) AS jugadores_actuales_api,
         p.p_brand AS desarrolladores, p.p_brand AS editores,
         concat_ws(' | ', p.p_type, split_part(p.p_name, ' ', 1)) AS generos,
         strftime(c.first_ship, '%Y-%m-%d') AS fecha_lanzamiento,
         CASE WHEN p.p_partkey % 97 = 3 THEN CASE WHEN p.p_size % 2 = 0 THEN CAST(0 AS DECIMAL(10,2)) END
              WHEN p.p_partkey % 6 IN (0, 1, 5) THEN CAST(p.p_retailprice AS DECIMAL(10,2))
              WHEN p.p_partkey % 6 IN (2, 3) THEN CAST(p.p_retailprice * 10 AS DECIMAL(10,2))
              ELSE CAST(round(p.p_retailprice * 10) AS DECIMAL(10,2)) END AS precio,
         CASE WHEN p.p_partkey % 97 = 3 THEN 'Free' ELSE {PRICE_TEXT} END AS precio_text,
         CASE WHEN p.p_size % 10 = 0 THEN NULL ELSE CAST(p.p_size * 3 - 20 AS INTEGER) END
           AS metacritic_score,
         CASE WHEN p.p_size % 10 = 0 THEN NULL
              ELSE 'https://example.org/item/' || CAST(p.p_partkey AS VARCHAR) END AS metacritic_url,
         '' AS descripcion_corta,
         CAST(c.total_resenas AS INTEGER) AS total_resenas,
         CAST(c.resenas_positivas AS INTEGER) AS resenas_positivas,
         CAST(c.resenas_negativas AS INTEGER) AS resenas_negativas,
         CAST(floor(CAST(10 AS DOUBLE) * c.resenas_positivas / nullif(c.total_resenas, 0)) AS INTEGER)
           AS puntuacion,
         CASE WHEN c.resenas_positivas / nullif(c.total_resenas, 0) >= 0.8
                THEN CASE WHEN p.p_size % 2 = 0 THEN 'Extremadamente positivas'
                          ELSE ' OVERWHELMINGLY Positive ' END
              WHEN c.resenas_positivas / nullif(c.total_resenas, 0) >= 0.7
                THEN CASE WHEN p.p_size % 2 = 0 THEN 'Muy positivas' ELSE 'Very Positive' END
              ELSE 'Mixed' END AS descripcion_puntuacion,
         p.p_partkey % 97 = 3 AND p.p_size % 2 = 0 AS es_gratis,
         c.run AS run
  FROM cum c JOIN part p ON c.l_partkey = p.p_partkey
)"""


def price_text(p: str, key: str) -> str:
    """The six localised store formats the snapshots render prices in."""
    return (f"CASE WHEN {key} % 6 = 0 THEN '$' || printf('%.2f', {p}) "
            f"WHEN {key} % 6 = 1 THEN replace(printf('%.2f', {p}), '.', ',') || '€' "
            f"WHEN {key} % 6 = 2 THEN 'Mex$ ' || format('{{:,.2f}}', {p} * 10) "
            f"WHEN {key} % 6 = 3 THEN translate(format('{{:,.2f}}', {p} * 10), ',.', '.,') || '€' "
            f"WHEN {key} % 6 = 4 THEN 'ARS$ ' || replace(format('{{:,.0f}}', {p} * 10), ',', '.') "
            f"ELSE 'S/.' || printf('%.2f', {p}) END")


SNAPSHOTS = SNAPSHOTS.replace("{PRICE_TEXT}", price_text("p.p_retailprice", "p.p_partkey"))


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SCORE_COLS = ("appid, nombre, generos, precio, total_resenas, resenas_positivas, "
              "resenas_negativas, puntuacion, quality_score, obscurity_score, price_score, "
              "hidden_gem_score, tier")


# ---------------------------------------------------------------------------
# landed pages, uncapped funnel, planted faults
# ---------------------------------------------------------------------------

PAGES = """
store AS (
  SELECT p_partkey AS appid, p_partkey // 50 AS page,
         row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey DESC) AS pos
  FROM part WHERE p_partkey // 50 < 20
),
chart AS (
  SELECT s_suppkey AS appid, s_suppkey AS page, 0 AS pos FROM supplier WHERE s_suppkey < 25
  UNION ALL SELECT s_suppkey + 1, s_suppkey, 1 FROM supplier WHERE s_suppkey < 25
),
top_list AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN 3 ELSE c_custkey * 3 END AS appid, c_custkey AS rank
  FROM customer WHERE c_custkey < 100 AND c_custkey % 20 <> 7
),
page_tagged AS (
  SELECT appid, 0 AS prio, min(page * 1000 + pos) AS place, 'store' AS source FROM store GROUP BY appid
  UNION ALL SELECT appid, 1, min(page * 1000 + pos), 'charts' FROM chart GROUP BY appid
  UNION ALL SELECT appid, 2, min(rank), 'top_list' FROM top_list GROUP BY appid
),
page_merged AS (
  SELECT appid, min(prio * 100000000 + place) AS k,
         array_to_string(list_sort(list(source)), ',') AS sources FROM page_tagged GROUP BY appid
),
cands AS (
  SELECT row_number() OVER (ORDER BY k, appid) AS candidate_rank, appid,
         ['store', 'charts', 'top_list'][1 + CAST(k // 100000000 AS INTEGER)] AS first_source, sources
  FROM page_merged
)"""

#: The same over sessions of 30 store pages (every third stops at page 20) and 25 chart pages, and lists of 150.
SESSIONS = """
store AS (
  SELECT p_partkey AS appid, p_partkey // 50 % 30 AS page,
         row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey DESC) AS pos
  FROM part WHERE p_partkey // 1500 % 3 <> 0 OR p_partkey // 50 % 30 < 20
),
chart_page AS (SELECT s_suppkey AS k, s_suppkey // 25 AS session FROM supplier),
chart_stop AS (SELECT session, min(k) FILTER (WHERE k % 37 = 36) AS stop FROM chart_page GROUP BY session),
chart_read AS (SELECT k FROM chart_page JOIN chart_stop USING (session) WHERE stop IS NULL OR k < stop),
chart AS (
  SELECT k AS appid, k % 25 AS page, 0 AS pos FROM chart_read
  UNION ALL SELECT k + 1, k % 25, 1 FROM chart_read
),
top_list AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN 3 ELSE c_custkey * 3 END AS appid, c_custkey % 150 AS rank
  FROM customer WHERE c_custkey % 150 < 100 AND c_custkey % 20 <> 7
),""" + PAGES[PAGES.index("\npage_tagged AS"):]


def _open_item() -> str:
    """The ITEM fragments up to ``classified``, with the open profile's thresholds."""
    body = ITEM.split("walked AS")[0].rstrip().rstrip(",")
    return body.replace("BETWEEN 20 AND 45", "BETWEEN 26 AND 32").replace("open_lines > 18", "open_lines > 14")


def _faulty() -> str:
    """CTE that plants the workload's faults into ``snapshots`` (as parsed values)."""
    k = "CAST(appid AS BIGINT) % 41"
    plant = {"appid": {1: "NULL"}, "nombre": {2: "NULL"}, "precio": {3: None, 14: "-5.00", 15: "35", 16: "99", 17: "4.99"},
             "total_resenas": {4: "NULL", 13: "9", 18: "0"}, "resenas_positivas": {5: "NULL", 11: "-1", 19: "100000"},
             "resenas_negativas": {6: "NULL", 12: "-1"}, "puntuacion": {7: "NULL", 9: "101"},
             "metacritic_score": {8: "101"}, "jugadores_actuales_api": {10: "-1"}}
    cols = []
    for c, faults in plant.items():
        whens = " ".join(f"WHEN {k} = {r} THEN " + ("CASE WHEN es_gratis THEN 0 END" if v is None else v)
                         for r, v in faults.items())
        cols.append(f"CASE {whens} ELSE {c} END AS {c}")
    return f"""
clean AS (SELECT * FROM snapshots),
planted AS (SELECT {', '.join(cols)}, run, generos FROM clean)"""


def page_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_chart_ids"] = """
WITH p AS (SELECT s_suppkey AS k, s_suppkey % 5 AS session_id, s_suppkey // 5 + 1 AS page FROM supplier),
stop AS (SELECT session_id, min(page) FILTER (WHERE k % 37 = 36) AS stop FROM p GROUP BY session_id),
r AS (SELECT p.* FROM p JOIN stop USING (session_id) WHERE k % 37 <> 36 AND (stop IS NULL OR page <= stop))
SELECT CAST(session_id AS BIGINT) AS session_id, CAST(page AS INTEGER) AS page_idx, 0 AS pos, CAST(k AS BIGINT) AS appid FROM r
UNION ALL SELECT CAST(session_id AS BIGINT), CAST(page AS INTEGER), 1, CAST(k + 1 AS BIGINT) FROM r"""
    q["q_candidates_from_pages"] = with_(PAGES) + """
SELECT candidate_rank, CAST(appid AS BIGINT) AS appid, first_source, sources FROM cands"""
    item = _open_item()
    q["q_entries_from_pages"] = with_(PAGES, item) + """
SELECT f.appid, f.nombre, f.total_resenas, k.sources AS sources, CAST(t.rank AS INTEGER) AS chart_rank
FROM classified c JOIN flat f ON c.appid = f.key JOIN cands k ON k.appid = c.appid
LEFT JOIN (SELECT appid, max(rank) AS rank FROM top_list GROUP BY appid) t ON t.appid = c.appid
WHERE c.outcome = 'accepted'"""
    q["q_metadata_from_pages"] = with_(PAGES, item) + """
SELECT 'pages' AS perfil_activo, 30 AS store_pages,
       CASE WHEN (SELECT count(*) FROM part) > 50 THEN (SELECT count(*) FROM part) END AS total_reportado,
       (SELECT count(*) FROM page_tagged WHERE prio = 0) AS store_ids_unicos,
       (SELECT count(*) FROM page_tagged WHERE prio = 1) AS charts_ids_unicos,
       (SELECT count(*) FROM page_tagged WHERE prio = 2) AS top_list_ids_unicos,
       (SELECT count(*) FROM cands) AS candidatos_unicos_combinados, count(*) AS evaluados,
       count(*) FILTER (WHERE outcome = 'accepted') AS total_resultados FROM classified"""
    for name in ("candidates", "entries", "metadata"):
        q[f"q_{name}_from_sessions"] = q[f"q_{name}_from_pages"].replace(PAGES, SESSIONS)
    parts = """
cands AS (SELECT p_partkey AS candidate_rank, p_partkey AS appid FROM part)"""
    q["q_funnel_all"] = with_(parts, item) + """
SELECT outcome, count(*) AS n FROM classified GROUP BY outcome
UNION ALL SELECT 'evaluados', count(*) FROM classified"""
    q["q_ranked_list_whole"] = """
SELECT l_orderkey AS list_id, 2 * count(*) AS ids, 2 AS last_rank FROM lineitem GROUP BY l_orderkey"""
    for name, rules in (("q_dq_outcomes_all", SILVER_RULES), ("q_readme_rules_all", README_RULES)):
        q[name] = with_(SNAPSHOTS, _faulty()) + _outcomes(rules).replace("FROM snapshots)", "FROM planted)")
    failed = " + ".join(f"CAST(({f}) AS INTEGER)" for _, f in SILVER_RULES)
    q["q_dq_audit"] = with_(SNAPSHOTS, _faulty()) + f""",
f AS (SELECT run, {failed} AS failed, len(string_split(generos, ' | ')) AS genres FROM planted)
SELECT run, CASE WHEN failed = 0 THEN 'Passed' ELSE 'Failed' END AS outcome, count(*) AS "rows",
       CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(genres) AS BIGINT) AS genres
FROM f GROUP BY 1, 2"""
    q["q_price_forms"] = """
SELECT p_partkey AS appid, CAST(CASE p_partkey % 8
         WHEN 0 THEN floor(p_retailprice) WHEN 1 THEN floor(p_retailprice) WHEN 3 THEN -p_retailprice
         WHEN 4 THEN -p_retailprice WHEN 6 THEN CAST('1' || substr(printf('%.2f', p_retailprice), 1, 6) AS DOUBLE)
         ELSE p_retailprice END AS DECIMAL(10,2)) AS precio FROM part"""
    return q


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_hgs_score"] = with_(CATALOG, scored("catalog", "g")) + f"\nSELECT {SCORE_COLS} FROM g"
    q["q_hgs_topk"] = with_(CATALOG, scored("catalog", "g")) + """
SELECT appid, nombre, generos, hidden_gem_score, tier,
       row_number() OVER (ORDER BY hidden_gem_score DESC NULLS LAST, appid) AS gem_rank
FROM g ORDER BY hidden_gem_score DESC NULLS LAST, appid LIMIT 20"""
    q["q_hgs_ranked"] = with_(CATALOG, scored("catalog", "g")) + """
SELECT appid, hidden_gem_score, tier,
       row_number() OVER (ORDER BY hidden_gem_score DESC NULLS LAST, appid) AS gem_rank FROM g"""
    q["q_tier_distribution"] = with_(CATALOG, scored("catalog", "g")) + f"""
SELECT tier, count(*) AS items, min(hidden_gem_score) AS min_score,
       max(hidden_gem_score) AS max_score, {r4('avg(hidden_gem_score)')} AS avg_score
FROM g GROUP BY tier"""
    q["q_genre_concentration"] = with_(CATALOG, scored("catalog", "g")) + f""",
e AS (SELECT unnest(string_split(generos, ' | ')) AS genero, tier, hidden_gem_score FROM g)
SELECT genero, count(*) AS items, count(*) FILTER (WHERE tier IN ('S', 'A')) AS gems,
       {r4("CAST(count(*) FILTER (WHERE tier IN ('S', 'A')) AS DOUBLE) / count(*)")} AS gem_share,
       {r4('avg(hidden_gem_score)')} AS avg_score
FROM e WHERE genero <> '' GROUP BY genero"""
    q["q_rank_within_genre"] = with_(CATALOG, scored("catalog", "g")) + """,
e AS (SELECT unnest(string_split(generos, ' | ')) AS genero, appid, nombre, hidden_gem_score, tier
      FROM g),
r AS (SELECT *, rank() OVER (PARTITION BY genero ORDER BY hidden_gem_score DESC NULLS LAST)
             AS group_rank FROM e WHERE genero <> '')
SELECT genero, appid, nombre, hidden_gem_score, tier, group_rank FROM r WHERE group_rank <= 3"""
    hist = with_(SNAPSHOTS, scored("snapshots", "h", by="run")) + f""",
c AS (SELECT appid, run, hidden_gem_score,
             lag(hidden_gem_score) OVER (PARTITION BY appid ORDER BY run) AS prev_score
      FROM h),
d AS (SELECT *, {r4('hidden_gem_score - prev_score')} AS score_delta FROM c),
b AS (SELECT *, coalesce(score_delta > 0, false) AS is_rising,
             sum(CASE WHEN coalesce(score_delta > 0, false) THEN 0 ELSE 1 END)
               OVER (PARTITION BY appid ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS brk
      FROM d),
s AS (SELECT *, CASE WHEN is_rising
                     THEN row_number() OVER (PARTITION BY appid, brk ORDER BY run) - 1
                     ELSE 0 END AS rise_streak
      FROM b)"""
    q["q_rising"] = hist + """
SELECT appid, run, prev_score, hidden_gem_score, score_delta, rise_streak FROM s WHERE score_delta > 0"""
    q["q_rising_incremental"] = q["q_rising"]
    q["q_latest_snapshot"] = with_(SNAPSHOTS) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY run DESC) AS rn FROM snapshots)
SELECT appid, run, nombre, total_resenas, resenas_positivas, puntuacion FROM r WHERE rn = 1"""
    q.update(extract_oracles())
    q.update(scalar_oracles())
    q.update(quality_oracles())
    q.update(job_oracles())
    q.update(page_oracles())
    return q


# ---------------------------------------------------------------------------
# extract stage: candidates, funnel, payload flattening, landed pages
# ---------------------------------------------------------------------------

CANDIDATES = """
per_part AS (
  SELECT l_partkey AS appid, count(*) AS lines, sum(l_quantity) AS qty,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returns
  FROM lineitem GROUP BY l_partkey
),
s0 AS (SELECT appid, row_number() OVER (ORDER BY lines DESC, appid) AS pos FROM per_part
       ORDER BY lines DESC, appid LIMIT 300),
s1 AS (SELECT appid, row_number() OVER (ORDER BY qty DESC, appid) AS pos FROM per_part
       ORDER BY qty DESC, appid LIMIT 300),
s2 AS (SELECT appid, row_number() OVER (ORDER BY returns DESC, appid) AS pos FROM per_part
       ORDER BY returns DESC, appid LIMIT 100),
tagged AS (
  SELECT appid, pos, 0 AS prio, 'top_lines' AS source FROM s0
  UNION ALL SELECT appid, pos, 1, 'top_quantity' FROM s1
  UNION ALL SELECT appid, pos, 2, 'top_returns' FROM s2
),
merged AS (
  SELECT appid, min(prio * 1000000 + pos) AS k,
         array_to_string(list_sort(list_distinct(list(source))), ',') AS sources
  FROM tagged GROUP BY appid
),
cands AS (
  SELECT row_number() OVER (ORDER BY k, appid) AS candidate_rank, appid,
         CASE k // 1000000 WHEN 0 THEN 'top_lines' WHEN 1 THEN 'top_quantity' ELSE 'top_returns' END
           AS first_source,
         CAST(k % 1000000 AS BIGINT) AS first_pos, sources
  FROM merged ORDER BY k, appid LIMIT 400
)"""

ITEM = """
item AS (
  SELECT p.*, coalesce(s.total_resenas, 0) AS tot, coalesce(s.resenas_positivas, 0) AS pos,
         coalesce(s.resenas_negativas, 0) AS neg, coalesce(s.open_lines, 0) AS open_lines
  FROM part p LEFT JOIN (
    SELECT l_partkey, count(*) AS total_resenas,
           count(*) FILTER (WHERE l_returnflag <> 'R') AS resenas_positivas,
           count(*) FILTER (WHERE l_returnflag = 'R') AS resenas_negativas,
           count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines
    FROM lineitem GROUP BY l_partkey) s ON p.p_partkey = s.l_partkey
),
flat AS (
  SELECT p_partkey AS key, CAST(p_partkey AS INTEGER) AS appid,
         CASE WHEN p_partkey % 101 = 5 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0
              THEN 'App ' || CAST(p_partkey AS VARCHAR) ELSE p_name END AS nombre,
         CAST(CASE WHEN open_lines > 0 THEN open_lines END AS INTEGER) AS jugadores_actuales_api,
         CASE WHEN has_data THEN p_brand ELSE '' END AS desarrolladores,
         CASE WHEN has_data THEN p_brand ELSE '' END AS editores,
         CASE WHEN has_data THEN p_type || ' | ' || split_part(p_name, ' ', 1) ELSE '' END AS generos,
         CASE WHEN has_data THEN '1 Jan, ' || CAST(1990 + p_size % 10 AS VARCHAR) END AS fecha_lanzamiento,
         CASE WHEN NOT has_data OR p_partkey % 97 = 3 THEN NULL
              ELSE """ + price_text("p_retailprice", "p_partkey") + """ END AS precio,
         CASE WHEN has_data AND p_size % 10 <> 0 THEN CAST(p_size * 3 - 20 AS INTEGER) END AS metacritic_score,
         CASE WHEN has_data AND p_size % 10 <> 0
              THEN 'https://example.org/item/' || CAST(p_partkey AS VARCHAR) END AS metacritic_url,
         CASE WHEN has_data THEN 'Size ' || CAST(p_size AS VARCHAR) ELSE '' END AS descripcion_corta,
         CASE WHEN rev_ok THEN CAST(tot AS INTEGER) END AS total_resenas,
         CASE WHEN rev_ok THEN CAST(pos AS INTEGER) END AS resenas_positivas,
         CASE WHEN rev_ok THEN CAST(neg AS INTEGER) END AS resenas_negativas,
         CASE WHEN rev_ok THEN CAST(floor(CAST(10 AS DOUBLE) * pos / nullif(tot, 0)) AS INTEGER) END
           AS puntuacion,
         CASE WHEN NOT rev_ok THEN NULL
              WHEN pos / nullif(tot, 0) >= 0.8
                THEN CASE WHEN p_size % 2 = 0 THEN 'Extremadamente positivas' ELSE ' OVERWHELMINGLY Positive ' END
              WHEN pos / nullif(tot, 0) >= 0.7
                THEN CASE WHEN p_size % 2 = 0 THEN 'Muy positivas' ELSE 'Very Positive' END
              ELSE 'Mixed' END AS descripcion_puntuacion,
         CASE WHEN has_data THEN p_partkey % 97 = 3 END AS es_gratis,
         p_partkey % 101 <> 5 AS details_ok, has_data AND p_type <> 'PROMO' AS is_game, rev_ok,
         open_lines
  FROM (SELECT *, p_partkey % 101 <> 5 AND p_partkey % 13 <> 0 AS has_data,
               p_partkey % 103 <> 9 AS rev_ok FROM item)
),
classified AS (
  SELECT c.candidate_rank, c.appid,
         CASE WHEN f.key IS NULL OR NOT f.details_ok THEN 'error_detalles'
              WHEN NOT f.is_game THEN 'descartado_no_juego'
              WHEN NOT f.rev_ok THEN 'error_resenas'
              WHEN f.descripcion_puntuacion IN ('Mixed') THEN 'descartado_label'
              WHEN coalesce(f.puntuacion < 8, true) THEN 'descartado_puntaje'
              WHEN NOT (coalesce(f.total_resenas, 0) BETWEEN 20 AND 45) THEN 'descartado_cantidad_resenas'
              WHEN f.open_lines > 18 THEN 'descartado_jugadores_actuales'
              ELSE 'accepted' END AS outcome
  FROM cands c LEFT JOIN flat f ON c.appid = f.key
),
walked AS (
  SELECT *, coalesce(sum(CASE WHEN outcome = 'accepted' THEN 1 ELSE 0 END)
                       OVER (ORDER BY candidate_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS accepted_before
  FROM classified
),
evaluated AS (
  SELECT * FROM walked WHERE candidate_rank <= 300 AND accepted_before < 3
)"""

FLAT_COLS = ("appid, nombre, jugadores_actuales_api, desarrolladores, editores, generos, "
             "fecha_lanzamiento, precio, metacritic_score, metacritic_url, descripcion_corta, "
             "total_resenas, resenas_positivas, resenas_negativas, puntuacion, descripcion_puntuacion, es_gratis")

SEARCH = """
pages AS (
  SELECT l_orderkey AS session_id, CAST(l_linenumber AS INTEGER) AS page_idx, l_partkey, l_suppkey,
         l_returnflag = 'N' AND l_linestatus = 'O' AS empty,
         CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS total
  FROM lineitem
),
stops AS (SELECT session_id, min(CASE WHEN empty THEN page_idx END) AS stop FROM pages GROUP BY session_id),
kept AS (SELECT p.* FROM pages p JOIN stops s USING (session_id) WHERE s.stop IS NULL OR p.page_idx <= s.stop),
ids AS (
  SELECT session_id, page_idx, 0 AS pos, l_partkey AS appid FROM kept WHERE NOT empty
  UNION ALL SELECT session_id, page_idx, 1, l_suppkey FROM kept WHERE NOT empty
  UNION ALL SELECT session_id, page_idx, 2, l_partkey FROM kept WHERE NOT empty
),
firsts AS (SELECT session_id, appid, min(page_idx * 10 + pos) AS k FROM ids GROUP BY session_id, appid),
totals AS (
  SELECT session_id, min(total) FILTER (WHERE page_idx = first_page) AS reported_total
  FROM (SELECT *, min(page_idx) OVER (PARTITION BY session_id) AS first_page FROM kept WHERE total <> 0)
  GROUP BY session_id
)"""


def extract_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_candidates"] = with_(CANDIDATES) + """
SELECT candidate_rank, appid, first_source, first_pos, sources FROM cands"""
    q["q_candidates_whole"] = """
WITH per_part AS (
  SELECT l_partkey AS appid, count(*) AS lines, sum(l_quantity) AS qty,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returns
  FROM lineitem GROUP BY l_partkey
),
ranks AS (
  SELECT appid, row_number() OVER (ORDER BY lines DESC, appid) AS by_lines,
         row_number() OVER (ORDER BY qty DESC, appid) AS by_quantity,
         row_number() OVER (ORDER BY returns DESC, appid) AS by_returns FROM per_part
)
SELECT by_lines AS candidate_rank, appid, 'top_lines' AS first_source, by_lines AS first_pos,
       'top_lines,top_quantity' || CASE WHEN by_returns <= 1500 THEN ',top_returns' ELSE '' END AS sources
FROM ranks"""
    q["q_funnel_rows"] = with_(CANDIDATES, ITEM) + """
SELECT candidate_rank, appid, outcome FROM evaluated"""
    q["q_funnel_stats"] = with_(CANDIDATES, ITEM) + """
SELECT outcome, count(*) AS n FROM evaluated GROUP BY outcome
UNION ALL SELECT 'evaluados', count(*) FROM evaluated"""
    q["q_funnel_entries"] = with_(CANDIDATES, ITEM) + f"""
SELECT {', '.join('f.' + c.strip() for c in FLAT_COLS.split(','))}
FROM evaluated e JOIN flat f ON e.appid = f.key WHERE e.outcome = 'accepted'"""
    q["q_flatten_payload"] = with_(ITEM.split("classified AS")[0].rstrip().rstrip(",")) + f"""
SELECT {FLAT_COLS} FROM flat"""
    q["q_ranked_list"] = """
WITH e AS (
  SELECT l_partkey AS appid, l_orderkey AS list_id, CAST(l_linenumber AS INTEGER) AS list_page,
         0 AS pos, 1 AS rank FROM lineitem
  UNION ALL
  SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS INTEGER), 1, 2 FROM lineitem
),
r AS (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY list_id DESC, list_page DESC, pos DESC)
             AS rn FROM e)
SELECT appid, list_id, list_page, rank FROM r WHERE rn = 1"""
    q["q_search_pages"] = with_(SEARCH) + """
SELECT f.session_id, f.appid, CAST(f.k // 10 AS INTEGER) AS first_page, CAST(f.k % 10 AS INTEGER) AS first_pos,
       t.reported_total
FROM firsts f LEFT JOIN totals t USING (session_id)"""
    q["q_search_totals"] = with_(SEARCH) + """
SELECT session_id, reported_total FROM totals
UNION ALL SELECT -1 - n_nationkey, n_nationkey + 5 FROM nation"""
    q["q_html_ids"] = """
WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                  regexp_extract_all(html, 'href="/([^"]+)"', 1) AS links FROM pages),
s AS (SELECT host, min(CASE WHEN len(links) = 0 THEN page_id END) AS stop FROM l GROUP BY host),
k AS (SELECT l.* FROM l JOIN s USING (host) WHERE s.stop IS NULL OR l.page_id <= s.stop),
x AS (SELECT page_id, unnest(links) AS link, unnest(range(len(links))) AS pos FROM k)
SELECT page_id, CAST(pos AS INTEGER) AS pos, link FROM x"""
    return q


def scalar_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_parse_price"] = """
SELECT p_partkey AS appid, p_partkey % 6 AS price_style,
       CASE WHEN p_partkey % 97 = 3 THEN CASE WHEN p_partkey % 2 = 0 THEN CAST(0 AS DECIMAL(10,2)) END
            WHEN p_partkey % 6 IN (0, 1, 5) THEN CAST(p_retailprice AS DECIMAL(10,2))
            WHEN p_partkey % 6 IN (2, 3) THEN CAST(p_retailprice * 10 AS DECIMAL(10,2))
            ELSE CAST(round(p_retailprice * 10) AS DECIMAL(10,2)) END AS precio
FROM part"""
    q["q_normalize_text"] = """
WITH n AS (SELECT doc_id, text, trim(strip_accents(lower(coalesce(text, '')))) AS norm FROM documents)
SELECT doc_id, md5(norm) AS norm_md5, CAST(strlen(norm) AS INTEGER) AS norm_bytes,
       norm IN ('extremadamente positivas', 'overwhelmingly positive', 'muy positivas', 'very positive')
         AS is_label
FROM n"""
    # Python int() semantics for text: optional sign and digits, surrounding whitespace.
    q["q_safe_int"] = """
WITH k AS (SELECT event_id, json_extract_string(props, '$.k') AS s FROM events),
v AS (SELECT event_id, s, ' ' || s || ' ' AS padded, s || '.5' AS fraction, 'x' || s AS junk FROM k)
SELECT event_id,
       CASE WHEN regexp_full_match(trim(s), '[+-]?[0-9]+') THEN CAST(trim(s) AS BIGINT) END AS v_plain,
       CASE WHEN regexp_full_match(trim(padded), '[+-]?[0-9]+') THEN CAST(trim(padded) AS BIGINT) END
         AS v_padded,
       CASE WHEN regexp_full_match(trim(fraction), '[+-]?[0-9]+') THEN CAST(trim(fraction) AS BIGINT) END
         AS v_fraction,
       CASE WHEN regexp_full_match(trim(junk), '[+-]?[0-9]+') THEN CAST(trim(junk) AS BIGINT) END AS v_junk
FROM v"""
    q["q_slug"] = """
WITH t AS (SELECT p_partkey,
                  CASE WHEN p_partkey % 89 = 0 THEN '!!! ?'
                       ELSE p_name || '! #' || p_brand || ' (v' || CAST(p_size AS VARCHAR) || ')' END AS txt
           FROM part)
SELECT p_partkey AS appid,
       coalesce(nullif(replace(trim(regexp_replace(txt, '[^\\p{L}\\p{N} _-]', '', 'g')), ' ', '_'), ''),
                'sin_nombre') AS slug
FROM t"""
    q["q_apply_mapping"] = """
SELECT TRY_CAST(o_orderkey AS BIGINT) AS order_id, TRY_CAST(o_custkey AS INTEGER) AS customer_id,
       TRY_CAST(o_orderstatus AS VARCHAR) AS status, TRY_CAST(o_totalprice AS DOUBLE) AS total_price,
       TRY_CAST(o_orderdate AS DATE) AS order_date, TRY_CAST(o_orderpriority AS INTEGER) AS priority_level
FROM orders"""
    return q


# ---------------------------------------------------------------------------
# data quality and upsert (fixed values: the names of rules, outcomes and columns)
# ---------------------------------------------------------------------------

SILVER_RULES = [
    ('IsComplete "nombre"', "nombre IS NULL"),
    ('IsComplete "appid"', "appid IS NULL"),
    ('IsComplete "precio"', "precio IS NULL"),
    ('IsComplete "total_resenas"', "total_resenas IS NULL"),
    ('IsComplete "resenas_positivas"', "resenas_positivas IS NULL"),
    ('IsComplete "resenas_negativas"', "resenas_negativas IS NULL"),
    ('IsComplete "puntuacion"', "puntuacion IS NULL"),
    ('ColumnValues "metacritic_score" between 0 and 100',
     "coalesce(NOT (metacritic_score BETWEEN 0 AND 100), false)"),
    ('ColumnValues "puntuacion" between 0 and 100', "coalesce(NOT (puntuacion BETWEEN 0 AND 100), false)"),
    ('ColumnValues "jugadores_actuales_api" >= 0', "coalesce(jugadores_actuales_api < 0, false)"),
    ('ColumnValues "resenas_positivas" >= 0', "coalesce(resenas_positivas < 0, false)"),
    ('ColumnValues "resenas_negativas" >= 0', "coalesce(resenas_negativas < 0, false)"),
    ('ColumnValues "total_resenas" >= 10', "coalesce(total_resenas < 10, false)"),
]
README_RULES = [
    ("positive <= total", "coalesce(NOT (resenas_positivas <= total_resenas), false)"),
    ("price >= 0", "coalesce(NOT (precio >= 0), false)"),
    ("positive pct between 0 and 100",
     "coalesce(NOT (100.0 * resenas_positivas / nullif(total_resenas, 0) BETWEEN 0 AND 100), false)"),
    ("total > 0", "coalesce(NOT (total_resenas > 0), true)"),
]


def _outcomes(rules: list[tuple[str, str]]) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {f}) AS f{i}" for i, (_, f) in enumerate(rules))
    rows = "\nUNION ALL ".join(
        f"SELECT {i} AS rule_idx, '{n}' AS rule, evaluated, f{i} AS failed, "
        f"{r4(f'CAST(evaluated - f{i} AS DOUBLE) / nullif(evaluated, 0)')} AS pass_ratio, "
        f"CASE WHEN f{i} = 0 THEN 'Passed' ELSE 'Failed' END AS outcome FROM a"
        for i, (n, _) in enumerate(rules))
    return f""",
a AS (SELECT count(*) AS evaluated, {counts} FROM snapshots)
{rows}"""


def _gold_between(name: str, lo: int, hi: int) -> str:
    return f"""
{name}_src AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY run DESC) AS rn
                 FROM snapshots WHERE run BETWEEN {lo} AND {hi}) WHERE rn = 1
),""" + scored(f"{name}_src", name)


def quality_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_dq_outcomes"] = with_(SNAPSHOTS) + _outcomes(SILVER_RULES)
    q["q_readme_rules"] = with_(SNAPSHOTS) + _outcomes(README_RULES)
    names = ", ".join(f"CASE WHEN {f} THEN '{n}' END" for n, f in SILVER_RULES)
    anyf = " OR ".join(f"({f})" for _, f in SILVER_RULES)
    q["q_dq_rejected"] = with_(SNAPSHOTS) + f"""
SELECT appid, run, concat_ws(', ', {names}) AS failed_rules FROM snapshots WHERE {anyf}"""
    q["q_dq_passed"] = with_(SNAPSHOTS) + f"""
SELECT run, count(*) AS "rows" FROM snapshots WHERE NOT ({anyf}) GROUP BY run"""
    gold = with_(SNAPSHOTS, _gold_between("t", 0, 1999), _gold_between("u", 2000, 9999))
    for name, upd in (("q_upsert_all", {"nombre", "precio", "hidden_gem_score", "tier"}),
                      ("q_upsert_name_only", {"nombre"})):
        cols = []
        for c in ("nombre", "precio", "hidden_gem_score", "tier"):
            matched = f"u.{c}" if c in upd else f"t.{c}"
            cols.append(f"CASE WHEN u.appid IS NULL THEN t.{c} WHEN t.appid IS NULL THEN u.{c} "
                        f"ELSE {matched} END AS {c}")
        q[name] = gold + f"""
SELECT CAST(coalesce(t.appid, u.appid) AS BIGINT) AS appid, {', '.join(cols)}
FROM t FULL OUTER JOIN u ON t.appid = u.appid"""
    return q


# ---------------------------------------------------------------------------
# jobs over landed files
# ---------------------------------------------------------------------------

def _passed() -> str:
    anyf = " OR ".join(f"({f})" for _, f in SILVER_RULES)
    return f"""
passed AS (
  SELECT *, precio_text AS precio_raw, CAST(run AS VARCHAR) || '-01-01_00-00-00' AS run_folder
  FROM snapshots WHERE NOT ({anyf})
),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY run DESC) AS rn FROM passed)
  WHERE rn = 1
),""" + scored("latest", "g")


BRONZE_COLS = ("appid, nombre, jugadores_actuales_api, desarrolladores, editores, generos, "
               "fecha_lanzamiento, precio_text AS precio, metacritic_score, metacritic_url, "
               "descripcion_corta, total_resenas, resenas_positivas, resenas_negativas, puntuacion, "
               "descripcion_puntuacion, es_gratis")


def job_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["q_parquet_roundtrip"] = with_(CATALOG) + """
SELECT appid, nombre, generos, precio, total_resenas, resenas_positivas, resenas_negativas, puntuacion
FROM catalog"""
    q["q_bronze_roundtrip"] = with_(SNAPSHOTS) + f"""
SELECT {BRONZE_COLS}, CAST(run AS VARCHAR) || '-01-01_00-00-00' AS run_folder FROM snapshots"""
    q["q_bronze_to_silver"] = with_(SNAPSHOTS, _passed()) + """
SELECT appid, run_folder, nombre, precio, precio_raw, total_resenas, resenas_positivas, puntuacion
FROM passed"""
    counts = ", ".join(f"count(*) FILTER (WHERE {f}) AS f{i}" for i, (_, f) in enumerate(SILVER_RULES))
    rows = "\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, evaluated, f{i} AS failed, "
        f"CASE WHEN f{i} = 0 THEN 'Passed' ELSE 'Failed' END AS outcome FROM a"
        for i, (n, _) in enumerate(SILVER_RULES))
    q["q_silver_observed"] = with_(SNAPSHOTS) + f""",
a AS (SELECT count(*) AS evaluated, {counts} FROM snapshots)
{rows}"""
    q["q_gold_publish"] = with_(SNAPSHOTS, _passed()) + """
SELECT CAST(appid AS BIGINT) AS appid, nombre, generos, CAST(precio AS DECIMAL(8,2)) AS precio,
       puntuacion, total_resenas, resenas_positivas,
       CAST(hidden_gem_score AS DECIMAL(5,4)) AS hidden_gem_score, tier
FROM g"""
    q["q_stream_incremental"] = with_(SNAPSHOTS, _passed()) + """
SELECT CAST(appid AS BIGINT) AS appid, nombre, precio, total_resenas, hidden_gem_score, tier FROM g"""
    q["q_score_history"] = with_(SNAPSHOTS, scored("snapshots", "h", by="run")) + """
SELECT CAST(appid AS BIGINT) AS appid, make_date(run, 1, 1) AS run_date, hidden_gem_score, tier FROM h"""
    q["q_gold_upsert_table"] = quality_oracles()["q_upsert_name_only"]
    q["q_table_reopened"] = quality_oracles()["q_upsert_all"]
    waves = ("run <= 1995", "run >= 1997", "run = 1996")
    upto = [" OR ".join(waves[:i + 1]) for i in range(3)]
    latest = ",".join(f"""
l{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY run DESC) AS place
                        FROM passed WHERE {upto[i]}) WHERE place = 1),
m{i} AS (SELECT count(*) AS items, greatest(coalesce(max(total_resenas), 1), 1) AS maximum FROM l{i}),
a{i} AS (SELECT count(DISTINCT appid) AS arrived FROM passed WHERE {waves[i]})""" for i in range(3))
    q["q_gold_waves"] = with_(SNAPSHOTS, _passed(), latest) + "UNION ALL".join(f"""
SELECT CAST({i} AS INTEGER) AS wave, arrived, m{i}.items, CAST(m{i}.maximum AS INTEGER) AS maximum,
       {f'arrived > 0 AND m{i}.maximum <> m{i - 1}.maximum' if i else 'false'} AS rescored
FROM m{i}, a{i}{f', m{i - 1}' if i else ''}
""" for i in range(3))
    anyf = " OR ".join(f"({f})" for _, f in SILVER_RULES)
    columns = 16 + 5  # mapped columns, free flag, raw price, run and file, and the malformed line
    share = f"CAST(count(*) FILTER (WHERE NOT ({anyf})) AS DOUBLE) / nullif(count(*), 0)"
    passed = f"count(*) FILTER (WHERE NOT ({anyf}))"

    def whole(n: str, value: str, holds: str, src: str) -> str:
        return (f"SELECT '{n}' AS rule, CAST({value} AS DOUBLE) AS value, count(*) AS evaluated, "
                f"CASE WHEN {holds} THEN 'Passed' ELSE 'Failed' END AS outcome FROM {src}")

    def wholes(src: str) -> str:
        return "\nUNION ALL ".join((whole("ColumnCount > 0", str(columns), "true", src),
                                    whole("RowCount >= 1", passed, f"{passed} >= 1", src),
                                    whole("PassShare >= 0.999", share, f"coalesce({share} >= 0.999, true)", src)))

    q["q_table_rules"] = with_(SNAPSHOTS) + f"""
SELECT rule, value, outcome FROM ({wholes("snapshots")})"""
    parts = []
    for run, cond in (("early", "run <= 1996"), ("late", "run >= 1997"), ("stream", "true")):
        src = f"(SELECT * FROM snapshots WHERE {cond})"
        parts += [f"SELECT '{run}' AS run, 'row' AS scope, '{n}' AS rule, count(*) AS evaluated, "
                  f"count(*) FILTER (WHERE {f}) AS failed, CASE WHEN count(*) FILTER (WHERE {f}) = 0 THEN 'Passed' "
                  f"ELSE 'Failed' END AS outcome FROM {src}" for n, f in SILVER_RULES]
        if run != "stream":
            parts.append(f"SELECT '{run}' AS run, 'table' AS scope, rule, evaluated, CAST(outcome = 'Failed' AS BIGINT) "
                         f"AS failed, outcome FROM ({wholes(src)})")
    q["q_dq_history"] = with_(SNAPSHOTS) + "\n" + "\nUNION ALL ".join(parts)
    q["q_run_metadata"] = with_(CANDIDATES, ITEM) + """
SELECT (SELECT count(*) FROM s0) AS top_lines_ids_unicos,
       (SELECT count(*) FROM s1) AS top_quantity_ids_unicos,
       (SELECT count(*) FROM s2) AS top_returns_ids_unicos,
       (SELECT count(*) FROM cands) AS candidatos_unicos_combinados,
       count(*) AS evaluados,
       count(*) FILTER (WHERE outcome = 'error_detalles') AS error_detalles,
       count(*) FILTER (WHERE outcome = 'descartado_no_juego') AS descartado_no_juego,
       count(*) FILTER (WHERE outcome = 'error_resenas') AS error_resenas,
       count(*) FILTER (WHERE outcome = 'descartado_label') AS descartado_label,
       count(*) FILTER (WHERE outcome = 'descartado_puntaje') AS descartado_puntaje,
       count(*) FILTER (WHERE outcome = 'descartado_cantidad_resenas') AS descartado_cantidad_resenas,
       count(*) FILTER (WHERE outcome = 'descartado_jugadores_actuales') AS descartado_jugadores_actuales,
       count(*) FILTER (WHERE outcome = 'accepted') AS total_resultados
FROM evaluated"""
    return q
