"""DuckDB oracle: for each catalogue key, SQL over the driver's tables that
must give the same rows, column names and types as the Spark builder.

DuckDB differences handled here: ``epoch_ms`` rounds (use ``epoch_us // 1000``);
``CAST(2.7 AS INT)`` rounds (use ``trunc``/``floor`` first); ``ceil`` returns
DOUBLE; ``regexp_replace`` replaces the first hit only; ``list_position``
returns NULL when absent; NULLS ordering is spelled out.
"""

# The timeline view over events (see fixture_views) and the six per-player
# tables derived from it, restricted to long-enough matches.
_TL = """
tl AS (
  SELECT strftime(ts, '%Y-%m-%d') AS match_id, user_id AS puuid,
         (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS off,
         event_id, event_type, value,
         CAST(props->>'k' AS INTEGER) AS k,
         CAST(user_id % 10 + 1 AS INTEGER) AS pos
  FROM events),
mstats AS (
  SELECT match_id, max(off) AS duration,
         CASE WHEN first(k ORDER BY off DESC, event_id DESC) % 2 = 0 THEN 100 ELSE 200 END
           AS winning_team
  FROM tl GROUP BY match_id),
longm AS (SELECT match_id, duration, winning_team FROM mstats WHERE duration >= 36000000),
t AS (SELECT * FROM tl WHERE match_id IN (SELECT match_id FROM longm)),
kills AS (SELECT match_id, puuid, count(*) AS no_kills FROM t
          WHERE event_type = 'purchase' AND off < 36006000 GROUP BY match_id, puuid),
deaths AS (SELECT match_id, puuid, count(*) AS no_deaths FROM t
           WHERE event_type = 'error' AND off < 36006000 GROUP BY match_id, puuid),
wards AS (SELECT match_id, puuid, count(*) AS ward_count FROM t
          WHERE (event_type = 'click' OR (event_type = 'view' AND k < 50)) AND off < 36006000
          GROUP BY match_id, puuid),
champ AS (SELECT match_id, puuid, k AS champion_id FROM (
            SELECT *, row_number() OVER (PARTITION BY match_id, puuid
                                         ORDER BY off, event_id) AS rn FROM t) WHERE rn = 1),
scores AS (SELECT match_id, puuid, k AS gold_at_10,
                  CAST(floor(value) AS INTEGER) AS minions_at_10,
                  CAST(off // 1000 AS INTEGER) AS xp_at_10 FROM (
             SELECT *, row_number() OVER (PARTITION BY match_id, puuid
                                          ORDER BY off, event_id) AS rn
             FROM t WHERE off >= 36000000) WHERE rn = 1),
outcomes AS (
  SELECT p.match_id, p.puuid,
         if((p.pos <= 5) = (m.winning_team = 100), 'win', 'loss') AS outcome
  FROM (SELECT match_id, puuid, max(pos) AS pos FROM tl GROUP BY match_id, puuid) p
  JOIN longm m USING (match_id)),
keys AS (
  SELECT match_id, puuid FROM champ UNION SELECT match_id, puuid FROM kills
  UNION SELECT match_id, puuid FROM deaths UNION SELECT match_id, puuid FROM scores
  UNION SELECT match_id, puuid FROM wards UNION SELECT match_id, puuid FROM outcomes)
"""

_PERF_SELECT = """
SELECT k.match_id, k.puuid,
       CAST(coalesce(c.champion_id, 0) AS INTEGER) AS champion_id,
       CAST(coalesce(ki.no_kills, 0) AS INTEGER) AS no_kills,
       CAST(coalesce(d.no_deaths, 0) AS INTEGER) AS no_deaths,
       CAST(coalesce(s.gold_at_10, 0) AS INTEGER) AS gold_at_10,
       CAST(coalesce(s.minions_at_10, 0) AS INTEGER) AS minions_at_10,
       CAST(coalesce(s.xp_at_10, 0) AS INTEGER) AS xp_at_10,
       CAST(coalesce(w.ward_count, 0) AS INTEGER) AS ward_count,
       CAST(coalesce(CASE o.outcome WHEN 'loss' THEN 0 WHEN 'win' THEN 1 END, 0) AS INTEGER)
         AS outcome_id
FROM keys k
LEFT JOIN champ c USING (match_id, puuid)
LEFT JOIN kills ki USING (match_id, puuid)
LEFT JOIN deaths d USING (match_id, puuid)
LEFT JOIN scores s USING (match_id, puuid)
LEFT JOIN wards w USING (match_id, puuid)
LEFT JOIN outcomes o USING (match_id, puuid)
"""
_PERFORMANCE = "WITH " + _TL + _PERF_SELECT

_ROSTER = """
SELECT c_custkey AS "DT_RowId", c_name AS plug, c_nationkey AS "roleNum", n_name AS role,
       c_mktsegment AS "rankHigh", c_acctbal AS "onlineNum"
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'EUROPE' AND c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2, 3, 4, 5)
"""

ORACLE_SQL = {
    "performance_table": _PERFORMANCE,
    "performance_union_agg": _PERFORMANCE,
    "performance_single_pass": _PERFORMANCE,
    "kill_death_single_pass": "WITH " + _TL + """
SELECT match_id, puuid,
       count(*) FILTER (WHERE event_type = 'purchase') AS no_kills,
       count(*) FILTER (WHERE event_type = 'error') AS no_deaths
FROM t WHERE event_type IN ('purchase', 'error') AND off < 36006000
GROUP BY match_id, puuid
""",
    "ward_counts": "WITH " + _TL + "SELECT * FROM wards",
    "nested_match_outcome": "WITH " + _TL + """
SELECT match_id, CAST(puuid AS VARCHAR) AS puuid, outcome FROM outcomes
""",
    "nested_chosen_champion": "WITH " + _TL + """
SELECT match_id, CAST(puuid AS VARCHAR) AS puuid, champion_id FROM champ
""",
    "nested_event_counts": "WITH " + _TL + """,
k AS (SELECT match_id, puuid FROM kills UNION SELECT match_id, puuid FROM deaths
      UNION SELECT match_id, puuid FROM wards)
SELECT k.match_id, CAST(k.puuid AS VARCHAR) AS puuid,
       coalesce(ki.no_kills, 0) AS no_kills, coalesce(d.no_deaths, 0) AS no_deaths,
       coalesce(w.ward_count, 0) AS ward_count
FROM k LEFT JOIN kills ki USING (match_id, puuid) LEFT JOIN deaths d USING (match_id, puuid)
LEFT JOIN wards w USING (match_id, puuid)
""",
    "snapshot_at_cutoff": "WITH " + _TL + "SELECT * FROM scores",
    "match_outcome": "WITH " + _TL + "SELECT * FROM outcomes",
    "duration_minutes": "WITH " + _TL + """
SELECT match_id, CAST(ceil(duration / 60000) AS INTEGER) AS duration FROM longm
""",
    "roster_filter": _ROSTER,
    "roster_online": _ROSTER + " AND c_acctbal > 0",
    "split_link": "SELECT page_id, string_split(url, '/')[-2] AS link FROM pages",
    "csv_all_string_cast": """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       CAST(trunc(l_extendedprice) AS INTEGER) AS price, l_returnflag
FROM lineitem
""",
    "select_rename_drop": """
SELECT s_name AS supplier_name, s_suppkey AS supplier_id, s_nationkey AS nation_id,
       s_acctbal AS balance FROM supplier
""",
    "outcome_encode": """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'F' THEN '1' END AS INTEGER)
  AS outcome_id FROM orders
""",
    "literal_outcome_dim": """
WITH dim(outcome_id, outcome_name) AS (VALUES (0, 'loss'), (1, 'win')),
enc AS (SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'F' THEN '1' END
                                AS INTEGER) AS outcome_id FROM orders)
SELECT o_orderkey, enc.outcome_id, CAST(dim.outcome_name AS VARCHAR) AS outcome_name
FROM enc LEFT JOIN dim ON enc.outcome_id = dim.outcome_id
""",
    "latest_match_per_player": """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""",
    "streamer_outer_join": """
WITH p1 AS (SELECT s_suppkey - 10 AS id, s_name AS plug, s_nationkey AS rolenum FROM supplier),
p2 AS (SELECT c_custkey AS id, c_name AS name, n_name AS birthplace
       FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT coalesce(p1.id, p2.id) AS streamer_id, p1.plug AS streamer_name,
       p2.name AS real_name, p2.birthplace AS birth_place, CAST(p1.rolenum AS INTEGER) AS role_id
FROM p1 FULL OUTER JOIN p2 ON p1.id = p2.id
""",
    "summoner_outer_join": """
WITH p1 AS (SELECT l_orderkey AS account_name, count(*) AS line_count
            FROM lineitem GROUP BY l_orderkey),
p2 AS (SELECT o_orderkey + 10 AS account_name, o_custkey AS streamer_id FROM orders)
SELECT coalesce(p1.account_name, p2.account_name) AS account_name, p1.line_count,
       p2.streamer_id
FROM p1 FULL OUTER JOIN p2 ON p1.account_name = p2.account_name
""",
    "ml_features": """
SELECT l_quantity, l_extendedprice, l_discount, l_tax, p_size AS attack,
       p_retailprice AS defense, CAST(length(p_type) AS INTEGER) AS magic
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""",
    "enrich_inner_lookup": """
SELECT d.doc_id, lang, source, n_chars, quality, toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""",
    "drop_any_null": """
SELECT d.doc_id, lang, source, n_chars, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL
  AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL
""",
    "first_wins_dedupe": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                 l_extendedprice NULLS FIRST, l_quantity NULLS FIRST, l_discount NULLS FIRST,
                 l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
      FROM lineitem) WHERE rn = 1
""",
    "append_if_absent": """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'target' ELSE 'batch' END AS src
FROM orders
""",
    "fk_orphans": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey IS NOT NULL
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)
""",
    "key_violations": """
SELECT 'duplicate' AS kind, l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'null_key', NULL, NULL, count(*) FROM lineitem
WHERE l_orderkey IS NULL OR l_linenumber IS NULL HAVING count(*) > 0
""",
    "surrogate_key": """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS serial_id, o_orderkey,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders
""",
    "json_props": """
SELECT CAST(props->>'k' AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1
""",
    "explode_nested": """
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS line_no
           FROM conversations)
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no,
       CAST(generate_subscripts(string_split(line, ' '), 1) AS INTEGER) AS word_no,
       unnest(string_split(line, ' ')) AS word
FROM l
""",
    "array_position_lookup": """
WITH s AS (SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
                  string_split(url, '/') AS parts FROM pages)
SELECT page_id, lang, CAST(coalesce(list_position(parts, lang), 0) AS INTEGER) AS lang_pos,
       CASE WHEN coalesce(list_position(parts, lang), 0) > 0
            THEN parts[list_position(parts, lang)] END AS segment
FROM s
""",
    "map_values_rows": """
SELECT p_partkey AS champion_id, p_name AS champion_name, p_size AS attack,
       CAST(floor(p_retailprice / 100) AS INTEGER) AS defense,
       CAST(length(p_name) AS INTEGER) AS magic
FROM part
""",
    "kv_pivot_dynamic": """
WITH s AS (SELECT page_id,
                  regexp_extract_all(html, '<(title|h1)>([^<]*)<', 1) AS ks,
                  regexp_extract_all(html, '<(title|h1)>([^<]*)<', 2) AS vs FROM pages)
SELECT page_id,
       CASE WHEN coalesce(list_position(ks, 'h1'), 0) > 0 THEN vs[list_position(ks, 'h1')] END
         AS h1,
       CASE WHEN coalesce(list_position(ks, 'title'), 0) > 0
            THEN vs[list_position(ks, 'title')] END AS title
FROM s
""",
    "union_missing_columns": """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""",
    "kv_pivot": """
WITH s AS (SELECT page_id,
                  regexp_extract_all(html, '<(title|h1)>([^<]*)<', 1) AS ks,
                  regexp_extract_all(html, '<(title|h1)>([^<]*)<', 2) AS vs FROM pages)
SELECT page_id,
       CASE WHEN coalesce(list_position(ks, 'h1'), 0) > 0 THEN vs[list_position(ks, 'h1')] END
         AS h1,
       CASE WHEN coalesce(list_position(ks, 'title'), 0) > 0
            THEN vs[list_position(ks, 'title')] END AS title
FROM s
""",
    "incremental_load": """
SELECT event_id, user_id, event_type, value, props, epoch_us(ts) AS ts_us FROM events
""",
    "star_load": "WITH " + _TL + ", perf AS (" + _PERF_SELECT + """)
SELECT row_number() OVER (ORDER BY match_id, summoner_id, champion_id, kills, deaths, gold,
                                   minions, xp, wards, outcome_id) AS performance_id,
       match_id, summoner_id, champion_id, kills, deaths, gold, minions, xp, wards, outcome_id
FROM (SELECT match_id, CAST(puuid AS VARCHAR) AS summoner_id,
             CAST(champion_id AS BIGINT) AS champion_id,
             no_kills AS kills, no_deaths AS deaths, gold_at_10 AS gold,
             minions_at_10 AS minions, xp_at_10 AS xp, ward_count AS wards, outcome_id
      FROM perf)
""",
}

from matchforge.plans.checked import checked_sql  # noqa: E402
from matchforge.plans.landed import LANDED_SQL  # noqa: E402

ORACLE_SQL |= LANDED_SQL | checked_sql(_TL, _PERF_SELECT)
