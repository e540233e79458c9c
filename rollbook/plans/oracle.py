"""DuckDB SQL for each registered query, written from the rules and not from the jobs."""

from __future__ import annotations

SITE_NAMES = "['www.xicidaili.com', 'www.ip3366.net', 'www.kuaidaili.com']"

LABEL = """CASE event_type WHEN 'signup' THEN '高匿' WHEN 'click' THEN '普匿名'
  WHEN 'view' THEN '普通代理IP' WHEN 'purchase' THEN '透明' ELSE 'x' END"""
CLASS = """CASE event_type WHEN 'signup' THEN 'A' WHEN 'click' THEN 'A'
  WHEN 'view' THEN 'C' WHEN 'purchase' THEN 'T' ELSE 'N' END"""
SEGMENT = """CASE c_mktsegment WHEN 'FURNITURE' THEN 'signup' WHEN 'HOUSEHOLD' THEN 'click'
  WHEN 'MACHINERY' THEN 'view' WHEN 'AUTOMOBILE' THEN 'purchase' ELSE 'error' END"""
SEGMENT_CLASS = """CASE c_mktsegment WHEN 'FURNITURE' THEN 'A' WHEN 'HOUSEHOLD' THEN 'A'
  WHEN 'MACHINERY' THEN 'C' WHEN 'AUTOMOBILE' THEN 'T' ELSE 'N' END"""
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

# Given pages: the navigation list by regular expression.
NAV = """nav AS (
  SELECT page_id, length(html) AS n_chars,
    regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'),
      '<li><a href="([^"]*)">(.*?)</a></li>', 2) AS texts,
    regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'),
      '<li><a href="([^"]*)">(.*?)</a></li>', 1) AS hrefs
  FROM pages)"""
NAV_ITEMS = NAV + """, items AS (
  SELECT page_id, len(texts) AS n, unnest(texts) AS text,
    generate_subscripts(texts, 1) - 1 AS pos FROM nav)"""

# Admission: the first page of a key, if the pool does not hold the key.
SIGHTINGS = f"""sightings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ip, event_type AS port, CAST(ts AS DATE) AS page,
    CASE WHEN event_type = 'click' THEN 'HTTP' ELSE 'HTTPS' END AS http, {CLASS} AS anonymous
  FROM events),
seeded AS (SELECT CAST(c_custkey AS VARCHAR) AS ip, {SEGMENT} AS port FROM customer)"""
FLAGGED = """flagged AS (
  SELECT s.*, s.page = min(s.page) OVER (PARTITION BY s.ip, s.port)
    AND NOT EXISTS (SELECT 1 FROM seeded p WHERE p.ip = s.ip AND p.port = s.port) AS is_new
  FROM sightings s)"""
BIG = """sightings AS (SELECT l_partkey AS ip, l_suppkey AS port, l_orderkey // 50 AS page FROM lineitem),
seeded AS (SELECT p_partkey AS ip, CAST(p_size AS BIGINT) AS port FROM part)"""

# Listing pages: 100 events each; a page with a broken row has no rows.
LISTING = f"""listing AS (
  SELECT event_id, event_id // 100 AS page, (event_id // 100) % 3 AS site,
    event_id - 100 * (event_id // 100) AS row_no,
    '10.0.' || (user_id // 250) || '.' || (user_id % 250) AS ip,
    CAST(8000 + {K} AS VARCHAR) AS port,
    '<' || event_type || '>' AS address,
    {CLASS} AS class,
    CASE WHEN event_type = 'click' THEN 'HTTP' ELSE 'HTTPS' END AS http,
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '秒' AS amount,
    event_type = 'error' AND {K} = 7 AS broken,
    (event_id // 300) % (CASE (event_id // 100) % 3 WHEN 2 THEN 2 ELSE 4 END) AS kind_no
  FROM events),
kinded AS (
  SELECT *,
    {SITE_NAMES}[site + 1] AS domain,
    CASE site WHEN 0 THEN ['nn', 'nt', 'wn', 'wt'][kind_no + 1]
      WHEN 1 THEN ['1', '2', '3', '4'][kind_no + 1]
      ELSE ['inha', 'intr'][kind_no + 1] END AS kind,
    ['国内高匿', '国内普通', '国外高匿', '国外普通'][kind_no + 1] AS kinddesc,
    bool_or(broken) OVER (PARTITION BY page) AS failed
  FROM listing),
parsed AS (
  SELECT 'http://' || domain || '/' || kind || '/' || page AS url, domain, kinddesc,
    page, page AS page_seq, CAST(row_no AS INTEGER) AS row_no, ip, port, address,
    CASE WHEN site = 1 AND kind_no >= 2 THEN 'W' ELSE '' END || class AS anonymous, http,
    amount AS speed, '7秒' AS resptime,
    CASE site WHEN 0 THEN '41天' ELSE '' END AS alivetime,
    CASE site WHEN 0 THEN '24-01-01 08:15' ELSE '' END AS testtime, '' AS portimage, failed
  FROM kinded),
sightings AS (SELECT * EXCLUDE (failed) FROM parsed WHERE NOT failed),
seeded AS (
  SELECT '10.0.' || (c_custkey // 250) || '.' || (c_custkey % 250) AS ip,
    CAST(8000 + c_custkey % 100 AS VARCHAR) AS port FROM customer)"""

# Pool rows and outcomes.
POOL = f"""pool AS (
  SELECT CAST(event_id AS VARCHAR) AS _id, CAST(user_id AS VARCHAR) AS ip,
    CAST(8000 + {K} AS VARCHAR) AS port,
    CASE WHEN user_id % 2 = 1 THEN 'W' ELSE '' END || {CLASS} AS anonymous,
    CAST(event_id % 5 AS INTEGER) AS status,
    CASE WHEN event_type = 'click' THEN 'HTTP' ELSE 'HTTPS' END AS http,
    'kind ' || event_type AS kinddesc
  FROM events)"""
OUTCOMES = POOL + """, outcomes AS (
  SELECT e.event_id AS seq, CAST(CASE WHEN e.event_type = 'error' THEN 0 ELSE 1 END AS INTEGER) AS result,
    lower(p.http) || '://' || p.ip || ':' || p.port AS purl, e.ts, p.*
  FROM events e JOIN pool p ON p._id = CAST(e.event_id AS VARCHAR)
  WHERE e.event_type <> 'signup')"""
OLD = f"""old_now AS (
  SELECT 'https://' || c_custkey || ':' || (8000 + c_custkey % 100) AS url,
    TIMESTAMP '2023-12-31 00:00:00' AS tm, {SEGMENT_CLASS} AS anonymous FROM customer),
old_history AS (
  SELECT CAST(c_custkey AS VARCHAR) AS _id, 'old-' || c_custkey AS ip, '80' AS port, 'A' AS anonymous,
    9 AS status, 'HTTP' AS http, c_mktsegment AS kinddesc FROM customer)"""
LIVE = f"""{OUTCOMES}, {OLD}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY purl ORDER BY seq DESC) AS rn FROM outcomes),
live AS (
  SELECT purl AS url, ts AS tm, anonymous FROM ranked WHERE rn = 1 AND result = 1
  UNION ALL
  SELECT o.* FROM old_now o WHERE NOT EXISTS (SELECT 1 FROM outcomes x WHERE x.purl = o.url))"""
DEAD = """new_history AS (
  SELECT h.* FROM old_history h
  WHERE NOT EXISTS (SELECT 1 FROM outcomes x WHERE x._id = h._id AND x.result < 1)
  UNION ALL
  SELECT _id, ip, port, anonymous, status, http, kinddesc FROM outcomes WHERE result < 1),
new_pool AS (
  SELECT p.* FROM pool p WHERE NOT EXISTS (
    SELECT 1 FROM outcomes x WHERE x.result < 1 AND x.ip = p.ip AND x.port = p.port))"""
ELIGIBLE = "(anonymous = 'A' OR regexp_matches(anonymous, '^W'))"

TOP = """top AS (
  SELECT url, row_number() OVER (ORDER BY tm DESC, url) - 1 AS idx FROM live
  WHERE anonymous = 'A' ORDER BY tm DESC, url LIMIT {n}),
req AS (SELECT page_id, CAST(page_id * 37 % 101 AS INTEGER) AS draw FROM pages)"""

LOG = """log AS (
  SELECT CAST(user_id AS VARCHAR) AS ip, event_id AS seq, event_type = 'error' AS dead,
    CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day FROM events)"""
ADMISSIONS = f"""WITH {LOG}, seen AS (
  SELECT *, lag(dead) OVER (PARTITION BY ip ORDER BY seq) AS was_dead FROM log)
SELECT ip, seq, day FROM seen WHERE NOT dead AND coalesce(was_dead, true)"""

HARVEST_POOL = f"""WITH {LISTING}, {FLAGGED}
SELECT page_seq || '-' || row_no AS _id, ip, port, address, anonymous, http, speed, resptime,
  alivetime, testtime, portimage, domain, kinddesc, 0 AS status,
  '2024-02-01 00:00:00.000000' AS timestamp, '' AS rmrk
FROM flagged WHERE is_new"""
STREAM_POOL = f"""{HARVEST_POOL}
UNION ALL SELECT NULL, ip, port, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  '2023-12-31 00:00:00.000000', NULL FROM seeded"""
# The first page of a key counts; a death between the two harvests removes all its rows.
READMITTED = f"""WITH {LISTING}, dead AS (
  SELECT DISTINCT l.ip, l.port FROM listing l JOIN events e USING (event_id) WHERE e.event_type = 'error'),
first AS (
  SELECT ip, port, min(page) AS page FROM sightings GROUP BY ip, port)
SELECT CASE WHEN d.ip IS NULL THEN s.page_seq ELSE s.page_seq + 1000000000 END || '-' || s.row_no AS _id, s.ip, s.port
FROM sightings s JOIN first f ON s.ip = f.ip AND s.port = f.port AND s.page = f.page
  LEFT JOIN dead d ON s.ip = d.ip AND s.port = d.port"""
HARVEST_COUNTS = f"""WITH {LISTING}, {FLAGGED}
SELECT url, kinddesc, count(*) FILTER (WHERE is_new) AS total,
  count(*) FILTER (WHERE is_new) AS addcount, count(*) FILTER (WHERE NOT is_new) AS existcount
FROM flagged GROUP BY page, url, kinddesc"""
FOLD = f"""WITH {LIVE}, {DEAD}
SELECT 'pool' AS tbl, _id AS id, ip, anonymous, CAST(NULL AS VARCHAR) AS tm FROM new_pool
UNION ALL SELECT 'now', url, NULL, anonymous, {TS.format('tm')} FROM live
UNION ALL SELECT 'history', _id, ip, anonymous, NULL FROM new_history"""

WS = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)"
    " || ' ' || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195)"
    " || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202)"
    " || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)

ORACLE: dict[str, str] = {
    "seed_frontier": r"""
      WITH hosts AS (
        SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages),
      kinds(kind, kinddesc) AS (
        VALUES ('1', '国内高匿'), ('2', '国内普通'), ('3', '国外高匿'), ('4', '国外普通'))
      SELECT CAST(page_id AS VARCHAR) AS site, kind, kinddesc, CAST(page AS INTEGER) AS page, host AS domain,
        'http://' || host || '/?stype=' || kind || '&page=' || page AS url
      FROM hosts, kinds, unnest(range(1, page_id % 3 + 2)) AS p(page)""",
    "kind_lookup": """
      WITH e AS (SELECT event_id, CAST(event_id % 5 + 1 AS VARCHAR) AS kind FROM events)
      SELECT event_id, kind, CASE kind WHEN '1' THEN '国内高匿' WHEN '2' THEN '国内普通'
        WHEN '3' THEN '国外高匿' WHEN '4' THEN '国外普通' END AS kinddesc FROM e""",
    "page_rows": f"""
      WITH {NAV_ITEMS}
      SELECT page_id, CAST(pos - 1 AS INTEGER) AS row_no, text FROM items WHERE pos >= 1""",
    "lateral_rows": f"""
      WITH {NAV_ITEMS}
      SELECT page_id, CAST(pos - 1 AS INTEGER) AS row_no, text FROM items WHERE pos >= 1""",
    "page_attr": f"""
      WITH {NAV}
      SELECT page_id, hrefs[1] AS href0, hrefs[2] AS href1, hrefs[3] AS href2, hrefs[4] AS href3
      FROM nav WHERE len(hrefs) >= 4""",
    "page_cells": f"""
      WITH {NAV}
      SELECT page_id, texts[1] AS c0, texts[2] AS c1, texts[3] AS c2, texts[4] AS c3, texts[5] AS c4,
        texts[6] AS c5 FROM nav WHERE len(texts) >= 6""",
    "page_atomic": f"""
      WITH {NAV_ITEMS}
      SELECT page_id, CAST(pos AS INTEGER) AS row_no, text FROM items WHERE n >= 6 AND pos >= 1""",
    "page_profile": f"""
      WITH {NAV}
      SELECT page_id, CAST(n_chars AS INTEGER) AS n_chars,
        CAST(greatest(len(texts) - 1, 0) AS INTEGER) AS n_rows FROM nav""",
    "frontier_source": """
      WITH sites(site_no, site, kind, head) AS (VALUES
        (0, 'xici', 'wn', 'http://www.xicidaili.com/wn/'), (0, 'xici', 'wt', 'http://www.xicidaili.com/wt/'),
        (1, 'cloud', '3', 'http://www.ip3366.net/free/?stype=3&page='),
        (1, 'cloud', '4', 'http://www.ip3366.net/free/?stype=4&page='))
      SELECT page_id, site, kind, CAST(page AS INTEGER) AS page, head || page AS url
      FROM pages JOIN sites ON site_no = page_id % 3, (VALUES (1), (2)) AS n(page)""",
    "page_envelope": f"WITH {LISTING} SELECT * EXCLUDE (page) FROM sightings",
    "raw_page_rows": f"WITH {LISTING} SELECT * EXCLUDE (page) FROM sightings WHERE page % 10 <> 9",
    "raw_page_errors": f"WITH {LISTING} SELECT DISTINCT url, 'utf-8' AS charset FROM parsed WHERE page % 10 = 9",
    "page_error_log": f"""
      WITH {LISTING}
      SELECT 'http://' || domain || '/' || kind || '/' || page AS url, 'error' AS status, kinddesc,
        'response解析异常, Traceback (most recent call last):' || chr(10) || '  in read_listing' || chr(10) || '  in value' || chr(10)
          || 'PageError: row ' || (min(row_no) + 1) || CASE site WHEN 0 THEN ': no div in cell 6'
          ELSE ': 6 cells, cell 6 wanted' END AS records,
        '20240201030405' AS timestamp
      FROM kinded WHERE broken GROUP BY page, domain, kind, kinddesc, site""",
    "listing_profile": f"""
      WITH {LISTING}
      SELECT url, CAST(CASE WHEN any_value(page) % 7 = 3 THEN 503 ELSE 200 END AS INTEGER) AS status,
        CAST(CASE WHEN bool_or(failed) THEN NULL ELSE count(*) END AS INTEGER) AS n_rows
      FROM parsed GROUP BY url""",
    "harvest_pool": HARVEST_POOL,
    "harvest_accounting": HARVEST_COUNTS.replace("SELECT url,", "SELECT page AS page_seq, url,"),
    "layout_union": """
      SELECT event_id AS id, CAST(user_id AS VARCHAR) AS ip, event_type AS label,
        strftime(ts, '%y-%m-%d %H:%M') AS testtime, '' AS portimage FROM events
      UNION ALL
      SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderpriority, '', '' FROM orders""",
    "classify_domestic": f"SELECT event_id, {CLASS} AS anonymous FROM events",
    "classify_foreign": f"""
      SELECT event_id, CASE WHEN event_id % 4 >= 2 THEN 'W' ELSE '' END || {CLASS} AS anonymous
      FROM events""",
    "scheme_url": """
      WITH e AS (SELECT *, CASE WHEN event_type = 'click' THEN 'HTTP' ELSE 'HTTPS' END AS http FROM events)
      SELECT event_id, http, lower(http) || '://' || user_id || ':' || (event_id % 65536) AS url FROM e""",
    "strip_ws": f"SELECT doc_id, trim(text, {WS}) AS text FROM documents",
    "ts_format": "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS ts14 FROM events",
    "admit_new": f"""
      WITH {SIGHTINGS}, {FLAGGED}
      SELECT event_id, ip, port, 'day/' || page AS url FROM flagged WHERE is_new""",
    "existing_rows": f"""
      WITH {SIGHTINGS}, {FLAGGED}
      SELECT event_id, ip, port, 'day/' || page AS url FROM flagged WHERE NOT is_new""",
    "key_match_count": f"WITH {POOL} SELECT ip, port, count(*) AS n FROM pool GROUP BY ip, port",
    "page_accounting": f"""
      WITH {SIGHTINGS}, {FLAGGED}
      SELECT 'day/' || page AS url, count(*) FILTER (WHERE is_new) AS total,
        count(*) FILTER (WHERE is_new) AS addcount, count(*) FILTER (WHERE NOT is_new) AS existcount
      FROM flagged GROUP BY page""",
    "pool_rows": f"""
      WITH {SIGHTINGS}, {FLAGGED}
      SELECT CAST(event_id AS VARCHAR) AS _id, ip, port, anonymous, http, 0 AS status,
        '2024-02-01 00:00:00.000000' AS timestamp, '' AS rmrk
      FROM flagged WHERE is_new""",
    "admit_big": f"""
      WITH {BIG}, {FLAGGED}
      SELECT page AS page_seq, count(*) FILTER (WHERE is_new) AS total,
        count(*) FILTER (WHERE is_new) AS addcount, count(*) FILTER (WHERE NOT is_new) AS existcount
      FROM flagged GROUP BY page""",
    "admit_big_rows": f"""
      WITH {BIG}, {FLAGGED} SELECT ip, port, page AS page_seq FROM flagged WHERE is_new""",
    "eligible_filter": f"WITH {POOL} SELECT _id, anonymous, status FROM pool WHERE {ELIGIBLE}",
    "nested_filter": f"""
      WITH {POOL} SELECT _id, anonymous, status, http FROM pool
      WHERE status >= 1 AND status < 4 AND (anonymous = 'A' OR anonymous LIKE 'W%' OR port IN ('8001', '8002') OR port IS NULL)
        AND NOT (http = 'HTTP' AND status > 2) AND NOT regexp_matches(kinddesc, 'error$') AND ip <> '7'""",
    "status_levels": f"""
      WITH {POOL} SELECT DISTINCT status FROM pool WHERE {ELIGIBLE} ORDER BY status DESC""",
    "status_sweep": f"""
      WITH {POOL}
      SELECT _id, anonymous, CAST(status + CASE WHEN {ELIGIBLE} THEN 1 ELSE 0 END AS INTEGER) AS status
      FROM pool""",
    "dispatch_list": f"""
      WITH {POOL}
      SELECT _id, ip, port, anonymous, CAST(status + 1 AS INTEGER) AS status, http, kinddesc
      FROM pool WHERE {ELIGIBLE} ORDER BY status DESC, _id""",
    "dispatch_count": f"""
      WITH {POOL}
      SELECT CAST(status + 1 AS INTEGER) AS status, count(*) AS n FROM pool WHERE {ELIGIBLE}
      GROUP BY status""",
    "probe_route": f"""
      WITH {POOL}
      SELECT _id, CASE WHEN anonymous = 'A' THEN 'http://www.baidu.com'
        ELSE 'https://www.google.com' END AS target FROM pool""",
    "outcome_classify": """
      SELECT event_id AS seq, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS INTEGER) AS result
      FROM events WHERE event_type <> 'signup'""",
    "outcome_split": """
      SELECT 'dead' AS side, 'http_error' AS err_kind, count(*) AS n FROM events WHERE event_type = 'error'
      UNION ALL
      SELECT 'alive', NULL, count(*) FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "outcome_join": f"WITH {OUTCOMES} SELECT * EXCLUDE (ts) FROM outcomes",
    "outcome_unmatched": f"""
      WITH {OUTCOMES} SELECT _id AS record_id, seq, result FROM outcomes WHERE NOT {ELIGIBLE}""",
    "dead_pool_delete": f"WITH {OUTCOMES}, {OLD}, {DEAD} SELECT * FROM new_pool",
    "dead_history_upsert": f"WITH {OUTCOMES}, {OLD}, {DEAD} SELECT * FROM new_history",
    "dead_now_delete": f"""
      WITH {OUTCOMES}, {OLD}
      SELECT url, {TS.format('tm')} AS tm, anonymous FROM old_now o
      WHERE NOT EXISTS (SELECT 1 FROM outcomes x WHERE x.result < 1 AND x.purl = o.url)""",
    "alive_now_upsert": f"""
      WITH {OUTCOMES}, {OLD}, won AS (
        SELECT *, row_number() OVER (PARTITION BY purl ORDER BY seq DESC) AS rn FROM outcomes WHERE result = 1)
      SELECT purl AS url, {TS.format('ts')} AS tm, anonymous FROM won WHERE rn = 1
      UNION ALL
      SELECT url, {TS.format('tm')}, anonymous FROM old_now o
      WHERE NOT EXISTS (SELECT 1 FROM won x WHERE x.purl = o.url)""",
    "outcome_fold": FOLD,
    "find_by_filter": f"""
      WITH {LIVE} SELECT url, {TS.format('tm')} AS tm, anonymous FROM live WHERE anonymous = 'WC'""",
    "freshest_topk": f"""
      WITH {LIVE}, best AS (
        SELECT * FROM live WHERE anonymous = 'A' ORDER BY tm DESC, url LIMIT 30)
      SELECT url, {TS.format('tm')} AS tm, anonymous FROM best""",
    "random_assign": f"""
      WITH {LIVE}, {TOP.format(n=30)}
      SELECT page_id, draw, url FROM req LEFT JOIN top ON idx = draw % (SELECT count(*) FROM top)""",
    "random_assign_fixed": f"""
      WITH {LIVE}, {TOP.format(n=20)}
      SELECT page_id, draw, url FROM req LEFT JOIN top ON idx = draw % 30""",
    "ledger_replay": ADMISSIONS,
    "ledger_members": f"""
      WITH {LOG}, last AS (
        SELECT *, row_number() OVER (PARTITION BY ip ORDER BY seq DESC) AS rn FROM log)
      SELECT ip, seq FROM last WHERE rn = 1 AND NOT dead""",
    "stream_harvest": HARVEST_COUNTS.replace("SELECT url,", "SELECT '20240201000000' AS timestamp, url,"),
    "stream_harvest_pool": STREAM_POOL,
    "stream_readmission": READMITTED,
    "stream_fold": FOLD,
    "stream_now": f"WITH {LIVE} SELECT url, {TS.format('tm')} AS tm, anonymous FROM live",
    "stream_sweep": f"""
      WITH {POOL}
      SELECT _id, ip, port, anonymous, CAST(status + 1 + sweep AS INTEGER) AS status, http, kinddesc, sweep
      FROM pool, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) AS s(sweep) WHERE {ELIGIBLE}""",
    "stream_ledger": ADMISSIONS,
}
