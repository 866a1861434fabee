"""SQL that gives the same rows as the queries of the core, where SQL can express them."""

from __future__ import annotations

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"
_WS = " \t\n\x0b\x0c\r\x1c-\x1f\u0085   -     　"
_EOL = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]"


def part(n: int, url: str = "url") -> str:
    found = f"regexp_extract({url}, '{_URL}', {n})"
    return f"regexp_replace({found}, ';[^/]*$', '')" if n == 3 else found


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, '[{_WS}]+', ' ', 'g')")


_PAIRS = f"list_filter(string_split({part(4)}, '&'), lambda x: x <> '')"
_KEY = "url_decode(replace(regexp_extract(x, '^([^=]*)', 1), '+', ' '))"
_VALUE = r"url_decode(replace(regexp_extract(x, '^[^=]*=([\s\S]*)$', 1), '+', ' '))"
_SEGMENTS = f"list_filter(string_split(lower({part(3)}), '/'), lambda x: x <> '')"


def listed(columns: str, table: str) -> str:
    """Rows of ``table`` with the rule that its url meets."""
    return f"""
urls AS (
  SELECT {columns}, url,
    regexp_replace(lower({part(2)}), '^www\\.', '') AS host, {part(3)} AS path,
    CASE WHEN regexp_replace({part(3)}, '/+$', '') = '' THEN '/' ELSE regexp_replace({part(3)}, '/+$', '') END AS bare,
    {_SEGMENTS} AS segs, list_transform({_PAIRS}, lambda x: lower({_KEY})) AS keys,
    list_transform({_PAIRS}, lambda x: {{'k': lower({_KEY}), 'v': {_VALUE}}}) AS pairs
  FROM {table}
),
hubs AS (
  SELECT *, (host = 'eec.eaeunion.org' AND regexp_matches(lower(bare), '^/news/(speech|events|video-gallery|photo-gallery|broadcasts)/?$')) OR (host = 'ria-stk.ru' AND lower(bare) = '/news/vse-novosti.php') AS hub FROM urls
),
ruled AS (
  SELECT *, CASE WHEN url IS NULL OR url = '' THEN NULL
    WHEN host IN ('notim.ru', 'eec.eaeunion.org', 'erzrf.ru') AND regexp_matches(bare, '^/news/[^/?#]+/?$') AND NOT hub THEN 'R1'
    WHEN host = 'ria-stk.ru' AND lower(bare) = '/news/index.php' AND len(list_filter(pairs, lambda p: p.k = 'element_id' AND p.v <> '')) > 0 THEN 'R2'
    WHEN bare = '/news' THEN 'R3' WHEN hub THEN 'R4' WHEN contains(lower(path), '/page/') THEN 'R5' WHEN bare IN ('/press', '/news-list') THEN 'R6'
    WHEN list_has_any(keys, ['page', 'pagen_1', 'per-page', 'tag', 'category', 'year', 'month', 'sort', 'filter']) THEN 'R7'
    WHEN len(list_filter(keys, lambda k: starts_with(k, 'pagen_'))) > 0 THEN 'R8'
    WHEN len(segs) > 0 AND segs[-1] = 'news' THEN 'R9'
    WHEN len(segs) = 2 AND segs[1] IN ('news', 'novosti', 'lenta', 'tema', 'topics', 'press', 'press-center', 'press-tsentr') AND NOT regexp_matches(segs[2], '^[0-9]+$') THEN 'R10'
    WHEN list_has_any(segs, ['tag', 'category', 'archive', 'search', 'page']) THEN 'R11'
    WHEN len(list_filter(pairs, lambda p: p.k = 'vote_id' AND regexp_matches(p.v, '^[0-9]+$'))) > 0 THEN 'R12' END AS rule FROM hubs
),
flagged AS (SELECT *, coalesce(rule NOT IN ('R1', 'R2'), false) AS listing FROM ruled)
"""


_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(?: ?([ap])m)?"
_ZONE = r"([a-z]{1,4}|[+-]\d{1,2}(?::?\d{2})?)?"
#: How dates are written: a pattern, and what a match is rewritten to (year, month, day, hour, minute, second, half, zone).
_DATES = (
    (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})(?:[t ]{_TIME} ?{_ZONE}(?:\[[^\]]*\])?)?$", r"\1|\2|\3|\4|\5|\6|\7|\8"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})(){_ZONE}$", r"\1|\2|\3|\4|\5|\6|\7|\8"),
    (rf"^(\d{{1,2}})[./](\d{{1,2}})[./](\d{{4}}|\d{{2}})(?:(?:,| в)? {_TIME})?$", r"\3|\2|\1|\4|\5|\6|\7|"),
    (r"^(\d{1,2}):(\d{2}) (\d{1,2})\.(\d{1,2})\.(\d{4})$", r"\5|\4|\3|\1|\2|||"),
    (rf"^(?:[a-z]+, )?(\d{{1,2}}) ([a-zа-яё]+) (\d{{4}})(?: года| г\.)?(?:(?:,| в)? {_TIME} ?{_ZONE})?$", r"\3|\2|\1|\4|\5|\6|\7|\8"),
    (rf"^([a-z]+) (\d{{1,2}}), (\d{{4}}),? {_TIME}$", r"\3|\1|\2|\4|\5|\6|\7|"),
)
_DATE_CELLS = "CASE " + " ".join(f"WHEN regexp_matches(s, '{p}') THEN regexp_replace(s, '{p}', '{r}')" for p, r in _DATES) + " END"
_MONTH = "CASE " + " ".join(f"WHEN starts_with(m, '{a}') THEN {k}" for k, names in enumerate(("янв jan", "фев feb", "мар mar", "апр apr", "мая май may", "июн jun", "июл jul", "авг aug", "сен sep", "окт oct", "ноя nov", "дек dec"), 1) for a in names.split()) + " ELSE try_cast(m AS INT) END"
_INSTANTS = rf"""
tidy AS (
  SELECT item_no, date_published AS raw, fetched_at, coalesce(time_zone, 'Europe/Moscow') AS z,
    regexp_replace(trim(regexp_replace(lower(date_published), '[\s\x{{a0}}]+', ' ', 'g')), '^опубликовано: ', '') AS s
  FROM unified LEFT JOIN sources ON name = source WHERE date_published IS NOT NULL
),
told AS (
  SELECT *, CASE WHEN regexp_matches(s, '^(сегодня|today|heute|сёння)') THEN 0 WHEN regexp_matches(s, '^(вчера|yesterday|gestern|учора)') THEN 1 END AS back FROM tidy
),
cells AS (
  SELECT *, string_split(coalesce(CASE WHEN back IS NOT NULL THEN strftime(CAST(timezone(z, fetched_at) AS DATE) - CAST(back AS INT), '%Y|%m|%d|') || regexp_replace(s, '^[^0-9]*(\d{{1,2}}):(\d{{2}})$', '\1|\2|||') END, {_DATE_CELLS}), '|') AS c FROM told
),
named AS (SELECT *, c[1] AS y, c[2] AS m, c[3] AS d, nullif(c[4], '') AS h, nullif(c[5], '') AS mi, nullif(c[6], '') AS sec, nullif(c[7], '') AS half, nullif(c[8], '') AS zone FROM cells),
numbers AS (
  SELECT *, try_cast(CASE WHEN length(y) = 2 THEN '20' || y ELSE y END AS INT) AS yy, {_MONTH} AS mm,
    CASE WHEN half IS NULL THEN coalesce(try_cast(h AS INT), 0) ELSE try_cast(h AS INT) % 12 + CASE half WHEN 'p' THEN 12 ELSE 0 END END AS hh FROM named
),
clocks AS (
  SELECT *, try_cast(yy || '-' || mm || '-' || d || ' ' || hh || ':' || coalesce(mi, '00') || ':' || coalesce(sec, '00') AS TIMESTAMP) AS t,
    CASE WHEN zone = 'msk' THEN 'Europe/Moscow' ELSE z END AS clock,
    CASE WHEN zone IN ('z', 'utc', 'gmt') THEN 0 WHEN zone = 'cet' THEN 3600 WHEN zone = 'cest' THEN 7200
      WHEN regexp_matches(zone, '^[+-]') THEN CASE WHEN zone[1] = '-' THEN -1 ELSE 1 END * (CAST(substr(zone, 2, 2) AS INT) * 3600 + coalesce(try_cast(nullif(substr(replace(zone, ':', ''), 4, 2), '') AS INT), 0) * 60) END AS off FROM numbers
),
found AS (
  SELECT *, CASE WHEN regexp_matches(s, '^\d{{9,10}}(\.\d+)?$') THEN CAST(regexp_extract(s, '^\d+') AS BIGINT) WHEN regexp_matches(s, '^\d{{13}}$') THEN CAST(s AS BIGINT) // 1000
    WHEN off IS NOT NULL THEN CAST(epoch(t) AS BIGINT) - off
    WHEN timezone(clock, timezone(clock, t)) <> t THEN CAST(epoch(timezone(clock, t - INTERVAL 1 HOUR)) AS BIGINT) + 3600
    WHEN timezone(clock, timezone(clock, t) - INTERVAL 1 HOUR) = t THEN CAST(epoch(timezone(clock, t)) AS BIGINT) - 3600
    ELSE CAST(epoch(timezone(clock, t)) AS BIGINT) END AS utc_second FROM clocks
),
home AS (
  SELECT item_no, raw, utc_second, timezone('Europe/Moscow', to_timestamp(utc_second)) AS local, timezone('UTC', to_timestamp(utc_second)) AS utc FROM found WHERE utc_second BETWEEN 946684800 AND 2082758399
)
"""
_HALF = "(SELECT max(batch_no) / 2.0 FROM unified)"
_RICH = f"coalesce({strip('content_text')} <> '', false)"
_WORDS = r"coalesce(len(regexp_extract_all(content_text, '[\p{L}\p{N}_]+')), 0)"
_ID = "coalesce(nullif(id, ''), sha256(url))"
_ONE_EACH = """
dated AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY CASE WHEN nullif(date_published, '') IS NULL THEN 1 ELSE 0 END, item_no) AS rn, min(item_no) OVER (PARTITION BY url) AS ord FROM unified),
feed AS (SELECT * FROM dated WHERE rn = 1)
"""
_ONCE = "once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY host, url, phase, attempt, attempted_at ORDER BY logged_at, log_no) AS rn FROM fetch_attempts) WHERE rn = 1)"
_GOOD = "coalesce(error IS NULL AND status < 400, false)"
_MERGED = f"""
{listed('item_no, id, title, date_published, content_text, source, batch_no', 'unified')},
kept AS (SELECT item_no, id, url, title, date_published, content_text, source, batch_no <= {_HALF} AS old FROM flagged WHERE url <> '' AND NOT listing),
olds AS (SELECT url, max_by(id, item_no) FILTER (WHERE id <> '') AS old_id, min(item_no) AS first_no, max(item_no) AS last_no FROM kept WHERE old GROUP BY url),
steps AS (
  SELECT k.*, coalesce(o.first_no, k.item_no) AS ord, f.seen FROM kept k LEFT JOIN olds o USING (url)
  LEFT JOIN (SELECT id, min(first_seen) AS seen FROM first_seen GROUP BY id) f ON f.id = coalesce(nullif(k.id, ''), o.old_id)
  WHERE NOT old OR k.item_no = o.last_no
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY old DESC, item_no) AS step, first_value(CASE WHEN old THEN ord ELSE item_no END) OVER (PARTITION BY url ORDER BY old DESC, item_no) AS place, first_value(CASE WHEN old THEN 0 ELSE 1 END) OVER (PARTITION BY url ORDER BY old DESC, item_no) AS side FROM steps),
folded AS (
  WITH RECURSIVE fold AS (
    SELECT url, step, side, place, title, date_published, content_text, source FROM numbered WHERE step = 1
    UNION ALL
    SELECT n.url, n.step, a.side, a.place, n.title,
      CASE WHEN nullif(a.date_published, '') IS NOT NULL AND nullif(n.date_published, '') IS NOT NULL AND coalesce(n.seen = n.date_published, false) THEN a.date_published ELSE n.date_published END,
      CASE WHEN coalesce({strip('n.content_text')} <> '', false) THEN n.content_text ELSE a.content_text END, n.source
    FROM fold a JOIN numbered n ON n.url = a.url AND n.step = a.step + 1
  )
  SELECT * FROM (SELECT *, max(step) OVER (PARTITION BY url) AS last FROM fold) WHERE step = last
)
"""

ORACLES: dict[str, str] = {
    "p5_found": f"WITH {_INSTANTS} SELECT item_no, utc_second FROM home WHERE raw <> strftime(local, '%Y-%m-%dT%H:%M:%S') || '+0' || date_diff('hour', utc, local) || ':00'",
    "url_parts": f"SELECT item_no, {part(1)} AS scheme, {part(2)} AS host, {part(3)} AS path, {part(4)} AS query, {part(5)} AS fragment FROM unified",
    "url_segments": f"SELECT item_no, unnest(list_filter(string_split({part(3)}, '/'), lambda x: x <> '')) AS segment FROM unified",
    "query_pairs": f"SELECT item_no, {_KEY} AS key, {_VALUE} AS value FROM (SELECT item_no, unnest({_PAIRS}) AS x FROM unified)",
    "url_listing_rule": f"WITH {listed('item_no', 'unified')} SELECT item_no, rule, listing FROM flagged",
    "url_listing_filter": f"WITH {listed('item_no', 'unified')} SELECT item_no, url FROM flagged WHERE url <> '' AND NOT listing",
    "cache_key": f"""
WITH slugs AS (SELECT item_no, url, {part(2)} AS host, regexp_replace(regexp_replace({part(3)}, '[^a-zA-Z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS p, trim({part(4)}) AS q FROM unified),
keyed AS (SELECT *, concat_ws('-', nullif(p, ''), CASE WHEN q <> '' THEN substr(sha1(q), 1, 10) END) AS slug FROM slugs),
named AS (SELECT item_no, url, host || '-' || CASE WHEN slug = '' THEN 'index' ELSE substr(slug, 1, 150) END AS k FROM keyed)
SELECT item_no, k || '.html' AS cache_key, k || '-amp.html' AS amp_key, sha256(url) AS id FROM named""",
    "url_joined": f"""
WITH u AS (SELECT item_no, {part(1)} AS s, {part(2)} AS h, {part(3)} AS p, regexp_replace(url, '#.*$', '') AS bare FROM unified),
hrefs AS (SELECT unnest(['/a/b?x=1', 'c.html', '?page=2', '#top', '//m.example/z', 'https://o.example/', 'mailto:a@b.example']) AS href)
SELECT item_no, href, CASE href WHEN '/a/b?x=1' THEN s || '://' || h || href
  WHEN 'c.html' THEN s || '://' || h || CASE WHEN regexp_replace(p, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(p, '[^/]*$', '') END || href
  WHEN '?page=2' THEN s || '://' || h || p || href WHEN '#top' THEN bare || href WHEN '//m.example/z' THEN s || ':' || href ELSE href END AS joined
FROM u CROSS JOIN hrefs""",
    "normalize_ws": f"SELECT item_no, array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce(content_text, ''), '{_EOL}'), lambda x: {strip('x')}), lambda x: x <> ''), chr(10)) AS lines, {collapse('title')} AS title FROM unified",
    "word_count": f"SELECT item_no, {_WORDS} AS words, coalesce(contains(content_text, '<') AND contains(content_text, '>') AND regexp_matches(content_text, '<[a-zA-Z][^>]*>'), false) AS html FROM unified",
    "min_words_filter": f"SELECT item_no, source FROM unified JOIN sources ON name = source WHERE coalesce(min_words, 0) <= 0 OR {_WORDS} >= min_words",
    "needs_fallback": f"SELECT item_no, nullif(content_text, '') IS NULL OR coalesce(lower({collapse('content_text')}) = lower({collapse('title')}), false) OR length(content_text) < 160 AS needed, {_RICH} AS rich FROM unified",
    "drop_leading_title": f"""
WITH t AS (SELECT item_no, regexp_replace(concat_ws(' — ', title, content_text), '^[{_WS}]+', '') AS head, coalesce({collapse('title')}, '') AS name FROM unified)
SELECT item_no, {strip(f'''CASE WHEN name = '' THEN head WHEN lower(substr(head, 1, length(name))) = lower(name) THEN regexp_replace(substr(head, length(name) + 1), '^[{_WS}\\-–—:]*', '')
  WHEN lower({collapse("regexp_extract(head, '^([^' || chr(10) || chr(13) || ']*)', 1)")}) = lower(name) THEN substr(head, length(regexp_extract(head, '^([^' || chr(10) || chr(13) || ']*)', 1)) + 1) ELSE head END''')} AS rest FROM t""",
    "ru_date_dotted": "SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 2000 AND 2035 THEN strftime(date_trunc('minute', o_orderdate), '%Y-%m-%d %H:%M:%S') END AS local FROM orders",
    "ru_date_words": "SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS local FROM events",
    "url_date": r"""
WITH d AS (SELECT item_no, regexp_extract(url, '/(20\d{2})/([01]\d)/([0-3]\d)/', 1) AS y, regexp_extract(url, '/(20\d{2})/([01]\d)/([0-3]\d)/', 2) AS m, regexp_extract(url, '/(20\d{2})/([01]\d)/([0-3]\d)/', 3) AS dd FROM unified)
SELECT item_no, CAST(epoch(timezone('Europe/Moscow', CAST(try_cast(y || '-' || m || '-' || dd AS DATE) AS TIMESTAMP))) AS BIGINT) AS utc_second FROM d""",
    "home_time": "SELECT item_no, strftime(timezone('Europe/Moscow', fetched_at), '%Y-%m-%dT%H:%M:%S') || '+0' || CAST(date_diff('hour', timezone('UTC', fetched_at), timezone('Europe/Moscow', fetched_at)) AS VARCHAR) || ':00' AS home_time FROM unified",
    "page_title": r"""
WITH t AS (SELECT page_id, html, regexp_extract(html, 'property=''og:title'' content="([^"]*)"', 1) AS og, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages),
c AS (SELECT page_id, CASE WHEN html IS NULL THEN NULL WHEN og <> '' THEN og WHEN contains(html, '<h1>') THEN h1 ELSE t END AS t FROM t)
SELECT page_id, replace(replace(replace(replace(trim(t), '&mdash;', '—'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') AS title FROM c""",
    "new_links": None,
    "missing_sources": "SELECT DISTINCT source AS name FROM unified WHERE source NOT IN (SELECT source FROM mix_targets)",
    "request_strategies": f"""
WITH s AS (SELECT name, {part(2, "coalesce(nullif(base_url, ''), nullif(start_url, ''))")} AS host, request_strategy AS r FROM sources WHERE request_strategy IS NOT NULL),
last AS (SELECT host, max(name) AS source FROM s WHERE host <> '' GROUP BY host)
SELECT s.host, source, coalesce(r.connect_timeout, r.read_timeout) AS connect, coalesce(r.read_timeout, r.connect_timeout) AS read, r.max_attempts AS max_attempts FROM s JOIN last ON s.host = last.host AND s.name = last.source""",
    "first_seen_fill": f"SELECT item_no, {_ID} AS id, coalesce(nullif(date_published, ''), f.seen, '2025-07-01T12:00+03:00') AS date_published FROM unified LEFT JOIN (SELECT id AS fid, min(first_seen) AS seen FROM first_seen GROUP BY id) f ON f.fid = {_ID}",
    "first_seen_after": f"SELECT id, first_seen FROM first_seen UNION ALL SELECT DISTINCT {_ID}, '2025-07-01T12:00+03:00' FROM unified WHERE nullif(date_published, '') IS NULL AND {_ID} NOT IN (SELECT id FROM first_seen)",
    "index_changed": """
WITH p AS (SELECT page_id, url, html, status FROM pages WHERE html IS NOT NULL), b AS (SELECT url, min(page_id) AS page_id FROM p WHERE status < 400 GROUP BY url)
SELECT CAST(page_id AS VARCHAR) AS key, sha256(html) AS digest FROM p WHERE page_id NOT IN (SELECT page_id FROM b)""",
    "cooldown_routes": """
WITH rest AS (SELECT url, max(attempted_at) + INTERVAL 6 HOUR AS until FROM fetch_attempts WHERE status IN (500, 502, 503, 504) GROUP BY url), cached AS (SELECT DISTINCT url FROM pages WHERE html IS NOT NULL)
SELECT name, CASE WHEN until > TIMESTAMPTZ '2021-01-20 00:00:00+00' THEN CASE WHEN c.url IS NOT NULL THEN 'cache_only' ELSE 'skip' END ELSE 'live' END AS route FROM sources LEFT JOIN rest r ON r.url = start_url LEFT JOIN cached c ON c.url = start_url""",
    "run_twice": "SELECT 0::BIGINT AS new_items",
    "pages_served": """
WITH copies AS (SELECT url, last(html ORDER BY fetched_at NULLS FIRST, html) AS c FROM pages WHERE status = 200 AND html IS NOT NULL GROUP BY url),
s AS (SELECT page_id, html, c, CASE WHEN coalesce(status < 400 AND status <> 304, false) AND html IS NOT NULL THEN 'fresh' WHEN c IS NOT NULL AND (status IS NULL OR status IN (304, 500, 502, 503, 504)) THEN 'cached' ELSE 'none' END AS origin FROM pages LEFT JOIN copies USING (url))
SELECT page_id, origin, length(CASE origin WHEN 'fresh' THEN html WHEN 'cached' THEN c END) AS size FROM s""",
    "feed_dedup": f"WITH {_ONE_EACH} SELECT ord, url, title, date_published FROM feed",
    "feed_built": f"WITH {_ONE_EACH} SELECT ord, url, date_published, source FROM feed WHERE nullif(date_published, '') IS NOT NULL",
    "feed_skip_keywords": f"WITH {_ONE_EACH} SELECT ord, url FROM feed WHERE nullif(date_published, '') IS NOT NULL AND NOT (coalesce(regexp_matches(title, '(?i)lorem|битум'), false) OR coalesce(regexp_matches(url, '(?i)lorem|битум'), false))",
    "feed_merged": f"WITH {_MERGED} SELECT side, place AS ord, url, title, date_published, content_text, source FROM folded",
    "feed_top": f"WITH {_MERGED} SELECT url, title, date_published, source FROM folded ORDER BY coalesce(date_published, '') DESC, side, place, url LIMIT 2000",
    "feed_metrics": f"WITH {listed('content_text', 'unified')} SELECT count(*) AS total, count(*) FILTER (WHERE NOT {_RICH}) AS empty_content_text, count(*) FILTER (WHERE listing) AS listing_urls_count FROM flagged",
    "regression_gate": f"""
WITH {listed('content_text, batch_no', 'unified')}, b AS (SELECT count(*) - count(*) FILTER (WHERE listing) AS least FROM flagged WHERE batch_no <= {_HALF}), c AS (SELECT count(*) AS total FROM flagged)
SELECT total >= least AS ok, CASE WHEN total < least THEN 'Feed dropped below ' || least || ' items: ' || total END AS message FROM b, c""",
    "seen_window": f"""
WITH old AS (SELECT source, item_no, url FROM unified WHERE batch_no <= {_HALF}), new AS (SELECT source, item_no, url FROM unified WHERE batch_no > {_HALF}),
b AS (SELECT source, url, item_no, 0 AS side FROM new UNION ALL SELECT source, url, item_no, 1 FROM old WHERE (source, url) IN (SELECT source, url FROM new))
SELECT source, n - 1 AS pos, url FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY side, item_no, url) AS n FROM b) WHERE n <= 500""",
    "api_entries": """
WITH e AS (SELECT *, row_number() OVER (PARTITION BY source, batch_no, item_no // 500 ORDER BY item_no) - 1 AS pos FROM unified)
SELECT source, batch_no, item_no // 500 AS block, pos, nullif(url, '') AS url, trim(nullif(title, '')) AS title, nullif(date_published, '') AS iso_date, nullif(length(s), 0) AS size FROM (SELECT *, """
    + strip("content_text")
    + " AS s FROM e)",
    "api_links": f"""
WITH {listed('item_no, source, batch_no', 'unified')}, e AS (SELECT *, row_number() OVER (PARTITION BY source, batch_no, item_no // 500 ORDER BY item_no) - 1 AS pos FROM flagged),
f AS (SELECT source, url, min(pos) AS pos FROM e WHERE url <> '' AND NOT listing GROUP BY source, url),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos, url) AS n FROM f)
SELECT source, url FROM n JOIN sources ON name = source WHERE n <= coalesce(max_links, 100)""",
    "json_feed_roundtrip": f"WITH {_ONE_EACH} SELECT url, title, date_published, source FROM feed WHERE nullif(date_published, '') IS NOT NULL ORDER BY date_published DESC, ord, url LIMIT 2000",
    "attempts_once": f"WITH {_ONCE} SELECT log_no, host, url, phase, attempt FROM once",
    "last_metric_per_host": f"""
WITH {_ONCE}, r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY attempted_at DESC, logged_at DESC, log_no DESC) AS k FROM once WHERE phase = 'request')
SELECT host, attempt, status, error, dns_ms, CASE WHEN response_ms - dns_ms IS NULL THEN 0.0 ELSE greatest(0.0, response_ms - dns_ms) END AS connect_ms, response_ms FROM r WHERE k = 1""",
    "consecutive_failures": f"""
WITH {_ONCE}, r AS (SELECT host, {_GOOD} AS good, row_number() OVER (PARTITION BY host ORDER BY attempted_at, logged_at, log_no) AS n FROM once WHERE phase = 'request'),
l AS (SELECT host, max(n) FILTER (WHERE good) AS last FROM r GROUP BY host)
SELECT host, count(*) FILTER (WHERE n > coalesce(last, 0)) AS consecutive_failures FROM r JOIN l USING (host) GROUP BY host""",
    "failure_islands": f"""
WITH {_ONCE}, r AS (SELECT *, {_GOOD} AS good, sum(CASE WHEN {_GOOD} THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY attempted_at, logged_at, log_no ROWS UNBOUNDED PRECEDING) AS island FROM once WHERE phase = 'request')
SELECT host, log_no, CAST(sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY host, island ORDER BY attempted_at, logged_at, log_no ROWS UNBOUNDED PRECEDING) AS BIGINT) AS failures FROM r""",
    "warmup_outcomes": f"""
WITH {_ONCE} SELECT log_no, host, CASE WHEN status < 400 THEN 'http_success'
  WHEN len(list_filter(coalesce(cookie_names, []), lambda c: starts_with(lower(c), '__ddg') OR starts_with(lower(c), 'ddg2') OR starts_with(lower(c), 'cf_clearance') OR starts_with(lower(c), 'cf_bm') OR starts_with(lower(c), 'cf_chl_'))) > 0 THEN 'http_4xx_with_cookies'
  WHEN status IS NOT NULL THEN 'http_error' ELSE 'failed' END AS outcome, coalesce(contains(lower(error), 'network is unreachable'), false) AS unreachable FROM once WHERE phase = 'warmup'""",
    "backoff_waits": "SELECT log_no, 1.5 * pow(2.0, attempt - 1) AS wait_s FROM fetch_attempts",
    "cookie_names": "SELECT DISTINCT host, unnest(cookie_names) AS name FROM fetch_attempts",
    "stream_new_addresses": "SELECT DISTINCT source, url FROM unified",
    "stream_first_seen": "SELECT id, epoch_us(min(fetched_at)) // 1000000 AS first_seen FROM unified WHERE id IS NOT NULL GROUP BY id",
    "flagship": f"""
WITH {listed('item_no, id, title, date_published, content_text, source', 'unified')},
f AS (SELECT id AS fid, min(first_seen) AS seen FROM first_seen GROUP BY id),
kept AS (SELECT item_no, {_ID} AS id, url, title, coalesce(nullif(date_published, ''), seen, '2025-07-01T12:00:00+03:00') AS date_published, content_text, source, seen FROM flagged LEFT JOIN f ON fid = {_ID} WHERE url <> '' AND NOT listing),
numbered AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY item_no) AS step FROM kept),
folded AS (
  WITH RECURSIVE fold AS (
    SELECT url, step, id, title, date_published, content_text, source FROM numbered WHERE step = 1
    UNION ALL
    SELECT n.url, n.step, n.id, n.title, CASE WHEN coalesce(n.seen = n.date_published, false) THEN a.date_published ELSE n.date_published END,
      CASE WHEN coalesce({strip('n.content_text')} <> '', false) THEN n.content_text ELSE a.content_text END, n.source
    FROM fold a JOIN numbered n ON n.url = a.url AND n.step = a.step + 1
  )
  SELECT * FROM (SELECT *, max(step) OVER (PARTITION BY url) AS last FROM fold) WHERE step = last
)
SELECT id, url, title, date_published, content_text, source FROM folded""",
}
ORACLES = {k: v for k, v in ORACLES.items() if v}
