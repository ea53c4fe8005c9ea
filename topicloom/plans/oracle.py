"""The registered queries as SQL on the same tables."""

from __future__ import annotations

from topicloom.plans.articles import TOPICS

#: What counts as white space, for RE2: the Unicode spaces, line ends and the four separators of ASCII.
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The entities that the pages of the registered queries have.
DECODED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#x27;": "'", "&nbsp;": " ", "&eacute;": "é", "&mdash;": "—", "&#8217;": "’", "&frac12;": "½", "&middot;": "·", "&copy;": "©", "&amp;": "\x01", "&amp": "&", "\x01": "&"}

ARTICLES = """articles AS (SELECT doc_id AS pos, 'https://www.' || source || '.example/' || md5(text) AS url,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE text END AS title,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS description,
  lang AS language, source AS media_url, strftime(DATE '2024-01-01' + (doc_id % 30)::INTEGER, '%Y-%m-%d') AS publish_date FROM documents)"""
LABELLED = f"{ARTICLES}, labelled AS (SELECT a.*, quality, toxic FROM articles a LEFT JOIN labels l ON l.doc_id = a.pos)"
DAYS = """days AS (SELECT event_id, ts::DATE AS day, event_type AS outlet, ts FROM events
  WHERE NOT (event_type = 'click' AND day(ts) IN (3, 4, 17)) AND NOT day(ts) = 20)"""
HAVE = f"{DAYS}, have AS (SELECT outlet, day, count(*) AS have FROM days GROUP BY ALL)"
EXPECTED = f"""{HAVE}, expected AS (SELECT day, outlet, (CASE WHEN day(day) = 12 AND outlet = 'purchase' THEN -1 WHEN day(day) = 9 THEN n + 1 ELSE n END)::BIGINT AS expected
  FROM (SELECT ts::DATE AS day, event_type AS outlet, count(*) AS n FROM events GROUP BY ALL) WHERE day(day) <> 15),
completed AS (SELECT day, outlet FROM have JOIN expected USING (day, outlet) WHERE have > 0 AND expected >= 0 AND have >= expected)"""
VERSIONS = """versions AS (SELECT strftime(ts, '%Y-%m-%d') AS version, 30 - day(ts) AS idx, count(*) AS n FROM events
  WHERE 30 - day(ts) > 0 OR event_id % 3 = 0 GROUP BY ALL)"""


ALL_VERSIONS = "versions AS (SELECT strftime(ts, '%Y-%m-%d') AS version, 30 - day(ts) AS idx, count(*) AS n FROM events GROUP BY ALL)"


def any_of(keywords, text: str) -> str:
    return "(" + " OR ".join(f"contains({text}, '{k}')" for k in keywords) + ")" if keywords else "false"


def count_of(text: str, keyword: str) -> str:
    return f"((length({text}) - length(replace({text}, '{keyword}', ''))) // {len(keyword)})"


def strict(keywords, title: str = "lower(title)", body: str = "lower(description)") -> str:
    return "(" + " OR ".join(f"contains({title}, '{k}') OR {count_of(body, k)} >= 2" for k in keywords) + ")"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda x: x <> '')"


def short(text: str) -> str:
    return f"CASE WHEN len({words(text)}) <= 50 THEN {text} ELSE array_to_string({words(text)}[1:50], ' ') || '...' END"


def trim(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def decoded(text: str) -> str:
    for entity, char in DECODED.items():
        text = f"replace({text}, '{entity.replace(chr(39), chr(39) * 2)}', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


LINES = """lines AS (SELECT event_id AS pos, event_id % 10 AS kind, CASE event_id % 10 WHEN 0 THEN '{"k":' WHEN 1 THEN '{"_manifest": true, "k": 5}' WHEN 2 THEN '[1]' WHEN 4 THEN '{"_meta": false, "k": 7}' ELSE props END AS line
  FROM events WHERE event_id % 10 <> 3)"""
MARKED_UP = "regexp_replace(html || '<p>Caf&eacute; &#8217;&mdash; it&#x27;s &amp;lt; &nbsp;&frac12;</p>', '<[^>]+>', ' ', 'g')"
BOTH = "lower(title || ' ' || description)"
A, B = TOPICS["a"], TOPICS["b"]
INVERTED = "translate({}, '0123456789', '9876543210')"
TOPIC_CLEAN = f"""WITH {ARTICLES}, kept AS (SELECT * REPLACE ({short('description')} AS description) FROM articles
  WHERE lower(language) = 'en' AND {any_of(A['broad'], BOTH)} AND NOT {any_of(A['exclude'], BOTH)}),
strict AS (SELECT * FROM kept WHERE {strict(A['strict'])}),
first AS (SELECT * FROM strict QUALIFY row_number() OVER (PARTITION BY url ORDER BY pos) = 1)
SELECT media_url, title, description, publish_date, url, 'a' AS my_topic, {INVERTED.format('publish_date')} AS order_day, md5(url) AS order_url FROM first"""


def topic_counts(name: str) -> str:
    t = TOPICS[name]
    loose, tight = any_of(t["broad"], BOTH), strict(t["strict"])
    rest = f"{loose} AND {tight}"
    return f"SELECT '{name}' AS topic, count(*) FILTER ({loose}) AS n_loose, count(*) FILTER ({rest}) AS n_strict, count(*) FILTER ({rest} AND media_url <> 'src3' AND language = 'en') AS n_kept FROM articles"


REASONS = f"""WITH {LABELLED}, given AS (SELECT pos, CASE WHEN pos % 23 = 5 THEN '' ELSE url END AS url,
    coalesce(quality = 1, pos % 2 = 0) AS ok, pos % 7 <> 0 AS indexed, lower(language) = 'en' AS english,
    {any_of([*A['broad'], 'ation'], BOTH)} AND NOT {any_of(A['exclude'], BOTH)} AS broad,
    {strict([*A['strict'], 'ation'], body='lower(short)')} AS strict FROM (SELECT *, {short('description')} AS short FROM labelled)),
firsts AS (SELECT url, min(pos) AS first FROM given WHERE ok AND url <> '' AND indexed AND english AND broad AND strict GROUP BY url),
reasons AS (SELECT pos, CASE WHEN NOT ok THEN 'not_success' WHEN url = '' THEN 'missing_url' WHEN pos > first THEN 'already_exists' WHEN NOT indexed THEN 'missing_in_index'
  WHEN NOT english THEN 'non_english' WHEN NOT broad THEN 'off_topic' WHEN NOT strict THEN 'not_relevant' ELSE 'added' END AS reason FROM given LEFT JOIN firsts USING (url))"""

ORACLES = {
    "topic_clean": TOPIC_CLEAN,
    "published_head": f"SELECT * FROM ({TOPIC_CLEAN}) ORDER BY order_day, order_url LIMIT 20",
    "topic_loose_any": f"WITH {ARTICLES} SELECT pos, url FROM articles WHERE {any_of([*A['broad'], *B['broad']], BOTH)}",
    "topic_multi_counts": f"WITH {ARTICLES} {topic_counts('a')} UNION ALL {topic_counts('b')}",
    "strict_title_only": f"WITH {ARTICLES} SELECT pos, url FROM articles WHERE {any_of(A['strict'], 'lower(title)')}",
    "strict_documented": f"WITH {ARTICLES} SELECT pos, url FROM articles WHERE {strict(A['strict'])}",
    "dedupe_first_wins": f"WITH {ARTICLES} SELECT min(pos) AS pos, url FROM articles GROUP BY url",
    "dedupe_after_filter": f"WITH {ARTICLES} SELECT min(pos) AS pos, url FROM articles WHERE language = 'en' AND url NOT IN (SELECT url FROM articles WHERE media_url = 'src0') GROUP BY url",
    "distinct_urls": f"WITH {ARTICLES} SELECT url, min(pos) AS first_pos FROM articles GROUP BY url",
    "lookup_last_wins": f"WITH {ARTICLES}, listing AS (SELECT url, max(pos) AS listing, arg_max(publish_date, pos) AS listed FROM articles WHERE language <> 'fr' GROUP BY url) SELECT pos, url, listed, listing FROM articles LEFT JOIN listing USING (url)",
    "integrity_missing": f"WITH {ARTICLES} SELECT pos, url FROM articles WHERE pos NOT IN (SELECT doc_id FROM labels)",
    "anti_new_records": f"WITH {ARTICLES} SELECT pos, url, title FROM articles a WHERE pos % 2 = 0 OR (pos % 2 = 1 AND NOT EXISTS (SELECT 1 FROM articles b WHERE b.pos % 2 = 0 AND b.url = a.url))",
    "merge_override": f"WITH {ARTICLES} SELECT pos, media_url, CASE WHEN l.doc_id IS NULL THEN language WHEN quality = 1 THEN 'good' END AS quality_text FROM articles LEFT JOIN labels l ON l.doc_id = pos",
    "filter_waterfall": f"{REASONS} SELECT reason, count(*) AS n FROM reasons GROUP BY reason",
    "filter_reasons": f"{REASONS} SELECT pos, reason FROM reasons",
    "outlet_counts": f"WITH {ARTICLES} SELECT coalesce(nullif(media_url, 'src3'), 'unknown') AS outlet, count(*) AS n FROM articles GROUP BY 1",
    "date_counts": "SELECT CASE WHEN user_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d') ELSE 'unknown' END AS day, count(*) AS n FROM events GROUP BY 1",
    "conditional_counts": f"WITH {LABELLED} SELECT count(*) AS total, count(*) FILTER (quality = 1) AS success, count(*) FILTER (language = 'en') AS english, count(*) FILTER (language <> 'en') AS other, count(*) FILTER ({any_of(A['broad'], BOTH)}) AS on_topic FROM labelled",
    "length_stats": f"WITH {ARTICLES} SELECT avg(length(description)) AS avg_description, min(length(description)) AS min_description, max(length(description)) AS max_description, avg(length(title)) AS avg_title FROM articles",
    "outlet_mean_words": f"WITH {ARTICLES} SELECT media_url AS outlet, count(*) AS n, avg(len({words('description')})) AS mean_words FROM articles GROUP BY 1",
    "date_range": "SELECT min(d) AS first_day, max(d) AS last_day, count(DISTINCT d) AS n_days, count(*) AS n FROM (SELECT CASE WHEN user_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS d FROM events)",
    "completeness": f"WITH {ARTICLES} SELECT " + ", ".join(f"count(*) FILTER (coalesce({c}, '') = '') AS no_{c}" for c in ("title", "url", "publish_date", "media_url", "description")) + " FROM articles",
    "duplicate_report": f"WITH {ARTICLES} SELECT url, count(*) AS n FROM articles WHERE url <> '' GROUP BY url HAVING count(*) > 1 ORDER BY n DESC, url LIMIT 5",
    "publication_rank": f"SELECT event_id, {INVERTED.format(chr(39).join(['CASE WHEN user_id % 17 <> 0 THEN strftime(ts, ', '%Y-%m-%d', ') ELSE ', '0000-00-00', ' END']))} AS order_day, md5('https://e/' || event_id) AS order_url FROM events",
    "top_n_outlets": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20",
    "per_outlet_head": "SELECT event_type, event_id, user_id, (row_number() OVER (PARTITION BY event_type ORDER BY event_id))::INTEGER AS rank FROM events QUALIFY rank <= 3",
    "histogram_rows": "WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1) SELECT day, n, repeat('█', greatest(1, floor(n / (SELECT max(n) FROM c) * 40)::INTEGER)) AS bar FROM c",
    "outlet_day_counts": "SELECT event_type AS outlet, ts::DATE AS day, count(*) AS have FROM events GROUP BY ALL",
    "coverage_gaps": f"WITH {DAYS}, ends AS (SELECT min(day) AS a, max(day) AS b FROM days WHERE outlet = 'click') SELECT d::DATE AS day FROM ends, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g(d) WHERE d::DATE NOT IN (SELECT day FROM days WHERE outlet = 'click')",
    "dates_to_collect": f"WITH {DAYS} SELECT d::DATE AS day FROM unnest(generate_series(DATE '2023-12-28', DATE '2024-02-02', INTERVAL 1 DAY)) AS g(d) WHERE d::DATE NOT IN (SELECT day FROM days WHERE outlet = 'click')",
    "completeness_status": f"""WITH {EXPECTED}, grid AS (SELECT d::DATE AS day FROM unnest(generate_series(DATE '2023-12-30', DATE '2024-01-31', INTERVAL 1 DAY)) AS g(d)),
got AS (SELECT day, sum(have)::BIGINT AS downloaded FROM have GROUP BY day), want AS (SELECT day, sum(expected)::BIGINT AS total, max((expected < 0)::INTEGER) AS bad FROM expected GROUP BY day),
rows_ AS (SELECT day, coalesce(downloaded, 0) AS downloaded, CASE WHEN bad = 0 THEN total END AS available FROM grid LEFT JOIN got USING (day) LEFT JOIN want USING (day))
SELECT *, CASE WHEN available IS NULL THEN 'unknown' WHEN downloaded >= available THEN 'complete' WHEN downloaded > 0 THEN 'partial' ELSE 'missing' END AS status FROM rows_
UNION ALL SELECT NULL, sum(downloaded)::BIGINT, sum(available)::BIGINT, 'total' FROM rows_""",
    "completed_pairs": f"WITH {EXPECTED} SELECT day, outlet FROM completed",
    "work_left": f"WITH {EXPECTED} SELECT d::DATE AS day, outlet FROM unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS g(d), (VALUES ('click'), ('purchase'), ('nowhere')) AS v(outlet) WHERE (d::DATE, outlet) NOT IN (SELECT (day, outlet) FROM completed)",
    "manifest_daily_runs": "SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS count, arg_min(event_id, (ts, event_id)) AS first_run, arg_max(event_id, (ts, event_id)) AS last_run, arg_min(outlet, (ts, event_id)) AS mode FROM (SELECT event_id, ts, ts::DATE AS day, event_type AS outlet FROM events) AS d GROUP BY d.day",
    "store_header": f"WITH {ARTICLES} SELECT 'a' AS topic, count(*) AS record_count, string_agg(DISTINCT publish_date, ',' ORDER BY publish_date) AS dates_collected, min(publish_date) AS start_day, max(publish_date) AS end_day FROM articles",
    "page_domain": "SELECT page_id, coalesce(nullif(replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'www.', ''), ''), 'unknown') AS domain FROM pages",
    "page_title": f"SELECT page_id, {trim(chr(39).join(['regexp_extract(html, ', '<title>([^<]*)</title>', ', 1)']))} AS title FROM pages",
    "strip_html": f"""SELECT page_id, {trim(f"regexp_replace({decoded(MARKED_UP)}, '{SPACE}+', ' ', 'g')")} AS body FROM pages""",
    "snapshot_argmax": f"WITH {VERSIONS} SELECT version, n FROM versions ORDER BY n DESC, idx LIMIT 1",
    "data_loss": f"WITH {VERSIONS}, c AS (SELECT arg_min(n, idx) AS current, max(n) AS largest FROM versions) SELECT current, largest, largest > 2 * current AS lost, (SELECT min(idx) FROM versions WHERE n > 1.5 * current) AS first_larger FROM c",
    "truncate_words": f"WITH {ARTICLES} SELECT pos, {short('description')} AS short, len({words('description')}) AS n_words FROM articles",
    "keyword_counts": f"WITH {ARTICLES} SELECT pos, {count_of('lower(description)', 'the')} AS n_the, {count_of('lower(description)', 'ere')} AS n_ere FROM articles",
    "query_hash": f"""WITH {ARTICLES}, named AS (SELECT *, replace(replace(replace(replace(replace(url, 'www.', ''), '.com', ''), '.org', ''), '.co.uk', ''), '.net', '') AS name_ FROM articles)
SELECT pos, substr(md5(title), 1, 12) AS query, sha256(url) AS id, CASE WHEN length(title) > 100 THEN substr(title, 1, 100) || '...' ELSE title END AS preview,
CASE WHEN length(name_) > 25 THEN substr(name_, 1, 22) || '...' ELSE name_ END AS name FROM named""",
    "recency_cutoff": """SELECT event_id, CASE WHEN event_id % 6 <> 2 THEN strftime(ts, '%Y-%m-%d') END AS publish_date FROM events WHERE event_id % 6 = 2 OR
  CASE WHEN event_id % 6 = 5 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END + (CASE event_id % 6 WHEN 0 THEN 300 WHEN 4 THEN -330 ELSE 0 END) * INTERVAL 1 MINUTE >= TIMESTAMP '2024-01-20 00:00:00'""",
    "recovery_merge": f"WITH {ARTICLES}, both_ AS (SELECT pos, url, 0 AS src FROM articles WHERE language = 'en' UNION ALL SELECT pos, url, 1 FROM articles) SELECT pos, url, src FROM both_ QUALIFY row_number() OVER (PARTITION BY url ORDER BY src, pos) = 1",
    "outlet_attribution": f"WITH {ARTICLES} SELECT pos, CASE WHEN contains(media_url, 'src1') THEN 'src1' WHEN contains(media_url, 'src15') THEN 'src15' WHEN contains(media_url, '5') THEN '5' END AS outlet FROM articles",
    "raw_records": f"""WITH {ARTICLES} SELECT sha256(url) AS id, NULL::VARCHAR AS indexed_date, 'en' AS language, media_url AS media_name, media_url, publish_date, title, url, description, 'rss' AS collected_with,
  '2024-02-01T00:00:00+00:00' AS collected_at, url AS final_url, NULL::INTEGER AS http_status, true AS success, NULL::VARCHAR AS error, NULL::VARCHAR AS scraped_at FROM articles""",
    "pending_urls": f"WITH {ARTICLES} SELECT pos, url FROM articles WHERE url NOT IN (SELECT url FROM articles WHERE language = 'de')",
    "conversation_roles": f"SELECT role, count(*) AS n, sum(len({words('text')}))::BIGINT AS n_words, count(*) FILTER (turn = 0) AS n_first FROM conversations GROUP BY role",
    "revision_stats": "SELECT doc_id::VARCHAR AS version, 'clean.jsonl' AS file, length(text) - length(replace(text, chr(10), '')) AS lines, octet_length(encode(text)) AS bytes FROM documents",
    "jsonl_props": "SELECT event_id AS pos, (props->>'k')::BIGINT AS k FROM events",
    "rss_items": f"SELECT page_id AS source, i AS pos, 'Story ' || (i + 1) AS title, url || '#' || (i + 1) AS url, '2024-01-02' AS publish_date, 'Text' AS summary FROM pages, unnest(range(CASE WHEN page_id % 2 = 0 THEN 2 ELSE 1 END)) AS u(i)",
    "jsonl_modes": f"""WITH {LINES} SELECT pos, CASE WHEN kind = 4 THEN 7 WHEN kind > 4 THEN (line->>'k')::BIGINT END AS k, CASE WHEN kind = 0 THEN line END AS corrupt, CASE WHEN kind = 2 THEN line END AS value
  FROM lines WHERE kind <> 1""",
    "jsonl_dropped": f"WITH {LINES} SELECT pos, CASE kind WHEN 1 THEN 5 WHEN 4 THEN 7 ELSE (line->>'k')::BIGINT END AS k FROM lines WHERE kind NOT IN (0, 2)",
    "jsonl_bad_lines": f"WITH {LINES} SELECT pos, pos + 1 AS number, line FROM lines WHERE kind = 0",
    "jsonl_files": f"WITH {ARTICLES} SELECT pos, url, title FROM articles",
    "jsonl_ordered": f"WITH {ARTICLES} SELECT publish_date, count(*) AS n, arg_min(url, md5(url)) AS first_url, arg_max(url, md5(url)) AS last_url FROM articles GROUP BY publish_date",
    "jsonl_split": """WITH l AS (SELECT doc_id, i - 1 AS pos, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))[i] AS line FROM documents, unnest(range(1, length(text) - length(replace(text, chr(10), '')) + 2)) AS u(i))
SELECT doc_id, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM l WHERE trim(line) <> '' GROUP BY doc_id""",
    "header_line": "SELECT n_name AS topic FROM nation WHERE n_nationkey = 0",
    "story_document": "SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pos, n_nationkey::BIGINT AS k, n_name AS name FROM nation",
    "input_urls": "SELECT replace(url, '\"', '') AS url FROM pages",
    "listed_ids": "SELECT DISTINCT 'u' || user_id AS id FROM events WHERE user_id % 7 <> 0",
    "merged_header": """SELECT n_nationkey::BIGINT AS file, 0::BIGINT AS pos, '{"_manifest": true, "n": ' || n_nationkey || '}' AS line FROM nation UNION ALL SELECT n_nationkey, 1, n_name FROM nation
UNION ALL SELECT n_nationkey, 2, upper(n_name) FROM nation WHERE n_nationkey % 2 = 1""",
    "date_labels": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M UTC') AS utc, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(greatest(DATE '2024-01-10', ts::DATE - 6), '%Y-%m-%d') AS window_start FROM events",
    "frequent_first_seen": "SELECT bucket, n FROM (SELECT user_id % 100 AS bucket, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1 ORDER BY n DESC, first LIMIT 30)",
    "outlets_and_more": """WITH c AS (SELECT 'u' || user_id AS outlet, count(*) AS n FROM events GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, outlet)::INTEGER AS rank FROM c)
SELECT outlet, n, rank FROM r WHERE rank <= 10 UNION ALL SELECT '+' || (count(*)) || ' more', sum(n)::BIGINT, 11 FROM r WHERE rank > 10 HAVING count(*) > 0""",
    "day_ranks": """WITH d AS (SELECT DISTINCT CASE WHEN user_id % 19 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events)
SELECT day, row_number() OVER (ORDER BY day <> 'unknown', day) AS place, row_number() OVER (ORDER BY day DESC) AS newest FROM d""",
    "first_rows": "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 25",
    "latest_snapshot": f"WITH {ALL_VERSIONS} SELECT version FROM versions ORDER BY version DESC, idx LIMIT 1",
    "third_revision": f"WITH {ALL_VERSIONS} SELECT version, n FROM versions ORDER BY idx LIMIT 1 OFFSET 2",
    "checked_positions": """WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT user_id, n, p AS position FROM c, unnest(range(n)) AS u(p)
WHERE n <= 5 OR p IN (0, n - 1) OR (n <= 10 AND p = 5) OR (n > 10 AND p IN (10, n // 2))""",
    "revision_range": "SELECT event_id FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-10'",
    "line_changes": """WITH l AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(string_split(replace(coalesce(text, ''), chr(10), ' '), ' ')) AS w FROM conversations) GROUP BY ALL),
pairs AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn + 1) AS turn, coalesce(a.n, 0) - coalesce(b.n, 0) AS more FROM l a FULL JOIN l b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1 AND a.w = b.w)
SELECT conv_id || '/' || turn AS version, conv_id::VARCHAR AS file, sum(greatest(more, 0))::BIGINT AS added, sum(greatest(-more, 0))::BIGINT AS deleted FROM pairs JOIN (SELECT DISTINCT conv_id, turn FROM conversations) USING (conv_id, turn) GROUP BY conv_id, turn""",
    "file_at_version": "SELECT conv_id::VARCHAR AS file, length(text) AS size FROM conversations WHERE turn = 1",
    "manifest_update": f"""WITH {DAYS}, d AS (SELECT DISTINCT day FROM days WHERE outlet = 'click'), ends AS (SELECT max(day) AS b FROM d)
SELECT 'a' AS topic, 42::BIGINT AS record_count, (SELECT strftime(b, '%Y-%m-%d') FROM ends) AS end_day, (SELECT string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day) FROM d) AS days,
  (SELECT coalesce(string_agg(strftime(g, '%Y-%m-%d'), ',' ORDER BY g), '') FROM ends, unnest(generate_series(DATE '2024-01-01', b, INTERVAL 1 DAY)) AS s(g) WHERE g::DATE NOT IN (SELECT day FROM d)) AS gaps,
  2::BIGINT AS runs, '06:00:00Z' AS first_run, '18:30:00Z' AS last_run, 'automated' AS mode""",
    "manifest_empty": "SELECT 'a' AS topic, 0::INTEGER AS record_count, 0::BIGINT AS n_days, '2024-01-01' AS start_day, 0::BIGINT AS n_gaps",
    "checkpoint_state": f"""WITH {EXPECTED}, done AS (SELECT outlet, strftime(day, '%Y-%m-%d') AS day FROM completed WHERE outlet = 'click'), known AS (SELECT outlet, strftime(day, '%Y-%m-%d') AS day, expected FROM expected WHERE expected >= 0)
SELECT coalesce(d.outlet, k.outlet) AS outlet, coalesce(d.day, k.day) AS day, d.day IS NOT NULL AS complete, expected FROM done d FULL JOIN known k ON d.outlet = k.outlet AND d.day = k.day""",
    "pairs_to_count": f"WITH {EXPECTED} SELECT DISTINCT event_type AS outlet, strftime(ts, '%Y-%m-%d') AS day FROM events e WHERE NOT EXISTS (SELECT 1 FROM expected x WHERE x.outlet = e.event_type AND x.day = e.ts::DATE AND x.expected >= 0)",
    "enriched": f"""WITH {ARTICLES}, last AS (SELECT url, arg_max(upper(title), pos) AS title_ FROM articles WHERE language = 'en' GROUP BY url)
SELECT pos, CASE WHEN pos % 13 <> 0 THEN a.url END AS url, pos % 13 <> 0 AS success, CASE WHEN pos % 13 <> 0 AND last.url IS NOT NULL THEN title_ ELSE title END AS title, CASE WHEN pos % 13 = 0 THEN 'missing url' END AS error FROM articles a LEFT JOIN last ON last.url = a.url""",
    "outlet_success": f"WITH {LABELLED} SELECT media_url AS outlet, count(*) AS n, count(*) FILTER (coalesce(quality = 1, false)) AS ok, count(*) FILTER (NOT coalesce(quality = 1, false)) AS failed FROM labelled GROUP BY 1",
    "top_terms": "SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS term FROM benchmark) GROUP BY term ORDER BY n DESC, term LIMIT 25",
    "lang_detect": f"""WITH {ARTICLES}, t AS (SELECT pos, language, {trim("title || ' ' || description")} AS w FROM articles),
l AS (SELECT pos, language, length(w) AS n, lower(regexp_replace(w, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS w FROM t),
c3 AS (SELECT pos, language, n, string_split(w, '') AS c FROM l),
g AS (SELECT pos, language, n, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM c3),
counts AS (SELECT language, gram, count(*) AS n FROM g WHERE language IS NOT NULL GROUP BY ALL), totals AS (SELECT language, sum(n) AS total FROM counts GROUP BY 1),
best AS (SELECT DISTINCT gram FROM (SELECT gram FROM counts QUALIFY row_number() OVER (PARTITION BY language ORDER BY n DESC, gram) <= 2000)),
shares AS (SELECT b.gram, x.language, ln((coalesce(c.n, 0) + 1) / (x.total + 2000)) AS s FROM best b CROSS JOIN totals x LEFT JOIN counts c ON c.gram = b.gram AND c.language = x.language),
scores AS (SELECT pos, s.language, sum(s) AS score FROM g JOIN shares s USING (gram) WHERE g.n >= 20 GROUP BY ALL),
found AS (SELECT pos, arg_max(language, (round(score, 6), language)) AS language FROM scores GROUP BY pos)
SELECT pos, coalesce(found.language, 'en') = 'en' AS english FROM t LEFT JOIN found USING (pos)""",
    "store_batches": """SELECT 'https://e/' || (user_id % 700) || '/' || event_type AS url, arg_min(event_id, ((day(ts) - 1) // 8, event_id)) AS pos FROM events GROUP BY 1""",
    "store_versions": f"""WITH {ARTICLES}, c AS (SELECT language, count(*) AS n FROM articles GROUP BY 1)
SELECT v::BIGINT AS version, language, n FROM c, (VALUES (1), (2), (3), (4)) AS t(v) WHERE v IN (2, 4) OR (v = 1 AND language = 'en') OR (v = 3 AND language = 'de')""",
    "collection_stream": f"""WITH {EXPECTED}, known AS (SELECT outlet, strftime(day, '%Y-%m-%d') AS day, expected FROM expected WHERE expected >= 0), done AS (SELECT outlet, strftime(day, '%Y-%m-%d') AS day FROM completed WHERE outlet = 'click')
SELECT 'a' AS topic, coalesce(d.outlet, k.outlet) AS outlet, coalesce(d.day, k.day) AS day, d.day IS NOT NULL AS complete, expected FROM done d FULL JOIN known k ON d.outlet = k.outlet AND d.day = k.day
UNION ALL SELECT 'b', outlet, day, false, expected FROM known""",
    "revision_diffs": """WITH l AS (SELECT conv_id, turn, string_split(replace(coalesce(text, ''), ' ', chr(10)), chr(10)) AS w FROM conversations),
p AS (SELECT b.conv_id, b.turn, coalesce(a.w, []) AS a, b.w AS b FROM l b LEFT JOIN l a ON a.conv_id = b.conv_id AND a.turn = b.turn - 1),
d AS (SELECT *, list_last(list_reduce(b, lambda before, y: list_reduce(range(1, len(a) + 1), lambda acc, i: list_append(acc, CASE WHEN a[i] = y THEN before[i] + 1 ELSE greatest(before[i + 1], acc[len(acc)]) END), [0]::BIGINT[]), list_transform(range(len(a) + 1), lambda i: 0::BIGINT))) AS same FROM p)
SELECT conv_id || '/' || turn AS version, conv_id::VARCHAR AS file, len(b) - same AS added, len(a) - same AS deleted FROM d""",
    "history_at": "SELECT conv_id::VARCHAR AS file, conv_id || '/' || turn AS version, md5(replace(coalesce(text, ''), ' ', chr(10))) AS digest FROM conversations QUALIFY max(turn) OVER (PARTITION BY conv_id) - turn = 2",
    "keys_within": f"WITH {ARTICLES}, k AS (SELECT DISTINCT unnest(string_split(coalesce(text, ''), ' ')) AS word FROM benchmark) SELECT DISTINCT pos, word FROM articles, k WHERE word <> '' AND contains(title, word)",
    "sampled_rows": "SELECT event_id, user_id FROM events ORDER BY md5('7|' || event_id), event_id LIMIT 50",
    "sampled_by_type": "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('7|' || event_id), event_id) <= 20",
    "filter_counters": f"{REASONS} SELECT reason, count(*) AS n FROM reasons GROUP BY reason",
    "day_folders": "SELECT ts::DATE AS day, event_type, count(*) AS n, min(event_id) AS first_id FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-08' GROUP BY ALL",
    "written_document": f"WITH {ARTICLES} SELECT url, language FROM articles",
    "json_documents": """SELECT 0::BIGINT AS pos, replace(url, '"', '') AS url, CASE WHEN page_id % 5 IN (0, 3) THEN 't' END AS title FROM pages WHERE page_id % 5 < 4
UNION ALL SELECT 1, replace(url, '"', ''), 't' FROM pages WHERE page_id % 5 = 1""",
    "html_meta": f"""WITH p AS (SELECT page_id, {trim(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} AS t FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'Story ' || page_id ELSE nullif(t, '') END AS title, CASE page_id % 3 WHEN 0 THEN 'About ' || page_id || ' & more' WHEN 1 THEN 'On ' || page_id END AS description FROM p""",
}
