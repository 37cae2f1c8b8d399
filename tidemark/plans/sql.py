"""DuckDB SQL of the queries in tidemark.plans.queries that SQL can express."""

from tidemark.plans import goldens, more

TEXT = r"trim(regexp_replace(regexp_replace({}, '<[^>]+>', ' ', 'g'), '[\s　]+', ' ', 'g'))"


def _found(rank: int, origin: str, pattern: str) -> str:
    return f"SELECT page_id, {rank} AS rank, '{origin}' AS origin, unnest(x) AS raw, generate_subscripts(x, 1) - 1 AS ord FROM (SELECT page_id, regexp_extract_all(html, '{pattern}', 1) AS x FROM pages)"


PAGE_CANDIDATES = f"""
WITH found AS (
  SELECT * FROM ({_found(0, "title", "(?is)<title[^>]*>(.*?)</title>")}) WHERE ord = 0
  {" ".join("UNION ALL " + _found(n, f"h{n}", f"(?is)<h{n}[^>]*>(.*?)</h{n}>") for n in (1, 2, 3, 4))}
  UNION ALL {_found(5, "anchor", "(?is)<a[ >][^>]*>(.*?)</a>").replace("<a[ >][^>]*>", "<a(?:[ ][^>]*)?>")}
  UNION ALL {_found(6, "table", "(?is)<t[dh](?:[ ][^>]*)?>(.*?)</t[dh]>")}
  UNION ALL (SELECT page_id, rank, origin, raw, row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS ord
             FROM ({_found(8, "list_item", "(?is)<li(?:[ ][^>]*)?>(.*?)</li>")}) WHERE length(raw) < 200 AND NOT contains(raw, '<li'))
), texts AS (SELECT page_id, rank, ord, origin, {TEXT.format("raw")} AS text FROM found),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id, text ORDER BY rank, ord) AS r FROM texts WHERE length(text) BETWEEN 2 AND 30)
SELECT page_id, origin, text, ord::BIGINT AS ord FROM ranked WHERE r = 1
"""

PAGE_LINKS = f"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '(?is)<a [^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a [^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS l FROM pages),
r AS (SELECT page_id, unnest(h) AS raw, unnest(l) AS lab, generate_subscripts(h, 1) - 1 AS ord FROM x),
t AS (SELECT page_id, ord, trim(raw) AS href, {TEXT.format("lab")} AS label FROM r),
b AS (SELECT *, label || ' ' || lower(regexp_extract(href, '^([^?#]*)', 1)) AS blob FROM t WHERE href <> '' AND NOT regexp_matches(lower(href), '^(javascript:|mailto:|tel:|#)'))
SELECT page_id, ord::BIGINT AS ord, href, label,
  CASE WHEN regexp_matches(blob, '(?i)login|contact|/la$') THEN 90 WHEN regexp_matches(blob, '(?i)^the|^and') THEN 0 WHEN regexp_matches(blob, '(?i)tion|ment') THEN 1 ELSE 5 END::BIGINT AS priority FROM b
"""


def _key(name: str) -> str:
    """dedup_key with RE2's ASCII classes spelled out."""
    for pattern in (
        r"[（(][\s　]*[ぁ-ゖァ-ヺー\s　]+[\s　]*[)）]",
        r"^(?:[0-9０-９]{1,2}月(?:[0-9０-９]{1,2}日)?(?:[（(][^）)]*[）)])?|[0-9０-９]{1,2}[/／.][0-9０-９]{1,2}|[0-9０-９]{1,2}日(?:[（(][^）)]*[）)])?)[\s　]*",
        r"第[\s　]*[0-9０-９一二三四五六七八九十百]+[\s　]*回[\s　]*",
        r"(?:令和|平成|R|H)[\s　]*[0-9０-９]+(?:[（(]20[0-9][0-9][）)])?[\s　]*年?度?|20[0-9][0-9][\s　]*年?度?",
        r"[\s　・,、。!！?？''\"()（）「」【】〜～~]",
    ):
        name = f"regexp_replace({name}, '{pattern}', '', 'g')"
    kata, hira = "".join(map(chr, range(0x30A1, 0x30F7))), "".join(map(chr, range(0x3041, 0x3097)))
    return f"replace(replace(translate({name}, '{kata}', '{hira}'), '祭り', '祭'), 'まつり', '祭')"


DEDUP_KEY_GROUPS = f"""
SELECT md5({_key("name")}) AS k, count(*) AS n_rows, count(DISTINCT name) AS n_names
FROM (SELECT text AS name FROM documents UNION ALL SELECT p_name FROM part) GROUP BY 1
"""

MERGE_PREFIX_VARIANTS = """
WITH rows AS (SELECT DISTINCT 'part' AS family, p_brand AS k FROM part UNION SELECT 'documents', source FROM documents UNION SELECT 'nation', n_name FROM nation)
SELECT a.family, a.k, coalesce(arg_min(b.k, length(b.k)), a.k) AS target
FROM rows a LEFT JOIN rows b ON a.family = b.family AND a.k <> b.k AND length(b.k) >= 4 AND starts_with(a.k, b.k) GROUP BY a.family, a.k
"""

REPRESENTATIVE = """
WITH c AS (SELECT {g}, {n}, count(*) AS c, min({o}) AS o, max({own})::INT AS own FROM {t} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY 1 - own, -c, length({n}), o) AS r, count(*) OVER (PARTITION BY {g}) AS n_names FROM c)
"""
REPRESENTATIVE_NAME = REPRESENTATIVE.format(g="p_brand", n="p_name", o="p_partkey", own="starts_with(p_name, 'old')", t="part") + "SELECT p_brand, p_name, n_names FROM r WHERE r = 1"

_PARTS = """(SELECT p_name AS grp, p_name || ' ' || p_size::VARCHAR AS name, p_partkey AS ord, p_brand, p_type,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS venue, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END AS date_text FROM part)"""
NORMALIZE_RECORDS = f"""{REPRESENTATIVE.format(g="grp", n="name", o="ord", own="ends_with(name, '7')", t=_PARTS)},
f AS (
  SELECT grp, coalesce(arg_min(venue, ord) FILTER (venue <> ''), '') AS venue, coalesce(arg_min(date_text, ord) FILTER (date_text <> ''), '') AS date_text,
    list_sort(list_distinct(list(p_brand))) AS urls, list_sort(list_distinct(list(p_type))) AS origins, substr(string_agg(p_type, ' ' ORDER BY ord), 1, 60) AS context,
    list_sort(list_distinct(list(name))) AS names FROM {_PARTS} GROUP BY grp
)
SELECT grp, name, array_to_string(list_filter(names, lambda x: x <> name), '|') AS aliases, array_to_string(urls[1:8], '|') AS source_urls, array_to_string(origins, '|') AS origins,
  array_to_string(urls, '|') AS reasons, venue, date_text, len(urls) AS source_count, context FROM r JOIN f USING (grp) WHERE r = 1
"""

DATE_CLASSIFICATION = """
WITH t AS (
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN year(o_orderdate)::VARCHAR || '年' || month(o_orderdate)::VARCHAR || '月' || day(o_orderdate)::VARCHAR || '日'
    WHEN 1 THEN '毎年' || month(o_orderdate)::VARCHAR || '月第2日曜日' WHEN 2 THEN month(o_orderdate)::VARCHAR || '月' || day(o_orderdate)::VARCHAR || '日'
    WHEN 3 THEN '毎年行われる' WHEN 4 THEN ' ' ELSE o_orderpriority END AS date_text FROM orders
), c AS (
  SELECT *, trim(date_text) AS t, regexp_matches(date_text, '令和[\\s　]*[0-9０-９]+[\\s　]*年|平成[\\s　]*[0-9０-９]+[\\s　]*年|[0-9０-９]{4}[\\s　]*年') AS y,
    regexp_matches(date_text, '毎年|例年|第[\\s　]*[0-9０-９一二三四五六七八九]|旧暦|上旬|中旬|下旬|春季|夏季|秋季|冬季|[月火水木金土日]曜') AS r,
    regexp_matches(date_text, '[月火水木金土日]曜|[0-9０-９]{1,2}[\\s　]*月|上旬|中旬|下旬|旧暦|[春夏秋冬]季') AS d, regexp_matches(date_text, '[0-9０-９]{1,2}[\\s　]*月') AS b FROM t
)
SELECT o_orderkey, date_text, CASE WHEN t <> '' AND NOT y AND r AND d THEN t END AS schedule,
  CASE WHEN t = '' THEN '' WHEN y THEN '情報源に特定年の日付として記載: ' || t WHEN r AND d THEN '' WHEN r THEN '例年の語はあるが日付が特定できない: ' || t
    WHEN b THEN '特定年の日程か例年の規則かは未確認: ' || t ELSE '日付表記を判別できず: ' || t END AS note FROM c
"""

CATEGORY_TAGS = """
WITH b AS (SELECT p_partkey, replace(p_name || ' ' || p_type, p_brand, '') AS b FROM part),
c AS (SELECT p_partkey, list_filter([CASE WHEN regexp_matches(b, 'bolt|rod|plate|ring') THEN 'hardware' END, CASE WHEN regexp_matches(b, 'gear|widget|gizmo') THEN 'machine' END,
  CASE WHEN contains(b, 'anvil') THEN 'forge' END, CASE WHEN regexp_matches(b, 'ECONOMY|PROMO') THEN 'budget' END, CASE WHEN regexp_matches(b, '^hot|red') THEN 'warm' END], lambda x: x IS NOT NULL) AS l FROM b)
SELECT p_partkey, CASE WHEN len(l) > 0 THEN array_to_string(l, '|') ELSE 'unclassified' END AS categories FROM c
"""

STABLE_HASH_IDS = """
SELECT c_custkey, lower(c_mktsegment) || '-n' || c_nationkey::VARCHAR || '-' || CASE WHEN c_custkey % 4 = 0 THEN trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-')
  ELSE 'x' || substr(sha1(lower(c_mktsegment) || '/n' || c_nationkey::VARCHAR || '/' || c_name), 1, 8) END AS id FROM customer
"""

ID_COLLISION = """
WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part)
SELECT p_partkey, slug, min(p_partkey) OVER (PARTITION BY slug) AS owner, min(p_partkey) OVER (PARTITION BY slug) = p_partkey AS keeps_slug FROM s
"""

UNIQUE_CONTAINMENT = """
WITH names AS (SELECT DISTINCT n FROM (SELECT lang AS n FROM documents UNION SELECT lower(r_name) FROM region UNION SELECT unnest(['thesh', 'quele', 'keit', 'ción', 'tionnt'])) WHERE n IS NOT NULL AND n <> ''),
w AS (SELECT doc_id, count(n) AS n_names, min(n) AS one FROM documents LEFT JOIN names ON contains(text, n) GROUP BY doc_id),
b AS (SELECT doc_id, count(n) AS n_bare, min(n) AS one FROM documents LEFT JOIN names ON length(n) > 2 AND contains(text, substr(n, 1, length(n) - 1)) GROUP BY doc_id)
SELECT doc_id, n_names, CASE WHEN n_names = 1 THEN w.one WHEN n_bare = 1 THEN b.one ELSE '(all)' END AS assigned FROM w JOIN b USING (doc_id)
"""

NAMES_BY_GRAM = """
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, text FROM documents),
names AS (SELECT lang, left(text, 8) AS name FROM docs WHERE text <> '' UNION SELECT lang, right(text, 6) FROM docs WHERE text <> ''),
hits AS (
  SELECT doc_id, count(*) FILTER (contains(text, name)) AS n_names, min(name) FILTER (contains(text, name)) AS one,
    count(*) FILTER (length(name) > 2) AS n_bare, min(name) FILTER (length(name) > 2) AS bare
  FROM docs JOIN names USING (lang) WHERE contains(text, name) OR (length(name) > 2 AND contains(text, left(name, length(name) - 1))) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_names, 0) AS n_names, CASE WHEN n_names = 1 THEN one WHEN n_bare = 1 THEN bare ELSE '(all)' END AS assigned FROM docs LEFT JOIN hits USING (doc_id)
"""
PLACE_RESOLUTION = """
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'nation-' WHEN 1 THEN 'NATION_' ELSE 'LAND_' END || s_nationkey::VARCHAR AS place FROM supplier)
SELECT s_suppkey, place, coalesce((SELECT n_name FROM nation WHERE n_name = place), (SELECT n_name FROM nation WHERE n_name = upper(replace(place, '-', '_'))), (SELECT n_name FROM nation WHERE n_name = upper(place)), '(all)') AS resolved FROM s
"""

MERGE_GUARD = """
WITH c AS (SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS seg, [substr(c_name, length(c_name) - 1, 2), substr(c_name, length(c_name) - 2, 3)] AS keys FROM customer),
known AS (SELECT DISTINCT nation, unnest(keys) AS k FROM c WHERE seg <> 'BUILDING'),
hit AS (SELECT DISTINCT id FROM (SELECT id, nation, unnest(keys) AS k FROM c WHERE seg IN ('BUILDING', 'MACHINERY')) JOIN known USING (nation, k))
SELECT id, nation, CASE WHEN seg <> 'BUILDING' THEN 'id_clash' WHEN id IN (SELECT id FROM hit) THEN 'name_clash' END AS guard FROM c WHERE seg IN ('BUILDING', 'MACHINERY')
"""

JUDGMENT_STATUS = """
WITH i AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'), v AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 11 = 0 THEN 'changed' ELSE o_orderpriority END AS p FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, CASE WHEN v.p IS NULL THEN 'missing' WHEN i.o_orderpriority IS NULL THEN 'extra' WHEN v.p IS DISTINCT FROM i.o_orderpriority THEN 'drift' ELSE 'ok' END AS status FROM i FULL JOIN v USING (o_orderkey)
"""

ALIAS_VALIDATION = """
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 1 THEN o_orderkey - 1 WHEN 2 THEN o_orderkey WHEN 3 THEN o_orderkey + 1 WHEN 4 THEN o_orderkey - 1 WHEN 5 THEN o_orderkey + 10000000 WHEN 6 THEN o_orderkey + 1 END AS alias,
  CASE WHEN o_orderkey % 3 = 0 THEN '(all)' ELSE o_orderstatus END AS place, CASE WHEN o_orderkey % 10 = 7 THEN 'drop' ELSE 'keep' END AS verdict FROM orders)
SELECT a.o_orderkey, a.alias, CASE WHEN t.o_orderkey IS NULL THEN 'unknown' WHEN a.alias = a.o_orderkey THEN 'self' WHEN a.place <> t.place AND a.place <> '(all)' AND t.place <> '(all)' THEN 'other_place'
  WHEN t.verdict <> 'keep' THEN 'not_kept' WHEN a.o_orderkey % 10 IN (3, 4) THEN 'cycle' END AS problem FROM r a LEFT JOIN r t ON t.o_orderkey = a.alias WHERE a.alias IS NOT NULL
"""

CLEANED_NAME_MERGE = """
WITH p AS (SELECT p_name, p_partkey AS id, p_name || ' ' || p_type AS name, [p_brand, p_type, p_brand || '-' || p_type][1:p_size % 3 + 1] AS urls FROM part),
m AS (SELECT p_name, list({'id': id, 'name': name, 'urls': urls} ORDER BY -len(urls), id) AS m FROM p GROUP BY p_name),
u AS (SELECT *, flatten(list_transform(m, lambda x: x.urls)) AS all_urls, list_transform(m, lambda x: x.name) AS names FROM m),
d AS (SELECT *, list_filter(all_urls, lambda x, i: list_position(all_urls, x) = i) AS du, list_filter(names, lambda x, i: list_position(names, x) = i AND x <> names[1]) AS dn FROM u)
SELECT p_name, m[1].id AS canonical, m[1].name AS name, array_to_string(dn, '|') AS aliases, len(du) AS source_count, array_to_string(du[1:8], '|') AS source_urls, len(m) AS members FROM d
"""

CONSUMER_CHECKS = """
WITH d AS (SELECT n_chars AS id, lang, CASE WHEN n_chars > 2000 THEN '' ELSE source END AS source, quality, coalesce(toxic = 1, false) AS marked FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'blank:lang' AS rule, count(*) FILTER (coalesce(lang, '') = '') AS n FROM d UNION ALL SELECT 'blank:source', count(*) FILTER (coalesce(source, '') = '') FROM d
UNION ALL SELECT 'blank:quality', count(*) FILTER (quality IS NULL) FROM d UNION ALL SELECT 'blank:marks', count(*) FILTER (NOT marked) FROM d
UNION ALL SELECT 'repeated:id', count(*) FROM (SELECT id FROM d GROUP BY id HAVING count(*) > 1)
"""

PUBLISHED_DEDUPE = """
WITH r AS (
  SELECT p_name, p_brand AS brand, p_partkey AS ord, 'a-' || CASE WHEN p_partkey % 3 = 0 THEN 'x' || lpad(lower(hex(p_partkey)), 8, '0') ELSE 'p' || p_partkey::VARCHAR END AS id, p_name || ' ' || p_partkey::VARCHAR AS name, p_type,
    [p_brand, p_type][1:p_size % 3] AS sources, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END AS venue, CASE WHEN p_size % 5 = 0 THEN p_retailprice END AS price, p_partkey % 97 = 0 AS curated, p_partkey % 3 = 0 AS hashed FROM part
), g AS (
  SELECT p_name, brand, count(*) AS merged, list({'id': id, 'name': name, 't': p_type, 's': sources, 'v': venue, 'p': price} ORDER BY hashed, -len(sources), ord) AS m FROM r GROUP BY p_name, brand HAVING count(*) > 1 AND NOT bool_or(curated)
), n AS (SELECT *, list_filter(list_distinct(flatten(list_transform(m, lambda x: [x.name, x.t]))), lambda x: x <> m[1].name) AS al, flatten(list_transform(m, lambda x: x.s)) AS so,
  list_filter(list_transform(m, lambda x: x.v), lambda x: x IS NOT NULL) AS vs, list_filter(list_transform(m, lambda x: x.p), lambda x: x IS NOT NULL) AS ps FROM g)
SELECT p_name, brand, m[1].id AS id, m[1].name AS name, array_to_string(list_sort(al), '|') AS aliases, array_to_string(list_filter(so, lambda x, i: list_position(so, x) = i), '|') AS sources,
  coalesce(vs[1], '') AS venue, ps[1] AS price, merged FROM n
"""

KNOWN_SET_NOVELTY = """
WITH d AS (SELECT lang, md5(text) AS k, doc_id FROM documents), u AS (SELECT DISTINCT lang, k FROM d),
a AS (SELECT DISTINCT lang, k FROM d JOIN labels USING (doc_id) WHERE quality = 1), b AS (SELECT DISTINCT lang, k FROM d JOIN labels USING (doc_id) WHERE toxic = 1),
f AS (SELECT u.lang, (a.k IS NOT NULL)::INT AS a, (b.k IS NOT NULL)::INT AS b FROM u LEFT JOIN a USING (lang, k) LEFT JOIN b USING (lang, k))
SELECT lang, count(*) AS total, sum(a)::BIGINT AS in_known, sum(b)::BIGINT AS in_other, count(*) FILTER (a + b = 0) AS new, floor(count(*) FILTER (a + b = 0) * 100 / greatest(1, count(*)))::BIGINT AS new_percent, grouping(lang)::BIGINT AS is_total FROM f GROUP BY ROLLUP (lang)
"""

GOLDEN_RECALL = """
WITH o AS (SELECT DISTINCT p_brand AS s, p_name AS k FROM part WHERE p_type IN ('ECONOMY', 'PROMO') UNION SELECT p_brand, reverse(p_name) FROM part WHERE p_type IN ('ECONOMY', 'PROMO')),
g AS (SELECT CASE WHEN p_size < 10 THEN 'core' ELSE 'notable' END AS tier, o.k IS NOT NULL AS hit FROM part LEFT JOIN o ON o.s = p_brand AND o.k = p_name)
SELECT tier, count(*) FILTER (hit) AS hits, count(*) AS total, floor(count(*) FILTER (hit) * 100 / greatest(1, count(*)))::BIGINT AS percent FROM g GROUP BY ROLLUP (tier)
"""

LOOSE_MATCH = """
WITH l AS (SELECT DISTINCT p_type, unnest([string_split(p_name, ' ')[1], substr(string_split(p_name, ' ')[1], 2, 2)]) AS t FROM part WHERE p_size > 20),
r AS (SELECT DISTINCT p_type, string_split(p_name, ' ')[2] AS t FROM part WHERE p_retailprice > 950 AND p_size < 12),
g AS (SELECT DISTINCT p_type, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS g FROM r WHERE length(t) >= 3)
SELECT DISTINCT l.p_type, l.t FROM l WHERE l.t <> '' AND (
  EXISTS (SELECT 1 FROM r WHERE r.p_type = l.p_type AND r.t <> '' AND (contains(l.t, r.t) OR contains(r.t, l.t)))
  OR EXISTS (SELECT 1 FROM g WHERE g.p_type = l.p_type AND contains(l.t, g.g)))
"""

VOCAB_TERMS = """
WITH t AS (SELECT p_brand, p_type, p_name, p_partkey, unnest(string_split_regex(p_name || '、' || p_type, '[、 ]')) AS term FROM part)
SELECT p_brand, term, CASE WHEN regexp_matches(term, 'gear|rod') THEN 'yes' ELSE 'no' END AS covered, count(*) AS source_count, array_to_string(list_sort(list_distinct(list(p_type))), '|') AS categories, arg_min(p_name, p_partkey) AS example
FROM t WHERE length(term) >= 2 AND term NOT IN ('old', 'new') AND term <> 'anvil' AND NOT contains(term, 'dge') AND NOT contains(term, 'PRO') AND NOT contains(term, 'anvil') GROUP BY p_brand, term
"""

COVERAGE_GAP = """
SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2 AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9500 OR s_acctbal < -500)
"""

POSITIONAL_ZIP = """
WITH s AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS ordinal, s_name FROM supplier), c AS (SELECT row_number() OVER (ORDER BY c_custkey) AS ordinal, c_name FROM customer)
SELECT ordinal, s_name, c_name FROM s FULL JOIN c USING (ordinal)
"""

_LEDGER = "(SELECT 'u' || user_id::VARCHAR AS host, strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, props::JSON->>'k' AS bytes FROM events)"
_HOSTS = f"""SELECT host, min(day) AS first, max(day) AS last, count(*) FILTER (kind = 'view') AS view, count(*) FILTER (kind = 'click') AS click, count(*) FILTER (kind = 'purchase') AS purchase,
  count(*) FILTER (kind = 'error' OR kind NOT IN ('view', 'click', 'purchase')) AS error, sum(CASE WHEN regexp_matches(bytes, '^[0-9]+$') THEN bytes::BIGINT ELSE 0 END)::BIGINT AS bytes FROM {_LEDGER} GROUP BY host"""
LEDGER_BY_DAY = f"""SELECT day, count(*) FILTER (kind = 'view') AS view, count(*) FILTER (kind = 'click') AS click, count(*) FILTER (kind = 'purchase') AS purchase, count(*) FILTER (kind = 'error') AS error,
  count(*) FILTER (kind IS NULL OR kind NOT IN ('view', 'click', 'purchase', 'error')) AS other FROM {_LEDGER} GROUP BY day"""
LEDGER_BY_GROUP = f"""
WITH h AS ({_HOSTS}), g AS (SELECT 'u' || c_custkey::VARCHAR AS host, c_mktsegment AS segment FROM customer WHERE c_acctbal > 3000)
SELECT coalesce(segment, 'unlabelled') AS segment, count(*) AS hosts, sum(view)::BIGINT AS fetch, sum(bytes)::BIGINT AS bytes FROM h LEFT JOIN g USING (host) WHERE view > 0 GROUP BY 1
"""
LEDGER_BACKFILL = """
WITH e AS (SELECT *, 'https://h/' || user_id::VARCHAR || '/' || event_id::VARCHAR AS url FROM events WHERE event_type = 'error')
SELECT strftime(ts, '%Y-%m-%d') AS ts, 'fail' AS kind, url, (event_id % 200 + 400)::VARCHAR AS status, '0' AS bytes, '' AS final_url, 'HTTP ' || (event_id % 200 + 400)::VARCHAR AS note FROM e WHERE url NOT IN (SELECT url FROM e WHERE value > 20)
"""

URL_SCOPE = r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
w AS (SELECT unnest(['north', 'south', 'east', 'west']) AS ward, unnest(['/en/', '/fr/', '/en/7', '/de/']) AS scope)
SELECT page_id, count(DISTINCT ward) AS n_scopes, CASE WHEN count(DISTINCT ward) = 1 THEN min(ward) END AS ward
FROM p LEFT JOIN w ON starts_with(path, scope) OR starts_with(regexp_extract(path, '^/[^/]+(/.*)$', 1), scope) GROUP BY page_id
"""
HOST_FIRST_SOURCE = "SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host, substr(sha1(url), 1, 8) AS page_hash FROM pages"
JUDGE_BATCHES = "SELECT o_orderkey, lpad(n::VARCHAR, 5, '0') AS id, (floor((n - 1) / 120) + 1)::INT AS batch_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS n FROM orders)"
CARRY_FORWARD = "SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), -1) AS last_user_turn FROM conversations"
NESTED_COUNTS = "SELECT lang, source, count(*) AS n, (2 - grouping(lang) - grouping(source))::BIGINT AS depth FROM documents GROUP BY ROLLUP (lang, source)"
FILTER_VIEW = r"SELECT lang, source, count(*) AS visible FROM documents WHERE lang = 'en' AND contains(regexp_replace(lower(text), '\s+', '', 'g'), 'thenea') GROUP BY lang, source"
REGISTRY_UNION = "SELECT nation, category, count(*) AS n, min(name) AS first_name FROM (SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS category FROM customer UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier) GROUP BY nation, category"
CATEGORY_TREE = """
WITH n AS (SELECT * FROM nation WHERE n_regionkey < 3)
SELECT 'r' || r_regionkey::VARCHAR AS node, 0::BIGINT AS depth FROM region WHERE r_regionkey < 3 UNION ALL SELECT 'n' || n_nationkey::VARCHAR, 1 FROM n UNION ALL SELECT 's' || s_suppkey::VARCHAR, 2 FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)
"""

VERDICT_CELLS = r"""
WITH c AS (
  SELECT o_orderkey, list_filter([CASE WHEN o_orderkey % 13 = 0 THEN 'id' ELSE lpad(o_orderkey::VARCHAR, 5, '0') END, ['KEEP', 'drop', 'unsure'][o_orderkey % 3 + 1], string_split(o_orderpriority, '-')[2],
    CASE o_orderkey % 4 WHEN 0 THEN lpad((o_orderkey % 1000)::VARCHAR, 5, '0') WHEN 1 THEN '' END, CASE WHEN o_orderkey % 5 = 0 THEN '日立市' END, CASE WHEN o_orderkey % 6 = 0 THEN 'つなび' END], lambda x: x IS NOT NULL) AS cells FROM orders
), r AS (SELECT *, list_filter(cells[2:], lambda x: x <> '') AS rest, regexp_full_match(cells[1], '[0-9]{4,6}') AS good FROM c),
p AS (SELECT *, list_filter(rest, lambda x: regexp_full_match(lower(x), 'keep|drop|unsure')) AS v, list_filter(rest, lambda x: regexp_full_match(x, '[0-9]{4,6}')) AS i,
  list_filter(rest, lambda x: regexp_full_match(x, '[ぁ-んゔー・\s　]+')) AS k, list_filter(rest, lambda x: regexp_full_match(x, '[^\s]+[市町村区]')) AS m FROM r)
SELECT o_orderkey, CASE WHEN good THEN cells[1] END AS id, CASE WHEN good THEN coalesce(lower(v[1]), '') END AS verdict,
  CASE WHEN good THEN coalesce(list_filter(rest, lambda x: NOT list_contains(v, x) AND NOT list_contains(i, x) AND NOT list_contains(k, x) AND NOT list_contains(m, x))[1], '') END AS reason,
  CASE WHEN good THEN coalesce(i[-1], '') END AS alias_of, CASE WHEN good THEN coalesce(m[-1], '') END AS municipality, CASE WHEN good THEN coalesce(k[-1], '') END AS reading FROM p
"""

ORACLES = {
    "page_candidates": PAGE_CANDIDATES, "page_links": PAGE_LINKS, "dedup_key_groups": DEDUP_KEY_GROUPS, "merge_prefix_variants": MERGE_PREFIX_VARIANTS, "representative_name": REPRESENTATIVE_NAME,
    "normalize_records": NORMALIZE_RECORDS, "date_classification": DATE_CLASSIFICATION, "category_tags": CATEGORY_TAGS, "stable_hash_ids": STABLE_HASH_IDS, "id_collision_resolution": ID_COLLISION,
    "unique_containment_assign": UNIQUE_CONTAINMENT, "names_by_rarest_gram": NAMES_BY_GRAM, "place_resolution": PLACE_RESOLUTION, "merge_guard_antijoin": MERGE_GUARD, "judgment_status": JUDGMENT_STATUS, "alias_validation": ALIAS_VALIDATION,
    "verdict_cells": VERDICT_CELLS, "cleaned_name_merge": CLEANED_NAME_MERGE, "published_dedupe_fill": PUBLISHED_DEDUPE, "consumer_checks": CONSUMER_CHECKS, "known_set_novelty": KNOWN_SET_NOVELTY, "golden_recall": GOLDEN_RECALL,
    "loose_match_4gram": LOOSE_MATCH, "vocab_terms": VOCAB_TERMS, "coverage_gap": COVERAGE_GAP, "positional_zip": POSITIONAL_ZIP, "ledger_by_host": _HOSTS, "ledger_by_day": LEDGER_BY_DAY,
    "ledger_by_group": LEDGER_BY_GROUP, "ledger_backfill": LEDGER_BACKFILL, "url_scope_district": URL_SCOPE, "host_first_source": HOST_FIRST_SOURCE, "judge_batches": JUDGE_BATCHES,
    "carry_forward": CARRY_FORWARD, "nested_counts": NESTED_COUNTS, "filter_view": FILTER_VIEW, "registry_union": REGISTRY_UNION, "category_tree": CATEGORY_TREE,
}
ORACLES |= goldens.oracles() | more.ORACLES
