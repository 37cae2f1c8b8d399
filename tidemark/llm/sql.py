"""DuckDB SQL of the queries that SQL can express over whole tables."""

from tidemark.llm.rulebits import INSULT

LINE_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = f"""
WITH lines AS (
  SELECT doc_id, i, line, {LINE_KEY} AS k
  FROM (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))
), owners AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (SELECT l.*, o.owner IS NOT NULL AND o.owner <> l.doc_id AS dropped FROM lines l LEFT JOIN owners o USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP6 = f"""
WITH item_words AS (SELECT item_id, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM item_words WHERE len(w) > 0)
), doc_words AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, p, d.n, item_id FROM doc_windows d JOIN item_windows i USING (n, s)),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP7 = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 4) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS p FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM shingles p JOIN shingles q USING (s) WHERE p.doc_id <> q.doc_id GROUP BY ALL) x
  JOIN sizes m ON m.doc_id = a JOIN sizes o ON o.doc_id = b WHERE 100 * k >= 85 * (m.n + o.n - k)
), reach AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.v WHERE r.c < l.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM reach WHERE v = d.doc_id) AS component_id FROM documents d LEFT JOIN sizes USING (doc_id)
"""

#: Shards take turns; a row of `fill` is one claim. 32 shards, 3,203 slots.
OP10 = """
WITH RECURSIVE prefs AS (
  SELECT list(('0x' || substr(md5('offset:' || n), 1, 8))::BIGINT % 3203 ORDER BY i) AS start, list(('0x' || substr(md5('skip:' || n), 1, 8))::BIGINT % 3202 + 1 ORDER BY i) AS skip
  FROM (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS n FROM range(32) t(i))
), fill AS (
  SELECT 0::BIGINT AS turn, list_transform(range(3203), lambda x: -1::BIGINT) AS slots, (SELECT start FROM prefs) AS start, (SELECT skip FROM prefs) AS skip
  UNION ALL
  SELECT turn + 1, slots[:c] || [turn % 32] || slots[c + 2:], start, skip
  FROM (SELECT *, (start[turn % 32 + 1] + list_filter(range(3203), lambda j: slots[(start[turn % 32 + 1] + j * skip[turn % 32 + 1]) % 3203 + 1] < 0)[1] * skip[turn % 32 + 1]) % 3203 AS c FROM fill WHERE turn < 3203)
), slots AS (SELECT unnest(range(3203)) AS slot, unnest(slots) AS shard_no FROM fill WHERE turn = 3203)
SELECT doc_id, slot::INTEGER AS slot, 'shard-' || lpad(shard_no::VARCHAR, 2, '0') AS shard
FROM (SELECT doc_id, ('0x' || substr(md5('key:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 3203 AS slot FROM documents) JOIN slots USING (slot)
"""

#: CRC-32 by its table; features are counted once for all documents and all items.
OP11 = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc
), words AS (
  SELECT 's' AS side, doc_id AS id, {WORDS.format("coalesce(text, '')")} AS w FROM documents UNION ALL SELECT 't', row_number() OVER (), {WORDS.format("coalesce(text, '')")} FROM benchmark
), features AS (
  SELECT side, id, len(w) AS n_words, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), hashed AS (
  SELECT f, xor(list_reduce(range(strlen(f)), lambda c, i: xor(c >> 8, crc[(xor(c, ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crc_table
), counts AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM features JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), weights AS (
  SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights ON weights.id = doc_id JOIN words x ON x.side = 's' AND x.id = doc_id
), places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM scored LEFT JOIN places USING (doc_id)
"""

OP12 = rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM words)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS k FROM windows) WHERE k > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(string_split(text, chr(10))) AS n_lines,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals, len(regexp_extract_all(text, '{INSULT}')) AS n_insults
  FROM words LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT + 64 * (100 * n_capitals > 40 * word_chars)::BIGINT + 128 * (n_insults > 0)::BIGINT AS failures
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 > 0 AS base_failed, failures = 0 AS kept, failures FROM judged
"""

ORACLES = {"op11_gain_resampling": OP11, "op12_rule_ledger": OP12, "op4_line_dedup": OP4, "op6_benchmark_winnowing": OP6, "op7_partition_jaccard": OP7, "op10_shard_placement": OP10}
