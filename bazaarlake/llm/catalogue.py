"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import (
    decontamination,
    filter_audit,
    html_extract,
    jaccard_join,
    license_scan,
    packing,
    prefix_trie,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_files,
    url_filter,
    warc_archive,
)
from bazaarlake.llm.tables import scratch, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    token_files.write_files(table(spark, sf_dir, "documents"), path, special_ids=True)
    return token_files.read_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("text_key")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), special_ids=True).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.html_extract(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("conv_id") - F.col("conv_id") % 5
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(prefix_trie.sequences(table(spark, sf_dir, "conversations"), base, shared, 8))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op13_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    warc_archive.write_archive(table(spark, sf_dir, "pages"), path)
    return warc_archive.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_token_files": op2_token_files,
    "op3_url_filter": op3_url_filter,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_html_extract": op10_html_extract,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_warc_archive": op13_warc_archive,
}

TEMPLATES_SQL = ", ".join(
    f"({number}, '{t.label}', '{t.text}', {t.exact})"
    for number, t in enumerate(license_scan.PHRASES + license_scan.NOTICES)
)

OP1_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM doc
), grams AS (
  SELECT doc_id, i, size, string_agg(word, ' ') OVER
    (PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING) AS s
  FROM words CROSS JOIN (VALUES (2), (3)) v(size) WHERE true QUALIFY i + size <= n
), template AS (
  SELECT number, label, string_split(t, ' ') AS w, exact, least(3, len(string_split(t, ' '))) AS size
  FROM (VALUES {TEMPLATES_SQL}) v(number, label, t, exact)
), place AS (
  SELECT number, exact, size, p, array_to_string(w[p + 1 : p + size], ' ') AS s
  FROM (SELECT *, unnest(range(len(w) - size + 1)) AS p FROM template)
), hit AS (
  SELECT doc_id, number, exact, p, place.size, i, i - p AS diagonal FROM grams JOIN place USING (s, size)
), step AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, number ORDER BY diagonal, i)
    > CASE WHEN exact THEN 0 ELSE 2 END, true)::INT AS apart FROM hit
), run AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, number ORDER BY diagonal, i) AS run FROM step
), span AS (
  SELECT doc_id, number, run, min(i) AS first_i, count(DISTINCT j) AS n FROM
    (SELECT doc_id, number, run, i, unnest(range(p, p + size)) AS j FROM run) GROUP BY ALL
), rated AS (
  SELECT doc_id, label, exact, first_i, n / len(w) AS share FROM span JOIN template USING (number)
), found AS (
  SELECT doc_id, count_if(exact AND share = 1) AS n_base, min(first_i) FILTER (WHERE exact AND share = 1) AS first_word,
    max(first_i) FILTER (WHERE exact AND share = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact AND share = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE share >= CASE WHEN exact THEN 1 ELSE 0.8 END) AS labels,
    max(share) AS score
  FROM rated GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN found USING (doc_id)
"""

OP4_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM doc
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, i, n, string_agg(word, ' ') OVER
      (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s
    FROM words) WHERE i + 5 <= n OR i = 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reached AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
), least AS (
  SELECT x, min(y) AS y FROM reached GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM doc d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least ON x = d.doc_id
"""

OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, i, word, n, string_agg(word, ' ') OVER
    (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s
  FROM words
), firsts AS (
  SELECT s, min(doc_id) AS first_id FROM windows WHERE i + 13 <= n GROUP BY s
), flagged AS (
  SELECT doc_id, i, word, bool_or(coalesce(doc_id > first_id AND i + 13 <= n, false)) OVER
    (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM windows LEFT JOIN firsts USING (s)
), kept AS (
  SELECT doc_id, count(*) AS n_words, count_if(gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept_text
  FROM flagged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept_text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

def matches_sql(number: int, rule: secret_scan.Rule) -> str:
    """Matches of one rule with their places: the pieces between matches give the starts."""
    pattern = ("(?i)" if rule.any_case else "") + rule.pattern.replace("'", "''")
    return rf"""
  SELECT doc_id, {number} AS rule, start, start + length(m) AS "end" FROM (
    SELECT doc_id, m, g, sum(length(before)) OVER w + coalesce(sum(length(m)) OVER
      (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{pattern}')) AS m,
        unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS g,
        unnest(regexp_split_to_array(text, '{pattern}')) AS before,
        unnest(range(len(regexp_split_to_array(text, '{pattern}')))) AS i FROM documents)
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE m IS NOT NULL AND length(g) >= {rule.least}"""


OP7_SQL = rf"""
WITH span AS ({" UNION ALL ".join(matches_sql(n, r) for n, r in enumerate(secret_scan.RULES))}
), named AS (
  SELECT doc_id, rule, start, kind || ':' || start::BIGINT || ':' || "end"::BIGINT AS s
  FROM span JOIN (VALUES {", ".join(f"({n}, '{r.kind}')" for n, r in enumerate(secret_scan.RULES))}) v(rule, kind) USING (rule)
), found AS (
  SELECT doc_id, count_if(rule = 0) AS n_assign, count_if(rule = 1) AS n_access, count_if(rule = 2) AS n_hex,
    string_agg(s, ',' ORDER BY start, rule) FILTER (WHERE rule < 3) AS base,
    string_agg(s, ',' ORDER BY start, rule) AS spans
  FROM named GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)
"""

OP9_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM doc
), runs AS (
  SELECT doc_id, i, n, size, list(word) OVER
    (PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS next
  FROM words CROSS JOIN (SELECT DISTINCT size FROM grams)
), hits AS (
  SELECT DISTINCT doc_id, i, r.size, item_id
  FROM (SELECT doc_id, i, size, array_to_string(next[1 : size], ' ') AS s FROM runs WHERE i + size <= n) r
  JOIN grams g ON g.s = r.s AND g.size = r.size
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP11_SQL = r"""
WITH named AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS n_bytes,
    sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key
  FROM conversations WHERE conv_id IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS rank FROM named
), conv AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, byte:
    list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM named)
), turns AS (
  SELECT c.conv_id, r.rank AS place, 0 AS part, r.key, r.n_bytes FROM conv c JOIN ranked r ON r.conv_id = c.base AND r.rank <= h
  UNION ALL
  SELECT c.conv_id, r.rank, 1, r.key, r.n_bytes FROM conv c JOIN ranked r ON r.conv_id = c.conv_id AND r.rank > h
), placed AS (
  SELECT conv_id, key, n_bytes, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM turns
), paths AS (
  SELECT conv_id, depth, n_bytes, string_agg(key, '/') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL SELECT conv_id, 0, 0, '' FROM conv
), members AS (
  SELECT *, lag(path) OVER w AS parent, lead(depth) OVER w IS NULL AS ends FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT path, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM members GROUP BY path, depth
), children AS (
  SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), below AS (
  SELECT m.path, m.depth, count_if(c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.path = n.path
  JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.path, m.depth
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(c.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path AND b.depth = n.depth LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON p.path = n.parent AND p.depth = n.depth - 1
"""

OP12_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), first_ids AS (
  SELECT t, min(doc_id) AS first_id FROM doc GROUP BY t
), good AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc.doc_id > first_id, false)::INT AS mask
  FROM doc JOIN first_ids USING (t) LEFT JOIN good ON good.doc_id = doc.doc_id
), counts AS (
  SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL
), orders AS (
  SELECT '' AS filter_order, 0 AS used
  UNION ALL
  SELECT filter_order || f, used + bit FROM orders, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)
  WHERE used & bit = 0
), steps AS (
  SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit, list_sum(list_transform(range(1, step),
    lambda i: 1 << (ascii(filter_order[i]) - 65)))::BIGINT AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE len(filter_order) = 5)
), cases AS (
  SELECT filter_order, step, bit, coalesce(before, 0) AS before FROM steps
)
SELECT part, filter_order, step::INT AS step,
  sum(n * (mask & (before | bit) = 0)::INT)::BIGINT AS kept,
  sum(n * (mask & before = 0 AND mask & bit > 0)::INT)::BIGINT AS removed,
  sum(n * (mask & before > 0 AND mask & bit > 0)::INT)::BIGINT AS redundant,
  sum(n * (mask = bit)::INT)::BIGINT AS unique_fails,
  sum(n * (mask & before = 0 AND mask & bit > 0 AND good)::INT)::BIGINT AS good_lost,
  sum(n * (mask & before = 0 AND mask & bit > 0 AND toxic)::INT)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & bit > 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
FROM counts CROSS JOIN cases GROUP BY part, filter_order, step
"""

OP13_SQL = r"""
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), last_ids AS (
  SELECT payload, max(page_id) AS last_id FROM page GROUP BY payload
), typed AS (
  SELECT page_id, payload, last_id, octet_length(payload) >= 1000 AND page_id IS DISTINCT FROM last_id AS again
  FROM page JOIN last_ids USING (payload)
)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last_id END AS refers_to
FROM typed
"""

ORACLES: dict[str, str] = {
    "op11_prefix_trie": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_warc_archive": OP13_SQL,
    "op7_secret_scan": OP7_SQL,
    "op1_license_scan": OP1_SQL,
    "op9_decontamination": OP9_SQL,
    "op4_jaccard_join": OP4_SQL,
    "op6_substring_dedup": OP6_SQL,
}
