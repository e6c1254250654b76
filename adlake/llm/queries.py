"""The operators bound to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import op1_jaccard, op2_pii, op3_suffixes, op4_decontaminate, op5_secrets, op6_lines, op7_warc, op8_quality, op9_units, op10_mixing, op11_topk, op12_periods, op13_trie
from adlake.llm.tables import table


def op1_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_jaccard.report(table(spark, sf_dir, "documents"))


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_pii.report(table(spark, sf_dir, "documents"))


def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_suffixes.report(table(spark, sf_dir, "documents"))


def op4_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op5_entropy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_secrets.report(table(spark, sf_dir, "documents"))


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_lines.report(table(spark, sf_dir, "documents"))


def op7_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_warc.round_trip(table(spark, sf_dir, "pages"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality.quality(table(spark, sf_dir, "documents"))


def op9_line_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_units.report(table(spark, sf_dir, "documents"))


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = op10_mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_topk.report(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_periods.report(op12_periods.with_repeated_tails(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_trie.report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_signature_trees, op2_weak_supervision, op3_suffix_levels, op4_prefix_join, op5_entropy_windows, op6_line_runs,
        op7_warc_chunks, op8_compression_bands, op9_line_hashes, op10_fair_mix, op11_norm_buckets, op12_periodic_runs,
        op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


SQL: dict[str, str] = {}

SQL["op7_warc_chunks"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (
  SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN p.payload_bytes >= 1000 AND p.page_id <> k.keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.payload_bytes >= 1000 AND p.page_id <> k.keeper THEN k.keeper END AS refers_to,
       CASE WHEN p.payload_bytes >= 1000 AND p.page_id <> k.keeper THEN 1
            ELSE greatest(1, CAST(ceil(length(p.html) / 262144.0) AS INTEGER)) END AS n_chunks
FROM p LEFT JOIN k USING (payload_digest)
"""

SQL["op4_prefix_join"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p
        FROM d CROSS JOIN (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, p, iw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op6_line_runs"] = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS no
  FROM documents),
b AS (
  SELECT doc_id, no, body, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos
  FROM (SELECT *, trim(line, E' \t\n\x0b\x0c\r') AS body FROM l) WHERE body <> ''),
p AS (SELECT *, lead(body) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM b),
f AS (
  SELECT *, next IS NOT NULL AND row_number() OVER (PARTITION BY body, next ORDER BY doc_id, pos) > 1 AS pair,
         length(body) >= 200 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) > 1 AS alone
  FROM p),
g AS (SELECT *, pair OR alone OR coalesce(lag(pair) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone FROM f),
first AS (
  SELECT doc_id, pos, first_value(doc_id) OVER w AS src, first_value(pos) OVER w AS src_pos
  FROM p WHERE next IS NOT NULL WINDOW w AS (PARTITION BY body, next ORDER BY doc_id, pos)),
later AS (SELECT * FROM first WHERE src <> doc_id OR src_pos <> pos),
starts AS (
  SELECT a.* FROM later a LEFT JOIN later c ON c.doc_id = a.doc_id AND c.pos = a.pos - 1 AND c.src = a.src AND c.src_pos = a.src_pos - 1
  WHERE c.doc_id IS NULL),
grown AS (
  SELECT *, 2 AS n FROM starts
  UNION ALL
  SELECT g.doc_id, g.pos, g.src, g.src_pos, g.n + 1
  FROM grown g JOIN b x ON x.doc_id = g.doc_id AND x.pos = g.pos + g.n JOIN b y ON y.doc_id = g.src AND y.pos = g.src_pos + g.n AND y.body = x.body),
whole AS (
  SELECT doc_id, count(*) AS n_copied_runs, max(n) AS longest_run
  FROM (SELECT doc_id, pos, max(n) AS n FROM grown GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS run FROM g)
SELECT l.doc_id, count(pos) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE run) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.no) FILTER (WHERE NOT coalesce(gone, false)), '')) AS kept_sha256,
       CAST(coalesce(any_value(n_copied_runs), 0) AS BIGINT) AS n_copied_runs, CAST(coalesce(any_value(longest_run), 0) AS BIGINT) AS longest_run
FROM l LEFT JOIN r ON l.doc_id = r.doc_id AND l.no = r.no LEFT JOIN whole ON whole.doc_id = l.doc_id GROUP BY 1
"""

SQL["op9_line_hashes"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS no
  FROM documents),
n AS (
  SELECT *, trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS body,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM l),
s AS (
  SELECT doc_id, no, trim(lower(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS body
  FROM (SELECT doc_id, unnest(string_split_regex(text, '[.!?]+(?:[\x20\x09-\x0D]+|\z)|\n+')) AS part,
               unnest(range(len(string_split_regex(text, '[.!?]+(?:[\x20\x09-\x0D]+|\z)|\n+')))) AS no FROM documents WHERE text IS NOT NULL)),
sp AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos, length(body) AS chars, count(*) OVER (PARTITION BY body) > 1 AS again
  FROM s WHERE body <> ''),
sr AS (
  SELECT doc_id, sum(chars) AS chars
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM sp WHERE again) GROUP BY doc_id, run HAVING sum(chars) >= 100),
passages AS (SELECT doc_id, count(*) AS n_passages, sum(chars) AS n_passage_chars FROM sr GROUP BY 1),
g AS (SELECT *, length(body) >= 60 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, no) > 1 AS gone FROM n)
SELECT g.doc_id, count(*) AS n_units, count(*) FILTER (WHERE gone) AS n_removed,
       CAST(coalesce(sum(length(line)) FILTER (WHERE gone), 0) AS BIGINT) AS n_removed_chars,
       coalesce(string_agg(CAST(CAST(place AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(place AS BIGINT) + length(line) AS VARCHAR), ',' ORDER BY no)
                FILTER (WHERE gone), '') AS spans,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '')) AS kept_sha256,
       CAST(coalesce(any_value(n_passages), 0) AS BIGINT) AS n_passages, CAST(coalesce(any_value(n_passage_chars), 0) AS BIGINT) AS n_passage_chars
FROM g LEFT JOIN passages USING (doc_id) GROUP BY 1
"""

SQL["op1_signature_trees"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, min(reach.b)) AS component_id,
       CAST(coalesce(any_value(m.n_links), 0) AS BIGINT) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY 1) m USING (doc_id) GROUP BY d.doc_id
"""

SQL["op3_suffix_levels"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, place, md5(substr(h, 2 * place + 1, 800)) AS digest
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS place FROM d WHERE length(h) >= 800)),
r AS (SELECT doc_id, place FROM (SELECT *, count(*) OVER (PARTITION BY digest) AS n FROM w) WHERE n > 1),
s AS (
  SELECT doc_id, place, CASE WHEN place <= lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 400 THEN 0 ELSE 1 END AS new FROM r),
g AS (SELECT doc_id, place, sum(new) OVER (PARTITION BY doc_id ORDER BY place) AS no FROM s),
spans AS (SELECT doc_id, no, min(place) AS lo, max(place) + 400 AS hi FROM g GROUP BY 1, 2),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
cut AS (
  SELECT gaps.doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

SQL["op11_norm_buckets"] = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

SQL["op13_prefix_trie"] = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
           list_prepend(CAST(n AS UBIGINT), list_transform(range(8), lambda x: CAST(x AS UBIGINT))),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END)) AS t),
own AS (
  SELECT conv_id, list(md5(coalesce(role, '')) || md5(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS w,
         list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
h AS (
  SELECT conv_id, CAST(xor(CAST(4294967295 AS UBIGINT), list_reduce(
           list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS UBIGINT))),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % 6 AS BIGINT) AS h
  FROM own, crc),
built AS (
  SELECT own.conv_id, coalesce(b.w, [])[1 : h] || own.w[h + 1 :] AS w, coalesce(b.n, [])[1 : h] || own.n[h + 1 :] AS n
  FROM own JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = own.conv_id - own.conv_id % 100),
p AS (
  SELECT conv_id, d, d = len(w) AS last, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars,
         array_to_string(w[1 : d], ',') AS prefix, CASE WHEN d > 0 THEN array_to_string(w[1 : d - 1], ',') END AS above
  FROM (SELECT *, unnest(range(len(w) + 1)) AS d FROM built)),
node AS (
  SELECT prefix, any_value(above) AS above, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last) AS ends
  FROM p GROUP BY prefix, d),
kids AS (SELECT above AS prefix, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
sums AS (
  SELECT a.prefix, a.d, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * x.chars) AS saved_tokens
  FROM node x LEFT JOIN kids ON kids.prefix = x.prefix AND kids.d = x.d JOIN p a ON a.conv_id = x.conv_id AND a.d <= x.d GROUP BY 1, 2)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN sums ON sums.prefix = node.prefix AND sums.d = node.d
LEFT JOIN kids ON kids.prefix = node.prefix AND kids.d = node.d
LEFT JOIN node up ON up.prefix = node.above AND up.d = node.d - 1
"""
