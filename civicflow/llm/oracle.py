"""DuckDB SQL of the queries that SQL can express.

The others (token ids and files, diagonals of edited licences, decoded keys,
mixtures, shards with checksums, sketches) are held against brute-force
versions in ``tests/llm``.
"""

from civicflow.llm.quality import MEASURES, POLICIES, RULES, mask

_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)

QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents
), w AS (
  SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM t
), placed AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w
), three AS (
  SELECT doc_id, i, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c
  FROM placed WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), repeated AS (
  SELECT doc_id, i FROM three WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(d) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) AS n_upper, length(x) - length(replace(x, '!', '')) AS n_exclaim
  FROM w LEFT JOIN covered USING (doc_id)
), ledger AS (SELECT *, {_BITS} AS fail_bits FROM m)
SELECT doc_id, {', '.join(MEASURES)}, fail_bits, fail_bits & {mask('base')} <> 0 AS base_failed, fail_bits & {mask('v2')} = 0 AS kept
FROM ledger
"""
assert set(POLICIES["base"]) <= set(POLICIES["v2"])

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""

EXACT = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL = f"""
WITH asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark
), q AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL
), d AS (SELECT row_number() OVER () AS uid, doc_id, {_TERMS} AS ts FROM documents
), size AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d WHERE len(ts) > 0
), said AS (SELECT uid, unnest(ts) AS term FROM d
), p AS (SELECT uid, term, count(*) AS tf FROM said WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM p, size GROUP BY term
), m AS (SELECT uid, doc_id, 75 + (25 * len(ts) * docs) // total AS m FROM d, size WHERE len(ts) > 0
), scored AS (
  SELECT item_id, uid, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (uid) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, uid) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

ORACLE: dict[str, str] = {
    "op3_quality": QUALITY, "op4_topk": TOPK, "op5_warc": WARC, "op12_exact_dedup": EXACT, "op13_lexical": LEXICAL}
