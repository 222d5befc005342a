"""SQL twins, for DuckDB over the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER w AS n, lag(role, 1, '') OVER w AS before, count(*) OVER (PARTITION BY conv_id) AS all_turns
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, (before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) AS fine,
    replace(replace(text, '\', '\s'), '<|', '\c') AS body,
    replace(replace(replace(role, '\', '\s'), '<|', '\c'), chr(10), '\n') AS head
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(head) + 1 + length(body) + 11)::BIGINT AS formatted_chars,
  bool_and(fine) AND bool_or(n = all_turns AND role = 'assistant') AS valid,
  coalesce(min(n) FILTER (NOT fine), 0)::BIGINT AS broken_at
FROM judged GROUP BY conv_id
"""

OP2 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    row_number() OVER () AS r FROM documents
), tokens AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), grams AS (
  SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g3,
    g3 || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g5,
    g5 || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o || ' ' || lead(word, 7) OVER o || ' ' || lead(word, 8) OVER o
      || ' ' || lead(word, 9) OVER o AS g10
  FROM tokens WINDOW o AS (PARTITION BY r ORDER BY i)
), named AS (
  SELECT r, i, 3 AS n, g3 AS g FROM grams WHERE g3 IS NOT NULL UNION ALL
  SELECT r, i, 5, g5 FROM grams WHERE g5 IS NOT NULL UNION ALL SELECT r, i, 10, g10 FROM grams WHERE g10 IS NOT NULL
), windows AS (
  SELECT r, i, n, count(*) OVER (PARTITION BY r, n, g) AS times FROM named
), covered AS (
  SELECT DISTINCT r, n, unnest(range(i, i + n)) AS i FROM windows WHERE times > 1
), runs AS (
  SELECT c.r, count(*) FILTER (n = 3) AS n_repeat_words,
    coalesce(sum(length(word)) FILTER (n = 5), 0) AS run5_chars, coalesce(sum(length(word)) FILTER (n = 10), 0) AS run10_chars
  FROM covered c JOIN tokens t ON t.r = c.r AND t.i = c.i GROUP BY c.r
), lines AS (
  SELECT r, line, count(*) - 1 AS again, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
), repeats AS (
  SELECT r, sum(again)::BIGINT AS n_dup_lines, sum(again * chars)::BIGINT AS line_chars FROM lines GROUP BY r
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(line_chars, 0)::BIGINT AS line_chars, coalesce(run5_chars, 0)::BIGINT AS run5_chars,
    coalesce(run10_chars, 0)::BIGINT AS run10_chars
  FROM docs LEFT JOIN runs USING (r) LEFT JOIN repeats USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * line_chars <= 40 * word_chars
    AND 100 * run5_chars <= 50 * word_chars AND 100 * run10_chars <= 25 * word_chars AS kept
FROM counts
"""

OP5 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM docs
), members AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_have
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared WHERE 100 * both_have >= 85 * (na + nb - both_have)
), reach AS (
  SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

OP8 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), tokens AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), grams AS (
  SELECT doc_id, i, count(*) OVER o AS n, string_agg(word, ' ') OVER o AS g FROM tokens
  WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), windows AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(g)) AS first_doc FROM grams WHERE n = 50
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows WHERE first_doc < doc_id
), judged AS (
  SELECT t.doc_id, t.i, t.word, g.i IS NOT NULL AS gone FROM tokens t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.i = g.i
), sums AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS stay
  FROM judged GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(stay, '')) AS kept_sha256
FROM docs LEFT JOIN sums USING (doc_id)
"""

OP11 = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), seen AS (
  SELECT lang, source, r, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM seen GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT g.lang, g.source, k.term, count(s.r)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
  GROUP BY ALL
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM counts JOIN langs USING (lang)
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM kept JOIN langs USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP12 = r"""
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS body FROM pages
), firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS response, sha1(body) AS h FROM payloads
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id < response OR (page_id IS NULL AND response IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < response OR (page_id IS NULL AND response IS NOT NULL) THEN response END AS refers_to,
  CASE WHEN coalesce(url, '') = '' THEN 'urn:page:' || coalesce(page_id::VARCHAR, '') ELSE url END AS target_uri
FROM firsts
"""

# DuckDB has no CRC-32: its table, then a fold over the bytes of the id's digits.
OP13 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY k) AS entries FROM (
    SELECT k, list_reduce(list_prepend(k::BIGINT, range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS k))
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) AS said, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS lender,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
      lambda x, b: xor(x >> 8, entries[xor(x & 255, b) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM placed), crc_table
), sized AS (
  SELECT c, lender, h, least(h, (SELECT count(*) FROM placed p WHERE p.conv_id = lender)) AS lent FROM convs
), steps AS (
  SELECT c, i AS d, said, bytes FROM sized JOIN placed ON conv_id = lender AND i <= lent
  UNION ALL SELECT c, i - h + lent, said, bytes FROM sized JOIN placed ON conv_id = c AND i > h
), paths AS (
  SELECT c, d, md5(string_agg(said, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS k, bytes FROM steps
  UNION ALL SELECT c, 0, '', 0 FROM convs
), linked AS (
  SELECT a.c, a.d, a.k, a.bytes, b.k AS parent, a.d = max(a.d) OVER (PARTITION BY a.c) AS ends
  FROM paths a LEFT JOIN paths b ON b.c = a.c AND b.d = a.d - 1
), nodes AS (
  SELECT d, k, any_value(parent) AS parent, any_value(bytes) AS bytes, min(c) AS c, count(*) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY d, k
), children AS (
  SELECT d - 1 AS d, parent AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), sums AS (
  SELECT p.d, p.k, count(*) FILTER (x.n_children IS NULL) AS n_leaves, sum((n.n - 1) * n.bytes) AS saved
  FROM nodes n LEFT JOIN children x ON x.d = n.d AND x.k = n.k JOIN paths p ON p.c = n.c AND p.d <= n.d GROUP BY p.d, p.k
)
SELECT n.c::BIGINT AS conv_id, n.d::BIGINT AS depth, a.c::BIGINT AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.k = n.k LEFT JOIN children x ON x.d = n.d AND x.k = n.k
  LEFT JOIN nodes a ON a.d = n.d - 1 AND a.k = n.parent
"""

STATEMENTS = {"op1_chat_formatting": OP1, "op2_quality_rules": OP2, "op5_minhash": OP5, "op8_substring_dedup": OP8, "op11_divergence": OP11, "op12_warc": OP12, "op13_prefix_trie": OP13}
