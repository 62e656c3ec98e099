"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"""
w AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         [x for x in regexp_split_to_array({text}, '[\x20\x09-\x0D]+') if x <> ''] AS words
  FROM documents
)"""
OP3_SQL = "WITH" + _WORDS.replace("{text}", "coalesce(text, '')") + """,
windows AS (
  SELECT row_id, doc_id, p, array_to_string(words[p : p + 12], ' ') AS words
  FROM (SELECT row_id, doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w WHERE doc_id IS NOT NULL)
),
first AS (SELECT words, min(doc_id) AS doc_id FROM windows GROUP BY words),
gone AS (
  SELECT DISTINCT row_id, unnest(range(p, p + 13)) AS i
  FROM windows JOIN first USING (words) WHERE first.doc_id < windows.doc_id
),
each AS (SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
kept AS (
  SELECT row_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
  FROM each ANTI JOIN gone USING (row_id, i) GROUP BY row_id
)
SELECT doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (row_id)
"""
_REACH = """,
near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT a, b FROM near UNION SELECT r.id, n.b FROM reach r JOIN near n ON r.other = n.a),
least AS (SELECT id, min(other) AS other FROM reach GROUP BY id)
"""
OP8_SQL = "WITH RECURSIVE" + _WORDS.replace("{text}", _LOWER) + """,
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p : p + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM w WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
)""" + _REACH + """
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least l ON l.id = w.doc_id
"""
OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
)""" + _REACH + """,
degrees AS (SELECT a AS vec_id, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
       vec_id <= coalesce(other, vec_id) AS kept
FROM embeddings LEFT JOIN degrees USING (vec_id) LEFT JOIN least l ON l.id = vec_id
"""
OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
OP6_SQL = """
WITH RECURSIVE weights(key, weight) AS (
  VALUES ('src0', 0.25::DOUBLE), ('src1', 0.1::DOUBLE), ('src2', 0.1::DOUBLE), ('src3', 0.05::DOUBLE),
         (NULL, 1.0::DOUBLE - (0.25::DOUBLE + 0.1::DOUBLE + 0.1::DOUBLE + 0.05::DOUBLE))
),
d AS (
  SELECT *, CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN source END AS key FROM documents
),
means AS (
  SELECT w.key, (SELECT count(*) FROM documents)::DOUBLE * (weight / sum(weight) OVER ()) / n::DOUBLE AS mean
  FROM (SELECT key, count(*) AS n FROM d GROUP BY key) c JOIN weights w ON c.key IS NOT DISTINCT FROM w.key
),
parts AS (SELECT key, greatest(ceil(mean / 16), 1)::INTEGER AS parts, mean / greatest(ceil(mean / 16), 1)::INTEGER AS m FROM means),
poisson AS (
  SELECT key, parts, m, 0 AS k, exp(-m) AS p, exp(-m) AS below FROM parts
  UNION ALL
  SELECT key, parts, m, k + 1, p * m / (k + 1), below + p * m / (k + 1) FROM poisson WHERE k < 79
),
draws AS (
  SELECT doc_id, key, part, (CAST('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || part), 1, 13) AS BIGINT)::DOUBLE + 0.5)
         / 4503599627370496::DOUBLE AS u
  FROM (SELECT doc_id, d.key, unnest(range(1, parts + 1)) AS part FROM d JOIN parts p ON d.key IS NOT DISTINCT FROM p.key)
),
times AS (
  SELECT w.doc_id, count(*) AS n
  FROM draws w JOIN poisson p ON w.key IS NOT DISTINCT FROM p.key AND p.below < w.u
  GROUP BY w.doc_id
)
SELECT doc_id, text, lang, source, n_chars, copy
FROM (SELECT d.*, unnest(range(1, n + 1))::INTEGER AS copy FROM d JOIN times USING (doc_id))
"""
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents
),
r AS (
  SELECT *, count(*) OVER (PARTITION BY plain) AS group_size,
         first_value(doc_id) OVER best AS keep_id, first_value(row_id) OVER best AS keep_row
  FROM d WINDOW best AS (PARTITION BY plain ORDER BY n_chars DESC, doc_id NULLS LAST, row_id)
)
SELECT doc_id, keep_id, group_size, row_id = keep_row AS kept, sha256(plain) AS text_sha256 FROM r
"""
_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
q AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
),
tf AS (
  SELECT row_id, doc_id, len_, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS len_, unnest(terms) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL
),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf CROSS JOIN size GROUP BY term
),
s AS (
  SELECT item, item_id, row_id, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len_ * n) // total)))) AS BIGINT) AS score
  FROM tf JOIN q USING (term) JOIN w USING (term) CROSS JOIN size GROUP BY ALL
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""

ORACLES = {
    "op3_substring_dedup": OP3_SQL,
    "op4_top_k": OP4_SQL,
    "op6_source_mix": OP6_SQL,
    "op8_minhash_dedup": OP8_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
