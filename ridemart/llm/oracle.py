"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from ridemart.llm.license_scan import PHRASES, TEMPLATES

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("text")}, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(sets.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = sets.doc_id), sets.doc_id)) AS component_id
FROM sets
"""

_phrases = ",\n    ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES.items())
_templates = ",\n    ".join(f"('{label}', '{text}', '{names}')" for label, text, names in TEMPLATES)

LICENSES = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), phrases AS (
  SELECT string_split(phrase, ' ') AS p, label FROM (VALUES
    {_phrases}) v(phrase, label)
), templates AS (
  SELECT label, list_distinct(string_split(t, ' ')) AS t, len(string_split(t, ' ')) AS half,
    list_filter(string_split(names, ' '), lambda x: x <> '') AS names
  FROM (VALUES
    {_templates}) v(label, t, names)
), starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words
), base AS (
  SELECT doc_id, i - 1 AS word, label FROM starts JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p
), blocks AS (
  SELECT doc_id, w, label, t, half, names, unnest(range(0, greatest(1, len(w) - half), half)) AS b FROM words, templates WHERE len(w) > 0
), matched AS (
  SELECT doc_id, label, CAST(len(list_intersect(t, list_distinct(w[b + 1:b + 2 * half]))) AS DOUBLE) / len(t) AS share
  FROM blocks WHERE len(list_intersect(t, list_distinct(w[b + 1:b + 2 * half]))) >= ceil(0.8 * len(t) - 1e-9)
    AND list_has_all(w[b + 1:b + 2 * half], names)
), by_base AS (
  SELECT doc_id, count(*) AS n, min(word) AS first_word, max(word) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM base GROUP BY doc_id
), all_labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM matched) GROUP BY doc_id
), best AS (SELECT doc_id, max(share) AS share FROM matched GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(by_base.n, 0) AS n_base, first_word, last_word,
  coalesce(by_base.labels, '') AS base_labels, coalesce(all_labels.labels, '') AS labels,
  CASE WHEN by_base.n > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(best.share, CAST(0 AS DOUBLE)) END AS score
FROM words LEFT JOIN by_base USING (doc_id) LEFT JOIN all_labels USING (doc_id) LEFT JOIN best USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), kept AS (SELECT html, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM p LEFT JOIN kept ON p.html = kept.html
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), escaped AS (
  SELECT *, CASE
      WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>')
        OR regexp_replace(text, '<\\(\\*)\|', '<\1|', 'g') <> text
      THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS shown
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(shown) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  true AS identical
FROM escaped GROUP BY conv_id
"""

COPIES = f"""
WITH d AS (SELECT doc_id, {_LOWER.format("text")} AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""

_SPACE = "[ \\t\\n\\x0B\\f\\r]+"

LINES = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS whole FROM documents
), keyed AS (
  SELECT doc_id, whole, list_transform(whole, lambda x: translate(
    regexp_replace(regexp_replace(x, '^{_SPACE}', ''), '{_SPACE}$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
  )) AS keys FROM cut
), repeated AS (
  SELECT key FROM (SELECT unnest(list_distinct(keys)) AS key FROM keyed) WHERE key <> '' GROUP BY key HAVING count(*) >= 10
), places AS (
  SELECT doc_id, unnest(whole) AS line, unnest(keys) AS key, unnest(range(len(whole))) AS i FROM keyed
), left_over AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
  FROM places WHERE key NOT IN (SELECT key FROM repeated) GROUP BY doc_id
)
SELECT doc_id, CAST(len(whole) AS BIGINT) AS n_lines, CAST(len(whole) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM keyed LEFT JOIN left_over USING (doc_id)
"""


def _assigned(name: str, centroids: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT vec_id, v, d AS distance, cluster FROM (
    SELECT vec_id, v, k AS cluster, list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, 65)])::BIGINT AS d
    FROM kept, {centroids}) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1
)"""


def _moved(name: str, assigned: str, before: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM {before} LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS m FROM (
      SELECT cluster, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
      FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS i FROM {assigned}) GROUP BY cluster, i)
    GROUP BY cluster) ON k = cluster
)"""


_rounds = ", ".join(f"{_assigned(f'a{r}', f'c{r}')}, {_moved(f'c{r + 1}', f'a{r}', f'c{r}')}" for r in range(5))

CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS k, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT 40)
), {_rounds}, {_assigned('last', 'c5')}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c5 ON k = cluster
"""

MIDDLES = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents
), numbers AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM drawn
), cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

ORACLE = {
    "op1_ngram_jaccard_join": JACCARD,
    "op2_license_scans": LICENSES,
    "op6_warc": WARC,
    "op8_chat_formatting": CHAT,
    "op10_exact_dedup": COPIES,
    "op11_line_dedup": LINES,
    "op12_centroid_clustering": CENTROIDS,
    "op13_fill_in_middle": MIDDLES,
}
