"""DuckDB SQL with the same answers, where SQL can express an operator on whole tables."""

TOP_K = """
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND q.id <> c.id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), c(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT c.doc_id, l.b FROM c JOIN l ON c.other = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(c.other) AS component_id
FROM s JOIN c ON s.doc_id = c.doc_id GROUP BY s.doc_id, s.s
"""

#: crc32 of a string ``s``: eight steps for each byte's table entry, one look-up for each byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(t ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
  )
)"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a string's bytes; ``crc_table`` must be in scope."""
    digits = f"hex(encode({text}))"
    part = f"CAST(concat('0x', substr({digits}, 2 * k - 1, 2)) AS BIGINT)"
    steps = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda k: {part})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INTEGER) + 1])), 4294967295)"


_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, {_AZ.format("run")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc32("concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run)")} AS h FROM runs, crc_table WHERE length(run) >= 6
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS INTEGER)), substr(run, CAST(h % length(run) AS INTEGER) + 2)) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gaps AS (
  SELECT word, n, length(word) AS size, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, w.n, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word
), near AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, hex(encode(other)))) AS best, max(other_n) AS best_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)
), walk AS (
  SELECT word, word AS spot, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN formed f ON walk.spot = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM formed f JOIN (SELECT word, arg_max(spot, steps) AS root FROM walk GROUP BY word) r USING (word)
"""

TRIE = f"""
WITH {_CRC_TABLE},
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS turns FROM numbered GROUP BY conv_id
), asked AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM whole, crc_table
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:h], []), a.turns[h + 1:]) AS turns FROM asked a LEFT JOIN whole b ON a.base = b.conv_id
), prefixes AS (
  SELECT conv_id, d, len(turns) = d AS ends, turns[1:d] AS prefix FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(prefix[d].text) END AS saved
  FROM prefixes GROUP BY d, prefix
), parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.d = p.d + 1 AND n.prefix[1:n.d - 1] = p.prefix
), children AS (
  SELECT p.d, p.prefix, count(n.d) AS n_children FROM nodes p LEFT JOIN nodes n ON n.d = p.d + 1 AND n.prefix[1:n.d - 1] = p.prefix GROUP BY p.d, p.prefix
), below AS (
  SELECT p.d, p.prefix, count(*) FILTER (c.n_children = 0) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM nodes p JOIN nodes n ON n.d >= p.d AND n.prefix[1:p.d] = p.prefix JOIN children c ON n.d = c.d AND n.prefix = c.prefix GROUP BY p.d, p.prefix
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, n.parent_conv_id, n.n_convs, c.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM parents n JOIN children c ON n.d = c.d AND n.prefix = c.prefix JOIN below b ON n.d = b.d AND n.prefix = b.prefix
"""

ORACLES = {"op2_exact_top_k": TOP_K, "op6_jaccard_join": JACCARD, "op11_spelling_variants": VARIANTS, "op12_conversation_trie": TRIE}
