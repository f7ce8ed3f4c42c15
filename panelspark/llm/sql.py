"""DuckDB SQL of the text queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

SOURCE_MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS sk,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS mark
  FROM documents
), s AS (
  SELECT sk, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY sk
), p AS (
  SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) + 1] AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM s
), r AS (
  SELECT *, 3 * source_size AS lim, (3 * source_size)::DOUBLE / weight AS ratio FROM p
), f AS (
  SELECT *, row_number() OVER w AS fill,
         ((sum(source_size) OVER ())::BIGINT - coalesce(sum(lim) OVER b, 0)::BIGINT)::DOUBLE
           / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER b, 0)::BIGINT) AS lvl
  FROM r
  WINDOW w AS (ORDER BY ratio, place),
         b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT sk, source_size, least(lim::DOUBLE, weight * (SELECT min_by(lvl, fill) FROM f WHERE lvl <= ratio)) AS target,
         ('0x' || substr(md5('mix|' || sk), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS shift
  FROM f
), k AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS r,
         row_number() OVER (
           PARTITION BY d.sk
           ORDER BY least(d.size // 32, 4095), substr(mark, 1, 1), d.size, mark, doc_id NULLS FIRST
         ) AS rk
  FROM d JOIN t USING (sk)
)
SELECT doc_id, size, source_size, target,
       ((floor(r * rk + shift) - floor(r * (rk - 1) + shift))::BIGINT * size)::BIGINT AS taken
FROM k
"""

#: The line windows and what is deleted, for ``lines`` (id, th, line, txt, w) of lines with a word.
_LINE_RUNS = r"""
n AS (
  SELECT *, row_number() OVER (PARTITION BY id, th ORDER BY line) AS s,
         sum(w) OVER (PARTITION BY id, th ORDER BY line) AS c
  FROM lines
), fwd AS (
  SELECT a.id, a.th, a.s AS s, min(b.s) AS e
  FROM n a JOIN n b ON a.id = b.id AND a.th = b.th AND b.s BETWEEN a.s AND a.s + 50 AND b.c - a.c + a.w >= 50
  GROUP BY ALL
), bwd AS (
  SELECT a.id, a.th, max(b.s) AS s, a.s AS e
  FROM n a JOIN n b ON a.id = b.id AND a.th = b.th AND b.s BETWEEN a.s - 50 AND a.s AND a.c - b.c + b.w >= 50
  GROUP BY a.id, a.th, a.s
), win AS (
  SELECT x.id, x.th, x.s, x.e, string_agg(n.txt, chr(10) ORDER BY n.s) AS body
  FROM (SELECT * FROM fwd UNION SELECT * FROM bwd) x
  JOIN n ON n.id = x.id AND n.th = x.th AND n.s BETWEEN x.s AND x.e
  GROUP BY x.id, x.th, x.s, x.e
), firsts AS (
  SELECT body, min(struct_pack(id := id, th := th, s := s)) AS f FROM win GROUP BY body
), gone AS (
  SELECT DISTINCT win.id, win.th, lo.line AS first_line, hi.line AS last_line
  FROM win JOIN firsts USING (body)
  JOIN n lo ON lo.id = win.id AND lo.th = win.th AND lo.s = win.s
  JOIN n hi ON hi.id = win.id AND hi.th = win.th AND hi.s = win.e
  WHERE struct_pack(id := win.id, th := win.th, s := win.s) > f
)
"""

LINE_DEDUP = rf"""
WITH raw AS (
  SELECT doc_id AS id, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, 0) AS th, text FROM documents
), every AS (
  SELECT id, th, unnest(string_split(text, chr(10))) AS txt,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM (SELECT DISTINCT id, th, text FROM raw WHERE text IS NOT NULL)
), counted AS (
  SELECT *, len(regexp_extract_all(txt, '{WORD}'))::BIGINT AS w FROM every
), lines AS (SELECT * FROM counted WHERE w > 0), {_LINE_RUNS}, marked AS (
  SELECT c.*, EXISTS (
    SELECT 1 FROM gone g WHERE g.id = c.id AND g.th = c.th AND c.line BETWEEN g.first_line AND g.last_line
  ) AS is_gone
  FROM counted c
), per_doc AS (
  SELECT id, th, count(*) FILTER (w > 0) AS n_lines, count(*) FILTER (w > 0 AND is_gone) AS n_removed,
         coalesce(string_agg(txt, chr(10) ORDER BY line) FILTER (NOT is_gone), '') AS kept
  FROM marked GROUP BY id, th
)
SELECT raw.id AS doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN raw.text IS NOT NULL THEN md5(kept) END AS kept_md5
FROM raw LEFT JOIN per_doc ON raw.id = per_doc.id AND raw.th = per_doc.th
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JOIN = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END
  ) AS shingle
  FROM t
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.size, nb.size
  HAVING 100 * count(*) >= 85 * (na.size + nb.size - count(*))
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT links.y, reach.other FROM reach JOIN links ON links.x = reach.id
)
SELECT d.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(reach.other) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.id = d.doc_id
GROUP BY d.doc_id
"""

SPHERICAL_CAPS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT links.y, reach.other FROM reach JOIN links ON links.x = reach.id
), c AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.x = e.vec_id)::BIGINT AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id AND len(a.x) = len(b.x)
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), found AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other AS negative_id, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other))::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 100 * s.score >= 30 * p.positive_score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""
