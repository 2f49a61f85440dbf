"""DuckDB SQL for the queries that SQL can express on whole tables."""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents
), u AS (
  SELECT doc_id, source, size,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) >> 20 AS cell,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) / 4294967296.0::DOUBLE AS part2
  FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM u GROUP BY source
), w AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM s
), l AS (
  SELECT source, source_size, weight,
         CAST((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
           / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM w
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT max(level) AS level FROM l WHERE level * weight <= 3.0 * source_size
), t AS (
  SELECT l.source, source_size, least(3.0::DOUBLE * source_size, f.level * weight) AS target FROM l, f
), p AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM t
), r AS (
  SELECT *, target - CAST(whole * source_size AS DOUBLE) AS rest FROM p
), c AS (
  SELECT source, cell, sum(size) AS words FROM u GROUP BY source, cell
), k AS (
  SELECT source, cell, words, sum(words) OVER (PARTITION BY source ORDER BY cell) AS upto FROM c
), e AS (
  SELECT k.source, min(k.cell) AS cell, arg_min((rest - CAST(upto - words AS DOUBLE)) / CAST(words AS DOUBLE), k.cell) AS part
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source
  WHERE CAST(upto AS DOUBLE) > rest GROUP BY k.source
)
SELECT u.doc_id, u.size, r.source_size, r.target,
       CAST(r.whole * u.size + CASE WHEN u.cell < e.cell THEN u.size
                                    WHEN u.cell = e.cell THEN floor(e.part * u.size + u.part2)
                                    ELSE 0 END AS BIGINT) AS taken
FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source
LEFT JOIN e ON u.source IS NOT DISTINCT FROM e.source
"""

OP8 = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), n AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM n WHERE rank <= 20
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
n AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT *, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p FROM n),
l AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term),
q AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM l),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round as two steps: the nearest entries, then their parts' means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(part) AS part, arg_min(e, (dist, e)) AS e, min(dist) AS dist
  FROM (SELECT parts.*, e, CAST(list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist FROM parts JOIN b{r} ON parts.p = b{r}.p)
  GROUP BY vec_id, label, p
)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT p, e, i, sum(part[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(generate_series(1, (SELECT max(len(part)) FROM parts))) AS i) GROUP BY p, e, i) GROUP BY p, e
  ) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS part FROM ok, (SELECT unnest(range({parts})) AS p)
), b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS c FROM parts WHERE vec_id IN (SELECT vec_id FROM ok ORDER BY vec_id LIMIT {entries})
), {", ".join(steps)},
codes AS (SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS sha FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM codes, books
"""


ORACLE_SQL = {"op7_mixing": OP7, "op8_topk": OP8, "op12_source_divergence": OP12, "op13_vector_codes": op13()}
