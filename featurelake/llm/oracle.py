"""DuckDB SQL for the operators that SQL can express."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# doc_ids are unique in the given tables
JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END)) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(doc_id, r) AS (
  SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, min(reach.r)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY 1, 2
"""

CONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s:s + 9], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS s FROM i WHERE len(ws) > 0)),
places AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM wins) WHERE len(ws) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM places JOIN wins USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY 1)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round as a table of its own: assignment, then averages."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, len(embedding) // {parts} AS w, [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
comps AS MATERIALIZED (
  SELECT vec_id, i // w AS p, i % w AS k, v[i + 1] AS x FROM (SELECT vec_id, w, v, unnest(range(len(v))) AS i FROM kept)),
book0 AS MATERIALIZED (
  SELECT e, p, k, x AS y FROM comps JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id))"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT vec_id, p, min({{'d': d, 'e': e}}) AS m FROM (
    SELECT vec_id, p, e, sum((x - y) * (x - y)) AS d FROM comps JOIN book{r} USING (p, k) GROUP BY 1, 2, 3) GROUP BY 1, 2)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (
  SELECT e, p, k, CASE WHEN s < 0 THEN -((n - 1 - s) // n) ELSE s // n END AS y FROM (
    SELECT m.e AS e, p, k, sum(x) AS s, count(*) AS n FROM comps JOIN near{r} USING (vec_id, p) GROUP BY 1, 2, 3)),
book{r + 1} AS MATERIALIZED (
  SELECT e, p, k, coalesce(mean{r}.y, book{r}.y) AS y FROM book{r} LEFT JOIN mean{r} USING (e, p, k))""")
    return ",".join(steps) + f"""
, coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{rounds} GROUP BY 1)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, k)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (vec_id)
"""


# vec_ids are unique in the given tables
VECTOR_CODES = _vector_codes()

DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
v AS (SELECT lang, term, count(*) AS c FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= 10),
l AS (SELECT lang, count(*) AS v, sum(c)::HUGEINT AS n FROM v GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN v USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY 1, 2),
dense AS MATERIALIZED (
  SELECT g.lang, g.source, v.term, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (v.c + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sums.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
