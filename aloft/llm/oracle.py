"""DuckDB SQL of the queries that SQL can express, written from the operators' definitions."""

_LEVEL = """
{name}_in AS ({source}),
{name}_a AS (SELECT *, budget - coalesce(sum(cap) OVER b, 0) AS left_over, sum(w) OVER p - coalesce(sum(w) OVER b, 0) AS weight_left
    FROM {name}_in WHERE w > 0
    WINDOW p AS (PARTITION BY {parent}), b AS (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_b AS (SELECT *, cap * weight_left <= left_over * w AS saturated FROM {name}_a),
{name}_c AS (SELECT *, budget - sum(CASE WHEN saturated THEN cap ELSE 0 END) OVER p AS rest,
    sum(CASE WHEN saturated THEN 0 ELSE w END) OVER p AS share FROM {name}_b WINDOW p AS (PARTITION BY {parent})),
{name}_d AS (SELECT *, CASE WHEN saturated THEN cap ELSE CAST(floor(CAST(rest AS DOUBLE) * w / greatest(share, 1)) AS BIGINT) END AS got FROM {name}_c),
{name}_e AS (SELECT *, rest - sum(CASE WHEN saturated THEN 0 ELSE got END) OVER (PARTITION BY {parent}) AS spare,
    sum(CASE WHEN saturated THEN 0 ELSE 1 END) OVER (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS UNBOUNDED PRECEDING) AS place FROM {name}_d),
{name} AS (SELECT * EXCLUDE (budget), got + CASE WHEN NOT saturated AND place <= spare THEN 1 ELSE 0 END AS budget FROM {name}_e)"""

OP3 = """
WITH d AS (SELECT doc_id, 'd' || CAST(coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) % 4 AS VARCHAR) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * 4 AS cap,
    CASE WHEN source = 'src0' THEN 8 ELSE 1 END AS w FROM d GROUP BY ALL),
""" + _LEVEL.format(name="l1", parent="1 + 1", child="domain", source="""SELECT domain, sum(cap) AS cap,
    CASE domain WHEN 'd0' THEN 5 ELSE 2 END AS w, (SELECT CAST(floor(sum(tokens) * 1.0) AS BIGINT) FROM leaf) AS budget FROM leaf GROUP BY domain""") + "," \
  + _LEVEL.format(name="l2", parent="domain", child="lang", source="""SELECT x.*, l1.budget FROM (SELECT domain, lang, sum(cap) AS cap,
    CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w FROM leaf GROUP BY ALL) x JOIN l1 USING (domain)""") + "," \
  + _LEVEL.format(name="l3", parent="domain, lang", child="source", source="SELECT leaf.*, l2.budget FROM leaf JOIN l2 USING (domain, lang)") + """,
b AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN CAST(floor(budget / tokens) AS BIGINT) ELSE 0 END AS whole, budget, tokens AS held FROM l3),
k AS (SELECT d.*, whole, budget - whole * held AS rest,
    md5('20260101|' || whole || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(text)) AS key FROM d JOIN b USING (domain, lang, source)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS UNBOUNDED PRECEDING) - tokens AS start FROM k),
n AS (SELECT *, whole + CASE WHEN start < rest THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, domain, lang, source, CAST(unnest(range(copies)) AS INT) AS epoch, tokens FROM n
"""

_WHOLE = """[CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v"""
_FINITE = """embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0"""

OP6 = f"""
WITH e AS (SELECT DISTINCT vec_id, {_WHOLE} FROM embeddings WHERE {_FINITE}),
s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""

OP13 = f"""
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} FROM embeddings
    WHERE label IS NOT NULL AND {_FINITE}),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
    FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE = {"op3_mixing": OP3, "op6_maxscore": OP6, "op13_hard_negatives": OP13}
