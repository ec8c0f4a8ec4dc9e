"""DuckDB SQL of the operators that SQL can express.

Written from the contracts alone: lines are compared as whole strings, the
fit is an unrolled chain of window sums.
"""

from __future__ import annotations

from . import mixing

_SPACE = r"[\x20\x09-\x0D]"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, u.line AS line, u.pos AS pos,
         translate(regexp_replace(u.line, '^{_SPACE}+|{_SPACE}+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS pos) u
), repeated AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= {10}
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT l.doc_id, l.pos, l.line, r.owner IS NOT NULL AND r.owner <> l.doc_id AS gone
  FROM lines l LEFT JOIN repeated r ON l.k = r.k
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _mixing_sql(sweeps: int = 24) -> str:
    ctes = [r"""
docs AS (
  SELECT *, CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN n_tokens >= 1000 THEN 'long'
                 WHEN n_tokens >= 200 THEN 'article' ELSE 'short' END AS topic
  FROM (SELECT doc_id, text, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents)
)""", """
cells AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0)"""]
    for dim in mixing.DIMENSIONS:
        ctes.append(f"""
m_{dim} AS (SELECT {dim}, s / sum(s) OVER () AS target_{dim}
            FROM (SELECT {dim}, pow(sum(tokens), {mixing.POWERS[dim]}) AS s FROM cells GROUP BY {dim}))""")
    ctes.append("""
w0 AS (SELECT *, tokens AS w FROM cells JOIN m_source USING (source) JOIN m_lang USING (lang) JOIN m_topic USING (topic))""")
    step = 0
    for _ in range(sweeps):
        for dim in mixing.DIMENSIONS:
            ctes.append(f"""
w{step + 1} AS (SELECT * REPLACE (w * target_{dim} / sum(w) OVER (PARTITION BY {dim}) AS w) FROM w{step})""")
            step += 1
    ctes.append(f"""
ranked AS (  -- cells by falling ratio: the first ones may be capped at 1
  SELECT *, coalesce(sum(tokens) OVER (ORDER BY w / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY w / tokens DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(tokens) OVER () AS total
  FROM w{step}
), scaled AS (
  SELECT min_by(({mixing.KEEP_SHARE} * total - capped) / free, -w / tokens) AS scale FROM ranked
  WHERE ({mixing.KEEP_SHARE} * total - capped) / free * w / tokens < 1
), p AS (SELECT source, lang, topic, least(1.0, scale * w / tokens) AS probability FROM w{step}, scaled)""")
    return "WITH " + ",".join(ctes) + """
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(probability, 0), 9) AS probability,
       CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / pow(2, 52) < coalesce(probability, 0) AS sampled
FROM docs LEFT JOIN p USING (source, lang, topic)
"""


# Anchors and all rows, component by component; the integer products are exact in doubles.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
parts AS (
  SELECT vec_id, label, i, embedding[i] AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM v)),
sound AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))),
q AS (
  SELECT vec_id, label, i, floor(256 * CAST(x AS DOUBLE)) AS z FROM parts WHERE vec_id IN (SELECT vec_id FROM sound)),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(sum(a.z * b.z) AS BIGINT) AS score
  FROM q AS a JOIN q AS b ON a.i = b.i AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
  GROUP BY a.vec_id, a.label, b.vec_id, b.label),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE s.label <> s.own AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""

ORACLE_SQL = {
    "op7_line_dedup": LINE_DEDUP,
    "op10_mixing": _mixing_sql(),
    "op11_hard_negatives": HARD_NEGATIVES,
}
