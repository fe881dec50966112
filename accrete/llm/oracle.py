"""SQL that gives the same rows, for operators that SQL can express on whole tables."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: str) -> str:
    """Words of op8: A-Z lower-cased, runs of 0-9, a-z and characters beyond ASCII."""
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"list_filter(regexp_split_to_array({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
runs AS (
  SELECT r, s.n, i, array_to_string(w[i : i + s.n - 1], ' ') AS t
  FROM d, (SELECT DISTINCT n FROM win) s, unnest(range(1, len(w) - s.n + 2)) AS u(i)),
hits AS (SELECT r, i, runs.n, item_id FROM runs JOIN win ON runs.n = win.n AND runs.t = win.t),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list_distinct(list(item_id::varchar))), ',') AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::double[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.x, r.c FROM reach r JOIN links l ON l.y = r.vec_id),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
m AS (SELECT vec_id, min(c) AS c FROM reach GROUP BY vec_id)
SELECT e.vec_id, coalesce(n.n, 0)::bigint AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN m ON m.vec_id = e.vec_id
"""

OP2 = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS no, line, trim(regexp_replace(line, '[\t\r\f\x0B]', ' ', 'g')) AS t
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
       unnest(ls) WITH ORDINALITY AS u(line, i)),
d AS (SELECT t, min((doc_id, no)) AS first FROM l WHERE t <> '' GROUP BY t),
near AS (
  SELECT DISTINCT y.t FROM d x JOIN d y ON length(x.t) BETWEEN length(y.t) - 1 AND length(y.t) + 1
  WHERE length(x.t) >= 20 AND length(y.t) >= 20 AND x.first < y.first
    AND (left(x.t, 8) = left(y.t, 8) OR right(x.t, 8) = right(y.t, 8)) AND levenshtein(x.t, y.t) = 1),
kept AS (
  SELECT l.doc_id, no, line FROM l LEFT JOIN d USING (t)
  WHERE t = '' OR (first = (l.doc_id, no) AND t NOT IN (SELECT t FROM near)))
SELECT doc_id, CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY no), '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id) GROUP BY doc_id
"""

def _terms(text: str, between: str) -> str:
    """Terms of op12 and op13: runs of characters other than `between`, A-Z lower-cased."""
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return f"list_filter(regexp_extract_all({lowered}, '[^{between}]+'), lambda w: w <> '')"


OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text", r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F")} AS w FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, {_terms("text", r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F")} AS w FROM benchmark),
size AS (SELECT count(*) AS n, sum(len(w))::bigint AS l FROM d WHERE len(w) > 0),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
tf AS (
  SELECT r, doc_id, len, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS len, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::double / (2 * count(*) + 1)::double))::bigint AS w FROM tf, size GROUP BY term),
part AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len * n) // l))) AS s
  FROM tf JOIN weight USING (term), size),
scored AS (SELECT i, item_id, r, doc_id, sum(times * s)::bigint AS score FROM asked JOIN part USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::int AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20
"""

OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {_terms("text", r"\x00-\x40\x5B-\x60\x7B-\x7F")} AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
own AS (SELECT lang, source, sum(n) AS m FROM cells GROUP BY ALL),
p AS (
  SELECT lang, source, term, n, (1 + (1000000000::hugeint * (n + 5)) // (m + 5 * v)::hugeint)::bigint AS p
  FROM cells JOIN own USING (lang, source) JOIN v USING (lang)),
q AS (
  SELECT lang, term, (1 + (1000000000::hugeint * (sum(n) + 5)) // (any_value(m) + 5 * any_value(v))::hugeint)::bigint AS q
  FROM cells JOIN (SELECT lang, sum(m) AS m FROM own GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::bigint AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, source, 'term', p.term, (p - q)::bigint FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::int AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_embedding_near_dedup": OP1,
    "op2_line_dedup": OP2,
    "op8_decontamination": OP8,
    "op12_ranked_search": OP12,
    "op13_source_audit": OP13,
}
