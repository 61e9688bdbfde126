"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from toxiscope.llm.licenses import TEMPLATES

OP2_MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s
), o AS (
  SELECT *,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
    sum(source_size) OVER () AS total
  FROM w
), l AS (
  SELECT min_by((1.5 * total - held) / open_weight, 2.0 * source_size / weight) FILTER
    (WHERE (1.5 * total - held) / open_weight < 2.0 * source_size / weight) AS level FROM o
), t AS (
  SELECT source, source_size, least(2.0 * source_size, weight * coalesce(level, 0)) AS target FROM w, l
), r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5('20:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
      / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

#: Lines, their windows of at least five words, and the lines of later copies. ``docs`` is
#: a table expression with doc_id and text.
LINE_DEDUP = r"""
  l0 AS (
    SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs} WHERE text IS NOT NULL)
  ), l1 AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l0
  ), l2 AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos,
      sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) AS upto
    FROM l1 WHERE words > 0
  ), seqs AS (
    SELECT doc_id, list(line ORDER BY pos) AS ls FROM l2 GROUP BY doc_id
  ), pairs AS (
    SELECT a.doc_id, a.pos AS p, b.pos AS e FROM l2 a JOIN l2 b
      ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + 4 AND b.upto - a.upto + a.words >= 5
  ), wins AS (
    SELECT doc_id, p, min(e) AS e FROM pairs GROUP BY doc_id, p
    UNION SELECT doc_id, max(p) AS p, e FROM pairs GROUP BY doc_id, e
  ), named AS (
    SELECT doc_id, p, e, row_number() OVER (PARTITION BY list_slice(ls, p, e) ORDER BY doc_id, p) AS copy
    FROM wins JOIN seqs USING (doc_id)
  ), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, e + 1)) AS pos FROM named WHERE copy > 1
  ), gone_lines AS (
    SELECT doc_id, line_no FROM gone JOIN l2 USING (doc_id, pos)
  ), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text
    FROM l0 ANTI JOIN gone_lines USING (doc_id, line_no) GROUP BY doc_id
  ), cut AS (
    SELECT doc_id, count(*) AS n_removed, string_agg(line_no, ',' ORDER BY line_no) AS removed
    FROM gone_lines GROUP BY doc_id
  )
"""

OP5_LINEDEDUP = "WITH " + LINE_DEDUP.format(docs="documents") + r"""
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed,
  md5(CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END) AS text_md5
FROM documents d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7_TOOLCALLS = r"""
WITH e AS (
  SELECT conv_id, turn, role, text,
    CASE WHEN role IN ('user', 'system') THEN 'call' WHEN role = 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE WHEN role IN ('user', 'system') THEN 'call_' || turn WHEN role = 'assistant' THEN 'call_' || (turn - 1) END AS call_id,
    CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS position
  FROM conversations
), j AS (
  SELECT a.*, b.turn AS linked_turn
  FROM e a LEFT JOIN e b ON a.conv_id = b.conv_id AND a.call_id = b.call_id AND a.kind <> b.kind
)
SELECT conv_id, position, turn, kind, call_id, linked_turn,
  CASE WHEN kind = 'message' THEN 'message' WHEN linked_turn IS NOT NULL THEN 'linked'
       WHEN kind = 'call' THEN 'unanswered' ELSE 'orphan' END AS status,
  CASE role WHEN 'user' THEN CASE WHEN length(text) < 20 THEN 'short:query' ELSE '' END
            WHEN 'system' THEN CASE WHEN length(text) < 1 THEN 'short:prompt' ELSE '' END END AS problems,
  md5(CASE role
    WHEN 'user' THEN '{"role":"assistant","tool_calls":[{'
      || CASE WHEN turn >= 2 THEN '"after":["call_' || (turn - 2) || '"],' ELSE '' END
      || '"arguments":{"query":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"id":"' || call_id
      || '","name":"ask"}]}'
    WHEN 'system' THEN '{"role":"assistant","tool_calls":[{"arguments":{"prompt":' || CAST(to_json(text) AS VARCHAR)
      || '},"id":"' || call_id || '","name":"configure"}]}'
    WHEN 'assistant' THEN '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":"tool","tool_call_id":"' || call_id || '"}'
    ELSE '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}' END) AS json_md5
FROM j
"""

OP9_KDTREE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_NOT_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_NOT_WORD}')"


def license_sql(templates, gram: int = 3, least: float = 0.8, exact_below: int = 10, shift: float = 0.125) -> str:
    """Positions of the templates' word k-grams, compared as lists, without hashes."""
    rows = ", ".join(
        "({}, '{}', {}, '{}')".format(i, t.label, t.base, t.text.replace("'", "''")) for i, t in enumerate(templates)
    )
    covered = f"""list_sum([CASE WHEN i = len(p) THEN {gram} ELSE least(p[i + 1] - p[i], {gram}) END FOR i IN range(1, len(p) + 1)])"""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, {_words_sql('text')} AS ws FROM documents
), t0 AS (
  SELECT id, label, base, {_words_sql('body')} AS ws FROM (VALUES {rows}) v(id, label, base, body)
), t AS (
  SELECT id, label, base, len(ws) AS size, unnest(range(len(ws) - {gram - 1})) AS place, ws FROM t0
), g AS (
  SELECT uid, ws, unnest(range(greatest(len(ws) - {gram - 1}, 0))) AS place FROM d
), hit AS (
  SELECT g.uid, t.id, g.place AS spot, t.place, g.place - t.place AS diagonal
  FROM g JOIN t ON g.ws[g.place + 1 : g.place + {gram}] = t.ws[t.place + 1 : t.place + {gram}]
), diag AS (
  SELECT uid, id, diagonal, min(spot) AS a, max(spot) AS b, list_sort(list(place)) AS p FROM hit GROUP BY ALL
), alone AS (
  SELECT diag.*, label, base, size, {covered} / greatest(size, b + {gram} - a)::DOUBLE AS sim
  FROM diag JOIN (SELECT id, label, base, len(ws) AS size FROM t0) USING (id)
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w > floor(size * {shift}) OR lag(diagonal) OVER w IS NULL THEN 1 ELSE 0 END AS new
  FROM alone WINDOW w AS (PARTITION BY uid, id ORDER BY diagonal)
), parts AS (
  SELECT *, sum(new) OVER (PARTITION BY uid, id ORDER BY diagonal) AS part FROM marked
), merged AS (
  SELECT uid, id, part, label, base, size, max(sim) AS best, min(a) AS a, max(b) AS b,
         list_sort(list_distinct(flatten(list(p)))) AS p
  FROM parts GROUP BY ALL
), verified AS (
  SELECT uid, label, sim FROM (
    SELECT *, greatest(best, {covered} / greatest(size, b + {gram} - a)::DOUBLE) AS sim FROM merged WHERE NOT base
  ) WHERE sim >= CASE WHEN size < {exact_below} THEN 1.0 ELSE {least} END
), exact AS (
  SELECT uid, label, diagonal AS start FROM alone WHERE base AND len(p) = size - {gram - 1}
), e AS (
  SELECT uid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM exact GROUP BY uid
), a AS (
  SELECT uid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sim) AS score
  FROM (SELECT * FROM verified UNION ALL SELECT uid, label, 1.0 FROM exact) GROUP BY uid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(CAST(coalesce(score, 0) AS DOUBLE), 6) AS score
FROM d LEFT JOIN e USING (uid) LEFT JOIN a USING (uid)
"""


ORACLES: dict[str, str] = {
    "op2_mixing": OP2_MIXING,
    "op5_linededup": OP5_LINEDEDUP,
    "op7_toolcalls": OP7_TOOLCALLS,
    "op9_kdtree": OP9_KDTREE,
    "op11_licenses": license_sql(TEMPLATES),
}
