"""Plain SQL for the queries of this subpackage that SQL can express, for an independent engine."""

from __future__ import annotations

from wardline.llm.chat_format import CONTROL, MARKS


def _escaped(c: str) -> str:
    out = rf"replace({c}, '\', '\\')"
    for s in CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


#: Each turn's place follows from the tokens before it; a window holds the turns of one cell, or one that crosses its end.
CHAT_FORMAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
counted AS (SELECT *, {MARKS} + len(regexp_extract_all(body,
  '[\p{{L}}\p{{M}}]+|\p{{N}}+|[^\x09-\x0d\x20\p{{L}}\p{{M}}\p{{N}}]')) AS tokens,
  24 + length({_escaped("role")}) + length({_escaped("body")}) AS chars FROM turns),
placed AS (SELECT *, CAST(sum(tokens) OVER w - tokens AS BIGINT) AS start FROM counted
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, body ROWS UNBOUNDED PRECEDING)),
cells AS (SELECT *, start // 768 AS cell, min(start) OVER (PARTITION BY conv_id, start // 768) AS first FROM placed),
marked AS (SELECT *, start + tokens - first > 768 AND start + tokens > (cell + 1) * 768 AS alone,
  start = 0 AND role = 'system' AS is_system FROM cells),
heads AS (SELECT conv_id, cell, alone, min(CASE WHEN alone THEN start ELSE first END) AS begins,
  bool_or(is_system) AS own FROM marked GROUP BY ALL),
parts AS (SELECT conv_id, chars FROM marked
  UNION ALL SELECT conv_id, chars FROM marked m JOIN heads h USING (conv_id)
    WHERE NOT is_system AND start + tokens <= begins AND start >= begins - 256
  UNION ALL SELECT conv_id, chars FROM marked JOIN heads USING (conv_id) WHERE is_system AND NOT own),
read AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || body || chr(10), '' ORDER BY start) AS whole,
  coalesce(string_agg(body, '' ORDER BY start) FILTER (WHERE role = 'assistant'), '') AS loss FROM placed GROUP BY 1)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  (SELECT CAST(sum(chars) AS BIGINT) FROM parts p WHERE p.conv_id = read.conv_id) AS formatted_chars
FROM read"""

#: Words by piece, all their runs of up to four, and for each frequent run its lowest cut and the runs around it.
COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
runs AS (SELECT lang, unnest(list_transform(range(i, least(i + 4, len(w) + 1)), lambda j: w[i:j])) AS w FROM placed),
f AS (SELECT lang, w, count(*) AS f FROM runs GROUP BY ALL),
said AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY 1),
cand AS (SELECT lang, w, f AS a FROM f WHERE len(w) > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, len(w))) AS k FROM cand),
scored AS (SELECT c.lang, c.w, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN f y ON y.lang = c.lang AND y.w = c.w[c.k + 1:len(c.w)]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
inner_ AS (SELECT lang, w, a, unnest(range(1, len(w))) AS i FROM cand WHERE len(w) > 2),
inside AS (SELECT lang, unnest(list_transform(range(i + 1, len(w) + 1), lambda j: w[i:j])) AS s, w, a FROM inner_),
around AS (SELECT lang, s, max(a) AS a FROM inside WHERE len(s) < len(w) GROUP BY ALL),
kept AS (SELECT l.*, array_to_string(l.w, ' ') AS phrase FROM lowest l LEFT JOIN around o ON o.lang = l.lang AND o.s = l.w
  WHERE o.a IS NULL OR 100 * CAST(o.a AS HUGEINT) < 80 * CAST(l.a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN said USING (lang) WHERE rank <= 2000"""

#: Every query against every row; the sums are whole numbers that doubles hold.
NEAREST_VECTORS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
pairs AS (SELECT q.vec_id AS query_id, s.vec_id, CAST(list_inner_product(q.x, s.x) AS BIGINT) AS score
  FROM v q JOIN v s ON q.vec_id % 100 = 0 AND q.vec_id <> s.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

TEXTS = {"op7_chat_format": CHAT_FORMAT, "op12_collocations": COLLOCATIONS, "op13_nearest_vectors": NEAREST_VECTORS}
