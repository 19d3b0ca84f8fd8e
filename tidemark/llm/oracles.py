"""DuckDB SQL for the queries that SQL can express, by plain definitions over all pairs or all runs."""

from __future__ import annotations

from tidemark.llm.chat_format import CONTROL
from tidemark.llm.decontamination import Windows
from tidemark.llm.hard_negatives import Mining
from tidemark.llm.line_dedup import Runs
from tidemark.llm.ngram_join import Join

_BLANKS = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_BLANKS}'), lambda x: x <> '')"


#: Windows that stand earlier; a line goes with any of them.
LINE_DEDUP = f"""WITH raw AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
  u AS (SELECT doc_id, pos, len(words) AS n, array_to_string(words, ' ') AS content, row_number() OVER w AS i, sum(len(words)) OVER w AS cum
        FROM (SELECT *, {_words('line')} AS words FROM raw) WHERE len(words) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
  s AS (SELECT a.doc_id, a.i AS b, c.i AS e FROM u a JOIN u c ON c.doc_id = a.doc_id AND c.i >= a.i AND c.cum - a.cum + a.n >= {Runs().run_words}),
  w AS (SELECT doc_id, b, min(e) AS e FROM s GROUP BY 1, 2 UNION SELECT doc_id, max(b), e FROM s GROUP BY doc_id, e),
  k AS (SELECT w.doc_id, w.b, w.e, string_agg(u.content, chr(10) ORDER BY u.i) AS content FROM w JOIN u ON u.doc_id = w.doc_id AND u.i BETWEEN w.b AND w.e GROUP BY 1, 2, 3),
  d AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY content ORDER BY doc_id, b) AS nth FROM k) WHERE nth > 1),
  gone AS (SELECT DISTINCT d.doc_id, r.pos FROM d JOIN u x ON x.doc_id = d.doc_id AND x.i = d.b JOIN u y ON y.doc_id = d.doc_id AND y.i = d.e
           JOIN raw r ON r.doc_id = d.doc_id AND r.pos BETWEEN x.pos AND y.pos),
  stay AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM raw ANTI JOIN gone USING (doc_id, pos) GROUP BY 1),
  lost AS (SELECT doc_id, count(*) AS n FROM gone JOIN u USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, coalesce(lost.n, 0) AS n_removed, CAST(length(coalesce(stay.text, '')) AS BIGINT) AS n_chars, coalesce(stay.text, '') AS text
FROM documents LEFT JOIN stay USING (doc_id) LEFT JOIN lost USING (doc_id)"""

#: The shingle sets of all documents, all pairs that share a shingle, and what links reach.
NGRAM_JOIN = f"""WITH RECURSIVE t AS (
    SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents),
  g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - {Join().words - 1}, 1) + 1),
        lambda i: array_to_string(words[i:i + {Join().words - 1}], ' '))) AS shingle FROM t WHERE len(words) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 10 * common >= {round(10 * Join().threshold)} * (x.n + y.n - common)),
  r AS (SELECT a AS doc_id, a AS seen FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT d.doc_id, least(d.doc_id, coalesce(c.low, d.doc_id)) AS class_id, coalesce(k.n, 0) AS n_links FROM documents d
LEFT JOIN (SELECT doc_id, min(seen) AS low FROM r GROUP BY 1) c USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM l GROUP BY 1) k USING (doc_id)"""

#: All pairs of sound vectors of a label.
EMBEDDING_DEDUP = """WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
  r AS (SELECT a AS vec_id, a AS seen FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT m.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.low, m.vec_id) AS component_id, coalesce(c.low, m.vec_id) = m.vec_id AS kept FROM embeddings m
LEFT JOIN (SELECT vec_id, min(seen) AS low FROM r GROUP BY 1) c USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1) k USING (vec_id)"""


def _breaks(text: str) -> str:
    """How many characters escaping adds: one for each backslash and each control string."""
    parts = [f"length({text}) - length(replace({text}, chr(92), ''))"]
    parts += [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in CONTROL]
    return " + ".join(parts)


#: What the texts themselves say; the length adds the marks of each turn and what escaping adds.
CHAT_FORMAT = f"""WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) x(turn, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len('<|im_start|>') + len('<|im_end|>') + 2} + length(role) + {_breaks('role')} + length(role) - length(replace(role, chr(10), '')) + length(text) + {_breaks('text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY 1"""


_ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: All windows of all documents against all windows of all items, by their words.
DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
  b AS (SELECT item_id, w, least(len(w), {Windows().words}) AS k FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
  bi AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b),
  g AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM bi),
  di AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM g) WHERE len(w) >= k),
  x AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram FROM di),
  h AS (SELECT * FROM x SEMI JOIN g USING (k, gram)),
  n AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM h) GROUP BY 1),
  t AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h JOIN g USING (k, gram) WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""


_MINING = Mining()

#: The scores of all anchors with all rows.
HARD_NEGATIVES = f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({_MINING.scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {_MINING.positives}),
  n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
        FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND {_MINING.low} * positive_score <= 100 * s.score AND 100 * s.score <= {_MINING.high} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {_MINING.negatives}"""
