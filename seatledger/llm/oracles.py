"""DuckDB forms of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"


def _windows(width: int) -> str:
    """Starts 1, 2, ... of the windows of list w."""
    return f"range(1, greatest(len(w) - {width - 2}, 1))"


def _shingles(table: str, key: str) -> str:
    return f"""
        SELECT DISTINCT {key}, g FROM (
          SELECT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform({_windows(5)}, lambda i: array_to_string(w[i:i+4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
          FROM (SELECT {key}, {_LOWER_WORDS} AS w FROM {table}))"""


_OP2 = r"""
WITH l AS (
  SELECT doc_id, p, x, translate(trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(s) AS x, unnest(range(len(s))) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
r AS (SELECT k, min(doc_id) AS f FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT l.*, r.f IS NOT NULL AND r.f <> doc_id AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

#: Weights of the mixture's nodes by level; other names weigh 1.
_WEIGHTS = {
    "domain": "CASE domain WHEN '0' THEN 2 WHEN '1' THEN 3 WHEN '2' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END",
    "source": "1",
}


def _family(levels: list[str]) -> str:
    """Budgets of the nodes of a level. A node is full if its family's needs, at the water level
    at which it becomes full, stay within the budget; the others share the rest by weight."""
    above, own, table = levels[:-1], levels[-1], "_".join(levels)
    family = f"PARTITION BY {', '.join(above)}" if above else ""
    joined = f"USING ({', '.join(above)})" if above else "ON true"
    return f"""
n_{table} AS (
  SELECT {', '.join(f'n.{c}' for c in levels)}, n.cap, n.weight, p.quota AS budget
  FROM (SELECT {', '.join(levels)}, sum(2 * tokens) AS cap, any_value({_WEIGHTS[own]}) AS weight FROM leaf GROUP BY ALL) n
  JOIN {f"q_{'_'.join(above)}" if above else 'root'} p {joined}),
f_{table} AS (
  SELECT a.*, (SELECT sum(least(b.cap * a.weight, b.weight * a.cap)) FROM n_{table} b
               WHERE {' AND '.join([f'b.{c} = a.{c}' for c in above] or ['true'])}) <= a.budget * a.weight AS is_full
  FROM n_{table} a),
o_{table} AS (
  SELECT *, budget - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({family}), 0) AS rest,
         sum(weight) FILTER (WHERE NOT is_full) OVER ({family}) AS every,
         sum(weight) FILTER (WHERE NOT is_full) OVER ({family} ORDER BY cap::DOUBLE / weight, {own}) AS upto
  FROM f_{table}),
q_{table} AS (
  SELECT {', '.join(levels)}, (CASE WHEN is_full THEN cap ELSE rest * upto // every - rest * (upto - weight) // every END)::BIGINT AS quota
  FROM o_{table})"""


_OP3 = rf"""
WITH d AS (
  SELECT doc_id, coalesce((TRY_CAST(nullif(regexp_extract(source, '(\d{{1,9}})$', 1), '') AS BIGINT) % 4)::VARCHAR, '?') AS domain,
         coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
         md5(concat_ws(chr(31), 11, doc_id, text)) AS h, len({_WORDS})::BIGINT AS n
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
root AS (SELECT least(floor(sum(tokens) * 0.5)::BIGINT, sum(2 * tokens)) AS quota FROM leaf),
{_family(['domain'])},
{_family(['domain', 'lang'])},
{_family(['domain', 'lang', 'source'])},
c AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS whole, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS part
      FROM leaf JOIN q_domain_lang_source USING (domain, lang, source)),
r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat_ws(chr(31), whole, h))
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
      FROM d JOIN c USING (domain, lang, source))
SELECT doc_id, domain, lang, source, unnest(range(whole)) AS epoch, n AS n_tokens, n AS take_tokens FROM r
UNION ALL
SELECT doc_id, domain, lang, source, whole, n, least(n, part - b)::BIGINT FROM r WHERE b < part"""

_OP4 = f"""
WITH i AS ({_shingles('benchmark', 'item_id')}),
v AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
k AS (SELECT 5 AS k UNION SELECT len(string_split(g, ' ')) FROM i),
d AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g
  FROM v JOIN k ON len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found
FROM d JOIN i USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) * 100 >= n_shingles * 75"""

_OP5 = f"""
WITH RECURSIVE d AS ({_shingles('documents', 'doc_id')}),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM d a JOIN d b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)"""

#: Measures of operator 6 as whole numbers, and the bins of their sketches with their borders.
_MEASURES = """
  SELECT doc_id, lang, source, unnest(['symbol_share', 'word_share', 'word_length', 'capital_share']) AS measure,
         unnest([marks * 100000 // word_chars,
                 trunc(greatest(commonest - 2 * sqrt(commonest::DOUBLE), 0::DOUBLE) * 100000 / n_words)::BIGINT,
                 (word_chars - marks) * 1000 // n_words, capitals * 100000 // word_chars]) AS v
  FROM j WHERE NOT base_failed"""
_BIN = "CASE WHEN v < 64 THEN v ELSE (len(bin(v)) - 6) * 32 + (v >> (len(bin(v)) - 6)) END"


def _top(b: str) -> str:
    return f"(CASE WHEN {b} < 64 THEN {b} ELSE (({b} % 32 + 33) << ({b} // 32 - 1)) - 1 END)"


def _fence(table: str, by: str) -> str:
    """Quantiles 0.1 and 0.4 of a weighted sketch, interpolated in their bins, and the fence."""
    bottom = f"(CASE WHEN bin > 0 THEN {_top('(bin - 1)')} + 1 ELSE 0 END)"
    at = lambda q: f"arg_min({bottom} + (every * {q}::DOUBLE - (upto - w)) / w::DOUBLE * ({_top('bin')} - {bottom}), bin) FILTER (WHERE upto >= every * {q}::DOUBLE)"  # noqa: E731
    return f"""
  SELECT *, centre + (centre - low) * 10 AS fence FROM (
    SELECT {by}, {at('0.1')} AS low, {at('0.4')} AS centre FROM (
      SELECT *, (sum(w) OVER (PARTITION BY {by} ORDER BY bin))::DOUBLE AS upto, (sum(w) OVER (PARTITION BY {by}))::DOUBLE AS every
      FROM {table}) GROUP BY {by})"""


def _lean(own: str, larger: str, by: str, shared: str) -> str:
    """A sketch with 20 documents' worth of the larger group's, in millionths of a document."""
    return f"""
  SELECT {by}, bin, sum(w)::BIGINT AS w FROM (
    SELECT {by}, bin, n * 1000000 AS w FROM {own}
    UNION ALL
    SELECT {by}, bin, w FROM (SELECT DISTINCT {by} FROM {own})
    JOIN (SELECT {shared}, bin, n * 20000000 // sum(n) OVER (PARTITION BY {shared}) AS w FROM {larger}) USING ({shared}))
  WHERE w > 0 GROUP BY {by}, bin"""


_OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '?') AS lang, coalesce(source, '?') AS source, coalesce(text, '') AS x, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest({_windows(5)}) AS i FROM d)),
t AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM s), range(5) r(k)
      WHERE c > 1 GROUP BY doc_id),
u AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, y, count(*) AS n FROM (SELECT doc_id, unnest(w) AS y FROM d) GROUP BY ALL) GROUP BY doc_id),
b AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda y: len(y))), 0)::BIGINT AS word_chars,
         len(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^ 	-]')) AS lines,
         coalesce(t.n, 0) AS n_repeat_words, len(regexp_replace(x, '[^!-/:-@\[-`{{-~]', '', 'g')) AS marks,
         len(regexp_replace(x, '[^A-Z]', '', 'g')) AS capitals, coalesce(u.n, 0) AS commonest
  FROM d LEFT JOIN t USING (doc_id) LEFT JOIN u USING (doc_id)),
j AS (SELECT * EXCLUDE (lines), (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
v AS ({_MEASURES}),
by_source AS (SELECT lang, source, measure, {_BIN} AS bin, count(*) AS n FROM v GROUP BY ALL),
by_lang AS (SELECT lang, measure, bin, sum(n)::BIGINT AS n FROM by_source GROUP BY ALL),
by_none AS (SELECT measure, bin, sum(n)::BIGINT AS n FROM by_lang GROUP BY ALL),
w_lang AS ({_lean('by_lang', 'by_none', 'lang, measure', 'measure')}),
w_source AS ({_lean('by_source', 'by_lang', 'lang, source, measure', 'lang, measure')}),
w_none AS (SELECT measure, bin, n * 1000000 AS w FROM by_none),
f AS ({_fence('w_none', 'measure')}),
l AS ({_fence('w_lang', 'lang, measure')}),
o AS ({_fence('w_source', 'lang, source, measure')}),
h AS (SELECT lang, measure, l.centre, CASE WHEN l.low <= f.centre THEN least(l.fence, f.fence) ELSE l.fence END AS fence FROM l JOIN f USING (measure)),
limits AS (SELECT lang, o.source, measure, CASE WHEN o.low <= h.centre THEN least(o.fence, h.fence) ELSE o.fence END AS fence
           FROM o JOIN h USING (lang, measure)),
over AS (SELECT DISTINCT doc_id FROM v JOIN limits USING (lang, source, measure) WHERE v > fence)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM over) AS kept
FROM j"""

_OP7 = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY turn, role, text) AS l FROM t GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM c
      WHERE NOT EXISTS (SELECT 1 FROM c d WHERE len(d.l) > len(c.l) AND d.l[1:len(c.l)] = c.l) GROUP BY l),
p AS (SELECT conv_id, len(l) AS n_turns, n_copies, unnest(l) AS v, unnest(range(len(l))) AS i FROM k JOIN c USING (conv_id))
SELECT conv_id, i // 256 AS piece, n_turns, n_copies,
       string_agg('<|im_start|>' || v.r || chr(10) || v.x || '<|im_end|>' || chr(10), '' ORDER BY i) AS rendered
FROM p GROUP BY conv_id, piece, n_turns, n_copies"""

_OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest({_windows(13)}) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS f FROM s GROUP BY g HAVING count(DISTINCT doc_id) > 1),
x AS (SELECT DISTINCT doc_id, i + j AS p FROM s JOIN f USING (g), range(13) t(j) WHERE f < doc_id),
y AS (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM d),
z AS (SELECT y.doc_id, string_agg(v, ' ' ORDER BY p) FILTER (WHERE x.p IS NULL) AS kept, count(x.p) AS n
      FROM y LEFT JOIN x USING (doc_id, p) GROUP BY y.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN z USING (doc_id)"""

#: CRC-32 of the decimal conv_id: byte by byte, each by eight shifts with the reflected polynomial.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)::UBIGINT[]),
        lambda s, k: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384 ELSE 0 END::UBIGINT))))"""

_OP11 = rf"""
WITH t AS (
  SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS v,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(v ORDER BY p) AS l FROM t GROUP BY c),
h AS (SELECT c, l, c - c % 20 AS b, {_CRC32} % 4 AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(list_slice(b.l, 1, h.h::BIGINT), []), list_slice(h.l, h.h::BIGINT + 1, len(h.l))) AS l
      FROM h LEFT JOIN o b ON b.c = h.b),
m AS (SELECT c, len(l) AS n, d, list_slice(l, 1, d) AS s FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM r)),
k AS (
  SELECT s, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
  FROM m GROUP BY s, d),
e AS (SELECT s[1:d - 1] AS s, d - 1 AS d, count(*) AS n FROM k WHERE d > 0 GROUP BY ALL),
f AS (SELECT k.*, coalesce(e.n, 0) AS n_children FROM k LEFT JOIN e USING (s, d)),
g AS (
  SELECT a.s, a.d, count(*) FILTER (WHERE z.n_children = 0) AS n_leaves, sum((z.n_convs - 1) * z.w)::BIGINT AS saved_tokens
  FROM (SELECT n_convs, n_children, w, s AS whole, unnest(range(d + 1)) AS d FROM f) z
  JOIN f a ON a.d = z.d AND a.s = list_slice(z.whole, 1, z.d) GROUP BY a.s, a.d)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, g.n_leaves, g.saved_tokens, f.ends_sha256
FROM f JOIN g USING (s, d) LEFT JOIN f p ON p.d = f.d - 1 AND p.s = f.s[1:f.d - 1]"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT anchor_id, positive_id, positive_score, s.vec_id, s.score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
WHERE rank <= 3"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_line_dedup": _OP2,
        "op3_source_mixing": _OP3,
        "op4_benchmark_decontamination": _OP4,
        "op5_minhash_near_dedup": _OP5,
        "op6_quality_rules": _OP6,
        "op7_chat_formatting": _OP7,
        "op10_substring_dedup": _OP10,
        "op11_prefix_trie": _OP11,
        "op12_hard_negatives": _OP12,
    }
