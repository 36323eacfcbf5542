"""DuckDB SQL spellings of the text expressions, for the oracles only.

Each helper takes a SQL expression string and returns one. They follow the
same Python-``re`` parity rules as :mod:`loomgraph.functions.text`, with
RE2 class syntax.
"""

from __future__ import annotations

from loomgraph.functions.text import WS_RE2 as WS

WORD = r"\p{L}\p{N}_"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q(f'^[{WS}]+|[{WS}]+\\z')}, '', 'g')"


def collapse_ws(e: str) -> str:
    return f"regexp_replace({e}, {q(f'[{WS}]+')}, ' ', 'g')"


def english_fix(e: str) -> str:
    e = f"replace(replace({e}, {q(' n' + chr(39) + 't')}, {q('n' + chr(39) + 't')}), {q(' ' + chr(39))}, {q(chr(39))})"
    return f"regexp_replace({e}, {q(f'[{WS}]([?.!,' + chr(39) + '])')}, '\\1', 'g')"


def clean_text(e: str) -> str:
    e = collapse_ws(e)
    e = f"regexp_replace({e}, {q(f'[^{WORD}{WS}.,!?]')}, '', 'g')"
    return strip(e)


def word_count(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, {q(f'[^{WS}]+')})) AS BIGINT)"


def letter_count(e: str) -> str:
    return f"CAST(length(regexp_replace({e}, '[^\\p{{L}}]', '', 'g')) AS BIGINT)"


def good_text(e: str, min_words: int, min_ratio: float) -> str:
    s = strip(e)
    return (f"({word_count(s)} >= {min_words} AND "
            f"{letter_count(s)} / greatest(1, length({s})) >= {float(min_ratio)!r})")


def good_line(e: str) -> str:
    return good_text(e, 5, 0.3)


def good_summary(e: str) -> str:
    return good_text(e, 8, 0.4)


def sentence_split(e: str) -> str:
    return (f"string_split(regexp_replace({e}, {q(f'([.?!])[{WS}]+')}, '\\1' || chr(1), 'g'), chr(1))")


def summary_fix(e: str) -> str:
    e = f"replace({e}, ' .', '.')"
    e = collapse_ws(e)
    e = f"regexp_replace({e}, '\\.\\.+', '.', 'g')"
    return strip(e)


def node_text(e: str) -> str:
    return strip(collapse_ws(f"regexp_replace({e}, '[\\n,.]', ' ', 'g')"))


def script_clean(e: str, lo: int, hi: int) -> str:
    e = f"regexp_replace({e}, '\\([^\\n]*?\\)', '', 'g')"
    e = f"regexp_replace({e}, {q(f'[^\\x{{{lo:x}}}-\\x{{{hi:x}}}{WS}\\x{{964}}.!?]')}, '', 'g')"
    e = f"regexp_replace({e}, {q(f'[{WS}]{{2,}}')}, ' ', 'g')"
    return strip(e)


def whitespace_tokens(e: str) -> str:
    s = strip(e)
    return f"(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, {q(f'[{WS}]+')}) END)"


def clean_docs_cte(table: str = "documents") -> str:
    """``clean(doc_id, text)``: P1 then P2 on every document."""
    return (f"clean AS (SELECT doc_id, {clean_text(english_fix('coalesce(text, ' + q('') + ')'))} AS text "
            f"FROM {table})")


def sentences_cte() -> str:
    """``good`` documents and their ``sents(doc_id, pos, sentence)``; needs ``clean``."""
    return f"""good AS (SELECT doc_id, text FROM clean WHERE {good_line('text')}),
pieces AS (
  SELECT doc_id, parts FROM (SELECT doc_id, {sentence_split('text')} AS parts FROM good)),
exploded AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, unnest(parts) AS piece
  FROM pieces),
sents AS (
  SELECT doc_id, pos, {strip('piece')} AS sentence FROM exploded
  WHERE {strip('piece')} <> '' AND {good_line(strip('piece'))})"""


def budget_cut(text: str, budget, nw: str = "nw") -> str:
    """``text``, cut to the words left where the running count ``run`` passes ``budget``."""
    return (f"CASE WHEN run <= {budget} THEN {text} ELSE "
            f"array_to_string(({whitespace_tokens(text)})[1:CAST({budget} - (run - {nw}) AS BIGINT)], ' ') END")


def louvain_sweep(vertices: str, colours: int = 8) -> str:
    """CTEs up to ``swept(u, c)``: one Louvain sweep over ``und(src, dst,
    weight)`` and the vertices ``u`` of a query, a chain of CTEs per round."""
    from loomgraph.operators.louvain import HASH_MOD, HASH_MULT
    sql = f"""ew AS (SELECT src, dst, CAST(round(weight * 1e6) AS BIGINT) AS w FROM und),
adj AS MATERIALIZED (SELECT src AS u, dst AS v, w FROM ew WHERE w > 0 UNION ALL SELECT dst, src, w FROM ew WHERE w > 0),
deg AS MATERIALIZED (SELECT x.u, coalesce(a.k, 0) AS k, ((x.u % {HASH_MOD}) * {HASH_MULT} % {HASH_MOD} // 65536) % {colours} AS col
        FROM ({vertices}) x LEFT JOIN (SELECT u, sum(w) AS k FROM adj GROUP BY u) a ON a.u = x.u),
m AS (SELECT sum(k) AS m2 FROM deg),
l0 AS MATERIALIZED (SELECT u, u AS c FROM deg)"""
    for r in range(colours):
        name = "swept" if r + 1 == colours else f"l{r + 1}"
        sql += f""",
tot{r} AS (SELECT c, sum(k) AS tot FROM l{r} JOIN deg USING (u) GROUP BY c),
mv{r} AS (SELECT u, c AS own, k FROM l{r} JOIN deg USING (u) WHERE col = {r}),
kin{r} AS (SELECT u, own, k, c, sum(kin) AS kin FROM (
    SELECT mv.u, mv.own, mv.k, l.c, a.w AS kin FROM mv{r} mv JOIN adj a ON a.u = mv.u JOIN l{r} l ON l.u = a.v
    UNION ALL SELECT u, own, k, own, 0 FROM mv{r}) GROUP BY u, own, k, c),
best{r} AS (SELECT u, c FROM (
    SELECT u, c, row_number() OVER (PARTITION BY u ORDER BY
        CAST(m2 AS HUGEINT) * kin - CAST(k AS HUGEINT) * (tot - CASE WHEN c = own THEN k ELSE 0 END) DESC,
        c = own DESC, c) AS rk
    FROM kin{r} JOIN tot{r} USING (c), m) WHERE rk = 1),
{name} AS MATERIALIZED (SELECT l.u, coalesce(b.c, l.c) AS c FROM l{r} l LEFT JOIN best{r} b USING (u))"""
    return sql


def louvain(vertices: str, levels: int = 14, colours: int = 8, min_gain: float = 1e-6) -> str:
    """CTEs up to ``swept(u, c)``: the whole Louvain job over ``und(src, dst,
    weight)`` and the vertices ``u`` of a query. A level is a recursion whose step
    is a round of one colour class; ``levels`` must reach the one that moves
    nobody (each further one changes nothing)."""
    from loomgraph.operators.louvain import HASH_MOD, HASH_MULT
    sql = f"""ew AS (SELECT src, dst, CAST(round(weight * 1e6) AS BIGINT) AS w FROM und),
adj0 AS MATERIALIZED (SELECT src AS u, dst AS v, w FROM ew WHERE w > 0 UNION ALL SELECT dst, src, w FROM ew WHERE w > 0),
loop0 AS (SELECT u, w FROM adj0 WHERE false),
node0 AS MATERIALIZED ({vertices}),
member0 AS (SELECT u AS id, u AS node FROM node0)"""
    for n in range(levels):
        sql += f""",
deg{n} AS MATERIALIZED (
  SELECT x.u, coalesce(a.k, 0) + 2 * coalesce(l.w, 0) AS k, ((x.u % {HASH_MOD}) * {HASH_MULT} % {HASH_MOD} // 65536) % {colours} AS col
  FROM node{n} x LEFT JOIN (SELECT u, sum(w) AS k FROM adj{n} GROUP BY u) a ON a.u = x.u
  LEFT JOIN (SELECT u, sum(w) AS w FROM loop{n} GROUP BY u) l ON l.u = x.u),
m{n} AS MATERIALIZED (SELECT sum(k) AS m2 FROM deg{n}),
loops{n} AS MATERIALIZED (SELECT u, sum(w) AS w FROM loop{n} GROUP BY u),
lv{n}(r, u, c, act, bc, bq) AS (
  SELECT 0, u, u, true, u, (SELECT CAST(2 * coalesce((SELECT sum(w) FROM loops{n}), 0) AS DOUBLE) / m2
                            - CAST(sum(CAST(k AS HUGEINT) * k) AS DOUBLE) / (CAST(m2 AS DOUBLE) * CAST(m2 AS DOUBLE))
                            FROM deg{n}, m{n} GROUP BY m2) FROM deg{n}, m{n} WHERE m2 > 0
  UNION ALL
  (WITH cur AS (SELECT lv{n}.r, lv{n}.u, lv{n}.c, lv{n}.act, lv{n}.bc, lv{n}.bq, k, col FROM lv{n} JOIN deg{n} d ON d.u = lv{n}.u),
   tot AS (SELECT c, sum(k) AS tot FROM cur GROUP BY c),
   mv AS (SELECT u, c AS own, k FROM cur WHERE act AND col = r % {colours}),
   kin AS (SELECT u, own, k, c, sum(kin) AS kin FROM (
      SELECT mv.u, mv.own, mv.k, l.c, a.w AS kin FROM mv JOIN adj{n} a ON a.u = mv.u JOIN cur l ON l.u = a.v
      UNION ALL SELECT u, own, k, own, 0 FROM mv) GROUP BY u, own, k, c),
   best AS (SELECT u, own, c FROM (
      SELECT u, own, c, row_number() OVER (PARTITION BY u ORDER BY
          CAST(m2 AS HUGEINT) * kin - CAST(k AS HUGEINT) * (tot - CASE WHEN c = own THEN k ELSE 0 END) DESC, c = own DESC, c) AS rk
      FROM kin JOIN tot USING (c), m{n}) WHERE rk = 1),
   again AS (SELECT DISTINCT v AS u FROM adj{n} JOIN best ON best.u = adj{n}.u AND best.c <> best.own),
   nxt AS (SELECT cur.r, cur.u, coalesce(best.c, cur.c) AS c, again.u IS NOT NULL OR (cur.act AND best.u IS NULL) AS act, bc, bq, k
           FROM cur LEFT JOIN best ON best.u = cur.u LEFT JOIN again ON again.u = cur.u),
   lab AS (SELECT r, u, CASE WHEN (r + 1) % {colours} = 0 THEN min(u) OVER (PARTITION BY c) ELSE c END AS c, act, bc, bq, k FROM nxt),
   inn AS (SELECT sum(w) AS s FROM (
      SELECT CAST(w AS HUGEINT) AS w FROM adj{n} a JOIN lab x ON x.u = a.u JOIN lab y ON y.u = a.v WHERE x.c = y.c
      UNION ALL SELECT CAST(2 * w AS HUGEINT) FROM loops{n})),
   q AS (SELECT CAST(coalesce((SELECT s FROM inn), 0) AS DOUBLE) / m2
                - CAST(sum(t * t) AS DOUBLE) / (CAST(m2 AS DOUBLE) * CAST(m2 AS DOUBLE)) AS q
         FROM (SELECT CAST(sum(k) AS HUGEINT) AS t FROM lab GROUP BY c), m{n} GROUP BY m2)
   SELECT r + 1, u, c, act, CASE WHEN (r + 1) % {colours} = 0 THEN c ELSE bc END, CASE WHEN (r + 1) % {colours} = 0 THEN q ELSE bq END
   FROM lab, q WHERE (r + 1) % {colours} <> 0 OR q > bq + {min_gain})),
lab{n} AS MATERIALIZED (SELECT node{n}.u, coalesce(l.bc, node{n}.u) AS c FROM node{n}
   LEFT JOIN (SELECT u, arg_max(bc, r) AS bc FROM lv{n} GROUP BY u) l ON l.u = node{n}.u),
member{n + 1} AS MATERIALIZED (SELECT id, c AS node FROM member{n} JOIN lab{n} ON lab{n}.u = node),
agg{n} AS MATERIALIZED (SELECT x.c AS cu, y.c AS cv, sum(w) AS w FROM adj{n} a JOIN lab{n} x ON x.u = a.u JOIN lab{n} y ON y.u = a.v GROUP BY x.c, y.c),
adj{n + 1} AS MATERIALIZED (SELECT cu AS u, cv AS v, CAST(w AS BIGINT) AS w FROM agg{n} WHERE cu <> cv),
loop{n + 1} AS MATERIALIZED (SELECT cu AS u, CAST(w AS BIGINT) // 2 AS w FROM agg{n} WHERE cu = cv
   UNION ALL SELECT x.c, l.w FROM loops{n} l JOIN lab{n} x ON x.u = l.u),
node{n + 1} AS MATERIALIZED (SELECT DISTINCT c AS u FROM lab{n})"""
    return sql + f""",
swept AS (SELECT id AS u, min(id) OVER (PARTITION BY node) AS c FROM member{levels})"""


def recursive(sql: str) -> str:
    """``sql`` with its leading WITH allowing recursion."""
    return "WITH RECURSIVE" + sql.strip()[len("WITH"):]
