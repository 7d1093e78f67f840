"""DuckDB SQL for the registered queries (the correctness oracle).

Written independently of the Spark plans, straight from the semantics: lines are
unnested into characters with their position, contexts come from ``lag`` over
each line, ties use the plain struct (document, line, position), and the
prediction fold is spelled out level by level.  Every constant is cast to DOUBLE
(DuckDB reads ``1.0`` as a DECIMAL).
"""

from __future__ import annotations

SKIP = "(chr(10), chr(13))"
BUILTIN_SQL = "[' ', '.', ',', '。', '،', '।', '，', '・', '-']"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def lines_cte(keep_blank: bool = False, split_lines: bool = True, table: str = "documents", name: str = "lines") -> str:
    blank = "" if keep_blank else "WHERE nfc_normalize(t) <> ''"
    if split_lines:
        pieces = f"""
  SELECT doc_id, lang AS grp,
         unnest(string_split(coalesce(text, ''), chr(10))) AS t,
         unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS piece
  FROM {table}"""
    else:
        pieces = f"""
  SELECT doc_id, lang AS grp, coalesce(text, '') AS t, CAST(0 AS BIGINT) AS piece FROM {table}"""
    return f"""
doc_pieces AS ({pieces}),
grp_index AS (
  SELECT grp, CAST(row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS BIGINT) AS grp_idx
  FROM (SELECT DISTINCT lang AS grp FROM {table})),
{name} AS (
  SELECT p.doc_id, piece, CAST(p.doc_id AS HUGEINT) * 2147483648 + piece AS line_id, p.grp, g.grp_idx,
         nfc_normalize(t) AS text
  FROM doc_pieces p JOIN grp_index g ON p.grp IS NOT DISTINCT FROM g.grp {blank})"""


def capped_cte(n: int, balanced: bool) -> str:
    """``lines``: the first ``n`` of ``every`` (blank lines kept there) in load order,
    which takes the document's place in the order of ties."""
    turn = "row_number() OVER (PARTITION BY grp_idx ORDER BY doc_id, piece)" if balanced else "0"
    order = "rr, grp_idx" if balanced else "grp_idx, doc_id, piece"
    return f"""
turns AS (SELECT *, {turn} AS rr FROM every),
taken AS (
  SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS place, grp, text FROM turns WHERE text <> ''),
lines AS (SELECT place AS doc_id, CAST(0 AS BIGINT) AS piece, grp, text FROM taken WHERE place <= {n})"""


def seq_cte(max_lag: int) -> str:
    lags = "".join(f",\n         lag(ch, {j}) OVER w AS p{j}" for j in range(1, max(max_lag, 1) + 1))
    return f"""
chars AS (
  SELECT doc_id, piece, unnest(string_split(text, '')) AS ch, unnest(range(0, length(text))) AS pos
  FROM lines),
seq AS (
  SELECT pos, ch, {{'d': doc_id, 'p': piece, 'i': pos}} AS fs{lags}
  FROM chars WINDOW w AS (PARTITION BY doc_id, piece ORDER BY pos))"""


def counts_ctes() -> str:
    return f"""
uni AS (
  SELECT ch, CAST(count(*) AS BIGINT) AS cnt, min(fs) AS fs FROM seq
  WHERE ch NOT IN {SKIP} GROUP BY ch),
bigr AS (
  SELECT p1 AS l, ch, min(fs) AS fs FROM seq
  WHERE pos >= 1 AND p1 NOT IN {SKIP} AND ch NOT IN {SKIP} GROUP BY p1, ch),
cont AS (
  SELECT ch, CAST(count(*) AS BIGINT) AS cont, min(fs) AS fs FROM bigr GROUP BY ch),
totals AS (
  SELECT (SELECT count(*) FROM bigr) AS t, (SELECT count(*) FROM cont) AS v_cont,
         (SELECT count(*) FROM uni) AS v_uni, (SELECT sum(cnt) FROM uni) AS n_uni)"""


def pairs_cte(order: int, name: str = "pairs") -> str:
    parts = []
    for L in range(1, order):
        ctx = " || ".join(f"p{j}" for j in range(L, 0, -1))
        parts.append(f"SELECT {ctx} AS context, {L} AS ctx_len, ch, fs FROM seq WHERE pos >= {L}")
    if not parts:
        parts.append("SELECT CAST(NULL AS VARCHAR) AS context, 0 AS ctx_len, ch, fs FROM seq WHERE false")
    body = "\n    UNION ALL ".join(parts)
    return f"""
{name} AS (
  SELECT context, CAST(ctx_len AS BIGINT) AS ctx_len, ch, CAST(count(*) AS BIGINT) AS cnt, min(fs) AS fs
  FROM ({body}) WHERE ch NOT IN {SKIP}
  GROUP BY context, ctx_len, ch)"""


def trim_ctes(src: str, name: str, min_count: int, max_contexts: int, kmax: int, ranked: bool) -> str:
    """First trim (ranked=False) or a trim of a trimmed table (ranked=True)."""
    if ranked:
        tie_sel, ctx_order, char_order = "min(ctx_rank) AS tie", "total DESC, tie", "cnt DESC, char_rank"
    else:
        tie_sel, ctx_order, char_order = "min(fs) AS tie", "total DESC, tie, ctx_len DESC", "cnt DESC, fs"
    cap = f"QUALIFY new_ctx_rank <= {max_contexts}" if max_contexts > 0 else ""
    return f"""
{name}_tot AS (
  SELECT context, ctx_len, sum(cnt) AS total, {tie_sel} FROM {src}
  GROUP BY context, ctx_len HAVING sum(cnt) >= {min_count}),
{name}_kept AS (
  SELECT context, CAST(row_number() OVER (ORDER BY {ctx_order}) AS BIGINT) AS new_ctx_rank
  FROM {name}_tot {cap}),
{name} AS (
  SELECT s.context, s.ctx_len, s.ch, s.cnt, s.fs, k.new_ctx_rank AS ctx_rank,
         CAST(row_number() OVER (PARTITION BY s.context ORDER BY {char_order}) AS BIGINT) AS char_rank
  FROM {src} s JOIN {name}_kept k USING (context)
  QUALIFY char_rank <= {kmax})"""


def base_ctes(alpha: float, name: str = "base") -> str:
    """M1 when bigrams exist, else M2; ``base_rank`` is L8."""
    a = dbl(alpha)
    return f"""
{name}_src AS (
  SELECT ch, cont AS bc, fs FROM cont WHERE (SELECT t FROM totals) > 0
  UNION ALL
  SELECT ch, cnt AS bc, fs FROM uni WHERE (SELECT t FROM totals) = 0),
{name}_den AS (
  SELECT CASE WHEN t > 0 THEN CAST(t AS DOUBLE) + {a} * CAST(greatest(v_cont, 1) AS DOUBLE)
              ELSE CAST(n_uni AS DOUBLE) + {a} * CAST(greatest(v_uni, 1) AS DOUBLE) END AS den
  FROM totals),
{name} AS (
  SELECT ch, bc, fs, (CAST(bc AS DOUBLE) + {a}) / (SELECT den FROM {name}_den) AS b,
         CAST(row_number() OVER (ORDER BY (CAST(bc AS DOUBLE) + {a}) / (SELECT den FROM {name}_den) DESC, fs)
              AS BIGINT) AS base_rank
  FROM {name}_src WHERE ch NOT IN {SKIP})"""


def defaults_cte(kmax: int, name: str = "defaults") -> str:
    """L9 + U2: the merged default list as a DuckDB list."""
    return f"""
{name}_freq AS (
  SELECT ch, row_number() OVER (ORDER BY cnt DESC, fs) AS r FROM uni QUALIFY r <= {kmax}),
{name}_raw AS (
  SELECT list_concat(coalesce((SELECT list(ch ORDER BY r) FROM {name}_freq WHERE ch NOT IN {SKIP}), []),
                     {BUILTIN_SQL}) AS l,
         (SELECT count(*) FROM uni) AS n_uni),
{name} AS (
  SELECT CASE WHEN n_uni = 0 THEN {BUILTIN_SQL} ELSE {distinct_ordered("l")} END AS chars FROM {name}_raw)"""


def level_ctes(trimmed: str, discount: float, name: str) -> str:
    """M3/M4 from a trimmed table: ``{name}_lam(context, lam)`` and
    ``{name}_ent(context, ch, d)``."""
    D = dbl(discount)
    return f"""
{name}_ctx AS (
  SELECT context, sum(cnt) AS total, count(*) AS n_types FROM {trimmed} GROUP BY context),
{name}_lam AS (
  SELECT context, ({D} * CAST(n_types AS DOUBLE)) / CAST(total AS DOUBLE) AS lam FROM {name}_ctx),
{name}_ent AS (
  SELECT t.context, t.ch, greatest(CAST(t.cnt AS DOUBLE) - {D}, 0.0) / CAST(c.total AS DOUBLE) AS d
  FROM {trimmed} t JOIN {name}_ctx c USING (context)
  WHERE t.ch NOT IN {SKIP}
    AND greatest(CAST(t.cnt AS DOUBLE) - {D}, 0.0) / CAST(c.total AS DOUBLE) > 0)"""


def predict_ctes(inputs: str, order: int, lv: str, base: str, defaults: str, k: int, name: str) -> str:
    """P5 for ``inputs(qid, text)`` -> ``{name}(qid, pred)``.

    Level j (context = last j characters) is matched when ``{lv}_lam`` has it;
    the fold s <- s * lam_j + d_j runs over matched levels, short to long."""
    n1 = order - 1
    ctx_cols = "".join(
        f",\n         CASE WHEN length(sfx) >= {j} THEN right(sfx, {j}) END AS c{j}" for j in range(1, n1 + 1))
    lam_joins = "".join(
        f"\n  LEFT JOIN {lv}_lam l{j} ON l{j}.context = s.c{j}" for j in range(1, n1 + 1))
    lam_cols = "".join(f", l{j}.lam AS lam{j}" for j in range(1, n1 + 1))
    scale = "1.0"
    for j in range(1, n1 + 1):
        scale = f"(CASE WHEN lam{j} IS NULL THEN {scale} ELSE ({scale}) * lam{j} END)"
    cand_parts = [f"SELECT q.qid, e.ch FROM {name}_q q JOIN {lv}_ent e ON e.context = q.c{j}"
                  for j in range(1, n1 + 1)]
    cand_union = "\n    UNION ".join(cand_parts) if cand_parts else \
        f"SELECT qid, CAST(NULL AS VARCHAR) AS ch FROM {name}_q WHERE false"
    d_joins = "".join(
        f"\n  LEFT JOIN {lv}_ent e{j} ON e{j}.context = q.c{j} AND e{j}.ch = c.ch" for j in range(1, n1 + 1))
    fold = "0.0"
    for j in range(1, n1 + 1):
        fold = f"(CASE WHEN q.lam{j} IS NULL THEN {fold} ELSE ({fold}) * q.lam{j} + coalesce(e{j}.d, 0.0) END)"
    return f"""
{name}_in AS (
  SELECT qid, nfc_normalize(text) AS text FROM {inputs}),
{name}_s AS (
  SELECT qid, text, {"right(text, " + str(n1) + ")" if n1 > 0 else "''"} AS sfx{ctx_cols}
  FROM {name}_in WHERE text IS NOT NULL),
{name}_q AS (
  SELECT s.*{lam_cols} FROM {name}_s s{lam_joins}),
{name}_qs AS (
  SELECT q.*, {scale} AS scale FROM {name}_q q),
{name}_cand AS (
  {cand_union}),
{name}_scored AS (
  SELECT q.qid, c.ch, {fold} + q.scale * coalesce(b.b, 0.0) AS score
  FROM {name}_cand c JOIN {name}_qs q ON q.qid = c.qid{d_joins}
  LEFT JOIN {base} b ON b.ch = c.ch),
{name}_back AS (
  SELECT q.qid, b.ch, q.scale * b.b AS score,
         row_number() OVER (PARTITION BY q.qid ORDER BY b.base_rank) AS r
  FROM {name}_qs q JOIN {base} b ON true
  WHERE NOT EXISTS (SELECT 1 FROM {name}_cand c WHERE c.qid = q.qid AND c.ch = b.ch)
  QUALIFY r <= {k}),
{name}_all AS (
  SELECT qid, ch, score FROM {name}_scored
  UNION ALL SELECT qid, ch, score FROM {name}_back),
{name}_top AS (
  SELECT qid, list(ch ORDER BY score DESC, ch DESC) AS g FROM {name}_all
  WHERE ch NOT IN {SKIP} GROUP BY qid),
{name}_pad AS (
  SELECT i.qid, i.text, dfl.chars AS dflt,
         list_concat(list_slice(coalesce(t.g, []), 1, {k}),
                     list_filter(dfl.chars, lambda x: x NOT IN {SKIP})) AS l
  FROM {name}_in i LEFT JOIN {name}_top t USING (qid) CROSS JOIN {defaults} dfl),
{name} AS (
  SELECT qid,
    CASE WHEN text IS NULL THEN
           array_to_string(list_slice(list_concat(list_slice(dflt, 1, {k}),
                                                  list_transform(range({k}), lambda x: ' ')), 1, {k}), '')
         ELSE array_to_string(list_slice(list_concat({distinct_ordered("l")},
                                                     list_transform(range({k}), lambda x: ' ')), 1, {k}), '')
    END AS pred
  FROM {name}_pad)"""


def distinct_ordered(expr: str) -> str:
    """Order-keeping distinct of a DuckDB list: keep an element where it first occurs."""
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


def with_(*ctes: str, select: str) -> str:
    body = ",".join(c.rstrip() for c in ctes)
    return f"WITH{body}\n{select}"


def conv_inputs_cte(name: str = "dev") -> str:
    """Inputs and gold from whole conversation turns: text[:-1] and text[-1]."""
    return f"""
{name}_raw AS (
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS qid, nfc_normalize(text) AS t FROM conversations
  WHERE length(nfc_normalize(text)) >= 2),
{name} AS (
  SELECT qid, substring(t, 1, length(t) - 1) AS text, right(t, 1) AS answer FROM {name}_raw)"""

