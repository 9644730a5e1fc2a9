"""DuckDB SQL building blocks for the independent oracle.

Every expression mirrors a Spark column function in :mod:`sqlscore.functions`
with DuckDB built-ins (RE2 regexes, list functions). Numeric literals in
arithmetic are cast to DOUBLE so the IEEE operations match Spark's exactly.
"""

from __future__ import annotations

from ..params import SQL_KEYWORDS


# Patterns written from the rules, in RE2 syntax (the library has its own, in Java syntax).
WS = r"[ \t\n\r\f\v]"
THINK_BLOCK = r"(?s)<think>.*?</think>"
ANSWER_BLOCK = r"(?s)<answer>(.*?)</answer>"
SQL_FENCE = r"(?is)```sql[ \t\n\r\f\v]+(.*?)[ \t\n\r\f\v]+```"
PLAIN_FENCE = r"(?s)```[ \t\n\r\f\v]+(.*?)[ \t\n\r\f\v]+```"
FORMAT_LAYOUT = (r"(?s)\A[ \t\n\r\f\v]*<think>.*?</think>[ \t\n\r\f\v]*<answer>.*?</answer>[ \t\n\r\f\v]*\z")
UNIT = r"""(?s)'(?:[^']|'')*'|"(?:[^"]|"")*"|--[^\n]*|/\*.*?\*/"""


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {lit(f'\\A{WS}+|{WS}+\\z')}, '', 'g')"


def extract_stage1(e: str) -> str:
    s = f"regexp_replace({e}, {lit(THINK_BLOCK)}, '', 'g')"
    s = f"regexp_replace({s}, {lit(ANSWER_BLOCK)}, '\\1', 'g')"
    return strip(s)


def extract_stage2(s: str) -> str:
    def keep(pat):
        return f"(CASE WHEN regexp_matches({s}, {lit(pat)}) THEN regexp_extract({s}, {lit(pat)}, 1) ELSE {s} END)"
    return strip(f"(CASE WHEN contains(lower({s}), '```sql') THEN {keep(SQL_FENCE)} "
                 f"WHEN contains({s}, '```') THEN {keep(PLAIN_FENCE)} ELSE {s} END)")


def normalize(e: str) -> str:
    units, gaps = f"regexp_extract_all({e}, {lit(UNIT)})", f"regexp_split_to_array({e}, {lit(UNIT)})"
    woven = (f"array_to_string(list_transform({gaps}, lambda g, i: lower(g) || coalesce("
             f"CASE WHEN starts_with({units}[i], '--') OR starts_with({units}[i], '/*') THEN ' ' ELSE {units}[i] END, '')), '')")
    return strip(f"regexp_replace({woven}, {lit(WS + '+')}, ' ', 'g')")


def tokens(e: str) -> str:
    return f"list_distinct(list_filter(string_split({e}, ' '), lambda t: t <> ''))"


def jaccard(ta: str, tb: str) -> str:
    return (f"(CASE WHEN len({ta}) = 0 OR len({tb}) = 0 THEN {dbl(0)} "
            f"ELSE len(list_intersect({ta}, {tb})) / len(list_distinct(list_concat({ta}, {tb}))) END)")


def token_count(e: str) -> str:
    s = f"replace(regexp_replace({e}, {lit(UNIT)}, ' L ', 'g'), ';', ' ; ')"
    return f"len(list_filter(regexp_split_to_array({s}, {lit(WS + '+')}), lambda t: t <> ''))"


def keyword_count(e: str) -> str:
    return "(" + " + ".join(f"CAST(contains(upper({e}), {lit(k)}) AS INTEGER)" for k in SQL_KEYWORDS) + ")"


def quality(e: str) -> str:
    base = f"({dbl(1.0)} - CASE WHEN {token_count(e)} < 3 THEN {dbl(0.3)} ELSE {dbl(0.0)} END)"
    return f"greatest({dbl(0.0)}, least({dbl(1.0)}, {base} + {dbl(0.1)} * CAST(least({keyword_count(e)}, 3) AS DOUBLE)))"


def extract_schema(e: str) -> str:
    lines = f"string_split({e}, chr(10))"
    flags = f"list_transform({lines}, lambda l: contains(upper(l), 'CREATE') OR contains(upper(l), 'INSERT'))"
    pos = f"list_position({flags}, true)"
    tail = f"(CASE WHEN {pos} IS NOT NULL THEN array_to_string(list_slice({lines}, {pos}, len({lines})), chr(10)) ELSE '' END)"
    return f"(CASE WHEN contains(upper({e}), 'CREATE TABLE') THEN {e} ELSE {tail} END)"


def format_score(e: str) -> str:
    return f"(CASE WHEN regexp_matches({e}, {lit(FORMAT_LAYOUT)}) THEN {dbl(1.0)} ELSE {dbl(0.0)} END)"


# ---- fixture CTEs -------------------------------------------------------------

CANDIDATES = r"""candidates AS (
SELECT sample_id, gen_idx, v,
  'Which orders did customer ' || CAST(sample_id AS VARCHAR) || ' place?' AS question,
  'CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT);' AS context,
  ref AS answer,
  CASE v WHEN 0 THEN ref
         WHEN 1 THEN lower(ref) || chr(10)
         WHEN 2 THEN 'Here you go:' || chr(10) || '```sql' || chr(10) || ref || chr(10) || '```'
         WHEN 3 THEN '<think>filter on' || chr(10) || 'customer</think><answer>' || ref || '</answer>'
         WHEN 4 THEN '-- one customer' || chr(10) || ref || ' /* done */'
         WHEN 5 THEN ref || ' AND o_orderkey % 3 <> 0'
         WHEN 6 THEN replace(ref, 'SELECT o_orderkey', 'SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 1000000 ELSE o_orderkey END')
         WHEN 7 THEN 'INVALID SQL QUERY HERE'
         WHEN 8 THEN '   '
         WHEN 9 THEN ref || ' ORDER BY o_orderkey'
         ELSE ref || ';' END AS completion,
  v NOT IN (7, 8, 9) AS gen_success,
  CASE v WHEN 7 THEN 'SQL error: syntax error' WHEN 8 THEN 'SQL error: empty query'
         WHEN 9 THEN 'Query execution timed out' END AS gen_error,
  v <> 10 AS ref_success
FROM (SELECT c_custkey AS sample_id, g.gen_idx, (c_custkey + g.gen_idx) % 11 AS v,
        'SELECT o_orderkey FROM orders WHERE o_custkey = ' || CAST(c_custkey AS VARCHAR) AS ref
      FROM customer CROSS JOIN (VALUES (0), (1), (2), (3)) AS g(gen_idx)) s)"""

RESULT_ROWS = r"""result_rows AS (
SELECT c.sample_id, c.gen_idx, 'ref' AS side, o.o_orderkey AS cell
FROM candidates c JOIN orders o ON o.o_custkey = c.sample_id WHERE c.ref_success
UNION ALL
SELECT c.sample_id, c.gen_idx, 'gen' AS side,
  CASE WHEN c.v = 6 AND o.o_orderkey % 2 = 0 THEN o.o_orderkey + 1000000 ELSE o.o_orderkey END AS cell
FROM candidates c JOIN orders o ON o.o_custkey = c.sample_id
WHERE c.gen_success AND NOT (c.v = 5 AND o.o_orderkey % 3 = 0))"""

SAMPLES = r"""samples AS (
SELECT c_custkey AS sample_id,
  'Which orders did customer ' || CAST(c_custkey AS VARCHAR) || ' place?' AS question,
  'CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT);' AS context,
  'SELECT o_orderkey FROM orders WHERE o_custkey = ' || CAST(c_custkey AS VARCHAR) AS answer
FROM customer)"""

# shared intermediate columns: sql, ref_sql, gen_norm, ref_norm, gen_tokens, ref_tokens, schema
def text_stages(src: str, completion: str = "completion", answer: str = "answer", context: str = "context",
                prefix: str = "") -> str:
    p = prefix
    return f"""{p}x1 AS (SELECT *, {extract_stage1(completion)} AS _s1 FROM {src}),
{p}x2 AS (SELECT * EXCLUDE (_s1), {extract_stage2('_s1')} AS sql, {strip(answer)} AS ref_sql,
         {extract_schema(f"coalesce({context}, '')")} AS schema FROM {p}x1),
{p}x4 AS (SELECT *, {normalize('sql')} AS gen_norm, {normalize('ref_sql')} AS ref_norm FROM {p}x2),
{p}texted AS (SELECT *, {tokens('gen_norm')} AS gen_tokens, {tokens('ref_norm')} AS ref_tokens FROM {p}x4)"""


OUTCOME = r"""cnt AS (SELECT sample_id, gen_idx, count(*) FILTER (WHERE side = 'gen') AS gen_rows,
                count(*) FILTER (WHERE side = 'ref') AS ref_rows FROM result_rows GROUP BY sample_id, gen_idx),
marked AS (SELECT sample_id, gen_idx, cell, max(CAST(side = 'gen' AS INTEGER)) AS in_gen,
                   max(CAST(side = 'ref' AS INTEGER)) AS in_ref FROM result_rows GROUP BY sample_id, gen_idx, cell),
ov AS (SELECT sample_id, gen_idx, sum(in_gen * in_ref) AS inter, count(*) AS uni FROM marked GROUP BY sample_id, gen_idx),
outcome AS (
  SELECT t.*, coalesce(cnt.gen_rows, 0) AS gen_rows, coalesce(cnt.ref_rows, 0) AS ref_rows,
         coalesce(ov.inter, 0) AS inter, coalesce(ov.uni, 0) AS uni
  FROM texted t LEFT JOIN cnt USING (sample_id, gen_idx) LEFT JOIN ov USING (sample_id, gen_idx)),
matched AS (
  SELECT *,
    (gen_success AND ref_success AND gen_rows = ref_rows AND inter = uni) AS exact_match,
    CASE WHEN NOT (gen_success AND ref_success) THEN CAST(0 AS DOUBLE)
         WHEN gen_rows <> ref_rows THEN (CASE WHEN greatest(gen_rows, ref_rows) > 0
              THEN least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows) ELSE CAST(0 AS DOUBLE) END) * CAST(0.3 AS DOUBLE)
         WHEN inter = uni THEN CAST(1 AS DOUBLE)
         ELSE (CASE WHEN uni > 0 THEN inter / uni ELSE CAST(0 AS DOUBLE) END) END AS similarity
  FROM outcome)"""


def syntax_score(sql: str = "sql") -> str:
    return f"(CASE WHEN length({sql}) > 0 THEN {dbl(0.5)} + {dbl(0.5)} * {quality(sql)} ELSE {dbl(-0.5)} END)"


def semantic_score() -> str:
    return (f"(CASE WHEN gen_norm = ref_norm THEN {dbl(1.0)} ELSE "
            f"{jaccard('gen_tokens', 'ref_tokens')} * {dbl(0.8)} - {dbl(0.2)} END)")


def execution_score() -> str:
    err = "lower(coalesce(gen_error, ''))"
    return (f"(CASE WHEN schema IS NULL OR length(schema) = 0 THEN {dbl(-1.0)} "
            f"WHEN NOT gen_success THEN (CASE WHEN contains({err}, 'timeout') OR contains({err}, 'timed out') "
            f"THEN {dbl(-0.8)} ELSE {dbl(-0.6)} END) "
            f"WHEN NOT ref_success THEN {dbl(0.3)} WHEN exact_match THEN {dbl(1.0)} "
            f"ELSE similarity * {dbl(0.7)} - {dbl(0.3)} END)")


SCORED = f"""scored AS (
  SELECT *, {syntax_score()} AS syntax_score, {execution_score()} AS execution_score,
         {semantic_score()} AS semantic_score FROM matched),
final AS (
  SELECT *, {dbl(0)} + syntax_score * {dbl(0.2)} + execution_score * {dbl(0.6)} + semantic_score * {dbl(0.2)} AS score
  FROM scored)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [CANDIDATES, RESULT_ROWS, text_stages("candidates")]
SCORED_BASE = BASE + [OUTCOME, SCORED]
PER_SAMPLE = """per_sample AS (
  SELECT sample_id, max(score) AS best_reward, avg(score) AS mean_reward, count(*) AS num_generations
  FROM final GROUP BY sample_id)"""
