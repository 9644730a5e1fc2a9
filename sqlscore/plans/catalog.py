"""Registered query plans: one Spark builder and one oracle SQL string per key.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or data Spark derives from them). Column names and types match
the oracle SQL: integers are BIGINT, scores DOUBLE.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schema as S
from ..functions import text as T
from ..operators import compare as X
from ..operators import dataset as D
from ..operators import evaluate as E
from ..operators import score as C
from ..operators.ranking import group_positions
from ..params import DataParams, EvalParams, ScoreParams
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as FX
from ..sources.tables import (load_split, map_fields, read_json, read_shuffled, read_table, write_eval_summary, write_evaluation,
                              write_shuffled, write_splits)
from . import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
KEYS = ["sample_id", "gen_idx"]


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _big(c):
    return c.cast("bigint")


# ---- shared Spark stages ----------------------------------------------------------

def texted(spark, sf_dir, params: ScoreParams = ScoreParams()) -> DataFrame:
    return C.with_sql_columns(FX.candidates(spark, sf_dir), params=params)


def outcome(spark, sf_dir, params: ScoreParams = ScoreParams(), cands: DataFrame | None = None) -> DataFrame:
    """Candidates with shared text columns ⟕ X2/X3 comparison of their result rows."""
    cands = FX.candidates(spark, sf_dir) if cands is None else cands
    rows = FX.result_rows(spark, sf_dir, cands)
    return X.compare_pairs(C.with_sql_columns(cands, params=params), rows, KEYS)


def scored(spark, sf_dir, params: ScoreParams = ScoreParams(), details: bool = False,
           cands: DataFrame | None = None) -> DataFrame:
    df = outcome(spark, sf_dir, params, cands)
    cols = {}
    for name, scorer in C.sql_components(params):
        s, _ = scorer(df)
        cols[f"{name}_score"] = s
    df = df.withColumns(cols)
    total = F.lit(0.0)
    for (name, _), w in zip(C.sql_components(params), params.weights):
        total = total + F.col(f"{name}_score") * F.lit(w)
    s, ok = C.safe_score(F.when(F.col(C.GIVEN), total), [])  # both texts are there
    df = df.withColumns({"score": s, "scored": ok})
    if details:
        _, d = C.combined_scorer(params)(df)
        df = df.withColumn("details", d)
    return df


def per_sample(spark, sf_dir, keep_lists: bool = False) -> DataFrame:
    """E2 of all candidates; the texts of ``keep_lists`` go round the result rows, which a digest passes in their place."""
    if not keep_lists:
        return E.sample_rewards(scored(spark, sf_dir), ["sample_id"])
    cands = FX.candidates(spark, sf_dir).withColumn(E.DIGEST, E.text_digest("completion"))
    return E.sample_rewards(scored(spark, sf_dir, cands=cands), ["sample_id"], keep_lists=True, generations=cands)


def _prompt_sql() -> str:
    from ..params import PROMPT_TEMPLATE
    q, c = "{question}", "{context}"
    head, rest = PROMPT_TEMPLATE.split(q)
    middle, tail = rest.split(c)
    return f"{O.lit(head)} || question || {O.lit(middle)} || context || {O.lit(tail)}"


PROMPT_SQL = _prompt_sql()


def _q(*ctes: str) -> str:
    return O.with_ctes(*ctes)


# ---- T: text functions -----------------------------------------------------------------

@register("strip_think", _q(O.CANDIDATES) + f"""
SELECT sample_id, gen_idx, regexp_replace(completion, {O.lit(O.THINK_BLOCK)}, '', 'g') AS stripped FROM candidates""")
def q_strip_think(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.strip_think("completion").alias("stripped"))


@register("unwrap_answer", _q(O.CANDIDATES) + f"""
SELECT sample_id, gen_idx, regexp_replace(completion, {O.lit(O.ANSWER_BLOCK)}, '\\1', 'g') AS unwrapped FROM candidates""")
def q_unwrap_answer(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.unwrap_answer("completion").alias("unwrapped"))


@register("py_strip", _q(O.CANDIDATES) + f"""
SELECT sample_id, gen_idx, {O.strip('completion')} AS stripped FROM candidates""")
def q_py_strip(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.py_strip("completion").alias("stripped"))


@register("extract_sql", _q(*O.BASE) + "SELECT sample_id, gen_idx, sql FROM texted")
def q_extract_sql(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.extract_sql("completion").alias("sql"))


@register("syntax_valid", _q(*O.BASE) + "SELECT sample_id, gen_idx, length(sql) > 0 AS syntax_valid FROM texted")
def q_syntax_valid(spark, sf_dir):
    return texted(spark, sf_dir).select(*KEYS, T.syntax_valid(C.SQL).alias("syntax_valid"))


@register("token_count", _q(*O.BASE) + f"SELECT sample_id, gen_idx, CAST({O.token_count('sql')} AS BIGINT) AS token_count FROM texted")
def q_token_count(spark, sf_dir):
    return texted(spark, sf_dir).select(*KEYS, _big(F.col(C.N_TOK)).alias("token_count"))


@register("keyword_count", _q(*O.BASE) + f"SELECT sample_id, gen_idx, CAST({O.keyword_count('sql')} AS BIGINT) AS keyword_count FROM texted")
def q_keyword_count(spark, sf_dir):
    return texted(spark, sf_dir).select(*KEYS, _big(F.col(C.N_KW)).alias("keyword_count"))


@register("quality", _q(*O.BASE) + f"SELECT sample_id, gen_idx, CASE WHEN length(sql) > 0 THEN {O.quality('sql')} END AS quality FROM texted")
def q_quality(spark, sf_dir):
    """T8 of every candidate's SQL (NULL when the extracted SQL is empty)."""
    df = texted(spark, sf_dir)
    q = T.quality_from_counts(F.col(C.N_TOK), F.col(C.N_KW))
    return df.select(*KEYS, F.when(T.syntax_valid(C.SQL), q).alias("quality"))


@register("syntax_score", _q(*O.BASE) + f"""
SELECT sample_id, gen_idx, {O.syntax_score()} AS syntax_score, length(sql) > 0 AS syntax_valid,
       CASE WHEN length(sql) > 0 THEN {O.quality('sql')} END AS quality_score, substring(sql, 1, 100) AS extracted_sql
FROM texted""")
def q_syntax_score(spark, sf_dir):
    df = texted(spark, sf_dir)
    s, d = C.syntax_scorer()(df)
    return df.select(*KEYS, s.alias("syntax_score"), d["syntax_valid"].alias("syntax_valid"),
                     d["quality_score"].alias("quality_score"), d["extracted_sql"].alias("extracted_sql"))


@register("normalize_sql", _q(*O.BASE) + "SELECT sample_id, gen_idx, gen_norm, ref_norm FROM texted")
def q_normalize_sql(spark, sf_dir):
    return texted(spark, sf_dir).select(*KEYS, F.col(C.GEN_NORM).alias("gen_norm"), F.col(C.REF_NORM).alias("ref_norm"))


@register("normalize_sql_documents", f"""
WITH d1 AS (SELECT doc_id, {O.normalize('text')} AS c FROM documents)
SELECT doc_id, md5(c) AS norm_md5, CAST(length(c) AS BIGINT) AS norm_len FROM d1""")
def q_normalize_sql_documents(spark, sf_dir):
    """T10 over whole documents (long texts, apostrophes, dashes)."""
    n = T.normalize_sql(F.col("text"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", n.alias("n"))
    return docs.select("doc_id", F.md5("n").alias("norm_md5"), _big(F.length("n")).alias("norm_len"))


@register("token_jaccard", _q(*O.BASE) + f"SELECT sample_id, gen_idx, {O.jaccard('gen_tokens', 'ref_tokens')} AS token_jaccard FROM texted")
def q_token_jaccard(spark, sf_dir):
    return texted(spark, sf_dir).select(*KEYS, T.jaccard_sets(C.GEN_TOK, C.REF_TOK).alias("token_jaccard"))


@register("token_jaccard_documents", f"""
WITH d1 AS (SELECT doc_id, {O.normalize('text')} AS c FROM documents),
d2 AS (SELECT doc_id, {O.tokens('c')} AS tk FROM d1)
SELECT a.doc_id, b.doc_id AS next_doc_id, {O.jaccard('a.tk', 'b.tk')} AS token_jaccard
FROM d2 a JOIN d2 b ON b.doc_id = a.doc_id + 1""")
def q_token_jaccard_documents(spark, sf_dir):
    """T11 between each document and the next one by doc_id.

    Documents meet in blocks of 1,000 consecutive ids; only the first document
    of a block is sent to the block before as well. Inside a block ``lead``
    finds the neighbour, so token sets move once and no aggregate holds them.
    """
    from pyspark.sql import Window
    docs = read_table(spark, sf_dir, "documents").select("doc_id", T.sql_tokens(F.col("text")).alias("tk"))
    block = F.floor(F.col("doc_id") / 1000)
    blocks = F.when(F.pmod("doc_id", F.lit(1000)) == 0, F.array(block, block - 1)).otherwise(F.array(block))
    dealt = docs.select("doc_id", "tk", block.alias("own"), F.explode(blocks).alias("b"))
    w = Window.partitionBy("b").orderBy("doc_id")
    pairs = dealt.withColumns({"next_doc_id": F.lead("doc_id").over(w), "next_tk": F.lead("tk").over(w)})
    return (pairs.where((F.col("own") == F.col("b")) & (F.col("next_doc_id") == F.col("doc_id") + 1))
            .select("doc_id", "next_doc_id", T.jaccard_sets("tk", "next_tk").alias("token_jaccard")))


@register("semantic_score", _q(*O.BASE) + f"""
SELECT sample_id, gen_idx, {O.semantic_score()} AS semantic_score, gen_norm = ref_norm AS exact_match,
       CASE WHEN gen_norm = ref_norm THEN CAST(1 AS DOUBLE) ELSE {O.jaccard('gen_tokens', 'ref_tokens')} END AS token_similarity
FROM texted""")
def q_semantic_score(spark, sf_dir):
    df = texted(spark, sf_dir)
    s, d = C.semantic_scorer()(df)
    return df.select(*KEYS, s.alias("semantic_score"), d["exact_match"].alias("exact_match"),
                     d["token_similarity"].alias("token_similarity"))


@register("extract_schema", f"""
SELECT doc_id, md5({O.extract_schema('text')}) AS schema_md5, CAST(length({O.extract_schema('text')}) AS BIGINT) AS schema_len
FROM documents""")
def q_extract_schema(spark, sf_dir):
    """T13 over whole documents: lines from the first CREATE/INSERT line on."""
    s = S.extract_schema(F.col("text"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", s.alias("s"))
    return docs.select("doc_id", F.md5("s").alias("schema_md5"), _big(F.length("s")).alias("schema_len"))


@register("resolve_schema", _q(O.SAMPLES) + f"""
, prompts AS (SELECT sample_id, 'Question: ' || question || chr(10) || chr(10) || 'Schema:' || chr(10) || context
               || chr(10) || chr(10) || 'Generate the SQL query to answer this question.' AS prompt, context FROM samples)
SELECT sample_id, {O.extract_schema('context')} AS schema_from_context,
       CASE WHEN contains(prompt, 'SCHEMA:') OR contains(upper(prompt), 'CREATE TABLE') THEN {O.extract_schema('prompt')} END AS schema_from_prompt
FROM prompts""")
def q_resolve_schema(spark, sf_dir):
    """T14 in both modes: context column present, and prompt only."""
    p = D.build_prompt(FX.samples(spark, sf_dir))
    with_ctx = S.resolve_schema(p.columns)
    prompt_only = S.resolve_schema([c for c in p.columns if c != "context"])
    return p.select("sample_id", with_ctx.alias("schema_from_context"), prompt_only.alias("schema_from_prompt"))


@register("execution_key", _q(*O.BASE) + """
SELECT sample_id, gen_idx, md5(sql || ':' || coalesce(schema, '')) AS gen_key, md5(ref_sql || ':' || coalesce(schema, '')) AS ref_key
FROM texted""")
def q_execution_key(spark, sf_dir):
    df = texted(spark, sf_dir)
    return df.select(*KEYS, S.execution_key(F.col(C.SQL), F.col(C.SCHEMA)).alias("gen_key"),
                     S.execution_key(F.col(C.REF), F.col(C.SCHEMA)).alias("ref_key"))


@register("format_score", _q(O.CANDIDATES) + f"SELECT sample_id, gen_idx, {O.format_score('completion')} AS format_score FROM candidates")
def q_format_score(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.format_score("completion").alias("format_score"))


@register("custom_keyword_score", _q(O.CANDIDATES) + """
SELECT sample_id, gen_idx, CASE WHEN contains(upper(completion), 'INDEX') THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS custom_score
FROM candidates""")
def q_custom_keyword_score(spark, sf_dir):
    return FX.candidates(spark, sf_dir).select(*KEYS, T.custom_keyword_score("completion").alias("custom_score"))


# ---- X: comparison and execution score ------------------------------------------------

@register("rowcount_similarity", _q(*O.SCORED_BASE[:-1]) + """
SELECT sample_id, gen_idx, gen_rows, ref_rows,
  (CASE WHEN greatest(gen_rows, ref_rows) > 0 THEN least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows)
        ELSE CAST(0 AS DOUBLE) END) * CAST(0.3 AS DOUBLE) AS size_similarity
FROM matched WHERE gen_success AND ref_success""")
def q_rowcount_similarity(spark, sf_dir):
    df = outcome(spark, sf_dir).where("gen_success AND ref_success")
    hi, lo = F.greatest("gen_rows", "ref_rows"), F.least("gen_rows", "ref_rows")
    sim = F.when(hi > 0, lo / hi).otherwise(F.lit(0.0)) * F.lit(0.3)
    return df.select(*KEYS, "gen_rows", "ref_rows", sim.alias("size_similarity"))


@register("set_match", _q(*O.SCORED_BASE[:-1]) + """
SELECT sample_id, gen_idx, CAST(inter AS BIGINT) AS inter, CAST(uni AS BIGINT) AS uni, inter = uni AS sets_equal,
  CASE WHEN uni > 0 THEN inter / uni ELSE CAST(0 AS DOUBLE) END AS jaccard
FROM matched WHERE gen_success AND ref_success AND gen_rows = ref_rows AND gen_rows > 0""")
def q_set_match(spark, sf_dir):
    """X3 for pairs that reach the set comparison (both ran, equal non-zero counts)."""
    cands = FX.candidates(spark, sf_dir)
    stats = X.pair_stats(FX.result_rows(spark, sf_dir, cands), KEYS)
    flags = cands.select(*KEYS, "gen_success", "ref_success")
    ok = stats.join(flags, KEYS).where(
        "gen_success AND ref_success AND gen_rows = ref_rows AND gen_rows > 0")
    return ok.select(*KEYS, _big(F.col("inter")).alias("inter"), _big(F.col("uni")).alias("uni"),
                     (F.col("inter") == F.col("uni")).alias("sets_equal"),
                     F.when(F.col("uni") > 0, F.col("inter") / F.col("uni")).otherwise(F.lit(0.0)).alias("jaccard"))


def _indexed_rows(spark, sf_dir) -> DataFrame:
    """Result rows with a row index: the reference returns its rows by order key, the candidate by
    order date and key, so equal row sets can differ in order. Whole results, no window per pair."""
    rows = FX.result_rows(spark, sf_dir, with_date=True)
    by = F.when(F.col("side") == "ref", F.lit("")).otherwise(F.col("o_orderdate").cast("string"))
    keyed = rows.select(*KEYS, "side", "cell", by.alias("_by"), "o_orderkey")
    return group_positions(keyed, KEYS + ["side"], ["_by", "o_orderkey"], "row_idx")


ORDERED = """, dated AS (SELECT r.*, o.o_orderdate, o.o_orderkey
  FROM result_rows r JOIN candidates c USING (sample_id, gen_idx)
  JOIN orders o ON o.o_orderkey = CASE WHEN r.side = 'gen' AND c.v = 6 AND r.cell % 2 = 0 THEN r.cell - 1000000 ELSE r.cell END),
indexed AS (SELECT *, row_number() OVER (PARTITION BY sample_id, gen_idx, side
                ORDER BY CASE WHEN side = 'ref' THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END, o_orderkey) AS row_idx FROM dated),
g AS (SELECT * FROM indexed WHERE side = 'gen'), r AS (SELECT * FROM indexed WHERE side = 'ref'),
om AS (SELECT coalesce(g.sample_id, r.sample_id) AS sample_id, coalesce(g.gen_idx, r.gen_idx) AS gen_idx,
              bool_and(g.cell IS NOT DISTINCT FROM r.cell AND g.cell IS NOT NULL) AS ordered_match
       FROM g FULL OUTER JOIN r ON g.sample_id = r.sample_id AND g.gen_idx = r.gen_idx AND g.row_idx = r.row_idx
       GROUP BY 1, 2)
"""


@register("ordered_match", _q(O.CANDIDATES, O.RESULT_ROWS) + ORDERED + "SELECT sample_id, gen_idx, ordered_match FROM om")
def q_ordered_match(spark, sf_dir):
    return X.ordered_match(_indexed_rows(spark, sf_dir), KEYS)


@register("results_equal", _q(O.CANDIDATES, O.RESULT_ROWS) + ORDERED + """
SELECT c.sample_id, c.gen_idx, c.gen_success AND c.ref_success AND coalesce(om.ordered_match, true) AS results_equal
FROM candidates c LEFT JOIN om USING (sample_id, gen_idx)""")
def q_results_equal(spark, sf_dir):
    cands = FX.candidates(spark, sf_dir).select(*KEYS, "gen_success", "ref_success")
    return X.results_equal(cands, _indexed_rows(spark, sf_dir), KEYS).select(*KEYS, "results_equal")


@register("compare_results", """
WITH g AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderpriority = '1-URGENT'),
r AS (SELECT c_custkey AS k, CASE WHEN c_acctbal > 0 THEN 'O' ELSE 'F' END AS s FROM customer),
gd AS (SELECT DISTINCT * FROM g), rd AS (SELECT DISTINCT * FROM r),
n AS (SELECT (SELECT count(*) FROM g) AS gen_rows, (SELECT count(*) FROM r) AS ref_rows,
             (SELECT count(*) FROM (SELECT * FROM gd INTERSECT SELECT * FROM rd)) AS inter,
             (SELECT count(*) FROM (SELECT * FROM gd UNION SELECT * FROM rd)) AS uni)
SELECT gen_rows = ref_rows AND inter = uni AS exact_match,
  CASE WHEN gen_rows <> ref_rows THEN (CASE WHEN greatest(gen_rows, ref_rows) > 0 THEN least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows) ELSE CAST(0 AS DOUBLE) END) * CAST(0.3 AS DOUBLE)
       WHEN inter = uni THEN CAST(1 AS DOUBLE) ELSE inter / uni END AS similarity, gen_rows, ref_rows
FROM n""")
def q_compare_results(spark, sf_dir):
    """X5 on two DataFrames derived from orders and customer (mixed bigint/string rows)."""
    g = read_table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    r = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") > 0, F.lit("O")).otherwise(F.lit("F")).alias("s"))
    return X.compare_results(g, r)


LINE_PAIRS = """
st AS (SELECT o_orderkey, true AS gen_success, o_orderkey % 10 <> 9 AS ref_success FROM orders),
li AS (SELECT l_orderkey AS o_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_quantity > 10),
rr AS (SELECT o_orderkey, 'ref' AS side, l_returnflag AS cell FROM li UNION ALL
       SELECT o_orderkey, 'gen', CASE WHEN l_linenumber % 3 = 1 THEN 'A' ELSE l_returnflag END FROM li
       WHERE NOT (o_orderkey % 7 = 0 AND l_linenumber = 2)),
pr AS (SELECT o_orderkey, cell, count(*) FILTER (WHERE side = 'gen') AS g, count(*) FILTER (WHERE side = 'ref') AS r FROM rr GROUP BY ALL),
ag AS (SELECT o_orderkey, sum(g) AS gen_rows, sum(r) AS ref_rows, count(*) FILTER (WHERE g > 0 AND r > 0) AS inter, count(*) AS uni,
              sum(least(g, r)) AS bag_inter, sum(greatest(g, r)) AS bag_uni FROM pr GROUP BY o_orderkey),
j AS (SELECT o_orderkey, gen_success AND ref_success AS ok, coalesce(gen_rows, 0)::BIGINT AS gen_rows, coalesce(ref_rows, 0)::BIGINT AS ref_rows,
             coalesce(inter, 0) AS i, coalesce(uni, 0) AS u, coalesce(bag_inter, 0) AS bi, coalesce(bag_uni, 0) AS bu
      FROM st LEFT JOIN ag USING (o_orderkey))"""


def _line_pairs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders as pairs: flags of their lines on the one side, altered ones on the other."""
    status = read_table(spark, sf_dir, "orders").select("o_orderkey", F.lit(True).alias("gen_success"), (F.col("o_orderkey") % 10 != 9).alias("ref_success"))
    lines = read_table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    n = F.col("l_linenumber")
    gen = F.when(n % 3 == 1, F.lit("A")).otherwise(F.col("l_returnflag"))
    sides = F.array(F.struct(F.lit("ref").alias("side"), F.col("l_returnflag").alias("cell"), F.lit(True).alias("keep")),
                    F.struct(F.lit("gen").alias("side"), gen.alias("cell"), (~((F.col("o_orderkey") % 7 == 0) & (n == 2))).alias("keep")))
    return status, lines.select("o_orderkey", F.inline(sides)).where("keep").drop("keep")


@register("multiset_match", f"""WITH {LINE_PAIRS}
SELECT o_orderkey, gen_rows, ref_rows, ok AND gen_rows = ref_rows AND bi = bu AS exact_match,
       CASE WHEN NOT ok THEN CAST(0 AS DOUBLE)
            WHEN gen_rows <> ref_rows THEN (least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows)) * CAST(0.3 AS DOUBLE)
            WHEN bi = bu THEN CAST(1 AS DOUBLE) ELSE bi / bu END AS similarity,
       ok AND gen_rows = 0 AND ref_rows = 0 AS empty_match, ok AND gen_rows = ref_rows AND i = u AS set_match
FROM j""")
def q_multiset_match(spark, sf_dir):
    """X3 on multisets beside the set rule, empty pairs told apart."""
    status, rows = _line_pairs(spark, sf_dir)
    bags = X.compare_pairs(status, rows, ["o_orderkey"], multiset=True)
    sets = X.compare_pairs(status, rows, ["o_orderkey"]).select("o_orderkey", F.col("exact_match").alias("set_match"))
    return bags.join(sets, "o_orderkey").select("o_orderkey", "gen_rows", "ref_rows", "exact_match", "similarity", "empty_match", "set_match")


LARGE_PAIRS = """
WITH r AS (SELECT 'fewer' AS pair, 'ref' AS side, l_orderkey * 10 + l_linenumber AS cell FROM lineitem
  UNION ALL SELECT 'fewer', 'gen', l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_orderkey % 4 <> 0
  UNION ALL SELECT 'last', 'ref', l_orderkey * 10 + l_linenumber FROM lineitem
  UNION ALL SELECT 'last', 'gen', CASE WHEN l_orderkey * 10 + l_linenumber = (SELECT max(l_orderkey * 10 + l_linenumber) FROM lineitem)
                                       THEN -1 ELSE l_orderkey * 10 + l_linenumber END FROM lineitem),
n AS (SELECT pair, count(*) FILTER (WHERE side = 'gen') AS gen_rows, count(*) FILTER (WHERE side = 'ref') AS ref_rows FROM r GROUP BY pair),
c AS (SELECT pair, cell, count(DISTINCT side) AS k FROM r GROUP BY pair, cell),
j AS (SELECT pair, count(*) FILTER (WHERE k = 2) AS inter, count(*) AS uni FROM c GROUP BY pair)
SELECT pair, gen_rows, ref_rows, gen_rows = ref_rows AND inter = uni AS exact_match,
  CASE WHEN gen_rows <> ref_rows THEN (least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows)) * CAST(0.3 AS DOUBLE)
       WHEN inter = uni THEN CAST(1 AS DOUBLE) ELSE inter / uni END AS similarity
FROM n JOIN j USING (pair)"""


@register("compare_large_results", LARGE_PAIRS)
def q_compare_large_results(spark, sf_dir):
    """X2/X3 on results of whole-table size: one side has fewer rows; one row differs, the last."""
    line = read_table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("cell"), "l_orderkey")
    top = line.agg(F.max("cell").alias("top"))
    ref = line.select(F.lit("ref").alias("side"), "cell")
    fewer = ref.unionByName(line.where(F.col("l_orderkey") % 4 != 0).select(F.lit("gen").alias("side"), "cell"))
    changed = line.crossJoin(F.broadcast(top)).select(F.lit("gen").alias("side"), F.when(F.col("cell") == F.col("top"), F.lit(-1)).otherwise(F.col("cell")).cast("bigint").alias("cell"))
    rows = fewer.withColumn("pair", F.lit("fewer")).unionByName(ref.unionByName(changed).withColumn("pair", F.lit("last")))
    status = rows.select("pair").distinct().withColumns({"gen_success": F.lit(True), "ref_success": F.lit(True)})
    return X.compare_pairs(status, rows, ["pair"]).select("pair", "gen_rows", "ref_rows", "exact_match", "similarity")


@register("execution_score", _q(*O.SCORED_BASE) + """
SELECT sample_id, gen_idx, execution_score, exact_match, similarity, gen_rows, ref_rows FROM scored""")
def q_execution_score(spark, sf_dir):
    df = outcome(spark, sf_dir)
    s, _ = C.execution_scorer()(df)
    return df.select(*KEYS, s.alias("execution_score"), "exact_match", "similarity", "gen_rows", "ref_rows")


# ---- C: composition -------------------------------------------------------------------

@register("composite_score", _q(*O.BASE) + f"""
SELECT sample_id, gen_idx, {O.dbl(0)} + {O.syntax_score()} * {O.dbl(0.5)} + {O.semantic_score()} * {O.dbl(0.5)} AS score FROM texted""")
def q_composite_score(spark, sf_dir):
    """C1 with default (equal) weights over syntax and semantic scorers."""
    df = texted(spark, sf_dir)
    s, _ = C.composite(df, [("syntax", C.syntax_scorer()), ("semantic", C.semantic_scorer())])
    return df.select(*KEYS, s.alias("score"))


@register("sql_score", _q(*O.SCORED_BASE) + """
SELECT sample_id, gen_idx, syntax_score, execution_score, semantic_score, score FROM final""")
def q_sql_score(spark, sf_dir):
    """C2 — the flagship: combined score of every candidate."""
    return scored(spark, sf_dir).select(*KEYS, "syntax_score", "execution_score", "semantic_score", "score")


@register("score_by_type", _q(*O.SCORED_BASE) + """
SELECT sample_id, gen_idx, reward_type, score FROM (
  SELECT sample_id, gen_idx, 'syntax' AS reward_type, syntax_score AS score FROM final UNION ALL
  SELECT sample_id, gen_idx, 'execution', execution_score FROM final UNION ALL
  SELECT sample_id, gen_idx, 'semantic', semantic_score FROM final UNION ALL
  SELECT sample_id, gen_idx, 'combined', score FROM final)""")
def q_score_by_type(spark, sf_dir):
    """Every scorer picked by name, long format."""
    df = outcome(spark, sf_dir)
    cols = {}
    for name in ("syntax", "execution", "semantic", "combined"):
        s, _ = C.score_by_type(name)(df)
        cols[name] = s
    wide = df.select(*KEYS, *[v.alias(k) for k, v in cols.items()])
    return wide.unpivot(KEYS, list(cols), "reward_type", "score")


@register("safe_score", _q(*O.SCORED_BASE) + """
SELECT sample_id, gen_idx, CASE WHEN completion IS NULL OR answer IS NULL OR score IS NULL THEN CAST(-1 AS DOUBLE) ELSE score END AS score,
  completion IS NOT NULL AND answer IS NOT NULL AND score IS NOT NULL AS scored FROM final""")
def q_safe_score(spark, sf_dir):
    return scored(spark, sf_dir).select(*KEYS, "score", "scored")


@register("rubric_score", _q(*O.SCORED_BASE) + f"""
SELECT sample_id, gen_idx, {O.dbl(0)} + score * {O.dbl(0.9)} + {O.format_score('completion')} * {O.dbl(0.1)} AS rubric_score FROM final""")
def q_rubric_score(spark, sf_dir):
    df = scored(spark, sf_dir)
    return df.select(*KEYS, C.rubric_score(F.col("score"), F.col("completion"), True).alias("rubric_score"))


@register("reward_statistics", _q(*O.SCORED_BASE) + """
SELECT count(*) FILTER (WHERE scored) AS call_count, round(coalesce(sum(score) FILTER (WHERE scored), 0), 6) AS total_reward,
  round(CASE WHEN count(*) FILTER (WHERE scored) > 0 THEN sum(score) FILTER (WHERE scored) / count(*) FILTER (WHERE scored) ELSE 0 END, 6) AS average_reward
FROM (SELECT *, true AS scored FROM final)""")
def q_reward_statistics(spark, sf_dir):
    st = C.reward_statistics(scored(spark, sf_dir))
    return st.select("call_count", F.round("total_reward", 6).alias("total_reward"),
                     F.round("average_reward", 6).alias("average_reward"))


# ---- D: dedup ---------------------------------------------------------------------------

@register("score_distinct", f"""
WITH d AS (SELECT doc_id, text FROM documents), u AS (SELECT DISTINCT text FROM d),
x1 AS (SELECT text, {O.extract_stage1('text')} AS _s1 FROM u),
x2 AS (SELECT text, {O.extract_stage2('_s1')} AS sql FROM x1),
s AS (SELECT text, {O.syntax_score()} AS syntax_score FROM x2)
SELECT d.doc_id, s.syntax_score FROM d LEFT JOIN s USING (text)""")
def q_score_distinct(spark, sf_dir):
    """Score each distinct document text once (syntax scorer), join back by key."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")

    def score_fn(keys: DataFrame) -> DataFrame:
        k = keys.withColumn("_s1", T.extract_sql_stage1(F.col("text")))
        k = C.with_syntax_columns(k.withColumn(C.SQL, T.extract_sql_stage2(F.col("_s1"))))
        s, _ = C.syntax_scorer()(k)
        return k.withColumn("syntax_score", s)

    return C.score_distinct(docs, "doc_id", ["text"], score_fn, ["syntax_score"]).select("doc_id", "syntax_score")


DUPLICATE_SQL = """
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS calls, count(*) AS distinct_keys,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeats,
       CASE WHEN sum(n) > 0 THEN sum(n - 1) / sum(n) ELSE CAST(0 AS DOUBLE) END AS repeat_rate FROM per_key"""


@register("duplicate_stats", "WITH per_key AS (SELECT text, count(*) AS n FROM documents GROUP BY text)" + DUPLICATE_SQL)
def q_duplicate_stats(spark, sf_dir):
    """D2 over all documents: how many scorings the distinct texts save."""
    return C.duplicate_stats(read_table(spark, sf_dir, "documents"), ["text"])


@register("duplicate_stats_candidates", _q(O.CANDIDATES) + """
, per_key AS (SELECT question, completion, answer, context, count(*) AS n FROM candidates GROUP BY ALL)""" + DUPLICATE_SQL)
def q_duplicate_stats_candidates(spark, sf_dir):
    """D2 over all candidates, keyed by the scorer's four inputs."""
    return C.duplicate_stats(FX.candidates(spark, sf_dir), ["question", "completion", "answer", "context"])


@register("distinct_executions", _q(*O.BASE) + """
SELECT DISTINCT md5(q || ':' || coalesce(schema, '')) AS exec_key, q AS query, schema FROM (
  SELECT sql AS q, schema FROM texted UNION ALL SELECT ref_sql AS q, schema FROM texted)""")
def q_distinct_executions(spark, sf_dir):
    df = texted(spark, sf_dir)
    both = df.select(F.col(C.SQL).alias("q"), F.col(C.SCHEMA).alias("s")).unionByName(
        df.select(F.col(C.REF).alias("q"), F.col(C.SCHEMA).alias("s")))
    return C.distinct_executions(both, "q", "s")


@register("failing_scorer", """
SELECT doc_id, CASE WHEN text IS NOT NULL AND source IS NOT NULL AND regexp_matches(text, '[0-9]')
                    THEN CAST(regexp_extract(text, '[0-9]') AS DOUBLE) / 10 ELSE CAST(-1 AS DOUBLE) END AS score,
       text IS NOT NULL AND source IS NOT NULL AND regexp_matches(text, '[0-9]') AS scored,
       CASE WHEN NOT regexp_matches(coalesce(text, ''), '[0-9]') THEN 'AttributeError' END AS error_kind
FROM documents""")
def q_failing_scorer(spark, sf_dir):
    """C4 with a scorer that raises: a Python rule over whole texts that fails on those without a digit."""
    import re

    def first_digit(prompt, completion, answer):
        return completion.map(lambda t: int(re.search("[0-9]", t).group()) / 10)  # None has no group

    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("completion"), F.col("source").alias("answer"))
    out = C.apply_scorer(docs, C.pandas_scorer(first_digit, "first_digit")())
    return out.select("doc_id", "score", "scored", F.substring_index("details.error", ":", 1).alias("error_kind"))


# ---- E / M / V7: evaluation ------------------------------------------------------------

@register("explode_generations", _q(O.CANDIDATES) + "SELECT sample_id, CAST(gen_idx AS INTEGER) AS gen_idx, completion FROM candidates")
def q_explode_generations(spark, sf_dir):
    """The array form of the generations exploded back to one row each."""
    wide = FX.candidates_wide(spark, sf_dir)
    return E.explode_generations(wide, "generated", "completion", "gen_idx").select("sample_id", "gen_idx", "completion")


@register("sample_rewards", _q(*O.SCORED_BASE) + """
SELECT sample_id, max(score) AS best_reward, round(avg(score), 6) AS mean_reward, count(*) AS num_generations,
  list(completion ORDER BY gen_idx) AS generated, list(score ORDER BY gen_idx) AS rewards
FROM final GROUP BY sample_id""")
def q_sample_rewards(spark, sf_dir):
    """Best and mean reward of every sample, with the generations and rewards they are taken of."""
    return per_sample(spark, sf_dir, keep_lists=True).withColumn("mean_reward", F.round("mean_reward", 6))


@register("evaluation_record", _q(*O.SCORED_BASE) + f"""
SELECT sample_id, substring({{PROMPT_SQL}}, 1, 100) || '...' AS prompt, min(answer) AS answer,
  list(completion ORDER BY gen_idx) AS generated, list(score ORDER BY gen_idx) AS rewards,
  max(score) AS best_reward, round(avg(score), 6) AS mean_reward
FROM final GROUP BY sample_id, 2""".replace("{PROMPT_SQL}", PROMPT_SQL))
def q_evaluation_record(spark, sf_dir):
    """E2 in full: prompt preview, answer, generations and rewards in order, best and mean."""
    df = D.build_prompt(scored(spark, sf_dir)).withColumn("prompt", T.preview(F.col("prompt"), 100, ellipsis=True))
    out = E.sample_rewards(df, ["sample_id", "prompt", "answer"], keep_lists=True)
    return out.withColumn("mean_reward", F.round("mean_reward", 6)).drop("num_generations")


@register("evaluation_summary", _q(*O.SCORED_BASE, O.PER_SAMPLE) + """
SELECT count(*) AS num_samples, max(num_generations) AS num_generations_per_sample,
  round(avg(best_reward), 6) AS best_reward_mean, round(stddev_samp(best_reward), 6) AS best_reward_std,
  round(avg(mean_reward), 6) AS mean_reward_mean, round(stddev_samp(mean_reward), 6) AS mean_reward_std,
  round(avg(CAST(best_reward > 0.5 AS DOUBLE)), 6) AS success_rate, round(avg(CAST(best_reward > 0.95 AS DOUBLE)), 6) AS perfect_rate
FROM per_sample""")
def q_evaluation_summary(spark, sf_dir):
    return E.evaluation_summary(per_sample(spark, sf_dir), digits=6)


@register("success_filter", _q(*O.SCORED_BASE, O.PER_SAMPLE) + """
SELECT sample_id, best_reward, best_reward > 0.95 AS perfect FROM per_sample WHERE best_reward > 0.5""")
def q_success_filter(spark, sf_dir):
    ok, top = E.success_flags()
    return per_sample(spark, sf_dir).where(ok).select("sample_id", "best_reward", top.alias("perfect"))


@register("reward_monitor", _q(*O.SCORED_BASE) + """
SELECT gen_idx, round(avg(score), 6) AS reward_mean, round(stddev_samp(score), 6) AS reward_std, count(*) AS num_generations
FROM final GROUP BY gen_idx""")
def q_reward_monitor(spark, sf_dir):
    """M1: reward mean/std per generation step."""
    return E.reward_monitor(scored(spark, sf_dir), ["gen_idx"], digits=6)


@register("score_range_check", _q(*O.SCORED_BASE) + """
SELECT count(*) FILTER (WHERE NOT (score BETWEEN -1 AND 1)) AS out_of_range, count(*) AS num_scores FROM final""")
def q_score_range_check(spark, sf_dir):
    return D.score_range_check(scored(spark, sf_dir))


@register("top_results", _q(*O.SCORED_BASE) + """
, firsts AS (SELECT * FROM final WHERE gen_idx = 0)
SELECT sample_id, substring({PROMPT_SQL}, 1, 100) || '...' AS prompt,
       answer, completion AS first_generation, score AS first_reward
FROM firsts ORDER BY sample_id LIMIT 5""".replace("{PROMPT_SQL}", PROMPT_SQL))
def q_top_results(spark, sf_dir):
    """The first ``show_samples`` detail rows (a top-k report); their ids are found first and reach all scans as literals."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey")
    ids = [r["c_custkey"] for r in customers.orderBy("c_custkey").limit(EvalParams().show_samples).collect()]  # a report of so many rows
    first = FX.candidates(spark, sf_dir).where((F.col("gen_idx") == 0) & F.col("sample_id").isin(ids))
    df = D.build_prompt(scored(spark, sf_dir, cands=first))
    return df.select(
        "sample_id", T.preview(F.col("prompt"), 100, ellipsis=True).alias("prompt"), "answer",
        F.col("completion").alias("first_generation"), F.col("score").alias("first_reward"))


# ---- R: ordering, subsets, splits ---------------------------------------------------------

HASH = "md5(CAST({id} AS VARCHAR) || ':42')"
SPLIT_HASH = "md5(CAST({id} AS VARCHAR) || ':42:split')"


@register("seeded_shuffle", f"""
SELECT c_custkey, row_number() OVER (ORDER BY {HASH.format(id='c_custkey')}, c_custkey) - 1 AS shuffle_pos FROM customer""")
def q_seeded_shuffle(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    return D.seeded_shuffle(cust, "c_custkey").select("c_custkey", _big(F.col("shuffle_pos")).alias("shuffle_pos"))


_DP = DataParams()
_SUBSET_N = _DP.train_size + _DP.test_size
SUBSET_SQL = f"""sub AS (SELECT * FROM orders ORDER BY {HASH.format(id='o_orderkey')}, o_orderkey LIMIT {_SUBSET_N})"""


@register("take_subset", f"WITH {SUBSET_SQL} SELECT o_orderkey, o_custkey FROM sub")
def q_take_subset(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return D.take_subset(orders, "o_orderkey", _SUBSET_N, _DP.seed)


def _split_sql() -> str:
    frac = _DP.test_size / (_DP.train_size + _DP.test_size)
    return f"""split AS (SELECT o_orderkey, o_custkey,
  CASE WHEN row_number() OVER (ORDER BY {SPLIT_HASH.format(id='o_orderkey')}, o_orderkey)
            <= CAST(ceil(count(*) OVER () * CAST({frac!r} AS DOUBLE)) AS BIGINT) THEN 'test' ELSE 'train' END AS split
  FROM sub)"""


def _orders_split(spark, sf_dir) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return D.prepare_splits(orders, "o_orderkey", _DP)


def _orders_split_sql(tail: str) -> str:
    return f"WITH {SUBSET_SQL}, {_split_sql()} {tail}"


@register("train_test_split", _orders_split_sql("SELECT o_orderkey, o_custkey, split FROM split"))
def q_train_test_split(spark, sf_dir):
    return _orders_split(spark, sf_dir).select("o_orderkey", "o_custkey", "split")


@register("split_accessor", _orders_split_sql("SELECT split, count(*) AS num_rows FROM split GROUP BY split"))
def q_split_accessor(spark, sf_dir):
    return D.split_counts(_orders_split(spark, sf_dir))


@register("load_split", _orders_split_sql("SELECT o_orderkey, o_custkey FROM split WHERE split = 'test'"))
def q_load_split(spark, sf_dir):
    """Persist the split dataset (partitioned by split), read back the test split."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "splits", uuid.uuid4().hex)
    write_splits(_orders_split(spark, sf_dir), path)
    return load_split(spark, path, "test").select("o_orderkey", "o_custkey")


@register("holdout_slice", f"""
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
WHERE pos >= {_DP.train_size} AND pos < {_DP.train_size + _DP.test_size}""")
def q_holdout_slice(spark, sf_dir):
    """Positions [train_size, train_size + test_size) of source (key) order."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return D.holdout_slice(orders, "o_orderkey", _DP.train_size, _DP.train_size + _DP.test_size)


@register("cap_samples", f"SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT {EvalParams().num_samples}")
def q_cap_samples(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return D.cap_samples(orders, "o_orderkey", EvalParams().num_samples)


@register("sample_preview", f"""
WITH s AS (SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY {SPLIT_HASH.format(id='doc_id')}, doc_id)
                  <= CAST(ceil(count(*) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM documents),
t AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {SPLIT_HASH.format(id='doc_id')}, doc_id) - 1 AS idx FROM s)
SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS text, split
FROM t WHERE split = 'train' AND idx = 0""")
def q_sample_preview(spark, sf_dir):
    """Row 0 of the train split of documents, long strings cut at 200 chars."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return D.split_preview(docs, "doc_id", 0.2, "train", 0, _DP.seed).select("doc_id", "text", "split")


# ---- P: formatting -----------------------------------------------------------------------

@register("build_prompt", _q(O.SAMPLES) + f"SELECT sample_id, {PROMPT_SQL} AS prompt, answer, context, question AS original_question FROM samples")
def q_build_prompt(spark, sf_dir):
    return D.build_prompt(FX.samples(spark, sf_dir)).select("sample_id", "prompt", "answer", "context", "original_question")


def _sys_sql(xml: bool) -> str:
    from ..params import SYSTEM_PROMPT, XML_FORMAT_SUFFIX
    tpl = SYSTEM_PROMPT + (XML_FORMAT_SUFFIX if xml else "")
    head, _, tail = tpl.partition("{schema}")
    return f"({O.lit(head)} || coalesce(context, '') || {O.lit(tail)})"


CONV_PAIRS = """u AS (SELECT conv_id, turn, text AS question FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, text AS answer FROM conversations WHERE role = 'assistant'),
sy AS (SELECT conv_id, arg_min(text, turn) AS context FROM conversations WHERE role = 'system' GROUP BY conv_id),
pairs AS (SELECT u.conv_id, u.turn, u.question, coalesce(sy.context, '') AS context, a.answer
          FROM u JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn LEFT JOIN sy ON sy.conv_id = u.conv_id)"""


@register("build_messages", f"""WITH {CONV_PAIRS}
SELECT conv_id, turn, CAST(m.i AS BIGINT) AS msg_idx, m.role, m.content FROM pairs,
LATERAL (SELECT 0 AS i, 'system' AS role, {_sys_sql(False)} AS content UNION ALL
         SELECT 1, 'user', question UNION ALL SELECT 2, 'assistant', answer) m""")
def q_build_messages(spark, sf_dir):
    """P2 over conversation pairs, flattened to one row per message."""
    msgs = D.build_messages(FX.conversation_pairs(spark, sf_dir))
    flat = msgs.select("conv_id", "turn", F.posexplode("messages").alias("msg_idx", "m"))
    return flat.select("conv_id", "turn", _big(F.col("msg_idx")).alias("msg_idx"),
                       F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def _chatml(role_sql: str, content_sql: str) -> str:
    return f"'<|im_start|>' || {role_sql} || chr(10) || {content_sql} || '<|im_end|>' || chr(10)"


@register("render_chat", f"""WITH {CONV_PAIRS}
SELECT conv_id, turn, {_chatml("'system'", _sys_sql(False))} || {_chatml("'user'", 'question')} || {_chatml("'assistant'", 'answer')} AS text
FROM pairs""")
def q_render_chat(spark, sf_dir):
    """ChatML training text of every conversation pair."""
    df = D.render_chat(D.build_messages(FX.conversation_pairs(spark, sf_dir)))
    return df.select("conv_id", "turn", "text")


@register("chat_prompt", _q(O.SAMPLES) + f"""
SELECT sample_id, {_chatml("'system'", _sys_sql(False))} || {_chatml("'user'", PROMPT_SQL)} || '<|im_start|>assistant' || chr(10) AS input_text
FROM samples""")
def q_chat_prompt(spark, sf_dir):
    """System + user prompt rendered with the generation prompt appended."""
    df = D.chat_prompt(D.build_prompt(FX.samples(spark, sf_dir)))
    return df.select("sample_id", "input_text")


@register("xml_system_prompt", _q(O.SAMPLES) + f"SELECT sample_id, {_sys_sql(True)} AS system_prompt FROM samples")
def q_xml_system_prompt(spark, sf_dir):
    s = FX.samples(spark, sf_dir)
    return s.select("sample_id", D.system_prompt(F.col("context"), use_xml_format=True).alias("system_prompt"))


@register("previews", _q(O.SAMPLES) + f"""
SELECT sample_id, substring({PROMPT_SQL}, 1, 100) || '...' AS prompt_preview, substring(answer, 1, 100) AS answer_preview FROM samples""")
def q_previews(spark, sf_dir):
    df = D.build_prompt(FX.samples(spark, sf_dir))
    return D.previews(df, {"prompt": (100, True), "answer": (100, False)}).select("sample_id", "prompt_preview", "answer_preview")


@register("map_fields", f"WITH {CONV_PAIRS} SELECT question AS prompt, answer, context FROM pairs")
def q_map_fields(spark, sf_dir):
    """S3: conversation fields renamed to prompt/answer/context."""
    pairs = FX.conversation_pairs(spark, sf_dir)
    return map_fields(pairs, {"question": "prompt", "answer": "answer", "context": "context"})


# ---- V: checks -------------------------------------------------------------------------------

@register("non_empty_fields", f"""WITH {CONV_PAIRS}, p AS (SELECT {PROMPT_SQL} AS prompt, answer FROM pairs)
SELECT count(*) AS num_rows, count(*) FILTER (WHERE coalesce({O.strip('prompt')}, '') = '') AS empty_prompt,
       count(*) FILTER (WHERE coalesce({O.strip('answer')}, '') = '') AS empty_answer FROM p""")
def q_non_empty_fields(spark, sf_dir):
    """V2 over all prompt rows built from conversation pairs."""
    return D.non_empty_fields(D.build_prompt(FX.conversation_pairs(spark, sf_dir)))


@register("non_empty_dataset", "SELECT count(*) > 0 AS has_rows FROM (SELECT 1 FROM documents LIMIT 1)")
def q_non_empty_dataset(spark, sf_dir):
    return D.non_empty_dataset(read_table(spark, sf_dir, "documents"))


@register("ground_truth_check", _q(O.SAMPLES) + f"""
, gt AS (SELECT s.sample_id, s.answer AS completion, s.answer, s.context, true AS gen_success, true AS ref_success,
                CAST(NULL AS VARCHAR) AS gen_error, 0 AS gen_idx FROM samples s),
{O.text_stages('gt')},
rr AS (SELECT o_custkey AS sample_id, count(*) AS n FROM orders GROUP BY o_custkey),
matched AS (SELECT t.*, coalesce(rr.n, 0) AS gen_rows, coalesce(rr.n, 0) AS ref_rows, true AS exact_match,
                   CAST(1 AS DOUBLE) AS similarity FROM texted t LEFT JOIN rr USING (sample_id)),
{O.SCORED}
SELECT sample_id, score FROM final""")
def q_ground_truth_check(spark, sf_dir):
    """V5: every reference answer executed and scored against itself."""
    from ..sources.executor import execute_candidates
    from ..sources.tables import register_tables
    s = D.ground_truth_pairs(FX.samples(spark, sf_dir)).withColumn("gen_idx", F.lit(0))
    df = execute_candidates(spark, C.with_sql_columns(s), KEYS, lambda x: register_tables(x, sf_dir))
    total, _ = C.combined_scorer()(df)
    return df.select("sample_id", total.alias("score"))


# ---- S4: sink ------------------------------------------------------------------------------

@register("write_eval_summary", _q(*O.SCORED_BASE, O.PER_SAMPLE) + """
SELECT count(*) AS num_samples, max(num_generations) AS num_generations_per_sample,
  round(avg(best_reward), 6) AS best_reward_mean, round(stddev_samp(best_reward), 6) AS best_reward_std,
  round(avg(mean_reward), 6) AS mean_reward_mean, round(stddev_samp(mean_reward), 6) AS mean_reward_std,
  round(avg(CAST(best_reward > 0.5 AS DOUBLE)), 6) AS success_rate, round(avg(CAST(best_reward > 0.95 AS DOUBLE)), 6) AS perfect_rate
FROM per_sample""")
def q_write_eval_summary(spark, sf_dir):
    """Write the summary as JSON, read it back (schema given, not inferred)."""
    summary = E.evaluation_summary(per_sample(spark, sf_dir), digits=6)
    path = os.path.join(ensure_checkpoint_dir(spark), "eval_summary", uuid.uuid4().hex)
    write_eval_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


# ---- X1: real execution ---------------------------------------------------------------------

@register("run_query_batch", _q(O.CANDIDATES) + r"""
, rr AS (
  SELECT c.sample_id, c.gen_idx, 'ref' AS side, o.o_orderkey AS cell
  FROM candidates c JOIN orders o ON o.o_custkey = c.sample_id
  UNION ALL
  SELECT c.sample_id, c.gen_idx, 'gen' AS side,
    CASE WHEN c.v = 6 AND o.o_orderkey % 2 = 0 THEN o.o_orderkey + 1000000 ELSE o.o_orderkey END AS cell
  FROM candidates c JOIN orders o ON o.o_custkey = c.sample_id
  WHERE c.v NOT IN (7, 8) AND NOT (c.v = 5 AND o.o_orderkey % 3 = 0)),
cnt AS (SELECT sample_id, gen_idx, count(*) FILTER (WHERE side = 'gen') AS gen_rows,
               count(*) FILTER (WHERE side = 'ref') AS ref_rows FROM rr GROUP BY sample_id, gen_idx),
mk AS (SELECT sample_id, gen_idx, cell, max(CAST(side = 'gen' AS INTEGER)) AS g, max(CAST(side = 'ref' AS INTEGER)) AS r
       FROM rr GROUP BY sample_id, gen_idx, cell),
ov AS (SELECT sample_id, gen_idx, sum(g * r) AS inter, count(*) AS uni FROM mk GROUP BY sample_id, gen_idx),
m AS (SELECT c.sample_id, c.gen_idx, c.v NOT IN (7, 8) AS gen_success, true AS ref_success,
             CASE WHEN c.v IN (7, 8) THEN 0 ELSE coalesce(cnt.gen_rows, 0) END AS gen_rows, coalesce(cnt.ref_rows, 0) AS ref_rows,
             coalesce(ov.inter, 0) AS inter, coalesce(ov.uni, 0) AS uni
      FROM candidates c LEFT JOIN cnt USING (sample_id, gen_idx) LEFT JOIN ov USING (sample_id, gen_idx)),
x AS (SELECT *, gen_success AND ref_success AND gen_rows = ref_rows AND inter = uni AS exact_match,
        CASE WHEN NOT (gen_success AND ref_success) THEN CAST(0 AS DOUBLE)
             WHEN gen_rows <> ref_rows THEN (least(gen_rows, ref_rows) / greatest(gen_rows, ref_rows)) * CAST(0.3 AS DOUBLE)
             WHEN inter = uni THEN CAST(1 AS DOUBLE) ELSE inter / uni END AS similarity FROM m)
SELECT sample_id, gen_idx, gen_success, ref_success, CAST(gen_rows AS BIGINT) AS gen_rows, CAST(ref_rows AS BIGINT) AS ref_rows,
  exact_match, similarity,
  CASE WHEN NOT gen_success THEN CAST(-0.6 AS DOUBLE) WHEN exact_match THEN CAST(1 AS DOUBLE)
       ELSE similarity * CAST(0.7 AS DOUBLE) - CAST(0.3 AS DOUBLE) END AS execution_score
FROM x""")
def q_run_query_batch(spark, sf_dir):
    """X1 end to end: every distinct candidate and reference query executed
    against the driver tables (one lateral job per query template), then
    compared and scored (X2/X3/X7)."""
    from ..sources.executor import execute_candidates
    from ..sources.tables import register_tables
    queries = texted(spark, sf_dir).select(*KEYS, C.SQL, C.REF, C.SCHEMA)  # what an execution is made of
    df = execute_candidates(spark, queries, KEYS, lambda s: register_tables(s, sf_dir))
    s, _ = C.execution_scorer()(df)
    return df.select(*KEYS, "gen_success", "ref_success", "gen_rows", "ref_rows", "exact_match", "similarity",
                     s.alias("execution_score"))


@register("kept_executions", _q(*O.BASE) + r"""
, q AS (SELECT sql AS query, schema, gen_idx FROM texted UNION ALL SELECT ref_sql, schema, gen_idx FROM texted),
k AS (SELECT md5(query || ':' || schema) AS query_id, min(gen_idx) < 2 AS early, min(query) AS query FROM q
      WHERE schema IS NOT NULL AND schema <> '' GROUP BY 1),
p AS (SELECT *, query NOT IN ('', 'INVALID SQL QUERY HERE') AS success,
             TRY_CAST(regexp_extract(query, '(?i)o_custkey = ([0-9]+)', 1) AS BIGINT) AS cust, contains(query, '% 3 <> 0') AS thinned FROM k),
n AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS n3 FROM orders GROUP BY o_custkey)
SELECT query_id, success, CAST(CASE WHEN success THEN coalesce(CASE WHEN thinned THEN n3 ELSE n END, 0) ELSE 0 END AS BIGINT) AS row_count,
       early AS in_first, CAST(CASE WHEN early AND NOT success THEN 2 ELSE 1 END AS BIGINT) AS times_run
FROM p LEFT JOIN n ON o_custkey = cust""")
def q_kept_executions(spark, sf_dir):
    """D3 over two batches: the second runs new queries and those that failed, the rest comes from the store."""
    from ..functions.schema import execution_key, has_schema
    from ..sources.executor import run_query_batch
    from ..sources.store import ExecutionStore
    from ..sources.tables import register_tables
    ensure_checkpoint_dir(spark)
    # both batches ask the store for their queries, then take the new ones: four times these texts
    df = texted(spark, sf_dir).where(has_schema(F.col(C.SCHEMA))).select("gen_idx", C.SQL, C.REF, C.SCHEMA).checkpoint()
    store = ExecutionStore(spark, os.path.join(ensure_checkpoint_dir(spark), "stores", uuid.uuid4().hex), buckets=16)

    def batch(part: DataFrame) -> DataFrame:
        qs = part.select(execution_key(F.col(C.SQL), F.col(C.SCHEMA)).alias("query_id"), F.col(C.SQL).alias("query"), C.SCHEMA).unionByName(
            part.select(execution_key(F.col(C.REF), F.col(C.SCHEMA)).alias("query_id"), F.col(C.REF).alias("query"), C.SCHEMA))
        return run_query_batch(spark, qs, lambda s: register_tables(s, sf_dir), schema=C.SCHEMA, store=store)[0]
    first = batch(df.where("gen_idx < 2")).select("query_id", F.lit(1).alias("_first"))
    second = batch(df)
    times = F.coalesce("_first", F.lit(0)) + F.when(F.col("kept"), 0).otherwise(1)
    return second.join(first, "query_id", "left").select("query_id", "success", "row_count", F.col("_first").isNotNull().alias("in_first"),
                                                         times.cast("bigint").alias("times_run"))


# ---- details, whole texts, sinks -------------------------------------------------------------

@register("score_details", _q(*O.SCORED_BASE) + """
SELECT sample_id, gen_idx, score, syntax_score, CAST(0.2 AS DOUBLE) AS syntax_weight, execution_score * CAST(0.6 AS DOUBLE) AS execution_weighted,
  CASE WHEN gen_success AND ref_success THEN exact_match END AS exact_match,
  CASE WHEN gen_success AND ref_success THEN CAST(gen_rows AS BIGINT) END AS generated_rows,
  CASE WHEN NOT gen_success THEN gen_error END AS error, semantic_score, CAST(3 AS INTEGER) AS num_components
FROM final""")
def q_score_details(spark, sf_dir):
    """Score, component details and metadata written as nested columns; single members read back."""
    path = os.path.join(ensure_checkpoint_dir(spark), "scores", uuid.uuid4().hex)
    C.with_details(outcome(spark, sf_dir)).select(*KEYS, "score", "scored", "details", "metadata").write.parquet(path)
    d = F.col("details")
    ex = d["reward_1_execution"]
    return spark.read.parquet(path).select(
        *KEYS, "score", d["reward_0_syntax"]["score"].alias("syntax_score"), d["reward_0_syntax"]["weight"].alias("syntax_weight"),
        ex["weighted_score"].alias("execution_weighted"), ex["details"]["exact_match"].alias("exact_match"),
        ex["details"]["generated_rows"].alias("generated_rows"), ex["details"]["error"].alias("error"),
        d["reward_2_semantic"]["score"].alias("semantic_score"), F.col("metadata.num_components").alias("num_components"))


@register("text_functions_documents", f"""
WITH x1 AS (SELECT doc_id, coalesce(text, '') AS text, {O.extract_stage1("coalesce(text, '')")} AS _s1 FROM documents),
x2 AS (SELECT doc_id, text, {O.extract_stage2('_s1')} AS sql FROM x1)
SELECT doc_id, md5(regexp_replace(text, {O.lit(O.THINK_BLOCK)}, '', 'g')) AS stripped_think, md5({O.strip('text')}) AS stripped, md5(sql) AS extracted,
  length(sql) > 0 AS syntax_valid, CAST({O.token_count('sql')} AS BIGINT) AS token_count, CAST({O.keyword_count('sql')} AS BIGINT) AS keyword_count,
  {O.syntax_score()} AS syntax_score, {O.format_score('text')} AS format_score FROM x2""")
def q_text_functions_documents(spark, sf_dir):
    """T1, T3–T9 and T16 over whole document texts."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = docs.withColumn("_s1", T.extract_sql_stage1(F.col("text")))
    d = C.with_syntax_columns(d.withColumn(C.SQL, T.extract_sql_stage2(F.col("_s1"))))
    score, _ = C.syntax_scorer()(d)
    return d.select("doc_id", F.md5(T.strip_think("text")).alias("stripped_think"), F.md5(T.py_strip("text")).alias("stripped"),
                    F.md5(C.SQL).alias("extracted"), T.syntax_valid(F.col(C.SQL)).alias("syntax_valid"), _big(F.col(C.N_TOK)).alias("token_count"),
                    _big(F.col(C.N_KW)).alias("keyword_count"), score.alias("syntax_score"), T.format_score(F.col("text")).alias("format_score"))


@register("semantic_score_conversations", f"""WITH {CONV_PAIRS},
n AS (SELECT conv_id, turn, {O.normalize('question')} AS gen_norm, {O.normalize('answer')} AS ref_norm FROM pairs),
t AS (SELECT *, {O.tokens('gen_norm')} AS gen_tokens, {O.tokens('ref_norm')} AS ref_tokens FROM n)
SELECT conv_id, turn, {O.semantic_score()} AS semantic_score FROM t""")
def q_semantic_score_conversations(spark, sf_dir):
    """T10–T12 over question and answer texts of all conversations."""
    pairs = FX.conversation_pairs(spark, sf_dir).select("conv_id", "turn", T.normalize_sql("question").alias(C.GEN_NORM), T.normalize_sql("answer").alias(C.REF_NORM))
    pairs = pairs.withColumns({C.GEN_TOK: T.tokens(F.col(C.GEN_NORM)), C.REF_TOK: T.tokens(F.col(C.REF_NORM))})
    score, _ = C.semantic_scorer()(pairs)
    return pairs.select("conv_id", "turn", score.alias("semantic_score"))


@register("observed_checks", _q(*O.SCORED_BASE) + f"""
, p AS (SELECT final.*, {PROMPT_SQL} AS prompt FROM final)
SELECT count(*) AS num_rows, count(*) FILTER (WHERE coalesce({O.strip('prompt')}, '') = '') AS empty_prompt,
  count(*) FILTER (WHERE coalesce({O.strip('completion')}, '') = '') AS empty_completion, count(score) AS num_scores,
  count(*) FILTER (WHERE NOT (score BETWEEN -1 AND 1)) AS out_of_range, count(*) AS call_count, round(sum(score), 6) AS total_reward FROM p""")
def q_observed_checks(spark, sf_dir):
    """V2–V4 and C6 as metrics of the write of the scored rows: one pass, no job of their own."""
    rows, seen = D.observed(D.build_prompt(scored(spark, sf_dir)), "checks", ("prompt", "completion"), "score", "scored")
    path = os.path.join(ensure_checkpoint_dir(spark), "observed", uuid.uuid4().hex)
    rows.select(*KEYS, "prompt", "completion", "score", "scored").write.parquet(path)
    got = seen.get
    names = ["num_rows", "empty_prompt", "empty_completion", "num_scores", "out_of_range", "call_count"]
    return spark.createDataFrame([(*(got[n] for n in names), round(got["total_reward"], 6))], ", ".join(f"{n} long" for n in names) + ", total_reward double")


@register("write_evaluation", _q(*O.SCORED_BASE, O.PER_SAMPLE) + """
SELECT sample_id, best_reward, CAST(num_generations AS BIGINT) AS num_rewards, (SELECT count(*) FROM per_sample) AS num_samples,
  (SELECT round(avg(best_reward), 6) FROM per_sample) AS best_reward_mean FROM per_sample""")
def q_write_evaluation(spark, sf_dir):
    """S4 with its detail rows: the details to Parquet, the summary without them to JSON, both read back."""
    path = os.path.join(ensure_checkpoint_dir(spark), "evaluation", uuid.uuid4().hex)
    records = E.sample_rewards(scored(spark, sf_dir), ["sample_id"], keep_lists=True).checkpoint()  # scored once for details and summary
    summary = E.evaluation_summary(records, digits=6)
    write_evaluation(records, summary.withColumn("detailed_results", F.lit("not written")), path)
    read = spark.read.schema(summary.schema).json(f"{path}/summary").first()  # one row
    details = spark.read.parquet(f"{path}/details").select("sample_id", "best_reward", _big(F.size("rewards")).alias("num_rewards"))
    return details.withColumns({"num_samples": F.lit(read["num_samples"]).cast("long"), "best_reward_mean": F.lit(read["best_reward_mean"])})


@register("merged_moments", _q(*O.SCORED_BASE, O.PER_SAMPLE) + """
SELECT num_generations, count(*) AS n, round(avg(best_reward), 6) AS mean, round(stddev_samp(best_reward), 6) AS std,
  round(avg(CAST(best_reward > 0.5 AS DOUBLE)), 6) AS success_rate, round(avg(CAST(best_reward > 0.95 AS DOUBLE)), 6) AS perfect_rate
FROM per_sample GROUP BY num_generations""")
def q_merged_moments(spark, sf_dir):
    """M1/E3 over runs: each run (a fifth of the samples) adds its state; the merged state is that of all rows."""
    samples = per_sample(spark, sf_dir).checkpoint()
    path = os.path.join(ensure_checkpoint_dir(spark), "moments", uuid.uuid4().hex)
    for k in (0, 1, 2, 3, 4, 0):  # the first run is written again
        E.append_moments(E.moments(samples.where(F.col("sample_id") % 5 == k), ["num_generations"]), path, f"run-{k}")
    return E.summary_of_moments(E.merge_moments(spark.read.parquet(path), ["num_generations"]), digits=6)


@register("sharded_shuffle", f"""
SELECT doc_id, row_number() OVER (ORDER BY {HASH.format(id='doc_id')}, doc_id) - 1 AS shuffle_pos FROM documents""")
def q_sharded_shuffle(spark, sf_dir):
    """Documents written in seeded shuffle order and read back with their positions."""
    path = os.path.join(ensure_checkpoint_dir(spark), "shuffled", uuid.uuid4().hex)
    write_shuffled(read_table(spark, sf_dir, "documents"), "doc_id", path, shards=16)
    return read_shuffled(spark, path).select("doc_id", _big(F.col("shuffle_pos")).alias("shuffle_pos"))


@register("load_json", """
SELECT conv_id, turn, role, text, CAST(NULL AS VARCHAR) AS bad_line FROM conversations UNION ALL
SELECT NULL, NULL, NULL, NULL, '{"conv_id": ' || conv_id || ', "turn": "first' FROM conversations WHERE turn = 0""")
def q_load_json(spark, sf_dir):
    """S1 from JSON lines: conversations written as JSON with broken lines between, read with a declared schema."""
    conv = read_table(spark, sf_dir, "conversations")
    path = os.path.join(ensure_checkpoint_dir(spark), "json", uuid.uuid4().hex)
    bad = conv.where("turn = 0").select(F.concat(F.lit('{"conv_id": '), F.col("conv_id").cast("string"), F.lit(', "turn": "first')).alias("value"))
    conv.select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value")).unionByName(bad).write.text(path)
    kinds = dict(conv.dtypes)
    return read_json(spark, path, ", ".join(f"{c} {kinds[c]}" for c in ("conv_id", "turn", "role", "text")))
