"""Candidate and result-row fixtures derived from the driver tables.

``candidates``: one row per (customer, generation) with a reference query, a
generated completion in one of eleven variants and the execution status the
completion would get. ``result_rows``: the rows each side of a pair returns
(one bigint cell per row). Both grow linearly with ``customer``/``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import crowded, read_table, spread, tasks_for

# ---- fixed values (fixture recipe) -------------------------------------------
CONTEXT_DDL = "CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT);"
REF_PREFIX = "SELECT o_orderkey FROM orders WHERE o_custkey = "
REPLACED_SELECT = "SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 1000000 ELSE o_orderkey END"
N_VARIANTS = 11
CUSTOMERS_PER_TASK = 25_000  # the texts of all generations are made of each
ORDERS_PER_TASK = 100_000  # each makes the rows of both sides of all generations
# v: 0 exact, 1 case/newline, 2 fenced, 3 tagged, 4 commented, 5 rows missing,
#    6 rows replaced, 7 garbage, 8 blank, 9 timeout, 10 reference failed
# -------------------------------------------------------------------------------

NL = "\n"


def completion_for(v: Column, ref: Column) -> Column:
    """The generated completion of variant ``v`` for reference query ``ref``."""
    return (
        F.when(v == 0, ref)
        .when(v == 1, F.concat(F.lower(ref), F.lit(NL)))
        .when(v == 2, F.concat(F.lit("Here you go:" + NL + "```sql" + NL), ref, F.lit(NL + "```")))
        .when(v == 3, F.concat(F.lit("<think>filter on" + NL + "customer</think><answer>"), ref, F.lit("</answer>")))
        .when(v == 4, F.concat(F.lit("-- one customer" + NL), ref, F.lit(" /* done */")))
        .when(v == 5, F.concat(ref, F.lit(" AND o_orderkey % 3 <> 0")))
        .when(v == 6, F.replace(ref, F.lit("SELECT o_orderkey"), F.lit(REPLACED_SELECT)))
        .when(v == 7, F.lit("INVALID SQL QUERY HERE"))
        .when(v == 8, F.lit("   "))
        .when(v == 9, F.concat(ref, F.lit(" ORDER BY o_orderkey")))
        .otherwise(F.concat(ref, F.lit(";")))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the samples, dealt over all cores: a few bytes each, several whole texts are made and scored of one."""
    return spread(read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id")), rows_per_task=CUSTOMERS_PER_TASK)


def candidates(spark: SparkSession, sf_dir: str, generations: int = 4) -> DataFrame:
    cust = customers(spark, sf_dir)
    gen, cols = _candidate_exprs(generations)
    return cust.select("sample_id", gen).withColumns(cols[0]).select(*cols[1])


def _candidate_exprs(generations: int):
    gen = F.explode(F.sequence(F.lit(0), F.lit(generations - 1))).alias("gen_idx")
    stage = {
        "v": (F.col("sample_id") + F.col("gen_idx")) % N_VARIANTS,
        "ref": F.concat(F.lit(REF_PREFIX), F.col("sample_id").cast("string")),
    }
    v, ref = F.col("v"), F.col("ref")
    gen_error = (
        F.when(v == 7, F.lit("SQL error: syntax error"))
        .when(v == 8, F.lit("SQL error: empty query"))
        .when(v == 9, F.lit("Query execution timed out"))
    )
    out = [
        "sample_id", "gen_idx", "v",
        F.concat(F.lit("Which orders did customer "), F.col("sample_id").cast("string"), F.lit(" place?")).alias("question"),
        F.lit(CONTEXT_DDL).alias("context"),
        ref.alias("answer"),
        completion_for(v, ref).alias("completion"),
        (~v.isin(7, 8, 9)).alias("gen_success"),
        gen_error.alias("gen_error"),
        (v != 10).alias("ref_success"),
    ]
    return gen, (stage, out)


def candidates_wide(spark: SparkSession, sf_dir: str, generations: int = 4) -> DataFrame:
    """Array form: one row per sample with ``generated: array<string>`` (E1 input)."""
    cust = customers(spark, sf_dir)
    ref = F.concat(F.lit(REF_PREFIX), F.col("sample_id").cast("string"))
    gens = F.transform(F.sequence(F.lit(0), F.lit(generations - 1)),
                       lambda g: completion_for((F.col("sample_id") + g) % N_VARIANTS, ref))
    return cust.select("sample_id", ref.alias("answer"), gens.alias("generated"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw samples (``question, context, answer``), one per customer."""
    cust = customers(spark, sf_dir)
    return cust.select(
        "sample_id",
        F.concat(F.lit("Which orders did customer "), F.col("sample_id").cast("string"), F.lit(" place?")).alias("question"),
        F.lit(CONTEXT_DDL).alias("context"),
        F.concat(F.lit(REF_PREFIX), F.col("sample_id").cast("string")).alias("answer"),
    )


def result_rows(spark: SparkSession, sf_dir: str, cands: DataFrame | None = None, with_date: bool = False) -> DataFrame:
    """Rows each side returns: ``sample_id, gen_idx, side, cell``.

    One join of candidates with orders; both sides come out of it through a
    two-element explode (no second join, no second pass over orders). They meet
    by customer in tasks of bounded size: their rows are few bytes, but each
    order becomes several rows, so neither is broadcast nor are tasks merged.
    The orders of customers with more than a task's share are dealt evenly, and
    only these (few) customers' candidates are broadcast to them.
    """
    c = cands if cands is not None else candidates(spark, sf_dir)
    more = ["o_orderdate"] if with_date else []
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *more)
    keyed = c.select("sample_id", "gen_idx", "v", "gen_success", "ref_success")
    tasks = tasks_for(orders, ORDERS_PER_TASK)
    hot = crowded(orders, "o_custkey", ORDERS_PER_TASK, tasks)

    def met(k: DataFrame, o: DataFrame) -> DataFrame:
        return k.join(o, o.o_custkey == k.sample_id).select(*keyed.columns, "o_orderkey", *more)
    rest = orders if hot is None else orders.join(F.broadcast(hot), "o_custkey", "left_anti")
    joined = met(keyed, rest.repartition(tasks, "o_custkey").hint("merge"))
    if hot is not None:
        theirs = keyed.join(F.broadcast(hot), F.col("sample_id") == F.col("o_custkey"), "left_semi")
        crowd = spread(orders.join(F.broadcast(hot), "o_custkey", "left_semi"), rows_per_task=ORDERS_PER_TASK)
        joined = joined.unionByName(met(F.broadcast(theirs), crowd))
    ok, v = F.col("o_orderkey"), F.col("v")
    gen_cell = F.when((v == 6) & (ok % 2 == 0), ok + 1000000).otherwise(ok)
    gen_keep = F.col("gen_success") & ~((v == 5) & (ok % 3 == 0))
    sides = F.array(
        F.struct(F.lit("ref").alias("side"), ok.alias("cell"), F.col("ref_success").alias("keep")),
        F.struct(F.lit("gen").alias("side"), gen_cell.alias("cell"), gen_keep.alias("keep")),
    )
    kept = ["o_orderkey", "o_orderdate"] if with_date else []
    out = joined.select("sample_id", "gen_idx", *kept, F.inline(sides))
    return out.where("keep").drop("keep")


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user turn, next assistant turn) pairs of ``conversations`` as raw samples.

    An equi-join on (conv_id, turn + 1); the system turn, when present, is the
    context.
    """
    conv = read_table(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    s = conv.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("context"))
    pairs = u.join(a, ["conv_id", "turn"]).join(s, "conv_id", "left")
    return pairs.select("conv_id", "turn", "question", F.coalesce("context", F.lit("")).alias("context"), "answer")
