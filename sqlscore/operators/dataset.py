"""Dataset preparation: seeded shuffle, subset, exact split, slices (R1–R8),
prompt and chat formatting (P1–P6) and data-quality checks (V1–V5).

Order everywhere comes from ``md5(id:seed[:salt])`` — reproducible and
independent of partitioning, unlike ``rand(seed)``. Exact cuts, slices and single
rows come from counts (:mod:`sqlscore.operators.selection`); positions of all rows
from :mod:`sqlscore.operators.ranking`. Nothing is ranked in a single partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import preview, py_strip, truncate_long
from ..params import (
    CHATML_GENERATION_PROMPT, CHATML_MESSAGE, PROMPT_TEMPLATE, SYSTEM_PROMPT, XML_FORMAT_SUFFIX, DataParams,
)
from .ranking import hash_positions, seeded_hash
from .selection import hash_cut, hash_row, slice_rows, upto

SHUFFLE_SALT = ""
SPLIT_SALT = "split"


# ---- R1–R5: order, subset, split, slices ----------------------------------------

def seeded_shuffle(df: DataFrame, id_col: str, seed: int = 42, pos_col: str = "shuffle_pos") -> DataFrame:
    """0-based position of every row in the seeded shuffle order."""
    d = df.withColumn("_h", seeded_hash(id_col, seed, SHUFFLE_SALT))
    return hash_positions(d, "_h", id_col, pos_col).drop("_h")


def take_subset(df: DataFrame, id_col: str, n: int, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """R2: the first ``n`` rows of the (shuffled) source, all if there are no more.

    Shuffled, the cut is found in the counts of hash buckets, and one filter keeps the rows up to it.
    Without shuffle "first" means ascending ``id_col`` (source order).
    """
    if not shuffle:
        return holdout_slice(df, id_col, 0, n)
    if n <= 0:
        return df.limit(0)
    h = seeded_hash(id_col, seed, SHUFFLE_SALT)
    cut = hash_cut(df, id_col, h, n)
    return df if cut is None else upto(df, id_col, h, cut, "_keep").where("_keep").drop("_keep")


def split_sizes(n: int, test_fraction: float) -> tuple[int, int]:
    """(n_train, n_test) with ``n_test = ceil(n · fraction)`` in float arithmetic."""
    n_test = int(math.ceil(test_fraction * n))
    return n - n_test, n_test


def _n_test(test_fraction: float):
    return lambda total: split_sizes(total, test_fraction)[1]


def train_test_split(df: DataFrame, id_col: str, test_fraction: float, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Exact-size seeded split; adds ``split`` ('train' / 'test').

    The test rows are the first ``ceil(n·fraction)`` rows in a second salted
    hash order — sizes are exact, unlike ``randomSplit``. The cut comes from the counts of
    hash buckets, which also give the total; the split itself is one comparison per row.
    """
    h = seeded_hash(id_col, seed, SPLIT_SALT)
    cut = hash_cut(df, id_col, h, _n_test(test_fraction))
    if cut is None:
        return df.withColumn(split_col, F.lit("train"))
    return upto(df, id_col, h, cut, "_test").withColumn(split_col, F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")


def prepare_splits(df: DataFrame, id_col: str, params: DataParams = DataParams(),
                   split_col: str = "split") -> DataFrame:
    """S1 pipeline: optional shuffle → subset of train+test rows → exact split.

    ``df`` should be a table: its ids are read once for each level of the two cuts.
    """
    want = params.train_size + params.test_size
    sub = take_subset(df, id_col, want, params.seed, params.shuffle)
    return train_test_split(sub, id_col, params.test_size / want, params.seed, split_col)


def holdout_slice(df: DataFrame, order_col: str, start: int, end: int, pos_col: str | None = None) -> DataFrame:
    """Rows at positions [start, end) of source order (ascending ``order_col``).

    The boundary keys come from a histogram of the key; a range filter, which reaches the scan, does the rest.
    """
    return slice_rows(df, order_col, start, end, pos_col)


def cap_samples(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The first ``min(n, len)`` samples in source order."""
    return holdout_slice(df, order_col, 0, n)


def split_positions(df: DataFrame, id_col: str, seed: int = 42, split_col: str = "split",
                    pos_col: str = "index") -> DataFrame:
    """0-based index of every row inside its split (split hash order)."""
    return _positions_within(df, id_col, seed, split_col, pos_col)


def _positions_within(df: DataFrame, id_col: str, seed: int, split_col: str, pos_col: str) -> DataFrame:
    # Buckets are (split, hash prefix); offsets restart per split.
    h = seeded_hash(id_col, seed, SPLIT_SALT)
    d = df.withColumn("_h", h).withColumn("_hb", F.concat(F.col(split_col), F.lit("|"), F.substring(F.col("_h"), 1, 4)))
    counts = d.groupBy("_hb", split_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(split_col).orderBy("_hb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offs = counts.withColumn("_start", F.sum("_n").over(w) - F.col("_n")).drop("_n", split_col)
    wr = Window.partitionBy("_hb").orderBy(F.col("_h"), F.col(id_col))
    out = d.join(offs, "_hb").withColumn(pos_col, F.col("_start") + F.row_number().over(wr) - 1)
    return out.drop("_h", "_hb", "_start")


def _preview(row: DataFrame, max_chars: int) -> DataFrame:
    return row.select(*[truncate_long(F.col(f.name), max_chars).alias(f.name) if f.dataType.simpleString() == "string"
                        else F.col(f.name) for f in row.schema.fields])


def sample_preview(df: DataFrame, id_col: str, split: str, index: int, seed: int = 42,
                   split_col: str = "split", max_chars: int = 200) -> DataFrame:
    """The row at (split, index); strings over ``max_chars`` are cut with ``...``.

    Two passes over the ids (counts of hash buckets, then of the ids of one bucket) and one fetch by id.
    """
    rows = df.where(F.col(split_col) == split)
    return _preview(hash_row(rows, id_col, seeded_hash(id_col, seed, SPLIT_SALT), index), max_chars)


def split_preview(df: DataFrame, id_col: str, test_fraction: float, split: str, index: int, seed: int = 42,
                  split_col: str = "split", max_chars: int = 200) -> DataFrame:
    """R6 over a table that is not split yet: the row that :func:`train_test_split` would place at (split, index).

    The test rows lead the split order, so a train row's place in it is its index after them: no split is made.
    """
    n_test = _n_test(test_fraction)
    inside = {"test": lambda total: index if index < n_test(total) else total, "train": lambda total: n_test(total) + index}
    if split not in inside or index < 0:
        return _preview(df.limit(0).withColumn(split_col, F.lit(split)), max_chars)
    row = hash_row(df, id_col, seeded_hash(id_col, seed, SPLIT_SALT), inside[split])
    return _preview(row.withColumn(split_col, F.lit(split)), max_chars)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("num_rows"))


def split_accessor(df: DataFrame, split: str, split_col: str = "split") -> DataFrame:
    """One split by name (lazy: nothing runs until an action)."""
    return df.where(F.col(split_col) == F.lit(split))


# ---- P1–P6: formatting -----------------------------------------------------------

def _field(df: DataFrame, name: str) -> Column:
    """A text field, '' when the column is absent or NULL."""
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Fill ``{name}`` slots of a fixed template with columns (no re-scan of values)."""
    import re
    parts, last = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts.append(F.lit(template[last:m.start()]))
        parts.append(values[m.group(1)])
        last = m.end()
    parts.append(F.lit(template[last:]))
    return F.concat(*parts)


def build_prompt(df: DataFrame, template: str = PROMPT_TEMPLATE, keep: bool = True) -> DataFrame:
    """``prompt`` from question and context; keeps answer, context, original_question."""
    q, c, a = _field(df, "question"), _field(df, "context"), _field(df, "answer")
    cols = {"prompt": _fill(template, {"question": q, "context": c}), "answer": a, "context": c,
            "original_question": q}
    if not keep:
        return df.select(*[v.alias(k) for k, v in cols.items()])
    return df.withColumns(cols)


def system_prompt(context: Column, template: str = SYSTEM_PROMPT, use_xml_format: bool = False) -> Column:
    """P5 + schema fill: system prompt with ``{schema}`` filled from the context
    and, when the XML layout is on, the think/answer instructions appended."""
    tpl = template + (XML_FORMAT_SUFFIX if use_xml_format else "")
    head, sep, tail = tpl.partition("{schema}")
    return F.concat(F.lit(head), context, F.lit(tail)) if sep else F.lit(tpl)


def build_messages(df: DataFrame, template: str = SYSTEM_PROMPT, use_xml_format: bool = False,
                   messages_col: str = "messages") -> DataFrame:
    """``messages`` = [system, user, assistant]; an existing column wins."""
    if messages_col in df.columns:
        return df
    msg = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    sys = system_prompt(_field(df, "context"), template, use_xml_format)
    return df.withColumn(messages_col, F.array(msg("system", sys), msg("user", _field(df, "question")),
                                               msg("assistant", _field(df, "answer"))))


def render_messages(messages: Column, message_template: str = CHATML_MESSAGE,
                    generation_prompt: str | None = None) -> Column:
    """Chat array → one training text; optional generation prompt appended."""
    def one(m):
        return _fill(message_template, {"role": m["role"], "content": F.coalesce(m["content"], F.lit(""))})
    text = F.array_join(F.transform(messages, one), "")
    return F.concat(text, F.lit(generation_prompt)) if generation_prompt else text


def render_chat(df: DataFrame, messages_col: str = "messages", out: str = "text",
                message_template: str = CHATML_MESSAGE) -> DataFrame:
    """Training text from a chat array, no generation prompt."""
    return df.withColumn(out, render_messages(F.col(messages_col), message_template))


def chat_prompt(df: DataFrame, prompt_col: str = "prompt", template: str = SYSTEM_PROMPT,
                out: str = "input_text", message_template: str = CHATML_MESSAGE,
                generation_prompt: str = CHATML_GENERATION_PROMPT, context_col: str | None = "context",
                use_xml_format: bool = False) -> DataFrame:
    """System + user messages rendered with the generation prompt appended.

    The system template's ``{schema}`` is filled when a context column is given.
    """
    ctx = _field(df, context_col) if context_col else F.lit("{schema}")
    sys = system_prompt(ctx, template, use_xml_format)
    msgs = F.array(F.struct(F.lit("system").alias("role"), sys.alias("content")),
                   F.struct(F.lit("user").alias("role"), _field(df, prompt_col).alias("content")))
    return df.withColumn(out, render_messages(msgs, message_template, generation_prompt))


def previews(df: DataFrame, cols: dict[str, tuple[int, bool]]) -> DataFrame:
    """``{column: (n, ellipsis)}`` → ``<column>_preview`` columns."""
    return df.withColumns({f"{c}_preview": preview(F.col(c), n, e) for c, (n, e) in cols.items()})


# ---- V1–V5: checks ---------------------------------------------------------------

def required_columns(df: DataFrame, required=("prompt", "answer")) -> list[str]:
    """V1: names of required columns that are missing (schema only, no job)."""
    return [c for c in required if c not in df.columns]


def non_empty_fields(df: DataFrame, fields=("prompt", "answer"), first_only: bool = False,
                     order_col: str | None = None) -> DataFrame:
    """V2: rows whose fields are empty or blank, counted over all rows.

    ``first_only`` checks just the first row in ``order_col`` order.
    """
    d = df
    if first_only:
        if order_col is None:
            raise ValueError("first_only needs order_col")
        d = df.orderBy(order_col).limit(1)
    aggs = [F.count_if(F.coalesce(py_strip(F.col(f)), F.lit("")) == "").alias(f"empty_{f}") for f in fields]
    return d.agg(F.count(F.lit(1)).alias("num_rows"), *aggs)


def non_empty_dataset(df: DataFrame) -> DataFrame:
    """V3: one row with ``has_rows`` — reads at most one row."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def score_range_check(scored: DataFrame, score: str = "score", strict: bool = False) -> DataFrame:
    """V4: count of scores outside [−1, 1]; ``strict`` fails the job on the first one."""
    s = F.col(score)
    bad = ~s.between(-1.0, 1.0)
    if strict:
        # the check sits inside the counted expression so it cannot be pruned
        msg = F.concat(F.lit("score outside the range -1 to 1: "), s.cast("string"))
        bad = F.when(bad, F.coalesce(F.raise_error(msg).cast("boolean"), F.lit(True))).otherwise(F.lit(False))
    return scored.agg(F.count_if(bad).alias("out_of_range"), F.count(F.lit(1)).alias("num_scores"))


def ground_truth_pairs(df: DataFrame, answer: str = "answer", completion: str = "completion") -> DataFrame:
    """V5: pair every reference answer with itself (completion := answer)."""
    return df.withColumn(completion, F.col(answer))


def observed(df: DataFrame, name: str, fields=("prompt", "answer"), score: str | None = None, scored: str | None = None,
             split_col: str | None = None, splits=("train", "test")) -> tuple[DataFrame, Observation]:
    """V2–V4, C6 and R8 without a job of their own: metrics that are taken while ``df`` is written.

    Returns the same rows and the observation, whose ``get`` has the metrics once an action over the rows has ended:
    ``num_rows``, ``empty_<field>``; with ``score``: ``num_scores, out_of_range``, with ``scored`` too: ``call_count,
    total_reward``; with ``split_col``: ``rows_<split>``.
    """
    metrics = [F.count(F.lit(1)).alias("num_rows")]
    metrics += [F.count_if(F.coalesce(py_strip(F.col(f)), F.lit("")) == "").alias(f"empty_{f}") for f in fields]
    if score:
        metrics += [F.count(score).alias("num_scores"), F.count_if(~F.col(score).between(-1.0, 1.0)).alias("out_of_range")]
        if scored:
            metrics += [F.count_if(F.col(scored)).alias("call_count"),
                        F.coalesce(F.sum(F.when(F.col(scored), F.col(score))), F.lit(0.0)).alias("total_reward")]
    if split_col:
        metrics += [F.count_if(F.col(split_col) == s).alias(f"rows_{s}") for s in splits]
    seen = Observation(name)
    return df.observe(seen, *metrics), seen
