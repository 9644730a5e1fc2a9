"""Mix the sources of a corpus to target weights, exact to the word.

Every source gets a target number of words: its share, by weight, of a budget
that is a fixed part of all words; no target exceeds ``repeats`` times the
source, and what a full source cannot take is shared out again by weight.
Inside a source the documents stand in the order of a hash of their id. The
order is cut into ranges by the leading digits of the hash, the word counts of
the ranges are added up per source, and a running sum inside each range gives
every document its prefix sum. Whole epochs are taken while the target allows;
the last epoch is cut where the prefix sum meets the target, inside a document
if need be.

Scale: a range holds 1/4096 of a source, hot sources included; the table of
ranges has at most 4096 rows a source, the table of sources one row a source.
Nothing is sampled, no text is shuffled, each text is read once. The order depends on the ids only,
so reruns and retried tasks agree.

Cases: null text has size 0; the null source is a source of its own, ordered
last; a source without words has target 0; documents with equal ids are ordered
by size, and rows equal in both are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hinted

#: Weights of the sources in code point order, repeating; the budget as a fraction of all words.
WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)
REPEATS = 2
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(per_source: DataFrame, weights=WEIGHTS, budget=BUDGET, repeats: int = REPEATS) -> DataFrame:
    """Target words of every source: ``min(repeats * size, level * weight)`` with the sum of the budget.

    ``per_source``: one row a source with ``source`` and ``source_size``. With the sources
    ordered by size over weight, the full ones are a prefix; the first source that its share of
    the rest does not fill gives the level. All steps but the last division are exact.
    """
    num, den = budget
    dec = "decimal(38,0)"
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                                  F.lit(len(weights))) + 1).cast("int")).cast("long")
    s = per_source.withColumn("weight", weight)
    total = s.agg(F.sum("source_size").alias("_total"))  # one row
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.crossJoin(F.broadcast(total))
         .withColumn("_num", F.lit(num) * F.col("_total")
                     - F.lit(den * repeats) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("_den", F.lit(den) * F.sum("weight").over(onward))
         .withColumn("_open", F.col("_num").cast(dec) * F.col("weight")
                     <= (F.lit(repeats) * F.col("source_size")).cast(dec) * F.col("_den")))
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.when(F.col("_open"), F.struct("_num", "_den")), ignorenulls=True).over(upto)
    level = (F.col("_first._num") * F.col("weight")).cast("double") / F.col("_first._den").cast("double")
    full = (F.lit(repeats) * F.col("source_size")).cast("double")
    return (s.withColumn("_first", first)
            .select("source", "source_size", "weight",
                    F.when(F.col("_first").isNull(), full).otherwise(F.least(level, full)).alias("target")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, budget=BUDGET, repeats: int = REPEATS, digits: int = RANGE_DIGITS) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, epochs, last_words, taken``.

    ``epochs`` whole copies of the document and the first ``last_words`` words of one more
    make up its ``taken`` words of the mix.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        word_count(F.col(text_col)).alias("size"), key.alias("_key"))
    # read three times below: ids and numbers are written, so that the words of a text are counted once
    return prefix_cut(sized.checkpoint(), weights, budget, repeats, digits)


def prefix_cut(sized: DataFrame, weights=WEIGHTS, budget=BUDGET, repeats: int = REPEATS,
               digits: int = RANGE_DIGITS) -> DataFrame:
    """The mix of rows ``doc_id, source, size, _key`` (``_key``: hex digits, uniform)."""
    group = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = sized.withColumn("_group", group).withColumn("_range", F.substring("_key", 1, digits))
    ranges = rows.groupBy("_group", "_range").agg(F.first("source").alias("source"), F.sum("size").alias("_words"))
    per_source = ranges.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = (source_targets(per_source, weights, budget, repeats)
               .select(group.alias("_group"), "source_size", "target"))
    ahead = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.withColumn("_before", F.coalesce(F.sum("_words").over(ahead), F.lit(0)))
               .select("_group", "_range", "_before").join(targets, "_group"))
    inside = (Window.partitionBy("_group", "_range").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = rows.withColumn("_upto", F.sum("size").over(inside))
    words = F.floor("target").cast("long")
    some = F.col("source_size") > 0
    epochs = F.when(some, F.floor(words / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    prefix = F.col("_before") + F.col("_upto") - F.col("size")
    left = words - F.col("epochs") * F.col("source_size") - prefix
    return (running.join(offsets, ["_group", "_range"])
            .withColumn("epochs", epochs)
            .withColumn("last_words", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "epochs", "last_words",
                    (F.col("epochs") * F.col("size") + F.col("last_words")).alias("taken")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               shares: bool = False, **options) -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``epoch``; one row per copy taken.

    A last, partial copy keeps the words up to the cut with the blanks between them.
    Documents of which nothing is taken do not appear. Rows equal in (id, source, size) have a
    share each: they are numbered by their text, the shares by size. An added column replaces one of
    the same name. ``shares`` adds ``size,
    source_size, target, epochs, last_words`` of the document and ``taken``, the words of this copy.
    """
    extras = ["size", "source_size", "target", "epochs", "last_words"]
    alike = Window.partitionBy("doc_id", "source", "size")
    mix = (mix_sources(docs, id_col, text_col, source_col, **options)
           .withColumn("of", F.count("*").over(alike)).withColumn("nth", F.row_number().over(alike.orderBy(F.desc("taken")))))
    plan = mix.where("taken > 0").select(F.col("doc_id").alias("i"), F.col("source").alias("s"), "of", "nth", *extras).checkpoint()
    # the row travels as one column, so its names meet no name of the plan
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{id_col}`").alias("own_id"), F.col(f"`{source_col}`").cast("string").alias("own_source"),
                       word_count(F.col(f"`{text_col}`")).alias("own_size"))
    text = F.col("text")
    key = ["own_id", "own_source", "own_size"]
    on = F.col("own_id").eqNullSafe(F.col("i")) & F.col("own_source").eqNullSafe(F.col("s")) & (F.col("own_size") == F.col("size"))
    one = rows.join(plan.where("of = 1").drop("of", "nth"), on)
    # rows equal in the key: only they are numbered
    repeated = plan.where("of > 1")
    several = (rows.join(hinted(repeated.where("nth = 1").select("i", "s", "size")), on, "left_semi")
               .withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(text), text))))
    several = several.join(repeated, on & (F.col("number") == F.col("nth"))).drop("number", "of", "nth")
    copies = F.concat(F.when(F.col("epochs") > 0, F.sequence(F.lit(1), F.col("epochs").cast("int"))).otherwise(F.array().cast("array<int>")),
                      F.when(F.col("last_words") > 0, F.array((F.col("epochs") + 1).cast("int"))).otherwise(F.array().cast("array<int>")))
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))  # the words with the blanks before them
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("last_words").cast("int")), "")
    partial = (F.col("epoch") > F.col("epochs")) & (F.col("last_words") < F.col("size"))
    out = one.unionByName(several).withColumn("epoch", F.explode(copies))
    out = out.withColumns({"copy": F.when(partial, cut).otherwise(text), "taken": F.when(partial, F.col("last_words")).otherwise(F.col("size"))})
    added = ["epoch", *([*extras, "taken"] if shares else [])]
    kept = [F.col("copy").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in added]
    return out.select(*kept, *added)
