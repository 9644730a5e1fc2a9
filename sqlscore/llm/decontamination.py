"""Benchmark decontamination: SimHash of item-sized windows, verified by weighted shingles.

DataFrame and SQL functions only.

Words are the runs of letters and digits of the lower-cased text; a shingle is
``SHINGLE`` consecutive words. A window of a document has as many words as the
benchmark item it is held against. Item and window match when the weighted
Jaccard similarity of their shingles, ``sum min(counts) / sum max(counts)``, is at
least ``THRESHOLD``. A document leaks an item if one of its windows matches.

1. *Places.* The shingles of the documents are joined with the distinct shingles of all items
   together; no pair of document and item is formed. Similarity ``t`` of a window of ``w`` and an
   item of ``n`` shingles needs ``t (w + n) / (1 + t)`` common ones, and moving a window to the right
   until its first shingle is one of the items' loses none. So of the windows of each item size those
   go on that start at such a shingle (or at the last possible place) and hold enough of them:
   an exact condition, no match is lost.
2. *SimHash.* Each such window and each item gets a 64-bit SimHash (a bit is set if more than half
   of the shingles have it). A document is cut into overlapping chunks; sums of the bits from the start
   of the chunk, two counters in a long, give the fingerprint of any window by one subtraction.
3. *Index.* Fingerprints are cut into ``BLOCKS`` blocks of 8 bits; within Hamming radius ``RADIUS`` =
   8 * 3 - 1 some block differs in at most two bits, so all items are entered under their size and every
   block value with up to two bits flipped, and the distinct fingerprints of the windows look up their own
   block values: every item within the radius is found. At similarity 0.8 the expected distance is
   10 bits with a deviation of 3, so the radius stands 4 deviations away.
4. *Verification.* The exact weighted similarity of the (window, item) pairs that the index found.

Scale: one pass over the documents that joins shingles with the items' shingles; these are
broadcast only if counted and below ``BROADCAST_ROWS``, else shuffled. After it the data are the
places of item shingles, at most one window a place and item size. Chunks are as long as the longest item, so
no row grows with the length of a document. A passage that a third of all documents hold has its windows in each of
them, but asks the index once.

Cases: null and empty texts, and texts or items of fewer than ``SHINGLE`` words, have no
shingles and match nothing; a document is a (id, text), repeated rows count once, and rows
with equal ids but different texts leak what one of them leaks; equal items are reported each; null ids take part like others.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, hinted, own_name, restore_id

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
BLOCKS = 8
FLIPS = 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Shortest step between the chunks of a document, in shingles (else the longest item).
STRIDE = 64
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column, width: int = SHINGLE) -> Column:
    """Hashes of the runs of ``width`` words, in order (empty if there are fewer words)."""
    first = F.sequence(F.lit(1), F.size(w) - F.lit(width - 1))
    some = F.size(w) >= width
    one = F.transform(F.when(some, first).otherwise(F.array().cast("array<int>")),
                      lambda i: F.xxhash64(*[F.get(w, i + F.lit(k - 1)) for k in range(width)]))
    return one


def _gram_arrays(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    return (df.select(*keys, words(F.col("text")).alias("_w"))
            .select(*keys, shingles(F.col("_w"), width).alias("_g")))


def _grams(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``keys, pos, gram, n_grams``: one row a shingle.

    The outer form of explode: for the inner one the optimizer adds a filter on the array's size
    below the projections and so puts the word splitting into the lambda, once per word.
    """
    return (_gram_arrays(df, keys, width).select(*keys, F.size("_g").alias("n_grams"), F.posexplode_outer("_g").alias("pos", "gram"))
            .where("gram is not null"))


def simhash(grams: DataFrame, keys: list[str]) -> DataFrame:
    """64-bit SimHash ``fp`` of the rows ``keys, gram`` (each row counts once)."""
    bit = [F.sum(F.when(F.shiftrightunsigned("gram", b).bitwiseAND(F.lit(1)) == 1, 1).otherwise(-1)) for b in range(BITS)]
    sums = grams.groupBy(*keys).agg(*[b.alias(f"_b{i}") for i, b in enumerate(bit)])
    fp = F.lit(0).cast("long")
    for i in range(BITS):
        fp = fp.bitwiseOR(F.when(F.col(f"_b{i}") > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def _block(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255)).cast("int")


def _masks() -> list[int]:
    return [0] + [sum(1 << b for b in c) for n in range(1, FLIPS + 1) for c in combinations(range(8), n)]


def within_radius(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], small: bool = False) -> DataFrame:
    """All pairs of ``left`` and ``right`` rows whose fingerprints differ in at most ``RADIUS`` bits.

    Multi-index over the blocks: ``right`` (the small side) is entered under every block value
    with up to ``FLIPS`` bits flipped; each pair is found at least once and reported once. Columns that
    both key lists name are equal in a pair. ``small``: the entries were counted and may be broadcast.
    """
    masks = _masks()
    blocks = F.array(*[F.struct(F.lit(k).alias("k"), _block(F.col("fp"), k).alias("v")) for k in range(BLOCKS)])
    index = (right.select(*right_keys, F.col("fp").alias("_fp"), F.explode(blocks).alias("_e"))
             .select(*right_keys, "_fp", F.col("_e.k").alias("_k"),
                     F.explode(F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: F.col("_e.v").bitwiseXOR(m))).alias("_v")))
    probe = left.select(*left_keys, "fp", F.explode(blocks).alias("_e")).select(*left_keys, "fp", F.col("_e.k").alias("_k"), F.col("_e.v").alias("_v"))
    shared = [c for c in left_keys if c in right_keys]  # also equal on these
    found = probe.join(F.broadcast(index) if small else index, ["_k", "_v"] + shared)
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("_fp")))
    keys = list(dict.fromkeys(left_keys + right_keys))
    return (found.where(distance <= RADIUS).groupBy(*keys).agg(F.min(distance).alias("distance")))


def _starts(threshold: float, stride: int) -> Column:
    """Starts of the windows of ``n`` shingles in a chunk that can match; ``places`` are the sorted positions of item shingles."""
    need = F.greatest(F.lit(1), F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("w") + F.col("n")) - 1e-9).cast("int"))
    base, last = F.col("chunk") * stride, F.col("n_grams") - F.col("w")
    inner = F.filter("places", lambda x, i: (x >= base) & (x < base + stride) & (x <= last)
                     & (F.get("places", i + need - 1) < x + F.col("w")))
    ends = (last >= base) & (last < base + stride) & (F.get("places", F.size("places") - need) >= last)
    return F.array_union(inner, F.when(ends, F.array(last)).otherwise(F.array().cast("array<int>")))


def candidate_windows(places: DataFrame, sizes: DataFrame, keys: list[str], threshold: float, stride: int) -> DataFrame:
    """``keys, chunk, n, w, starts``: windows of each item size ``n`` that hold enough shingles of items.

    ``places``: ``keys, pos, n_grams``, a row for each position of an item shingle; ``sizes``: one row with the array
    ``sizes``, all at most ``stride``. A chunk reaches over the next one; windows belong to the chunk they start in.
    """
    k = F.floor(F.col("pos") / stride).cast("int")
    chunked = (places.select(*keys, "n_grams", "pos", F.explode(F.array(k, k - 1)).alias("chunk")).where("chunk >= 0")
               .groupBy(*keys, "n_grams", "chunk").agg(F.sort_array(F.collect_set("pos")).alias("places")))
    sized = (chunked.crossJoin(F.broadcast(sizes))  # one row
             .select(*keys, "n_grams", "chunk", "places", F.explode_outer("sizes").alias("n"))
             .withColumn("w", F.least("n", "n_grams")))
    return sized.select(*keys, "chunk", "n", "w", _starts(threshold, stride).alias("starts")).where(F.size("starts") > 0)


def _window_fp(upto: Column, before: Column, w: Column) -> Column:
    """SimHash of a window of ``w`` shingles from the counters up to its end and before its start.

    Counter j holds the bits j and 32 + j in its halves: ``2 * count - w - 1`` is not negative, so the bit
    2**30 added to it stands, if more than half of the shingles have the bit.
    """
    ones, bias = 2 ** 32 + 1, 2 ** 30 * (2 ** 32 + 1)
    fp = F.lit(0).cast("long")
    for j in range(BITS // 2):
        count = upto[f"s{j}"] - F.coalesce(before[f"s{j}"], F.lit(0).cast("long"))
        over = (F.lit(bias) + count * 2 - (w.cast("long") + 1) * F.lit(ones)).bitwiseAND(F.lit(bias))
        fp = fp.bitwiseOR(F.shiftrightunsigned(over, 30 - j) if j <= 30 else F.shiftleft(over, 1))
    return fp


def window_fingerprints(cells: DataFrame, windows: DataFrame, keys: list[str], stride: int) -> DataFrame:
    """``keys, chunk, start, n, w, fp`` of the ``windows``; ``cells``: ``keys, chunk, pos, gram``, all shingles of their chunks."""
    upto = Window.partitionBy(*keys, "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bits = [F.sum(F.shiftrightunsigned("gram", j).bitwiseAND(F.lit(2 ** 32 + 1))).over(upto).alias(f"s{j}") for j in range(BITS // 2)]
    sums = (cells.select(*keys, "chunk", "pos", *bits).groupBy(*keys, "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("pos", *[f"s{j}" for j in range(BITS // 2)]))).alias("sums")))
    at = lambda s: s - F.col("chunk") * stride
    ends = F.transform("starts", lambda s: F.struct(s.alias("start"), F.get("sums", at(s) + F.col("w") - 1).alias("upto"),
                                                    F.get("sums", at(s) - 1).alias("before")))
    found = sums.join(windows, keys + ["chunk"]).select(*keys, "chunk", "n", "w", F.explode_outer(ends).alias("e"))
    return found.select(*keys, "chunk", F.col("e.start").alias("start"), "n", "w", _window_fp(F.col("e.upto"), F.col("e.before"), F.col("w")).alias("fp"))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
               width: int = SHINGLE) -> DataFrame:
    """One row per (document, item) that leaks: ``doc_id, item_id, similarity, start, end, distance``.

    ``start`` and ``end`` bound the best window in words (end excluded; the earliest of equals),
    ``distance`` is the Hamming distance of the fingerprints.
    """
    bench = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    bench = bench.withColumn("item", F.xxhash64("text"))  # equal texts are matched once
    grams = _grams(bench.dropDuplicates(["item"]).select("item", "text"), ["item"], width)
    per_item = grams.groupBy("item", "gram", "n_grams").agg(F.count("*").alias("in_item")).checkpoint()
    few_items = per_item.count() <= BROADCAST_ROWS
    item_fp = simhash(grams.withColumnRenamed("n_grams", "n"), ["item", "n"]).checkpoint()
    few_entries = item_fp.count() * BLOCKS * len(_masks()) <= BROADCAST_ROWS
    stride = max(STRIDE, item_fp.agg(F.max("n")).first()[0] or 0)

    def hint(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few_items else df  # counted: at most BROADCAST_ROWS rows of longs

    # places of item shingles in documents: the only rows that leave the scan
    doc = ["doc_id", "sig"]
    text = documents(docs, id_col, text_col).withColumn("sig", F.xxhash64("text"))
    places = _grams(text, doc, width).join(hint(per_item.select("gram").distinct()), "gram").select(*doc, "pos", "n_grams")
    sizes = item_fp.agg(F.collect_set("n").alias("sizes"))
    windows = candidate_windows(places, sizes, doc, threshold, stride).checkpoint()

    # all shingles of the chunks that have windows
    chunks = windows.select(*doc, "chunk").distinct().checkpoint()
    own = text.join(hinted(chunks.select(*doc).distinct().checkpoint()), doc, "left_semi").dropDuplicates(doc)
    k = F.floor(F.col("pos") / stride).cast("int")
    cells = (_grams(own, doc, width).select(*doc, "pos", "gram", F.explode(F.array(k, k - 1)).alias("chunk"))
             .join(hinted(chunks), doc + ["chunk"]).checkpoint())

    # SimHash, and the index of all items: each distinct fingerprint asks once
    prints = window_fingerprints(cells, windows, doc, stride).checkpoint()
    asked = prints.select("n", "fp").distinct().withColumn("print", F.col("fp"))
    near = (within_radius(asked, item_fp, ["n", "print"], ["n", "item"], few_entries)
            .select("n", F.col("print").alias("fp"), "item", "distance").checkpoint())
    found = prints.join(hinted(near), ["n", "fp"]).drop("fp")

    # exact weighted similarity
    window = [*doc, "item", "start", "n", "distance"]
    inside = (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + F.col("w"))
    counted = found.join(cells, doc + ["chunk"]).where(inside).groupBy(*window, "gram").agg(F.count("*").alias("in_window"))
    sides = (counted.join(hint(per_item.select("item", "gram", "in_item")), ["item", "gram"], "left").groupBy(*window)
             .agg(F.sum("in_window").alias("_w"), F.sum(F.least("in_window", F.coalesce("in_item", F.lit(0)))).alias("_both")))
    exact = sides.withColumn("similarity", F.col("_both") / (F.col("_w") + F.col("n") - F.col("_both")))
    best = (exact.where(F.col("similarity") >= threshold)
            .groupBy("doc_id", "item")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("_s"), F.col("_w"), "distance")).alias("_b")))
    out = best.select("doc_id", "item", F.col("_b.similarity").alias("similarity"), (-F.col("_b._s")).cast("long").alias("start"),
                      (-F.col("_b._s") + F.col("_b._w") + F.lit(width - 1)).cast("long").alias("end"),
                      F.col("_b.distance").cast("int").alias("distance"))
    names = bench.select("item_id", "item")
    return restore_id(out.join(names, "item").select("doc_id", "item_id", "similarity", "start", "end", "distance"))


def drop_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that leak no item, all columns unchanged (rows with a leaking id go together)."""
    mark = own_name(docs, "leak")
    leaks = find_leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias(mark)).distinct().checkpoint()
    return docs.join(hinted(leaks), F.col(id_col).eqNullSafe(F.col(mark)), "left_anti")
