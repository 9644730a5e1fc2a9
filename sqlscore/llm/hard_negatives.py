"""Mine hard negatives among embeddings by coordinate pruning in length buckets.

Vectors become integers (``floor(scale * x)``), scores are integer inner products. The rows are dealt into
buckets of about equal length (norm); inside a bucket each coordinate has a list of the rows sorted by
its value in the unit vector. A search asks a bucket for the best rows of an anchor at or above a
score. With the longest row of the bucket that score is a smallest cosine; rows that reach it must have,
in each focus coordinate of the anchor (those where its unit vector is largest), a value inside a
feasible range around the anchor's. The ranges are found in the sorted lists, their rows are
intersected, and only rows inside all of them are scored exactly. A first look at the rows that lead the
list of the strongest coordinate raises the score that has to be reached.

Two searches follow each other: the positives of an anchor (best rows of its label), then, for the band of
scores that each positive allows, the best rows of other labels. Every bucket returns its own best few; the
best of all buckets follow by a ranking per anchor.

Scale: anchors are the stated query set, dealt into blocks; each pair of a bucket and an anchor block is one
task's unit of work of bounded size (``BUCKET_VALUES`` numbers, ``BLOCK_ANCHORS`` anchors), however the labels
or lengths are distributed: a class of lengths that holds most rows is cut into several buckets by a hash.
Work grows with anchors times rows, as the exact search must; what a bucket returns does not grow.

Cases: rows with a null label, a null id, a null vector, or a null or non-finite component take no part; vectors of
different sizes are filled up with zeros; components are limited to the range of a long. Scores are exact
integers; one outside the range of a long cannot be returned and is an error. Repeated rows are rows of
their own, an anchor never meets itself as a row but may meet its repetition; an anchor without a positive
or a positive without a negative has no row. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces

SCALE = 256
POSITIVES, NEGATIVES = 5, 10

#: Percent of a positive's score between which its negatives lie.
BAND = (30, 90)

#: Numbers in a bucket, anchors in a block, focus coordinates, rows of the first look.
BUCKET_VALUES, BLOCK_ANCHORS, FOCUS, FIRST_LOOK = 500_000, 2048, 4, 64

#: Classes of lengths: this many to a factor of two.
CLASSES = 4

#: Stands for a positive that an anchor does not have.
NO_SCORE = -(2 ** 63)


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` (array of long) of the rows that take part."""
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("_v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("_v").isNotNull())
            .where(F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf")))))
            .select("vec_id", "label", F.transform("_v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v")))


def matrix(rows: list[np.ndarray], size: int) -> np.ndarray:
    """Rows as one matrix, filled up with zeros: doubles where every inner product is exact in them, else whole numbers of any size."""
    out = np.zeros((len(rows), size), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which inner products of rows of ``a`` and ``b`` are exact."""
    if not a.size or not b.size:
        return float
    largest = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) * a.shape[1]
    return float if largest < 2 ** 53 else object


class Bucket:
    """Rows of about equal length with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, owns: np.ndarray, labels: np.ndarray, vectors: np.ndarray, kind: type = float):
        self.ids, self.owns, self.labels = ids, owns, labels
        self.exact = vectors.astype(kind)
        real = vectors.astype(float)
        norms = np.sqrt((real * real).sum(axis=1))
        self.longest, self.shortest = (norms.max(), norms.min()) if len(norms) else (0.0, 0.0)
        self.unit = real / np.where(norms > 0, norms, 1.0)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in the order of coordinate ``f``, and its values in that order."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact scores as integers, of some rows or of all."""
        s = (self.exact if rows is None else self.exact[rows]) @ anchor
        return s.astype(np.int64) if s.dtype != object else s

    def feasible(self, unit: np.ndarray, focus: np.ndarray, norm: float, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` or more (None: all of them may)."""
        length = self.longest if least > 0 else self.shortest
        if norm * length == 0:
            return np.empty(0, np.int64) if least > 0 else None
        cosine = least / (norm * length) - 1e-9
        if cosine > 1:
            return np.empty(0, np.int64)
        if cosine <= -1:
            return None
        aside = np.sqrt(max(0.0, 1 - cosine * cosine))
        ranges = []
        for f in focus:
            q = float(np.clip(unit[f], -1, 1))
            spread = aside * np.sqrt(max(0.0, 1 - q * q))
            low = -1.0 if -q >= cosine else q * cosine - spread
            high = 1.0 if q >= cosine else q * cosine + spread
            order, values = self.sorted_list(int(f))
            a, b = np.searchsorted(values, low - 1e-9), np.searchsorted(values, high + 1e-9, "right")
            ranges.append(order[a:b])
        ranges.sort(key=len)
        if len(ranges[0]) == len(self.ids):
            return None
        hits = np.zeros(len(self.ids), np.uint8)
        for r in ranges:
            hits[r] += 1
        return np.flatnonzero(hits == len(ranges))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best: higher score, then smaller id."""
    if len(scores) > 8 * k and scores.dtype != object:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def kth(scores: np.ndarray, k: int):
    """The ``k``-th best score, None if there are fewer."""
    return None if len(scores) < k else (sorted(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k])


def search(bucket: Bucket, anchor: np.ndarray, allowed: np.ndarray, bands: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per band (lowest or None, highest or None): rows and scores of the ``k`` best allowed rows of the bucket inside it."""
    real = anchor.astype(float)
    norm = float(np.sqrt((real * real).sum()))
    unit = real / (norm or 1.0)
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    look = np.empty(0, np.int64)
    if len(unit):
        order, _ = bucket.sorted_list(int(focus[0]))
        open_ = order[allowed[order]]
        look = open_[-FIRST_LOOK:] if unit[focus[0]] > 0 else open_[:FIRST_LOOK]
    seen = bucket.scores(anchor, look)
    least = []
    for low, high in bands:
        inside = seen if high is None else seen[seen <= high]
        reached = kth(inside, k)
        least.append(max((x for x in (low, reached) if x is not None), default=None))
    rows = None if any(x is None for x in least) else bucket.feasible(unit, focus, norm, float(min(least)))
    rows = np.flatnonzero(allowed) if rows is None else rows[allowed[rows]]
    scores = bucket.scores(anchor, rows) if 2 * len(rows) < len(bucket.ids) else bucket.scores(anchor)[rows]
    out = []
    for low, high in bands:
        keep = np.ones(len(rows), bool)
        if low is not None:
            keep &= (scores >= low).astype(bool)
        if high is not None:
            keep &= (scores <= high).astype(bool)
        at = np.flatnonzero(keep)
        top = at[best(scores[at], bucket.ids[rows[at]], k)]
        out.append((rows[top], scores[top]))
    return out


# ---- buckets and blocks as rows ----------------------------------------------------------

def _pack(pdf: pd.DataFrame, extra: tuple = ()) -> tuple:
    """Ids, row numbers, labels and vectors (in the smallest whole type that holds them) of some rows as one row."""
    m = matrix(list(pdf["v"]), max(map(len, pdf["v"]), default=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if not m.size or (m.min() >= np.iinfo(t).min and m.max() <= np.iinfo(t).max))
    return (*(pdf[c].to_numpy(np.int64).tobytes() for c in ("vec_id", "own", "label")), m.shape[1], kind, m.astype(kind).tobytes(), *extra)


def _unpack(row) -> tuple[np.ndarray, ...]:
    ids, owns, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "owns", "labels"))
    return ids, owns, labels, np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), row["size"]).astype(np.int64)


def _meeting(rows: pd.Series, block: pd.Series) -> tuple:
    """The bucket, and the anchors' ids, row numbers, labels and vectors in the bucket's type and size."""
    ids, owns, labels, vectors = _unpack(rows)
    *known, anchors = _unpack(block)
    size = max(vectors.shape[1], anchors.shape[1])
    vectors, anchors = (np.pad(m, ((0, 0), (0, size - m.shape[1]))) for m in (vectors, anchors))
    kind = exact_type(vectors, anchors)
    return Bucket(ids, owns, labels, vectors, kind), *known, anchors.astype(kind)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Layout:
    """Rows in length buckets and anchors in blocks; each block meets each bucket once."""

    PACKED = "ids binary, owns binary, labels binary, size int, kind string, vectors binary"

    def __init__(self, rows: DataFrame, is_anchor: Column, bucket_values: int, block_anchors: int):
        square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
        length = F.floor(F.log2(F.greatest(square, F.lit(1.0))) * F.lit(CLASSES / 2)).cast("int")
        # own: number of the row, fixed by the checkpoint
        kept = rows.withColumn("length", length).withColumn("own", F.monotonically_increasing_id()).checkpoint()
        classes = kept.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("size")).collect()  # one row a class of lengths
        cuts = {r["length"]: pieces(r["n"] * max(1, r["size"]), bucket_values) for r in classes}
        first = {k: sum(cuts[j] for j in cuts if j < k) for k in cuts}
        self.buckets = sum(cuts.values())
        self.anchors = kept.where(is_anchor)
        self.blocks = pieces(self.anchors.count(), block_anchors)
        pick = lambda of: F.element_at(F.create_map(*[F.lit(x) for kv in (of or {0: 0}).items() for x in kv]), F.col("length"))
        dealt = kept.withColumn("bucket", (pick(first) + F.pmod(F.xxhash64("own"), pick(cuts))).cast("long"))
        schema = f"bucket long, {self.PACKED}"

        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([(int(pdf["bucket"].iloc[0]), *_pack(pdf))], columns=_names(schema))
        self.rows = dealt.select("bucket", "vec_id", "own", "label", "v").groupBy("bucket").applyInPandas(pack, schema).checkpoint()

    def meet(self, anchors: DataFrame, ask, schema: str) -> DataFrame:
        """``ask(bucket, ids, owns, labels, vectors, asked)`` for each bucket and each block of ``anchors`` (with the column ``asked``)."""
        packed = f"block long, {self.PACKED}, asked binary"

        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            asked = np.concatenate(list(pdf["asked"])).astype(np.int64).tobytes()
            return pd.DataFrame([(int(pdf["block"].iloc[0]), *_pack(pdf, (asked,)))], columns=_names(packed))

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame(columns=_names(schema))
            bucket, ids, owns, labels, vectors = _meeting(left.iloc[0], right.iloc[0])
            asked = np.frombuffer(right["asked"].iloc[0], np.int64).reshape(len(ids), -1)
            return pd.DataFrame(ask(bucket, ids, owns, labels, vectors, asked), columns=_names(schema))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)).cast("array<long>"))
        blocks = (anchors.withColumn("block", F.pmod(F.xxhash64("own"), F.lit(self.blocks)))
                  .select("block", "vec_id", "own", "label", "v", "asked").groupBy("block").applyInPandas(pack, packed))
        key = ["bucket", "block"]
        return (self.rows.withColumn("block", every(self.blocks)).groupBy(*key)
                .cogroup(blocks.withColumn("bucket", every(self.buckets)).groupBy(*key)).applyInPandas(pair, schema))


def _ranked(found: DataFrame, keys: list[str], k: int, out_col: str) -> DataFrame:
    """The ``k`` best of each key; a key has at most ``k`` rows from each bucket."""
    best_first = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("vec_id"), F.asc("own"))
    return found.withColumn(out_col, F.row_number().over(best_first)).where(F.col(out_col) <= k)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
         bucket_values: int = BUCKET_VALUES, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Hard negatives of each anchor and positive.

    ``is_anchor`` is a condition over ``vec_id`` and ``label``. Returns ``anchor_id, positive_id, positive_rank, rank,
    negative_id, positive_score, negative_score``: the first ``negatives`` rows of other labels whose score lies
    between the percentages ``band`` of the positive's score, for each of the first ``positives`` rows of the anchor's label.
    """
    layout = Layout(integer_rows(vectors, id_col, vector_col, label_col, scale), is_anchor, bucket_values, block_anchors)
    low, high = band
    hit = "anchor long, asked_rank int, vec_id long, own long, score long"

    def find_positives(bucket, ids, owns, labels, vectors, asked):
        out = []
        for own, label, v in zip(owns, labels, vectors):
            allowed = (bucket.labels == label) & (bucket.owns != own)
            (rows, scores), = search(bucket, v, allowed, [(None, None)], positives)
            out += [(own, 0, bucket.ids[r], bucket.owns[r], s) for r, s in zip(rows, scores)]
        return out

    def find_negatives(bucket, ids, owns, labels, vectors, asked):
        out = []
        for own, label, v, wanted in zip(owns, labels, vectors, asked.tolist()):
            bands = {n: (-(-low * s // 100), high * s // 100) for n, s in enumerate(wanted, 1) if s != NO_SCORE}
            bands = {n: b for n, b in bands.items() if b[0] <= b[1]}
            if bands:
                found = search(bucket, v, bucket.labels != label, list(bands.values()), negatives)
                out += [(own, n, bucket.ids[r], bucket.owns[r], s) for n, (rows, scores) in zip(bands, found) for r, s in zip(rows, scores)]
        return out

    nothing = F.array(F.lit(NO_SCORE).cast("long"))
    near = layout.meet(layout.anchors.withColumn("asked", nothing), find_positives, hit)
    near = _ranked(near.drop("asked_rank"), ["anchor"], positives, "asked_rank").checkpoint()
    wanted = (near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("asked_rank", "score"))).alias("p"))  # at most ``positives`` rows
              .select(F.col("anchor").alias("own"), F.slice(F.concat(F.col("p.score"), F.array_repeat(nothing[0], positives)), 1, positives).alias("asked")))
    anchors = layout.anchors.join(wanted, "own")
    far = _ranked(layout.meet(anchors, find_negatives, hit), ["anchor", "asked_rank"], negatives, "rank")
    pairs = near.select("anchor", "asked_rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = layout.anchors.select(F.col("own").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (far.join(pairs, ["anchor", "asked_rank"]).join(names, "anchor")
            .select("anchor_id", "positive_id", F.col("asked_rank").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
