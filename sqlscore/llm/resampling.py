"""Importance resampling towards a target distribution, over hashed n-gram features.

A feature is a run of 1 to ``max_run`` consecutive words; its bucket is the CRC-32 of its bytes modulo
``buckets``. The vocabulary has a head and a tail. The head are the words that make up at least
1/``HEAD`` of all words, found by an exact count, and the pairs of such words that do so: their CRC
states are computed once and broadcast. All other features (the tail) take the CRC of their bytes, a run
going on from the state of its prefix. Both feed the exact bucket totals of the corpus and of the
target, and the totals give each bucket a gain: the scaled log ratio of its smoothed shares. A document
weighs the sum of the gains of its features; a seeded Gumbel number per id turns the highest scores into
a draw without replacement.

Scale: four passes over the texts, none of which shuffles text. The count of words is combined in the
task before its shuffle; the head has at most ``HEAD`` words of at most ``HEAD_BYTES`` bytes and as
many pairs, whatever the corpus; totals and gains have one number a bucket. The draw sorts ids and
numbers by ranges; a document's rank is its place in its range plus the rows of the ranges before.

Cases: null texts have no words; a document without features weighs 0; ties in the score go to the
smaller id (null first); repeated rows are drawn one by one; an empty target or corpus gives totals of 0,
which the smoothing allows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import exact_positions

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

#: A head word is at least one in this many words; a longer one stays in the tail.
HEAD, HEAD_BYTES = 50_000, 64

#: Words (pairs) that a task counts before it hands the counts on.
COUNTED = 400_000

#: Bytes to lower-cased letters, digits and bytes of other scripts; all else separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class Head(dict):
    """CRC state of a word: looked up for head words, computed for others."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class Features:
    """CRC states of all features of a text."""

    def __init__(self, words: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int], max_run: int = 1):
        self.words, self.pairs, self.max_run = words, pairs, max_run
        self.state = Head(words)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        state = list(map(self.state.__getitem__, words))
        parts = [np.array(state, np.uint32)]
        for run in range(2, min(self.max_run, len(words)) + 1):
            if run == 2 and self.pairs:
                known = map(self.pairs.get, zip(words, words[1:]))
                state = [crc32(b" " + w, s) if k is None else k for k, w, s in zip(known, words[1:], state)]
            else:
                state = [crc32(b" " + w, s) for w, s in zip(words[run - 1:], state)]
            parts.append(np.array(state, np.uint32))
        return np.concatenate(parts)


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _counted(texts: DataFrame, keys_of) -> DataFrame:
    """Exact count of each key that ``keys_of(words)`` lists, as ``key, n``."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(keys_of(words_of(text)))
                if len(counts) > COUNTED:
                    yield pd.DataFrame({"key": list(counts.keys()), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"key": pd.Series(counts.keys(), dtype=object), "n": pd.Series(counts.values(), dtype="int64")})
    return texts.mapInPandas(count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def find_head(docs: DataFrame, text_col: str = "text", max_run: int = 1, head: int = HEAD) -> Features:
    """The features of a corpus, with its frequent words and pairs known: at most ``head`` of each."""
    texts = _texts(docs, text_col)
    counts = _counted(texts, lambda words: words).checkpoint()
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * head >= total
    rows = counts.where(often & (F.length("key") <= HEAD_BYTES)).select("key").toLocalIterator()  # at most ``head`` rows
    words = {(w := bytes(r["key"])): crc32(w) for r in rows}
    pairs: dict[tuple[bytes, bytes], int] = {}
    if max_run > 1:
        def both_known(ws: list[bytes]) -> list[bytes]:
            return [a + b" " + b for a, b in zip(ws, ws[1:]) if a in words and b in words]
        for r in _counted(texts, both_known).where(often).select("key").toLocalIterator():  # at most ``head`` rows
            a, b = bytes(r["key"]).split(b" ")
            pairs[a, b] = crc32(b" " + b, words[a])
    return Features(words, pairs, max_run)


def bucket_totals(df: DataFrame, features: Features, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket."""
    known = df.sparkSession.sparkContext.broadcast((features.words, features.pairs, features.max_run))

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, sums = Features(*known.value), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                sums += np.bincount(of(words_of(text)) % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": at, "n": sums[at]})
    out = np.zeros(buckets, np.int64)
    for r in _texts(df, text_col).mapInPandas(total, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # one row a bucket
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: float = 1000.0) -> np.ndarray:
    """Per bucket: the floor of the scaled log ratio of its smoothed shares in the target and in the source."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([floor(scale * log((float(t) + 1.0) * (s_all + n) / ((float(s) + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(id_col: str, seed: int = SEED, scale: float = 1000.0):
    """Scaled Gumbel number of an id, rounded down: the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-scale) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    target_col: str = "text", max_run: int = 1, buckets: int = BUCKETS, head: int = HEAD) -> DataFrame:
    """Per document: ``doc_id, n_words, n_features, weight``; higher weights look more like the target."""
    features = find_head(docs, text_col, max_run, head)
    gains = bucket_gains(bucket_totals(docs, features, text_col, buckets),
                         bucket_totals(target, features, target_col, buckets))
    known = docs.sparkSession.sparkContext.broadcast(((features.words, features.pairs, features.max_run), gains))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, gain = Features(*known.value[0]), known.value[1]
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                crcs = of(words)
                rows.append((len(words), len(crcs), int(gain[crcs % np.uint32(len(gain))].sum())))
            numbers = pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype="int64")
            yield pd.concat([batch[["doc_id"]].astype("Int64").reset_index(drop=True), numbers], axis=1)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Adds ``score`` and ``rank``: 1, 2, 3... for the drawn ``percent`` of the documents with ``min_words`` words, else null."""
    scored = weighed.withColumn("score", F.col("weight") + gumbel("doc_id", seed)).checkpoint()  # read twice below: numbers only
    enough = F.col("n_words") >= min_words
    wanted = scored.where(enough).count() * percent // 100
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    placed = exact_positions(scored, order, "_at")
    return placed.withColumn("rank", F.when(F.col("_at") < wanted, F.col("_at") + 1)).drop("_at")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             **options) -> DataFrame:
    """Every document with ``n_words, n_features, weight, score`` and, if it is drawn, ``rank``."""
    return draw(weigh_documents(docs, target, **options), percent, min_words, seed)
