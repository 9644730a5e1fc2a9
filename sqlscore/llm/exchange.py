"""Messages between blocks of documents and buckets of keys (see ``common``).

Keys are mixed 64-bit hashes. The bucket of a key is monotonic in the key, so a
sorted key array splits into its buckets at a few positions, and each piece
travels as one binary value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, block_of, bucket_of, documents, pieces, text_bytes

#: Keys that one bucket answers for, about.
BUCKET_KEYS = 500_000


class Layout:
    """Documents dealt into blocks, and the number of buckets for about ``keys_per_byte`` keys."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, keys_per_byte: float, block_bytes: int = BLOCK_BYTES):
        d = documents(docs, id_col, text_col)
        total = text_bytes(d)
        self.blocks = pieces(total, block_bytes)
        self.buckets = pieces(int(total * keys_per_byte), BUCKET_KEYS)
        self.docs = d.withColumn("block", block_of(self.blocks, "doc_id"))

    def by_block(self):
        return self.docs.groupBy("block")


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values."""
    if not len(sorted_keys):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def split_buckets(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of the non-empty buckets of a sorted key array."""
    b = bucket_of(sorted_keys, buckets)
    at = runs(b)
    for lo, hi in zip(at, np.append(at[1:], len(b))):
        yield int(b[lo]), slice(int(lo), int(hi))


def low32(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4")


# ---- which keys occur in several documents ---------------------------------------------

ASK = "bucket int, block int, keys binary"
SHARED = "block int, bucket int, keys binary, weight binary"


def ask_shared(keys: np.ndarray, owner: np.ndarray, block: int, buckets: int) -> pd.DataFrame:
    """One message a bucket with the block's distinct keys; a key of several owners stands twice.

    Inside its bucket a key is told by its lower 32 bits: among ``BUCKET_KEYS`` keys about one
    in ten thousand meets a stranger and is taken as shared without being so. Users of the
    answer only lose a little pruning by that; they compare full keys later.
    """
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    at = runs(keys)
    many = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at) if len(at) else np.empty(0, bool)
    keys = np.repeat(keys[at], 1 + many)
    rows = [(b, block, low32(keys[s]).tobytes()) for b, s in split_buckets(keys, buckets)]
    return pd.DataFrame(rows, columns=["bucket", "block", "keys"])


def answer_shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """To every block of the bucket: those of its keys that occur twice or more, and log2 of how often."""
    sent = [np.frombuffer(k, "<u4") for k in pdf["keys"]]
    values, inverse, count = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    weight = np.minimum(np.log2(np.maximum(count, 1)), 255).astype(np.uint8)
    bucket, rows, at = int(pdf["bucket"].iloc[0]), [], 0
    for block, own in zip(pdf["block"], sent):
        codes = np.unique(inverse[at:at + len(own)])
        at += len(own)
        codes = codes[count[codes] > 1]
        if len(codes):
            rows.append((block, bucket, values[codes].astype("<u4").tobytes(), weight[codes].tobytes()))
    return pd.DataFrame(rows, columns=["block", "bucket", "keys", "weight"])


def shared_keys(layout: Layout, ask) -> DataFrame:
    """Answers per block: the keys found by ``ask(block rows) -> (keys, owners)`` that several documents hold."""
    buckets = layout.buckets

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, owner = ask(pdf)
        return ask_shared(keys, owner, int(pdf["block"].iloc[0]), buckets)
    asked = layout.by_block().applyInPandas(send, ASK)
    return asked.groupBy("bucket").applyInPandas(answer_shared, SHARED)


class SharedLookup:
    """The answers that one block got: ``weights(keys)`` is 0 for keys that are not shared, else 1 + log2 of the count."""

    def __init__(self, answers: pd.DataFrame, buckets: int):
        self.buckets = buckets
        parts = [(np.uint64(b) << np.uint64(32)) | np.frombuffer(k, "<u4").astype(np.uint64)
                 for b, k in zip(answers["bucket"], answers["keys"])]
        keys = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        weight = np.concatenate([np.frombuffer(w, np.uint8) for w in answers["weight"]]) if parts else np.empty(0, np.uint8)
        order = np.argsort(keys, kind="stable")
        self.keys, self.weight = keys[order], weight[order]

    def weights(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.uint8)
        short = (bucket_of(keys, self.buckets) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        at = np.minimum(np.searchsorted(self.keys, short), len(self.keys) - 1)
        return np.where(self.keys[at] == short, np.minimum(self.weight[at], 254) + 1, 0).astype(np.uint8)
