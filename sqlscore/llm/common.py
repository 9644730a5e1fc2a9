"""Helpers shared by the training-data operators.

Conventions of every operator in this package:

* only the named id and text columns of the input are read, by name, so other
  columns (also ones named like an output column) never clash;
* a null text counts as the empty text; a null id is kept as a row of its own
  and is ordered as smaller than every other id;
* repeated rows are separate rows: the same row twice gives the same result twice;
* an empty table gives an empty result with the same schema.

*Blocks.* Operators that need whole documents together with corpus statistics
deal the documents into blocks of about ``BLOCK_BYTES`` of text by a hash of the
id. A block sends one message per bucket of the key space (sorted, distinct
keys, packed into one binary value), a bucket answers every block that asked,
and the answers meet the block's documents again. The number of blocks and of
buckets follows the size of the corpus, so the memory of a task does not grow,
and a key held by a third of all documents costs its bucket one entry per block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One word: no blank among space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes of one block (a task of a block operator holds one block at a time).
BLOCK_BYTES = 4_000_000

MIN_ID = -(2 ** 63)

#: A list of ids is broadcast if it was counted and has at most this many rows.
BROADCAST_ROWS = 500_000


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, without nulls: ``doc_id`` (null: ``MIN_ID``) and ``text`` (null: empty)."""
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias("doc_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def restore_id(df: DataFrame) -> DataFrame:
    """Turn the stand-in of :func:`documents` back into a null id."""
    return df.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(MIN_ID), F.col("doc_id")))


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts: one aggregate over one column, one number to the driver."""
    return int(df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0)


def pieces(total: int, each: int) -> int:
    """How many pieces of about ``each`` make up ``total`` (at least one)."""
    return max(1, -(-total // each))


def block_of(n: int, *keys: str) -> Column:
    """Block number 0..n-1 by a hash of the keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def salted_crc(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: crc32 of the empty text)."""
    name = F.when(F.col(id_col) != F.lit(MIN_ID), F.col(id_col).cast("string"))
    return F.pmod(F.crc32(F.coalesce(name, F.lit("")).cast("binary")), F.lit(modulus))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all others (uint64 in, uint64 out)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_sums(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every run of ``width`` consecutive values (modulo 2**64, mixed)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    b = np.uint64(base | 1)
    acc = h[:n].copy()
    for k in range(1, width):
        acc *= b
        acc += h[k:k + n]
    return mix64(acc)


def split_words(texts: list[str], fold: bool = False) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in order, and the word count of each text.

    ``bytes.split`` separates at exactly the blanks of :data:`WORD`; ``fold`` lower-cases A-Z only.
    """
    words: list[bytes] = []
    counts = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass")
        w = (b.lower() if fold else b).split()
        counts[i] = len(w)
        words += w
    return words, counts


def hash_words(words: list[bytes]) -> np.ndarray:
    """128-bit hashes of the words as two uint64 columns; each distinct word is hashed once."""
    import xxhash
    codes: dict[bytes, int] = {}
    at = codes.setdefault
    idx = np.fromiter((at(w, len(codes)) for w in words), np.int64, len(words))
    raw = b"".join(map(xxhash.xxh3_128_digest, codes))
    table = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return table[idx] if len(words) else np.empty((0, 2), np.uint64)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 from the upper 32 bits of a mixed hash."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def hinted(ids: DataFrame) -> DataFrame:
    """Broadcast a materialised list of ids if it has at most ``BROADCAST_ROWS`` rows, counted; else leave it to the planner."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def own_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
