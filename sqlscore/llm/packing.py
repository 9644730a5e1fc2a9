"""Pack documents into training sequences by minimum bin slack.

Every document becomes its token ids and a closing id. What is longer than a window is cut into
whole windows; the rest, shorter than a window, waits in a pool of lengths. A window takes the
longest waiting piece and, from the multiset of the other lengths, the one whose sum comes closest to
what is left: a bitset holds the sums that can be reached (bit s: sum s), one stage a distinct
length, and the stages are walked back for how many pieces of each length make up the best sum. What
slack remains is filled with the head of the shortest piece left over, so windows are full. The last
pieces of a partition go into sequences of a power of two, which need no padding.

Scale: each partition of the input is packed as it stands, so nothing is shuffled, no key can be hot
and a retried task packs the same rows again. A task holds at most ``POOL_TOKENS`` waiting ids and the
batch it reads. Sequences are numbered inside their partition, the partition in the upper bits.

Token ids: those of ``tokenizers`` for the given file, special tokens spelled in a text included. Texts
of the characters ``PLAIN`` are encoded with the same vocabulary as ranks, several times faster: both
libraries put these characters into the same classes (a test compares each one) and merge in the same
order. All other texts, and texts with very long runs without a break, go through ``tokenizers``.

Cases: null and empty texts are one closing id; a null id is kept; a repeated row is packed again, with a
``row_id`` of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids of a sequence, and the id that closes a document.
CAPACITY = 2048
END_ID = 1

#: Waiting ids at which windows are filled; filling stops at half of it.
POOL_TOKENS = 1 << 20

#: Files of the public vocabulary: for ``tokenizers``, and the same as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

#: Characters of one class in both libraries: Latin, Greek, Cyrillic, dashes and quotes, kana, common ideographs, Hangul.
PLAIN = "\u0000-ͯΆ-ϿЀ-ԯ‐-‧‰-‾€、-〃ぁ-ゖァ-ヺ一-龥가-힣！-／"
#: A text that must go through ``tokenizers``: another character, or a run of this many without a break.
_SLOW = re.compile(rf"[^{PLAIN}]|\S{{1500}}|\s{{1500}}")

PIECES = ("doc_id long, row_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long")


class Encoder:
    """Token ids of texts as ``uint32`` arrays, without the closing id."""

    def __init__(self, tokenizer: str | None = None, ranks: str | None = None):
        from tokenizers import Tokenizer
        if tokenizer is None:
            import public_tokenizers
            tokenizer, ranks = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
        self.exact = Tokenizer.from_file(tokenizer)
        self.quick = None
        if ranks is not None:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                           special_tokens=special)

    def exact_ids(self, text: str) -> np.ndarray:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def quick_ids(self, text: str) -> np.ndarray:
        return np.asarray(self.quick.encode_to_numpy(text, allowed_special="all"), np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        if self.quick is None or _SLOW.search(text):
            return self.exact_ids(text)
        return self.quick_ids(text)


def best_fill(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """(length, how many) of the sub-multiset of ``counts`` whose sum comes closest to ``capacity`` from below."""
    reach, whole, stages = 1, (1 << capacity + 1) - 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        stages.append((length, reach))
        many, part = min(counts[length], capacity // length), 1
        while many:
            take = min(part, many)
            reach |= reach << take * length & whole
            many -= take
            part *= 2
        if reach >> capacity & 1:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(stages):
        n = 0
        while not before >> left & 1:
            left -= length
            n += 1
        if n:
            chosen.append((length, n))
    return chosen


class Pool:
    """Pieces that wait for a window, by length. A piece is (document, start); a document any object."""

    def __init__(self):
        self.waiting: dict[int, list[tuple]] = {}
        self.total = 0

    def add(self, document, start: int, length: int) -> None:
        if length:
            self.waiting.setdefault(length, []).append((document, start))
            self.total += length

    def take(self, length: int) -> tuple:
        """(document, start, length) of a piece of this length, no longer waiting."""
        same = self.waiting[length]
        document, start = same.pop()
        if not same:
            del self.waiting[length]
        self.total -= length
        return document, start, length

    def head(self, length: int, of: int) -> tuple:
        """The first ``length`` ids of a piece of length ``of``; the rest waits on."""
        document, start, _ = self.take(of)
        self.add(document, start + length, of - length)
        return document, start, length

    def window(self, capacity: int) -> list[tuple]:
        """The pieces of the next window: ``capacity`` ids, or all that wait."""
        longest = max(self.waiting)
        if longest >= capacity:
            return [self.head(capacity, longest)]
        pieces = [self.take(longest)]
        slack = capacity - longest
        for length, n in best_fill({k: len(v) for k, v in self.waiting.items()}, slack):
            pieces += [self.take(length) for _ in range(n)]
            slack -= n * length
        if slack and self.waiting:  # all that still wait are longer than the slack, or they would have been chosen
            pieces.append(self.head(slack, min(self.waiting)))
        return pieces


def windows(pool: Pool, capacity: int, down_to: int) -> Iterator[list[tuple]]:
    """Windows until at most ``down_to`` ids wait; what is less than a window goes by powers of two."""
    while pool.total > down_to:
        size = capacity if pool.total >= capacity else 1 << pool.total.bit_length() - 1
        yield pool.window(size)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, tokenizer: str | None = None, ranks: str | None = None,
                   pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """The pieces of all sequences, one row each.

    ``doc_id, row_id`` (number of the input row), ``start`` (ids of the document before the piece), ``length``,
    ``ids`` (unsigned 32-bit little-endian), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and
    ``sequence_length``. ``tokenizer`` is a file of ``tokenizers`` and ``ranks`` the same vocabulary as ranks
    (none: no quick path); without ``tokenizer``, the public vocabulary as the executors have it installed.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encode, pool = Encoder(tokenizer, ranks), Pool()
        number = row = TaskContext.get().partitionId() << 32

        def filled(down_to: int) -> pd.DataFrame:
            nonlocal number
            rows = []
            for pieces in windows(pool, capacity, down_to):
                size, at = sum(p[2] for p in pieces), 0
                for (doc_id, row_id, ids), start, length in pieces:
                    rows.append((doc_id, row_id, start, length, ids[start:start + length].tobytes(), len(ids), number, at, size))
                    at += length
                number += 1
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            return out.astype({"doc_id": "Int64"})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                document = (None if pd.isna(doc_id) else int(doc_id), row, ids)
                row += 1
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    pool.add(document, start, capacity)
                pool.add(document, whole, len(ids) - whole)
                if pool.total >= pool_tokens:
                    yield filled(pool_tokens // 2)
        yield filled(0)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInPandas(pack, PIECES)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids`` (binary), ``sequence_length, n_padding``.

    A sequence whose length is a power of two stays as it is, others are padded to ``capacity``.
    """
    one = F.struct("offset", "ids")
    whole = (pieces.groupBy("sequence_id", "sequence_length")
             .agg(F.array_sort(F.collect_list(one)).alias("p")))  # a sequence has at most ``capacity`` pieces
    ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    n = F.col("sequence_length")
    padding = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - n)
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), padding.cast("int")))
    return whole.select("sequence_id", F.concat(ids, pad).alias("ids"), "sequence_length", padding.cast("long").alias("n_padding"))
