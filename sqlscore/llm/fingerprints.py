"""Document fingerprints from prefix polynomial hashes.

``prefix_array`` holds, for every position of a text, the polynomial hash of the
code points before it under two bases modulo the prime 2**31 - 1. The hash of
any span is a difference of two entries times an inverse power, so any two
spans compare in constant time and the longest common extension of two
positions is found by binary search (:func:`common_extension`).

A fingerprint is a sampled prefix array: the length, the hash of the whole text,
the prefix hashes at the positions of a grid with eight points an octave, and
the hashes of the suffixes of the same lengths, and the smallest span hashes of the text:
of all its spans of ``SPAN`` code points, wherever they stand, the ``SKETCH`` smallest mixed hashes.
The grid does not depend on the text, so equal prefixes (suffixes) give equal entries; the
longest common prefix plus the longest common suffix that the grid can see are found by binary search. The
smallest spans of both texts together are a random sample of all their spans, so the share of them that both
texts hold tells how much text they have in common where one is shifted, or changed at both ends. The
likeness is the larger of both, over the longer length (1 for equal texts, below 1 for others). The size of
a fingerprint is logarithmic in the length.

:func:`edited_pairs` pairs every document with the next one in descending id
order. Documents are dealt into ranges of ids whose upper ends are ids that
occur; the document at an upper end is sent to the range above as well, where it
is the successor of that range's last document. Text is shuffled once.

Cases: null text is empty; two empty texts have likeness 1, an empty and a
non-empty one 0; documents with equal ids are ordered by text; null ids come
last; a single document is its own successor.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, documents, mix64, pieces, restore_id, text_bytes

PRIME = np.uint64(2 ** 31 - 1)
BASES = (1_000_003, 776_531_401)
POINTS_PER_OCTAVE = 8
#: Code points of a span, spans kept.
SPAN, SKETCH = 32, 48

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime; kept between calls, doubled as needed."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), int(PRIME)))
        have = np.concatenate([have, have * step % PRIME])
    _powers[base] = have
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def prefix_array(points: np.ndarray) -> np.ndarray:
    """Two rows (one per base) of n+1 prefix hashes: ``[k, i]`` is the hash of the first i code points."""
    out = np.zeros((len(BASES), len(points) + 1), np.uint64)
    for k, base in enumerate(BASES):
        np.cumsum((points + np.uint64(1)) * _power_table(base, len(points)) % PRIME, out=out[k, 1:])
        out[k] %= PRIME
    return out


def span_hash(prefix: np.ndarray, start, end) -> np.ndarray:
    """Hash of the spans [start, end): equal spans have equal hashes wherever they stand."""
    start, end = np.atleast_1d(start), np.atleast_1d(end)
    parts = []
    for k, base in enumerate(BASES):
        inverse = _power_table(pow(base, -1, int(PRIME)), int(start.max(initial=0)) + 1)
        parts.append((prefix[k, end] + PRIME - prefix[k, start]) % PRIME * inverse[start] % PRIME)
    return (parts[0] << np.uint64(31)) | parts[1]


def common_extension(a: np.ndarray, i: int, b: np.ndarray, j: int) -> int:
    """Length of the longest common run from position i of text a and j of text b (prefix arrays)."""
    low, high = 0, min(a.shape[1] - 1 - i, b.shape[1] - 1 - j)
    while low < high:
        mid = (low + high + 1) // 2
        if span_hash(a, i, i + mid)[0] == span_hash(b, j, j + mid)[0]:
            low = mid
        else:
            high = mid - 1
    return low


def _grid() -> np.ndarray:
    p = POINTS_PER_OCTAVE
    points = list(range(1, p + 1))
    for octave in range(28):
        points += [(p << octave) + (m << octave) for m in range(1, p + 1)]
    return np.array(points, np.int64)


GRID = _grid()


def smallest_spans(prefix: np.ndarray) -> np.ndarray:
    """The ``SKETCH`` smallest distinct mixed hashes of the spans of ``SPAN`` code points (32 bits, sorted)."""
    n = prefix.shape[1] - SPAN
    if n < 1:
        return np.empty(0, np.uint32)
    inverse = _power_table(pow(BASES[0], -1, int(PRIME)), n)
    h = (prefix[0, SPAN:] + PRIME - prefix[0, :n]) % PRIME * inverse % PRIME
    h = (mix64(h) >> np.uint64(32)).astype(np.uint32)
    some = 4 * SKETCH
    least = np.unique(np.partition(h, some)[:some] if len(h) > some else h)[:SKETCH]
    return least if len(least) == SKETCH or len(h) <= some else np.unique(h)[:SKETCH]  # many repetitions: look at all


class Fingerprint:
    """Length, whole hash, 24-bit prefix and suffix hashes at the grid positions, and the smallest spans."""

    __slots__ = ("n", "whole", "prefixes", "suffixes", "spans")

    def __init__(self, n: int, whole: int, prefixes: np.ndarray, suffixes: np.ndarray, spans: np.ndarray):
        self.n, self.whole, self.prefixes, self.suffixes, self.spans = n, whole, prefixes, suffixes, spans

    @classmethod
    def of(cls, text: str) -> "Fingerprint":
        prefix = prefix_array(code_points(text))
        n = prefix.shape[1] - 1
        at = GRID[:np.searchsorted(GRID, n, side="right")]
        head = (prefix[0, at] << np.uint64(31)) | prefix[1, at]
        tail = span_hash(prefix, n - at, np.full(len(at), n)) if len(at) else head
        return cls(n, (int(prefix[0, n]) << 31) | int(prefix[1, n]), _short(head), _short(tail), smallest_spans(prefix))

    def __str__(self) -> str:
        def pack(a):
            return base64.b64encode(a.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()).decode()
        spans = base64.b64encode(self.spans.astype(">u4").tobytes()).decode()
        return f"{self.n}.{self.whole:016x}.{pack(self.prefixes)}.{pack(self.suffixes)}.{spans}"

    @classmethod
    def parse(cls, text: str) -> "Fingerprint":
        n, whole, head, tail, spans = text.split(".")

        def unpack(s):
            raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 3).astype(np.uint32)
            return (raw[:, 0] << 16) | (raw[:, 1] << 8) | raw[:, 2]
        return cls(int(n), int(whole, 16), unpack(head), unpack(tail), np.frombuffer(base64.b64decode(spans), ">u4").astype(np.uint32))


def _short(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.uint32)


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Largest grid position at which the hashes agree (equality holds up to it and fails beyond)."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[mid - 1] == b[mid - 1]:
            low = mid
        else:
            high = mid - 1
    return int(GRID[low - 1]) if low else 0


def common_share(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated code points that two texts have in common, from the spans that both hold among their smallest."""
    if not len(a.spans) or not len(b.spans):
        return 0.0
    both = np.union1d(a.spans, b.spans)
    if SKETCH in (len(a.spans), len(b.spans)):  # beyond the last of a full sketch nothing is known
        both = both[:SKETCH]
    j = np.isin(both, np.intersect1d(a.spans, b.spans)).mean()
    return j * (a.n + b.n - 2 * SPAN + 2) / (1 + j) + SPAN - 1 if j else 0.0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1: what the texts are seen to have in common, at their ends or anywhere, over the longer length; 1 for equal texts."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    longest, shortest = max(a.n, b.n), min(a.n, b.n)
    if not shortest:
        return 0.0
    ends = _agree(a.prefixes, b.prefixes) + _agree(a.suffixes, b.suffixes)
    return float(min(shortest, longest - 1, max(ends, common_share(a, b))) / longest)


def edited_text(text: str, following: str) -> str:
    """The last third (rounded down) replaced by the first as many code points of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _pair_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["doc_id", "text"], ascending=[False, True], kind="stable")
    own, ahead = pdf[~pdf["ahead"]], pdf[pdf["ahead"]]
    if own.empty:
        return pd.DataFrame({c.split()[0]: [] for c in SCHEMA.split(", ")})
    texts = list(own["text"])
    nxt = ahead["text"].iloc[0] if len(ahead) else texts[0]
    rows, mine = [], Fingerprint.of(texts[0])
    for i, text in enumerate(texts):
        following = texts[i + 1] if i + 1 < len(texts) else nxt
        edited = edited_text(text, following)
        fe, fn = Fingerprint.of(edited), Fingerprint.of(following)
        rows.append((len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), str(mine), str(fe),
                     likeness(mine, fe), likeness(mine, fn)))
        mine = fn
    out = pd.DataFrame(rows, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    out.insert(0, "doc_id", own["doc_id"].array)
    return out


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness (see the module's text)."""
    d = documents(docs, id_col, text_col)
    n = pieces(text_bytes(d), block_bytes)
    cuts = d.agg(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n)], F.lit(max(10_000, 20 * n))).alias("cuts")).first()["cuts"]
    ends = np.unique(np.array(cuts or [0], dtype=np.int64))  # ids that occur; the last is the largest id

    @F.pandas_udf("array<int>")
    def ranges(ids: pd.Series) -> pd.Series:
        """The range of the id and, for the upper end of a range, the range above (as -1 - range)."""
        at = np.searchsorted(ends, ids.to_numpy(np.int64))
        edge = ends[at] == ids.to_numpy(np.int64)
        return pd.Series([[a, -1 - (a + 1) % len(ends)] if e else [a] for a, e in zip(at.tolist(), edge)])

    dealt = d.select("doc_id", "text", F.explode(ranges("doc_id")).alias("_r"))
    dealt = dealt.select("doc_id", "text", F.when(F.col("_r") < 0, -1 - F.col("_r")).otherwise(F.col("_r")).alias("range"),
                         (F.col("_r") < 0).alias("ahead"))
    return restore_id(dealt.groupBy("range").applyInPandas(_pair_block, SCHEMA))
