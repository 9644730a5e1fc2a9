"""Remove word runs that an earlier document already holds, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window
over it starts in a document with a smaller id too; windows are judged on the
input.

Method. The residues COVER = {0, 1, 3} modulo PERIOD = 7 are a difference cover:
for any two positions i and j some k < 7 makes both i + k and j + k fall on the
cover. Only the runs of ANCHOR = WINDOW - PERIOD + 1 = 7 words that start at cover
positions are hashed (three of seven). Two equal windows, wherever they stand,
therefore share an anchor at the same offset inside both, so a window without a
shared anchor is unique and is never looked at again. The others are extended to
full windows, which are compared by 128-bit hashes; the smallest document id of
each decides.

Jobs: (1) blocks ask the buckets which of their anchors several documents hold;
(2) windows around shared anchors are sent, once per block, with the smallest id
holding them, and buckets answer where a smaller id holds the same window;
(3) blocks mark the covered words. The texts are shuffled once (the three steps
reuse one exchange). No pair of documents is ever formed, so copies by the
thousand cost what the same number of unrelated documents costs.

Cases: documents of fewer than ``WINDOW`` words lose nothing; null and empty texts
have no words; rows with equal ids do not count as earlier for each other; a null
id is smaller than all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import hash_words, restore_id, split_words, window_sums
from .exchange import Layout, SharedLookup, runs, shared_keys, split_buckets

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)

WINDOWS = "bucket int, block int, first binary, second binary, smallest binary"
EARLIER = "block int, first binary, second binary, smallest binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"


class _Block:
    """Words, hashes and document bounds of the rows of one block."""

    def __init__(self, pdf: pd.DataFrame):
        self.ids = pdf["doc_id"].to_numpy(np.int64)
        self.words, self.counts = split_words(list(pdf["text"]))
        self.hashes = hash_words(self.words)
        ends = np.cumsum(self.counts)
        self.starts = ends - self.counts
        self.row = np.repeat(np.arange(len(self.ids)), self.counts)
        self.offset = np.arange(len(self.words)) - self.starts[self.row]
        self.left = ends[self.row] - np.arange(len(self.words))  # words from here to the end of the document

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors of the documents that are long enough for a window."""
        h = window_sums(self.hashes[:, 0], ANCHOR, _BASES[0])
        n = len(h)
        ok = np.isin(self.offset[:n] % PERIOD, COVER) & (self.left[:n] >= ANCHOR) & (self.counts[self.row[:n]] >= WINDOW)
        at = np.flatnonzero(ok)
        return at, h[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, first hash, second hash) of all windows."""
        a = window_sums(self.hashes[:, 0], WINDOW, _BASES[1])
        b = window_sums(self.hashes[:, 1], WINDOW, _BASES[2])
        at = np.flatnonzero(self.left[:len(a)] >= WINDOW)
        return at, a[at], b[at]


def _ask(pdf: pd.DataFrame):
    block = _Block(pdf)
    at, h = block.anchors()
    return h, block.ids[block.row[at]]


def _smallest(a, b, ids):
    """Distinct (a, b) in order of a, and the smallest id of each."""
    order = np.argsort(a, kind="stable")
    a, b, ids = a[order], b[order], ids[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else runs(a)
    return a[at], b[at], np.minimum.reduceat(ids, at) if len(at) else ids, order, at


def _send_windows(pdf: pd.DataFrame, answers: pd.DataFrame, buckets: int) -> pd.DataFrame:
    columns = ["bucket", "block", "first", "second", "smallest"]
    if pdf.empty or answers.empty:
        return pd.DataFrame({c: [] for c in columns})
    block = _Block(pdf)
    at, h = block.anchors()
    shared = np.zeros(len(block.words) + PERIOD, np.int32)
    shared[at] = SharedLookup(answers, buckets).weights(h) > 0
    upto = np.concatenate([[0], np.cumsum(shared)])
    pos, a, b = block.windows()
    candidate = upto[pos + PERIOD] > upto[pos]  # a shared anchor starts at one of the first PERIOD words
    pos, a, b = pos[candidate], a[candidate], b[candidate]
    a, b, ids, _, _ = _smallest(a, b, block.ids[block.row[pos]])
    name = int(pdf["block"].iloc[0])
    return pd.DataFrame([(k, name, a[s].tobytes(), b[s].tobytes(), ids[s].tobytes()) for k, s in split_buckets(a, buckets)],
                        columns=columns)


def _answer_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    first = [np.frombuffer(x, "<u8") for x in pdf["first"]]
    second = [np.frombuffer(x, "<u8") for x in pdf["second"]]
    ids = [np.frombuffer(x, "<i8") for x in pdf["smallest"]]
    a, b, i = np.concatenate(first), np.concatenate(second), np.concatenate(ids)
    _, _, least, order, at = _smallest(a, b, i)
    best = np.empty(len(a), np.int64)
    best[order] = np.repeat(least, np.diff(np.append(at, len(a))))
    rows, pos = [], 0
    for block, x, y, own in zip(pdf["block"], first, second, ids):
        g = best[pos:pos + len(own)]
        pos += len(own)
        m = g < own  # the block knows the smallest id of its own documents
        if m.any():
            rows.append((block, x[m].tobytes(), y[m].tobytes(), g[m].tobytes()))
    return pd.DataFrame(rows, columns=["block", "first", "second", "smallest"])


def _mark(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    columns = ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
    if pdf.empty:
        return pd.DataFrame({c: [] for c in columns})
    block = _Block(pdf)
    pos, a, b = block.windows()
    owner = block.ids[block.row[pos]]
    _, _, least, order, at = _smallest(a, b, owner)
    best = np.empty(len(a), np.int64)
    best[order] = np.repeat(least, np.diff(np.append(at, len(a))))
    if not answers.empty and len(a):
        first = np.concatenate([np.frombuffer(x, "<u8") for x in answers["first"]])
        second = np.concatenate([np.frombuffer(x, "<u8") for x in answers["second"]])
        ids = np.concatenate([np.frombuffer(x, "<i8") for x in answers["smallest"]])
        o = np.argsort(first, kind="stable")
        first, second, ids = first[o], second[o], ids[o]
        k = np.minimum(np.searchsorted(first, a), len(first) - 1)
        best = np.where((first[k] == a) & (second[k] == b), np.minimum(best, ids[k]), best)
    gone = pos[best < owner]
    edge = np.zeros(len(block.words) + WINDOW + 1, np.int32)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + WINDOW, -1)
    covered = np.cumsum(edge)[:len(block.words)] > 0
    rows = []
    for i, (s, n) in enumerate(zip(block.starts, block.counts)):
        c = covered[s:s + n]
        words = block.words[s:s + n]
        lost = int(c.sum())
        spans = []
        if lost:
            turn = np.flatnonzero(np.diff(np.concatenate([[0], c.view(np.int8), [0]])))
            spans = [{"start": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)]
            words = [words[k] for k in np.flatnonzero(~c)]
        rows.append((block.ids[i], n, lost, b" ".join(words).decode("utf-8", "surrogatepass"), spans))
    return pd.DataFrame(rows, columns=columns)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_text, removed`` (word spans, end excluded)."""
    layout = Layout(docs, id_col, text_col, keys_per_byte=len(COVER) / PERIOD / 6)
    buckets = layout.buckets
    shared = shared_keys(layout, _ask)
    windows = layout.by_block().cogroup(shared.groupBy("block")).applyInPandas(
        lambda d, s: _send_windows(d, s, buckets), WINDOWS)
    earlier = windows.groupBy("bucket").applyInPandas(_answer_windows, EARLIER)
    return restore_id(layout.by_block().cogroup(earlier.groupBy("block")).applyInPandas(_mark, RESULT))
