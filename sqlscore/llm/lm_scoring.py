"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its words (A-Z in lower case) and one end token. A word is coded byte by byte with a
closing blank, a byte by the bits of a weight-balanced code (few for frequent bytes); the end token is coded as a line feed. Every bit is
predicted by several contexts at once, each with counts of zeros and ones from the training
documents:

* *prefix*: all bytes of the word so far and the bits of this byte. The first bytes use a hashed
  table; deeper prefixes are counted exactly, as sums over runs of sorted words;
* *order 4, 3, 2*: the last bytes inside the word, in hashed tables of fixed size.

Prefix and order 2 also know the *state* of the text: the group (language) that the words read so far
speak for most, by a hashed table of word counts per group. The state depends on earlier words only, so it
adapts to each text as the text is read, and the product over the tokens stays a probability.

The predictions are mixed in the logistic domain by weights chosen by a gate (the bit's place
and how often the prefix was seen), learned online: mini-batches of training words in a random
order, each word predicted by counts without itself. An adaptive table then refines the mixed
probability (per gate and probability step, the observed rate of ones). The product over the
bits is the probability of the word, so all words have probabilities that sum to at most one; no
word is impossible.

Contexts of words: the counts of the word after the previous word, and after the previous two, are
interpolated with that probability p, in turn: ``(count + K * p) / (count of the context + K)`` with the
constants ``CONTEXT``. The start of a text is a context like a word. The sum over all words stays at most
one. These counts are kept by bits of the key whose number grows with the corpus (``SPARE_BITS``), and nothing is dropped. The bit predictors themselves see one word only.
The score of a text is the sum of the log10 probabilities of its tokens.

Jobs: (1) the counts of (state, word) tokens of the training documents, whose state is their own group: a
table of buckets, in which words with the same first bytes stand together; (2) from it the word counts
per group, hashed; (3) hashed tables and, bucket by bucket, the weights and the adaptive table, summed over buckets; (4) blocks of documents
ask the buckets for the tokens they hold and get the log probability and the training count of each; every
distinct token of a bucket is evaluated once; they send the buckets of contexts the keys of the word pairs
and triples they hold, with their own training counts, and get the sums; (5) blocks add up.

Scale: the table of tokens grows with the corpus and is spread over buckets by the first bytes, the counts of
pairs and triples over buckets by their keys. What
reaches the driver and is broadcast has a fixed size: ``sum(2 ** TABLE_BITS)`` slots of counts,
``STATE_SLOTS`` times ``GROUPS`` word counts, and the weights.

Cases: null and empty texts have the end token only; without training documents all counts
are 0 and every bit has probability 1/2; rows with equal ids are scored (and learned) each; without a
group column, or where it is null, a text belongs to group 0.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BLOCK_BYTES, MIN_ID, block_of, bucket_of, documents, mix64, pieces, restore_id, salted_crc,
                     text_bytes)
from .exchange import runs, split_buckets

END = b"\n"
TRIE_FROM = 5
#: log2 of the slots of the hashed tables: prefix, order 4, 3, 2.
TABLE_BITS = (18, 20, 19, 18)
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])])
TABLES = len(TABLE_BITS)
INPUTS = TABLES + 1  # and a bias
#: Groups that states tell apart (the most frequent ones; the rest is group 0), hashed word slots of the state table.
GROUPS, STATE_SLOTS = 8, 1 << 16
#: State of the first token of a text.
UNKNOWN = 15
CONFIDENCE = (1, 2, 4, 16)
GATES = 8 * (len(CONFIDENCE) + 1)
STEPS = 24
#: Steps that are mixed at once, and after which the weights move.
BATCH = 1 << 14
#: Characters that a worker splits at once: a block is one slice, or a few.
PIECE = 8_000_000
#: Text bytes that share one bucket of words.
BUCKET_BYTES = 8_000_000

#: Weight of the shorter context, after one word and after two (chosen on a fifth of the training documents of sf0.01).
CONTEXT = (1024.0, 1.0)
#: Bits of the keys of contexts beyond those that number the bytes of the corpus: a context that was not seen is taken
#: for another one with a probability of less than 1 in 2 ** SPARE_BITS, at every size.
SPARE_BITS = 12
#: Text bytes that share one bucket of pairs and triples.
CONTEXT_BYTES = 4_000_000

WORDS = "bucket int, words binary, counts binary"
REQUEST = "bucket int, block int, part int, words binary, counts binary"
REPLY = "block int, part int, bucket int, logs binary, counts binary"
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, bits_per_byte double")

_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


@functools.cache
def _zstd():
    import zstandard
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _squeeze(raw: bytes) -> bytes:
    return _zstd()[0].compress(raw)


def _loosen(raw: bytes) -> bytes:
    return _zstd()[1].decompress(raw)


def _pack(words: list[bytes]) -> bytes:
    return _squeeze(b" ".join(words)) if words else b""


def _unpack(raw: bytes) -> list[bytes]:
    return _loosen(raw).split(b" ") if raw else []


def _planes(values: np.ndarray) -> bytes:
    """Numbers, first bytes first, squeezed: small numbers take little room."""
    return _squeeze(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()) if len(values) else b""


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    if not raw:
        return np.empty(0, dtype)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(_loosen(raw), np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps: the bytes that are noise at the mean gap plain, the upper ones squeezed."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    plain = max(0, int(keys[-1] - keys[0]) // len(keys)).bit_length() // 8
    b = gaps.view(np.uint8).reshape(-1, 8).T
    return bytes([plain]) + len(keys).to_bytes(8, "little") + b[:plain].tobytes() + _squeeze(b[plain:].tobytes())


def _unpack_keys(raw: bytes) -> np.ndarray:
    plain, n = raw[0], int.from_bytes(raw[1:9], "little")
    b = np.frombuffer(raw[9:9 + plain * n] + _loosen(raw[9 + plain * n:]), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(b.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _texts(texts: list[str]) -> Iterator[slice]:
    """Slices of about ``PIECE`` characters."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > PIECE:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


class _Places(dict):
    """Numbers new keys in order of arrival."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _split(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, place of every token among them, tokens of each text); each text ends with the end token.

    A blank at an end of a text may add the empty word, which no token has.
    """
    if not texts:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    raw = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.large_binary()).view(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(raw))
    numbered = parts.values.view(pa.large_binary()).dictionary_encode()
    words, code = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy().astype(np.int64)
    is_word = np.array([len(w) > 0 for w in words], bool)[code]  # blanks at the ends of a text leave empty pieces
    ends = np.concatenate([[0], np.cumsum(is_word)])[parts.offsets.to_numpy()]
    return words + [END], np.insert(code[is_word], ends[1:], len(words)), np.diff(ends) + 1


def _distinct(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, place of every key) of keys below ``size``."""
    used = np.zeros(size, bool)
    used[keys] = True
    return np.flatnonzero(used), (np.cumsum(used) - 1)[keys]


def _name(words: list[bytes], keys: np.ndarray) -> list[bytes]:
    return [bytes([65 + c % 16]) + words[c // 16] for c in keys.tolist()]


def _hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def _slots_of(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.int64) & (STATE_SLOTS - 1)


def _after(values: np.ndarray, counts: np.ndarray, start) -> np.ndarray:
    """The value of the token before, ``start`` for the first token of a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(counts) - counts] = start
    return out


def _contexts(hashes: np.ndarray, code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (previous word, word) and of (previous two, word) of every token; a text's first token has start marks before it.

    ``hashes``: of the distinct words.
    """
    if not len(code):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h = hashes[code]
    pair = mix64(mix64(_after(h, counts, _K[2]) ^ _K[0]) * _K[1] + h)
    return pair, mix64(mix64(_after(pair, counts, _K[2]) ^ _K[1]) * _K[0] + h)


def _context_rows(keys: np.ndarray, counts: np.ndarray, buckets: int, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, keys, counts) of sorted keys of ``bits`` bits; buckets of contexts have negative numbers."""
    for b, at in split_buckets(keys << np.uint64(64 - bits), buckets):
        yield -1 - b, _pack_keys(keys[at]), _planes(counts[at].astype("<u4"))


def _count_contexts(asked: pd.DataFrame) -> pd.DataFrame:
    """A bucket of contexts adds up the counts of all blocks and answers each with the sums, in the order of its keys."""
    sent = [_unpack_keys(raw) for raw in asked["words"]]
    _, place = np.unique(np.concatenate(sent), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate([_from_planes(raw, "<u4") for raw in asked["counts"]]))
    sums = np.split(n[place].astype("<u4"), np.cumsum([len(x) for x in sent])[:-1])
    return pd.DataFrame([(block, part, bucket, b"", _planes(x))
                         for block, part, bucket, x in zip(asked["block"], asked["part"], asked["bucket"], sums)],
                        columns=["block", "part", "bucket", "logs", "counts"])


def interpolate(p: np.ndarray, before: np.ndarray, pair: np.ndarray, triple: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probability of every token from that of its word ``p`` and the training counts of the word before it, the pair and the triple."""
    first, second = CONTEXT
    p = (pair + first * p) / (before + first)
    both = _after(pair, counts, 0)  # the pair before; a first token has no second context
    return (np.where(both > 0, triple, 0) + second * p) / (both + second)


def _tokens(texts: list[str], groups: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(distinct words, distinct tokens, place of every token among them, tokens of each text, keys of pairs and triples).

    A token is 16 times the place of its word and the state. ``groups``: log probability of each word slot in each group.
    """
    words, code, counts = _split(texts)
    hashes = _hashes(words, len(words))
    if not len(code):
        return [], code, code, counts, _contexts(hashes, code, counts)
    table = groups[_slots_of(hashes)]
    first = np.cumsum(counts) - counts
    start = np.repeat(first, counts)
    state, best = np.zeros(len(code), np.int64), np.zeros(len(code))
    for z in range(1, groups.shape[1]):  # lead of group z over group 0 on the earlier words
        gain = np.ascontiguousarray(table[:, z] - table[:, 0], np.float64)[code]
        lead = np.cumsum(gain)
        lead -= gain
        lead -= lead[start]
        better = lead > best
        state[better] = z
        best[better] = lead[better]
    state[first] = UNKNOWN
    both, place = _distinct(code * 16 + state, 16 * len(words))
    return words, both, place, counts, _contexts(hashes, code, counts)


def _deal(words: Iterable[bytes], tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the tokens by bucket, buckets that have some, where each starts); words with the same first bytes share one, in all states."""
    words = list(words)
    h = _hashes((w[:TRIE_FROM - 1] for w in words), len(words))
    b = bucket_of(h, buckets).astype(np.int64)[tokens // 16]
    order = np.argsort(b, kind="stable")
    at = runs(b[order])
    return order, b[order[at]], at


class ByteCode:
    """Steps (yes or no) that code a byte: a tree over the byte values in order, cut at half the weight each time.

    Frequent bytes take few steps, every byte takes some. Depends on the counts of bytes only.
    """

    def __init__(self, weights: np.ndarray):
        weights = weights + max(float(weights.sum()), 1.0) / 2 ** 14
        below = np.concatenate([[0.0], np.cumsum(weights)])
        paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
        todo, nodes = [(0, 256)], 0
        while todo:
            lo, hi = todo.pop()
            if hi - lo < 2:
                continue
            nodes += 1
            cut = lo + 1 + int(np.argmin(np.abs(below[lo + 1:hi] - (below[lo] + below[hi]) / 2)))
            for v in range(lo, hi):
                paths[v].append((nodes, int(v >= cut)))
            todo += [(lo, cut), (cut, hi)]
        self.length = np.array([len(x) for x in paths])
        self.node = np.zeros((256, self.length.max()), np.uint64)
        self.bit = np.zeros(self.node.shape, np.int8)
        for v, path in enumerate(paths):
            self.node[v, :len(path)], self.bit[v, :len(path)] = zip(*path)
        place = np.where(np.arange(self.node.shape[1]) < self.length[:, None], 2 * self.node.astype(np.int64) + self.bit, -1)
        #: Steps that two different bytes have in common.
        self.shared = np.cumprod((place[:, None] == place[None]) & (place[None] >= 0), axis=2).sum(2)


class _Words:
    """Distinct words (state and bytes), in the order of their bytes with closing blanks, and the steps that code them.

    ``order``: place of each among the words given. All other arrays follow this order. The state is not coded.
    """

    def __init__(self, words: list[bytes], code: ByteCode):
        closed = [w + b" " for w in words]
        self.order = np.array(sorted(range(len(words)), key=closed.__getitem__), np.int64)
        b = np.frombuffer(b"".join([closed[i] for i in self.order.tolist()]), np.uint8)
        self.code, self.n, self.raw = code, len(words), b
        self.ends = np.flatnonzero(b == 32) + 1
        self.starts = np.concatenate([[0], self.ends])[:-1]
        word = np.repeat(np.arange(self.n), self.ends - self.starts)
        self.pos = np.arange(len(b)) - self.starts[word]
        byte = b.astype(np.uint64)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), _K[0])]))
        total = np.concatenate([[np.uint64(0)], np.cumsum((byte + np.uint64(1)) * power[:-1])])
        inverse = np.uint64(pow(int(_K[0]), -1, 2 ** 64))
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), inverse)]))
        first = self.starts[word]
        prefix = mix64((total[:-1] - total[first]) * back[first] + self.pos.astype(np.uint64) * _K[1])
        order, known = [], np.zeros(len(b), np.uint64)
        state = byte[first] << np.uint64(40)
        for k in (1, 2, 3, 4):
            before = np.where(self.pos > k, np.concatenate([np.zeros(k, np.uint64), byte[:-k]])[:len(b)], np.uint64(0))
            known = known | (before << np.uint64(8 * (k - 1)))
            order.append(known + (state if k < 3 else np.uint64(0)) + np.uint64(k << 48))
        self.contexts = [prefix, mix64(order[3]), mix64(order[2]), mix64(order[1])]
        self.length = np.where(self.pos > 0, code.length[b], 0)
        self.first = np.concatenate([[0], np.cumsum(self.length)])  # of each byte among the steps of all words
        self.base = self.first[self.starts]
        self.size = self.first[self.ends] - self.base

    def prefix_counts(self, c: np.ndarray) -> np.ndarray:
        """(no, yes) of every step: how often the words ``c`` with the same state and the same steps before went on so.

        Words that share steps stand together, so a step's counts are sums over runs; past the steps that a word
        shares with a neighbour only the word itself is counted. Right from byte ``TRIE_FROM`` on: before it, the
        words of other buckets are missing.
        """
        out = np.zeros((self.first[-1], 2), np.float32)
        if not self.n:
            return out
        bit = self._bits()
        out[np.arange(len(bit)), bit] = np.repeat(c, self.size)
        word = np.repeat(np.arange(self.n), self.ends - self.starts)
        last = np.maximum(word - 1, 0)
        other = self.raw[np.minimum(self.starts[last] + self.pos, self.ends[last] - 1)]
        differs = np.minimum.reduceat(np.where(self.raw != other, self.pos, len(self.raw)), self.starts)
        differs[0] = 0
        at = self.starts + differs
        shared = np.where(differs > 0, self.first[at] - self.base + self.code.shared[self.raw[at], other[at]], -1)
        most = np.maximum(shared, np.append(shared[1:], -1))
        deep = self.first[np.minimum(self.starts + TRIE_FROM, self.ends)] - self.base
        active = np.flatnonzero(most >= deep)
        depth = int(deep[active].min(initial=0))
        while len(active):
            here = active[deep[active] <= depth]
            if len(here):
                start = shared[here] < depth
                start[0] = True
                at, run = np.flatnonzero(start), np.cumsum(start) - 1
                step = self.base[here] + depth
                every, yes = np.add.reduceat(c[here], at), np.add.reduceat(c[here] * bit[step], at)
                out[step] = np.stack([every - yes, yes], axis=1)[run]
            depth += 1
            active = active[most[active] >= depth]
        return out

    def _bits(self) -> np.ndarray:
        at = np.repeat(np.arange(len(self.raw)), self.length)
        return self.code.bit[self.raw[at], np.arange(len(at)) - self.first[at]]

    def batches(self, words: np.ndarray) -> Iterator[np.ndarray]:
        """The words in turn, about ``BATCH`` steps at once."""
        at = runs(np.cumsum(self.size[words]) // BATCH)
        yield from np.split(words, at[1:])

    def steps(self, words: np.ndarray) -> tuple[np.ndarray, ...]:
        """(word, byte, step, depth in the byte, bit) of all steps of the words."""
        n = self.ends[words] - self.starts[words]
        bytes_ = np.repeat(self.starts[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        word, n = np.repeat(np.arange(len(words)), n), self.length[bytes_]
        at = np.repeat(bytes_, n)
        depth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(word, n), at, self.first[at] + depth, depth, self.code.bit[self.raw[at], depth].astype(np.int64)

    def slots(self, at: np.ndarray, depth: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """Slots of the tables in the joint array; those of the prefix table for the steps ``first``, in the first bytes."""
        step = self.code.node[self.raw[at], depth] * _K[2]
        for t, c in enumerate(self.contexts):
            h = (c[at] + step) if t else (c[at[first]] + step[first])
            yield ((h * _K[0]) >> np.uint64(64 - TABLE_BITS[t])).astype(np.int64) + OFFSETS[t]


def _add_tables(n: np.ndarray, words: list[bytes], counts: np.ndarray, code: ByteCode) -> None:
    """Add the words to the tables: ``n[slot, bit]``."""
    w = _Words(words, code)
    flat, counts = n.reshape(-1), counts[w.order].astype(np.float64)
    for ids in w.batches(np.arange(w.n)):
        word, at, _, depth, bit = w.steps(ids)
        c = counts[ids][word]
        first = np.flatnonzero(w.pos[at] < TRIE_FROM)
        for t, slot in enumerate(w.slots(at, depth, first)):
            if t:
                np.add.at(flat, 2 * slot + bit, c)
            else:
                np.add.at(flat, 2 * slot + bit[first], c[first])


def _log_odds(n: np.ndarray) -> np.ndarray:
    return np.log((n[..., 1] + np.float32(0.02)) / (n[..., 0] + np.float32(0.02)))


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of two float32, each fetched as one number."""
    return table.view(np.float64)[:, 0][at].view(np.float32).reshape(-1, 2)


def _without(n: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The counts, in place, without one of each at ``own``."""
    flat = n.reshape(-1)
    flat[own] = np.maximum(flat[own] - 1, 0)
    return n


def _inputs(w: _Words, ids: np.ndarray, prefixes: np.ndarray, tables: np.ndarray, leave_out: bool):
    """(inputs, gate, bit, place among ``ids``) of the steps of some words.

    ``tables``: counts (slot, bit) if ``leave_out``, which takes one token of each word out; else the log odds by slot.
    """
    word, at, step, depth, bit = w.steps(ids)
    x = np.empty((INPUTS, len(bit)), np.float32)
    own = 2 * np.arange(len(bit)) + bit
    first = np.flatnonzero(w.pos[at] < TRIE_FROM)
    prefix = _rows(prefixes, step)
    for t, slot in enumerate(w.slots(at, depth, first)):
        found = _rows(tables, slot)
        if t and leave_out:
            x[t] = _log_odds(_without(found, own))
        elif t:
            x[t] = found[:, 0]
        elif leave_out:
            prefix[first] = found
            x[0] = _log_odds(_without(prefix, own))
            seen = prefix[:, 0] + prefix[:, 1]
        else:
            x[0] = _log_odds(prefix)
            seen = prefix[:, 0] + prefix[:, 1]
            x[0, first], seen[first] = found[:, 0], found[:, 1]
    x[TABLES] = 0.3
    gate = np.minimum(depth, 7) * (len(CONFIDENCE) + 1)
    for least in CONFIDENCE:
        gate += seen >= least
    return x, gate, bit, word


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


def _step(dot):
    """Step of the adaptive table: the mixed log odds from -12 to 12."""
    return np.clip(((dot + 12) * STEPS / 24).astype(np.int64), 0, STEPS - 1)


def first_weights() -> np.ndarray:
    w = np.zeros((GATES, INPUTS))
    w[:, :TABLES] = (0.5, 0.25, 0.15, 0.1)
    return w


def _mix(weights: np.ndarray, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
    """``weights``: (inputs, gates)."""
    out = weights[0][gate] * x[0]
    for i in range(1, INPUTS):
        out += weights[i][gate] * x[i]
    return out


def _learn(words: list[bytes], counts: np.ndarray, tables: np.ndarray, code: ByteCode):
    """Online pass over the words of a bucket: (weights, tokens per gate, ones and all of the adaptive table)."""
    w = _Words(words, code)
    counts = counts[w.order].astype(np.float64)
    prefixes = w.prefix_counts(counts)
    weights, seen = first_weights().T.astype(np.float32), np.zeros(GATES)
    ones, every = np.zeros(GATES * STEPS), np.zeros(GATES * STEPS)
    for n, ids in enumerate(w.batches(np.random.default_rng(17).permutation(w.n))):
        x, gate, bit, word = _inputs(w, ids, prefixes, tables, True)
        c = counts[ids][word]
        dot = _mix(weights, gate, x)
        gap = (bit - _sigmoid(dot)) * c
        mass = np.bincount(gate, weights=c, minlength=GATES)
        rate = 0.3 / (1 + n / 50) / np.maximum(mass, 1)
        for i in range(INPUTS):
            weights[i] += rate * np.bincount(gate, weights=gap * x[i], minlength=GATES)
        cell = gate * STEPS + _step(dot)
        ones += np.bincount(cell, weights=c * bit, minlength=GATES * STEPS)
        every += np.bincount(cell, weights=c, minlength=GATES * STEPS)
        seen += mass
    return weights.T.astype(np.float64), seen, ones.reshape(GATES, STEPS), every.reshape(GATES, STEPS)


class Model:
    """Log odds (and how often seen) of the hashed tables, mixing weights and the adaptive table."""

    def __init__(self, tables: np.ndarray, weights: np.ndarray, refined: np.ndarray, code: ByteCode):
        self.tables, self.weights, self.code = tables, np.ascontiguousarray(weights.T, np.float32), code
        self.refined = np.stack([1 - refined, refined], axis=-1).astype(np.float32).reshape(-1)

    @staticmethod
    def scoring_tables(n: np.ndarray) -> np.ndarray:
        return np.stack([_log_odds(n), n.sum(1)], axis=1).astype(np.float32)

    def log10(self, words: list[bytes], known: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 probability of each of the distinct words; ``known``: the training tokens with the same first bytes."""
        out = np.zeros(len(words))
        if not words:
            return out
        place = {v: i for i, v in enumerate(words)}
        others = [v for v in known if v not in place]  # count, but are not asked for
        c = np.zeros(len(words) + len(others))
        for v in others:
            place[v] = len(place)
        c[np.fromiter((place[v] for v in known), np.int64, len(known))] = counts
        w = _Words(words + others, self.code)
        prefixes = w.prefix_counts(c[w.order])
        for ids in w.batches(np.flatnonzero(w.order < len(words))):
            x, gate, bit, word = _inputs(w, ids, prefixes, self.tables, False)
            dot = _mix(self.weights, gate, x)
            p = 0.5 * _sigmoid(np.where(bit == 1, dot, -dot)) + 0.5 * self.refined[2 * (gate * STEPS + _step(dot)) + bit]
            out[w.order[ids]] = np.bincount(word, weights=np.log10(p), minlength=len(ids))
        return out


def _group_table(table: DataFrame) -> tuple[np.ndarray, ByteCode]:
    """(log probability of each word slot in each group, code of the bytes) from the table of training tokens."""
    size = STATE_SLOTS * GROUPS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size + 256, np.int64)
        for pdf in batches:
            for raw, counts in zip(pdf["words"], pdf["counts"]):
                words, c = _unpack(raw), _from_planes(counts, np.int64)
                n[size:] += np.bincount(np.frombuffer(b"".join([w[1:] + b" " for w in words]), np.uint8), minlength=256)
                group = np.fromiter((w[0] - 65 for w in words), np.int64, len(words))
                told = group < GROUPS
                np.add.at(n, (_slots_of(_hashes((w[1:] for w in words), len(words))) * GROUPS + group)[told], c[told])
        at = np.flatnonzero(n)
        yield pd.DataFrame({"i": at, "n": n[at]})
    n = np.zeros(size + 256)
    rows = table.mapInPandas(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    n[rows["i"].to_numpy()] = rows["n"].to_numpy()  # size + 256 numbers at most
    code, n = ByteCode(n[size:]), n[:size].reshape(STATE_SLOTS, GROUPS)
    spoken = np.flatnonzero(n.sum(0))
    n = n[:, :spoken.max(initial=0) + 1]
    table_ = np.log((n + 0.05) / (n.sum(0) + 0.05 * STATE_SLOTS))
    table_[:, n.sum(0) == 0] = -50.0  # a group without texts is no state
    return table_.astype(np.float32), code


def _corpus_words(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, words, counts``: one row a bucket, of the training documents' tokens (the state is the document's group)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[bytes, int] = {}

        def rows():
            words, n = list(total), np.fromiter(total.values(), np.int64, len(total))
            total.clear()
            order, names, at = _deal((w[1:] for w in words), 16 * np.arange(len(words)), buckets)
            return pd.DataFrame([(b, _pack([words[i] for i in part.tolist()]), _planes(n[part]))
                                 for b, part in zip(names.tolist(), np.split(order, at[1:]))], columns=["bucket", "words", "counts"])
        for pdf in batches:
            texts, group = list(pdf["text"]), pdf["group"].to_numpy(np.int64)
            for s in _texts(texts):
                words, code, counts = _split(texts[s])
                state = np.repeat(group[s], counts)
                state[np.cumsum(counts) - counts] = UNKNOWN
                both, place = _distinct(code * 16 + state, 16 * len(words))
                for w, n in zip(_name(words, both), np.bincount(place, minlength=len(both)).tolist()):
                    total[w] = total.get(w, 0) + n
                if len(total) > 400_000:  # bounded memory; the counts are added up later
                    yield rows()
        yield rows()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = {}
        for raw, n in zip(pdf["words"], pdf["counts"]):
            for w, k in zip(_unpack(raw), _from_planes(n, np.int64).tolist()):
                total[w] = total.get(w, 0) + k
        words = sorted(total)
        return pd.DataFrame([(int(pdf["bucket"].iloc[0]), _pack(words), _planes(np.array([total[w] for w in words], np.int64)))],
                            columns=["bucket", "words", "counts"])
    return docs.select("text", "group").mapInPandas(count, WORDS).groupBy("bucket").applyInPandas(add, WORDS)


def _sum_tables(table: DataFrame, parts: int, code: ByteCode) -> np.ndarray:
    """Counts (slot, bit) of the hashed tables over all buckets (a fixed number of slots)."""
    size = int(OFFSETS[-1])
    width = -(-size // parts)
    schema = "part int, slots binary, counts binary"

    def local(batches):
        n = np.zeros((size, 2))
        for pdf in batches:
            for words, counts in zip(pdf["words"], pdf["counts"]):
                _add_tables(n, _unpack(words), _from_planes(counts, np.int64), code)
        at = np.flatnonzero(n.sum(1))
        s = runs(at // width)
        rows = [(int(at[lo] // width), _pack_keys(at[lo:hi].astype(np.uint64)), _planes(n[at[lo:hi]].astype("<u8").reshape(-1)))
                for lo, hi in zip(s, np.append(s[1:], len(at)))]
        yield pd.DataFrame(rows, columns=["part", "slots", "counts"])

    def add(pdf):
        lo = int(pdf["part"].iloc[0]) * width
        n = np.zeros((width, 2))
        for s, c in zip(pdf["slots"], pdf["counts"]):
            n[_unpack_keys(s).astype(np.int64) - lo] += _from_planes(c, "<u8").reshape(-1, 2)
        at = np.flatnonzero(n.sum(1))
        return pd.DataFrame([(int(pdf["part"].iloc[0]), (at + lo).astype("<u4").tobytes(), n[at].astype("<f4").tobytes())],
                            columns=["part", "slots", "counts"])
    n = np.zeros((size, 2), np.float32)
    for r in table.mapInPandas(local, schema).groupBy("part").applyInPandas(add, schema).toLocalIterator():  # OFFSETS[-1] slots in all
        n[np.frombuffer(r["slots"], "<u4")] = np.frombuffer(r["counts"], "<f4").reshape(-1, 2)
    return n


def train(table: DataFrame, buckets: int, code: ByteCode) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Fit on the table of training tokens: (scoring tables, weights, adaptive table, tokens, distinct words)."""
    n = _sum_tables(table, max(64, buckets), code)
    shared = table.sparkSession.sparkContext.broadcast(n)  # fixed size
    size = GATES * (INPUTS + 1 + 2 * STEPS)

    def learn(batches):
        total = np.zeros(size)
        tokens = distinct = 0
        for pdf in batches:
            for raw, c in zip(pdf["words"], pdf["counts"]):
                words, c = _unpack(raw), _from_planes(c, np.int64)
                if not words:
                    continue
                tokens, distinct = tokens + int(c.sum()), distinct + len({w[1:] for w in words})
                w, seen, ones, every = _learn(words, c, shared.value, code)
                total += np.concatenate([(w * seen[:, None]).ravel(), seen, ones.ravel(), every.ravel()])
        yield pd.DataFrame({"i": np.arange(size + 2), "v": np.concatenate([total, [tokens, distinct]])})
    sums = table.mapInPandas(learn, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()  # fixed size
    v = np.zeros(size + 2)
    v[sums["i"].to_numpy()] = np.round(sums["v"].to_numpy(), 3)
    w, seen, ones, every = np.split(v[:size], np.cumsum([GATES * INPUTS, GATES, GATES * STEPS]))
    w, seen = w.reshape(GATES, INPUTS), seen[:, None]
    weights = np.where(seen > 0, w / np.maximum(seen, 1), first_weights()).round(6)
    centre = _sigmoid(-12 + (np.arange(STEPS) + 0.5) * 24 / STEPS)
    refined = (ones.reshape(GATES, STEPS) + 4 * centre) / (every.reshape(GATES, STEPS) + 4)
    return Model.scoring_tables(n), weights, np.clip(refined, 1e-6, 1 - 1e-6), int(v[size]), int(v[size + 1])


def _grouped(docs: DataFrame, group_col: str | None, train) -> DataFrame:
    """Add ``group`` 0..GROUPS-1: the most frequent values of the column among the training rows, in order."""
    if group_col is None or group_col not in docs.columns:
        return docs.withColumn("group", F.lit(0))
    value = F.col(group_col).cast("string")
    top = (docs.where(train & value.isNotNull()).groupBy(value.alias("v")).agg(F.count("*").alias("n"))
           .orderBy(F.desc("n"), "v").limit(GROUPS - 1).collect())
    group = F.lit(0)
    for k, r in enumerate(top):
        group = F.when(value == r["v"], k + 1).otherwise(group)
    return docs.withColumn("group", F.coalesce(group, F.lit(0)))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang",
                    folds: int = 7, held_out: int = 2) -> DataFrame:
    """Per document ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Learns from the documents whose crc32(id) modulo ``folds`` is not ``held_out``.
    ``base_score`` is the add-one unigram score of the same tokens.
    """
    columns = documents(docs, id_col, text_col)
    total = text_bytes(columns)
    buckets, blocks = pieces(total, BUCKET_BYTES), pieces(total, BLOCK_BYTES)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias("doc_id")
    extra = [F.col(group_col).alias("_group")] if group_col in docs.columns else []
    d = docs.select(key, F.coalesce(F.col(text_col), F.lit("")).alias("text"), *extra)
    learns = salted_crc("doc_id", folds) != held_out
    training = _grouped(d, "_group", learns).where(learns).select("text", "group")
    table = _corpus_words(training, buckets).checkpoint()
    context_buckets = pieces(total, CONTEXT_BYTES)
    bits = min(63, total.bit_length() + SPARE_BITS)
    spoken, code = _group_table(table)
    states = d.sparkSession.sparkContext.broadcast(spoken)  # fixed size
    *fitted, n_train, n_distinct = train(table, buckets, code)
    shared = d.sparkSession.sparkContext.broadcast((*fitted, code))  # fixed size

    dealt = d.select("doc_id", "text").withColumn("held_out", salted_crc("doc_id", folds) == held_out).withColumn("block", block_of(blocks, "doc_id"))

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"])  # one order, so that sums and states agree with add_up
        texts, learned = list(pdf["text"]), ~pdf["held_out"].to_numpy(bool)
        rows, name = [], int(pdf["block"].iloc[0])
        for part, s in enumerate(_texts(texts)):
            words, tokens, _, n, pairs = _tokens(texts[s], states.value)
            # the lowest bit: from a training document
            own = np.repeat(learned[s], n).astype(np.uint64)
            keys = np.sort(np.concatenate([((k >> np.uint64(64 - bits)) << np.uint64(1)) | own for k in pairs]))
            at = runs(keys >> np.uint64(1))
            counts, keys = np.add.reduceat(keys & np.uint64(1), at), keys[at] >> np.uint64(1)
            order, names, at = _deal(words, tokens, buckets)
            rows += [(b, name, part, _pack(_name(words, tokens[i])), b"") for b, i in zip(names.tolist(), np.split(order, at[1:]))]
            rows += [(b, name, part, raw, c) for b, raw, c in _context_rows(keys, counts, context_buckets, bits)]
        return pd.DataFrame(rows, columns=["bucket", "block", "part", "words", "counts"])

    def reply(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        words, counts = [], np.empty(0, np.int64)
        if len(asked) and asked["bucket"].iloc[0] < 0:
            return _count_contexts(asked)
        if len(asked) and len(known):
            words, counts = _unpack(known["words"].iloc[0]), _from_planes(known["counts"].iloc[0], np.int64)
        sent = [_unpack(raw) for raw in asked["words"]]
        place = _Places()
        at = [np.fromiter(map(place.__getitem__, s), np.int64, len(s)) for s in sent]
        names = list(place)
        logs = Model(*shared.value).log10(names, words, counts).astype(np.float32)
        have: dict[bytes, int] = {}
        for w, n in zip(words, counts.tolist()):  # of the word in all states
            have[w[1:]] = have.get(w[1:], 0) + n
        c = np.fromiter((have.get(w[1:], 0) for w in names), np.int64, len(names))
        rows = [(block, part, bucket, _planes(logs[i]), _planes(c[i]))
                for block, part, bucket, i in zip(asked["block"], asked["part"], asked["bucket"], at)]
        return pd.DataFrame(rows, columns=["block", "part", "bucket", "logs", "counts"])

    def add_up(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in RESULT.split(", ")]
        if pdf.empty:
            return pd.DataFrame({c: [] for c in columns})
        pdf = pdf.sort_values(["doc_id", "text"])
        texts = list(pdf["text"])
        sums = np.zeros((3, len(texts)))
        n = np.empty(len(texts), np.int64)
        answers = answers.sort_values("bucket")
        for part, s in enumerate(_texts(texts)):
            words, tokens, code, n[s], contexts = _tokens(texts[s], states.value)
            order, _, _ = _deal(words, tokens, buckets)  # as asked for, bucket by bucket
            got = answers[answers["part"] == part]
            of_words = got["bucket"] >= 0
            logs, counts = np.empty(len(tokens)), np.empty(len(tokens), np.int64)
            logs[order] = np.concatenate([_from_planes(x, np.float32) for x in got["logs"][of_words]])
            counts[order] = np.concatenate([_from_planes(x, np.int64) for x in got["counts"][of_words]])
            base = np.log10((counts + 1) / (n_train + n_distinct + 1))
            n_keys = np.concatenate([_from_planes(x, "<u4") for x in got["counts"][~of_words][::-1]]).astype(np.int64)
            _, at = np.unique(np.concatenate(contexts) >> np.uint64(64 - bits), return_inverse=True)
            pair, triple = n_keys[at].reshape(2, -1)
            row = np.repeat(np.arange(s.start, s.stop), n[s])
            seen = counts[code]
            # a text starts as often as it ends
            p = interpolate((10.0 ** logs)[code], _after(seen, n[s], seen[n[s][0] - 1]), pair, triple, n[s])
            for k, v in enumerate((np.log10(p), base[code], seen > 0)):
                sums[k] += np.bincount(row, weights=v, minlength=len(texts))
        score = sums[0]
        size = np.array([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
        return pd.DataFrame({"doc_id": pdf["doc_id"].array, "held_out": pdf["held_out"].array, "n_tokens": n,
                             "n_known": np.rint(sums[2]).astype(np.int64),
                             "train_tokens": n_train, "base_score": sums[1], "score": score,
                             "bits_per_byte": -score / math.log10(2) / size})
    asked = dealt.groupBy("block").applyInPandas(ask, REQUEST)
    answers = asked.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInPandas(reply, REPLY)
    return restore_id(dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(add_up, RESULT))
