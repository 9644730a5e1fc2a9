"""Hard negatives, packing and resampling against brute force on small inputs with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from sqlscore.llm import hard_negatives, packing, resampling

from pyspark.sql import functions as F

# ---- hard negatives ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, own string, v int, score double, bucket int"


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5, 3) for r in rows], VECTORS).repartition(3)


def brute_negatives(rows, is_anchor, positives=5, negatives=10, band=(30, 90), scale=256):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, v, lab) in enumerate(kept):
        if not is_anchor(i):
            continue
        scored = sorted(((-dot(v, w), j, other) for n, (j, w, other) in enumerate(kept) if n != k), key=lambda x: x[:2])
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            fits = [x for x in scored if x[2] != lab and band[0] * -s <= 100 * -x[0] <= band[1] * -s][:negatives]
            out += [(i, j, n, x[1], -s, -x[0]) for n, x in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    got = hard_negatives.mine(vector_table(spark, rows), F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_negatives_equal_brute_force(spark, spread):
    """Vectors of several lengths and sizes, ties, zero vectors; many small buckets and blocks."""
    rng = random.Random(int(spread * 100))
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(240):
        c = rng.choice(centres)
        stretch = rng.choice([0.05, 1, 1, 1, 30])
        rows.append((i, [stretch * (x + rng.gauss(0, spread)) for x in c][:rng.choice([6, 6, 6, 4])], rng.randrange(3)))
    rows += [(300 + k, list(rows[10][1]), k % 2) for k in range(12)]  # ties
    rows += [(400, [0.0] * 6, 1), (410, [], 1), (420, None, 1), (430, [1.0, None], 1), (440, [1.0, float("nan")], 1),
             (450, [float("inf")], 1), (460, [1.0], None), (None, [1.0], 1)]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert want
    assert mined(spark, rows, bucket_values=100, block_anchors=7) == want
    assert mined(spark, rows) == want


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 2 ** 20 for _ in range(3)], i % 2) for i in range(40)]
    assert mined(spark, rows) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor


def test_feasible_ranges_keep_every_row_that_reaches_the_score():
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * rng.normal(size=(500, 8)) * rng.choice([0.5, 1.0], size=(500, 1))).astype(np.int64)
    bucket = hard_negatives.Bucket(np.arange(500), np.arange(500), np.zeros(500, np.int64), vectors)
    pruned = 0
    for q in vectors[:60]:
        scores = bucket.scores(q.astype(float))
        norm = float(np.sqrt((q.astype(float) ** 2).sum()))
        for least in np.quantile(scores, [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]):
            rows = bucket.feasible(q / norm, np.argsort(-np.abs(q))[:4], norm, float(least))
            if rows is not None:
                assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
                pruned += 500 - len(rows)
    assert pruned > 5000


# ---- packing -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder()


def check_packing(rows, pieces, encoder, capacity=2048):
    """Every id in exactly one piece, sequences without gaps, crc of the ids, padding only where allowed."""
    by_row, by_sequence = {}, {}
    for p in pieces:
        by_row.setdefault(p["row_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    want = Counter((i, tuple(encoder.exact_ids(t or "").tolist()) + (1,)) for i, t in rows)
    got = Counter()
    for ps in by_row.values():
        ps.sort(key=lambda p: p["start"])
        ids = ()
        for p in ps:
            assert p["start"] == len(ids) and p["length"] > 0
            part = struct.unpack(f"<{p['length']}I", bytes(p["ids"]))
            ids += part
        assert {p["doc_tokens"] for p in ps} == {len(ids)}
        got[ps[0]["doc_id"], ids] += 1
    assert got == want
    padding = 0
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p["offset"])
        at = 0
        for p in ps:
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and {p["sequence_length"] for p in ps} == {at}
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing_of_documents(spark, encoder):
    rng = random.Random(8)
    words = ["alpha", "Beta", "naïve", "день", "12", "don't", "東京", "<|endoftext|>", "x\tq", "é", "\x1c!", "…", "𝛼𝛽", "͸"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 50, 700, 4000])))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a text without id"), (102, "a" * 9000), (103, " " * 5000 + "x"), rows[0], rows[0]]
    docs = spark.createDataFrame([(i, t, 5, "s") for i, t in rows], "doc_id long, text string, start int, ids string").repartition(3)
    for options in ({}, {"pool_tokens": 4096}):
        packed = packing.pack_documents(docs, **options)
        pieces = packed.collect()
        assert check_packing(rows, pieces, encoder) == 0
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["sequence_length"] + r["n_padding"] for r in whole)
    cut = sum(p["start"] > 0 for p in pieces if p["doc_tokens"] <= 2048)
    assert cut < len(rows) / 2  # most documents that fit a window stay whole


def test_query_of_packing_reads_whole_tables(spark, encoder):
    from sqlscore.llm.queries import QUERIES
    from conftest import SF001
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    pieces = QUERIES["op12_packing"](spark, SF001).collect()
    ids = {i: encoder.exact_ids(t or "").tolist() + [1] for i, t in docs}
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))
    for p in pieces:
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part)) and len(part) == p["length"]


def test_packing_of_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), capacity=1000)


def test_best_fill_equals_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        capacity = rng.randint(0, 70)
        sums = {0}
        for n in lengths:
            sums |= {s + n for s in sums if s + n <= capacity}
        chosen = packing.best_fill(dict(Counter(lengths)), capacity)
        assert sum(n * k for n, k in chosen) == max(sums)
        assert all(k <= lengths.count(n) for n, k in chosen)


def test_plain_characters_are_of_one_class(encoder):
    """Both libraries cut and encode every character of PLAIN alike, beside letters, digits, marks and blanks."""
    plain = [c for c in map(chr, range(0x10000)) if re.match(f"[{packing.PLAIN}]", c)]
    assert len(plain) > 30_000 and not any(0xD800 <= ord(c) < 0xE000 for c in plain)
    texts = ["".join(f"a{c}b {c}1{c}2 {c}!{c}? {c}{c}  {c}'s\n{c} {c}" for c in plain[n:n + 200]) for n in range(0, len(plain), 200)]
    for t in texts:
        assert encoder.quick_ids(t).tolist() == encoder.exact_ids(t).tolist()


# ---- resampling --------------------------------------------------------------------------

def brute_resample(docs, target, max_run=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(ws), [zlib.crc32(" ".join(ws[i:i + k]).encode()) % buckets for k in range(1, max_run + 1) for i in range(len(ws) - k + 1)]
    of = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in of for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets))))
    rows = []
    for (i, _), (n, f) in zip(docs, of):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], -2 ** 64 if r[0] is None else r[0]))
    for n, r in enumerate(enough[:percent * len(enough) // 100], 1):
        r[5] = n
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("max_run, head", [(1, 50_000), (1, 40), (2, 50_000), (2, 60), (3, 60), (3, 1)])
def test_resampling_equals_brute_force(spark, make_docs, corpus, max_run, head):
    """Any head gives the same buckets as the plain features."""
    docs = [(r[0], r[1]) for r in corpus] + [(2000, "ÄÖ Straße 12-34 " * 30), (2001, "word" * 40 + " b" * 25)]
    target = [r[1] for r in corpus[:12]] + [None, ""]
    texts = spark.createDataFrame([(n, t) for n, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(make_docs([(*r, "s") for r in docs]), texts, max_run=max_run, head=head, buckets=997, percent=40)
    want = brute_resample(docs, target, max_run, 997, percent=40)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str) == want
    assert any(r[5] for r in want)


def test_resampling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert resampling.resample(empty, empty).collect() == []
    got = {r["doc_id"]: r for r in resampling.resample(some, empty, min_words=0, percent=100).collect()}
    assert got[1]["weight"] == 0 and {got[1]["rank"], got[2]["rank"]} == {1, 2}


def test_head_is_the_frequent_words(spark):
    docs = spark.createDataFrame([(1, "a a a a b b c d e f"), (2, "a b " + "z" * 70 + " " + "z" * 70)], "doc_id long, text string")
    features = resampling.find_head(docs, max_run=2, head=5)  # 14 words: at least 2.8 times
    assert features.words == {b"a": zlib.crc32(b"a"), b"b": zlib.crc32(b"b")}
    assert features.pairs == {(b"a", b"a"): zlib.crc32(b"a a")}
