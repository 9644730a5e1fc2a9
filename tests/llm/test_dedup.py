"""Substring dedup, line dedup and Jaccard join against brute force on a small corpus."""

import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sqlscore.llm import jaccard_join, line_dedup, substring_dedup
from sqlscore.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = -(2 ** 63)


def words(text):
    return WORD.findall(text or "")


def order(i):
    return LOW if i is None else i


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) if not isinstance(x, list) else (True, str(x)) for x in r))


def brute_substrings(rows):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, t, *_ in rows:
        w, gone = words(t), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < order(i):
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def key_of(rows):
    return sorted(rows, key=lambda r: (order(r[0]), str(r[1:])))


def test_substrings_match_brute_force(make_docs, corpus):
    got = substring_dedup.dedup_substrings(make_docs(corpus)).select("doc_id", "n_words", "n_removed", "kept_text")
    assert key_of([tuple(r) for r in got.collect()]) == key_of(brute_substrings(corpus))
    assert sum(r[2] for r in brute_substrings(corpus)) > 1000


def test_removed_spans_cover_the_removed_words(make_docs, corpus):
    for r in substring_dedup.dedup_substrings(make_docs(corpus)).collect():
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_difference_cover_property():
    for i in range(7):
        for j in range(7):
            assert any((i + k) % 7 in substring_dedup.COVER and (j + k) % 7 in substring_dedup.COVER for k in range(7))


@pytest.mark.parametrize("operator", [substring_dedup.dedup_substrings, line_dedup.dedup_lines, jaccard_join.link_components])
def test_empty_table(make_docs, operator):
    assert operator(make_docs([(1, "x")]).where("false")).collect() == []


def test_substrings_across_blocks(make_docs, corpus, monkeypatch):
    import sqlscore.llm.exchange as exchange
    init = exchange.Layout.__init__

    def tiny(self, docs, id_col, text_col, keys_per_byte, block_bytes=300):
        init(self, docs, id_col, text_col, keys_per_byte * 2000, block_bytes)
    monkeypatch.setattr(exchange.Layout, "__init__", tiny)
    got = substring_dedup.dedup_substrings(make_docs(corpus)).select("doc_id", "n_words", "n_removed", "kept_text")
    assert key_of([tuple(r) for r in got.collect()]) == key_of(brute_substrings(corpus))
    lines = line_dedup.dedup_lines(make_docs(corpus))
    assert key_of([tuple(r) for r in lines.collect()]) == key_of(brute_lines(corpus))
    assert components(make_docs, corpus) == brute_components(corpus, 4, 85)


def line_key(line):
    k = line.strip(" \t\n\r\x0b\x0c")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)


def brute_lines(rows, min_docs=3):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= 20:
                holders[line_key(x)].add(order(i))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(line_key(x), ())) < min_docs or max(holders[line_key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_lines_match_brute_force(make_docs, corpus):
    assert key_of([tuple(r) for r in line_dedup.dedup_lines(make_docs(corpus)).collect()]) == key_of(brute_lines(corpus))
    assert sum(r[2] for r in brute_lines(corpus)) >= 10


def test_line_rows_keep_all_columns(make_docs, corpus):
    docs = make_docs(corpus)
    out = line_dedup.dedup_rows(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = sorted(((i, t), s) for (i, _, _, t), (_, _, s) in zip(brute_lines(corpus), corpus) if i is not None and s is not None)
    got = sorted(((r["doc_id"], r["text"]), r["source"]) for r in out.collect() if r["doc_id"] is not None and r["source"] is not None)
    assert got == want


def test_line_key_length_counts_code_points(make_docs):
    short, long = "é" * 19, "é" * 20
    rows = [(k, f"{short}\n{long}\n{'z' * 200_000}") for k in range(3)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(make_docs(rows)).collect()}
    assert got == {0: 2, 1: 2, 2: 0}


def test_index_insert_and_delete_are_reversible(make_docs, corpus):
    rows = [r for r in corpus if r[0] is not None]
    ids = sorted({r[0] for r in rows})
    extra = set(ids[::2])
    base = make_docs([r for r in rows if r[0] not in extra])
    more = make_docs([r for r in rows if r[0] in extra])
    index = line_dedup.LineIndex.build(base)
    before = [tuple(map(bytes, r[1:])) for r in sorted(index.shards().collect())]
    grown = index.insert(more)
    assert key_of([tuple(r) for r in grown.dedup(make_docs(rows)).collect()]) == key_of(brute_lines(rows))
    back = grown.delete(more.select("doc_id"))
    assert [tuple(map(bytes, r[1:])) for r in sorted(back.shards().collect())] == before


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=800))
def test_cuckoo_filter(keys):
    keys = np.array(sorted(keys), np.uint64)
    f = line_dedup.CuckooFilter.of(keys)
    assert f.contains(keys).all()
    f.delete(keys[::2])
    assert f.contains(keys[1::2]).all()
    assert int((f.tags != 0).sum()) == len(keys[1::2])
    assert line_dedup.CuckooFilter.load(f.dump()).contains(keys[1::2]).all()


def test_cuckoo_filter_has_few_false_positives():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2 ** 64, 50_000, dtype=np.uint64)
    f = line_dedup.CuckooFilter.of(np.unique(keys))
    assert f.contains(rng.integers(0, 2 ** 64, 50_000, dtype=np.uint64)).mean() < 0.002


def shingle_set(text, width):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < width else (tuple(w[k:k + width]) for k in range(len(w) - width + 1)))


def brute_components(rows, width, threshold):
    sets = [shingle_set(r[1], width) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), 2 ** 63), order(r[0]))
    return sorted((order(r[0]), len(sets[k]), least[find(k)]) for k, r in enumerate(rows))


def components(make_docs, rows, **options):
    got = jaccard_join.link_components(make_docs(rows), **options).collect()
    return sorted((order(r["doc_id"]), r["n_shingles"], order(r["component_id"])) for r in got)


def test_components_match_brute_force(make_docs, corpus):
    assert components(make_docs, corpus) == brute_components(corpus, 4, 85)
    assert components(make_docs, corpus, shingle=5, threshold=80) == brute_components(corpus, 5, 80)


def test_components_with_tiny_chunks(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 3)
    assert components(make_docs, corpus) == brute_components(corpus, 4, 85)


def test_threshold_is_inclusive(make_docs):
    a = [f"w{k}" for k in range(103)]  # 100 shingles of 4 words
    b = a[:-8] + [f"x{k}" for k in range(8)]  # 92 words shared: 92 of 108 shingles common
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[:-1]))]
    assert components(make_docs, rows) == brute_components(rows, 4, 85)


def test_connected_components_of_a_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001), (5000, 5000)], "a long, b long")
    got = dict(tuple(r) for r in connected_components(edges).collect())
    assert got == {**{k: 0 for k in range(n + 1)}, 1000: 1000, 1001: 1000, 5000: 5000}
