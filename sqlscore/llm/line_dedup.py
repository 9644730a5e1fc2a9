"""Line dedup over sharded cuckoo filters backed by exact reference-count tables.

The key of a line is the line without blanks at both ends, A-Z in lower case; keys
shorter than ``MIN_CHARS`` code points never count. A key that at least ``MIN_DOCS``
documents hold is *repeated*: its lines are dropped everywhere but in the document
with the largest id.

State. Keys are dealt into shards by their 128-bit hash. A shard holds an exact
table (key, documents that hold it, largest id) and a cuckoo filter with the
repeated keys. Documents are inserted and deleted in any order; the filter follows:
a key enters it when its count reaches ``MIN_DOCS`` and leaves it when the count falls
below. A line is looked up in the filter first; only a hit (repeated, or one of few
false positives) is looked up in the table. So the result never depends on a false
positive, and after deleting what was inserted all is as before.

* :func:`block_counts`: per block of documents and shard, the distinct keys with the
  number of documents and the largest id inside the block. A key in every document
  reaches its shard once per block, whatever its share of the rows.
* :class:`LineIndex`: the postings (block, document, keys) as a table of its own, so that
  deletion needs no texts; ``insert`` adds documents, ``delete`` takes ids out, ``shards``
  gives tables and filters, ``repeated`` answers the blocks.
* :func:`dedup_lines`: the lines that stay, for the documents of a table.

Cases: a null or empty text is one empty line; rows with equal ids count as one
document; blank lines and short lines always stay; a null id counts as the smallest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import MIN_ID, block_of, documents, mix64, restore_id
from .exchange import Layout, runs, split_buckets

MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = b" \t\n\r\x0b\x0c"

COUNTS = "shard int, block int, first binary, second binary, docs binary, largest binary"
SHARD = "shard int, filter binary, first binary, second binary, docs binary, largest binary"
ANSWER = "block int, first binary, second binary, largest binary"
POSTINGS = "block int, doc_id long, first binary, second binary"
RESULT = "doc_id long, n_lines long, n_dropped long, kept_text string"


class CuckooFilter:
    """Set of 64-bit keys with deletion: buckets of four 16-bit tags, two places a key.

    All operations work on arrays. The table grows by doubling (the caller passes the keys
    again), so insertion never fails.
    """

    SLOTS = 4

    def __init__(self, buckets: int):
        self.tags = np.zeros((1 << max(1, int(buckets - 1).bit_length()), self.SLOTS), np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> "CuckooFilter":
        size = max(2, len(keys) // 3)
        while True:
            f = cls(size)
            if f.insert(keys):
                return f
            size *= 2

    @classmethod
    def load(cls, raw: bytes) -> "CuckooFilter":
        f = cls(2)
        f.tags = np.frombuffer(raw, "<u2").reshape(-1, cls.SLOTS).copy()
        return f

    def dump(self) -> bytes:
        return self.tags.astype("<u2").tobytes()

    def _places(self, keys):
        mask = np.uint64(len(self.tags) - 1)
        tag = (keys >> np.uint64(48)).astype(np.uint16)
        tag = np.where(tag == 0, 1, tag).astype(np.uint16)
        return tag, mix64(keys) & mask

    def _other(self, place, tag):
        return (place ^ mix64(tag.astype(np.uint64))) & np.uint64(len(self.tags) - 1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        tag, one = self._places(keys)
        two = self._other(one, tag)
        return (self.tags[one] == tag[:, None]).any(1) | (self.tags[two] == tag[:, None]).any(1)

    def insert(self, keys: np.ndarray, rounds: int = 500) -> bool:
        """Insert distinct keys; False if the table is too full (its content is then undefined)."""
        tag, place = self._places(keys)
        for turn in range(rounds):
            for _ in range(2):  # free slots of one place, then of the other
                if not len(tag):
                    return True
                order = np.argsort(place, kind="stable")
                tag, place = tag[order], place[order]
                at = runs(place)
                rank = np.arange(len(place)) - np.repeat(at, np.diff(np.append(at, len(place))))
                free = self.tags[place] == 0
                fits = rank < free.sum(1)
                slot = (np.cumsum(free, 1) == (rank + 1)[:, None]).argmax(1)
                self.tags[place[fits], slot[fits]] = tag[fits]
                tag, place = tag[~fits], place[~fits]
                place = self._other(place, tag)
            if not len(tag):
                return True
            at = runs(place) if (place[1:] >= place[:-1]).all() else np.unique(place, return_index=True)[1]
            slot = (turn + tag[at]) % self.SLOTS  # evict one tag of each place still wanted
            out = self.tags[place[at], slot].copy()
            self.tags[place[at], slot] = tag[at]
            tag[at] = out
            place[at] = self._other(place[at], out)
            keep = tag != 0
            tag, place = tag[keep], place[keep]
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Delete keys that are in the set, one by one (equal tags share slots)."""
        tag, one = self._places(keys)
        two = self._other(one, tag)
        for t, a, b in zip(tag, one, two):
            for p in (a, b):
                hit = np.flatnonzero(self.tags[p] == t)
                if len(hit):
                    self.tags[p, hit[0]] = 0
                    break


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def _text_keys(text: str) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and the 16-byte key hash of each (None: too short to count)."""
    import xxhash
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        k = line_key(line)
        long = len(k) >= MIN_CHARS and (len(k) >= 4 * MIN_CHARS or len(k.decode("utf-8", "surrogatepass")) >= MIN_CHARS)
        keys.append(xxhash.xxh3_128_digest(k) if long else None)
    return lines, keys


def _columns(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    table = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return mix64(table[:, 0]), table[:, 1].copy()


def _group(a, b, docs, largest):
    """Add up the counts of equal keys and take the largest id: sorted distinct keys."""
    order = np.lexsort((b, a))
    a, b, docs, largest = a[order], b[order], docs[order], largest[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else runs(a)
    if not len(at):
        return a, b, docs, largest
    return a[at], b[at], np.add.reduceat(docs, at), np.maximum.reduceat(largest, at)


def _count_rows(block: int, a, b, ids, shards: int) -> pd.DataFrame:
    """Messages of one block from its (key, id) pairs, in any order and with repetitions."""
    order = np.lexsort((ids, b, a))
    a, b, ids = a[order], b[order], ids[order]
    if len(a):
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (ids[1:] != ids[:-1])])
        a, b, ids = a[new], b[new], ids[new]
    a, b, n, largest = _group(a, b, np.ones(len(a), np.int64), ids)
    rows = [(s, block, a[c].tobytes(), b[c].tobytes(), n[c].tobytes(), largest[c].tobytes()) for s, c in split_buckets(a, shards)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in COUNTS.split(", ")])


def _block_pairs(pdf: pd.DataFrame):
    keys, ids = [], []
    for i, text in zip(pdf["doc_id"], pdf["text"]):
        own = {k for k in _text_keys(text)[1] if k is not None}
        keys += own
        ids += [i] * len(own)
    a, b = _columns(keys)
    return a, b, np.array(ids, np.int64)


def block_counts(layout: Layout) -> DataFrame:
    """Per block and shard: the block's keys, the documents in the block that hold each, the largest id."""
    shards = layout.buckets

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        return _count_rows(int(pdf["block"].iloc[0]), *_block_pairs(pdf), shards)
    return layout.by_block().applyInPandas(count, COUNTS)


def _load(pdf: pd.DataFrame):
    def column(name, kind):
        return [np.frombuffer(x, kind) for x in pdf[name]]
    return column("first", "<u8"), column("second", "<u8"), column("docs", "<i8"), column("largest", "<i8")


def _shard_table(pdf: pd.DataFrame, min_docs: int):
    a, b, n, top = _group(*(np.concatenate(x) for x in _load(pdf)))
    return a, b, n, top, CuckooFilter.of(a[n >= min_docs])


def _shard_rows(pdf: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    a, b, n, top, f = _shard_table(pdf, min_docs)
    return pd.DataFrame([(int(pdf["shard"].iloc[0]), f.dump(), a.tobytes(), b.tobytes(), n.tobytes(), top.tobytes())],
                        columns=[c.split()[0] for c in SHARD.split(", ")])


def _answer(pdf: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    """To every block: its keys that are repeated, and the largest id that holds each."""
    a, b, n, top, f = _shard_table(pdf, min_docs)
    rows = []
    for block, x, y in zip(pdf["block"], *_load(pdf)[:2]):
        hit = f.contains(x)  # most keys end here
        x, y = x[hit], y[hit]
        k = np.searchsorted(a, x)
        while True:  # equal first halves stand in order of the second
            off = (a[k] == x) & (b[k] != y)
            if not off.any():
                break
            k = k + off
        m = n[k] >= min_docs  # the table decides
        if m.any():
            rows.append((block, x[m].tobytes(), y[m].tobytes(), top[k][m].tobytes()))
    return pd.DataFrame(rows, columns=["block", "first", "second", "largest"])


def repeated_keys(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    return counts.groupBy("shard").applyInPandas(lambda pdf: _answer(pdf, min_docs), ANSWER)


def _keep(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The lines that stay, of every document of a block."""
    columns = [c.split()[0] for c in RESULT.split(", ")]
    if pdf.empty:
        return pd.DataFrame({c: [] for c in columns})
    drop: dict[tuple[int, int], int] = {}
    for x, y, top in zip(answers["first"], answers["second"], answers["largest"]):
        drop.update(zip(zip(np.frombuffer(x, "<u8").tolist(), np.frombuffer(y, "<u8").tolist()), np.frombuffer(top, "<i8").tolist()))
    rows = []
    for i, text in zip(pdf["doc_id"], pdf["text"]):
        lines, keys = _text_keys(text)
        counted = [k for k, key in enumerate(keys) if key is not None]
        gone = set()
        if counted and drop:
            a, b = _columns([keys[k] for k in counted])
            gone = {k for k, pair in zip(counted, zip(a.tolist(), b.tolist())) if drop.get(pair, i) != i}
        kept = lines if not gone else [x for k, x in enumerate(lines) if k not in gone]
        rows.append((i, len(lines), len(gone), b"\n".join(kept).decode("utf-8", "surrogatepass")))
    return pd.DataFrame(rows, columns=columns)


def _keep_rows(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of a block with the lines that stay as ``text``; the other columns are handed through as they are."""
    kept = _keep(rows.select(["doc_id", "text"]).to_pandas(), answers.to_pandas())["kept_text"]
    names = [c for c in rows.column_names if c not in ("doc_id", "text", "block")]
    text = pa.array(list(kept), pa.string()).cast(rows.schema.field("text").type)
    return pa.table([text, *(rows[c] for c in names)], names=["text", *names])


def _layout(docs: DataFrame, id_col: str, text_col: str) -> Layout:
    return Layout(docs, id_col, text_col, keys_per_byte=1 / 100)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_dropped, kept_text``."""
    layout = _layout(docs, id_col, text_col)
    answers = repeated_keys(block_counts(layout), min_docs)
    return restore_id(layout.by_block().cogroup(answers.groupBy("block")).applyInPandas(_keep, RESULT))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns, with the lines that stay as text (a null text becomes empty)."""
    layout = _layout(docs, id_col, text_col)
    answers = repeated_keys(block_counts(layout), min_docs)
    others = {f"c{n}": f for n, f in enumerate(docs.schema.fields) if f.name != text_col}  # names that clash with nothing
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(f"`{f.name}`").alias(n) for n, f in others.items()])
    rows = rows.withColumn("block", block_of(layout.blocks, "doc_id"))
    schema = StructType([StructField("text", StringType()), *(StructField(n, f.dataType) for n, f in others.items())])
    kept = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_keep_rows, schema)
    named = {f.name: n for n, f in others.items()}
    return kept.select(*[F.col("text" if c == text_col else named[c]).alias(c) for c in docs.columns])


class LineIndex:
    """Postings of the documents inserted so far, one row a document, dealt into blocks by the id.

    The postings are an ordinary table (write it, read it, partition it by block); all methods
    return a new index over a new DataFrame.
    """

    def __init__(self, postings: DataFrame, blocks: int, shards: int, min_docs: int = MIN_DOCS):
        self.postings, self.blocks, self.shards_n, self.min_docs = postings, blocks, shards, min_docs

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> "LineIndex":
        layout = _layout(docs, id_col, text_col)
        return cls(cls._postings(layout.docs), layout.blocks, layout.buckets, min_docs)

    @staticmethod
    def _postings(blocked: DataFrame) -> DataFrame:
        def rows(batches):
            for pdf in batches:
                out = []
                for block, i, text in zip(pdf["block"], pdf["doc_id"], pdf["text"]):
                    a, b = _columns(sorted({k for k in _text_keys(text)[1] if k is not None}))
                    out.append((block, i, a.tobytes(), b.tobytes()))
                yield pd.DataFrame(out, columns=["block", "doc_id", "first", "second"])
        return blocked.select("block", "doc_id", "text").mapInPandas(rows, POSTINGS)

    def _with(self, postings: DataFrame) -> "LineIndex":
        return LineIndex(postings, self.blocks, self.shards_n, self.min_docs)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> "LineIndex":
        new = documents(docs, id_col, text_col).withColumn("block", block_of(self.blocks, "doc_id"))
        return self._with(self.postings.unionByName(self._postings(new)))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> "LineIndex":
        gone = ids.select(F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_ID)).alias("doc_id")).distinct()
        return self._with(self.postings.join(gone, "doc_id", "left_anti").select(*[c.split()[0] for c in POSTINGS.split(", ")]))

    def counts(self) -> DataFrame:
        shards = self.shards_n

        def count(pdf: pd.DataFrame) -> pd.DataFrame:
            a = [np.frombuffer(x, "<u8") for x in pdf["first"]]
            ids = np.repeat(pdf["doc_id"].to_numpy(np.int64), [len(x) for x in a])
            b = np.concatenate([np.frombuffer(x, "<u8") for x in pdf["second"]])
            return _count_rows(int(pdf["block"].iloc[0]), np.concatenate(a), b, ids, shards)
        return self.postings.groupBy("block").applyInPandas(count, COUNTS)

    def shards(self) -> DataFrame:
        """One row a shard: the cuckoo filter of the repeated keys and the exact table."""
        least = self.min_docs
        return self.counts().groupBy("shard").applyInPandas(lambda pdf: _shard_rows(pdf, least), SHARD)

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """:func:`dedup_lines` for documents of the index, judged by all documents of the index."""
        d = documents(docs, id_col, text_col).withColumn("block", block_of(self.blocks, "doc_id"))
        answers = repeated_keys(self.counts(), self.min_docs)
        return restore_id(d.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_keep, RESULT))
