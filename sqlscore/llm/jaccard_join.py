"""Exact n-gram Jaccard join through a token-group matrix.

The set of a document: its distinct ``SHINGLE``-word shingles (fewer words: the whole
sequence as one). Two documents link when ``100 * |A & B| >= THRESHOLD * |A | B|``.

Method. Similar documents are put into *groups*; a group stores the union of its
members' tokens, and the token-group matrix says which groups hold which token. A
query document with n tokens needs ``ceil(THRESHOLD / 100 * n)`` common tokens with any
partner, so a group whose union holds fewer of its tokens has none and stays
closed; qualifying groups are opened and their members compared exactly.

1. *All other documents as one group.* A token in one document only is in no
   partner. Blocks ask the buckets which tokens several documents hold; a document
   with too few of them links with nothing and is finished. Equal sets become one
   node (they link with each other by definition).
2. *Groups.* Nodes with the same smallest token hash form a group, cut into chunks of
   ``CHUNK`` members; the smallest node of the group, its pivot, joins every chunk. All
   pairs of a chunk are compared; the links give first components, which join the
   chunks of a large group through the pivot.
3. *Matrix.* Components, again in chunks, are the groups now. Tokens are ordered by rarity
   (how often blocks asked for them, then the hash), tokens of one document first. Of two linked
   sets the smaller one, of m tokens, has ``2 * THRESHOLD * m / (100 + THRESHOLD)`` in common with the
   other, so it is entered under its few first tokens only, and the larger one, which needs
   ``THRESHOLD / 100`` of its own, looks up its first tokens: they share one. Sets of which too
   much is unshared have no such token left and are not entered at all. A node meets the groups
   of *other* components that hold a token it looks up, with a fitting size and enough shared tokens;
   the bound on the whole union decides which it opens.
4. The links of steps 2 and 3 give the components.

Only pairs that could still join two components are ever compared, so a group of
thousands of near copies costs the pairs inside its chunks. Hot tokens are split by
the shuffle join; a chunk has at most ``CHUNK`` members. Tokens that a bucket takes as
shared by mistake (one in ten thousand) only weaken the pruning. Nothing is capped.

Cases: null, empty and blank texts have the empty set and link with nothing; rows with equal
ids are nodes of their own (a component's name is its smallest id).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIN_ID, hash_words, hinted, mix64, restore_id, split_words, window_sums
from .components import connected_components
from .exchange import Layout, SharedLookup, runs, shared_keys

SHINGLE = 4
THRESHOLD = 85
CHUNK = 128
_BASE = 0x9E3779B97F4A7C15

FOUND = "doc_id long, n_shingles long, node long, size int, least long, tokens binary"


def need(n, threshold: int = THRESHOLD):
    """Common tokens that a set of n tokens needs with any partner."""
    return -(-threshold * n // 100)


def need_smaller(n, threshold: int = THRESHOLD):
    """Common tokens that a set of n tokens needs with any partner that is not smaller."""
    return -(-2 * threshold * n // (100 + threshold))


def linked(common, n, m, threshold: int = THRESHOLD):
    return 100 * common >= threshold * (n + m - common)


class _Sets:
    """The token sets of the rows of a block: sorted by (row, token), with bounds per row."""

    def __init__(self, pdf: pd.DataFrame, width: int):
        words, counts = split_words(list(pdf["text"]), fold=True)
        h = hash_words(words)[:, 0]
        ends = np.cumsum(counts)
        starts = ends - counts
        row = np.repeat(np.arange(len(counts)), counts)
        w = window_sums(h, width, _BASE)
        ok = (ends[row[:len(w)]] - np.arange(len(w))) >= width
        tokens, owner = [w[ok]], [row[:len(w)][ok]]
        for k in range(1, width):  # short documents: the whole sequence, with the length mixed in
            short = np.flatnonzero(counts == k)
            if len(short):
                acc = np.full(len(short), np.uint64(k))
                for j in range(k):
                    acc = mix64(acc ^ h[starts[short] + j])
                tokens.append(acc)
                owner.append(short)
        tokens, owner = np.concatenate(tokens), np.concatenate(owner)
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        if len(tokens):
            new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])])
            tokens, owner = tokens[new], owner[new]
        self.tokens, self.owner = tokens, owner
        self.sizes = np.bincount(owner, minlength=len(counts)).astype(np.int64)


def _ask(pdf: pd.DataFrame, width: int):
    s = _Sets(pdf, width)
    return s.tokens, s.owner


def _candidates(pdf: pd.DataFrame, answers: pd.DataFrame, buckets: int, width: int, threshold: int) -> pd.DataFrame:
    """A row per document (with its node, 0: finished), and one row per node of the block with its shared tokens."""
    import xxhash
    columns = [c.split()[0] for c in FOUND.split(", ")]
    if pdf.empty:
        return pd.DataFrame({c: [] for c in columns})
    s = _Sets(pdf, width)
    weights = SharedLookup(answers, buckets).weights(s.tokens)
    shared = np.bincount(s.owner, weights=weights > 0, minlength=len(pdf)).astype(np.int64)
    ends = np.cumsum(s.sizes)
    rows, seen = [], set()
    for i, (doc, n) in enumerate(zip(pdf["doc_id"], s.sizes.tolist())):
        if not n or shared[i] < need(n, threshold):
            rows.append((doc, n, 0, None, None, None))
            continue
        own = slice(int(ends[i] - n), int(ends[i]))
        node = xxhash.xxh3_64_intdigest(s.tokens[own].tobytes()) >> 1 or 1
        rows.append((doc, n, node, None, None, None))
        if node not in seen:
            seen.add(node)
            m = weights[own] > 0
            t = s.tokens[own][m]
            least = int(t[0] >> np.uint64(1))
            rows.append((None, None, node, n, least, t[np.lexsort((t, weights[own][m]))].tobytes()))  # rarest first
    out = pd.DataFrame(rows, columns=columns)
    for c in ("doc_id", "n_shingles", "size", "least"):
        out[c] = out[c].astype("Int64")
    return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


class _Postings:
    """Token -> members of one group, to count common tokens with all members at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        member = np.repeat(np.arange(self.n), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        self.member, tokens = member[order], tokens[order]
        at = runs(tokens)
        self.union, self.at = tokens[at], np.append(at, len(tokens))

    def overlap(self, query: np.ndarray) -> np.ndarray:
        """Places in the union of the query's tokens: their number bounds every member's overlap."""
        if not len(self.union):
            return np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        return k[self.union[k] == query]

    def counts(self, places: np.ndarray) -> np.ndarray:
        lengths = self.at[places + 1] - self.at[places]
        first = np.repeat(self.at[places] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(places) else np.empty(0, np.int64)
        return np.bincount(self.member[first + np.arange(len(first))], minlength=self.n)


def _load(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.sort(np.frombuffer(t, "<u8")) for t in pdf["tokens"]]


def _chunk_links(pdf: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Links among the members of one chunk: enough of them to connect what is connected."""
    pdf = pdf.drop_duplicates("node").sort_values("node")
    nodes, sizes, sets = pdf["node"].to_numpy(), pdf["size"].to_numpy(np.int64), _load(pdf)
    index = _Postings(sets)
    label = np.arange(len(nodes))
    a, b = [], []
    for i in range(len(nodes)):
        if (label == label[i]).all():
            break
        common = index.counts(index.overlap(sets[i]))
        for j in np.flatnonzero(linked(common, sizes[i], sizes, threshold)):
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                a.append(nodes[i])
                b.append(nodes[j])
    return pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _open_groups(group: pd.DataFrame, queries: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Links from the queries to members of one group of another component."""
    if group.empty or queries.empty:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    group, queries = group.sort_values("node"), queries.sort_values("node")
    nodes, sizes = group["node"].to_numpy(), group["size"].to_numpy(np.int64)
    index = _Postings(_load(group))
    a, b = [], []
    for q, n, t in zip(queries["node"], queries["size"].to_numpy(np.int64), _load(queries)):
        places = index.overlap(t)
        if len(places) < need(n, threshold):  # the bound: the group stays closed
            continue
        hit = np.flatnonzero(linked(index.counts(places), n, sizes, threshold))
        if len(hit):  # the members are of one component: one link is enough
            a.append(q)
            b.append(nodes[hit[0]])
    return pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _prefixes(batches, threshold: int):
    """(node, shared, token, entered) of the first tokens: those a node looks up, and whether it is entered under them."""
    for pdf in batches:
        parts = []
        for node, n, raw in zip(pdf["node"], pdf["size"].to_numpy(np.int64), pdf["tokens"]):
            t = np.frombuffer(raw, "<i8")
            k = max(0, len(t) - int(need(n, threshold)) + 1)
            entered = max(0, len(t) - int(need_smaller(n, threshold)) + 1)
            parts.append(pd.DataFrame({"node": node, "shared": len(t), "token": t[:k], "entered": np.arange(min(k, len(t))) < entered}))
        yield pd.concat(parts) if parts else pd.DataFrame({"node": [], "shared": [], "token": [], "entered": []})


def _chunks(rows: DataFrame, key: str) -> DataFrame:
    """Add ``chunk``: groups of ``key`` cut by the node's hash into pieces of about CHUNK members."""
    count = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return (rows.join(count, key)
            .withColumn("chunk", F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") / F.lit(CHUNK))).cast("int")).drop("_n"))


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: ``doc_id, n_shingles, node``; nodes: ``node, size, ...``; links ``a, b`` between nodes).

    ``node`` names the set of a document, 0 if no other document can link with it.
    """
    layout = Layout(docs, id_col, text_col, keys_per_byte=1 / 6)
    buckets = layout.buckets
    shared = shared_keys(layout, lambda pdf: _ask(pdf, shingle))
    found = layout.by_block().cogroup(shared.groupBy("block")).applyInPandas(
        lambda d, s: _candidates(d, s, buckets, shingle, threshold), FOUND).checkpoint()
    per_doc = found.where("doc_id is not null").select("doc_id", "n_shingles", "node")
    nodes = (found.where("size is not null").groupBy("node")
             .agg(*[F.first(c).alias(c) for c in ("size", "least", "tokens")]).checkpoint())

    # groups of similar nodes: links inside the chunks, which meet in the group's pivot
    members = nodes.select("node", "size", "tokens")
    pieces = _chunks(nodes.select("node", "least"), "least").checkpoint()  # ids only: a large group is cut before its tokens move
    whole = pieces.groupBy("least").agg(F.min("node").alias("node"), F.count("*").alias("_n")).where(F.col("_n") > CHUNK)
    whole = (whole.select("least", "node").join(pieces.select("least", "chunk").distinct(), "least")).checkpoint()
    pivots = members.join(hinted(whole), "node").select("least", "chunk", "node", "size", "tokens")
    first = (members.join(hinted(pieces), "node").select("least", "chunk", "node", "size", "tokens").unionByName(pivots)
             .groupBy("least", "chunk").applyInPandas(lambda pdf: _chunk_links(pdf, threshold), "a long, b long").checkpoint())
    groups = connected_components(first.unionByName(nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))))

    # the token-group matrix of the prefix tokens; nodes meet groups of other components
    placed = _chunks(nodes.select("node", "size").join(groups, "node"), "component").checkpoint()
    prefix = nodes.select("node", "size", "tokens").mapInPandas(
        lambda b: _prefixes(b, threshold), "node long, shared int, token long, entered boolean").join(placed, "node")
    entered = prefix.where("entered").groupBy("token", "component", "chunk").agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.max("shared").alias("most"))
    n, low, high = F.col("size"), F.col("low"), F.col("high")
    meets = (prefix.select("token", "node", "size", "shared", F.col("component").alias("_own")).join(entered, "token")
             .where((F.col("_own") != F.col("component")) & (n >= low) & (F.lit(100) * high >= F.lit(threshold) * n)
                    & (F.lit(100 + threshold) * F.least("shared", "most") >= F.lit(threshold) * (n + low)))
             .select("node", "component", "chunk").distinct().checkpoint())
    tokens = nodes.select("node", "size", "tokens")
    wanted = meets.select("component", "chunk").distinct()
    inside = placed.select("node", "component", "chunk").join(wanted, ["component", "chunk"]).checkpoint()
    queries = tokens.join(hinted(meets), "node")
    opened = tokens.join(hinted(inside), "node").select(*[F.col(c).alias(c) for c in ("component", "chunk", "node", "size", "tokens")])
    second = (opened.groupBy("component", "chunk").cogroup(queries.groupBy("component", "chunk"))
              .applyInPandas(lambda g, q: _open_groups(g, q, threshold), "a long, b long"))
    return per_doc, nodes, first.unionByName(second.checkpoint())


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id`` (the smallest id reachable by links)."""
    per_doc, nodes, links = join_documents(docs, id_col, text_col, **options)
    component = connected_components(links.unionByName(nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))))
    least = (per_doc.where("node != 0").groupBy("node").agg(F.min("doc_id").alias("_id")).join(component, "node"))
    name = least.groupBy("component").agg(F.min("_id").alias("component_id"))
    named = least.join(name, "component").select("node", "component_id")
    out = per_doc.join(named, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return restore_id(out.withColumn("component_id", F.when(F.col("component_id") != F.lit(MIN_ID), F.col("component_id"))))
