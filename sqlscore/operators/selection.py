"""Exact cuts, single rows and slices, found by counting instead of sorting.

Which row stands at a position of an order is found by descent: the rows are counted in at
most ``BINS`` buckets of the order, the running sum tells the bucket that holds the position, and
the next pass counts inside that bucket only, until it is small (``LEAF`` rows) or holds one value. Each
pass is an aggregate over the id or key column alone, combined in the task; at most ``BINS`` counts (``LEAF``
in the last pass) come back. What follows is a filter by a literal: the rows themselves are neither ranked, sorted nor written.

* :func:`hash_cut`, :func:`upto` — the first k rows in (hash, id) order;
* :func:`hash_row` — the row at a position of that order;
* :func:`slice_rows` — the rows at positions [start, end) of a key's order; the range filter reaches the scan.

Rows that tie at a boundary (equal id, equal key) are told apart by a hash of their content; only those
rows are ordered, and only if the boundary parts them. Null ids and keys stand first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import exact_positions

#: Hex digits (4096 buckets) of one level of the descent; rows at which it ends.
DIGITS, BINS, LEAF = 3, 1 << 12, 4096


def _holding(counts: list, before: int, target: int):
    """(row, rows before it) of the ordered counts that holds the 1-based ``target``, None beyond the last."""
    for row in counts:
        if before < target <= before + row["n"]:
            return row, before
        before += row["n"]
    return None


def _counted(rows: DataFrame, keys: list[Column], *more: Column) -> list:
    """Rows of each key, in the order of the keys, nulls first; the callers bound the number of keys."""
    names = [f"k{i}" for i in range(len(keys))]
    found = rows.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("n"), *more).collect()
    return sorted(found, key=lambda r: [(r[n] is not None, r[n]) if r[n] is not None else (False, 0) for n in names])


# ---- (hash, id) order ----------------------------------------------------------------------

@dataclass(frozen=True)
class Cut:
    """A pair of the order: ``less`` rows stand before it, ``same`` rows share it, ``take`` of them belong to the first part."""
    hash: str
    id: object
    kind: T.DataType
    less: int
    same: int
    take: int
    total: int

    def _pair(self) -> Column:
        return F.struct(F.lit(self.hash).alias("h"), F.lit(self.id).cast(self.kind).alias("i"))

    def before(self, hash_: Column, id_: Column) -> Column:
        """Rows before the pair (one comparison of pairs: the hash is computed once a row; nulls stand first)."""
        return F.struct(hash_.alias("h"), id_.alias("i")) < self._pair()

    def upto(self, hash_: Column, id_: Column) -> Column:
        """Rows up to the pair."""
        return F.struct(hash_.alias("h"), id_.alias("i")) <= self._pair()

    def at(self, hash_: Column, id_: Column) -> Column:
        """Rows that share the pair."""
        return id_.eqNullSafe(F.lit(self.id).cast(self.kind)) & (hash_ == F.lit(self.hash))


def hash_cut(df: DataFrame, id_col: str, hash_: Column, k: int | Callable[[int], int]) -> Cut | None:
    """Where the first ``k`` rows in (hash, id) order end; None if that is before the first row or there are fewer.

    ``hash_``: hex digits, uniform, the same for equal ids. ``k`` is a number, or made from the total.
    """
    keys = df.select(hash_.alias("h"), F.col(id_col).alias("i"))
    prefix, before, total = "", 0, None
    while True:
        inside = keys.where(F.col("h").startswith(prefix)) if prefix else keys
        counts = _counted(inside, [F.substring("h", len(prefix) + 1, DIGITS)], F.min("h").alias("lo"), F.max("h").alias("hi"))
        if total is None:
            total = sum(r["n"] for r in counts)
            target = k(total) if callable(k) else k
        held = _holding(counts, before, target)
        if held is None:
            return None
        row, before = held
        prefix += row["k0"]
        if row["n"] <= LEAF or row["lo"] == row["hi"]:
            break
    leaf = _counted(keys.where(F.col("h").startswith(prefix)), [F.col("h"), F.col("i")])
    row, before = _holding(leaf, before, target)
    return Cut(row["k0"], row["k1"], df.schema[id_col].dataType, before, row["n"], target - before, total)


def _some(equal: DataFrame, start: int, end: int) -> DataFrame:
    """Rows [start, end) of rows that tie, in the order of their content."""
    tagged = equal.withColumns({"_content": F.xxhash64(*[F.col(f"`{c}`") for c in equal.columns]), "_tie": F.monotonically_increasing_id()})
    placed = exact_positions(tagged, [F.col("_content"), F.col("_tie")], "_at")
    return placed.where((F.col("_at") >= start) & (F.col("_at") < end)).select(*equal.columns)


def upto(df: DataFrame, id_col: str, hash_: Column, cut: Cut, flag_col: str) -> DataFrame:
    """Add ``flag_col``: true for the rows up to the cut."""
    id_ = F.col(id_col)
    if cut.take == cut.same:
        return df.withColumn(flag_col, cut.upto(hash_, id_))
    ties = df.where(cut.at(hash_, id_))
    flagged = df.where(~cut.at(hash_, id_)).withColumn(flag_col, cut.before(hash_, id_))
    return (flagged.unionByName(_some(ties, 0, cut.take).withColumn(flag_col, F.lit(True)))
            .unionByName(_some(ties, cut.take, cut.same).withColumn(flag_col, F.lit(False))))


def hash_row(df: DataFrame, id_col: str, hash_: Column, position: int | Callable[[int], int]) -> DataFrame:
    """The row at the 0-based ``position`` of the (hash, id) order; no row if there are not as many."""
    k = (lambda total: position(total) + 1) if callable(position) else position + 1
    cut = hash_cut(df, id_col, hash_, k)
    if cut is None:
        return df.limit(0)
    row = df.where(F.col(id_col).eqNullSafe(F.lit(cut.id)) if cut.id is None else F.col(id_col) == F.lit(cut.id))
    return row if cut.same == 1 else _some(row.where(hash_ == F.lit(cut.hash)), cut.take - 1, cut.take)


# ---- order of a key ------------------------------------------------------------------------

def as_whole(df: DataFrame, col: str) -> tuple[Column, Callable[[int], Column]] | None:
    """The key as a whole number and the way back to a literal; None for other types."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(col).cast("long"), lambda x: F.lit(x).cast(kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(col)).cast("long"), lambda x: F.date_from_unix_date(F.lit(x).cast("int"))
    return None


def key_at(df: DataFrame, col: str, position: int, low: int, high: int) -> tuple[int, int, int]:
    """(key, rows with a smaller key, rows with this key) at a 0-based position of the non-null keys; keys lie in [low, high]."""
    key, literal = as_whole(df, col)
    keys = df.select(F.col(col)).where(F.col(col).isNotNull())
    before, target = 0, position + 1
    while True:
        width = (high - low) // BINS + 1
        inside = keys.where((F.col(col) >= literal(low)) & (F.col(col) <= literal(high)))
        # the span of long keys may exceed a long
        wide = [c.cast("decimal(20,0)") for c in (key, F.lit(low), F.lit(width))]
        bin_ = F.call_function("div", wide[0] - wide[1], wide[2])
        row, before = _holding(_counted(inside, [bin_.cast("long")]), before, target)
        low += row["k0"] * width
        high = min(high, low + width - 1)
        if width == 1:
            return low, before, row["n"]
        if row["n"] <= LEAF:
            break
    leaf = _counted(keys.where((F.col(col) >= literal(low)) & (F.col(col) <= literal(high))), [key])
    row, before = _holding(leaf, before, target)
    return row["k0"], before, row["n"]


def slice_rows(df: DataFrame, order_col: str, start: int, end: int, pos_col: str | None = None) -> DataFrame:
    """Rows at positions [start, end) in ascending order of ``order_col`` (nulls first, ties by content).

    ``pos_col`` adds the position, which orders the rows of the slice alone. Keys that are neither whole
    numbers nor dates are sorted by ranges instead.
    """
    whole = as_whole(df, order_col)
    if whole is None:
        placed = exact_positions(df, [F.col(order_col)], "_pos")
        out = placed.where((F.col("_pos") >= start) & (F.col("_pos") < end))
        return out.withColumnRenamed("_pos", pos_col) if pos_col else out.drop("_pos")
    key, literal = whole
    col = F.col(order_col)
    some = df.select(key.alias("k")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n"),
                                         F.count_if(F.col("k").isNull()).alias("nulls")).first()
    nulls, n = some["nulls"], some["n"]
    start = max(start, 0)
    parts = []
    if start < min(end, nulls):
        rows = df.where(col.isNull())
        parts.append(rows if start == 0 and end >= nulls else _some(rows, start, min(end, nulls)))
    s, e = max(start - nulls, 0), min(end - nulls, n)
    if s < e:
        first, less_f, n_f = key_at(df, order_col, s, some["lo"], some["hi"]) if s else (some["lo"], 0, None)
        last, less_l, n_l = key_at(df, order_col, e - 1, some["lo"], some["hi"]) if e < n else (some["hi"], None, None)
        from_first, to_last = s - less_f, None if less_l is None else e - less_l
        if first == last and (from_first or (to_last is not None and to_last < n_l)):
            parts.append(_some(df.where(col == literal(first)), from_first, e - less_f))
        else:
            low = col > literal(first) if from_first else col >= literal(first)
            high = col < literal(last) if to_last is not None and to_last < n_l else col <= literal(last)
            parts.append(df.where(low & high))
            if from_first:
                parts.append(_some(df.where(col == literal(first)), from_first, n_f))
            if to_last is not None and to_last < n_l:
                parts.append(_some(df.where(col == literal(last)), 0, to_last))
    if not parts:
        out = df.limit(0)
    else:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    if pos_col is None:
        return out
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = exact_positions(out, [col.asc_nulls_first(), content], "_pos")
    return placed.withColumn(pos_col, F.col("_pos") + F.lit(start)).drop("_pos")
