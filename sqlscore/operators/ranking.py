"""Exact positions and exact first-k selection without a single-partition window.

* :func:`first_k_flag` — exact "first k rows in (hash, tie) order" for a
  uniformly distributed hex hash column. Rows are bucketed by the first hex
  characters of the hash; bucket counts (≤ 16^prefix rows, a bounded table)
  give cumulative offsets; only the one bucket that straddles ``k`` is ranked.
* :func:`exact_positions` — 0-based global position for any total order: a
  range-partitioned sort, per-partition counts, offsets broadcast back (one
  row per partition). The sorted, id-tagged data is checkpointed first so a
  retried or recomputed stage sees the same partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def seeded_hash(id_col, seed: int, salt: str = "") -> Column:
    """md5 hex of ``id:seed[:salt]`` — a reproducible, partitioning-independent order key."""
    parts = [F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(str(seed))]
    if salt:
        parts.append(F.lit(salt))
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def _bucket_offsets(df: DataFrame, bucket: Column) -> DataFrame:
    counts = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # bounded input: at most 16^prefix_len rows
    return counts.withColumn("_end", F.sum("_n").over(w)).select("_b", (F.col("_end") - F.col("_n")).alias("_start"), "_end")


def first_k_flag(df: DataFrame, hash_col: str, tie_col: str, k: int, flag_col: str,
                 prefix_len: int = 4) -> DataFrame:
    """Add boolean ``flag_col``: true for the first ``k`` rows ordered by (hash, tie)."""
    bucket = F.substring(F.col(hash_col), 1, prefix_len)
    d = df.withColumn("_b", bucket)
    offs = _bucket_offsets(d, F.col("_b"))
    j = d.join(F.broadcast(offs), "_b")
    straddle = (F.col("_start") < F.lit(k)) & (F.col("_end") > F.lit(k))
    plain = j.where(~straddle).withColumn(flag_col, F.col("_end") <= F.lit(k))
    w = Window.partitionBy("_b").orderBy(F.col(hash_col), F.col(tie_col))
    edge = j.where(straddle).withColumn(flag_col, (F.col("_start") + F.row_number().over(w)) <= F.lit(k))
    return plain.unionByName(edge).drop("_b", "_start", "_end")


def first_k(df: DataFrame, hash_col: str, tie_col: str, k: int, prefix_len: int = 4) -> DataFrame:
    """Exactly the first ``k`` rows in (hash, tie) order (all rows if fewer)."""
    return first_k_flag(df, hash_col, tie_col, k, "_keep", prefix_len).where("_keep").drop("_keep")


def hash_positions(df: DataFrame, hash_col: str, tie_col: str, out_col: str, prefix_len: int = 4) -> DataFrame:
    """0-based position of every row in (hash, tie) order.

    Ranks inside each hash bucket (≈ n / 16^prefix rows per window partition)
    plus the bucket's offset; uniform hashes keep the windows balanced.
    """
    bucket = F.substring(F.col(hash_col), 1, prefix_len)
    d = df.withColumn("_b", bucket)
    offs = _bucket_offsets(d, F.col("_b"))
    w = Window.partitionBy("_b").orderBy(F.col(hash_col), F.col(tie_col))
    ranked = d.join(F.broadcast(offs), "_b").withColumn(out_col, F.col("_start") + F.row_number().over(w) - 1)
    return ranked.drop("_b", "_start", "_end")


def exact_positions(df: DataFrame, order: list, out_col: str) -> DataFrame:
    """0-based global position of every row for an arbitrary total order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    counts = tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offs = counts.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).select("_p", "_off")
    local = F.col("_mid") - F.shiftleft(F.col("_p"), 33)
    out = tagged.withColumn("_p", part).join(F.broadcast(offs), "_p")  # one row per partition
    return out.withColumn(out_col, F.col("_off") + local).drop("_mid", "_p", "_off")


def group_positions(df: DataFrame, keys: list[str], order: list, out_col: str) -> DataFrame:
    """1-based position of every row inside its group, for any order and any group size.

    One range-partitioned sort by (keys, order); the position in the group is the
    global position minus the group's smallest one, so a group that holds most
    rows is spread over many partitions.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in (*keys, *order)]
    placed = exact_positions(df, cols, "_pos")
    first = placed.groupBy(*keys).agg(F.min("_pos").alias("_first"))
    return placed.join(first, keys).withColumn(out_col, F.col("_pos") - F.col("_first") + 1).drop("_pos", "_first")
