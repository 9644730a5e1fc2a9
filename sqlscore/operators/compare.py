"""Result-set comparison (X2–X6) over long tables of result rows.

Result rows arrive as ``(key..., side, row)`` where ``side`` is ``'gen'`` or
``'ref'`` and ``row`` is any groupable value (a bigint cell, or the
``array<string>`` of canonical cells from :mod:`sqlscore.functions.cells`).

Plan shape, chosen for skew: one pass over the rows; they are grouped by (key, row),
which spreads a key that holds a third of all rows over all tasks (distinct rows are
not combined before that shuffle), then by key on the counts. No per-key collect, no
window over a key, no pair enumeration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_counts(rows: DataFrame, keys: list[str], side_col: str = "side") -> DataFrame:
    """Rows per key and side: ``gen_rows``, ``ref_rows`` (bigint)."""
    return rows.groupBy(*keys).agg(
        F.count_if(F.col(side_col) == "gen").alias("gen_rows"),
        F.count_if(F.col(side_col) == "ref").alias("ref_rows"),
    )


def match_columns(gen_ok, ref_ok, gen_rows, ref_rows, inter, uni):
    """X2+X3 as columns: ``(exact_match, similarity)``.

    Either side failed → (false, 0.0). Different counts → (false,
    0.3·min/max, 0.0 if max is 0). Equal counts → set equality of distinct rows,
    similarity 1.0 when equal else |∩|/|∪|. Two empty results are equal.
    """
    both = gen_ok & ref_ok
    same_n = gen_rows == ref_rows
    inter = F.coalesce(inter, F.lit(0))
    uni = F.coalesce(uni, F.lit(0))
    sets_equal = inter == uni
    exact = both & same_n & sets_equal
    hi = F.greatest(gen_rows, ref_rows)
    lo = F.least(gen_rows, ref_rows)
    size_sim = F.when(hi > 0, lo / hi).otherwise(F.lit(0.0)) * F.lit(0.3)
    jac = F.when(uni > 0, inter / uni).otherwise(F.lit(0.0))
    sim = (
        F.when(~both, F.lit(0.0))
        .when(~same_n, size_sim)
        .when(sets_equal, F.lit(1.0))
        .otherwise(jac)
    )
    return exact, sim


def pair_stats(rows: DataFrame, keys: list[str], side_col: str = "side", row_col: str = "cell") -> DataFrame:
    """Counts and overlap per key in one pass over the rows.

    ``groupBy(key, row)`` counts each side (map-side combined), then ``groupBy(key)`` sums: ``gen_rows``,
    ``ref_rows``, ``inter`` (rows present on both sides) and ``uni`` (distinct rows on either side); for multisets
    ``bag_inter`` (sum of the smaller counts) and ``bag_uni`` (sum of the larger counts).
    """
    per_row = rows.groupBy(*keys, row_col).agg(
        F.count_if(F.col(side_col) == "gen").alias("_g"),
        F.count_if(F.col(side_col) == "ref").alias("_r"),
    )
    return per_row.groupBy(*keys).agg(
        F.sum("_g").alias("gen_rows"),
        F.sum("_r").alias("ref_rows"),
        F.count_if((F.col("_g") > 0) & (F.col("_r") > 0)).alias("inter"),
        F.count(F.lit(1)).alias("uni"),
        F.sum(F.least("_g", "_r")).alias("bag_inter"),
        F.sum(F.greatest("_g", "_r")).alias("bag_uni"),
    )


def compare_pairs(status: DataFrame, rows: DataFrame, keys: list[str], side_col: str = "side",
                  row_col: str = "cell", gen_ok: str = "gen_success", ref_ok: str = "ref_success",
                  multiset: bool = False) -> DataFrame:
    """X2/X3 for many pairs: ``status`` (one row per key with the two success
    flags) and the result rows → ``gen_rows, ref_rows, exact_match, similarity, empty_match``.

    The rows are read once (:func:`pair_stats`). A side with no rows counts 0, so "both empty" stays an exact
    match; ``empty_match`` tells these pairs apart. The rule compares sets of rows; ``multiset`` compares how
    often each row occurs instead (``[a, a, b]`` is then not ``[a, b, b]``), with the multiset Jaccard as similarity.
    """
    inter, uni = ("bag_inter", "bag_uni") if multiset else ("inter", "uni")
    stats = pair_stats(rows, keys, side_col, row_col).select(*keys, "gen_rows", "ref_rows", F.col(inter).alias("_inter"), F.col(uni).alias("_uni"))
    out = status.join(stats, keys, "left").withColumns({
        "gen_rows": F.coalesce(F.col("gen_rows"), F.lit(0)).cast("bigint"),
        "ref_rows": F.coalesce(F.col("ref_rows"), F.lit(0)).cast("bigint"),
    })
    exact, sim = match_columns(F.col(gen_ok), F.col(ref_ok), F.col("gen_rows"), F.col("ref_rows"), F.col("_inter"), F.col("_uni"))
    empty = F.col(gen_ok) & F.col(ref_ok) & (F.col("gen_rows") == 0) & (F.col("ref_rows") == 0)
    return out.withColumns({"exact_match": exact, "similarity": sim, "empty_match": empty}).drop("_inter", "_uni")


def ordered_match(rows: DataFrame, keys: list[str], side_col: str = "side", idx_col: str = "row_idx",
                  row_col: str = "cell") -> DataFrame:
    """Same rows in the same positions → 1/0 per key.

    Full outer join of the two sides on (key, row_idx), null-safe comparison of
    the rows, ``bool_and`` per key. The join key includes the row index, so a
    hot key is spread over many join keys.
    """
    g = rows.where(F.col(side_col) == "gen").select(*keys, idx_col, F.col(row_col).alias("_g"))
    r = rows.where(F.col(side_col) == "ref").select(*keys, idx_col, F.col(row_col).alias("_r"))
    j = g.join(r, [*keys, idx_col], "full_outer")
    same = F.col("_g").eqNullSafe(F.col("_r")) & F.col("_g").isNotNull()
    return j.groupBy(*keys).agg(F.bool_and(same).alias("ordered_match"))


def results_equal(status: DataFrame, rows: DataFrame, keys: list[str], side_col: str = "side",
                  idx_col: str = "row_idx", row_col: str = "cell", gen_ok: str = "gen_success",
                  ref_ok: str = "ref_success") -> DataFrame:
    """Strict list equality, false when either side failed.

    Pairs whose sides returned no rows at all are equal (two empty lists).
    """
    om = ordered_match(rows, keys, side_col, idx_col, row_col)
    out = status.join(om, keys, "left")
    eq = F.col(gen_ok) & F.col(ref_ok) & F.coalesce(F.col("ordered_match"), F.lit(True))
    return out.withColumn("results_equal", eq).drop("ordered_match")


def compare_results(gen: DataFrame, ref: DataFrame, gen_ok: bool = True, ref_ok: bool = True,
                    order_matters: bool = False, order_by: list[str] | None = None, multiset: bool = False) -> DataFrame:
    """Two DataFrames → one row ``exact_match, similarity, gen_rows, ref_rows``; ``multiset`` as in :func:`compare_pairs`.

    Columns are compared by position; rows become canonical cell arrays
    (1 = 1.0, NULL = NULL, 1 ≠ '1'). Unordered mode is the X2/X3 rule; ordered
    mode needs ``order_by`` (the same column names on both sides).
    """
    from ..functions.cells import row_cells
    from .ranking import exact_positions

    def long(df, side):
        # positional names: duplicate or differing column names compare by position
        pos = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
        keys = [F.col(f"_c{df.columns.index(c)}").alias(c) for c in (order_by or [])]
        return pos.select(F.lit(0).alias("_pair"), F.lit(side).alias("side"), row_cells(pos).alias("cells"), *keys)

    rows = long(gen, "gen").unionByName(long(ref, "ref"))
    status = rows.sparkSession.range(1).select(
        F.lit(0).alias("_pair"), F.lit(gen_ok).alias("gen_success"), F.lit(ref_ok).alias("ref_success"))
    if not order_matters:
        out = compare_pairs(status, rows, ["_pair"], row_col="cells", multiset=multiset)
        return out.select("exact_match", "similarity", "gen_rows", "ref_rows")
    if not order_by:
        raise ValueError("order_matters=True needs order_by columns")
    counts = side_counts(rows, ["_pair"]).join(status, "_pair")
    sides = []
    for side in ("gen", "ref"):
        part = rows.where(F.col("side") == side)
        sides.append(exact_positions(part, [F.col(c) for c in order_by], "row_idx"))
    ranked = sides[0].unionByName(sides[1])
    eq = results_equal(counts, ranked, ["_pair"], row_col="cells")
    exact = F.col("results_equal")
    return eq.select(exact.alias("exact_match"), F.when(exact, 1.0).otherwise(0.0).alias("similarity"),
                     "gen_rows", "ref_rows")
