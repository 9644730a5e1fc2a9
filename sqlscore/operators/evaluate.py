"""Evaluation aggregates (E1–E3, M1) and the success predicates (V7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import PERFECT_THRESHOLD, SUCCESS_THRESHOLD


def explode_generations(df: DataFrame, generated: str = "generated", out: str = "completion",
                        idx: str = "gen_idx") -> DataFrame:
    """One sample with an array of generations → one row per generation."""
    others = [c for c in df.columns if c != generated]
    return df.select(*others, F.posexplode(F.col(generated)).alias(idx, out))


#: Names the text of a scored row where the text itself is left behind.
DIGEST = "_gen_digest"


def text_digest(generation: str = "completion") -> Column:
    return F.unhex(F.md5(F.col(generation)))


def sample_rewards(scored: DataFrame, sample_key: list[str], score: str = "score", gen_idx: str = "gen_idx",
                   keep_lists: bool = False, generation: str = "completion", generations: DataFrame | None = None) -> DataFrame:
    """Best and mean reward per sample (and generation count).

    ``keep_lists`` adds the rewards and the generations in generation order, as
    the per-sample detail record holds them; lists are bounded by the number of
    generations per sample, which is a job parameter. With ``generations`` (a row
    per scored row) the texts are taken from there: see :func:`_with_texts_apart`.
    """
    if keep_lists and generations is not None:
        return _with_texts_apart(scored, generations, sample_key, score, gen_idx, generation)
    mean = F.avg(score)
    aggs = [F.max(score).alias("best_reward"),
            mean.alias("mean_reward"),
            F.count(F.lit(1)).alias("num_generations")]
    if keep_lists:
        text = F.col(generation) if generation in scored.columns else F.lit(None).cast("string")
        ordered = F.array_sort(F.collect_list(F.struct(F.col(gen_idx).alias("i"), F.col(score).alias("r"), text.alias("g"))))
        if generation in scored.columns:
            aggs.append(F.transform(ordered, lambda x: x["g"]).alias("generated"))
        aggs.append(F.transform(ordered, lambda x: x["r"]).alias("rewards"))
    return scored.groupBy(*sample_key).agg(*aggs)


def _with_texts_apart(scored: DataFrame, generations: DataFrame, sample_key: list[str], score: str, gen_idx: str, generation: str) -> DataFrame:
    """E2 with its lists, for texts that do not pass through the scoring: a scored row names its text by ``DIGEST``.

    Scores and texts meet in the aggregate that makes the lists (no join, so null keys are a sample as in any grouping).
    Both lists are in the order of index and digest: the n-th reward is that of the n-th text, even where an index repeats.
    """
    at = [*sample_key, F.col(gen_idx).alias("i")]
    rows = scored.select(*at, F.col(DIGEST).alias("d"), F.col(score).alias("r"), F.lit(None).alias("g"), F.lit(True).alias("is_score")).unionByName(
        generations.select(*at, text_digest(generation).alias("d"), F.lit(None).alias("r"), F.col(generation).alias("g"), F.lit(False).alias("is_score")))

    def listed(which: Column, value: str) -> Column:
        return F.sort_array(F.collect_list(F.when(which, F.struct("i", "d", value)))).getField(value)
    is_score = F.col("is_score")
    return rows.groupBy(*sample_key).agg(F.max("r").alias("best_reward"), F.avg("r").alias("mean_reward"), F.count_if(is_score).alias("num_generations"),
                                         listed(~is_score, "g").alias("generated"), listed(is_score, "r").alias("rewards"))


def success_flags(best: str = "best_reward", success: float = SUCCESS_THRESHOLD,
                  perfect: float = PERFECT_THRESHOLD):
    """V7: strict ``> 0.5`` and ``> 0.95`` predicates on the best reward."""
    b = F.col(best)
    return b > F.lit(success), b > F.lit(perfect)


def evaluation_summary(per_sample: DataFrame, digits: int | None = None, success: float = SUCCESS_THRESHOLD,
                       perfect: float = PERFECT_THRESHOLD) -> DataFrame:
    """One row — sample count, generations per sample, mean and sample
    standard deviation of best and of mean rewards, success and perfect rates.

    A single global aggregate (partial per task, one small final merge).
    ``digits`` rounds the floats (their summation order is not fixed); by default
    they stay as they are.
    """
    ok, top = success_flags("best_reward", success, perfect)
    r = lambda c: c if digits is None else F.round(c, digits)
    return per_sample.agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.max("num_generations").alias("num_generations_per_sample"),
        r(F.avg("best_reward")).alias("best_reward_mean"),
        r(F.stddev_samp("best_reward")).alias("best_reward_std"),
        r(F.avg("mean_reward")).alias("mean_reward_mean"),
        r(F.stddev_samp("mean_reward")).alias("mean_reward_std"),
        r(F.avg(ok.cast("double"))).alias("success_rate"),
        r(F.avg(top.cast("double"))).alias("perfect_rate"),
    )


def reward_monitor(scored: DataFrame, group_cols: list[str], score: str = "score", digits: int | None = None) -> DataFrame:
    """M1: ``reward/mean`` and ``reward/std`` of generations per group (run, step …)."""
    r = lambda c: c if digits is None else F.round(c, digits)
    return scored.groupBy(*group_cols).agg(
        r(F.avg(score)).alias("reward_mean"),
        r(F.stddev_samp(score)).alias("reward_std"),
        F.count(F.lit(1)).alias("num_generations"),
    )


# ---- moments that can be added up -------------------------------------------------------

def moments(rewards: DataFrame, keys: list[str], value: str = "best_reward", success: float = SUCCESS_THRESHOLD,
            perfect: float = PERFECT_THRESHOLD) -> DataFrame:
    """The state of a run: per key ``n, mean, m2`` (sum of squared distances from the mean), ``n_success, n_perfect``.

    A few numbers per key, whatever the rows; states of any parts of the rows merge to that of all of them.
    """
    ok, top = success_flags(value, success, perfect)
    return rewards.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                      (F.var_pop(value) * F.count(value)).alias("m2"),
                                      F.count_if(ok).alias("n_success"), F.count_if(top).alias("n_perfect"))


def append_moments(state: DataFrame, path: str, run: str) -> None:
    """Add the state of one run to the table of states; a run that is written again replaces itself when merged."""
    state.withColumns({"run": F.lit(run), "written": F.current_timestamp()}).write.mode("append").parquet(path)


def merge_moments(states: DataFrame, keys: list[str], run_col: str = "run") -> DataFrame:
    """States of all runs as one per key: counts add up, ``mean`` is weighted, ``m2`` adds the distance of each mean.

    Of a run that was written more than once the latest state counts.
    """
    if run_col in states.columns and "written" in states.columns:
        last = F.max_by(F.struct("n", "mean", "m2", "n_success", "n_perfect"), "written").alias("s")
        states = states.groupBy(run_col, *keys).agg(last).select(*keys, "s.*")
    sums = [F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
            F.collect_list(F.struct("n", "mean", "m2")).alias("_parts"),  # one entry a run
            F.sum("n_success").alias("n_success"), F.sum("n_perfect").alias("n_perfect")]
    out = states.where("n > 0").groupBy(*keys).agg(*sums)
    far = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")))
    return out.withColumn("m2", far).drop("_parts")


def summary_of_moments(merged: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean, sample standard deviation, success and perfect rate of merged states."""
    r = lambda c: c if digits is None else F.round(c, digits)
    n = F.col("n")
    return merged.withColumns({"std": r(F.when(n > 1, F.sqrt(F.col("m2") / (n - 1)))), "success_rate": r(F.col("n_success") / n),
                               "perfect_rate": r(F.col("n_perfect") / n), "mean": r(F.col("mean"))}).drop("m2", "n_success", "n_perfect")
