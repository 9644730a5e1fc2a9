"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (parquet: pushdown and pruning apply), listed anew on every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tasks_for(df: DataFrame, rows_per_task: int | None = None) -> int:
    """As many tasks as keep all cores at work; more, if these would get more than ``rows_per_task`` rows each."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return tasks if rows_per_task is None else max(tasks, -(-df.count() // rows_per_task))


def spread(df: DataFrame, *keys: str, rows_per_task: int | None = None) -> DataFrame:
    """The rows dealt evenly (by ``keys``, if given) over all cores, for narrow rows that many larger ones are made of.

    A scan has as many tasks as its files have splits, which a table of keys with few bytes a row has hardly any of; tasks
    after a shuffle of such rows are merged by their few bytes. ``rows_per_task`` counts the rows and adds tasks as they grow.
    """
    return df.repartition(tasks_for(df, rows_per_task), *keys)


def crowded(df: DataFrame, key: str, rows_per_task: int, tasks: int) -> DataFrame | None:
    """The keys that more than ``rows_per_task`` rows share (there is at most one to so many rows), one row each.

    None, if there are none or if dealing the rows by ``key`` gives none of ``tasks`` twice as many; this alone counts a few buckets only.
    """
    given = df.where(F.col(key).isNotNull())
    bucket = F.pmod(F.hash(key), F.lit(tasks))
    if (given.groupBy(bucket).count().agg(F.max("count")).first()[0] or 0) <= 2 * rows_per_task:
        return None
    keys = given.groupBy(key).count().where(F.col("count") > rows_per_task).select(key).checkpoint()
    return None if keys.isEmpty() else keys


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver tables as temp views (used by the SQL executor)."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def load_split(spark: SparkSession, path: str, split: str | None = None,
               fmt: str = "parquet", split_col: str = "split") -> DataFrame:
    """Read a persisted dataset; with ``split`` keep only that split.

    A dataset written by :func:`write_splits` is partitioned by ``split`` so the
    filter prunes whole directories.
    """
    df = spark.read.format(fmt).load(path)
    if split is not None:
        df = df.where(F.col(split_col) == F.lit(split))
    return df


def from_records(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A dataset from in-memory column lists (``question/context/answer`` ...).

    For small, hand-written datasets only; large inputs belong in files.
    """
    names = list(columns)
    lengths = {len(v) for v in columns.values()}
    if len(lengths) > 1:
        raise ValueError("all columns must have the same length")
    rows = list(zip(*(columns[n] for n in names)))
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema=schema)


def map_fields(df: DataFrame, mapping: dict[str, str], keep_others: bool = False) -> DataFrame:
    """S3: rename source fields to ``prompt/answer/context`` (``{source: target}``)."""
    missing = [s for s in mapping if s not in df.columns]
    if missing:
        raise ValueError(f"Missing source fields: {missing}")
    renamed = [F.col(s).alias(t) for s, t in mapping.items()]
    others = [c for c in df.columns if c not in mapping and c not in mapping.values()] if keep_others else []
    return df.select(*renamed, *others)


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """Persist a split dataset partitioned by its split column."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def write_eval_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the one-row evaluation summary as JSON without the detail rows."""
    cols = [c for c in summary.columns if c != "detailed_results"]
    summary.select(*cols).coalesce(1).write.mode(mode).json(path)


def write_evaluation(records: DataFrame, summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S4 in full: the detail rows as Parquet under ``details``, the summary without them as JSON under ``summary``."""
    records.write.mode(mode).parquet(f"{path}/details")
    write_eval_summary(summary, f"{path}/summary", mode)


def write_shuffled(df: DataFrame, id_col: str, path: str, shards: int, seed: int = 42, mode: str = "overwrite") -> None:
    """R1/S1 on disk: the rows in seeded shuffle order, range-partitioned by the hash into ``shards`` files, sorted inside.

    The files' names are in the order of their ranges, so reading them in name order gives the shuffle.
    """
    from ..operators.dataset import SHUFFLE_SALT
    from ..operators.ranking import seeded_hash
    h = seeded_hash(id_col, seed, SHUFFLE_SALT)
    order = [h, F.col(id_col)]
    df.repartitionByRange(shards, *order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def read_shuffled(spark: SparkSession, path: str, pos_col: str = "shuffle_pos") -> DataFrame:
    """The rows of :func:`write_shuffled` with their position: the row's place in its file and the rows of the files before.

    The files' sizes are counted once; a running sum over them (one row a file) gives the offsets.
    """
    rows = spark.read.parquet(path)
    file = F.col("_metadata.file_name")
    sizes = rows.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    at = rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_place"))
    return at.join(F.broadcast(offsets), "_file").withColumn(pos_col, F.col("_before") + F.col("_place")).drop("_file", "_place", "_before")


def read_json(spark: SparkSession, path: str, schema: str, bad_col: str = "bad_line") -> DataFrame:
    """S1 from JSON lines with a declared schema: a line that does not fit keeps its text in ``bad_col``, its fields are null.

    Nothing is inferred (no pass over the files before the read) and no line is dropped.
    """
    return spark.read.schema(f"{schema}, `{bad_col}` string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_col).json(path)


def split_bad(df: DataFrame, bad_col: str = "bad_line") -> tuple[DataFrame, DataFrame]:
    """(rows that were read, texts of the lines that were not)."""
    return df.where(F.col(bad_col).isNull()).drop(bad_col), df.where(F.col(bad_col).isNotNull()).select(bad_col)
