"""Filter, deduplicate, decontaminate and mix a corpus: five stages over documents.

Each stage takes the rows its predecessor kept; the driver of the pipeline writes them as Parquet and
reads them again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sqlscore.llm import decontamination, jaccard_join, line_dedup, mixing, toxicity
from sqlscore.llm.common import hinted, own_name
from sqlscore.session import ensure_checkpoint_dir

#: Near duplicates: five-word shingles, similarity 0.8 or more.
SHINGLE, SIMILARITY = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled documents of this stage, does not reject."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents hold stay in the document with the largest id; ``n_chars`` follows."""
    return line_dedup.dedup_rows(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; of repeated rows one."""
    names = jaccard_join.link_components(docs, shingle=SHINGLE, threshold=SIMILARITY)
    stays, gone, own, sig, n = (own_name(docs, x) for x in ("stays", "gone", "own", "sig", "n"))
    out = (names.groupBy(F.col("doc_id").alias(gone)).agg(F.max(F.col("component_id").eqNullSafe(F.col("doc_id"))).alias(stays))
           .where(f"not {stays}").select(gone).checkpoint())
    rows = docs.join(hinted(out), F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti")
    # repeated rows: only they are shuffled
    key = [F.col("doc_id").alias(own), F.xxhash64("text").alias(sig)]
    repeated = rows.select(*key).groupBy(own, sig).count().where("count > 1").select(own, sig).checkpoint()
    on = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(sig))
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    again = rows.join(hinted(repeated), on, "left_semi").withColumn(n, F.row_number().over(first)).where(f"{n} = 1").drop(n)
    return rows.join(hinted(repeated), on, "left_anti").unionByName(again)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per copy taken, the last one cut at the budget; ``n_chars`` follows.

    Adds ``epoch`` (number of the copy), ``size, source_size, target, epochs, last_words`` of the document and
    ``taken``, the words of this copy; these replace columns of the input that have their names.
    """
    return mixing.mixed_rows(docs, shares=True).withColumn("n_chars", F.length("text").cast("long"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near duplicates", drop_near_duplicates),
          ("benchmark decontamination", drop_benchmark), ("mixing", mix)]

#: The classifier of the first stage has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    import uuid
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{n}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
