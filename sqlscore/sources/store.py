"""Kept executions: results of earlier batches, so that a batch runs only what is new.

A store is a folder (shared, as any output folder). ``executions`` is a table of the successful executions,
bucketed by their key: a batch finds what it still has to run by an anti-join that moves the batch
alone, once, to the store's buckets; the store itself is never shuffled. Failures are not kept and are run
again. Result rows stay where the run that made them wrote them, spread as they were, so one query with very
many rows is no hot bucket; ``paths`` lists the files of each run. The append to ``executions`` is the last step of
a run: rows of a run that did not get there are never read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXECUTION = "query_id string, row_count bigint, seconds double, run string"
ROWS_SCHEMA = "query_id string, cells array<string>"

#: Buckets of a new store.
BUCKETS = 64


class ExecutionStore:
    """The executions kept in a folder; made on first use, with ``buckets`` buckets (an existing store keeps its number)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}/layout"
        if not self._exists(layout):
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(layout)
        self.buckets = spark.read.parquet(layout).first()["buckets"]
        self.table = f"kept_executions_{hashlib.md5(self.path.encode()).hexdigest()[:12]}"
        # a catalog that does not outlive the session is told of the folder anew
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({EXECUTION}) USING parquet "
                  f"CLUSTERED BY (query_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}/executions'")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def executions(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def dealt(self, queries: DataFrame, query_id: str = "query_id") -> DataFrame:
        """One row of ``queries`` a key, dealt as the store's buckets are: the only shuffle of both joins below."""
        return queries.repartition(self.buckets, query_id).dropDuplicates([query_id])

    def known(self, dealt: DataFrame) -> DataFrame:
        """Kept executions of the queries."""
        return self.executions().join(dealt.select("query_id"), "query_id", "left_semi")

    def fresh(self, dealt: DataFrame) -> DataFrame:
        """Queries without a kept execution."""
        return dealt.join(self.executions().select("query_id"), "query_id", "left_anti")

    def rows_of(self, known: DataFrame) -> list[str]:
        """Folders with the result rows of kept executions: those of the runs that made them."""
        if not self._exists(f"{self.path}/paths"):
            return []
        runs = known.select("run").distinct()
        return [r["path"] for r in self.spark.read.parquet(f"{self.path}/paths").join(F.broadcast(runs), "run", "left_semi").collect()]  # one row a job

    def keep(self, run: str, executions: DataFrame, paths: list[str]) -> None:
        """Add the successful ``executions`` of a run whose rows lie in ``paths``."""
        if paths:
            self.spark.createDataFrame([(run, p) for p in paths], "run string, path string").coalesce(1).write.mode("append").parquet(f"{self.path}/paths")
        rows = executions.where("success").select("query_id", "row_count", "seconds", F.lit(run).alias("run"))
        (rows.repartition(self.buckets, "query_id").write.mode("append").format("parquet").bucketBy(self.buckets, "query_id")
         .option("path", f"{self.path}/executions").saveAsTable(self.table))
