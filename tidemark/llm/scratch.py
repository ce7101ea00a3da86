"""Tables that an operator writes on its way, in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """One folder for one run of an operator; a table can be dropped once it is used up."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and go on from the written rows: later steps cannot see it change."""
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")  # the step's shuffle files are of no use after it
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
