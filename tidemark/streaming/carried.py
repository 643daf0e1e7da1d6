"""Tables carried from micro-batch to micro-batch.

A ``foreachBatch`` handler that keeps state as a table per batch depends on its
own rows and on the table of the batch before only, so a replay after a
failure gives the same result again. Folders are ``<path>/batch=<id>``; those older
than ``keep`` batches are deleted (Spark replays the last batch only).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written into ``folder`` to the end."""
    fs, place = _file_system(spark, os.path.join(folder, "_SUCCESS"))
    return fs.exists(place)


def remove(spark: SparkSession, folder: str) -> None:
    fs, place = _file_system(spark, folder)
    if fs.exists(place):
        fs.delete(place, True)


class Carried:
    """One carried table."""

    def __init__(self, path: str, schema: str, keep: int = 10):
        if keep < 2:
            raise ValueError("the last two batches are needed for a replay")
        self.path, self.schema, self.keep = path, schema, keep

    def folder(self, batch_id: int) -> str:
        return os.path.join(self.path, f"batch={batch_id}")

    def read(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table after the batch before ``batch_id``. Every batch writes it, so
        a missing one is lost data."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return self.at(spark, batch_id - 1)

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame:
        try:
            return spark.read.schema(self.schema).parquet(self.folder(batch_id))
        except AnalysisException as exc:
            raise RuntimeError(f"the carried table {self.folder(batch_id)} is missing") from exc

    def write(self, df: DataFrame, batch_id: int) -> None:
        names = df.sparkSession.createDataFrame([], self.schema).columns
        df.select(*names).write.mode("overwrite").parquet(self.folder(batch_id))
        if batch_id >= self.keep:
            remove(df.sparkSession, self.folder(batch_id - self.keep))
