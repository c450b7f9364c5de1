"""Cutting lineage in iterative operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from affinity.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once and written to the shared checkpoint folder;
    later reads come from there, also after an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Rounds:
    """Tables of a loop, as Parquet in a folder of its own under the shared
    checkpoint folder.  Unlike checkpoints they carry no constraints of the
    plans that made them (these multiply from round to round), and a table
    goes when the loop lets go of it.  ``with`` removes what is left."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def read(self, names: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{n}" for n in names])

    def drop(self, name: str) -> None:
        delete_folder(self.spark, f"{self.folder}/{name}")

    def __enter__(self) -> "Rounds":
        return self

    def __exit__(self, *_) -> None:
        delete_folder(self.spark, self.folder)
