"""Tables a job writes between its steps, in the folder every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets a
    temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="sluice-llm-"))
    return _LOCAL[0]


class Scratch:
    """Named Parquet tables below one new folder.  A written table cuts lineage:
    later steps, also after a lost executor, read it instead of the input."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
