"""Session settings and the shared scratch folder.

Intermediate tables that must survive a lost executor are written as Parquet below
``spark.checkpoint.dir``, which every executor and the driver share.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "colloquy", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; other settings stay the cluster's own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables written to the shared folder, which cut lineage and keep their statistics."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def save(self, df: DataFrame, by: str | None = None, compression: str = "snappy") -> DataFrame:
        """Write df, in one folder for each value of by if it is given, and read it back."""
        self.n += 1
        path = f"{self.base}/t{self.n}"
        writer = df.write.option("compression", compression)
        (writer.partitionBy(by) if by else writer).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def release(self) -> None:
        """Have Spark delete the shuffle files of plans that nothing refers to any more; it does so when the driver's memory is collected."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that save() returned and that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
