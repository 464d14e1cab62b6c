"""Shared-storage tables that cut lineage, so that a lost executor costs one stage, not the job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings this library is meant to run under on a cluster. Nothing here is set
# behind the caller's back: pass them to the session builder.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir`` (or already set on the context); where neither is set, as in
    a local session, one beside the session's tables."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_idweave")
    return context.getCheckpointDir().rstrip("/")


class Workspace:
    """Intermediate tables of one run, below the shared folder; ``codec`` packs them (None: as the session does)."""

    def __init__(self, spark: SparkSession, codec: str | None = None) -> None:
        self.spark = spark
        self.options = {"compression": codec} if codec else {}
        self.path = f"{shared_dir(spark)}/idweave-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return it as a scan: columnar, prunable, with known size."""
        return self._write(df, name, "error")

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` beside what the table ``name`` has already, and return all of it."""
        return self._write(df, name, "append")

    def _write(self, df: DataFrame, name: str, mode: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode(mode).options(**self.options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Drop tables that nothing reads any more. Frames built on them are unreadable afterwards."""
        for name in names:
            self._delete(f"{self.path}/{name}")

    def clean(self) -> None:
        """Ask the driver's JVM for a collection: Spark removes the shuffle files of steps that nothing refers to any
        more, as those behind stored tables, only when the driver has collected its garbage. For jobs that move much."""
        self.spark._jvm.System.gc()

    def release(self) -> None:
        """Drop all tables."""
        self._delete(self.path)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
