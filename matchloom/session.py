"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. Joins are never hinted: Spark
# broadcasts a side only below spark.sql.autoBroadcastJoinThreshold, and a hot
# key in a join of two fresh shuffles is split by the AQE skew rule. The force
# flag keeps that split even when an aggregate on the same key follows. Where
# the rule cannot see a join, operators.skew salts it.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings of the table queries. Shuffles start with many partitions, which Spark joins up to the advisory size, so a
# task's share does not grow with the tables. Parquet files of tables are a fraction of their rows in memory; taken
# at face value, a column of ids of some million rows would be broadcast through the driver.
TABLE_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


def tune(spark: SparkSession, more: Mapping[str, str] = {}) -> SparkSession:
    """Apply the runtime settings, and those of ``more``, to an existing session."""
    for key, value in {**RUNTIME_CONF, **more}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and single-node benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("matchloom")
    settings = {
        "spark.sql.shuffle.partitions": "8" if cpus == "*" else str(cpus),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        # No call sites are recorded; page plans are large and build twice as fast without.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **RUNTIME_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="matchloom-")
    context.setCheckpointDir(local)
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """Fresh, never reused folder below the shared root."""
    return f"{shared_root(spark)}/matchloom/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read one result: the written table survives
    lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Working tables of one job below the shared root, deleted together when the job ends.

    Each table is written once and read back, so a lost executor costs at most
    the job that was running. Spark is told to drop the shuffle files of each
    write as soon as it ends; they are of no use once the table is there.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = work_dir(spark, label)
        self.latest: dict[str, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, before)
        self.latest[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete the latest table of that name, once nothing reads it any more."""
        delete_folder(self.spark, self.latest.pop(name))

    def result(self, df: DataFrame) -> DataFrame:
        """Settle the job's result outside this folder, then delete the folder."""
        kept = Workspace(self.spark, "result").settle(df, "rows")
        self.close()
        return kept

    def close(self) -> None:
        delete_folder(self.spark, self.root)


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash ``df`` on a unique key over all cores, ahead of a CPU-bound step.

    Rows that are small before such a step would otherwise be packed into a few
    partitions by their size. Hashing, unlike round robin, gives a retried
    task the same rows.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys)
