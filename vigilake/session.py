"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only (no static ones), so they can be applied to a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Merge sessions inside each map task first, so a hot actor shuffles sessions and not events.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Like JSON libraries: of two equal keys in one object the later one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "vigilake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # call-site capture costs several JVM round trips per expression while a plan is put together
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` as the cluster names it.

    Only when nothing is set (local tests) a temporary folder is made and named there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="vigilake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing(spark: SparkSession):
    """The files of the shuffles of what is run meanwhile go as soon as it has ended."""
    before = spark.conf.get(FREE)
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE, before)


def materialise(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write a result to the shared folder and go on from the file: cuts the plan and survives lost executors.

    With `free` the files of its shuffles go as soon as it is written, and it is packed more closely.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    if not free:
        df.write.parquet(path)
        return spark.read.parquet(path)
    with freeing(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete tables that `materialise` has written and nothing reads any more."""
    for df in frames:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for input that comes in fewer partitions than there are cores, such as one small file.

    Large inputs have more partitions than cores and are left as they are: no shuffle.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
