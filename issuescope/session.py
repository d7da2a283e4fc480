"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on.  Everything else is left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.speculation": "false",  # a speculative copy of a model task would pay for its calls twice
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per column expression
}


def build_session(app: str = "issuescope", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="issuescope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Later reads then neither repeat the work (or the paid model calls) nor depend on executor memory.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/issuescope/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_small(df: DataFrame) -> DataFrame:
    """Share out a table that has fewer input splits than the session has cores.

    A single row group, or a text file that cannot be split, would leave all work to one task.  Tables of many
    splits are returned as they are, so large inputs are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
