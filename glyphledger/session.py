"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys (one code, one name, one project) are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "glyphledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="glyphledger-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir()


def _stage_root(spark: SparkSession) -> str:
    return f"{_checkpoint_root(spark).rstrip('/')}/stages-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table that is written and read back."""
    return f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage tables of this application; call it when no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write a stage table to the shared folder and read it back.

    The lineage ends at the files, so the loss of an executor only repeats reads,
    and later stages read the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
