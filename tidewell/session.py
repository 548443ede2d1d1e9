"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidewell", **conf: str) -> SparkSession:
    """A session with the library's settings; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may run without it: a machine-local folder would be
    lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidewell-")
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """``df`` as a written table in the shared folder.

    The table survives lost executors, and unlike a checkpointed RDD it has a
    known size, so that later joins can tell a small side from a large one.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
