"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


SHUFFLE_BYTES_PER_PARTITION = 256 * 1024 * 1024
#: Blocks of a shuffle grow with the product of its map and reduce tasks.
MAX_SHUFFLE_PARTITIONS = 20_000


def build_session(
    app: str = "legwork", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session in UTC with adaptive execution.

    ``input_bytes``, what the largest shuffle is expected to move after pruning and
    partial aggregation, sets how many shuffle partitions a query starts with; adaptive
    execution merges small ones.
    Skewed joins are split even where that costs one more shuffle, because a hub
    airport or a busy carrier may hold a large part of all legs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes:
        partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, -(-input_bytes // SHUFFLE_BYTES_PER_PARTITION)))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    settings |= conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """A new folder for this run under ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/legwork-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="legwork-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set the checkpoint folder only where the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))
