"""Session helper and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch of texts, and the setting that bounds them.
BATCH_BYTES = 4_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "loomtext", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew handling and UTC times; `conf` overrides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a session in one process without that setting gets a fresh folder of its own; everywhere
    else the setting is required, because a machine-local folder dies with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send texts to Python in batches of about BATCH_BYTES or one row.

    Spark's own bound is so many rows that a batch of texts takes tens of megabytes in the JVM, twice while its buffers
    grow, and again in Python. A bound that the session sets itself holds.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
