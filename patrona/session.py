"""Session set-up and the shared folder used to cut lineage and stage files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "patrona", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with adaptive execution and skew-join splitting on, and UTC times.

    Nothing here is needed on a cluster whose defaults already say so; every
    operator also runs on a session that was built elsewhere.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own; on
    a cluster the setting is required, since a machine-local folder would not be
    readable from the other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="patrona-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder for a table that one job writes and reads."""
    return f"{shared_dir(spark)}/patrona/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame once to the shared folder and read it back.

    Cuts lineage before iterative work: the copy is columnar, survives the loss of
    executors and is pruned to the columns a later step reads.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_path = path
    return staged


def discard(*staged: DataFrame) -> None:
    """Delete tables written by :func:`materialize` that no later frame reads.

    Only tables whose rows have gone into another written table may be named: a task that
    runs again reads that one.
    """
    for df in staged:
        spark, path = df.sparkSession, df.staged_path
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
