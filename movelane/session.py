"""Session settings and table access shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "movelane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; ``conf`` keys use ``__`` for dots.

    Sizes that depend on the cluster (shuffle partitions, broadcast threshold) are left to the caller and to AQE.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a folder of this machine only on a local master.

    On a cluster without that setting it raises: tables written to one machine's own folder would be lost to the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="movelane-checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def files_of(spark: SparkSession, path: str):
    """(file system, path) of ``path`` in the JVM."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = files_of(spark, path)
    return files.exists(where)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted with what it holds when the driver ends."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    files, where = files_of(spark, path)
    files.deleteOnExit(where)
    return path


_WRITTEN = "_movelane_path"


def cut_lineage(frame: DataFrame) -> DataFrame:
    """``frame`` written as a table to the shared folder and read again.

    It survives the loss of executors, and later plans start from the table's real size: estimates carried on through
    the rounds of an iterative operator would multiply at every join. The table is deleted by ``release`` or when the
    driver ends.
    """
    spark = frame.sparkSession
    path = scratch_path(spark)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    setattr(table, _WRITTEN, path)
    return table


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``cut_lineage`` that no later plan reads."""
    for table in tables:
        if path := getattr(table, _WRITTEN, None):
            files, where = files_of(table.sparkSession, path)
            files.delete(where, True)


def written_bytes(table: DataFrame) -> int:
    """The size on disk of a table of ``cut_lineage``."""
    files, where = files_of(table.sparkSession, getattr(table, _WRITTEN))
    return files.getContentSummary(where).getLength()


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's threshold below which a table is broadcast; negative if none is."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
