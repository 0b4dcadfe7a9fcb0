"""Session helpers: configuration for local runs and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: dict[str, str] = {}


def build_session(app: str = "galena", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.config("spark.ui.showConsoleProgress", "false").getOrCreate()


class NoSharedFolder(RuntimeError):
    """The session names no folder that all its executors share."""


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only on one machine (a local master, as in
    tests) a temporary folder is made and set where that is unset; a cluster without one is an error."""
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="galena-")
        spark.sparkContext.setCheckpointDir(_local[app])
    return _local[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/galena/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A frame that is expected to be small, for a join: with at most `most` rows it is computed at once and broadcast;
    else it stays as it is and Spark joins it like any other."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file through Hadoop's file system; None where there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file: written beside it first, so that a reader finds the old or the new one, or for a moment
    none, never a part."""
    jvm = spark.sparkContext._jvm
    p, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"could not write {path}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, so that any store works."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_work(spark: SparkSession) -> None:
    """Deletes what the queries of all sessions wrote to the shared folder; frames that still read it become unusable."""
    remove_path(spark, f"{shared_dir(spark)}/galena")
