"""Versioned tables in a lake of Parquet folders, and the sinks."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LakeUnavailable(RuntimeError):
    """The lake can't be read for another reason than that a table is missing."""


def versions(spark: SparkSession, root: str, name: str = "data_version") -> list[str]:
    """The versions of a table by its folders, sorted; none if the root is missing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(f"{name}="))


def read_latest(spark: SparkSession, root: str, name: str = "data_version", required: bool = True) -> DataFrame | None:
    """The newest version of a table; if there is none an error, or None where it isn't required."""
    v = versions(spark, root, name)
    if not v:
        if required:
            raise FileNotFoundError(f"no {name} under {root}")
        return None
    return spark.read.option("basePath", root).parquet(f"{root}/{name}={v[-1]}")


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or an empty one of the schema if its path is missing; any other failure is LakeUnavailable."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise LakeUnavailable(path) from e


def same_version(*tables: DataFrame, name: str = "data_version") -> str | None:
    """The newest version of all tables; an error if they differ."""
    tops = {t.agg(F.max(name)).first()[0] for t in tables}
    if len(tops) > 1:
        raise ValueError(f"versions differ: {sorted(map(str, tops))}")
    return next(iter(tops), None)


def write_versioned(df: DataFrame, root: str, by: str = "data_version", manifest: dict | None = None) -> None:
    """Replaces only the partitions that the rows have. Small partitions are gathered by Spark's own rebalancing.
    A manifest is written beside them as JSON."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(root)
    if manifest is not None:
        df.sparkSession.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}_manifest")


def write_whole(df: DataFrame, path: str) -> None:
    """Replaces a table without versions."""
    df.write.mode("overwrite").parquet(path)


def write_geojson_lines(df: DataFrame, path: str) -> None:
    """Features (a string column named feature), one a line."""
    df.select(F.col("feature").alias("value")).write.mode("overwrite").text(path)


def read_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of a database with its driver on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def dimension_from_sheet(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(code, libelle) from the cells of a sheet: four-digit codes only, labels trimmed. A small dimension by nature."""
    return spark.createDataFrame(rows, "code string, libelle string").where(F.col("code").rlike(r"^\d{4}$")).select("code", F.trim("libelle").alias("libelle"))
