"""Tables written into the folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset a temporary folder takes its place, but only for a local
    master: on a cluster that folder would be one machine's own, so it is an
    error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="strandlake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage: a lost executor costs the tasks that it ran, not
    what came before the table.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Remove a table that :func:`stored` wrote and nothing reads any more."""
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        _remove(df.sparkSession, folder)


#: Folders written while :func:`settled` builds a table, innermost last.
_scopes: list[list[str]] = []


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, stored; the tables that it stored on the way are removed."""
    _scopes.append([])
    try:
        path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        df = build()
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    finally:
        for folder in _scopes.pop():
            _remove(spark, folder)
