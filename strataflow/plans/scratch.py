"""Tables that one step writes and others read, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder of our own only where none is set and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="strataflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/strataflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: computed once, its lineage cut."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def model(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A model over the tables in ``sf_dir``, written when it is first asked for in an application and read after."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = written(build(), name)
    return _TABLES[key]


def forget() -> None:
    """Have every model built anew when it is next asked for."""
    _TABLES.clear()
