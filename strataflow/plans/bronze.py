"""Lossless landing tables: every column text, technical columns after, loads that can be repeated."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.scalars import row_hash
from strataflow.operators.joins import lookup

#: Technical columns in order, after the business columns.
TECHNICAL = ("_ingested_at", "_replay_date", "_source_system", "_source_file", "_source_identifier", "_batch_id", "_row_hash", "_wellbore_uid")


def as_all_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def add_technical_columns(df: DataFrame, business: list[str], system: str, batch_id: str | None = None, ingested_at: str | None = None, crosswalk: DataFrame | None = None) -> DataFrame:
    """Business columns as text, then the technical ones. One time and one batch id serve a whole load.

    ``df`` may bring ``_replay_date``, ``_source_file`` and ``_source_identifier``; they are null if not.
    """
    ingested_at = ingested_at or dt.datetime.now(dt.UTC).isoformat(timespec="seconds")
    own = {c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in ("_replay_date", "_source_file", "_source_identifier")}
    out = df.select(
        *[F.col(c).cast("string").alias(c) for c in business],
        F.lit(ingested_at).alias("_ingested_at"),
        own["_replay_date"].alias("_replay_date"),
        F.lit(system).alias("_source_system"),
        own["_source_file"].alias("_source_file"),
        own["_source_identifier"].alias("_source_identifier"),
        F.lit(batch_id or str(uuid.uuid4())).alias("_batch_id"),
    ).withColumn("_row_hash", row_hash(*business))
    if crosswalk is None:
        return out.withColumn("_wellbore_uid", F.lit(None).cast("string"))
    return lookup(out, crosswalk).withColumnRenamed("wellbore_uid", "_wellbore_uid")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def load_range(df: DataFrame, path: str, first: str, last: str) -> int:
    """Replace the days from first to last by what ``df`` has of them; gives the rows written.

    Days without rows are emptied too, which a dynamic overwrite alone would leave as they were. The
    source is read once: rows are counted in what was written.
    """
    spark = df.sparkSession
    seen = Observation()
    days = df.where(F.col("_replay_date").between(first, last)).observe(seen, F.collect_set("_replay_date").alias("days"))
    # Rows of a day come together in few files, and a day that is much larger than others is split.
    out = days.hint("rebalance", "_replay_date")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_replay_date").parquet(path)
    try:
        loaded = set(seen.get["days"] or ())
    except Py4JJavaError:  # where Spark knows a plan to be empty it drops what was to be observed
        loaded = set()
    day, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    while day <= end:
        if day.isoformat() not in loaded:
            _delete(spark, f"{path}/_replay_date={day.isoformat()}")
        day += dt.timedelta(days=1)
    return spark.read.schema(df.schema).parquet(path).where(F.col("_replay_date").between(first, last)).count() if loaded else 0


def load_day(df: DataFrame, path: str, day: str) -> int:
    return load_range(df, path, day, day)


def bronze_scan(spark: SparkSession, path: str, business: list[str]) -> DataFrame:
    """A landing table with its declared, all-text schema; nothing is inferred."""
    from pyspark.sql import types as T

    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in (*business, *TECHNICAL)])).parquet(path)


def table_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count("_wellbore_uid").alias("rows_with_uid"), (100.0 * F.count("_wellbore_uid") / F.nullif(F.count("*"), F.lit(0))).alias("uid_pct"))


def table_state(df: DataFrame) -> DataFrame:
    """Fingerprint of a table's content: rows, distinct hashes, sum of the hashes' first 32 bits."""
    head = F.conv(F.substring("_row_hash", 1, 8), 16, 10).cast("long")
    return df.agg(F.count("*").alias("rows"), F.count_distinct("_row_hash").alias("hashes"), F.coalesce(F.sum(head), F.lit(0)).alias("checksum"))


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a Parquet table, from file metadata alone."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))


def compact(spark: SparkSession, path: str, to: str, file_bytes: int = 256 << 20) -> tuple[int, int]:
    """Write a table anew with files of about ``file_bytes``; fails if a row is lost. Gives files before and after."""
    before = file_stats(spark, path).first()
    df = spark.read.parquet(path)
    df.repartition(max(1, -(-(before["bytes"] or 0) // file_bytes))).write.mode("overwrite").parquet(to)
    if spark.read.parquet(to).count() != df.count():
        raise RuntimeError(f"rows were lost in writing {path} to {to}")
    return before["files"], file_stats(spark, to).first()["files"]


def out_of_replay_window(df: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Counts of rows before, after and in the window, and of those without a usable day."""
    d = F.col(day)
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    return df.agg(F.count_if(d < low).alias("before"), F.count_if(d > high).alias("after"), F.count_if(d.between(low, high)).alias("inside"), F.count_if(d.isNull()).alias("unparseable"))
