"""Telemetry as a stream: contract, late rows aside, duplicates out, each to a sink of its own.

Rows that come later than the watermark would be dropped inside a stateful operator without a trace.
So late rows are told apart first, by a threshold kept beside the checkpoint: the greatest time seen
in the batches before. The main sink drops duplicates within the watermark.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from strataflow.operators.contract import CHANNELS, split_valid, validate_records

WATERMARK_MINUTES = 10
RAW_COLUMNS = ("wellbore_uid", "ts", "source_identifier", "bit_depth_m", "hole_depth_m", *CHANNELS, "producer_seq")
RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def file_source(spark: SparkSession, path: str, files_per_batch: int = 10) -> DataFrame:
    """JSON lines from a folder, a bounded number of files per batch."""
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, per_batch: int = 200_000) -> DataFrame:
    """JSON values of a topic from its beginning. Needs Spark's Kafka package."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    stream = stream.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_batch).option("failOnDataLoss", "false").load()
    return stream.select(F.from_json(F.col("value").cast("string"), RAW_SCHEMA).alias("r")).select("r.*")


def dedup_stream(valid: DataFrame, minutes: int = WATERMARK_MINUTES) -> DataFrame:
    """One row per wellbore and time among those within the watermark."""
    return valid.withWatermark("ts", f"{minutes} minutes").dropDuplicatesWithinWatermark(["wellbore_uid", "ts"])


class _State:
    """Thresholds by batch, in a folder that survives restarts; a batch that is run again finds its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(path))

    def before(self, batch: int) -> int | None:
        """Greatest microsecond seen before this batch."""
        known = [int(f.getPath().getName()) for f in self._fs.listStatus(self._path(self.path))]
        earlier = [k for k in known if k < batch]
        if not earlier:
            return None
        text = self.spark.read.text(f"{self.path}/{max(earlier)}").first()
        return json.loads(text[0])["seen"] if text else None

    def put(self, batch: int, seen: int | None) -> None:
        out = self._fs.create(self._path(f"{self.path}/{batch}"), True)
        out.write(json.dumps({"seen": seen}).encode())
        out.close()
        for f in self._fs.listStatus(self._path(self.path)):
            if int(f.getPath().getName()) < batch - 100:
                self._fs.delete(f.getPath(), False)


def route_batch(batch: DataFrame, number: int, folder: str, state: _State, minutes: int = WATERMARK_MINUTES) -> None:
    """Write a batch's dead letters, late rows and new rows, each to this batch's own folder.

    A batch that runs again after a crash overwrites its folders and uses the threshold it had, so the
    result is the same. New rows: not in the batch twice, and not among what earlier batches wrote
    for the same days.
    """
    spark = batch.sparkSession
    checked = validate_records(batch).withColumn("_micros", F.unix_micros("ts")).persist()
    good, dead = split_valid(checked)
    dead.drop("_micros").withColumn("rejected_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{folder}/dead_letter/batch={number}")
    seen = state.before(number)
    limit = None if seen is None else seen - minutes * 60 * 1_000_000
    late = F.lit(False) if limit is None else F.col("_micros") < limit
    good.where(late).drop("_micros").write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
    fresh = good.where(~late).dropDuplicates(["wellbore_uid", "ts"]).withColumn("ts_date", F.to_date("ts"))
    if limit is not None:
        earlier = _earlier(spark, f"{folder}/telemetry", fresh.drop("_micros", "ts_date").schema, limit).where(F.col("batch") < number).select("wellbore_uid", "ts")
        fresh = fresh.join(earlier, ["wellbore_uid", "ts"], "left_anti")
    fresh.withColumn("batch", F.lit(number)).drop("_micros").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ts_date", "batch").parquet(f"{folder}/telemetry")
    greatest = good.agg(F.max("_micros")).first()[0]
    state.put(number, max((x for x in (seen, greatest) if x is not None), default=None))
    checked.unpersist()


def _earlier(spark: SparkSession, path: str, schema: StructType, limit: int) -> DataFrame:
    """What earlier batches wrote for the days since ``limit`` (microseconds); only those days' folders are listed."""
    store = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = store.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    since = f"ts_date={dt.datetime.fromtimestamp(limit // 1_000_000, dt.UTC).date() - dt.timedelta(days=1)}"  # a day more, as sessions have zones
    days = [f.getPath().toString() for f in fs.listStatus(root) if f.getPath().getName() >= since and f.getPath().getName().startswith("ts_date=")] if fs.exists(root) else []
    full = StructType([*schema.fields, StructField("ts_date", DateType()), StructField("batch", IntegerType())])
    return spark.read.option("basePath", path).schema(full).parquet(*days) if days else spark.createDataFrame([], full)


def start_routing(raw: DataFrame, folder: str, checkpoint: str, minutes: int = WATERMARK_MINUTES, available_now: bool = True) -> StreamingQuery:
    """Run the whole path; a query that is started again with the same checkpoint goes on where it stopped."""
    spark = raw.sparkSession
    state = _State(spark, f"{checkpoint}/thresholds")
    writer = raw.writeStream.foreachBatch(lambda batch, number: route_batch(batch, number, folder, state, minutes)).option("checkpointLocation", f"{checkpoint}/query")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


_GOOD = "wellbore_uid string, ts timestamp, source_identifier string, bit_depth_m double, hole_depth_m double, " + "".join(f"{c} double, " for c in CHANNELS) + "producer_seq string"
ROUTED = {"telemetry": _GOOD, "late": _GOOD, "dead_letter": f"{_GOOD}, reason string, field string, raw_value string, rejected_at timestamp"}


def read_routed(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Rows of telemetry, late or dead_letter; none where nothing has come yet."""
    return spark.read.schema(ROUTED[kind]).option("recursiveFileLookup", "true").parquet(f"{folder}/{kind}")


def avro_records(values: DataFrame, schema: str, frame_bytes: int = 5) -> DataFrame:
    """Records of a ``value`` column of framed Avro; what doesn't decode gives null fields, so it ends as a dead letter.

    Needs Spark's Avro package. The frame (a zero byte and the schema's id) stands before each record.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring(value, {frame_bytes + 1})")
    return values.select(from_avro(body, schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def append_stream(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet table by day; with a checkpoint each row is written once."""
    writer = rows.withColumn("ts_date", F.to_date("ts")).writeStream.format("parquet").outputMode("append").partitionBy("ts_date")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
