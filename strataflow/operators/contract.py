"""The telemetry contract: which records are usable, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.scalars import NUMERIC

#: The record's optional channels. Fixed values.
CHANNELS = ("block_position_m", "hook_load_klbf", "wob_klbf", "rpm", "torque_kftlbf", "flow_in_lpm", "spp_bar", "rop_mph")
DEPTH_SLACK_M = 0.5


def validate_records(raw: DataFrame) -> DataFrame:
    """All-text records with typed columns, and reason, field and raw_value of the first fault found.

    ``raw`` has wellbore_uid, ts (epoch milliseconds), depths and channels as text. A record is good
    if reason is null. Order: uid, time, depths, bit above hole, channels.
    """
    number = {c: F.when(F.trim(c).rlike(NUMERIC), F.trim(c).try_cast("double")) for c in ("bit_depth_m", "hole_depth_m", *CHANNELS)}
    millis = F.when(F.trim("ts").rlike(r"^-?[0-9]{1,15}$"), F.trim("ts").try_cast("long"))

    def fault(reason: str, field: str) -> Column:
        return F.struct(F.lit(reason).alias("reason"), F.lit(field).alias("field"), F.col(field).cast("string").alias("raw_value"))

    checks = [(F.coalesce(F.trim("wellbore_uid"), F.lit("")) == "", fault("missing_wellbore", "wellbore_uid")), (millis.isNull(), fault("bad_timestamp", "ts"))]
    checks += [(number[c].isNull(), fault("not_numeric", c)) for c in ("bit_depth_m", "hole_depth_m")]
    checks += [(number["bit_depth_m"] > number["hole_depth_m"] + DEPTH_SLACK_M, fault("bit_below_hole", "bit_depth_m"))]
    checks += [(F.col(c).isNotNull() & number[c].isNull(), fault("not_numeric", c)) for c in CHANNELS]
    found = F.when(checks[0][0], checks[0][1])
    for condition, value in checks[1:]:
        found = found.when(condition, value)
    typed = {c: number[c] for c in number} | {"ts": F.timestamp_millis(millis)}
    return raw.withColumn("_fault", found).withColumns(typed).withColumns({c: F.col(f"_fault.{c}") for c in ("reason", "field", "raw_value")}).drop("_fault")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, dead letters)."""
    faults = ("reason", "field", "raw_value")
    return checked.where("reason is null").drop(*faults), checked.where("reason is not null")
