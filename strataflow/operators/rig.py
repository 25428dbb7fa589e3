"""Rig states from drilling telemetry, their spans, and non-productive time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.scalars import micros, minutes_preceding, seconds_between
from strataflow.operators.runs import spans

STATES = ("CONNECTION", "TRIPPING_OUT", "TRIPPING_IN", "DRILLING", "CIRCULATING", "STATIC")


@dataclass(frozen=True)
class RigRules:
    """Thresholds of the six-state rule. Fixed values of the rule."""

    connection_flow: float = 100.0
    connection_rpm: float = 5.0
    connection_travel: float = 0.5
    trip_rate: float = 0.05
    trip_weight: float = 2.0
    on_bottom: float = 0.5
    pumping_flow: float = 1000.0
    still_rate: float = 0.01
    frame_minutes: int = 10
    npt_seconds: int = 1800


def _chunk(minutes: int) -> Column:
    """Number of the stretch of so many minutes in which a sample lies."""
    return F.floor(micros("ts") / (minutes * 60_000_000)).cast("long")


def motion(samples: DataFrame, key: str = "wellbore_uid", rules: RigRules = RigRules(), chunk_minutes: int | None = None) -> DataFrame:
    """Samples with bit ``rate`` (m/s to the sample before) and block ``travel`` over the last minutes.

    Where single wellbores hold a large share of all samples, ``chunk_minutes`` cuts their time into
    stretches that tasks work on apart: the end of each goes along with the next for the frame, and
    the last sample of each is looked up for the first of the next. The result is the same.
    """
    by = [key]
    if chunk_minutes is not None:
        if chunk_minutes < rules.frame_minutes:
            raise ValueError("a stretch must not be shorter than the frame")
        length, frame = chunk_minutes * 60_000_000, rules.frame_minutes * 60_000_000
        own = _chunk(chunk_minutes)
        lasts = samples.groupBy(key, own.alias("_chunk")).agg(F.max("ts").alias("_last_ts"), F.max_by("bit_depth_m", "ts").alias("_last_bit"))
        earlier = Window.partitionBy(key).orderBy("_chunk")
        lasts = lasts.select(key, "_chunk", F.lag("_last_ts").over(earlier).alias("_last_ts"), F.lag("_last_bit").over(earlier).alias("_last_bit"))
        near_end = F.pmod(micros("ts"), F.lit(length)) >= length - frame
        samples = samples.withColumn("_own", own).withColumn("_chunk", F.explode(F.when(near_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
        by = [key, "_chunk"]
    ordered = Window.partitionBy(*by).orderBy("ts")
    frame = Window.partitionBy(*by).orderBy(micros("ts")).rangeBetween(minutes_preceding(rules.frame_minutes), 0)
    travel = F.max("block_position_m").over(frame) - F.min("block_position_m").over(frame)
    rows = samples.withColumns({"_before_ts": F.lag("ts").over(ordered), "_before_bit": F.lag("bit_depth_m").over(ordered), "travel": F.coalesce(travel, F.lit(0.0))})
    if chunk_minutes is not None:
        rows = rows.where("_own = _chunk").join(lasts, [key, "_chunk"], "left")
        alone = F.col("_before_ts").isNull()
        rows = rows.withColumns({"_before_bit": F.when(alone, F.col("_last_bit")).otherwise(F.col("_before_bit")), "_before_ts": F.coalesce("_before_ts", "_last_ts")})
        rows = rows.drop("_own", "_chunk", "_last_ts", "_last_bit")
    seconds = F.coalesce(seconds_between("_before_ts", "ts"), F.lit(0))
    rate = F.when(seconds == 0, F.lit(0.0)).otherwise((F.col("bit_depth_m") - F.col("_before_bit")) / seconds)
    return rows.withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("_before_ts", "_before_bit")


def state_of(rules: RigRules = RigRules()) -> Column:
    """First rule that holds; channels without a reading count as zero."""
    flow, rpm, weight = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("flow_in_lpm", "rpm", "wob_klbf"))
    rate, pumping = F.col("rate"), F.coalesce(F.col("flow_in_lpm"), F.lit(0.0)) > rules.pumping_flow
    on_bottom = F.abs(F.col("bit_depth_m") - F.col("hole_depth_m")) <= rules.on_bottom
    return (
        F.when((flow < rules.connection_flow) & (rpm < rules.connection_rpm) & (F.col("travel") >= rules.connection_travel), "CONNECTION")
        .when((rate < -rules.trip_rate) & (weight < rules.trip_weight), "TRIPPING_OUT")
        .when((rate > rules.trip_rate) & (weight < rules.trip_weight), "TRIPPING_IN")
        .when(on_bottom & (weight > rules.trip_weight) & pumping, "DRILLING")
        .when(pumping & (F.abs(rate) < rules.still_rate), "CIRCULATING")
        .otherwise("STATIC")
    )


def rig_states(samples: DataFrame, key: str = "wellbore_uid", rules: RigRules = RigRules(), chunk_minutes: int | None = None) -> DataFrame:
    return motion(samples, key, rules, chunk_minutes).withColumn("state", state_of(rules))


def state_spans(samples: DataFrame, key: str = "wellbore_uid", rules: RigRules = RigRules(), chunk_minutes: int | None = None) -> DataFrame:
    """Runs of a state with depths, whole seconds and whether they are non-productive.

    depth_from and depth_to are least and greatest bit depth; first_depth and last_depth those of the
    first and last sample.
    """
    bit = "bit_depth_m"
    measures = {"depth_from": (bit, "min"), "depth_to": (bit, "max"), "first_depth": (bit, "first"), "last_depth": (bit, "last")}
    states = rig_states(samples, key, rules, chunk_minutes)
    if chunk_minutes is not None:
        states = states.withColumn("_chunk", _chunk(chunk_minutes))
    runs = spans(states, key, "ts", "state", measures, None if chunk_minutes is None else "_chunk")
    seconds = seconds_between("started_at", "ended_at")
    return runs.withColumns({"duration_s": seconds, "is_npt": (F.col("state") == "STATIC") & (seconds > rules.npt_seconds)})


def drilling_efficiency(runs: DataFrame, key: str = "wellbore_uid") -> DataFrame:
    """Shares, rates and connection times of each wellbore from its spans."""
    from strataflow.functions.scalars import safe_divide

    of = lambda state, c: F.sum(F.when(F.col("state") == state, c).otherwise(0))
    agg = runs.groupBy(key).agg(
        F.sum("duration_s").alias("total_s"),
        F.sum(F.when(F.col("is_npt"), F.col("duration_s")).otherwise(0)).alias("npt_s"),
        of("DRILLING", F.col("duration_s")).alias("drilling_s"),
        of("DRILLING", F.col("depth_to") - F.col("depth_from")).alias("drilled_m"),
        of("CONNECTION", F.col("duration_s")).alias("connection_s"),
        F.count_if(F.col("state") == "CONNECTION").alias("connections"),
    )
    return agg.withColumns(
        {
            "npt_pct": safe_divide(100.0 * F.col("npt_s"), "total_s"),
            "rop_m_per_h": safe_divide(3600.0 * F.col("drilled_m"), "drilling_s"),
            "mean_connection_s": safe_divide(F.col("connection_s").cast("double"), "connections"),
            "m_per_day": safe_divide(86400.0 * F.col("drilled_m"), "total_s"),
        }
    )
