"""Every landing table's reader behind one contract: a day, or a range of days in one scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.plans import bronze
from strataflow.sources import columns, logs, subsurface, witsml, xlsx

#: Day on which files without a date of their own are loaded: the first of the field's life.
STATIC_DAY = "2008-06-01"


@dataclass(frozen=True)
class FieldSource:
    """``rows(spark, folder, first, last)`` reads once whatever the range; ``dated`` sources bring their own days."""

    table: str
    system: str
    business: tuple[str, ...]
    rows: Callable[[SparkSession, str, str, str], DataFrame]
    dated: bool = True

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in (*self.business, *bronze.TECHNICAL)])

    def read_range(self, spark: SparkSession, folder: str, first: str, last: str, batch_id: str | None = None, crosswalk: DataFrame | None = None) -> DataFrame:
        """Landing rows of the days from first to last. Rows without a day count as the static day's."""
        rows = self.rows(spark, folder, first, last)
        day = F.coalesce("_replay_date", F.lit(STATIC_DAY)) if self.dated else F.lit(STATIC_DAY)
        rows = rows.withColumn("_replay_date", day).where(F.col("_replay_date").between(first, last))
        return bronze.add_technical_columns(rows, list(self.business), self.system, batch_id, crosswalk=crosswalk)

    def read(self, spark: SparkSession, folder: str, day: str, **more) -> DataFrame:
        return self.read_range(spark, folder, day, day, **more)


def _plain(reader: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str, str, str], DataFrame]:
    return lambda spark, folder, first, last: reader(spark, folder)


SOURCES: dict[str, FieldSource] = {
    s.table: s
    for s in (
        FieldSource("prod_daily", "PROD", columns.PROD_DAILY, xlsx.read_prod_daily),
        FieldSource("prod_monthly", "PROD_MONTHLY", columns.PROD_MONTHLY, xlsx.read_prod_monthly),
        FieldSource("ddr_activity", "DDR", columns.DDR_ACTIVITY, _plain(witsml.read_reports)),
        FieldSource("trajectory_station", "TRAJECTORY", columns.TRAJECTORY_STATION, _plain(witsml.read_trajectory_station)),
        FieldSource("witsml_message", "WITSML", columns.WITSML_MESSAGE, _plain(witsml.read_witsml_message)),
        FieldSource("witsml_log_header", "WITSML", columns.WITSML_LOG_HEADER, _plain(witsml.read_witsml_log_header), dated=False),
        FieldSource("witsml_log_data", "WITSML", columns.WITSML_LOG_DATA, _plain(witsml.read_witsml_log_data)),
        FieldSource("las_curve_header", "LAS", columns.LAS_CURVE_HEADER, _plain(logs.read_las_curve_header), dated=False),
        FieldSource("las_sample", "LAS", columns.LAS_SAMPLE, _plain(logs.read_las_sample), dated=False),
        FieldSource("vsp_checkshot", "VSP", columns.VSP_CHECKSHOT, _plain(subsurface.read_checkshot), dated=False),
        FieldSource("segy_header", "SEGY", columns.SEGY_HEADER, _plain(subsurface.read_segy_header), dated=False),
        FieldSource("sim_summary", "ECLIPSE", columns.SIM_SUMMARY, _plain(subsurface.read_eclipse_balance)),
        FieldSource("geom_fault_record", "GEOM", columns.GEOM_FAULT_RECORD, _plain(subsurface.read_fault_records), dated=False),
    )
}


def ingest(spark: SparkSession, folders: dict[str, str], to: str, first: str, last: str, crosswalk: DataFrame | None = None) -> dict[str, int]:
    """Load the days from first to last of each table named in ``folders`` below ``to``; rows written by table.

    One batch id serves the whole load; loading again replaces the same days.
    """
    import uuid

    batch = str(uuid.uuid4())
    return {name: bronze.load_range(SOURCES[name].read_range(spark, folder, first, last, batch, crosswalk), f"{to}/{name}", first, last) for name, folder in folders.items()}
