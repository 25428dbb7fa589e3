"""A replay day from files to verdict: which days, landing, models, assertions, objectives."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators.replay import ReplayClock
from strataflow.plans import assertions, bronze, slo
from strataflow.plans.registry import Registry, default_registry


@dataclass(frozen=True)
class DayResult:
    first: str
    last: str
    loaded: dict[str, int]
    assertions: dict[str, bool]
    objectives: list[slo.Measurement]

    @property
    def blocked(self) -> bool:
        """Whether an assertion fails or an objective that isn't known to be missed is."""
        return not all(ok for name, ok in self.assertions.items() if name in assertions.ASSERTIONS) or any(m.blocking for m in self.objectives)


def landing_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    from strataflow.sources.catalogue import SOURCES

    return {name: bronze.bronze_scan(spark, f"{folder}/{name}", list(SOURCES[name].business)) for name in names}


def run_day(spark: SparkSession, clock: ReplayClock, begin: datetime, end: datetime, folders: dict[str, str], to: str, models: list[str], registry: Registry | None = None, crosswalk: DataFrame | None = None) -> DayResult:
    """Load the field days of a real interval, build the wanted models below ``to``, and judge them.

    The whole window is loaded, not its first day only. Running an interval again gives the same tables.
    """
    from strataflow.sources.catalogue import ingest

    first, last = (d.isoformat() for d in clock.replay_window(begin, end))
    loaded = ingest(spark, folders, f"{to}/bronze", first, last, crosswalk)
    registry = registry or default_registry()
    landing = landing_tables(spark, f"{to}/bronze", list(folders))
    registry.write(landing, f"{to}/models", models)
    built = {name: spark.read.parquet(f"{to}/models/{name}") for name in registry.order(models)}
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    wanted = [o for o in slo.default_objectives(last) if o.table in built]
    return DayResult(first, last, loaded, assertions.evaluate(built), slo.evaluate(spark, wanted))
