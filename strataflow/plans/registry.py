"""Models by name with what they need; built lazily, each at most once, in one session."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from strataflow.operators import production
from strataflow.plans import gold, mart, silver


@dataclass
class Registry:
    """name -> (dependencies, function of their DataFrames)."""

    models: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = field(default_factory=dict)

    def model(self, name: str, needs: tuple[str, ...], build: Callable[..., DataFrame]) -> None:
        self.models[name] = needs, build

    def build(self, sources: dict[str, DataFrame], wanted: list[str] | None = None) -> dict[str, DataFrame]:
        built = dict(sources)

        def get(name: str, path: tuple[str, ...] = ()) -> DataFrame:
            if name not in built:
                if name in path or name not in self.models:
                    raise KeyError(f"{name} is needed by {path} and can't be built")
                needs, make = self.models[name]
                built[name] = make(*[get(n, (*path, name)) for n in needs])
            return built[name]

        return {name: get(name) for name in wanted or self.models}

    def write(self, sources: dict[str, DataFrame], folder: str, wanted: list[str] | None = None) -> None:
        """Each model as a Parquet table; later models read what was written, so nothing is computed twice."""
        built = dict(sources)
        for name in self.order(wanted or list(self.models)):
            needs, make = self.models[name]
            df = make(*[built[n] for n in needs])
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            built[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    def order(self, wanted: list[str]) -> list[str]:
        out: list[str] = []

        def visit(name: str) -> None:
            if name in self.models and name not in out:
                for need in self.models[name][0]:
                    visit(need)
                out.append(name)

        for name in wanted:
            visit(name)
        return out


def default_registry() -> Registry:
    r = Registry()
    r.model("silver_production_daily", ("prod_daily",), silver.production_daily)
    r.model("silver_production_monthly", ("prod_monthly",), silver.production_monthly)
    r.model("silver_production_quarantine", ("silver_production_daily",), production.quarantine)
    r.model("silver_log_curve", ("las_curve_header",), silver.log_curve)
    r.model("silver_log_sample", ("las_sample", "las_curve_header"), silver.log_sample)
    r.model("silver_trajectory_station", ("trajectory_station",), silver.trajectory_station)
    r.model("silver_ddr_activity", ("ddr_activity",), silver.ddr_activity)
    r.model("silver_vsp_checkshot", ("vsp_checkshot",), silver.vsp_checkshot)
    r.model("silver_simulation_result", ("sim_summary",), silver.simulation_result)
    sources = ("prod_daily", "prod_monthly", "ddr_activity", "trajectory_station", "las_curve_header", "las_sample", "vsp_checkshot", "sim_summary")
    r.model("silver_wellbore_identity", sources, lambda *tables: silver.wellbore_identity(list(tables)))
    r.model("dim_wellbore", ("silver_production_daily",), gold.dim_wellbore)
    r.model("dim_well", ("silver_wellbore_identity",), gold.dim_well)
    r.model("dim_curve", ("silver_log_curve",), gold.dim_curve)
    r.model("dim_facility", ("silver_production_daily",), gold.dim_facility)
    r.model("dim_date", ("silver_production_daily",), lambda daily: gold.dim_date(daily.sparkSession))
    r.model("fct_production_daily", ("silver_production_daily", "dim_wellbore"), gold.fct_production_daily)
    r.model("fct_production_monthly", ("silver_production_monthly", "dim_wellbore"), gold.fct_production_monthly)
    r.model("fct_log_sample", ("silver_log_sample", "dim_wellbore"), gold.fct_log_sample)
    r.model("fct_simulation", ("silver_simulation_result", "dim_wellbore"), gold.fct_simulation)
    r.model("fct_trajectory", ("silver_trajectory_station", "dim_wellbore"), gold.fct_trajectory)
    r.model("fct_drilling_state", ("drilling_telemetry",), gold.fct_drilling_state)
    r.model("mart_allocation_reconciliation", ("silver_production_daily", "silver_production_monthly"), mart.mart_allocation_reconciliation)
    r.model("mart_well_performance", ("silver_production_daily",), mart.mart_well_performance)
    r.model("mart_drilling_efficiency", ("fct_drilling_state",), mart.mart_drilling_efficiency)
    r.model("mart_identity_coverage", ("silver_wellbore_identity",), mart.mart_identity_coverage)
    return r
