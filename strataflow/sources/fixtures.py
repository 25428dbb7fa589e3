"""Small made-up inputs with the cases the rules are about, the same for the same seed.

Each stream of values has a generator of its own, so one more value in one doesn't move the others.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import random

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators.rig import STATES

WELLS = ("15/9-X-1", "15/9-X-2", "15/9-X-3 A", "15/9-X-4")
#: The same wellbore as four sources write it.
SPELLINGS = ("15/9-X-3 A", "15_9-X-3 A", "NO 15/9-X-3 A", "Norway-Statoil-15_$47$_9-X-3 A")
#: Shares of states in made-up telemetry. Fixed values.
STATE_SHARES = {"DRILLING": 0.35, "CIRCULATING": 0.15, "TRIPPING_IN": 0.12, "TRIPPING_OUT": 0.12, "CONNECTION": 0.16, "STATIC": 0.10}


def stream(seed: int, name: str) -> random.Random:
    return random.Random(int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:8], "big"))


def production(spark: SparkSession, seed: int = 42, days: int = 120) -> tuple[DataFrame, DataFrame]:
    """(daily, monthly) as text. Planted: volume without uptime, an injector with oil, months off by some per cent."""
    start, rows, months = dt.date(2012, 1, 1), [], {}
    for k, well in enumerate(WELLS):
        draw, injector = stream(seed, f"production:{well}"), k == 3
        rate = draw.uniform(200, 800)
        for d in range(days):
            day = start + dt.timedelta(days=d)
            hours = 24.0 if draw.random() > 0.1 else round(draw.uniform(1, 23), 1)
            oil = 0.0 if injector else round(rate * 0.999**d * hours / 24, 2)
            if k == 0 and d == 10:
                hours, oil = 0.0, 412.5
            if injector and d == 20:
                oil = 37.5
            serial = (day - dt.date(1899, 12, 30)).days
            rows.append((str(serial), f"NO {well}", str(hours), str(oil), str(round(oil * 140, 1)), str(round(oil * 0.2, 2)), "1500" if injector else None, "WI" if injector else "OP", "injection" if injector else "production", "50", "%"))
            months.setdefault((well, day.year, day.month), []).append(0.0 if injector else oil)
    daily = spark.createDataFrame(rows, "dateprd string, well_bore_code string, on_stream_hrs string, bore_oil_vol string, bore_gas_vol string, bore_wat_vol string, bore_wi_vol string, well_type string, flow_kind string, avg_choke_size_p string, avg_choke_uom string")
    factor = lambda p: 1.085 if p % 7 == 3 else 0.94 if p % 5 == 1 else 1.001
    reported = [(w, str(y), str(m), str(round(sum(v) * factor(p), 2)), "NULL", "NULL") for p, ((w, y, m), v) in enumerate(sorted(months.items()))]
    return daily, spark.createDataFrame(reported, "wellbore_name string, year string, month string, oil string, gi string, wi string")


def telemetry(spark: SparkSession, seed: int = 42, samples: int = 500, step_s: int = 5) -> DataFrame:
    """Samples of one wellbore whose states follow the shares, each held for a while, with the state meant."""
    draw, rows, at = stream(seed, "telemetry"), [], dt.datetime(2020, 1, 1)
    bit, hole, block, state, left = 990.0, 1000.0, 2.0, "STATIC", 0
    for _ in range(samples):
        if not left:
            state, left = draw.choices(STATES, [STATE_SHARES[s] for s in STATES])[0], draw.randint(20, 60)
        left -= 1
        flow, rpm, wob = {"DRILLING": (2200.0, 120.0, 12.0), "CIRCULATING": (2200.0, 60.0, 0.5), "CONNECTION": (0.0, 0.0, 0.0)}.get(state, (300.0, 10.0, 0.5))
        if state == "DRILLING":
            bit = hole = hole + 0.02
        elif state == "TRIPPING_IN":
            bit = min(hole, bit + 1.0)
        elif state == "TRIPPING_OUT":
            bit = max(0.0, bit - 1.0)
        elif state == "CONNECTION":
            block = 2.0 if block > 25 else block + 1.0
        rows.append((WELLS[0], at, bit, hole, block, flow, rpm, wob, state))
        at += dt.timedelta(seconds=step_s)
    return spark.createDataFrame(rows, "wellbore_uid string, ts timestamp, bit_depth_m double, hole_depth_m double, block_position_m double, flow_in_lpm double, rpm double, wob_klbf double, meant string")


def trajectories(spark: SparkSession, seed: int = 42, stations: int = 40) -> DataFrame:
    """A survey per spelling of the same wellbore, stations 30 m apart."""
    rows = []
    for k, name in enumerate(SPELLINGS):
        draw, inclination = stream(seed, f"trajectory:{k}"), 0.0
        for n in range(stations):
            inclination = min(80.0, inclination + draw.uniform(0, 3))
            rows.append((name, f"t{k}", str(n + 1), str(30 * n), str(round(inclination, 3)), "dega", str(round(draw.uniform(40, 45), 3)), "dega"))
    return spark.createDataFrame(rows, "_source_identifier string, trajectory_uid string, station_seq string, md string, incl string, incl_uom string, azi string, azi_uom string")


def picks_and_perforations(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """A perforation from 3,120 to 3,220 m over a formation boundary at 3,180 m."""
    picks = [(WELLS[0], "UPPER", 3000.0, 3180.0), (WELLS[0], "LOWER", 3180.0, 3400.0)]
    return spark.createDataFrame(picks, "wellbore_uid string, formation string, top_m double, base_m double"), spark.createDataFrame([(WELLS[0], 3120.0, 3220.0)], "wellbore_uid string, perf_top_m double, perf_base_m double")
