"""Queries of every relational operator over the driver's tables, each with its twin in DuckDB's SQL.

The tables are not field data, so each query first dresses them up: suppliers are wellbores, ship
dates production days, users rigs. All dressing is exact (integers, or integers over ten), so that
both engines see the same input. Every row of a table is dressed: where partners are to be missing,
keys are moved out of the way.

Landing tables and typed models that several queries start from are written when first asked for, as
the registry writes them; the query of a model builds it from its landing table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.functions import scalars as s
from strataflow.operators import checks, contract, history, identity, joins, production, rig, runs, survey
from strataflow.operators.dedup import dedup_by_row_hash, keep_first, most_frequent
from strataflow.plans import bronze, gold, mart, profile, scratch, silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# ---------------------------------------------------------------- dressing

DAILY = """
    daily AS (
        SELECT 'W' || CAST(l_suppkey AS VARCHAR) AS wellbore_uid, CAST(l_shipdate AS DATE) AS prod_date,
               CASE WHEN max(l_returnflag) = 'R' AND min(l_returnflag) = 'R' THEN 'WI' ELSE 'OP' END AS well_type,
               CAST(CAST(sum(l_quantity) AS BIGINT) % 30 AS DOUBLE) AS on_stream_hrs,
               CAST(CASE WHEN (max(l_suppkey) + day(max(l_shipdate))) % 5 = 0 THEN 0 ELSE sum(CAST(round(l_extendedprice * 100) AS BIGINT)) END AS DOUBLE) AS oil_raw,
               CAST(sum(l_linenumber) AS DOUBLE) AS gas_raw,
               CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS water_raw,
               CAST(sum(l_partkey % 100) AS DOUBLE) AS wi_raw,
               max(l_suppkey) % 4 AS facility
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)),
    silver AS (
        SELECT wellbore_uid, prod_date, on_stream_hrs, well_type, facility,
               CASE WHEN well_type = 'WI' THEN 0.0 ELSE oil_raw END AS oil_sm3, CASE WHEN well_type = 'WI' THEN 0.0 ELSE gas_raw END AS gas_sm3,
               CASE WHEN well_type = 'WI' THEN 0.0 ELSE water_raw END AS water_sm3, CASE WHEN well_type = 'WI' THEN wi_raw ELSE 0.0 END AS injected_sm3,
               oil_raw AS reported_bore_oil_vol
        FROM daily)"""


def daily_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.model(spark, sf_dir, "prod_daily", lambda: _land_daily(spark, sf_dir))


def _land_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table of daily production, every tenth wellbore's rows loaded twice."""
    day = F.to_date("l_shipdate")
    all_r = (F.max("l_returnflag") == "R") & (F.min("l_returnflag") == "R")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", day.alias("day")).agg(
        F.when(all_r, "WI").otherwise("OP").alias("well_type"),
        (F.sum("l_quantity").cast("long") % 30).alias("on_stream_hrs"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("oil"),
        F.sum("l_linenumber").alias("bore_gas_vol"),
        F.sum(F.round(F.col("l_tax") * 100).cast("long")).alias("bore_wat_vol"),
        F.sum(F.col("l_partkey") % 100).alias("bore_wi_vol"),
    )
    unit = F.when(F.col("l_suppkey") % 2 == 0, "FRAC").otherwise(" pct ")
    rows = rows.select(
        F.datediff("day", F.lit(s.SPREADSHEET_EPOCH).cast("date")).alias("dateprd"),
        F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("well_bore_code"),
        (F.col("l_suppkey") % 4).alias("npd_facility_code"), F.concat(F.lit("FACILITY "), (F.col("l_suppkey") % 4).cast("string")).alias("npd_facility_name"),
        "on_stream_hrs", (F.col("on_stream_hrs") * 2).alias("avg_choke_size_p"), unit.alias("avg_choke_uom"),
        F.when((F.col("l_suppkey") + F.dayofmonth("day")) % 5 == 0, 0).otherwise(F.col("oil")).alias("bore_oil_vol"), "bore_gas_vol", "bore_wat_vol", "bore_wi_vol",
        F.when(F.col("well_type") == "WI", "injection").otherwise("production").alias("flow_kind"), "well_type", F.col("l_suppkey").alias("_n"),
    )
    business = [c for c in rows.columns if c != "_n"]
    loads = F.when(F.col("_n") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    named = rows.withColumns({"_source_identifier": F.col("well_bore_code"), "_source_file": F.lit("daily.xlsx")}).withColumn("_load", F.explode(loads))
    landed = bronze.add_technical_columns(named, [*business, "_load"], "PROD", "batch-1", "2024-01-01T00:00:00+00:00")
    second = F.col("_load") == "2"
    landed = landed.withColumns({"_batch_id": F.when(second, "batch-2").otherwise(F.col("_batch_id")), "_ingested_at": F.when(second, "2024-01-02T00:00:00+00:00").otherwise(F.col("_ingested_at")), "_row_hash": s.row_hash(*business)})
    return landed.drop("_load").withColumn("_wellbore_uid", F.col("_source_identifier"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.model(spark, sf_dir, "silver_production_daily", lambda: silver.production_daily(daily_bronze(spark, sf_dir)))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.model(spark, sf_dir, "silver_production_monthly", lambda: silver.production_monthly(monthly_bronze(spark, sf_dir)))


def wellbores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.model(spark, sf_dir, "dim_wellbore", lambda: gold.dim_wellbore(daily(spark, sf_dir)))


REPORTED = """
    sums AS (SELECT wellbore_uid, CAST(year(prod_date) * 100 + month(prod_date) AS INTEGER) AS month_key,
                    sum(oil_sm3) AS oil_sm3, sum(gas_sm3) AS gas_sm3, sum(water_sm3) AS water_sm3 FROM silver GROUP BY 1, 2),
    reported AS (SELECT wellbore_uid, CASE WHEN month_key % 9 = 4 OR month_key % 7 = 2 THEN month_key + 5000 ELSE month_key END AS month_key,
                        CAST(CAST(oil_sm3 AS BIGINT) * (CASE WHEN month_key % 3 = 0 THEN 105 ELSE 100 END) // 100 AS DOUBLE) AS oil_sm3,
                        CAST(CASE WHEN month_key % 4 = 1 THEN 0 ELSE CAST(gas_sm3 AS BIGINT) END AS DOUBLE) AS gas_sm3, water_sm3
                 FROM sums)"""


def monthly_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.model(spark, sf_dir, "prod_monthly", lambda: _land_monthly(spark, sf_dir))


def _land_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table of reported months: some off by five per cent, some out of place and so missing where they belong."""
    sums = production.monthly_sums(daily(spark, sf_dir))
    year = F.expr("month_key div 100 + case when month_key % 9 = 4 or month_key % 7 = 2 then 50 else 0 end")
    rows = sums.select(
        F.col("wellbore_uid").alias("wellbore_name"), F.lit("1").alias("npdcode"), year.alias("year"), F.expr("month_key % 100").alias("month"), F.lit(720).alias("on_stream"),
        F.expr("cast(oil_sm3 as bigint) * (case when month_key % 3 = 0 then 105 else 100 end) div 100").alias("oil"),
        F.expr("case when month_key % 4 = 1 then 0 else cast(gas_sm3 as bigint) end").alias("gas"), F.expr("cast(water_sm3 as bigint)").alias("water"),
        F.lit("NULL").alias("gi"), F.lit("NULL").alias("wi"), F.col("wellbore_uid").alias("_source_identifier"), F.lit("monthly.xlsx").alias("_source_file"),
    )
    business = [c for c in rows.columns if not c.startswith("_")]
    return bronze.add_technical_columns(rows, business, "PROD_MONTHLY", "batch-1", "2024-01-01T00:00:00+00:00").withColumn("_wellbore_uid", F.col("_source_identifier"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


TELEMETRY = """
    telemetry AS (
        SELECT CAST(user_id AS VARCHAR) AS wellbore_uid, ts, event_id, 1000 + (event_id * 37 % 1000) / 10.0 AS bit_depth_m,
               1000 + (event_id * 37 % 1000) / 10.0 + CASE WHEN event_id % 3 = 0 THEN 0.25 ELSE 5.0 END AS hole_depth_m,
               (event_id * 13 % 70) / 10.0 AS block_position_m, CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 5) * 600.0 END AS flow_in_lpm,
               CAST(event_id % 7 AS DOUBLE) AS rpm, CAST(event_id % 4 AS DOUBLE) AS wob_klbf
        FROM events)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = 1000 + (F.col("event_id") * 37 % 1000) / 10.0
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("wellbore_uid"), "ts", "event_id", depth.alias("bit_depth_m"), (depth + F.when(F.col("event_id") % 3 == 0, 0.25).otherwise(5.0)).alias("hole_depth_m"),
        ((F.col("event_id") * 13 % 70) / 10.0).alias("block_position_m"), F.when(F.col("event_id") % 11 == 0, None).otherwise((F.col("event_id") % 5) * 600.0).alias("flow_in_lpm"),
        (F.col("event_id") % 7).cast("double").alias("rpm"), (F.col("event_id") % 4).cast("double").alias("wob_klbf"),
    )


STATIONS = """
    ordered AS (
        SELECT l_orderkey, row_number() OVER w AS seq, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS md,
               l_discount * 900 AS inclination_deg, l_tax * 4500 AS azimuth_deg
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
    legs AS (
        SELECT *, lag(md) OVER o AS md0, radians(lag(inclination_deg) OVER o) AS i1, radians(lag(azimuth_deg) OVER o) AS a1, radians(inclination_deg) AS i2, radians(azimuth_deg) AS a2
        FROM ordered WINDOW o AS (PARTITION BY l_orderkey ORDER BY md)),
    bent AS (SELECT *, CASE WHEN md0 IS NULL THEN 0.0 ELSE acos(least(1.0, greatest(-1.0, cos(i2 - i1) - sin(i1) * sin(i2) * (1 - cos(a2 - a1))))) END AS dl FROM legs),
    steps AS (SELECT *, CASE WHEN dl < 1e-4 THEN 1 + dl * dl / 12 ELSE 2 / dl * tan(dl / 2) END * (md - md0) / 2 AS h FROM bent),
    curve AS (
        SELECT l_orderkey, seq, md, inclination_deg, azimuth_deg, sum(coalesce(h * (cos(i1) + cos(i2)), 0)) OVER o AS tvd, sum(coalesce(h * (sin(i1) * cos(a1) + sin(i2) * cos(a2)), 0)) OVER o AS north,
               sum(coalesce(h * (sin(i1) * sin(a1) + sin(i2) * sin(a2)), 0)) OVER o AS east, degrees(dl) AS dogleg_deg,
               CASE WHEN md > md0 THEN degrees(dl) * 30 / (md - md0) ELSE 0.0 END AS dls_deg_30m
        FROM steps WINDOW o AS (PARTITION BY l_orderkey ORDER BY md ROWS UNBOUNDED PRECEDING))"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, sf_dir, "lineitem").withColumns({"seq": F.row_number().over(w).cast("long"), "md": F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    return rows.select("l_orderkey", "seq", "md", (F.col("l_discount") * 900).alias("inclination_deg"), (F.col("l_tax") * 4500).alias("azimuth_deg"))


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.minimum_curvature(stations(spark, sf_dir), "l_orderkey")


# ---------------------------------------------------------------- scalars

_PRICE = "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)"


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sha256(concat(CAST(l_orderkey AS VARCHAR), chr(31), CAST(l_partkey AS VARCHAR), chr(31), CAST(l_suppkey AS VARCHAR), chr(31), CAST(l_linenumber AS VARCHAR), chr(31), l_returnflag, chr(31))) AS row_hash FROM lineitem""")
def bronze_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s.row_hash(*keys, "l_returnflag").alias("row_hash"))


@query(f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_PRICE} AS p FROM lineitem),
    x AS (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN ' 1 ' || p || ',5 ' WHEN 1 THEN p WHEN 2 THEN 'n/a' ELSE '' END AS raw FROM t)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 4 WHEN 0 THEN CAST('1' || p || '.5' AS DOUBLE) WHEN 1 THEN CAST(p AS DOUBLE) END AS number FROM x""")
def to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    kind = F.col("l_linenumber") % 4
    raw = F.when(kind == 0, F.concat(F.lit(" 1 "), price, F.lit(",5 "))).when(kind == 1, price).when(kind == 2, "n/a").otherwise("")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s.to_number(raw).alias("number"))


@query("""
    SELECT event_id, CASE WHEN event_id % 10 IN (0, 3, 6) THEN NULL ELSE CAST(event_id AS DOUBLE) / 4 END AS value, event_id % 10 IN (0, 3, 6) AS was_sentinel FROM events""")
def null_if_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = F.when(F.col("event_id") % 2 == 0, "-999.25").otherwise("-9999")
    kind = F.col("event_id") % 10
    raw = F.when(kind == 0, "-999.2500").when(kind == 3, " -9999.0").when(kind == 6, "NaN").otherwise((F.col("event_id") / 4).cast("decimal(20,2)").cast("string"))
    value = s.null_if_sentinel(raw, declared)
    return events(spark, sf_dir).select("event_id", value.alias("value"), (value.isNull() & raw.isNotNull()).alias("was_sentinel"))


@query("""SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, CAST(l_shipdate AS DATE) AS from_serial, CAST(l_shipdate AS DATE) AS from_iso,
                 CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month_key, CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS date_key,
                 CAST(NULL AS DATE) AS bad_serial, CAST(NULL AS DATE) AS bad_iso FROM lineitem""")
def dates_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    serial = F.concat(F.datediff("day", F.lit(s.SPREADSHEET_EPOCH).cast("date")).cast("string"), F.lit(".75"))
    iso = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T23:59:00+02:00"))
    return days.select(
        "day", s.date_from_excel_serial(serial).alias("from_serial"), s.date_from_iso(iso).alias("from_iso"), s.month_key("day").alias("month_key"), s.date_key("day").alias("date_key"),
        s.date_from_excel_serial(F.concat(F.lit("-"), serial)).alias("bad_serial"), s.date_from_iso(F.date_format("day", "yyyy")).alias("bad_iso"),
    )


@query("""SELECT o_orderkey, md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(nullif(o_orderstatus, 'F'), ''), coalesce(o_orderpriority, ''))) AS key_hash FROM orders""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", s.surrogate_key("o_orderkey", F.nullif("o_orderstatus", F.lit("F")), "o_orderpriority").alias("key_hash"))


@query("""
    SELECT event_id, CAST(event_id AS VARCHAR) AS as_text, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value / (event_id % 3) END AS safe_divide, CAST(strpos(event_type, 'e') AS INTEGER) AS position,
           CAST(date_sub('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS BIGINT) AS seconds_between FROM events""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return events(spark, sf_dir).select(
        "event_id", s.as_text("event_id").alias("as_text"), s.safe_divide(F.col("value"), F.col("event_id") % 3).alias("safe_divide"), s.position("event_type", "e").alias("position"),
        s.seconds_between(start, F.col("ts").cast("timestamp")).alias("seconds_between"),
    )


@query("""
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) * 100 + month(d) AS INTEGER) AS month_key, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month
    FROM (SELECT unnest(generate_series(DATE '2008-06-01', DATE '2016-09-30', INTERVAL 1 DAY)) AS d)""")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(spark)


# ---------------------------------------------------------------- landing tables

@query("""SELECT event_id, event_type, 'batch-1' AS _batch_id FROM events""")
def dedup_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type")
    loads = [bronze.add_technical_columns(rows, ["event_id", "event_type"], "EVENTS", f"batch-{k}", f"2024-01-0{k}T00:00:00+00:00") for k in (2, 1, 3)]
    out = dedup_by_row_hash(loads[0].unionByName(loads[1]).unionByName(loads[2]))
    return out.select(F.col("event_id").cast("long").alias("event_id"), "event_type", "_batch_id")


@query("""
    WITH h AS (SELECT sha256(concat(CAST(event_id AS VARCHAR), chr(31), event_type, chr(31))) AS h FROM events)
    SELECT count(*) AS rows, count(DISTINCT h) AS hashes, CAST(sum(CAST('0x' || substr(h, 1, 8) AS BIGINT)) AS BIGINT) AS checksum FROM h""")
def table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.table_state(bronze.add_technical_columns(events(spark, sf_dir), ["event_id", "event_type"], "EVENTS"))


@query("""SELECT count(*) AS rows, count(*) FILTER (user_id % 2 = 0) AS rows_with_uid, 100.0 * count(*) FILTER (user_id % 2 = 0) / count(*) AS uid_pct FROM events""")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string"))
    crosswalk = events(spark, sf_dir).select("user_id").distinct().select(F.lit("EVENTS").alias("source_system"), F.col("user_id").cast("string").alias("source_identifier"), uid.alias("wellbore_uid"))
    rows = events(spark, sf_dir).withColumn("_source_identifier", F.col("user_id").cast("string"))
    return bronze.table_counts(bronze.add_technical_columns(rows, ["event_id"], "EVENTS", crosswalk=crosswalk))


@query("""SELECT count(*) FILTER (d < DATE '1996-01-01') AS before, count(*) FILTER (d > DATE '1999-12-31') AS after, count(*) FILTER (d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') AS inside, count(*) FILTER (d IS NULL) AS unparseable
           FROM (SELECT CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS d FROM lineitem)""")
def out_of_replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") != 3, F.to_date("l_shipdate")).alias("day"))
    return bronze.out_of_replay_window(rows, "day", "1996-01-01", "1999-12-31")


# ---------------------------------------------------------------- typed tables and marts

@query(f"""WITH {DAILY} SELECT wellbore_uid, prod_date, on_stream_hrs, well_type, oil_sm3, gas_sm3, water_sm3, injected_sm3, reported_bore_oil_vol,
           CASE WHEN CAST(substr(wellbore_uid, 2) AS INTEGER) % 2 = 0 THEN on_stream_hrs * 200 ELSE on_stream_hrs * 2 END AS choke_pct FROM silver""")
def silver_production_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.production_daily(daily_bronze(spark, sf_dir)).select("wellbore_uid", "prod_date", "on_stream_hrs", "well_type", "oil_sm3", "gas_sm3", "water_sm3", "injected_sm3", "reported_bore_oil_vol", "choke_pct")


@query(f"""WITH {DAILY}, {REPORTED} SELECT wellbore_uid, CAST(month_key AS INTEGER) AS month_key, oil_sm3, gas_sm3, water_sm3, CAST(NULL AS DOUBLE) AS gas_injected_sm3 FROM reported""")
def silver_production_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.production_monthly(monthly_bronze(spark, sf_dir)).select("wellbore_uid", "month_key", "oil_sm3", "gas_sm3", "water_sm3", "gas_injected_sm3")


@query(f"""
    WITH {DAILY}
    SELECT wellbore_uid, prod_date, 'volume_without_uptime' AS rule FROM silver WHERE on_stream_hrs = 0 AND (oil_sm3 > 0 OR gas_sm3 > 0 OR water_sm3 > 0)
    UNION ALL SELECT wellbore_uid, prod_date, 'uptime_without_volume' FROM silver WHERE on_stream_hrs > 0 AND oil_sm3 = 0 AND gas_sm3 = 0 AND water_sm3 = 0 AND injected_sm3 = 0
    UNION ALL SELECT wellbore_uid, prod_date, 'uptime_out_of_range' FROM silver WHERE on_stream_hrs < 0 OR on_stream_hrs > 24""")
def production_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production.quarantine(daily(spark, sf_dir)).select("wellbore_uid", "prod_date", "rule")


@query(f"""
    WITH {DAILY}, {REPORTED},
    b AS (SELECT wellbore_uid, month_key, s.oil_sm3 AS daily_oil, s.gas_sm3 AS daily_gas, s.water_sm3 AS daily_water, r.oil_sm3 AS monthly_oil, r.gas_sm3 AS monthly_gas, r.water_sm3 AS monthly_water,
                 s.oil_sm3 IS NULL AS missing_from_daily, r.oil_sm3 IS NULL AS missing_from_monthly
          FROM sums s FULL JOIN reported r USING (wellbore_uid, month_key)),
    v AS (SELECT *, daily_oil - monthly_oil AS oil_variance, daily_gas - monthly_gas AS gas_variance, daily_water - monthly_water AS water_variance FROM b),
    f AS (SELECT *, oil_variance / nullif(monthly_oil, 0) AS oil_fraction, gas_variance / nullif(monthly_gas, 0) AS gas_fraction, water_variance / nullif(monthly_water, 0) AS water_fraction FROM v)
    SELECT wellbore_uid, CAST(month_key AS INTEGER) AS month_key, daily_oil, daily_gas, daily_water, monthly_oil, monthly_gas, monthly_water, missing_from_daily, missing_from_monthly, oil_variance, gas_variance, water_variance,
           round(oil_fraction, 6) AS oil_fraction, round(gas_fraction, 6) AS gas_fraction, round(water_fraction, 6) AS water_fraction,
           missing_from_daily OR missing_from_monthly OR abs(coalesce(oil_fraction, 0)) > 0.02 OR abs(coalesce(gas_fraction, 0)) > 0.02 OR abs(coalesce(water_fraction, 0)) > 0.02 AS out_of_tolerance
    FROM f""")
def allocation_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mart.mart_allocation_reconciliation(daily(spark, sf_dir), monthly(spark, sf_dir)))


@query(f"""
    WITH {DAILY}, first AS (SELECT wellbore_uid, arg_min(oil_sm3, prod_date) AS first_oil_sm3 FROM silver WHERE oil_sm3 > 0 GROUP BY 1)
    SELECT wellbore_uid, prod_date, round(oil_sm3 * 6.2898, 4) AS oil_boe, round(oil_sm3 / nullif(on_stream_hrs, 0), 6) AS oil_rate_per_h, round(water_sm3 / nullif(oil_sm3 + water_sm3, 0), 6) AS water_cut,
           round(gas_sm3 / nullif(oil_sm3, 0), 6) AS gas_oil_ratio, round(on_stream_hrs / 24, 6) AS uptime, round((oil_sm3 - first_oil_sm3) / nullif(first_oil_sm3, 0), 6) AS change_since_first_oil
    FROM silver LEFT JOIN first USING (wellbore_uid)""")
def well_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mart.mart_well_performance(daily(spark, sf_dir))
    places = {"oil_boe": 4, "oil_rate_per_h": 6, "water_cut": 6, "gas_oil_ratio": 6, "uptime": 6, "change_since_first_oil": 6}
    return out.select("wellbore_uid", "prod_date", *[F.round(c, n).alias(c) for c, n in places.items()])


@query(f"""
    WITH {DAILY} SELECT CAST(facility AS VARCHAR) AS npd_facility_code, 'FACILITY ' || CAST(facility AS VARCHAR) AS facility_name, count(DISTINCT wellbore_uid) AS wellbores, min(prod_date) AS first_seen, max(prod_date) AS last_seen,
           md5(CAST(facility AS VARCHAR)) AS facility_key FROM silver GROUP BY facility""")
def dim_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_facility(daily(spark, sf_dir))


_ROLES = """
    roles AS (SELECT wellbore_uid, prod_date, CASE WHEN well_type = 'WI' THEN 'INJECTOR' ELSE 'PRODUCER' END AS well_role FROM silver),
    marked AS (SELECT *, CASE WHEN lag(well_role) OVER w IS DISTINCT FROM well_role THEN 1 ELSE 0 END AS n FROM roles WINDOW w AS (PARTITION BY wellbore_uid ORDER BY prod_date)),
    numbered AS (SELECT *, sum(n) OVER (PARTITION BY wellbore_uid ORDER BY prod_date ROWS UNBOUNDED PRECEDING) AS version_number FROM marked),
    grouped AS (SELECT wellbore_uid, CAST(version_number AS INTEGER) AS version_number, min(well_role) AS well_role, min(prod_date) AS valid_from FROM numbered GROUP BY 1, 2),
    versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY wellbore_uid ORDER BY version_number) AS valid_to, md5(wellbore_uid || '|' || CAST(version_number AS VARCHAR)) AS wellbore_key FROM grouped)"""


@query(f"""WITH {DAILY}, {_ROLES} SELECT wellbore_uid, well_role, version_number, valid_from, valid_to, valid_to IS NULL AS is_current, wellbore_key FROM versions""")
def dim_wellbore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_wellbore(daily(spark, sf_dir)).drop("operator_label")


@query(f"""
    WITH {DAILY}, {_ROLES}
    SELECT s.wellbore_uid, s.prod_date, s.oil_sm3, CAST(year(prod_date) * 10000 + month(prod_date) * 100 + day(prod_date) AS INTEGER) AS date_key, coalesce(v.wellbore_key, md5('UNRESOLVED|' || s.wellbore_uid)) AS wellbore_key
    FROM silver s LEFT JOIN (SELECT * REPLACE (CASE WHEN CAST(substr(wellbore_uid, 2) AS INTEGER) % 5 = 0 THEN 'moved ' || wellbore_uid ELSE wellbore_uid END AS wellbore_uid) FROM versions) v
      ON s.wellbore_uid = v.wellbore_uid AND s.prod_date >= v.valid_from AND (v.valid_to IS NULL OR s.prod_date < v.valid_to)""")
def fct_production_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.expr("cast(substring(wellbore_uid, 2) as int) % 5 = 0"), F.concat(F.lit("moved "), "wellbore_uid")).otherwise(F.col("wellbore_uid"))
    known = wellbores(spark, sf_dir).withColumn("wellbore_uid", moved)
    return gold.fct_production_daily(daily(spark, sf_dir), known).select("wellbore_uid", "prod_date", "oil_sm3", "date_key", "wellbore_key")


@query(f"""
    WITH {DAILY}, {REPORTED}, {_ROLES}
    SELECT r.wellbore_uid, CAST(r.month_key AS INTEGER) AS month_key, r.oil_sm3, v.wellbore_key FROM reported r LEFT JOIN versions v ON r.wellbore_uid = v.wellbore_uid AND v.valid_to IS NULL""")
def fct_production_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_production_monthly(monthly(spark, sf_dir), wellbores(spark, sf_dir)).select("wellbore_uid", "month_key", "oil_sm3", "wellbore_key")


# ---------------------------------------------------------------- history over events

_TYPES = """
    marked AS (SELECT user_id, ts, event_type, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS version_number FROM marked),
    grouped AS (SELECT user_id, CAST(version_number AS INTEGER) AS version_number, min(event_type) AS event_type, min(ts) AS valid_from FROM numbered GROUP BY 1, 2),
    versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY version_number) AS valid_to, md5(CAST(user_id AS VARCHAR) || '|' || CAST(version_number AS VARCHAR)) AS key_hash FROM grouped)"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2(events(spark, sf_dir), "user_id", ["event_type"], "ts", chunk=F.to_date("ts"))


@query(f"""WITH {_TYPES} SELECT user_id, event_type, version_number, valid_from, valid_to, valid_to IS NULL AS is_current, key_hash FROM versions""")
def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir)


@query(f"""
    WITH {_TYPES} SELECT e.event_id, coalesce(v.key_hash, md5('UNRESOLVED|' || CAST(e.user_id AS VARCHAR))) AS version_key
    FROM events e LEFT JOIN (SELECT * REPLACE (CASE WHEN user_id % 4 = 0 THEN -1 - user_id ELSE user_id END AS user_id) FROM versions) v ON e.user_id = v.user_id AND e.ts >= v.valid_from AND (v.valid_to IS NULL OR e.ts < v.valid_to)""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("user_id") % 4 == 0, -1 - F.col("user_id")).otherwise(F.col("user_id"))
    joined = history.asof_join(events(spark, sf_dir), _versions(spark, sf_dir).withColumn("user_id", moved), "user_id", "ts", {"key_hash": "found"}, chunk=lambda t: F.to_date(t))
    return joined.select("event_id", F.coalesce("found", history.unresolved_key("user_id")).alias("version_key"))


@query("""SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1""")
def most_frequent_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return most_frequent(events(spark, sf_dir), "user_id", "event_type")


@query("""SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(events(spark, sf_dir), ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").asc_nulls_last()]).select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- rig states


def _states(minutes: int) -> str:
    return f"""{TELEMETRY},
    moved AS (SELECT *, date_sub('second', lag(ts) OVER w, ts) AS gap, bit_depth_m - lag(bit_depth_m) OVER w AS step,
                     coalesce(max(block_position_m) OVER f - min(block_position_m) OVER f, 0) AS travel
              FROM telemetry WINDOW w AS (PARTITION BY wellbore_uid ORDER BY ts), f AS (PARTITION BY wellbore_uid ORDER BY ts RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW)),
    rated AS (SELECT *, CASE WHEN coalesce(gap, 0) = 0 THEN 0.0 ELSE step / gap END AS rate, coalesce(flow_in_lpm, 0) AS flow FROM moved),
    states AS (SELECT *, CASE WHEN flow < 100 AND rpm < 5 AND travel >= 0.5 THEN 'CONNECTION' WHEN rate < -0.05 AND wob_klbf < 2 THEN 'TRIPPING_OUT' WHEN rate > 0.05 AND wob_klbf < 2 THEN 'TRIPPING_IN'
                     WHEN abs(bit_depth_m - hole_depth_m) <= 0.5 AND wob_klbf > 2 AND flow > 1000 THEN 'DRILLING' WHEN flow > 1000 AND abs(rate) < 0.01 THEN 'CIRCULATING' ELSE 'STATIC' END AS state FROM rated)"""


_SPANS = """
    marked AS (SELECT *, row_number() OVER (PARTITION BY wellbore_uid ORDER BY ts) - row_number() OVER (PARTITION BY wellbore_uid, state ORDER BY ts) AS island FROM states),
    grouped AS (SELECT wellbore_uid, state, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS samples, min(bit_depth_m) AS depth_from, max(bit_depth_m) AS depth_to, arg_min(bit_depth_m, ts) AS first_depth, arg_max(bit_depth_m, ts) AS last_depth
                FROM marked GROUP BY wellbore_uid, state, island),
    spans AS (SELECT *, CAST(row_number() OVER (PARTITION BY wellbore_uid ORDER BY started_at) AS INTEGER) AS state_seq, CAST(date_sub('second', started_at, ended_at) AS BIGINT) AS duration_s FROM grouped),
    npt AS (SELECT *, state = 'STATIC' AND duration_s > 1800 AS is_npt FROM spans)"""


@query(f"WITH {_states(10)} SELECT event_id, state, round(rate, 9) AS rate, round(travel, 6) AS travel FROM states")
def rig_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rig.rig_states(telemetry(spark, sf_dir)).select("event_id", "state", F.round("rate", 9).alias("rate"), F.round("travel", 6).alias("travel"))


@query(f"WITH {_states(360)} SELECT event_id, state, round(travel, 6) AS travel FROM states")
def rig_state_six_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rig.rig_states(telemetry(spark, sf_dir), rules=rig.RigRules(frame_minutes=360)).select("event_id", "state", F.round("travel", 6).alias("travel"))


@query(f"WITH {_states(10)}, {_SPANS} SELECT * FROM npt")
def fct_drilling_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_drilling_state(telemetry(spark, sf_dir))


@query(f"""
    WITH {_states(10)}, {_SPANS},
    a AS (SELECT wellbore_uid, sum(duration_s) AS total_s, sum(CASE WHEN is_npt THEN duration_s ELSE 0 END) AS npt_s, sum(CASE WHEN state = 'DRILLING' THEN duration_s ELSE 0 END) AS drilling_s,
                 sum(CASE WHEN state = 'DRILLING' THEN depth_to - depth_from ELSE 0 END) AS drilled_m, sum(CASE WHEN state = 'CONNECTION' THEN duration_s ELSE 0 END) AS connection_s, count(*) FILTER (state = 'CONNECTION') AS connections
          FROM npt GROUP BY 1)
    SELECT wellbore_uid, CAST(total_s AS BIGINT) AS total_s, CAST(npt_s AS BIGINT) AS npt_s, CAST(drilling_s AS BIGINT) AS drilling_s, round(drilled_m, 6) AS drilled_m, CAST(connection_s AS BIGINT) AS connection_s, connections,
           round(100.0 * npt_s / nullif(total_s, 0), 6) AS npt_pct, round(3600.0 * drilled_m / nullif(drilling_s, 0), 6) AS rop_m_per_h, round(CAST(connection_s AS DOUBLE) / nullif(connections, 0), 6) AS mean_connection_s, round(86400.0 * drilled_m / nullif(total_s, 0), 6) AS m_per_day
    FROM a""")
def drilling_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mart.mart_drilling_efficiency(gold.fct_drilling_state(telemetry(spark, sf_dir))))


# ---------------------------------------------------------------- surveys

@query(f"WITH {STATIONS} SELECT l_orderkey, seq, round(tvd, 5) + 0.0 AS tvd, round(north, 5) + 0.0 AS north, round(east, 5) + 0.0 AS east, round(dls_deg_30m, 5) + 0.0 AS dls_deg_30m FROM curve")
def minimum_curvature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve(spark, sf_dir).select("l_orderkey", "seq", *[(F.round(c, 5) + 0.0).alias(c) for c in ("tvd", "north", "east", "dls_deg_30m")])


@query(f"""
    WITH {STATIONS}, d AS (SELECT l_orderkey, md, CASE WHEN seq % 2 = 0 THEN 0.25 ELSE 0.0 END AS v, CASE WHEN seq % 3 = 0 THEN 0.5 ELSE 0.0 END AS n, CASE WHEN seq % 5 = 0 THEN 1.25 ELSE 0.0 END AS e FROM curve),
    o AS (SELECT *, sqrt(v * v + n * n + e * e) AS off FROM d),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY off DESC, md) AS k FROM o)
    SELECT l_orderkey, CAST(max(v) AS DOUBLE) AS max_tvd, CAST(max(n) AS DOUBLE) AS max_north, CAST(max(e) AS DOUBLE) AS max_east, round(max(off), 6) AS max_position, min(md) FILTER (k = 1) AS md_at_max, max(md) AS max_md,
           round(CASE WHEN max(md) > 0 THEN 100 * max(off) / max(md) END, 6) AS max_position_pct FROM r GROUP BY 1""")
def closure_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our stations against themselves, moved by known steps on all three axes."""
    axes = {"tvd": (2, 0.25), "north": (3, 0.5), "east": (5, -1.25)}
    ours = curve(spark, sf_dir).withColumns({c: F.round(F.col(c) * 4) / 4 for c in axes})  # quarters, so that differences are exact
    theirs = ours.withColumns({c: F.col(c) + F.when(F.col("seq") % n == 0, step).otherwise(0.0) for c, (n, step) in axes.items()})
    out = survey.closure_error(ours, theirs, ["l_orderkey", "seq", "md"], "l_orderkey")
    return rounded(out.select("l_orderkey", "max_tvd", "max_north", "max_east", "max_position", "md_at_max", "max_md", "max_position_pct"))


@query(f"""
    WITH {STATIONS}, p AS (SELECT DISTINCT l_orderkey, CAST(30.0 AS DOUBLE) AS probe FROM lineitem),
    legs2 AS (SELECT l_orderkey, md AS m1, tvd AS v1, lead(md) OVER w AS m2, lead(tvd) OVER w AS v2 FROM curve WINDOW w AS (PARTITION BY l_orderkey ORDER BY md))
    SELECT p.l_orderkey, p.probe, round(CASE WHEN probe = m1 THEN v1 ELSE v1 + (probe - m1) / (m2 - m1) * (v2 - v1) END, 5) + 0.0 AS tvd_at
    FROM p LEFT JOIN legs2 l ON p.l_orderkey = l.l_orderkey AND probe >= m1 AND (probe < m2 OR (m2 IS NULL AND probe = m1))""")
def interpolation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().withColumn("probe", F.lit(30.0))
    return survey.interpolate_at(points, curve(spark, sf_dir), "l_orderkey", "probe").withColumn("tvd_at", F.round("tvd_at", 5) + 0.0)


# ---------------------------------------------------------------- identity

_SPELLED = """
    spelled AS (SELECT s_suppkey, CAST(15 + 3 * (s_suppkey // 1000 % 300) + s_nationkey % 3 AS VARCHAR) AS q, CAST(1 + 9 * (s_suppkey // 300000) + s_nationkey % 9 AS VARCHAR) AS b, CAST(s_suppkey % 1000 AS VARCHAR) AS n,
                       CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'T2' ELSE '' END AS t, s_suppkey % 4 AS v FROM supplier),
    named AS (SELECT *, q || '/' || b || '-F-' || n || CASE WHEN t = '' THEN '' ELSE ' ' || t END AS uid,
                     CASE v WHEN 0 THEN q || '/' || b || '-F-' || n || CASE WHEN t = '' THEN '' ELSE ' ' || t END WHEN 1 THEN 'NO ' || q || '_' || b || '-F' || n || t
                            WHEN 2 THEN 'Norway-Statoil-' || q || '_$47$_' || b || '-f-' || n || '_' || lower(t) ELSE 'Relief well ' || CAST(s_suppkey AS VARCHAR) END AS spelling FROM spelled)"""


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    q = F.expr("cast(15 + 3 * (s_suppkey div 1000 % 300) + s_nationkey % 3 as string)")
    b, n = F.expr("cast(1 + 9 * (s_suppkey div 300000) + s_nationkey % 9 as string)"), (key % 1000).cast("string")
    t = F.when(key % 3 == 0, "A").when(key % 3 == 1, "T2").otherwise("")
    plain = F.concat(q, F.lit("/"), b, F.lit("-F-"), n, F.when(t == "", "").otherwise(F.concat(F.lit(" "), t)))
    spelling = (
        F.when(key % 4 == 0, plain)
        .when(key % 4 == 1, F.concat(F.lit("NO "), q, F.lit("_"), b, F.lit("-F"), n, t))
        .when(key % 4 == 2, F.concat(F.lit("Norway-Statoil-"), q, F.lit("_$47$_"), b, F.lit("-f-"), n, F.lit("_"), F.lower(t)))
        .otherwise(F.concat(F.lit("Relief well "), key.cast("string")))
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", spelling.alias("spelling"))


@query(f"""WITH {_SPELLED} SELECT s_suppkey, spelling, CASE WHEN v < 3 THEN uid END AS wellbore_uid, CASE WHEN v < 3 AND t <> '' THEN t END AS sidetrack, CASE WHEN v = 2 THEN 'Statoil' END AS operator,
           CASE WHEN v = 3 THEN 'no_block_and_quadrant' END AS failure FROM named""")
def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.with_normalized_name(spellings(spark, sf_dir), "spelling").drop("well_uid")


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'W_NUMBER' WHEN 1 THEN 'B_NUMBER' WHEN 2 THEN 'NPD' END AS kind FROM supplier""")
def classify_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad((F.col("s_suppkey") % 10000).cast("string"), 5, "7")
    text = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("W-"), number)).when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("B-"), number)).when(F.col("s_suppkey") % 4 == 2, number).otherwise(F.concat(F.lit("X"), number))
    return table(spark, sf_dir, "supplier").select("s_suppkey", identity.identifier_kind(text).alias("kind"))


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = spellings(spark, sf_dir)
    ids = F.when(F.col("s_suppkey") % 8 == 3, F.array((F.col("s_suppkey") - 3).cast("string"))).when(F.col("s_suppkey") % 4 == 0, F.array(F.col("s_suppkey").cast("string"))).otherwise(F.array().cast("array<string>"))
    return named.select(F.when(F.col("s_suppkey") % 2 == 0, "FILES").otherwise("REPORTS").alias("source_system"), F.col("spelling").alias("source_identifier"), F.lit(2).cast("long").alias("occurrences"), ids.alias("identifiers"), (F.col("s_suppkey") % 4 == 0).alias("defines_identifier"), F.lit(1).alias("seen"))


@query(f"""
    WITH {_SPELLED} SELECT CASE WHEN n.s_suppkey % 2 = 0 THEN 'FILES' ELSE 'REPORTS' END AS source_system, n.spelling AS source_identifier, CASE WHEN n.v < 3 THEN n.uid ELSE o.uid END AS wellbore_uid,
           CASE WHEN n.v = 0 THEN 'EXACT' WHEN n.v < 3 THEN 'NORMALIZED' WHEN o.uid IS NOT NULL THEN 'IDENTIFIER' END AS method, CAST(CASE WHEN n.v = 0 THEN 1.0 WHEN n.v < 3 THEN 0.95 WHEN o.uid IS NOT NULL THEN 1.0 END AS DOUBLE) AS confidence
    FROM named n LEFT JOIN named o ON n.s_suppkey % 8 = 3 AND o.s_suppkey = n.s_suppkey - 3""")
def resolve_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.resolve_identities(_observed(spark, sf_dir)).select("source_system", "source_identifier", "wellbore_uid", "method", "confidence")


@query("""
    WITH i AS (SELECT event_type AS source_system, user_id, count(*) AS occurrences, CASE WHEN user_id % 5 <> 0 THEN 'W' || CAST(user_id % 40 AS VARCHAR) END AS uid FROM events GROUP BY 1, 2),
    c AS (SELECT source_system, count(*) AS identities, count(uid) AS resolved, count(DISTINCT uid) AS wellbore_count, sum(occurrences) AS row_count FROM i GROUP BY 1
          UNION ALL SELECT 'TOTAL', count(*), count(uid), count(DISTINCT uid), sum(occurrences) FROM i)
    SELECT source_system, identities, resolved, wellbore_count, CAST(row_count AS BIGINT) AS row_count, round(100.0 * resolved / identities, 6) AS resolved_pct FROM c""")
def identity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).groupBy(F.col("event_type").alias("source_system"), "user_id").agg(F.count("*").alias("occurrences"))
    named = rows.withColumn("wellbore_uid", F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("W"), (F.col("user_id") % 40).cast("string"))))
    return rounded(mart.mart_identity_coverage(named))


@query("""
    WITH x AS (SELECT event_id, event_type AS sys, CAST(user_id AS VARCHAR) AS id, user_id FROM events)
    SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 AND sys = 'click' THEN 'EXACT-' || id WHEN user_id % 3 = 1 AND sys = 'view' THEN 'OTHER-' || id WHEN user_id % 3 = 2 THEN 'ALONE-' || id END AS wellbore_uid FROM x""")
def lookup_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = events(spark, sf_dir).select("user_id").distinct()
    row = lambda system, name, rest: users.where(f"user_id % 3 = {rest}").select(F.lit(system).alias("source_system"), F.col("user_id").cast("string").alias("source_identifier"), F.concat(F.lit(name), F.col("user_id").cast("string")).alias("wellbore_uid"))
    crosswalk = row("click", "EXACT-", 1).unionByName(row("view", "OTHER-", 1)).unionByName(row("somewhere", "ALONE-", 2))
    rows = events(spark, sf_dir).select("event_id", F.col("event_type").alias("_source_system"), F.col("user_id").cast("string").alias("_source_identifier"))
    return joins.lookup(rows, crosswalk).select("event_id", "wellbore_uid")


# ---------------------------------------------------------------- runs, gaps, profile

_DAYS = "days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) + CAST(event_id % 97 AS INTEGER) AS day FROM events)"


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, spread over some months so that there are gaps."""
    return events(spark, sf_dir).select("user_id", F.date_add(F.to_date("ts"), (F.col("event_id") % 97).cast("int")).alias("day"))


@query("""
    SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS island FROM events""")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.islands(events(spark, sf_dir), "user_id", "ts", "event_type").select("event_id", "island")


@query(f"""WITH {_DAYS}, m AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS anchor FROM days)
           SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM m GROUP BY user_id, anchor""")
def day_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.day_runs(_days(spark, sf_dir), "user_id", "day")


@query(f"""WITH {_DAYS}, m AS (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap_after FROM days)
           SELECT user_id, gap_after, CAST(day - gap_after - 1 AS INTEGER) AS missing_days FROM m WHERE day - gap_after > 1""")
def day_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.day_gaps(_days(spark, sf_dir), "user_id", "day")


@query("""
    WITH e AS (SELECT user_id, ts, event_id % 2 AS v FROM events),
    m AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) - row_number() OVER (PARTITION BY user_id, v ORDER BY ts) AS island FROM e)
    SELECT user_id, v, min(ts) AS first_at, max(ts) AS last_at, count(*) AS length FROM m GROUP BY user_id, v, island HAVING count(*) >= 3 AND v <> 0""")
def frozen_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.frozen_runs(events(spark, sf_dir).select("user_id", "ts", (F.col("event_id") % 2).alias("v")), "user_id", "ts", "v")


@query("""
    SELECT event_id FROM (SELECT event_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts)) AS step, stddev_samp(value) OVER (PARTITION BY user_id) AS spread FROM events) WHERE step > 2 * spread""")
def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.spikes(events(spark, sf_dir), "user_id", "ts", "value", 2.0).select("event_id")


@query(f"""WITH {DAILY} SELECT CASE WHEN on_stream_hrs = 0 THEN 'shut_in' WHEN on_stream_hrs >= 23.5 THEN 'full' ELSE 'partial' END AS bucket, count(*) AS days FROM silver GROUP BY 1""")
def uptime_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.uptime_buckets(daily(spark, sf_dir))


@query(f"""WITH {DAILY} SELECT wellbore_uid, count(*) AS days, round(avg(oil_sm3), 2) AS mean_oil, round(stddev_samp(oil_sm3), 2) AS sd_oil, max(oil_sm3) AS max_oil FROM silver WHERE oil_sm3 > 0 GROUP BY 1""")
def rate_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.rate_statistics(daily(spark, sf_dir)), 2)


@query(f"""WITH {DAILY}, y AS (SELECT wellbore_uid, CAST(year(prod_date) AS INTEGER) AS year, avg(oil_sm3) AS mean_oil FROM silver WHERE oil_sm3 > 0 GROUP BY 1, 2)
           SELECT wellbore_uid, year, round(mean_oil, 3) AS mean_oil, round(mean_oil / max(mean_oil) OVER (PARTITION BY wellbore_uid), 6) AS share_of_best FROM y""")
def decline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.decline(daily(spark, sf_dir)).select("wellbore_uid", "year", F.round("mean_oil", 3).alias("mean_oil"), F.round("share_of_best", 6).alias("share_of_best"))


@query(f"""WITH {DAILY}, y AS (SELECT wellbore_uid, year(prod_date) AS year, sum(water_sm3) / nullif(sum(oil_sm3 + water_sm3), 0) AS cut FROM silver GROUP BY 1, 2)
           SELECT wellbore_uid, round(1e6 * (arg_max(cut, year) - arg_min(cut, year)) / (count(*) - 1), 3) + 0.0 AS rise_ppm_per_year FROM y WHERE cut IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def water_cut_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rise = profile.water_cut_rise(daily(spark, sf_dir))
    return rise.select("wellbore_uid", (F.round(1e6 * F.col("rise_per_year"), 3) + 0.0).alias("rise_ppm_per_year"))


@query(f"""
    WITH {DAILY},
    s AS (SELECT *, prod_date - CAST(row_number() OVER (PARTITION BY wellbore_uid ORDER BY prod_date) AS INTEGER) AS anchor FROM silver WHERE on_stream_hrs = 0),
    g AS (SELECT prod_date - lag(prod_date) OVER (PARTITION BY wellbore_uid ORDER BY prod_date) - 1 AS gap FROM silver),
    i AS (SELECT wellbore_uid, oil_sm3, row_number() OVER (PARTITION BY wellbore_uid ORDER BY prod_date) - row_number() OVER (PARTITION BY wellbore_uid, oil_sm3 ORDER BY prod_date) AS k FROM silver),
    x AS (SELECT abs(oil_sm3 - lag(oil_sm3) OVER (PARTITION BY wellbore_uid ORDER BY prod_date)) AS step, stddev_samp(oil_sm3) OVER (PARTITION BY wellbore_uid) AS sd FROM silver)
    SELECT 'shutdown_runs' AS kind, count(*) AS count FROM (SELECT DISTINCT wellbore_uid, anchor FROM s)
    UNION ALL SELECT 'missing_days', CAST(coalesce(sum(gap), 0) AS BIGINT) FROM g WHERE gap > 0
    UNION ALL SELECT 'frozen_runs', count(*) FROM (SELECT 1 FROM i WHERE oil_sm3 <> 0 GROUP BY wellbore_uid, oil_sm3, k HAVING count(*) >= 3)
    UNION ALL SELECT 'spikes', count(*) FROM x WHERE step > 5 * sd""")
def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.anomaly_counts(daily(spark, sf_dir))


# ---------------------------------------------------------------- other shapes

@query("""
    SELECT o_orderkey, 'custkey' AS measure, o_custkey AS amount FROM orders UNION ALL SELECT o_orderkey, 'length', CAST(length(o_orderpriority) AS BIGINT) FROM orders
    UNION ALL SELECT o_orderkey, 'year', CAST(year(o_orderdate) AS BIGINT) FROM orders""")
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"), F.length("o_orderpriority").cast("long").alias("length"), F.year("o_orderdate").cast("long").alias("year"))
    return wide.unpivot(["o_orderkey"], ["custkey", "length", "year"], "measure", "amount")


@query("""
    WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS begin_day FROM orders),
    e AS (SELECT o_custkey, o_orderkey AS other_key, CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS begin_day FROM orders)
    SELECT o.o_custkey, o.o_orderkey, e.other_key, CAST(least(o.begin_day + 90, e.begin_day + 60) - greatest(o.begin_day, e.begin_day) AS INTEGER) AS overlap
    FROM o JOIN e ON o.o_custkey = e.o_custkey AND least(o.begin_day + 90, e.begin_day + 60) > greatest(o.begin_day, e.begin_day)""")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("begin", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")))
    left = orders.select("o_custkey", "o_orderkey", "begin", (F.col("begin") + 90).alias("end"))
    right = orders.select("o_custkey", F.col("o_orderkey").alias("other_key"), F.col("begin").alias("other_begin"), (F.col("begin") + 60).alias("other_end"))
    return joins.overlap_join(left, right, ["o_custkey"], ("begin", "end"), ("other_begin", "other_end"), width=90).select("o_custkey", "o_orderkey", "other_key", "overlap")


@query("""
    WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey + 100 AS k FROM orders)
    SELECT coalesce(a.k, b.k) AS custkey, a.k IS NOT NULL AS in_expected, b.k IS NOT NULL AS in_actual FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return joins.set_difference(expected, table(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).alias("custkey")), ["custkey"])


@query(f"""
    WITH {_TYPES},
    b AS (SELECT *, lag(valid_to) OVER (PARTITION BY user_id ORDER BY version_number) AS before FROM (SELECT user_id, version_number, valid_from - CASE WHEN version_number % 10 = 0 THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END AS valid_from, valid_to FROM versions))
    SELECT user_id, version_number FROM b WHERE version_number > 1 AND valid_from < before""")
def check_versions_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("version_number") % 10 == 0, F.col("valid_from") - F.expr("interval 1 second")).otherwise(F.col("valid_from"))
    return checks.versions_overlap(_versions(spark, sf_dir).withColumn("valid_from", moved), "user_id").select("user_id", "version_number")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END FROM customer)""")
def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 10 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey"))
    return checks.relationships(table(spark, sf_dir, "orders"), "o_custkey", moved, "c_custkey").select("o_orderkey")


@query("""
    SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'missing_wellbore' WHEN 1 THEN 'bad_timestamp' WHEN 2 THEN 'not_numeric' WHEN 3 THEN 'bit_below_hole' WHEN 4 THEN 'not_numeric' END AS reason,
           CASE event_id % 8 WHEN 0 THEN 'wellbore_uid' WHEN 1 THEN 'ts' WHEN 2 THEN 'hole_depth_m' WHEN 3 THEN 'bit_depth_m' WHEN 4 THEN 'rpm' END AS field,
           CASE event_id % 8 WHEN 0 THEN '  ' WHEN 1 THEN 'true' WHEN 2 THEN 'deep' WHEN 3 THEN '101.5' WHEN 4 THEN 'fast' END AS raw_value FROM events""")
def validate_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 8
    raw = events(spark, sf_dir).select(
        "event_id", F.when(kind == 0, "  ").otherwise("15/9-F-1").alias("wellbore_uid"), F.when(kind == 1, "true").otherwise("1577836800000").alias("ts"), F.when(kind == 3, "101.5").otherwise("100").alias("bit_depth_m"),
        F.when(kind == 2, "deep").otherwise("100.5").alias("hole_depth_m"), *[F.when((kind == 4) & F.lit(c == "rpm"), "fast").when(kind == 5, None).otherwise("1.5").alias(c) for c in contract.CHANNELS],
    )
    return contract.validate_records(raw).select("event_id", "reason", "field", "raw_value")


# ---------------------------------------------------------------- logs, trajectories, results, records

def _bronze(df: DataFrame, business: list[str], system: str) -> DataFrame:
    return bronze.add_technical_columns(df, business, system, "batch-1", "2024-01-01T00:00:00+00:00").withColumn("_wellbore_uid", F.col("_source_identifier"))


def log_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(
        F.concat(F.lit("15/9-F-"), F.col("user_id").cast("string")).alias("well_name"), F.col("event_type").alias("mnemonic"), F.when(F.col("user_id") % 2 == 0, "API").otherwise("V/V").alias("unit"), F.lit("0").alias("start"), F.lit("9").alias("stop"), F.lit("d").alias("description"),
        F.when(F.col("user_id") % 3 == 0, "-999.25").otherwise("-9999").alias("null_value_declared"), F.concat(F.lit("logs/"), F.col("user_id").cast("string"), F.lit(".las")).alias("_source_file"),
        F.concat(F.lit("15/9-F-"), F.col("user_id").cast("string")).alias("_source_identifier"),
    ).distinct()
    return _bronze(rows, [c for c in rows.columns if not c.startswith("_")], "LAS")


def log_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 10
    raw = F.when(kind == 0, "-999.2500").when(kind == 3, "-9999").when(kind == 6, "nan").otherwise(F.col("event_id").cast("string"))
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("mnemonic"), F.lit("DEPT").alias("index_mnemonic"), F.col("event_id").cast("string").alias("index_value"), F.lit("M").alias("index_unit"), raw.alias("value"),
        F.when(F.col("event_id") % 4 == 0, "-9999").alias("null_value_declared"), F.concat(F.lit("logs/"), F.col("user_id").cast("string"), F.lit(".las")).alias("_source_file"),
        F.concat(F.lit("15/9-F-"), F.col("user_id").cast("string")).alias("_source_identifier"),
    )
    return _bronze(rows, [c for c in rows.columns if not c.startswith("_")], "LAS")


_SAMPLES = """
    raw AS (SELECT event_id, user_id, event_type AS mnemonic, CASE WHEN event_id % 10 IN (0, 3, 6) THEN NULL ELSE event_id END AS plain,
                   CASE event_id % 10 WHEN 0 THEN -999.25 WHEN 3 THEN -9999.0 END AS odd, CASE WHEN event_id % 4 = 0 THEN -9999.0 WHEN user_id % 3 = 0 THEN -999.25 ELSE -9999.0 END AS declared FROM events),
    samples AS (SELECT event_id, user_id, mnemonic, CAST(CASE WHEN plain IS NOT NULL THEN plain WHEN odd IS NULL OR odd = declared THEN NULL ELSE odd END AS DOUBLE) AS value FROM raw)"""


@query(f"WITH {_SAMPLES} SELECT CAST(event_id AS DOUBLE) AS index_value, mnemonic, value, value IS NULL AS was_sentinel FROM samples")
def silver_log_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.log_sample(log_samples(spark, sf_dir), log_headers(spark, sf_dir)).select("index_value", "mnemonic", "value", "was_sentinel")


@query(f"WITH {_SAMPLES} SELECT mnemonic, count(*) AS samples, count(*) FILTER (value IS NULL) AS sentinels, round(1.0 * count(*) FILTER (value IS NULL) / count(*), 9) AS share FROM samples GROUP BY 1")
def sentinel_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.sentinel_shares(silver.log_sample(log_samples(spark, sf_dir), log_headers(spark, sf_dir))), 9)


@query("""
    SELECT event_type AS mnemonic, min(CASE WHEN user_id % 2 = 0 THEN 'API' ELSE 'V/V' END) AS unit, count(DISTINCT user_id % 2) AS units, count(DISTINCT user_id) AS wellbores, count(DISTINCT user_id) AS files,
           count(DISTINCT user_id % 2) > 1 AS has_mixed_units, md5(event_type) AS curve_key FROM events GROUP BY 1""")
def dim_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_curve(silver.log_curve(log_headers(spark, sf_dir)))


@query(f"WITH {_SAMPLES} SELECT CAST(event_id AS DOUBLE) AS index_value, md5(mnemonic) AS curve_key, md5('UNRESOLVED|15/9-F-' || CAST(user_id AS VARCHAR)) AS wellbore_key FROM samples")
def fct_log_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = silver.log_sample(log_samples(spark, sf_dir), log_headers(spark, sf_dir))
    return gold.fct_log_sample(facts, wellbores(spark, sf_dir)).select("index_value", "curve_key", "wellbore_key")


@query("""
    SELECT 'LAS' AS source_system, '15/9-F-' || CAST(user_id AS VARCHAR) AS source_identifier, '15/9-F-' || CAST(user_id AS VARCHAR) AS wellbore_uid, count(*) AS occurrences, true AS is_resolved FROM events GROUP BY user_id
    UNION ALL SELECT 'PROD', 'W' || CAST(l_suppkey AS VARCHAR), 'W' || CAST(l_suppkey AS VARCHAR), count(DISTINCT CAST(l_shipdate AS DATE)), true FROM lineitem GROUP BY l_suppkey""")
def wellbore_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = silver.wellbore_identity([log_samples(spark, sf_dir), daily_bronze(spark, sf_dir)])
    return out.select("source_system", "source_identifier", "wellbore_uid", "occurrences", "is_resolved")


@query("""
    WITH i AS (SELECT DISTINCT 'W' || CAST(l_suppkey % 7 AS VARCHAR) AS well, l_suppkey FROM lineitem)
    SELECT well AS well_uid, count(*) AS wellbores, count(*) FILTER (l_suppkey % 2 = 0) AS sidetracks, CAST(1 AS BIGINT) AS source_systems, CAST(count(*) AS BIGINT) AS occurrences, md5(well) AS well_key FROM i GROUP BY 1""")
def dim_well(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(key).distinct().select(
        F.concat(F.lit("W"), (key % 7).cast("string")).alias("well_uid"), key.cast("string").alias("wellbore_uid"), F.when(key % 2 == 0, "A").alias("sidetrack"), F.lit("S").alias("source_system"), F.lit(1).cast("long").alias("occurrences")
    )
    return gold.dim_well(rows)


def stations_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataflow.sources.columns import TRAJECTORY_STATION

    even, md = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 50
    given = {
        "trajectory_uid": F.col("o_orderkey"), "station_seq": F.lit(1), "dtim_station": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), "md": md, "source_crs": F.when(md % 4 == 0, "ED50"),
        "incl": F.when(even, "3.141592653589793").otherwise("45"), "incl_uom": F.when(even, "rad").otherwise("dega"), "azi": F.lit("0"),
    }
    rows = table(spark, sf_dir, "orders").select(*[given.get(c, F.lit(None)).cast("string").alias(c) for c in TRAJECTORY_STATION], F.concat(F.lit("15/9-F-"), F.col("o_custkey").cast("string")).alias("_source_identifier"))
    return _bronze(rows, list(TRAJECTORY_STATION), "TRAJECTORY")


def results_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("oil_total"), F.sum("o_orderkey").alias("water_total"), F.max("o_orderkey").alias("gas_total"))
    rows = rows.select(F.col("d").cast("string").alias("report_date"), "oil_total", "water_total", "gas_total", F.concat(F.lit("15/9-F-"), F.col("o_custkey").cast("string")).alias("_source_identifier"))
    return _bronze(rows, ["report_date", "oil_total", "water_total", "gas_total"], "SIM")


@query("""
    WITH s AS (SELECT o_custkey, o_orderkey, o_orderkey % 50 AS md, CAST(o_orderdate AS DATE) AS d FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, md ORDER BY d DESC, CAST(o_orderkey AS VARCHAR)) AS k FROM s)
    SELECT '15/9-F-' || CAST(o_custkey AS VARCHAR) AS wellbore_uid, CAST(md AS DOUBLE) AS md, CAST(o_orderkey AS VARCHAR) AS trajectory_uid, d AS station_date, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 180.0 ELSE 45.0 END AS DOUBLE) AS inclination_deg FROM r WHERE k = 1""")
def fct_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = gold.fct_trajectory(silver.trajectory_station(stations_bronze(spark, sf_dir)), wellbores(spark, sf_dir))
    return facts.select("wellbore_uid", "md", "trajectory_uid", "station_date", "inclination_deg")


@query("""
    WITH w AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS a, sum(o_orderkey) AS b, max(o_orderkey) AS c FROM orders GROUP BY 1, 2)
    SELECT '15/9-F-' || CAST(o_custkey AS VARCHAR) AS wellbore_uid, d AS report_date, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, phase, CAST(volume AS DOUBLE) AS volume
    FROM (SELECT o_custkey, d, 'OIL' AS phase, a AS volume FROM w UNION ALL SELECT o_custkey, d, 'WATER', b FROM w UNION ALL SELECT o_custkey, d, 'GAS', c FROM w)""")
def fct_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = silver.simulation_result(results_bronze(spark, sf_dir))
    return gold.fct_simulation(results, wellbores(spark, sf_dir)).select("wellbore_uid", "report_date", "date_key", "phase", "volume")


@query(f"""
    WITH {_SAMPLES}, c AS (SELECT user_id, mnemonic, min(event_id) AS top, max(event_id) AS base, count(*) AS n, count(*) FILTER (value IS NULL) AS s FROM samples GROUP BY 1, 2)
    SELECT 'logs/' || CAST(user_id AS VARCHAR) || '.las' AS source_file, CAST(user_id AS VARCHAR) || '.las' AS name, 'partition:master-data--Wellbore:15%2F9-F-' || CAST(user_id AS VARCHAR) AS wellbore,
           CAST(min(top) AS DOUBLE) AS top, CAST(max(base) AS DOUBLE) AS base, CAST(sum(n) AS BIGINT) AS samples, CAST(sum(s) AS BIGINT) AS sentinels, min(mnemonic) AS first_curve FROM c GROUP BY user_id""")
def export_welllog(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataflow.plans import export

    records = export.welllog_records(silver.log_sample(log_samples(spark, sf_dir), log_headers(spark, sf_dir)))
    field = lambda path, kind="string": F.get_json_object("record", f"$.data.{path}").cast(kind)
    return records.select(
        "source_file", field("Name").alias("name"), field("WellboreID").alias("wellbore"), field("TopMeasuredDepth", "double").alias("top"), field("BottomMeasuredDepth", "double").alias("base"),
        field("ExtensionProperties.SampleCount", "long").alias("samples"), field("ExtensionProperties.SentinelReadingCount", "long").alias("sentinels"), field("Curves[0].Mnemonic").alias("first_curve"),
    )


@query(f"""
    WITH {DAILY}, {_ROLES}
    SELECT wellbore_uid, version_number, 'partition:master-data--Wellbore:' || wellbore_uid AS id, well_role AS state, CAST(valid_from AS VARCHAR) || 'T00:00:00Z' AS effective, CAST(valid_to AS VARCHAR) || 'T00:00:00Z' AS terminated FROM versions""")
def export_wellbore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataflow.plans import export

    records = export.wellbore_records(gold.dim_wellbore(daily(spark, sf_dir)), silver.wellbore_identity([daily_bronze(spark, sf_dir)]))
    state = lambda c: F.get_json_object("record", f"$.data.FacilityStates[0].{c}")
    return records.select("wellbore_uid", "version_number", F.get_json_object("record", "$.id").alias("id"), state("FacilityStateTypeID").alias("state"), state("EffectiveDateTime").alias("effective"), state("TerminationDateTime").alias("terminated"))


_COVERED = """
    i AS (SELECT event_type AS source_system, user_id, CASE WHEN user_id % 5 <> 0 THEN 'W' || CAST(user_id % 40 AS VARCHAR) END AS uid FROM events GROUP BY 1, 2),
    c AS (SELECT source_system, 100.0 * count(uid) / count(*) AS pct FROM i GROUP BY 1)"""


@query(f"""
    WITH {DAILY}, {REPORTED}, {_ROLES}, {_COVERED},
    stations AS (SELECT DISTINCT o_custkey, o_orderkey % 50 AS md FROM orders), results AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
    current AS (SELECT wellbore_uid, count(*) FILTER (valid_to IS NULL) AS n FROM versions GROUP BY 1),
    m(name, value, threshold, at_least) AS (
        SELECT 'daily freshness', date_diff('day', max(prod_date), DATE '2016-09-30'), 2, false FROM silver
        UNION ALL SELECT 'monthly freshness', date_diff('day', last_day(make_date(CAST(max(month_key) // 100 AS BIGINT), CAST(max(month_key) % 100 AS BIGINT), 1)), DATE '2016-09-30'), 62, false FROM reported
        UNION ALL SELECT 'daily rows', count(*), 14000, true FROM silver UNION ALL SELECT 'monthly rows', count(*), 480, true FROM reported
        UNION ALL SELECT 'log rows', count(*), 30000, true FROM events UNION ALL SELECT 'trajectory rows', count(*), 450, true FROM stations UNION ALL SELECT 'simulation rows', 3 * count(*), 180, true FROM results
        UNION ALL SELECT 'daily keys', 100.0 * count(s.wellbore_uid) / count(*), 100, true FROM silver s UNION ALL SELECT 'wellbores', count(DISTINCT wellbore_uid), 7, true FROM versions
        UNION ALL SELECT 'current versions', count(*) FILTER (n <> 1), 0, false FROM current UNION ALL SELECT 'days', date_diff('day', DATE '2008-06-01', DATE '2016-09-30') + 1, 3044, true
        UNION ALL SELECT 'log curve keys', 100.0 * count(event_type) / count(*), 99, true FROM events UNION ALL SELECT 'curves', count(DISTINCT event_type), 1, true FROM events
        UNION ALL SELECT 'trajectory reference systems', 100.0 * count(CASE WHEN md % 4 = 0 THEN 'ED50' END) / count(*), 100, true FROM stations
        UNION ALL SELECT 'identity coverage', 100.0 * count(uid) / count(*), 95, true FROM i UNION ALL SELECT 'weak systems', count(*) FILTER (pct < 50), 0, false FROM c)
    SELECT name, round(CAST(value AS DOUBLE), 6) AS value, CASE WHEN at_least THEN value >= threshold ELSE value <= threshold END AS met FROM m""")
def slo_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen objectives over models built from the dressed tables, met or not."""
    from strataflow.plans import slo

    facts, known = daily(spark, sf_dir), wellbores(spark, sf_dir)
    samples = silver.log_sample(log_samples(spark, sf_dir), log_headers(spark, sf_dir))
    rows = events(spark, sf_dir).groupBy(F.col("event_type").alias("source_system"), "user_id").agg(F.count("*").alias("occurrences"))
    named = rows.withColumn("wellbore_uid", F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("W"), (F.col("user_id") % 40).cast("string"))))
    models = {
        "fct_production_daily": gold.fct_production_daily(facts, known), "fct_production_monthly": gold.fct_production_monthly(monthly(spark, sf_dir), known), "dim_wellbore": known,
        "dim_date": gold.dim_date(spark), "fct_log_sample": gold.fct_log_sample(samples, known), "dim_curve": gold.dim_curve(silver.log_curve(log_headers(spark, sf_dir))),
        "fct_trajectory": gold.fct_trajectory(silver.trajectory_station(stations_bronze(spark, sf_dir)), known), "fct_simulation": gold.fct_simulation(silver.simulation_result(results_bronze(spark, sf_dir)), known),
        "mart_identity_coverage": mart.mart_identity_coverage(named),
    }
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    found = slo.evaluate(spark, slo.default_objectives("2016-09-30"))
    return rounded(spark.createDataFrame([(m.objective.name, m.value, m.met) for m in found], "name string, value double, met boolean"))


@query(f"""
    WITH {DAILY}, {REPORTED},
    met AS (SELECT s.wellbore_uid, s.oil_sm3 AS a, r.oil_sm3 AS b, s.gas_sm3 AS c, r.gas_sm3 AS d FROM sums s JOIN reported r USING (wellbore_uid, month_key)),
    seen AS (SELECT count(*) FILTER (well_type = 'WI') AS injected, max(CASE WHEN CAST(substr(wellbore_uid, 2) AS INTEGER) % 2 = 0 THEN on_stream_hrs * 200 ELSE on_stream_hrs * 2 END) AS choke, min(prod_date) AS first, max(prod_date) AS last,
                    count(*) FILTER (on_stream_hrs = 0 AND (oil_sm3 > 0 OR gas_sm3 > 0 OR water_sm3 > 0) OR on_stream_hrs > 0 AND oil_sm3 = 0 AND gas_sm3 = 0 AND water_sm3 = 0 AND injected_sm3 = 0 OR on_stream_hrs > 24) AS broken, count(*) AS n FROM silver),
    differ AS (SELECT count(*) FILTER (abs((a - b) / nullif(b, 0)) > 0.02 OR abs((c - d) / nullif(d, 0)) > 0.02) AS n FROM met)
    SELECT name, holds, planted FROM seen, differ, LATERAL (VALUES
      ('br02_flag_matches_the_variance', true, seen.n = 0), ('br02_reconciliation_covers_every_wellbore_month', true, seen.n = 0), ('br02_reconciliation_finds_real_disagreement', differ.n > 0, false),
      ('br03_injectors_never_report_produced_oil', true, injected = 0), ('br03_produced_water_never_includes_injected_water', true, injected = 0),
      ('br04_every_violating_day_is_quarantined', true, broken = 0), ('br04_quarantined_rows_remain_in_silver', true, broken = 0),
      ('br05_choke_is_normalised_to_percent', coalesce(choke <= 100, true), false), ('br05_volumes_stay_in_sm3_until_mart', true, false),
      ('gold_daily_fact_row_count_matches_silver', true, false), ('gold_every_fact_joins_to_a_wellbore_version', true, false), ('gold_scd2_has_exactly_one_current_version', true, false), ('gold_scd2_versions_do_not_overlap', true, false),
      ('silver_dates_decoded_within_field_life', first >= DATE '2008-06-01' AND last <= DATE '2016-09-30', false), ('silver_dedup_by_row_hash_left_no_duplicates', true, false), ('silver_scandinavian_characters_survived', true, false)) AS t(name, holds, planted)""")
def assertions_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assertion over the models of production, as they are and with a breach of each planted in them."""
    from strataflow.plans import assertions

    facts, months, known = daily(spark, sf_dir), monthly(spark, sf_dir), wellbores(spark, sf_dir)
    models = {
        "silver_production_daily": facts, "silver_production_monthly": months, "silver_production_quarantine": production.quarantine(facts), "dim_wellbore": known,
        "fct_production_daily": gold.fct_production_daily(facts, known), "mart_allocation_reconciliation": mart.mart_allocation_reconciliation(facts, months), "mart_well_performance": mart.mart_well_performance(facts),
    }
    models = {name: scratch.model(spark, sf_dir, name, lambda df=df: df) for name, df in models.items()}
    injector = F.col("well_type") == "WI"
    spoilt = {c: F.when(injector, 1.0).otherwise(F.col(c)) for c in ("oil_sm3", "water_sm3")}
    spoilt |= {"choke_pct": F.lit(250.0), "prod_date": F.lit("1970-01-01").cast("date"), "npd_facility_name": F.lit("M\ufffdRSK")}
    agreed = models["mart_allocation_reconciliation"].withColumn("out_of_tolerance", ~F.col("out_of_tolerance"))
    breaches = {
        "br02_flag_matches_the_variance": {"mart_allocation_reconciliation": agreed}, "br02_reconciliation_covers_every_wellbore_month": {"mart_allocation_reconciliation": agreed.where("false")},
        "br02_reconciliation_finds_real_disagreement": {"mart_allocation_reconciliation": agreed.where("false")}, "br04_every_violating_day_is_quarantined": {"silver_production_quarantine": models["silver_production_quarantine"].where("false")},
        "br04_quarantined_rows_remain_in_silver": {"silver_production_daily": facts.where("false")}, "br05_volumes_stay_in_sm3_until_mart": {"mart_well_performance": models["mart_well_performance"].withColumn("oil_boe", F.col("oil_boe") + 1)},
        "gold_daily_fact_row_count_matches_silver": {"fct_production_daily": models["fct_production_daily"].where("false")}, "gold_every_fact_joins_to_a_wellbore_version": {"dim_wellbore": known.where("false")},
        "gold_scd2_has_exactly_one_current_version": {"dim_wellbore": known.withColumn("is_current", F.lit(False))},
        "gold_scd2_versions_do_not_overlap": {"dim_wellbore": known.unionByName(known.withColumns({"version_number": F.col("version_number") + 1000000, "valid_from": F.lit("1900-01-01").cast("date")}))},
        "silver_dedup_by_row_hash_left_no_duplicates": {"silver_production_daily": facts.unionByName(facts)},
    }
    found = assertions.evaluate(models)
    planted = {name: assertions.evaluate({**models, **breaches.get(name, {"silver_production_daily": facts.withColumns(spoilt)})}, [name])[name] for name in found}
    return spark.createDataFrame([(name, holds, planted[name]) for name, holds in sorted(found.items())], "name string, holds boolean, planted boolean")


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS wellbore_uid, ts FROM events""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events sent twice through the routed stream in one batch: every one arrives once."""
    from strataflow.streaming import telemetry as stream

    folder = scratch.fresh_path(spark, "stream")
    rows = events(spark, sf_dir).select(F.col("user_id").cast("string").alias("wellbore_uid"), F.lit("1").alias("bit_depth_m"), F.lit("1").alias("hole_depth_m"), F.col("event_id").cast("string").alias("producer_seq"))
    # The contract's times are milliseconds; each event gets a millisecond of its own to be told apart.
    raw = rows.select("wellbore_uid", F.col("producer_seq").alias("ts"), "bit_depth_m", "hole_depth_m", "producer_seq")
    raw.unionByName(raw).write.json(f"{folder}/in")
    run = stream.start_routing(stream.file_source(spark, f"{folder}/in", 10_000), f"{folder}/out", f"{folder}/checkpoint")
    run.awaitTermination()
    arrived = stream.read_routed(spark, f"{folder}/out", "telemetry").select(F.col("producer_seq").cast("long").alias("event_id"), "wellbore_uid")
    return arrived.join(events(spark, sf_dir).select("event_id", "ts"), "event_id")


@query("""
    SELECT CAST(i AS INTEGER) AS day, CAST(DATE '2008-06-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS first_day, CAST(last_day(DATE '2008-06-01' + to_months(CAST(i AS INTEGER))) AS DATE) AS last_day FROM range(100) t(i)""")
def replay_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A real day passes a field month at speed one: its window on each of the hundred days."""
    import datetime as dt

    from strataflow.operators.replay import ReplayClock

    epoch = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    clock, day = ReplayClock(epoch), dt.timedelta(days=1)
    windows = [(k, *clock.replay_window(epoch + k * day, epoch + (k + 1) * day)) for k in range(clock.months)]
    return spark.createDataFrame(windows, "day int, first_day date, last_day date")
