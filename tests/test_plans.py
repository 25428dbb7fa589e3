import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow.plans import bronze, export, gold, queries, registry, silver, slo
from strataflow.sources import columns


def landing(spark, rows, names=("d", "v")):
    df = spark.createDataFrame(rows, "d string, v string").withColumn("_replay_date", F.col("d"))
    return bronze.add_technical_columns(df, list(names), "T", ingested_at="2024-01-01T00:00:00+00:00")


def test_technical_columns_follow_the_business_ones(spark):
    df = landing(spark, [("2020-01-01", "a")])
    assert df.columns == ["d", "v", *bronze.TECHNICAL] and {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_loads_can_be_repeated_and_empty_days_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = landing(spark, [("2020-01-01", "a"), ("2020-01-02", "b"), ("2020-01-03", "c")])
    assert bronze.load_range(rows, path, "2020-01-01", "2020-01-03") == 3
    once = bronze.table_state(bronze.bronze_scan(spark, path, ["d", "v"])).first()
    bronze.load_range(rows, path, "2020-01-01", "2020-01-03")
    assert bronze.table_state(bronze.bronze_scan(spark, path, ["d", "v"])).first() == once
    assert bronze.load_day(rows.where("v <> 'b'"), path, "2020-01-02") == 0
    assert sorted(r.v for r in bronze.bronze_scan(spark, path, ["d", "v"]).collect()) == ["a", "c"]


def test_compaction_keeps_rows(spark, tmp_path):
    spark.range(100).repartition(20).write.parquet(str(tmp_path / "a"))
    before, after = bronze.compact(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert before == 20 and after == 1 and spark.read.parquet(str(tmp_path / "b")).count() == 100


def table(spark, names, *rows, system="S"):
    df = spark.createDataFrame([tuple(r.get(c) for c in (*names, "_source_identifier", "_source_file")) for r in rows], ", ".join(f"`{c}` string" for c in (*names, "_source_identifier", "_source_file")))
    return bronze.add_technical_columns(df, list(names), system, "b", "2024-01-01T00:00:00+00:00").withColumn("_wellbore_uid", F.col("_source_identifier"))


@pytest.fixture(scope="module")
def built(spark):
    w, f = {"_source_identifier": "15/9-F-1 A"}, {"_source_file": "dir/x.las"}
    day = {"dateprd": "41000", "on_stream_hrs": "24", "bore_oil_vol": "10", "bore_gas_vol": "5", "bore_wat_vol": "2", "well_type": "OP", "avg_choke_size_p": "0.5", "avg_choke_uom": "FRAC", "npd_facility_code": "1", "npd_facility_name": "MÆRSK"}
    sources = {
        "prod_daily": table(spark, columns.PROD_DAILY, w | day, w | day, w | day | {"dateprd": "41001", "well_type": "WI", "bore_wi_vol": "7"}, w | {"dateprd": "x"}),
        "prod_monthly": table(spark, columns.PROD_MONTHLY, w | {"year": "2012", "month": "4", "oil": "10", "gas": "5", "water": "2", "gi": "NULL"}),
        "ddr_activity": table(spark, columns.DDR_ACTIVITY, w | {"report_date": "2012-04-01", "activity_seq": "1"}),
        "trajectory_station": table(spark, columns.TRAJECTORY_STATION, w | {"trajectory_uid": "t", "station_seq": "1", "md": "0", "incl": "0", "azi": "0"}, w | {"trajectory_uid": "t", "station_seq": "2", "md": "100", "incl": "3.141592653589793", "incl_uom": "rad", "azi": "0", "dtim_station": "2012-04-01"}),
        "las_curve_header": table(spark, columns.LAS_CURVE_HEADER, w | f | {"mnemonic": "GR", "unit": "API", "null_value_declared": "-999.25"}),
        "las_sample": table(spark, columns.LAS_SAMPLE, w | f | {"mnemonic": "GR", "index_value": "1", "index_unit": "M", "value": "-999.2500"}, w | f | {"mnemonic": "GR", "index_value": "2", "index_unit": "M", "value": "55"}),
        "vsp_checkshot": table(spark, columns.VSP_CHECKSHOT, w | {"md_m": "10", "tvd_m": "9"}, w | {"md_m": "11"}),
        "sim_summary": table(spark, columns.SIM_SUMMARY, w | {"report_date": "2012-04-01", "oil_total": "1", "water_total": "2", "gas_total": "3"}),
        "drilling_telemetry": spark.createDataFrame([("15/9-F-1 A", dt.datetime(2020, 1, 1), 1.0, 1.0, None, None, None, None)], "wellbore_uid string, ts timestamp, bit_depth_m double, hole_depth_m double, block_position_m double, flow_in_lpm double, rpm double, wob_klbf double"),
    }
    return registry.default_registry().build(sources), sources


def test_the_registry_builds_every_model(built):
    counts = {name: df.count() for name, df in built[0].items()}
    assert len(counts) == 25
    assert counts["silver_production_daily"] == 2 and counts["dim_wellbore"] == 2 and counts["silver_vsp_checkshot"] == 1 and counts["silver_simulation_result"] == 3
    assert all(counts.values()) or counts["silver_production_quarantine"] == 0


def test_injectors_produce_nothing(built):
    rows = {r.prod_date.day: r for r in built[0]["silver_production_daily"].collect()}
    assert (rows[1].oil_sm3, rows[1].choke_pct, rows[1].injected_sm3) == (10.0, 50.0, 0.0)
    assert (rows[2].oil_sm3, rows[2].injected_sm3, rows[2].reported_bore_oil_vol) == (0.0, 7.0, 10.0)


def test_sentinels_become_null_and_are_counted(built):
    rows = {r.index_value: (r.value, r.was_sentinel) for r in built[0]["silver_log_sample"].collect()}
    assert rows == {1.0: (None, True), 2.0: (55.0, False)}


def test_angles_become_degrees(built):
    assert [r.inclination_deg for r in built[0]["fct_trajectory"].orderBy("md").collect()] == [0.0, pytest.approx(180.0)]


def test_identities_split_well_and_sidetrack(built):
    rows = built[0]["silver_wellbore_identity"].collect()
    assert {(r.well_uid, r.sidetrack) for r in rows} == {("15/9-F-1", "A")}
    assert built[0]["mart_identity_coverage"].where("source_system = 'TOTAL'").first().resolved_pct == 100.0


def test_models_can_be_written_in_order(spark, built, tmp_path):
    r = registry.default_registry()
    r.write(built[1], str(tmp_path), ["mart_allocation_reconciliation", "fct_production_daily"])
    assert spark.read.parquet(str(tmp_path / "fct_production_daily")).where("wellbore_key is null").count() == 0
    assert r.order(["mart_drilling_efficiency"]) == ["fct_drilling_state", "mart_drilling_efficiency"]


def test_assertions_hold_and_find_what_is_broken(spark, built):
    from strataflow.plans import assertions

    models = dict(built[0])
    assert len(assertions.ASSERTIONS) + len(assertions.MUST_FIND) == 25
    held = assertions.evaluate(models)
    assert len(held) == 25 and [n for n, ok in held.items() if not ok] == ["br02_reconciliation_finds_real_disagreement"]
    models["silver_production_daily"] = models["silver_production_daily"].withColumns({"choke_pct": F.lit(500.0), "npd_facility_name": F.lit("M\ufffdRSK"), "prod_date": F.lit("1990-01-01").cast("date")})
    broken = {n for n, ok in assertions.evaluate(models).items() if not ok}
    assert {"br05_choke_is_normalised_to_percent", "silver_scandinavian_characters_survived", "silver_dates_decoded_within_field_life", "br02_reconciliation_covers_every_wellbore_month"} <= broken


def test_objectives(spark, built):
    for name, df in built[0].items():
        df.createOrReplaceTempView(name)
    out = {m.objective.name: m for m in slo.evaluate(spark, slo.default_objectives("2012-04-03"))}
    assert len(out) == 16
    assert out["daily freshness"].met and out["days"].met and not out["daily rows"].met and out["daily rows"].blocking
    assert not out["trajectory reference systems"].met and not out["trajectory reference systems"].blocking
    broken = slo.Objective("x", "t", "d", "select count(*) from no_such_table", 1, True)
    assert not slo.evaluate(spark, [broken])[0].met and slo.evaluate(spark, [broken])[0].blocking


def test_exported_records(spark, built):
    import json

    models = built[0]
    wells = export.wellbore_records(models["dim_wellbore"], models["silver_wellbore_identity"]).orderBy("version_number").collect()
    record = json.loads(wells[0].record)
    assert record["id"] == "partition:master-data--Wellbore:15%2F9-F-1%20A"
    assert record["data"]["FacilityStates"][0]["EffectiveDateTime"] == "2012-04-01T00:00:00Z" and "FacilityOperators" not in record["data"]
    assert "TerminationDateTime" not in json.loads(wells[1].record)["data"]["FacilityStates"][0]
    log = json.loads(export.welllog_records(models["silver_log_sample"]).first().record)
    assert log["data"]["Name"] == "x.las" and log["data"]["Curves"][0]["DepthUnit"] == "m" and log["data"]["Curves"][0]["SentinelReadingCount"] == 1
    survey = json.loads(export.trajectory_records(models["silver_trajectory_station"]).first().record)
    assert survey["data"]["ExtensionProperties"]["StationCount"] == 2 and {"Name": "TVD"} not in survey["data"]["AvailableTrajectoryStationProperties"]
    good = spark.createDataFrame([(wells[0].record,), ("{}",)], "record string")
    assert [len(r.reasons) for r in export.invalid_records(good).collect()] == [6]


def test_dim_wellbore_takes_the_usual_operator(spark, sf):
    daily = queries.daily(spark, sf).limit(50)
    names = daily.select("wellbore_uid").distinct().withColumn("operator", F.explode(F.array(F.lit("Statoil"), F.lit("XXXXX"), F.lit("Statoil"), F.lit("Equinor"))))
    assert {r.operator_label for r in gold.dim_wellbore(daily, names).collect()} == {"Statoil"}
    assert silver.wellbore_identity([queries.daily_bronze(spark, sf)]).where("not is_resolved").count() == 0
