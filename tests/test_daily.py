import datetime as dt

from pyspark.sql import functions as F
from test_sources import LAS2, write_xlsx

from strataflow.operators import identity, joins, production, rig
from strataflow.operators.replay import ReplayClock
from strataflow.plans import bronze, daily, registry, silver
from strataflow.sources import catalogue, columns, fixtures, observers
from strataflow.streaming import telemetry


def workbook(folder):
    folder.mkdir()
    day = dict.fromkeys(columns.PROD_DAILY) | {"well_bore_code": "NO 15/9-F-4 AH", "npd_well_bore_code": "5693", "on_stream_hrs": "24", "bore_oil_vol": "10", "well_type": "OP", "avg_choke_uom": "%", "avg_choke_size_p": "40"}
    rows = [list(columns.PROD_DAILY)] + [[serial, *list(day.values())[1:]] for serial in range(39600, 39640)]
    write_xlsx(folder / "p.xlsx", [rows, [["Wellbore name", "Year", "Month", "Oil"], [None, None, None, "Sm3"], ["15/9-F-4 AH", "2008", "6", "280"]]])


def test_a_real_day_from_files_to_verdict(spark, tmp_path):
    workbook(tmp_path / "prod")
    epoch = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    clock = ReplayClock(epoch)
    crosswalk = spark.createDataFrame([("PROD", "NO 15/9-F-4 AH", "15/9-F-4 AH"), ("PROD_MONTHLY", "15/9-F-4 AH", "15/9-F-4 AH")], "source_system string, source_identifier string, wellbore_uid string")
    run = lambda: daily.run_day(
        spark, clock, epoch, epoch + dt.timedelta(days=1), {"prod_daily": str(tmp_path / "prod"), "prod_monthly": str(tmp_path / "prod")}, str(tmp_path / "out"),
        ["fct_production_daily", "mart_allocation_reconciliation"], crosswalk=crosswalk,
    )
    first = run()
    assert (first.first, first.last) == ("2008-06-01", "2008-06-30")
    assert first.loaded == {"prod_daily": 30, "prod_monthly": 1}  # serials 39600 on are 2008-06-01 on
    assert first.assertions["gold_scd2_has_exactly_one_current_version"] and first.assertions["silver_dedup_by_row_hash_left_no_duplicates"]
    assert first.blocked  # one field month has fewer rows than the objective asks for
    state = bronze.table_state(daily.landing_tables(spark, f"{tmp_path}/out/bronze", ["prod_daily"])["prod_daily"]).first()
    again = run()
    assert again.loaded == first.loaded and bronze.table_state(daily.landing_tables(spark, f"{tmp_path}/out/bronze", ["prod_daily"])["prod_daily"]).first() == state
    assert spark.read.parquet(f"{tmp_path}/out/models/fct_production_daily").select("wellbore_uid").distinct().first()[0] == "15/9-F-4 AH"


def test_the_contract_of_sources(spark, tmp_path):
    (tmp_path / "a.las").write_text(LAS2)
    assert len(catalogue.SOURCES) == 13
    las = catalogue.SOURCES["las_sample"]
    rows = las.read(spark, str(tmp_path), catalogue.STATIC_DAY)
    assert rows.columns == las.schema().names and rows.count() == 2
    assert las.read(spark, str(tmp_path), "2010-01-01").count() == 0
    loaded = catalogue.ingest(spark, {"las_sample": str(tmp_path), "las_curve_header": str(tmp_path)}, str(tmp_path / "out"), catalogue.STATIC_DAY, catalogue.STATIC_DAY)
    assert loaded == {"las_sample": 2, "las_curve_header": 2}


def test_observed_names_resolve(spark, tmp_path):
    (tmp_path / "M.DATA").write_text("WELSPECS\n'P-F-12' G1 1 2 /\n P-F-99 G1 1 2 / -- c\n/\nOTHER\nX /\n")
    landing = spark.createDataFrame([("15/9-F-12", "5599"), ("15/9-F-12", "5599"), ("NO 15/9-F-1 C", None)], "_source_identifier string, npd_well_bore_code string")
    paths = spark.createDataFrame([("x/checkshot_15_9_F_12.txt",), ("x/other.txt",)], "path string")
    seen = observers.observe_all({"prod_daily": landing}, [observers.observe_welspecs(spark, str(tmp_path)), observers.observe_names(paths, "FILES", r"checkshot_(.+)\.")])
    out = {(r.source_system, r.source_identifier): (r.wellbore_uid, r.method) for r in identity.resolve_identities(seen).collect()}
    assert out == {
        ("PROD", "15/9-F-12"): ("15/9-F-12", "EXACT"), ("PROD", "NO 15/9-F-1 C"): ("15/9-F-1 C", "NORMALIZED"), ("FILES", "15_9_F_12"): ("15/9-F-12", "NORMALIZED"),
        ("ECLIPSE", "P-F-12"): ("15/9-F-12", "SIMULATOR"), ("ECLIPSE", "P-F-99"): (None, None),
    }


def test_fixtures_hold_the_planted_cases(spark):
    rows, months = fixtures.production(spark)
    assert rows.collect() == fixtures.production(spark)[0].collect() and rows.count() == 4 * 120
    landing = lambda df, names, who: bronze.add_technical_columns(df.withColumn("_source_identifier", F.col(who)), names, "T").withColumn("_wellbore_uid", F.regexp_replace(who, "^NO ", ""))
    typed = silver.production_daily(landing(rows, rows.columns, "well_bore_code"))
    assert typed.where("well_type = 'WI' and oil_sm3 > 0").count() == 0 and typed.where("reported_bore_oil_vol = 37.5").count() == 1
    assert production.quarantine(typed).where("rule = 'volume_without_uptime'").count() == 1
    reported = silver.production_monthly(landing(months.withColumns({c: F.lit(None).cast("string") for c in ("npdcode", "on_stream", "gas", "water")}), [*months.columns, "npdcode", "on_stream", "gas", "water"], "wellbore_name"))
    off = production.reconcile(production.monthly_sums(typed), reported).where("abs(oil_fraction) > 0.02").count()
    assert off > 0
    states = rig.rig_states(fixtures.telemetry(spark))
    assert states.where("state = meant").count() > 0.6 * states.count()
    names = identity.with_normalized_name(fixtures.trajectories(spark).select("_source_identifier").distinct(), "_source_identifier")
    assert [r[0] for r in names.select("wellbore_uid").distinct().collect()] == ["15/9-X-3 A"]
    picks, shots = fixtures.picks_and_perforations(spark)
    assert sorted(r.overlap for r in joins.overlap_join(shots, picks, ["wellbore_uid"], ("perf_top_m", "perf_base_m"), ("top_m", "base_m")).collect()) == [40.0, 60.0]


def test_append_stream_goes_on_after_a_stop(spark, tmp_path):
    source = tmp_path / "in"
    schema = "wellbore_uid string, ts timestamp"
    for k in range(2):
        spark.createDataFrame([("w", dt.datetime(2020, 1, 1 + k))], schema).write.mode("append").json(str(source))
        stream = spark.readStream.schema(schema).json(str(source))
        telemetry.append_stream(telemetry.dedup_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_registry_refuses_what_it_cannot_build():
    try:
        registry.default_registry().build({}, ["dim_wellbore"])
    except KeyError as error:
        assert "prod_daily" in str(error)
    else:
        raise AssertionError
