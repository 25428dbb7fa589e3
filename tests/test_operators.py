import datetime as dt
import math
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.operators import checks, contract, dedup, history, identity, joins, production, replay, rig, runs, survey

D = dt.date


# ---------------------------------------------------------------- history

def versions_of(spark, rows):
    df = spark.createDataFrame(rows, "k string, v string, d date")
    return history.scd2(df, "k", ["v"], "d")


def test_scd2_collapses_and_reopens(spark):
    rows = [("a", "x", D(2020, 1, 1)), ("a", "x", D(2020, 1, 2)), ("a", "y", D(2020, 1, 3)), ("a", "x", D(2020, 1, 5)), (None, "z", D(2020, 1, 1))]
    out = versions_of(spark, rows).orderBy("version_number").collect()
    assert [(r.v, r.valid_from, r.valid_to, r.is_current) for r in out] == [
        ("x", D(2020, 1, 1), D(2020, 1, 3), False), ("y", D(2020, 1, 3), D(2020, 1, 5), False), ("x", D(2020, 1, 5), None, True),
    ]


def test_scd2_takes_null_for_empty(spark):
    assert versions_of(spark, [("a", None, D(2020, 1, 1)), ("a", "", D(2020, 1, 2))]).count() == 1


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", "", None]), st.integers(0, 120)), min_size=1, max_size=60))
def test_scd2_in_chunks_is_the_same(spark, rows):
    df = spark.createDataFrame([(k, v, D(2020, 1, 1) + dt.timedelta(days=d), n) for n, (k, v, d) in enumerate(rows)], "k string, v string, d date, n int")
    plain = history.scd2(df, "k", ["v"], "d", ("n",))
    chunked = history.scd2(df, "k", ["v"], "d", ("n",), chunk=F.trunc("d", "month"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, chunked.collect()))


def test_scd2_of_nothing(spark):
    assert versions_of(spark, []).count() == 0


def test_asof_is_half_open_and_keeps_the_rest(spark):
    versions = versions_of(spark, [("a", "x", D(2020, 1, 1)), ("a", "y", D(2020, 1, 3))])
    facts = spark.createDataFrame([("a", D(2019, 12, 31)), ("a", D(2020, 1, 2)), ("a", D(2020, 1, 3)), ("b", D(2020, 1, 3))], "k string, d date")
    for side in (versions, F.broadcast(versions)):
        out = {(r.k, r.d): r.v for r in history.asof_join(facts, side, "k", "d", {"v": "v"}).collect()}
        assert out == {("a", D(2019, 12, 31)): None, ("a", D(2020, 1, 2)): "x", ("a", D(2020, 1, 3)): "y", ("b", D(2020, 1, 3)): None}


def test_version_checks_find_what_is_wrong(spark):
    good = versions_of(spark, [("a", "x", D(2020, 1, 1)), ("a", "y", D(2020, 1, 3))])
    assert checks.run_checks({"overlap": checks.versions_overlap(good, "k"), "current": checks.one_current_version(good, "k")}) == {"overlap": 0, "current": 0}
    bad = good.withColumn("valid_to", F.lit(D(2021, 1, 1))).withColumn("is_current", F.lit(True))
    assert checks.versions_overlap(bad, "k").count() == 1 and checks.one_current_version(bad, "k").count() == 1


def test_dedup_ties_are_total(spark):
    rows = [("h", "t1", "b1", "f2"), ("h", "t1", "b1", "f1"), ("h", "t0", "b9", "f3"), ("g", None, "b1", "f1")]
    df = spark.createDataFrame(rows, "_row_hash string, _ingested_at string, _batch_id string, _source_file string")
    for n in (1, 3):
        assert sorted(r._source_file for r in dedup.dedup_by_row_hash(df.repartition(n)).collect()) == ["f1", "f3"]


# ---------------------------------------------------------------- rig states

T0 = dt.datetime(2020, 1, 1)


def sample(seconds, bit=1000.0, hole=1000.0, block=None, flow=None, rpm=None, wob=None):
    return ("w", T0 + dt.timedelta(seconds=seconds), float(bit), float(hole), block, flow, rpm, wob)


def telemetry(spark, rows):
    return spark.createDataFrame(rows, "wellbore_uid string, ts timestamp, bit_depth_m double, hole_depth_m double, block_position_m double, flow_in_lpm double, rpm double, wob_klbf double")


@pytest.mark.parametrize(
    ("rows", "state"),
    [
        ([sample(0, wob=12.0, flow=2200.0), sample(5, 1000.1, 1000.1, wob=12.0, flow=2200.0)], "DRILLING"),
        ([sample(0, 960.0, flow=2200.0), sample(5, 960.0, flow=2200.0)], "CIRCULATING"),
        ([sample(0, wob=0.5), sample(10, 999.0, wob=0.5)], "TRIPPING_OUT"),
        ([sample(0, 900.0, wob=0.5), sample(10, 901.0, wob=0.5)], "TRIPPING_IN"),
        ([sample(0, block=2.0, flow=0.0, rpm=0.0), sample(120, block=7.5, flow=0.0, rpm=0.0)], "CONNECTION"),
        ([sample(0, block=2.0), sample(120, block=2.0)], "STATIC"),
        ([sample(0, block=2.0), sample(1200, block=7.5)], "STATIC"),
        ([sample(0, block=2.0), sample(600, block=7.5)], "CONNECTION"),
    ],
)
def test_rig_state_of_the_last_sample(spark, rows, state):
    assert rig.rig_states(telemetry(spark, rows)).orderBy(F.desc("ts")).first()["state"] == state


@pytest.mark.parametrize(("seconds", "npt"), [(2940, True), (1800, False), (540, False)])
def test_npt_needs_over_half_an_hour(spark, seconds, npt):
    out = rig.state_spans(telemetry(spark, [sample(0), sample(seconds)])).collect()
    assert len(out) == 1 and out[0].is_npt is npt and out[0].duration_s == seconds


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50_000), st.floats(0, 50), st.floats(0, 3000), st.floats(0, 20)), min_size=1, max_size=30, unique_by=lambda x: x[0]))
def test_spans_cover_every_sample_once(spark, rows):
    df = telemetry(spark, [sample(t, 1000 + d, 1050, 5.0, f, 0.0, w) for t, d, f, w in rows])
    out = rig.state_spans(df).collect()
    assert sum(r.samples for r in out) == len(rows) and {r.state for r in out} <= set(rig.STATES)
    assert [r.state_seq for r in sorted(out, key=lambda r: r.started_at)] == list(range(1, len(out) + 1))


@pytest.mark.parametrize("minutes", [10, 37, 100_000])
def test_rig_states_in_stretches_are_the_same(spark, minutes):
    from strataflow.sources import fixtures

    df = fixtures.telemetry(spark, samples=900, step_s=7).where("pmod(hash(ts), 5) <> 0 and not minute(ts) between 20 and 45")
    plain, cut = rig.state_spans(df), rig.state_spans(df, chunk_minutes=minutes)
    assert sorted(map(str, plain.select(*sorted(plain.columns)).collect())) == sorted(map(str, cut.select(*sorted(cut.columns)).collect()))
    a, b = (x.select("ts", "rate", "travel", "state").orderBy("ts").collect() for x in (rig.rig_states(df), rig.rig_states(df, chunk_minutes=minutes)))
    assert a == b
    with pytest.raises(ValueError):
        rig.rig_states(df, chunk_minutes=5)


def test_efficiency_divides_by_nothing_safely(spark):
    row = rig.drilling_efficiency(rig.state_spans(telemetry(spark, [sample(0)]))).first()
    assert row.npt_pct is None and row.rop_m_per_h is None


# ---------------------------------------------------------------- surveys

def path(spark, rows):
    df = spark.createDataFrame([("s", float(m), float(i), float(a)) for m, i, a in rows], "survey string, md double, inclination_deg double, azimuth_deg double")
    return survey.minimum_curvature(df, "survey").orderBy("md").collect()


def test_straight_wells(spark):
    assert path(spark, [(0, 0, 0), (100, 0, 0)])[-1].tvd == pytest.approx(100)
    assert path(spark, [(0, 90, 0), (100, 90, 0)])[-1].north == pytest.approx(100)
    assert path(spark, [(0, 90, 90), (100, 90, 90)])[-1].east == pytest.approx(100)
    assert path(spark, [(0, 90, 180), (100, 90, 180)])[-1].north == pytest.approx(-100)
    assert path(spark, [(0, 30, 0), (100, 30, 0)])[-1].tvd == pytest.approx(100 * math.cos(math.radians(30)))


def test_quarter_circle(spark):
    last = path(spark, [(0, 0, 0), (100, 90, 0)])[-1]
    radius = 100 / (math.pi / 2)
    assert (last.tvd, last.north, last.dls_deg_30m) == pytest.approx((radius, radius, 27.0))


def test_survey_that_goes_back_up_is_an_error(spark):
    df = spark.createDataFrame([("s", 1, 100.0, 0.0, 0.0), ("s", 2, 50.0, 0.0, 0.0)], "survey string, n int, md double, inclination_deg double, azimuth_deg double")
    with pytest.raises(Exception, match="goes back up"):
        survey.minimum_curvature(df, "survey", order=("n",)).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(0, 120), st.integers(0, 359)), min_size=2, max_size=12))
def test_no_path_is_longer_than_its_depth(spark, legs):
    md, rows = 0, []
    for step, inclination, azimuth in legs:
        rows.append((md, inclination, azimuth))
        md += step
    out = path(spark, rows)
    for a, b in zip(out, out[1:]):
        chord = math.dist((a.tvd, a.north, a.east), (b.tvd, b.north, b.east))
        assert chord <= (b.md - a.md) * (1 + 1e-9)


def test_angles_by_unit(spark):
    df = spark.createDataFrame([(math.pi, "rad"), (180.0, "dega"), (None, None)], "a double, u string")
    assert [r[0] for r in df.select(survey.to_degrees("a", "u")).collect()] == [pytest.approx(180), 180.0, None]
    with pytest.raises(Exception, match="unknown angle unit"):
        df.limit(1).select(survey.to_degrees("a", F.lit("gon"))).collect()


def test_interpolation_between_stations(spark):
    stations = spark.createDataFrame([("s", 0.0, 0.0), ("s", 100.0, 80.0)], "survey string, md double, tvd double")
    points = spark.createDataFrame([("s", 0.0), ("s", 50.0), ("s", 100.0), ("s", 101.0), ("x", 1.0)], "survey string, p double")
    out = {(r.survey, r.p): r.tvd_at for r in survey.interpolate_at(points, stations, "survey", "p").collect()}
    assert out == {("s", 0.0): 0.0, ("s", 50.0): 40.0, ("s", 100.0): 80.0, ("s", 101.0): None, ("x", 1.0): None}


def test_overlap_lengths_sum_to_the_interval(spark):
    shots = spark.createDataFrame([("w", 3120.0, 3220.0)], "well string, top double, base double")
    picks = spark.createDataFrame([("w", "A", 3000.0, 3180.0), ("w", "B", 3180.0, 3300.0), ("w", "C", 3300.0, 3400.0)], "well string, formation string, f_top double, f_base double")
    out = {r.formation: r.overlap for r in joins.overlap_join(shots, picks, ["well"], ("top", "base"), ("f_top", "f_base")).collect()}
    assert out == {"A": 60.0, "B": 40.0}


# ---------------------------------------------------------------- identity

@pytest.mark.parametrize(
    ("name", "uid", "failure"),
    [
        ("15/9-F-12", "15/9-F-12", None), ("NO 15/9-F-4 AH", "15/9-F-4 AH", None), ("15/9-F15S", "15/9-F-15 S", None), ("15_9_19_ST2", "15/9-19 ST2", None), ("15_9-X-3 A", "15/9-X-3 A", None),
        ("Norway-Statoil-15_$47$_9-X-3 A", "15/9-X-3 A", None), ("Norway-StatoilHydro-NO 15/9-19 BT2", "15/9-19 BT2", None), ("15/9-f-1 c", "15/9-F-1 C", None), ("Relief well location 3", None, "no_block_and_quadrant"),
        ("", None, "empty"), (None, None, "empty"), ("15/9-", None, "no_well_number"), ("15/9-19 SR", "15/9-19 SR", None), ("15/9-19 XYZ", None, "unrecognised_suffix:XYZ"),
    ],
)
def test_names(spark, name, uid, failure):
    row = identity.with_normalized_name(spark.createDataFrame([(name,)], "n string"), "n").first()
    assert (row.wellbore_uid, row.failure) == (uid, failure)


def test_normalising_twice_changes_nothing(spark):
    quadrants, slots, tracks = ("15/9", "15_9", "15-9", "15 9"), ("F-12", "F12", "F_12", "19"), ("", " A", "_T2", "-ST2")
    names = [(f"{p}{q}-{s}{t}",) for p in ("", "NO ", "Norway-Equinor-") for q in quadrants for s in slots for t in tracks]
    once = identity.with_normalized_name(spark.createDataFrame(names, "n string"), "n").select("wellbore_uid").distinct()
    twice = identity.with_normalized_name(once.withColumnRenamed("wellbore_uid", "n"), "n")
    assert once.count() == 2 * 4 and twice.where("n <> wellbore_uid or wellbore_uid is null").count() == 0


def test_main_wellbore_and_operator(spark):
    row = identity.read_name(spark.createDataFrame([("Norway-Statoil-15/9-F-1 - Main Wellbore",)], "n string"), "n").first()
    assert (row.wellbore_uid, row.method, row.confidence, row.operator) == ("15/9-F-1", "MAIN_WELLBORE", 0.9, "Statoil")


def test_resolution_order(spark):
    rows = [
        ("A", "15/9-F-1", 3, ["W-1234"], True, 1), ("B", "15/9-F-2", 1, ["W-1234"], False, 1), ("C", "unknown", 1, ["W-1234"], False, 1), ("C", "nothing", 1, [], False, 1),
        ("SIM", "P-F-1", 1, [], False, 1), ("SIM", "P-F-77", 1, [], False, 1), ("M", "odd", 1, [], False, 1), ("A", "15/9-F-1", 2, [], False, 2),
    ]
    seen = spark.createDataFrame(rows, "source_system string, source_identifier string, occurrences long, identifiers array<string>, defines_identifier boolean, seen int")
    manual = spark.createDataFrame([("M", "odd", "15/9-F-9")], "source_system string, source_identifier string, wellbore_uid string")
    out = {(r.source_system, r.source_identifier): (r.wellbore_uid, r.method, r.occurrences) for r in identity.resolve_identities(seen, manual).collect()}
    assert out == {
        ("A", "15/9-F-1"): ("15/9-F-1", "EXACT", 5), ("B", "15/9-F-2"): ("15/9-F-1", "IDENTIFIER", 1), ("C", "unknown"): ("15/9-F-1", "IDENTIFIER", 1), ("C", "nothing"): (None, None, 1),
        ("SIM", "P-F-1"): ("15/9-F-1", "SIMULATOR", 1), ("SIM", "P-F-77"): (None, None, 1), ("M", "odd"): ("15/9-F-9", "MANUAL", 1),
    }


def test_conflicting_identifiers_are_recorded(spark):
    rows = [("A", "a", ["1"], True, 2, "u2"), ("B", "b", ["1"], True, 1, "u1")]
    df = spark.createDataFrame(rows, "source_system string, source_identifier string, identifiers array<string>, defines_identifier boolean, seen int, wellbore_uid string")
    row = identity.build_identifier_index(df).first()
    assert row.wellbore_uid == "u1" and row.conflicting


def test_regressions(spark):
    make = lambda rows: spark.createDataFrame(rows, "source_system string, source_identifier string, wellbore_uid string")
    before, now = make([("A", "x", "u"), ("A", "y", None)]), make([("A", "x", None), ("A", "y", "v")])
    assert [tuple(r) for r in identity.regressions(before, now).collect()] == [("A", "x")]


# ---------------------------------------------------------------- production, contract, runs

def test_reconciliation_keeps_both_sides(spark):
    schema = "wellbore_uid string, month_key int, oil_sm3 double, gas_sm3 double, water_sm3 double"
    summed = spark.createDataFrame([("w", 1, 100.0, 1.0, 1.0), ("w", 2, 5.0, 0.0, 0.0), ("w", 4, 102.1, 1.0, 1.0)], schema)
    reported = spark.createDataFrame([("w", 1, 102.0, 1.0, 1.0), ("w", 3, 5.0, 0.0, 0.0), ("w", 4, 100.0, 0.0, 1.0)], schema)
    out = {r.month_key: r for r in production.reconcile(summed, reported).collect()}
    assert [out[k].out_of_tolerance for k in (1, 2, 3, 4)] == [False, True, True, True]
    assert out[2].missing_from_monthly and out[3].missing_from_daily and out[4].gas_fraction is None


def test_a_row_may_break_several_rules(spark):
    df = spark.createDataFrame([("w", 0.0, 5.0, 0.0, 0.0, 0.0), ("w", 25.0, 0.0, 0.0, 0.0, 0.0), ("w", None, 0.0, 0.0, 0.0, 9.0)], "wellbore_uid string, on_stream_hrs double, oil_sm3 double, gas_sm3 double, water_sm3 double, injected_sm3 double")
    assert sorted(r.rule for r in production.quarantine(df).collect()) == ["uptime_out_of_range", "uptime_without_volume", "volume_without_uptime"]


def test_contract_order_and_types(spark):
    base = dict(wellbore_uid="w", ts="1577836800000", bit_depth_m="10", hole_depth_m="10.5", **{c: None for c in contract.CHANNELS})
    rows = [base, base | {"wellbore_uid": " ", "ts": "x"}, base | {"ts": "True"}, base | {"bit_depth_m": "12"}, base | {"rpm": "fast"}]
    raw = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} string" for k in base))
    good, dead = contract.split_valid(contract.validate_records(raw))
    assert good.count() == 1 and good.first().ts == dt.datetime(2020, 1, 1)
    assert sorted((r.reason, r.field) for r in dead.collect()) == [("bad_timestamp", "ts"), ("bit_below_hole", "bit_depth_m"), ("missing_wellbore", "wellbore_uid"), ("not_numeric", "rpm")]


def test_runs_and_gaps(spark):
    days = spark.createDataFrame([("w", D(2020, 1, d)) for d in (1, 2, 3, 6, 6)], "k string, d date")
    assert sorted(r.days for r in runs.day_runs(days, "k", "d").collect()) == [1, 3]
    assert [(r.gap_after, r.missing_days) for r in runs.day_gaps(days, "k", "d").collect()] == [(D(2020, 1, 3), 2)]


# ---------------------------------------------------------------- replay clock

EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def test_clock_maps_a_day_to_a_month():
    clock = replay.ReplayClock(EPOCH)
    assert clock.replay_date(EPOCH) == D(2008, 6, 1)
    assert clock.replay_window(EPOCH, EPOCH + dt.timedelta(days=1)) == (D(2008, 6, 1), D(2008, 6, 30))
    assert clock.months == 100 and clock.is_exhausted(EPOCH + dt.timedelta(days=100))
    with pytest.raises(replay.NotStarted):
        clock.replay_date(EPOCH - dt.timedelta(microseconds=1))
    with pytest.raises(replay.Exhausted):
        clock.replay_date(EPOCH + dt.timedelta(days=100))
    with pytest.raises(ValueError):
        replay.ReplayClock(dt.datetime(2024, 1, 1))
    assert replay.parse_epoch("2024-01-01") == EPOCH


@pytest.mark.parametrize("speed", [Fraction(1), Fraction(7, 3), Fraction(1, 30)])
def test_every_field_day_comes_back(speed):
    clock, day = replay.ReplayClock(EPOCH, speed), replay.FIELD_START
    while day <= replay.FIELD_END:
        at = clock.real_instant_for(day)
        assert clock.replay_date(at) == day
        if day > replay.FIELD_START:
            assert clock.replay_date(at - dt.timedelta(microseconds=1)) == day - dt.timedelta(days=1)
        day += dt.timedelta(days=1)
