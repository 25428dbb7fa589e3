import datetime as dt
import json

from strataflow.streaming import telemetry as t

T0 = 1_577_836_800_000


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def record(minute, well="w", **more):
    return {"wellbore_uid": well, "ts": str(T0 + minute * 60_000), "bit_depth_m": "10", "hole_depth_m": "10"} | more


def run(spark, tmp_path, per_batch=1):
    query = t.start_routing(t.file_source(spark, str(tmp_path / "in"), per_batch), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert query.exception() is None


def minutes(spark, tmp_path, kind):
    rows = t.read_routed(spark, str(tmp_path / "out"), kind).collect()
    return sorted(int((r.ts - dt.datetime(2020, 1, 1)).total_seconds() // 60) for r in rows)


def test_late_rows_dead_letters_and_duplicates(spark, tmp_path):
    put(tmp_path / "in", "1.json", [record(0), record(0), record(30), record(31, bit_depth_m="x"), record(1, well=" ")])
    run(spark, tmp_path)
    put(tmp_path / "in", "2.json", [record(5), record(25), record(30), record(40)])
    run(spark, tmp_path)  # goes on from the checkpoint
    assert minutes(spark, tmp_path, "telemetry") == [0, 25, 30, 40]
    assert minutes(spark, tmp_path, "late") == [5]
    dead = t.read_routed(spark, str(tmp_path / "out"), "dead_letter").collect()
    assert sorted(r.reason for r in dead) == ["missing_wellbore", "not_numeric"]


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    state = t._State(spark, f"{tmp_path}/state")
    raw = spark.createDataFrame([tuple(record(m).get(c) for c in t.RAW_COLUMNS) for m in (0, 5, 5)], t.RAW_SCHEMA)
    for _ in range(2):
        t.route_batch(raw, 0, f"{tmp_path}/out", state)
    later = spark.createDataFrame([tuple(record(m).get(c) for c in t.RAW_COLUMNS) for m in (-20, 5, 6)], t.RAW_SCHEMA)
    for _ in range(2):
        t.route_batch(later, 1, f"{tmp_path}/out", state)
    assert minutes(spark, tmp_path, "telemetry") == [0, 5, 6] and minutes(spark, tmp_path, "late") == [-20]


def test_stateful_dedup_equals_distinct(spark, tmp_path):
    put(tmp_path / "in", "1.json", [record(k) for k in (0, 1, 2, 1)])
    put(tmp_path / "in", "2.json", [record(k) for k in (2, 3, 3)])
    from strataflow.operators.contract import split_valid, validate_records

    good = split_valid(validate_records(t.file_source(spark, str(tmp_path / "in"), 1)))[0]
    query = t.dedup_stream(good).writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("deduped").count() == 4


def test_batches_without_new_rows(spark, tmp_path):
    state = t._State(spark, f"{tmp_path}/state")
    make = lambda rows: spark.createDataFrame([tuple(r.get(c) for c in t.RAW_COLUMNS) for r in rows], t.RAW_SCHEMA)
    t.route_batch(make([record(0, well=" ")]), 0, f"{tmp_path}/out", state)
    t.route_batch(make([record(50)]), 1, f"{tmp_path}/out", state)
    t.route_batch(make([record(1)]), 2, f"{tmp_path}/out", state)
    t.route_batch(make([]), 3, f"{tmp_path}/out", state)
    t.route_batch(make([record(51)]), 4, f"{tmp_path}/out", state)
    assert minutes(spark, tmp_path, "telemetry") == [50, 51] and minutes(spark, tmp_path, "late") == [1]
    assert t.read_routed(spark, str(tmp_path / "out"), "dead_letter").count() == 1


def test_resume_tells_events_apart_whatever_their_numbers(spark, tmp_path):
    from strataflow.plans import source_queries

    ids = [*range(1, 60), *range(10_001, 10_060), *range(500_001, 500_060), *range(1_000_001, 1_000_060), *range(12_345_001, 12_345_060)]
    spark.createDataFrame([(k, k % 7) for k in ids], "event_id long, user_id long").selectExpr("*", "timestamp_seconds(event_id) as ts").write.parquet(f"{tmp_path}/events.parquet")
    out = source_queries.stream_resume(spark, str(tmp_path)).collect()
    assert sorted((r.event_id, r.wellbore_uid) for r in out) == [(k, str(k % 7)) for k in ids if k % 5]
