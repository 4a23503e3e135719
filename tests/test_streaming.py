import datetime as dt
import json
import time

from pyspark.sql import functions as F

from punctual.operators import asof
from punctual.session import scratch_path
from punctual.sources import schemas
from punctual.streaming import enrichment, envelopes, rolling, scoring, sinks

EVENT = "id INT, at TIMESTAMP_NTZ, k STRING, v DOUBLE, tags ARRAY<STRING>"
START = dt.datetime(2024, 5, 1)


def events(spark, minutes, key="a"):
    data = [(i, START + dt.timedelta(minutes=m, microseconds=i), key, float(i), ["x"]) for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, EVENT)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_round_trip_through_envelopes(spark, tmp_path, rows):
    table = events(spark, range(0, 60, 2)).unionAll(
        spark.createDataFrame([(100, START, None, float("nan"), []), (101, None, "z", 1.0, None)], EVENT)
    )
    path = str(tmp_path / "lines")
    envelopes.publish(table, "at", path, page_size=2)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sum(line["num_records"] for line in lines) == 31
    assert all(line["num_records"] == len(line["records"]) for line in lines)
    assert {line["window_start"] for line in lines} == {f"2024-05-01 00:{m:02d}:00" for m in range(0, 60, 5)}
    back = envelopes.read_envelopes(spark.read.text(path), table.schema)
    expected = table.filter("at IS NOT NULL").withColumn("v", F.nanvl("v", F.lit(None)))
    assert rows(back) == rows(expected)
    assert envelopes.without_time(table, "at").first()[0] == 1
    stream = envelopes.read_envelopes(spark.readStream.text(path), table.schema)
    finish(sinks.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(expected)


def test_bad_lines_yield_no_rows(spark):
    lines = spark.createDataFrame([("not json",), ("{}",), ('{"window_start": "x", "records": []}',)], "value STRING")
    assert envelopes.read_envelopes(lines).count() == 0
    assert len(envelopes.read_envelopes(lines).columns) == len(schemas.STREAM_RECORD) == 72


def test_stream_windows_equal_batch_windows(spark, tmp_path, rows):
    table = events(spark, [0, 3, 14, 15, 16, 44, 59, 60, 200])
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    metrics = {"n": F.count(F.lit(1)), "total": F.sum("v")}
    for width, slide in (("15 minutes", None), ("1 hour", "15 minutes")):
        batch = rolling.windowed_metrics(table, "at", ["k"], metrics, width, slide)
        out = scratch_path(spark, "test-rolling")
        source = sinks.file_stream(spark, str(tmp_path / "in"), table.schema, files_per_batch=1)
        stream = rolling.windowed_metrics(
            rolling.event_time(source, "at", "1 day"), "at", ["k"], metrics, width, slide
        )
        finish(sinks.per_batch_folders(stream, out, scratch_path(spark, "test-state")))
        state = sinks.latest_state(spark.read.parquet(out), ["k", "window_start"])
        assert rows(state) == rows(batch)


def test_rolled_up_windows_equal_direct_windows(spark, rows):
    table = events(spark, [0, 3, 14, 15, 16, 44, 59, 60, 200, 1500])
    metrics = {"n": F.count(F.lit(1)), "total": F.sum("v")}
    fine = rolling.windowed_metrics(table, "at", ["k"], metrics, "15 minutes")
    for width, slide in (("1 hour", None), ("1 day", None), ("1 hour", "15 minutes")):
        direct = rolling.windowed_metrics(table, "at", ["k"], metrics, width, slide)
        assert rows(rolling.roll_up(fine, ["k"], ["n", "total"], width, slide)) == rows(direct)


def test_append_mode_drops_late_rows_and_holds_open_windows(spark, tmp_path):
    folder = tmp_path / "in"
    for minutes in ([0, 5], [120], [130], [6], [300]):
        time.sleep(0.05)  # files are read in order of their age
        events(spark, minutes).coalesce(1).write.mode("append").parquet(str(folder))
    source = sinks.file_stream(spark, str(folder), events(spark, [0]).schema, files_per_batch=1)
    counts = rolling.windowed_metrics(
        rolling.event_time(source, "at", "30 minutes"), "at", ["k"], {"n": F.count(F.lit(1))}, "15 minutes"
    )
    finish(sinks.append_parquet(counts, str(tmp_path / "out"), str(tmp_path / "state")))
    got = {r["window_start"].strftime("%H:%M"): r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # Minutes 120 and 130 share a window. Minute 6 came after its window was closed; minute 300 is still open.
    assert got == {"00:00": 2, "02:00": 2}


def test_duplicates_are_dropped(spark, tmp_path):
    table = events(spark, [0, 1, 2])
    table.unionAll(table).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = sinks.file_stream(spark, str(tmp_path / "in"), table.schema)
    unique = rolling.without_duplicates(rolling.event_time(source, "at", "1 hour"), ["id"])
    finish(sinks.append_parquet(unique.select("id"), str(tmp_path / "out"), str(tmp_path / "state")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for minutes in ([0, 1], [2, 3, 4]):
        events(spark, minutes).write.mode("append").parquet(folder)
        source = sinks.file_stream(spark, folder, events(spark, [0]).schema)
        finish(sinks.append_parquet(source.select("at"), out, state))
    assert spark.read.parquet(out).count() == 5


def test_enrichment_equals_the_batch_join(spark, tmp_path, rows):
    legs = events(spark, range(0, 600, 7), "a").unionAll(events(spark, range(0, 600, 11), "b"))
    seen = events(spark, range(3, 500, 13), "a").select("k", F.col("at").alias("seen"), F.col("v").alias("w"))
    legs.repartition(3).write.parquet(str(tmp_path / "in"))
    roles = [asof.Role("k", "at")]
    batch = asof.join_asof(legs, seen, roles, "k", "seen", {"w": "w"}, tolerance_seconds=600)
    source = sinks.file_stream(spark, str(tmp_path / "in"), legs.schema, files_per_batch=1)
    out = str(tmp_path / "out")
    finish(
        enrichment.enrich_stream(
            source, seen, roles, "k", "seen", {"w": "w"}, out, str(tmp_path / "state"), max_age_seconds=600
        )
    )
    assert rows(spark.read.parquet(out).drop("batch")) == rows(batch)
    assert batch.filter("w IS NULL").count() > 0


def test_stream_scores_equal_batch_scores(spark, tmp_path, rows):
    from test_model import SPEC

    from punctual.plans import features, model

    legs = spark.range(400).selectExpr(
        "id", "DATE'2024-01-01' AS day", "CAST(id % 24 * 100 AS INT) AS dep", "CAST(id % 24 * 100 AS INT) AS arr",
        "CASE WHEN id % 2 = 0 THEN 'X' ELSE 'Y' END AS carrier", "array('few') AS clouds", "CAST(id % 7 AS DOUBLE) AS wind",
        "CASE WHEN id % 24 > 12 THEN 1.0 ELSE 0.0 END AS late",
    )
    table = features.build_features(legs, SPEC, {})
    fitted = model.fit(SPEC, table, model.boosted_trees(depth=2, iterations=2))
    table.repartition(4).write.parquet(str(tmp_path / "in"))
    source = sinks.file_stream(spark, str(tmp_path / "in"), table.schema, files_per_batch=2)
    finish(scoring.score_to_parquet(fitted, source, str(tmp_path / "out"), str(tmp_path / "state")))
    columns = ["id", "prediction", "delay_probability"]
    assert rows(spark.read.parquet(str(tmp_path / "out")), *columns) == rows(model.score(fitted, table), *columns)
