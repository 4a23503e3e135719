"""What the plans of the named queries must and must not contain. Nothing is executed here."""

import pytest

from __spark_entry__ import oracle_sql, queries
from punctual.plans import catalogue
from punctual.sources.tables import LEG_COLUMNS, legs

FOLDER = "/root/testdata/sf0.001"
ASOF = ("asof_weather", "asof_two_roles", "nearest_observation")
# The corpus operators have plan tests of their own.
BATCH = sorted(name for name in oracle_sql() if not name.startswith(("stream_", "op", "enrich_legs")))


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_rows(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert forbidden not in text
    assert "Python" not in text and "MapInPandas" not in text
    assert "unboundedfollowing" not in text.lower().replace(" ", "") or name not in ASOF


def test_rows_out_of_order_at_a_border_of_runs_count(spark):
    times = [1, 2, 1, 5, 4, 4, None, 3]
    rows = [(ts, name, at) for name in ("a", "b") for at, ts in enumerate(times)]
    placed = spark.createDataFrame(rows, "ts int, file string, place long")
    for run_rows in (1, 2, 3, 100):
        assert tuple(catalogue.rows_before_earlier(placed, run_rows).first()) == (16, 4)


def test_leg_view_reads_and_joins_only_what_is_asked(spark):
    text = plan(legs(spark, FOLDER, "month", "arr_delay"))
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert "Join" not in text.split("== Optimized")[1]
    text = plan(legs(spark, FOLDER, "origin_city"))
    assert "orders" not in text and "part.parquet" not in text and "supplier.parquet" in text


def test_leg_view_row_count_does_not_depend_on_its_columns(spark):
    everything = legs(spark, FOLDER, *LEG_COLUMNS).count()
    assert everything == legs(spark, FOLDER, "leg_date").count()


def test_filters_reach_the_scan(spark):
    text = plan(legs(spark, FOLDER, "carrier", "cancelled").filter("carrier = '2-HIGH'"))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,2-HIGH)" in text
    text = plan(queries()["asof_weather"](spark, FOLDER))
    assert "EqualTo(event_type,view)" in text and "EqualTo(event_type,purchase)" in text
    text = plan(queries()["origin_counts"](spark, FOLDER))
    assert "PushedFilters: []" in text and "ReadSchema: struct<l_suppkey:bigint>" in text


def test_aggregations_start_before_the_shuffle(spark):
    text = plan(queries()["wind_bucket_origin_kt"](spark, FOLDER)).split("== Physical Plan ==")[1]
    assert text.index("Exchange hashpartitioning") < text.index("partial_")


def test_only_small_results_are_ordered_globally(spark):
    for name in ("feature_table", "asof_weather", "decode_observations", "legs_by_dest_date", "sched_timestamps"):
        assert "rangepartitioning" not in plan(queries()[name](spark, FOLDER))


def test_roles_share_one_pass(spark):
    """Per role the points are planned twice (equal exchanges are reused when it runs), and the result reads once more."""
    physical = plan(queries()["asof_two_roles"](spark, FOLDER)).split("== Physical Plan ==")[1]
    assert physical.count("EqualTo(event_type,purchase)") <= 5
    frames = plan(queries()["station_timeframes"](spark, FOLDER)).split("== Physical Plan ==")[1]
    assert frames.count("SortMergeJoin") + frames.count("BroadcastHashJoin") <= 5


def test_legs_meet_stored_responses_without_a_shuffle(spark):
    plan = queries()["legs_in_timeframes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the size of the responses is known
    assert "l_orderkey" not in plan  # the legs are joined once, before
