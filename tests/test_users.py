"""Distinct users, merged from hourly states."""

from lakeshore import queries
from lakeshore.plans import users
from pyspark.sql import functions as F


def test_numbers_stay_and_are_dense(spark):
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "user_id string")
    first = users.numbered_users(frame([f"u{i}" for i in range(500)] + [None, "u1"]), shards=8)
    old = {r.user_id: r.number for r in first.collect()}
    assert len(old) == 500 == len(set(old.values())) and min(old.values()) >= 1 and max(old.values()) < 800
    known = spark.createDataFrame(list(old.items()), "user_id string, number long")
    new = {r.user_id: r.number for r in users.numbered_users(frame([f"u{i}" for i in range(400, 900)]), known, shards=8).collect()}
    assert len(new) == 900 == len(set(new.values())) and new | old == new and max(new.values()) < 1300
    assert users.numbered_users(frame([]), shards=8).count() == 0


def test_days_and_weeks_count_each_user_once(spark):
    events = queries._events(spark, "/root/testdata/sf0.01").persist()
    exact = users.users_hourly(events, users.numbered_users(events))
    for keys in (("device_os",), ("event_type", "app_version"), ()):
        want = {tuple(r)[:-1]: r.n for r in events.groupBy(*keys).agg(F.countDistinct("user_id").alias("n")).collect()}
        assert {tuple(r)[:-1]: r.unique_users for r in users.distinct_users(exact, *keys).collect()} == want
        sketched = {tuple(r)[:-1]: r.unique_users for r in users.estimated_users(users.sketches_hourly(events), *keys).collect()}
        assert all(abs(sketched[k] - n) <= max(1, 3 * 0.01625 * n) for k, n in want.items()) and sketched.keys() == want.keys()
    events.unpersist()


def test_sketches_of_many_users(spark):
    events = spark.range(60000).selectExpr("concat('u', id % 40000) AS user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 24 AS int)) AS event_time", "'1' AS app_version", "'iOS' AS device_os", "'view' AS event_type")
    (got,) = users.estimated_users(users.sketches_hourly(events)).collect()
    assert abs(got.unique_users - 40000) <= 3 * 0.01625 * 40000


def test_days_parse_each_record_once(spark, sf):
    """Filters on an event's fields are no parses of their own; events are made once, and never broadcast to be numbered."""
    from lakeshore import queries

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(queries._events(spark, sf)).count("from_json(") == 2  # the record's, and its metadata's
    got = queries.report_users_by_day(spark, sf)
    got.collect()
    final = plan(got).split("== Initial Plan ==")[0]
    assert "from_json(" not in final and "BroadcastHashJoin" not in final and "ShuffledHashJoin" in final
