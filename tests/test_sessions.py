"""Two-level sessions against ``session_window``."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare
from revlens.streaming import streams as ST

START = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(START + timedelta(microseconds=t), u, k) for t, u, k in rows],
                                 "ts timestamp_ntz, user_id long, event_type string")


def both(df, gap="30 minutes"):
    plain = ST.sessions(df, gap).select("user_id", F.col("s.start").cast("string"), "events")
    made = ST.two_level_sessions(df, gap).select("user_id", F.col("session_start").cast("string"), "events")
    return sorted(map(tuple, plain.collect()), key=str), sorted(map(tuple, made.collect()), key=str)


def test_equal_to_session_window_with_a_hot_user(spark):
    rnd = random.Random(1)
    minute = 60_000_000
    rows = [(rnd.randrange(20 * 24 * 60 * minute), 7 if i % 3 == 0 else rnd.randrange(60), rnd.choice(["view", "error"]))
            for i in range(3000)]
    plain, made = both(events(spark, rows))
    assert plain == made and len(made) > 500
    plain, made = both(events(spark, rows), "3 hours")
    assert plain == made


def test_gap_edges_ties_and_times_before_1970(spark):
    gap = 30 * 60_000_000
    day = -60 * 365 * 24 * 3600 * 1_000_000
    for offset in (0, 1, gap - 1, day, day - 1):
        rows = [(offset, 1, "view"), (offset, 1, "view"), (offset + gap, 1, "error"), (offset + 2 * gap - 1, 1, "view"),
                (offset + 3 * gap, 1, "view"), (offset, 2, "error"), (offset + gap - 1, 2, "error"),
                (offset, None, "view"), (offset + 4 * gap, None, None)]
        plain, made = both(events(spark, rows))
        assert plain == made


def test_complaints_null_times_and_empty(spark):
    df = events(spark, [(0, 1, "error"), (5, 1, "view"), (10, 1, None)]).unionByName(
        spark.createDataFrame([(None, 1, "error")], "ts timestamp_ntz, user_id long, event_type string"))
    assert [(r.events, r.complaints) for r in ST.two_level_sessions(df).collect()] == [(3, 1)]
    assert ST.two_level_sessions(df.limit(0)).count() == 0


def test_twins(spark, sf_small):
    for name in ("user_sessions", "complaint_sessions"):
        got = compare(spark, E.queries()[name], E.oracle_sql()[name], sf_small)
        assert got["cols_match"] and got["hash_match"] and got["spark_rows"], got
