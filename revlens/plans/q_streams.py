"""Batch twins of the streaming jobs (STR-2/3), registered with oracles;
the streams themselves live in ``revlens.streaming`` and are checked
against these twins in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import streams as ST
from .registry import register


@register("event_window_counts", lambda: """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       count(*)::BIGINT AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2""")
def q_event_window_counts(spark, d):
    """STR-2 batch twin: hourly tumbling counts and value totals per type."""
    w = ST.window_counts(table(spark, d, "events"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n",
                    F.round("total_value", 6).alias("total_value"))


@register("user_sessions", lambda: """
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)
SELECT user_id, sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)::BIGINT AS sessions,
       count(*)::BIGINT AS events
FROM e GROUP BY user_id""")
def q_user_sessions(spark, d):
    """STR-3 batch twin: 30-minute gap sessions per user."""
    s = ST.two_level_sessions(table(spark, d, "events"))
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("events").alias("events"))


@register("complaint_sessions", lambda: """
WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
     n AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                     OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_event,
       count(*)::BIGINT AS events, count(*) FILTER (event_type = 'error')::BIGINT AS complaints
FROM n GROUP BY user_id, session""")
def q_complaint_sessions(spark, d):
    """STR-3: every 30-minute gap session of every user with its complaint
    events (``error``, the events table's own bad outcome)."""
    s = ST.two_level_sessions(table(spark, d, "events"))
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return s.select("user_id", F.date_format("session_start", stamp).alias("session_start"),
                    F.date_format("last_event", stamp).alias("last_event"), "events", "complaints")
