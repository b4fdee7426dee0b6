"""Offset progress over the event table as a partitioned log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.operators import progress
from ledgerweave.sources import tables as t

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


# early records are all done, so that watermarks move; later ones depend on their type
_STATE = """st AS (SELECT 'events' AS topic, (user_id % 4)::INT AS partition, event_id AS "offset", (event_id // 1000)::INT AS leader_epoch,
  event_type <> 'error' OR event_id % 10000 < 500 AS done, CASE WHEN user_id % 4 = 3 THEN -1 ELSE 100 END AS committed FROM events),
pt AS (SELECT topic, partition, min("offset") FILTER (WHERE NOT done) AS first_pending, max("offset") FILTER (WHERE done) AS last_done,
  max(committed) AS committed, min("offset") AS lowest, max("offset") AS highest FROM st GROUP BY ALL)"""


def _state(spark, sf):
    return t.load(spark, sf, "events").selectExpr(
        "'events' as topic", "cast(user_id % 4 as int) as partition", "event_id as offset",
        "cast(event_id div 1000 as int) as leader_epoch", "event_type <> 'error' or event_id % 10000 < 500 as done",
        "if(user_id % 4 = 3, -1L, 100L) as committed")


@query("committable", f"""WITH {_STATE}, m AS (SELECT *, coalesce(first_pending, last_done + 1) AS watermark FROM pt)
SELECT m.topic, m.partition, watermark, leader_epoch FROM m JOIN st ON st.partition = m.partition AND st."offset" = watermark - 1 AND st.done WHERE watermark > m.committed""")
def committable(spark, sf):
    # a partition's offsets are sparse here: make them dense first, so that boundaries exist
    return progress.committable(_state(spark, sf))


# the same log with dense offsets: every partition has its own boundary record
@query("committable_dense", """WITH st AS (SELECT (event_id % 4)::INT AS partition, event_id // 4 AS o, (event_id // 1000)::INT AS ep, event_type <> 'error' OR event_id < 2000 AS done FROM events),
m AS (SELECT partition, coalesce(min(o) FILTER (WHERE NOT done), max(o) FILTER (WHERE done) + 1) AS watermark FROM st GROUP BY 1)
SELECT 'dense' AS topic, m.partition, watermark, ep AS leader_epoch FROM m JOIN st ON st.partition = m.partition AND st.o = watermark - 1 AND done WHERE watermark > -1""")
def committable_dense(spark, sf):
    return progress.committable(_dense(spark, sf))


def _dense(spark, sf):
    return t.load(spark, sf, "events").selectExpr(
        "'dense' as topic", "cast(event_id % 4 as int) as partition", "event_id div 4 as offset",
        "cast(event_id div 1000 as int) as leader_epoch", "event_type <> 'error' or event_id < 2000 as done", "-1L as committed")


@query("rewind_points", f"""WITH {_STATE} SELECT pt.topic, pt.partition, first_pending AS rewind_to, coalesce(leader_epoch, -1) AS leader_epoch
FROM pt LEFT JOIN st ON st.partition = pt.partition AND st."offset" = first_pending - 1 AND st.done WHERE first_pending IS NOT NULL""")
def rewind_points(spark, sf):
    return progress.rewind_points(_state(spark, sf))


@query("commit_lag", f"""WITH {_STATE} SELECT topic, partition, highest + 1 - CASE WHEN committed < 0 THEN lowest ELSE committed END AS lag FROM pt""")
def commit_lag(spark, sf):
    return progress.commit_lag(_state(spark, sf))


@query("in_flight", f"""WITH {_STATE} SELECT count(*) FILTER (WHERE NOT done) AS in_flight FROM st""")
def in_flight(spark, sf):
    return progress.in_flight(_state(spark, sf))


# marks: every record tracked except some, done marks doubled, some done without track, one commit per partition
@query("progress_state", """WITH e AS (SELECT (user_id % 4)::INT AS partition, event_id AS o, (event_id // 1000)::INT AS ep, event_type AS et FROM events)
SELECT 'events' AS topic, partition, o AS "offset", ep AS leader_epoch, et <> 'error' AS done, CASE WHEN partition = 3 THEN -1 ELSE 3000 END AS committed
FROM e WHERE et <> 'view' AND NOT (et <> 'error' AND o < CASE WHEN partition = 3 THEN -1 ELSE 3000 END)""")
def progress_state(spark, sf):
    events = t.load(spark, sf, "events").selectExpr(
        "'events' as topic", "cast(user_id % 4 as int) as partition", "event_id as offset",
        "cast(event_id div 1000 as int) as leader_epoch", "event_type")
    track = events.filter("event_type <> 'view'").withColumn("mark", F.lit("track"))
    done = events.filter("event_type <> 'error'").withColumn("mark", F.lit("done"))
    commit = events.filter("partition <> 3").selectExpr(
        "topic", "partition", "3000L as offset", "leader_epoch", "event_type", "'commit' as mark")
    return progress.progress_state(track.unionByName(done).unionByName(done).unionByName(commit))


_RECORDS = """r AS (SELECT (user_id % 4)::INT AS partition, event_id AS o, NOT (event_type = 'error' AND event_id % 10000 > 4000) AS good FROM events),
stop AS (SELECT partition, min(o) FILTER (WHERE NOT good) AS s FROM r GROUP BY 1)"""


def _records(spark, sf, name: str, value: str):
    return t.load(spark, sf, "events").selectExpr(
        "'events' as topic", "cast(user_id % 4 as int) as partition", "event_id as offset", f"{value} as {name}")


@query("acked_prefix", f"""WITH {_RECORDS} SELECT r.partition, o AS "offset" FROM r JOIN stop ON stop.partition = r.partition WHERE s IS NULL OR o < s""")
def acked_prefix(spark, sf):
    return progress.acked_prefix(_records(spark, sf, "acked", "not (event_type = 'error' and event_id % 10000 > 4000)")).select(
        "partition", "offset")


@query("failure_cut", f"""WITH {_RECORDS} SELECT r.partition, o AS "offset" FROM r JOIN stop ON stop.partition = r.partition WHERE s IS NULL OR o < s""")
def failure_cut(spark, sf):
    return progress.failure_cut(_records(spark, sf, "failed", "event_type = 'error' and event_id % 10000 > 4000")).select(
        "partition", "offset")


@query("pass_cap", """SELECT (user_id % 4)::INT AS partition, event_id AS "offset" FROM events QUALIFY row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) <= 1000""")
def pass_cap(spark, sf):
    return progress.pass_cap(_records(spark, sf, "kind", "event_type"), 1000).select("partition", "offset")
