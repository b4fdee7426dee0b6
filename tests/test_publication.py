"""Windows inside a micro-batch, tails from footers, reconciliation by ranges, composed outlooks."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import batches, cdc
from ledgerweave.streaming import publish
from test_streaming import REG, changes


def test_a_crash_between_windows_repeats_one(spark, tmp_path):
    ledgers, codes = REG.ledger_table(spark), REG.code_table(spark)
    source, topic, checkpoint = (str(tmp_path / n) for n in ("in", "topic", "cp"))
    windows, wrote, broken = publish.WindowLedger(str(tmp_path / "windows")), [], {"at": 4}
    changes(spark, range(100, 110)).coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def write(records, step):
        if step == "closing":
            broken["at"] -= 1
            if broken["at"] == 0:
                raise RuntimeError("broker gone")
        rows = records.selectExpr("event_timestamp as t", "cast(get_json_object(cast(value as string), '$.checkpoint') as bigint) as c").collect()
        wrote.extend((r["t"], r["c"]) for r in rows)

    def run():
        query = publish.start(spark.readStream.schema(schema).parquet(source), 0, ledgers, codes, "t", write, checkpoint,
                              available_now=True, window=3, windows=windows)
        query.awaitTermination()

    broken["at"] = 3
    with pytest.raises(Exception, match="broker gone"):
        run()
    assert windows.last(spark) == (0, 105)
    assert sorted(wrote) == [(t, 102 if t == 102 else 105 if t == 105 else 0 if t < 102 else 102 if t < 105 else 105) for t in range(100, 108)]
    before = len(wrote)
    run()
    again = wrote[before:]
    assert sorted(again) == [(106, 105), (107, 105), (108, 108), (109, 109)]  # only the third window repeats
    assert {t for t, _ in wrote} == set(range(100, 110)) and windows.last(spark)[1] == 109
    changes(spark, range(110, 114)).coalesce(1).write.mode("append").parquet(source)
    run()
    assert sorted(wrote[-4:]) == [(110, 109), (111, 109), (112, 112), (113, 113)]


def test_late_events_stop_windows_too(spark, tmp_path):
    ledgers, codes = REG.ledger_table(spark), REG.code_table(spark)
    with pytest.raises(publish.OutOfOrder):
        publish.publish_windows(changes(spark, [5, 6, 6]), 0, 2, ledgers, codes, "t", lambda r, s: None, lambda t: None)
    assert publish.publish_windows(changes(spark, []), 7, 2, ledgers, codes, "t", lambda r, s: None, lambda t: None) == 7


def test_tails_come_from_footers(spark, tmp_path):
    topic = str(tmp_path / "topic")
    for batch in range(3):
        rows = [("t", p, 10 * batch + i, f'{{"checkpoint":"{100 * batch + 10 * p + i}"}}'.encode()) for p in range(3) for i in range(5) if p < 2 or batch == 0]
        spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary").write.mode("append").partitionBy("topic", "partition").parquet(topic)
    got = cdc.file_tails(spark, topic)
    want = cdc.tails(spark.read.parquet(topic))
    assert sorted(map(tuple, got.select("partition", "offset", "value").collect())) == sorted(map(tuple, want.select("partition", "offset", "value").collect()))
    assert {(r["partition"], r["offset"]) for r in got.collect()} == {(0, 24), (1, 24), (2, 4)}
    assert int(cdc.highest_claim(got).first()["checkpoint"]) == int(cdc.resume_cursor(spark.read.parquet(topic)).first()["checkpoint"]) == 214
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = footers.read.parquet(topic).groupBy("topic", "partition").agg(F.max("offset"))._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(offset)]" in plan  # no rows are scanned


@pytest.mark.parametrize("width", [None, 1, 7, 10 ** 6])
def test_ranges_find_what_the_full_join_finds(spark, width):
    draw = random.Random(5)
    applied = sorted(draw.sample(range(10 ** 9, 10 ** 9 + 5000), 900))
    published = [t for t in applied if draw.random() > 0.01] + draw.sample(applied, 5) + [17, 10 ** 9 + 6001]
    at = lambda ts: spark.createDataFrame([(t,) for t in ts], "timestamp long")
    want = sorted(map(tuple, cdc.reconcile(at(applied), at(published)).collect()))
    assert want and sorted(map(tuple, cdc.reconcile_ranges(at(applied), at(published), width).collect())) == want
    assert cdc.reconcile_ranges(at(applied), at(applied), width).count() == 0
    assert cdc.reconcile_ranges(at([]), at([3]), width).collect()[0]["problem"] == "extra"


@pytest.mark.parametrize("block,fan", [(1, 2), (3, 2), (4, 3), (1000, 2)])
def test_outlooks_compose_over_any_runs(spark, block, fan):
    draw, rows = random.Random(9), []
    for partition in range(2):
        op = "a"
        for offset in range(60):
            op = draw.choice("ab") if draw.random() < 0.3 else op
            rows.append(("t", partition, offset * draw.choice([1, 1]) + 7, op, draw.randint(1, 5)))
    want, state = {}, {}
    for topic, partition, offset, op, n in rows:
        batch, kind, filled = state.get(partition, (-1, None, 0))
        batch, filled = (batch, filled + n) if op == kind and filled + n <= 8 else (batch + 1, n)
        state[partition] = (batch, op, filled)
        want[partition, offset] = batch
    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint, op string, n_events int")
    got = {(r["partition"], r["offset"]): r["batch"] for r in batches.command_batches(frame, 8, block, fan).collect()}
    assert got == want


def test_checkpoints_leave_wide_rows_in_place(spark):
    """Windows by their ends alone; repeated and missing timestamps as before."""
    from ledgerweave.operators import cdc

    stamps = [5, 9, 11, 40, 41, 77, 90]
    events = spark.createDataFrame([(s, f"wide {s}") for s in stamps] + [(None, "none")], "timestamp bigint, body string")
    out = cdc.checkpoints(events, 3, 2)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    # the row without a timestamp takes the first place and is left out
    assert {r.timestamp: (r.window, r.is_closing, r.checkpoint) for r in out.collect()} == {
        5: (0, False, 2), 9: (0, True, 9), 11: (1, False, 9), 40: (1, False, 9), 41: (1, True, 41), 77: (2, False, 41), 90: (2, True, 90)}
    again = events.unionByName(events.filter("timestamp = 9"))
    assert cdc.checkpoints(again, 3, 2).filter("timestamp = 9").count() == 4
    assert cdc.checkpoints(events.limit(0), 3).count() == 0


def test_a_window_is_written_from_its_own_files(spark):
    read = []
    publish.publish_windows(changes(spark, range(1, 10)), 0, 3, REG.ledger_table(spark), REG.code_table(spark), "t", lambda records, step: read.append((step, records.count(), set(records.inputFiles()))), lambda _: None)
    assert [(step, n) for step, n, _ in read] == [("rest", 2), ("closing", 1)] * 3
    files = [f for step, _, f in read if step == "rest"]
    assert all(f and not f & g for i, f in enumerate(files) for g in files[:i])


def test_a_step_reads_its_own_files_and_layouts_encode_nothing(spark, monkeypatch):
    read, laid = [], []
    named = cdc.named
    monkeypatch.setattr(cdc, "named", lambda events, *more: laid.append(events._jdf.queryExecution().analyzed().toString()) or named(events, *more))
    publish.publish_windows(changes(spark, [*range(1, 8)]), 0, 3, REG.ledger_table(spark), REG.code_table(spark), "t",
                            lambda records, step: read.append((step, sorted(r[0] for r in records.select("event_timestamp").collect()), set(records.inputFiles()))), lambda _: None)
    assert [(step, t) for step, t, _ in read] == [("rest", [1, 2]), ("closing", [3]), ("rest", [4, 5]), ("closing", [6]), ("rest", []), ("closing", [7])]
    files = [f for _, t, f in read if t]
    assert all(f and not f & g for i, f in enumerate(files) for g in files[:i])
    # events reach the encoder in the order and place they are written in
    assert len(laid) == 1 and "RepartitionByExpression" in laid[0]
