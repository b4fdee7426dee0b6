"""Batches, alignment, progress and generated commands on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import batches, progress
from ledgerweave.operators.scan import number_rows, previous, running_sums


@pytest.mark.parametrize("block", [1, 37, 100, 1 << 17])
def test_command_batches_match_a_plain_fold(spark, block):
    rng = random.Random(7)
    rows = [("t", p, o, rng.choice(["create_transfers", "create_transfers", "create_accounts"]), rng.choice([0, 1, 2, 3, 5, 9]))
            for p in range(2) for o in range(0, 300, 2)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, op string, n_events int")
    out = batches.command_batches(df, 8, block=block).collect()
    assert {(r.partition, r.offset) for r in out} == {(p, o) for _, p, o, _, _ in rows}
    assert {r.error for r in out if r.n_events in (0, 9)} == {"empty_command", "command_too_large"}
    want, batch, filled, kind, place = {}, 0, 0, None, None
    for _, p, o, op, n in rows:
        if n in (0, 9):
            continue
        if p != place:
            place, batch, filled = p, 0, 0
        if filled and (op != kind or filled + n > 8):
            batch, filled = batch + 1, 0
        want[p, o] = batch
        filled, kind = filled + n, op
        if filled >= 8:
            batch, filled = batch + 1, 0
    assert {(r.partition, r.offset): r.batch for r in out if r.error is None} == want
    groups = {}
    for r in out:
        if r.error is None:
            groups.setdefault((r.partition, r.batch), []).append(r)
    for group in groups.values():
        assert sum(r.n_events for r in group) <= 8 and len({r.op for r in group}) == 1


def test_a_short_reply_fails_the_batch(spark):
    commands = spark.createDataFrame([(1, 2, 0, "a", 0), (1, 2, 1, "b", 0)], "batch_id int, batch_size int, start int, id string, idx int")
    full = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "batch_id int, pos int, raw string")
    got = {r.id: r.raw for r in batches.align_outcomes(commands, full).collect()}
    assert got == {"a": "x", "b": "y"}
    with pytest.raises(Exception, match="result count does not match"):
        batches.align_outcomes(commands, full.filter("pos = 0")).collect()


def test_progress_of_known_logs(spark):
    schema = "topic string, partition int, offset bigint, leader_epoch int, done boolean, committed bigint"

    def watermarks(offsets, done, committed=-1):
        rows = [("t", 0, o, o + 10, o in done, committed) for o in offsets]
        return [(r.watermark, r.leader_epoch) for r in progress.committable(spark.createDataFrame(rows, schema)).collect()]

    assert watermarks([0, 1, 2], {0, 2}) == [(1, 10)]
    assert watermarks([0, 1, 2], {0, 1, 2}) == [(3, 12)]
    assert watermarks([3, 5], {3, 5}) == [(6, 15)]  # a gap in the log does not block
    assert watermarks([0, 1], {1}) == []
    assert watermarks([0, 1], {0, 1}, committed=2) == []
    rows = [("t", 0, 5, 1, True, -1), ("t", 0, 6, 1, False, -1)]
    state = spark.createDataFrame(rows, schema)
    assert [r.lag for r in progress.commit_lag(state).collect()] == [2]
    assert [(r.rewind_to, r.leader_epoch) for r in progress.rewind_points(state).collect()] == [(6, 1)]


def test_scans_across_buckets_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 7}", i * 2, rng.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o bigint, x int")
    out = running_sums(df, ["k"], "o", {"s": "x"}, bucket="o div 16")
    out = previous(out, ["k"], "o", "x", "p", bucket="o div 16")
    sums, last, want = {}, {}, {}
    for k, o, x in rows:
        sums[k] = sums.get(k, 0) + x
        want[o] = (sums[k], last.get(k))
        last[k] = x
    assert {r.o: (r.s, r.p) for r in out.collect()} == want
    numbered = number_rows(df.orderBy(F.rand(1)), ["x", "o"]).collect()
    ordered = sorted((r.x, r.o) for r in numbered)
    assert {r.rn: (r.x, r.o) for r in numbered} == {i + 1: v for i, v in enumerate(ordered)}


def test_buckets_need_no_numbering(spark, monkeypatch):
    """Gaps, negative and missing places; more buckets than one; nothing is numbered or written for them."""
    from ledgerweave.operators import scan

    monkeypatch.setattr(scan, "BUCKET", 16)
    monkeypatch.setattr(scan, "number_rows", None)
    rng = random.Random(5)
    orders = [None, *sorted(rng.sample(range(-50, 10**12), 200)), *range(2 * 10**12, 2 * 10**12 + 400)]
    rows = [("hot" if i % 3 else f"k{i % 7}", o, rng.randrange(100)) for i, o in enumerate(orders)]
    df = spark.createDataFrame(rows, "k string, o bigint, x int")
    facts = spark.createDataFrame([("hot", "fact")], "k string, f string")
    out = running_sums(df, ["k"], "o", {"s": "x"}, facts=facts)
    sums, want = {}, {}
    for k, o, x in rows:
        sums[k] = sums.get(k, 0) + x
        want[o] = (sums[k], "fact" if k == "hot" else None)
    assert {r.o: (r.s, r.f) for r in out.collect()} == want
    last, before = {}, {}
    for k, o, x in rows:
        before[o], last[k] = last.get(k), x
    assert {r.o: r.p for r in previous(df, ["k"], "o", "x", "p").collect()} == before
    assert scan._bucketed(df, ["k"], "o", None).select("_b").distinct().count() > 10


def test_only_the_columns_asked_for_are_numbered(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (1, "b", 2.0), (1, "a", 3.0)], "o int, p string, x double")
    out = number_rows(df, ["o", "p"], keep=["x"])
    assert out.columns == ["x", "rn"] and {r.x: r.rn for r in out.collect()} == {3.0: 1, 2.0: 2, 1.0: 3}


def test_missing_values_do_not_depend_on_buckets(spark):
    rows = [("a", i, None if i in (0, 1, 4, 5, 9) else i) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, o bigint, x int")
    want = {0: None, 1: None, 2: 2, 3: 5, 4: 5, 5: 5, 6: 11, 7: 18, 8: 26, 9: 26, 10: 36, 11: 47}
    for size in (1, 2, 4, 100):
        assert {r.o: r.s for r in running_sums(df, ["k"], "o", {"s": "x"}, bucket=f"o div {size}").collect()} == want


def test_totals_are_made_of_hot_keys_only(spark, monkeypatch):
    """A key of few rows is one bucket: its rows move once, and nothing is joined to them."""
    from ledgerweave.operators import scan

    rows = [(f"k{i % 50}", i, i % 9) for i in range(1000)]
    df = spark.createDataFrame([*rows, (None, 5000, 1)], "k string, o bigint, x int")
    sums, want = {}, {}
    for k, o, x in rows:
        sums[k] = sums.get(k, 0) + x
        want[o] = sums[k]
    small = running_sums(df, ["k"], "o", {"s": "x"})
    assert "Join" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert {r.o: r.s for r in small.collect()} == want  # a row without a key is left out, as ever
    monkeypatch.setattr(scan, "BUCKET", 30)
    hot = [("hot", o, 1) for o in range(2000, 2400)]
    want |= {o: i + 1 for i, (_, o, _) in enumerate(hot)}
    mixed = df.unionByName(spark.createDataFrame([*hot, ("hot", None, 7)], "k string, o bigint, x int"))
    facts = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, f int")
    got = running_sums(mixed, ["k"], "o", {"s": "x"}, facts=facts).collect()
    want = {o: s + 7 if o >= 2000 else s for o, s in want.items()} | {None: 7}  # a row without a place comes first
    assert {r.o: r.s for r in got} == want
    assert {(r.k, r.f) for r in got} == {("hot", 1), *((f"k{i}", 2 if i == 3 else None) for i in range(50))}


def test_no_shuffle_files_stay_behind_a_written_step(spark):
    import time

    from ledgerweave.session import configure, stage

    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        every = files.getAllFiles()
        return {name for name in (every.apply(i).getName() for i in range(every.size())) if name.startswith("shuffle_")}

    before = shuffled()
    summed = configure(spark).range(10000).selectExpr("id % 100 as k", "id").groupBy("k").sum("id")
    assert stage(summed).count() == 100
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert len(summed.collect()) == len(summed.collect()) == 100  # the same frame again makes them again


@pytest.mark.parametrize("hi,lo", [(0, 7), (0, 10**18 - 1), (3, 5)])
def test_balances_of_any_size_are_exact(spark, hi, lo):
    from ledgerweave.operators import balances

    amount = "struct<hi:decimal(22,0),lo:decimal(19,0)>"
    legs = spark.range(30).selectExpr(
        "id as seq", "cast(id as string) as id", f"cast(named_struct('hi', 0, 'lo', 0) as {amount}) as pending",
        f"cast(named_struct('hi', {hi}, 'lo', {lo}) as {amount}) as booked",
        "inline(array(named_struct('side', 'debit', 'account_id', 'a'), named_struct('side', 'credit', 'account_id', 'b')))")
    assert balances._fits_long(legs) == (hi == 0 and lo == 7)
    got = {(r.side, r.seq): (int(r.debits_posted.hi) * 10**18 + int(r.debits_posted.lo), int(r.credits_posted.hi) * 10**18 + int(r.credits_posted.lo))
           for r in balances.running_balances(legs).collect()}
    each = hi * 10**18 + lo
    assert got == {(side, s): ((s + 1) * each, 0) if side == "debit" else (0, (s + 1) * each) for s in range(30) for side in ("debit", "credit")}
