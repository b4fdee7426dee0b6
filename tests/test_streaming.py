"""Streams: crash and restart, replay, two-step publication, deduplication."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.operators import cdc
from ledgerweave.operators.decode import DecodeOptions
from ledgerweave.schemas import ENVELOPE, header
from ledgerweave.sources import kafka
from ledgerweave.sources.registry import Registry
from ledgerweave.streaming import publish, sink

REG = Registry.of({"USD": (1, 2)}, {"payment": 1})
OPTIONS = DecodeOptions(REG, {"cmd": "json"})


def ident(n):
    return f"0193f8a1-7c2e-7000-8000-{n:012d}"


def transfer(n, debit, credit, amount, **more):
    return {"id": ident(n), "debit_account_id": ident(debit), "credit_account_id": ident(credit), "amount": amount,
            "ledger": "USD", "code": "payment", **more}


def command(*items, kind="transfers"):
    return json.dumps({"operation": f"create_{kind}", kind: list(items)})


def append(spark, folder, texts, first_offset):
    rows = [(b"k", x.encode(), "cmd", 0, first_offset + i, datetime.datetime(2024, 1, 1), 0, None)
            for i, x in enumerate(texts)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(folder)


def amounts(spark, tables):
    rows = sink.balances_now(spark, tables).selectExpr(
        "account_id", *[f"{u128.digits(n)} as {n}" for n in ("debits_pending", "debits_posted", "credits_posted")])
    return {r.account_id[-2:]: (int(r.debits_pending), int(r.debits_posted), int(r.credits_posted)) for r in rows.collect()}


def test_sink_replay_crash_and_dead_letters(spark, tmp_path):
    source, tables, checkpoint = str(tmp_path / "in"), sink.SinkTables(str(tmp_path / "t")), str(tmp_path / "cp")
    accounts = command(*[{"id": ident(i), "ledger": "USD", "code": "payment"} for i in (1, 2)], kind="accounts")
    first = [
        accounts, command(transfer(10, 1, 2, "10.00")), "garbage",
        command(transfer(11, 1, 2, "7.25", flags=["pending"], timeout="1m")),
        command(transfer(12, 1, 2, "1.00", flags=["linked"]), transfer(13, 1, 9, "1.00")),
    ]

    def run(**more):
        query = sink.start(kafka.read_files_stream(spark, source), OPTIONS, tables, checkpoint, available_now=True, **more)
        query.awaitTermination()

    append(spark, source, first, 0)
    with pytest.raises(Exception, match="stopped after posted"):
        run(fail_after="posted")
    run()  # the same batch again
    assert amounts(spark, tables) == {"01": (725, 1000, 0), "02": (0, 0, 1000)}

    # replay of everything, a post of the earlier pending transfer, a second post of it
    again = first + [
        command({"id": ident(20), "pending_id": ident(11), "flags": ["post_pending_transfer"], "amount": "7.25",
                 "ledger": "USD", "code": "payment"}),
        command({"id": ident(21), "pending_id": ident(11), "flags": ["post_pending_transfer"], "amount": "7.25",
                 "ledger": "USD", "code": "payment"}),
    ]
    append(spark, source, again, 100)
    run()
    assert amounts(spark, tables) == {"01": (0, 1725, 0), "02": (0, 0, 1725)}
    letters = spark.read.parquet(tables.path("dlq")).selectExpr(
        "src_offset", f"{header('headers', 'x-ledger-error')} as error", "cast(value as string) as value").collect()
    errors = sorted((r.src_offset, r.error) for r in letters)
    assert errors == [(2, "decode"), (4, "credit_account_not_found"), (4, "linked_event_failed"), (102, "decode"),
                      (104, "credit_account_not_found"), (104, "linked_event_failed"),
                      (106, "pending_transfer_already_resolved")]
    assert {r.value for r in letters if r.src_offset == 4} == {first[4]}
    results = spark.read.parquet(tables.path("results"))
    assert results.count() == 4 + 6


def change(ts):
    side = lambda p, n: {
        f"{p}_account_id": ident(n), **{f"{p}_account_{b}": {"hi": 0, "lo": 5} for b in (
            "debits_pending", "debits_posted", "credits_pending", "credits_posted")},
        f"{p}_account_user_data_128": None, f"{p}_account_user_data_64": 0, f"{p}_account_user_data_32": 0,
        f"{p}_account_code": 1, f"{p}_account_flags": 8, f"{p}_account_timestamp": 1}
    return {"type": 0, "timestamp": ts, "ledger": 1, "transfer_id": ident(ts), "transfer_amount": {"hi": 0, "lo": 1234},
            "transfer_pending_id": None, "transfer_user_data_128": None, "transfer_user_data_64": 0,
            "transfer_user_data_32": 0, "transfer_timeout": 90, "transfer_code": 1, "transfer_flags": 2,
            "transfer_timestamp": ts, **side("debit", 1 + ts % 3), **side("credit", 7)}


def changes(spark, stamps):
    limb = "struct<hi:bigint,lo:bigint>"
    parts = ["type int", "timestamp bigint", "ledger bigint", "transfer_id string", f"transfer_amount {limb}",
             "transfer_pending_id string", "transfer_user_data_128 string", "transfer_user_data_64 bigint",
             "transfer_user_data_32 bigint", "transfer_timeout bigint", "transfer_code int", "transfer_flags int",
             "transfer_timestamp bigint"]
    for p in ("debit", "credit"):
        parts += [f"{p}_account_id string", *[f"{p}_account_{b} {limb}" for b in (
            "debits_pending", "debits_posted", "credits_pending", "credits_posted")],
            f"{p}_account_user_data_128 string", f"{p}_account_user_data_64 bigint",
            f"{p}_account_user_data_32 bigint", f"{p}_account_code int", f"{p}_account_flags int",
            f"{p}_account_timestamp bigint"]
    return spark.createDataFrame([change(t) for t in stamps], ", ".join(parts))


def test_crash_between_the_two_writes_duplicates_but_never_loses(spark, tmp_path):
    ledgers, codes = REG.ledger_table(spark), REG.code_table(spark)
    table = changes(spark, range(100, 106))
    topic = str(tmp_path / "topic")
    count = {"closing": 0}

    def write(records, step):
        if step == "closing":
            count["closing"] += 1
            if count["closing"] == 2:
                raise RuntimeError("broker gone")
        records.selectExpr(
            "key", "value", "topic", "cast(event_timestamp % 3 as int) as partition",
            f"event_timestamp + {count['closing'] * 1000} as offset", "event_timestamp as timestamp",
        ).write.mode("append").parquet(topic)

    def go(cursor):
        return publish.run_available(
            lambda c: cdc.window_scan(table, c, 3), cursor,
            lambda df, c: publish.publish_window(df, c, ledgers, codes, "changes", write))

    with pytest.raises(RuntimeError, match="broker gone"):
        go(0)
    resumed = cdc.resume_cursor(spark.read.parquet(topic)).first().checkpoint
    assert int(resumed) == 102
    assert go(int(resumed)) == 105
    published = spark.read.parquet(topic)
    assert published.count() == 8  # 103 and 104 twice
    assert cdc.reconcile(table, cdc.deduplicated(published)).count() == 0
    assert int(cdc.resume_cursor(published).first().checkpoint) == 105
    body = json.loads(published.filter("timestamp = 105").first().value)
    assert body["checkpoint"] == "105" and body["transfer"]["timeout"] == "1m30s"
    assert body["transfer"]["amount"] == "12.34" and body["debit_account"]["flags"] == ["history"]
    assert "pending_id" not in body["transfer"] and list(body) == [
        "type", "timestamp", "checkpoint", "ledger", "transfer", "debit_account", "credit_account"]


def test_out_of_order_windows_stop_the_job(spark):
    ledgers, codes = REG.ledger_table(spark), REG.code_table(spark)
    with pytest.raises(publish.OutOfOrder):
        publish.publish_window(changes(spark, [5, 6, 6]), 0, ledgers, codes, "t", lambda r, s: None)
    rows = spark.createDataFrame([(1, 10), (2, 12), (3, 11)], "pos bigint, timestamp bigint")
    with pytest.raises(publish.OutOfOrder):
        publish.check_order(rows, "pos")


def test_stream_deduplication_keeps_late_copies(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "timestamp bigint, value string"
    out = []

    def step(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = publish.deduplicated(spark.readStream.schema(schema).parquet(folder))
        query = (stream.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
                 .foreachBatch(lambda df, _: out.extend(r.timestamp for r in df.collect()))
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    step([(105, "a"), (104, "a"), (104, "b")])
    step([(103, "late"), (105, "again"), (104, "again")])  # a running maximum would lose 103
    assert sorted(out) == [103, 104, 105]


def test_expiries_come_out_of_the_join(spark, tmp_path):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    left, right, out = str(tmp_path / "p"), str(tmp_path / "r"), []
    ps, rs = "id string, expires_at timestamp", "pending_id string, resolved_at timestamp"

    def step(pendings, resolvers):
        spark.createDataFrame(pendings, ps).coalesce(1).write.mode("append").parquet(left)
        spark.createDataFrame(resolvers, rs).coalesce(1).write.mode("append").parquet(right)
        joined = publish.expiries(spark.readStream.schema(ps).parquet(left), spark.readStream.schema(rs).parquet(right))
        query = (joined.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
                 .foreachBatch(lambda df, _: out.extend(r.id for r in df.collect()))
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    step([("a", t(10)), ("b", t(10)), ("c", t(50))], [("a", t(5))])
    step([("z", t(59))], [("other", t(20))])
    assert out == ["b"]
