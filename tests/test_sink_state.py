"""The sink's memory: limits, timers, seen ids and balances across micro-batches."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.operators import posting
from ledgerweave.operators.decode import DecodeOptions
from ledgerweave.schemas import ENVELOPE
from ledgerweave.sources.registry import Registry
from ledgerweave.streaming import outbox, sink
from ledgerweave.streaming.state import KeyedTable, SeenIds

OPTIONS = DecodeOptions(Registry.of({"USD": (1, 0)}, {"payment": 1}), {"cmd": "json"})
START = datetime.datetime(2024, 1, 1)


def ident(n):
    return f"0193f8a1-7c2e-7000-8000-{n:012d}"


def story(seed, n):
    """(second, transfer) of a ledger with a capped account, pending transfers, timeouts, late posts and repeated ids."""
    draw, rows, pendings, second = random.Random(seed), [], [], 0
    for i in range(n):
        second += draw.choice([0, 1, 1, 2, 6])
        kind = draw.random()
        t = {"id": ident(100 + i), "amount": str(draw.randint(1, 60)), "ledger": "USD", "code": "payment"}
        if kind < 0.25:
            t |= {"debit_account_id": ident(1), "credit_account_id": ident(2)}
        elif kind < 0.5 or not pendings:
            t |= {"debit_account_id": ident(2), "credit_account_id": ident(3)}
        elif kind < 0.55:
            t = dict(draw.choice(rows)[1])  # again
        else:
            t |= {"pending_id": draw.choice(pendings[-4:]), "flags": [draw.choice(["post_pending_transfer", "void_pending_transfer"])], "amount": "1"}
        if "flags" not in t and draw.random() < 0.5:
            t |= {"flags": ["pending"]} | ({"timeout": f"{draw.randint(1, 9)}s"} if draw.random() < 0.8 else {})
            pendings.append(t["id"])
        rows.append((second, t))
    return rows


def replay(rows):
    """The same ledger, one event after another; account 2 may not debit more than it was credited."""
    bal, verdict, held, done, applied = {i: [0, 0, 0, 0] for i in (1, 2, 3)}, {}, {}, {}, []
    clock = 0

    def move(d, c, pending, booked):
        for account, side in ((d, 0), (c, 2)):
            bal[account][side] += pending
            bal[account][side + 1] += booked

    for second, t in rows:
        clock = max(clock, second)
        for at, name in sorted((h["until"], k) for k, h in held.items() if h["until"] is not None and h["until"] <= clock and k not in done):
            h = held[name]
            move(h["d"], h["c"], -h["amount"], 0)
            done[name] = "pending_transfer_expired"
            applied.append((4, name, [list(bal[h["d"]]), list(bal[h["c"]])]))
        if t["id"] in verdict:
            continue
        amount, flags, error = int(t["amount"]), t.get("flags", []), None
        if "pending_id" in t:
            p = t["pending_id"]
            h = held.get(p)
            error = ("pending_transfer_not_found" if h is None else done.get(p))
            if not error:
                move(h["d"], h["c"], -h["amount"], amount if "post_pending_transfer" in flags else 0)
                done[p] = "pending_transfer_already_resolved"
                applied.append((2 if "post_pending_transfer" in flags else 3, t["id"], [list(bal[h["d"]]), list(bal[h["c"]])]))
        else:
            d, c = (int(t[f"{s}_account_id"][-3:]) for s in ("debit", "credit"))
            if d == 2 and bal[2][0] + bal[2][1] + amount > bal[2][3]:
                error = "exceeds_credits"
            else:
                pending = "pending" in flags
                move(d, c, amount if pending else 0, 0 if pending else amount)
                if pending:
                    held[t["id"]] = {"d": d, "c": c, "amount": amount, "until": clock + int(t["timeout"][:-1]) if "timeout" in t else None}
                applied.append((1 if pending else 0, t["id"], [list(bal[d]), list(bal[c])]))
        verdict[t["id"]] = error
    return bal, verdict, applied


def records(spark, rows, first):
    accounts = {"operation": "create_accounts", "accounts": [
        {"id": ident(i), "ledger": "USD", "code": "payment", "flags": ["debits_must_not_exceed_credits"] if i == 2 else []} for i in (1, 2, 3)]}
    texts = [(0, accounts)] if first == 0 else []
    texts += [(s, {"operation": "create_transfers", "transfers": [t]}) for s, t in rows]
    return spark.createDataFrame([
        (b"k", json.dumps(x).encode(), "cmd", 0, first + i + (first > 0), START + datetime.timedelta(seconds=s), 0, None) for i, (s, x) in enumerate(texts)],
        ENVELOPE)


def seen_of(spark, tables):
    names = list(posting.BUCKETS)
    order = ["debits_pending", "debits_posted", "credits_pending", "credits_posted"]
    now = {int(r["account_id"][-3:]): [int(r[n]) for n in order] for r in sink.balances_now(spark, tables).selectExpr(
        "account_id", *[f"{u128.digits(n)} as {n}" for n in names]).collect()}
    errors = {r["id"]: r["error"] for r in tables.posted(spark).filter(f"not {posting.EXPIRY}").select("id", "error").collect()}
    changes = spark.read.parquet(tables.path("changes")).orderBy("timestamp").selectExpr(
        "timestamp", "type", "transfer_id", *[f"{u128.digits(f'{s}_account_{n}')} as {s}_{n}" for s in ("debit", "credit") for n in order]).collect()
    told = [(r["type"], r["transfer_id"], [[int(r[f"{s}_{n}"]) for n in order] for s in ("debit", "credit")]) for r in changes]
    stamps = [r["timestamp"] for r in changes]
    assert stamps == sorted(set(stamps))
    return now, errors, told


@pytest.mark.parametrize("seed,cuts", [(1, [25, 50])])
def test_a_stream_cut_into_batches_equals_the_ledger(spark, tmp_path, seed, cuts):
    rows = story(seed, 70)
    bal, verdict, applied = replay(rows)
    assert {"exceeds_credits", "pending_transfer_expired", "pending_transfer_already_resolved", None} <= set(verdict.values())
    tables, at = sink.SinkTables(str(tmp_path / "t"), seen_bits=1 << 12), 0
    for batch, end in enumerate([*cuts, len(rows)]):
        sink.process_batch(records(spark, rows[at:end], at), batch, OPTIONS, tables)
        at = end
    now, errors, told = seen_of(spark, tables)
    assert errors == verdict
    assert now == {a: b for a, b in bal.items() if any(b) or a in now}
    assert told == applied
    counted = {r["status"]: r["n"] for r in sink.totals_now(spark, tables, "events_total", ["status"]).collect()}
    assert counted["rejected"] == sum(verdict[t["id"]] is not None for _, t in rows) and counted["ok"] == 3 + len(rows) - counted["rejected"]


def test_a_keyed_table_keeps_the_last_row_and_stays_small(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "k"), "id", "id string, n bigint", every=3)
    frame = lambda rows: spark.createDataFrame(rows, "id string, n bigint")
    assert table.read(spark, 5).collect() == []
    want = {}
    for batch in range(8):
        rows = [(f"k{i}", batch) for i in range(batch, batch + 3)]
        table.write(frame(rows), batch, gone="id = 'k4' and n = 4")
        want |= dict(rows)
        if batch == 4:
            del want["k4"]
        table.write(frame(rows), batch, gone="id = 'k4' and n = 4")  # the same batch again
        assert dict(map(tuple, table.read(spark, batch + 1).collect())) == want
    assert dict(map(tuple, table.read(spark, 3).collect())) == {"k0": 0, "k1": 1, "k2": 2, "k3": 2, "k4": 2}  # state ahead of batch 3
    assert [r["id"] for r in table.read(spark, 99, frame([("k7", 0), ("zz", 0)])).collect()] == ["k7"]


def test_seen_ids_are_always_found_and_new_ones_hardly_ever(spark, tmp_path):
    seen = SeenIds(str(tmp_path / "s"), buckets=4, bits=1 << 12)
    ids = lambda a, b: spark.range(a, b).selectExpr("concat('id-', id) as id")
    assert seen.suspected(ids(0, 10), 0).count() == 0
    rows = []
    for batch in range(4):
        new = ids(batch * 500, batch * 500 + 500)
        assert seen.suspected(new, batch).count() <= 2  # nothing of the history need be read
        seen.add(new, batch)
        seen.add(new, batch)  # the same batch again
        rows.append(seen._filters(spark, seen.generations(spark, batch + 1)).count())
    assert seen.suspected(ids(0, 2000), 4).count() == 2000
    assert len(seen.generations(spark, 4)) == 2 and rows == [4, 4, 8, 8]  # rows a generation, not rows an id
    assert seen.suspected(ids(500, 1000), 1).count() <= 2  # ahead of batch 1 they were new


def test_a_failed_delivery_repeats_its_own_step_only(spark, tmp_path):
    sent, broken = [], [True]

    def results(df, batch):
        sent.append(("results", df.count()))

    def dlq(df, batch):
        n = df.count()
        if broken[0]:
            broken[0] = False
            raise RuntimeError("broker gone")
        sent.append(("dlq", n))

    tables, box = sink.SinkTables(str(tmp_path / "t"), seen_bits=1 << 12), outbox.Outbox(results=results, dlq=dlq)
    rows = [(0, {"id": ident(50), "debit_account_id": ident(1), "credit_account_id": ident(9), "amount": "5", "ledger": "USD", "code": "payment"})]
    batch = records(spark, rows, 0)
    with pytest.raises(RuntimeError, match="broker gone"):
        sink.process_batch(batch, 0, OPTIONS, tables, outbox=box)
    sink.process_batch(batch, 0, OPTIONS, tables, outbox=box)
    assert sent == [("results", 2), ("dlq", 1)]
    assert tables.posted(spark).select("error").collect()[0][0] == "credit_account_not_found"


def test_far_offsets_keep_their_order(spark):
    rows = [(b"k", json.dumps({"operation": "create_transfers", "transfers": [
        {"id": ident(200 + i), "debit_account_id": ident(1), "credit_account_id": ident(2), "amount": "1", "ledger": "USD", "code": "payment"}]}).encode(),
        "cmd", p, o, START, 0, None) for i, (p, o) in enumerate([(1, 5), (0, 10 ** 12), (0, 3), (2, 1)])]
    from ledgerweave.operators.decode import decode
    decoded = decode(spark.createDataFrame(rows, ENVELOPE), OPTIONS)
    near = decode(spark.createDataFrame([r[:4] + (r[4] % 1000,) + r[5:] for r in rows], ENVELOPE), OPTIONS)
    order = lambda d: [r["id"][-3:] for r in sink.in_order(d, 3, 8189).orderBy("seq").collect()]
    assert order(decoded) == ["202", "201", "200", "203"]
    low, high = sink.in_order(near, 3, 8189).agg(F.min("seq"), F.max("seq")).first()
    assert 3 * sink.SEQ_PER_BATCH < low < high < 4 * sink.SEQ_PER_BATCH
