"""Chains with posts and voids against a sequential ledger, and publication that loses nothing."""

import random
from decimal import Decimal

import pytest

from ledgerweave.functions import values as v
from ledgerweave.operators import posting
from ledgerweave.streaming import publish

SCHEMA = ("seq long, id string, debit_account_id string, credit_account_id string, pending_id string, "
          "amount struct<hi:decimal(21,0),lo:decimal(18,0)>, flags int, chain_id long")


def sequential(events):
    """What a ledger that applies one event after another, chain by chain, would answer."""
    pending, done, out, i = {}, set(), {}, 0
    while i < len(events):
        j = i + 1
        while events[i]["chain"] is not None and j < len(events) and events[j]["chain"] == events[i]["chain"]:
            j += 1
        tried, closed, failed = dict(pending), set(done), None
        for e in events[i:j]:
            if e["pending_id"]:
                p = tried.get(e["pending_id"])
                error = ("pending_transfer_not_found" if p is None else "pending_transfer_not_pending" if not p["flags"] & v.PENDING
                         else "exceeds_pending_transfer_amount" if e["flags"] & v.POST and e["amount"] > p["amount"]
                         else "pending_transfer_already_resolved" if e["pending_id"] in closed else None)
                if not error:
                    closed.add(e["pending_id"])
            else:
                error = "debit_account_not_found" if e["debit"] == "nobody" else None
            if error:
                failed = (e["seq"], error)
                break
            tried[e["id"]] = e
        for e in events[i:j]:
            out[e["seq"]] = None if failed is None else failed[1] if e["seq"] == failed[0] else "linked_event_failed"
        if failed is None:
            pending, done = tried, closed
        i = j
    return out


def stream(draw, n):
    events, chain, names = [], None, []
    for seq in range(1, n + 1):
        chain = None if draw.random() < 0.4 else chain if chain and draw.random() < 0.6 else seq
        e = {"seq": seq, "id": f"t{seq}", "chain": chain, "debit": "nobody" if draw.random() < 0.08 else "a", "amount": draw.randint(1, 9), "pending_id": None, "flags": draw.choice([0, v.PENDING, v.PENDING])}
        if names and draw.random() < 0.5:
            e |= {"pending_id": draw.choice(names[-6:] + ["nothing"]), "flags": draw.choice([v.POST, v.VOID])}
        names += [e["id"]] if e["pending_id"] is None else []
        events.append(e)
    return events


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chains_fall_with_their_posts_and_voids(spark, seed):
    events = stream(random.Random(seed), 120)
    rows = [(e["seq"], e["id"], None if e["pending_id"] else e["debit"], None if e["pending_id"] else "b", e["pending_id"], (Decimal(0), Decimal(e["amount"])), e["flags"], e["chain"]) for e in events]
    accounts = spark.createDataFrame([("a", 0), ("b", 0)], "id string, created long")
    got = {r["seq"]: r["error"] for r in posting.post(spark.createDataFrame(rows, SCHEMA), accounts).collect()}
    assert got == sequential(events)


def test_a_post_of_nothing_takes_its_chain_down(spark):
    rows = [(1, "t1", "a", "b", None, (Decimal(0), Decimal(5)), 0, 7), (2, "t2", None, None, "unknown", (Decimal(0), Decimal(5)), v.POST, 7)]
    accounts = spark.createDataFrame([("a", 0), ("b", 0)], "id string, created long")
    got = {r["id"]: r["error"] for r in posting.post(spark.createDataFrame(rows, SCHEMA), accounts).collect()}
    assert got == {"t1": "linked_event_failed", "t2": "pending_transfer_not_found"}


def test_late_events_stop_publication_instead_of_vanishing(spark):
    at = lambda *ts: spark.createDataFrame([(t,) for t in ts], "timestamp long")
    assert [r[0] for r in publish.unpublished(at(103, 104), 102, None).collect()] == [103, 104]
    with pytest.raises(publish.OutOfOrder):
        publish.unpublished(at(99, 103), 102, at(100, 101, 102))
    assert [r[0] for r in publish.unpublished(at(101, 102, 103), 102, at(100, 101, 102)).collect()] == [103]


def test_account_checks_move_narrow_rows_only(spark):
    """Missing, late and repeated accounts, null ids and chains; the events themselves are shuffled by ``seq`` alone."""
    events = spark.createDataFrame(
        [(1, "a", "x", "y", None, 0, 7), (2, "b", "x", "gone", None, 0, 7), (3, "c", "late", "y", None, 0, None), (4, "d", "x", None, None, 0, None),
         (5, "e", "twice", "y", None, 0, None), (6, "f", "late", "x", None, 0, None), (7, "b", "x", "y", None, 0, 8), (8, "g", "x", "y", None, 0, 8)],
        "seq long, id string, debit_account_id string, credit_account_id string, pending_id string, flags int, chain_id long"
    ).selectExpr("*", "named_struct('hi', cast(0 as decimal(21,0)), 'lo', cast(5 as decimal(18,0))) as amount", "0L as timeout_s")
    accounts = spark.createDataFrame([("x", 0), ("y", 0), ("late", 4), ("twice", 0), ("twice", 1)], "id string, created long")
    posted = posting.post(events, accounts)
    assert sorted((r.id, r.error) for r in posted.select("id", "error").collect()) == sorted([
        ("a", "linked_event_failed"), ("b", "credit_account_not_found"), ("c", "debit_account_not_found"), ("d", "credit_account_not_found"),
        ("e", None), ("e", None), ("f", None), ("g", None)], key=lambda x: (x[0], x[1] or ""))
    checked = posting.account_errors(posting.first_copies(events), accounts, events)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = checked._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join" in line]
    # the accounts meet (account, seq), never the events
    assert not any("debit_account_id" in line or "credit_account_id" in line for line in joins), joins


def test_places_under_limits_are_found_on_narrow_rows(spark, monkeypatch):
    from ledgerweave.operators import limits

    numbered, real = [], limits.number_rows
    monkeypatch.setattr(limits, "number_rows", lambda df, *more: numbered.append(df.columns) or real(df, *more))
    events = spark.createDataFrame([(1, "a", "x", "y", None, 0, None), (2, "b", "x", "y", None, 0, 7), (5, "c", "y", "gone", None, 0, 7)],
        "seq long, id string, debit_account_id string, credit_account_id string, pending_id string, flags int, chain_id long"
    ).selectExpr("*", "named_struct('hi', cast(0 as decimal(21,0)), 'lo', cast(5 as decimal(18,0))) as amount", "0L as timeout_s")
    accounts = spark.createDataFrame([("x", 0, 0), ("y", 0, 0)], "id string, created long, flags int")
    out = limits._prepared(events, accounts, None).select("id", "seq", "seq0", "e1").collect()
    assert {(r.id, r.seq, r.seq0, r.e1) for r in out} == {("a", 1, 1, None), ("b", 2, 2, None), ("c", 3, 5, "credit_account_not_found")}
    assert numbered == [["seq", "chain_key", "_first"]]
