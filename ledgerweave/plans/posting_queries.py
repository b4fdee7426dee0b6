"""Posting, balances and lookups over the orders mapped to transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.operators import balances, limits, lookups, posting
from ledgerweave.plans import duck, inputs
from ledgerweave.sources import tables as t

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def _texts(*names: str) -> list[str]:
    return [f"{u128.digits(n)} as {n}" for n in names]


# all transfers applied once, no account rules: the smallest whole pipeline
@query("account_balances_agg", f"""WITH {duck.EVENTS},
f AS (SELECT * FROM ev WHERE flags NOT IN (4, 8) QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1),
l AS (SELECT debit AS account_id, amt AS d, 0 AS c, flags & 2 AS p FROM f UNION ALL SELECT credit, 0, amt, flags & 2 FROM f)
SELECT account_id, sum(CASE WHEN p = 2 THEN d ELSE 0 END)::VARCHAR AS debits_pending, sum(CASE WHEN p = 0 THEN d ELSE 0 END)::VARCHAR AS debits_posted,
 sum(CASE WHEN p = 2 THEN c ELSE 0 END)::VARCHAR AS credits_pending, sum(CASE WHEN p = 0 THEN c ELSE 0 END)::VARCHAR AS credits_posted,
 sum(CASE WHEN p = 0 THEN c - d ELSE 0 END)::VARCHAR AS net FROM l GROUP BY 1""")
def account_balances_agg(spark, sf):
    events = t.fundings(spark, sf).unionByName(t.transfers(spark, sf))
    firsts = posting.first_copies(events).selectExpr(
        "*", "cast(null as string) as error", f"cast(null as {u128.LIMBS}) as p_amount",
        "cast(null as string) as p_debit", "cast(null as string) as p_credit")
    return balances_text(posting.balances(posting.legs(firsts)))


def balances_text(sums):
    return sums.selectExpr("account_id", *_texts(*posting.BUCKETS),
                           f"{u128.difference('credits_posted', 'debits_posted')} as net")


@query("idempotent_transfers", f"""WITH {duck.EVENTS}
SELECT seq, id, amt::VARCHAR AS minor FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1""")
def idempotent_transfers(spark, sf):
    return posting.first_copies(t.ledger_events(spark, sf)).selectExpr("seq", "id", f"{u128.digits('amount')} as minor")


@query("account_not_found", f"""WITH {duck.EVENTS}, {duck.ACCOUNTS},
f AS (SELECT * FROM ev WHERE flags NOT IN (4, 8) QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1)
SELECT seq, id, CASE WHEN d.id IS NULL THEN 'debit_account_not_found' ELSE 'credit_account_not_found' END AS error
FROM (SELECT * FROM f) f LEFT JOIN acc d ON d.id = f.debit AND d.created < f.seq LEFT JOIN acc c ON c.id = f.credit AND c.created < f.seq
WHERE d.id IS NULL OR c.id IS NULL""".replace("SELECT seq, id,", "SELECT f.seq, f.id,"))
def account_not_found(spark, sf):
    events = t.fundings(spark, sf).unionByName(t.transfers(spark, sf))
    return posting.account_errors(posting.first_copies(events), t.accounts(spark, sf), events).filter("error is not null").select("seq", "id", "error")


@query("linked_chains", f"""WITH {duck.POSTED} SELECT seq, id, chain_id, e2 AS error FROM s2 WHERE chain_id IS NOT NULL""")
def linked_chains(spark, sf):
    events = t.transfers(spark, sf)
    judged = posting.chain_errors(posting.account_errors(posting.first_copies(events), t.accounts(spark, sf), events))
    return judged.filter("chain_id is not null").select("seq", "id", "chain_id", "error")


@query("two_phase_resolve", f"""WITH {duck.POSTED} SELECT seq, id, pending_id, p_amt::VARCHAR AS reserved, error FROM posted WHERE flags IN (4, 8)""")
def two_phase_resolve(spark, sf):
    return inputs.posted(spark, sf).filter(posting.RESOLVES).selectExpr(
        "seq", "id", "pending_id", f"{u128.digits('p_amount')} as reserved", "error")


def _phase(name: str, keep: str, duck_keep: str):
    def run(spark, sf):
        moved = posting.legs(inputs.posted(spark, sf).filter(keep))
        return balances_text(posting.balances(moved))

    QUERIES[name] = run
    ORACLES[name] = f"""WITH {duck.LEGS.replace('FROM posted WHERE error IS NULL', f'FROM posted WHERE error IS NULL AND ({duck_keep})')}
SELECT account_id, sum(CASE WHEN side = 'debit' THEN pend ELSE 0 END)::VARCHAR AS debits_pending, sum(CASE WHEN side = 'debit' THEN book ELSE 0 END)::VARCHAR AS debits_posted,
 sum(CASE WHEN side = 'credit' THEN pend ELSE 0 END)::VARCHAR AS credits_pending, sum(CASE WHEN side = 'credit' THEN book ELSE 0 END)::VARCHAR AS credits_posted,
 sum(CASE WHEN side = 'credit' THEN book ELSE -book END)::VARCHAR AS net FROM legs GROUP BY 1"""


_phase("post_single_phase", "flags & 14 = 0", "flags & 14 = 0")
_phase("pending_balances", "flags & 2 <> 0", "flags & 2 <> 0")
_phase("two_phase_balances", "true", "true")


@query("transfer_outcomes", f"""WITH {duck.POSTED} SELECT CASE WHEN p.error IS NULL THEN 'ok' ELSE 'rejected' END AS status, p.error, count(*) AS n
FROM ev JOIN posted p ON ev.id = p.id GROUP BY ALL""")
def transfer_outcomes(spark, sf):
    return posting.outcomes(t.ledger_events(spark, sf), inputs.posted(spark, sf)).groupBy("status", "error").agg(
        F.count("*").alias("n"))


@query("expired_pending", f"""WITH {duck.POSTED}, {duck.DUE} SELECT id, seq AS created, expires_at, xseq AS expired_seq, amt::VARCHAR AS minor FROM due""")
def expired_pending(spark, sf):
    return inputs.due(spark, sf).selectExpr(
        "id", "seq as created", "expires_at", "expired_seq", f"{u128.digits('amount')} as minor")


@query("running_balances", f"""WITH {duck.LEGS}
SELECT seq, side, account_id, sum(CASE WHEN side = 'debit' THEN pend ELSE 0 END) OVER w::VARCHAR AS debits_pending,
 sum(CASE WHEN side = 'debit' THEN book ELSE 0 END) OVER w::VARCHAR AS debits_posted, sum(CASE WHEN side = 'credit' THEN pend ELSE 0 END) OVER w::VARCHAR AS credits_pending,
 sum(CASE WHEN side = 'credit' THEN book ELSE 0 END) OVER w::VARCHAR AS credits_posted FROM legs WINDOW w AS (PARTITION BY account_id ORDER BY seq)""")
def running_balances(spark, sf):
    return balances.running_balances(posting.legs(inputs.posted(spark, sf))).selectExpr(
        "seq", "side", "account_id", *_texts(*posting.BUCKETS))


@query("no_loss_no_double", f"""WITH {duck.EVENTS}
SELECT count(DISTINCT id) AS sent, 0 AS lost, (SELECT sum(amt) FROM (SELECT amt FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1))::VARCHAR AS total FROM ev""")
def no_loss_no_double(spark, sf):
    """Post the stream twice over: every id is there once, and the total is that of the first copies."""
    # several steps read the events and two the first copies: of both only what they read is written, once
    events = t.staged(spark, sf, "sent", lambda s, d: t.ledger_events(s, d).select("seq", "id", "amount"))
    replayed = events.unionByName(events.withColumn("seq", F.expr("seq + 1000000000000000")))
    applied = t.staged(spark, sf, "applied_once", lambda s, d: posting.first_copies(replayed).select("id", "amount"))
    lost = events.select("id").distinct().join(applied.select("id"), "id", "left_anti")
    total = applied.agg(F.count("*").alias("sent"), F.expr(u128.sum_limbs("amount")).alias("s"))
    return total.selectExpr("'k' as k", "sent", f"{u128.digits('s')} as total").join(
        lost.agg(F.count("*").alias("lost")).selectExpr("'k' as k", "cast(lost as int) as lost"), "k"
    ).select("sent", "lost", "total")


# --- lookups -------------------------------------------------------------------------

@query("lookup_transfers", f"""WITH {duck.POSTED} SELECT id, seq, amt::VARCHAR AS minor FROM posted WHERE error IS NULL AND id IN (
 SELECT {duck.uid(3, '(o_orderkey % 7 + 1)', 'o_orderkey')} FROM orders)""")
def lookup_transfers(spark, sf):
    wanted = t.load(spark, sf, "orders").selectExpr(f"{t.object_id(3, 'o_orderkey % 7 + 1', 'o_orderkey')} as id")
    return lookups.by_ids(inputs.posted(spark, sf).filter("error is null"), wanted).selectExpr(
        "id", "seq", f"{u128.digits('amount')} as minor")


@query("lookup_accounts", f"""WITH {duck.CUST}, {duck.ACCOUNTS} SELECT id, ledger::BIGINT AS ledger_id, code, flags FROM acc WHERE id IN (SELECT DISTINCT {duck.uid(1, 'user_id')} FROM events)""")
def lookup_accounts(spark, sf):
    wanted = t.load(spark, sf, "events").selectExpr(f"{t.object_id(1, 'user_id')} as id")
    return lookups.by_ids(t.accounts(spark, sf), wanted).select("id", "ledger_id", "code", "flags")


@query("account_transfers", f"""WITH {duck.POSTED}, x AS (SELECT id, seq, 'debit' AS side, debit AS account_id FROM posted WHERE error IS NULL
 UNION ALL SELECT id, seq, 'credit', credit FROM posted WHERE error IS NULL)
SELECT * FROM x WHERE account_id IN (SELECT id FROM acc WHERE flags & 2 <> 0)""")
def account_transfers(spark, sf):
    wanted = t.accounts(spark, sf).filter(f"flags & {v.DEBITS_CAPPED} <> 0")
    return lookups.account_transfers(inputs.posted(spark, sf).filter("error is null"), wanted).select(
        "id", "seq", "side", "account_id")


@query("account_balances", f"""WITH {duck.LEGS}, r AS (SELECT seq, side, account_id, sum(CASE WHEN side = 'debit' THEN book ELSE 0 END) OVER w::VARCHAR AS debits_posted,
 sum(CASE WHEN side = 'credit' THEN book ELSE 0 END) OVER w::VARCHAR AS credits_posted FROM legs WINDOW w AS (PARTITION BY account_id ORDER BY seq))
SELECT * FROM r WHERE account_id IN (SELECT id FROM acc WHERE flags & 8 <> 0)""")
def account_balances(spark, sf):
    kept = lookups.by_ids(
        posting.legs(inputs.posted(spark, sf)).withColumn("lid", F.col("id")).withColumn("id", F.col("account_id")),
        t.accounts(spark, sf).filter(f"flags & {v.HISTORY} <> 0"))
    return balances.running_balances(kept).selectExpr(
        "seq", "side", "account_id", *_texts("debits_posted", "credits_posted"))


@query("query_transfers", f"""WITH {duck.POSTED} SELECT id, seq, code FROM posted WHERE error IS NULL AND ledger = 2 AND code = 1 AND seq >= {duck.BASE} ORDER BY seq LIMIT 500""")
def query_transfers(spark, sf):
    return lookups.query(inputs.posted(spark, sf).filter("error is null"), ledger_id=2, code=1,
                         since=duck.BASE, limit=500).select("id", "seq", "code")


@query("query_accounts", f"""WITH {duck.CUST}, {duck.ACCOUNTS} SELECT id, flags FROM acc WHERE ledger = 3 AND code = 1""")
def query_accounts(spark, sf):
    return lookups.query(t.accounts(spark, sf), ledger_id=3, code=1).select("id", "flags")


@query("limit_checked_posting")
def limit_checked_posting(spark, sf):
    settled = limits.settle(t.ledger_events(spark, sf), t.accounts(spark, sf))
    return settled.select("seq", "id", "error")
