"""Posting as set operations: idempotence, existence, two-phase, chains.

Events carry a total order ``seq``. Everything here is order-free apart from
comparisons of ``seq``, so it runs as aggregates and equi-joins. Accounts with
a spending limit make later events depend on earlier verdicts; those streams go
through ``limits.settle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.session import stage

#: An account cannot carry both limits: such accounts are never created.
BOTH_CAPS = f"(flags & {v.DEBITS_CAPPED | v.CREDITS_CAPPED}) = {v.DEBITS_CAPPED | v.CREDITS_CAPPED}"
RESOLVES = f"(flags & {v.POST | v.VOID}) <> 0"
#: Ids of the voids that timers add to the order (operators/expiry); no command can carry such an id.
EXPIRY_PREFIX = "expiry:"
EXPIRY = f"startswith(id, '{EXPIRY_PREFIX}')"


def lost_to(expiry: str) -> str:
    """SQL text of why a post or void comes too late."""
    return f"if({expiry}, 'pending_transfer_expired', 'pending_transfer_already_resolved')"


def first_copies(events: DataFrame) -> DataFrame:
    """The first event of every id; repeats move nothing.

    The minimum of ``seq`` aggregates on the map side, so an id that makes up a
    third of the stream reaches the shuffle as one row per task, and the rows
    themselves are picked by ``seq``, which is unique.
    """
    return events.join(_first_seqs(events), "seq", "left_semi").select(*events.columns)


def _first_seqs(events: DataFrame) -> DataFrame:
    return events.groupBy("id").agg(F.min("seq").alias("seq")).select("seq")


def _account_marks(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """(seq, chain_id, side, account, n) where not exactly one account of that id exists at the event's place in the order."""
    created = accounts.groupBy("id").agg(F.collect_list("created").alias("_created")).withColumnRenamed("id", "_id")
    chain = "chain_id" if "chain_id" in events.columns else "cast(null as bigint) as chain_id"
    touched = events.selectExpr(
        "seq", chain, f"{RESOLVES} as _resolves",
        "inline(array(named_struct('side', 'debit', 'account', debit_account_id),"
        " named_struct('side', 'credit', 'account', credit_account_id)))",
    ).filter("account is not null or not _resolves")
    return touched.join(created, F.expr("account = _id"), "left").selectExpr(
        "seq", "chain_id", "side", "account", "_resolves",
        "if(_id is null, 0, size(filter(_created, c -> c < seq))) as n",
    ).filter("n > 1 or n = 0 and not _resolves").drop("_resolves")


def account_errors(events: DataFrame, accounts: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Add ``error`` for events whose accounts do not exist yet at their place in the order.

    Only ids and places travel to the accounts; the few that lack one come back
    and meet the events by ``seq``. ``among`` holds these events and maybe more,
    where that table is cheaper to read twice than ``events``. An account that
    exists n times makes n rows of its event.
    """
    marks = _account_marks(events if among is None else among, accounts).groupBy("seq").agg(
        F.collect_set(F.struct("side", "account", "n")).alias("_marks")).withColumnRenamed("seq", "_seq")

    def found(side: str) -> str:
        return f"coalesce(get(filter(_marks, m -> m.side = '{side}' and m.account <=> {side}_account_id), 0).n, 1)"

    return (
        events.join(marks, F.expr("seq = _seq"), "left")
        .selectExpr(*events.columns, f"{found('debit')} as _debits", f"{found('credit')} as _credits")
        .selectExpr(
            *events.columns,
            f"case when {RESOLVES} then null when _debits = 0 then 'debit_account_not_found'"
            " when _credits = 0 then 'credit_account_not_found' end as error",
            "explode(sequence(1, greatest(_debits, 1) * greatest(_credits, 1))) as _copy",
        ).drop("_copy")
    )


def _checked(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """First copies with account and chain errors, for events whose chains hold no post or void.

    What fails is found on narrow rows; the events themselves move once, by ``seq``.
    """
    missing = _account_marks(events, accounts).filter("n = 0 and chain_id is not null").select("seq", "chain_id")
    failed = missing.join(_first_seqs(events), "seq", "left_semi").groupBy("chain_id").agg(F.min("seq").alias("_failed"))
    fallen = events.filter("chain_id is not null").select("seq", "chain_id").join(failed, "chain_id").groupBy("seq").agg(
        F.min("_failed").alias("_failed")).withColumnRenamed("seq", "_fallen")
    judged = account_errors(first_copies(events), accounts, events)
    return judged.join(fallen, F.expr("seq = _fallen"), "left").selectExpr(
        *events.columns,
        "case when _failed is null or seq = _failed then error else 'linked_event_failed' end as error")


def chain_errors(events: DataFrame) -> DataFrame:
    """All or nothing: the first failing leg keeps its error, its chain mates share its fate."""
    failed = (
        events.filter("error is not null and chain_id is not null")
        .groupBy("chain_id").agg(F.min("seq").alias("_failed"))
        .withColumnRenamed("chain_id", "_chain")
    )
    # unchained events get keys of their own instead of one null key for all
    return (
        events.join(failed, F.expr("coalesce(chain_id, -seq) = _chain"), "left")
        .selectExpr(
            *[c for c in events.columns if c != "error"],
            "case when _failed is null then error when seq = _failed then error"
            " else 'linked_event_failed' end as error",
        )
    )


def two_phase(events: DataFrame, earlier: DataFrame | None = None, fallen: DataFrame | None = None) -> DataFrame:
    """Match posts and voids with their pending transfer; the first good one wins.

    Adds ``p_amount, p_debit, p_credit``: what the resolved transfer reserved, and where.
    ``earlier`` holds rows a previous call returned, for a stream posted in batches.
    ``fallen`` (chain_id) are chains that fail: what they would do counts only for
    their own legs, which are judged as if the chain stood until its first failure.
    """
    needed = ["id", "seq", "flags", "amount", "debit_account_id", "credit_account_id", "error", "chain_id", "_fallen"]
    if fallen is None:
        marked = events.withColumn("_fallen", F.lit(False))
    else:
        chains = fallen.select(F.col("chain_id").alias("_chain"), F.lit(True).alias("_down"))
        marked = events.join(chains, F.expr("coalesce(chain_id, -seq) = _chain"), "left").selectExpr(
            *events.columns, "_down is not null as _fallen")
    plain = marked.filter(f"not ({RESOLVES})")
    known = plain.select(*needed)
    if earlier is not None:
        # other calls' chains are done with; their numbers may come again
        before = earlier.selectExpr(*[c for c in earlier.columns if c != "chain_id"], "cast(null as bigint) as chain_id", "false as _fallen")
        known = known.unionByName(before.filter(f"not ({RESOLVES})").select(*needed))
    targets = known.filter("error is null").selectExpr(
        "id as _p", "seq as _p_seq", "flags as _p_flags", "amount as p_amount",
        "debit_account_id as p_debit", "credit_account_id as p_credit", "if(_fallen, chain_id, null) as _p_only",
    )
    matched = (
        marked.filter(RESOLVES)
        .join(targets, F.expr("pending_id = _p and _p_seq < seq and (_p_only is null or _p_only = chain_id)"), "left")
        .selectExpr(
            *[c for c in marked.columns if c != "error"], "p_amount", "p_debit", "p_credit",
            "coalesce(error, case when _p is null then 'pending_transfer_not_found'"
            f" when (_p_flags & {v.PENDING}) = 0 then 'pending_transfer_not_pending'"
            f" when (flags & {v.POST}) <> 0 and amount > p_amount then 'exceeds_pending_transfer_amount' end)"
            " as error",
        )
    )
    claims = matched.filter("error is null").selectExpr("pending_id", "seq", "chain_id", "_fallen", f"{EXPIRY} as expiry")
    standing = claims.filter("not _fallen").select("pending_id", "seq", "expiry")
    if earlier is not None:
        standing = standing.unionByName(earlier.filter(f"error is null and {RESOLVES}").selectExpr("pending_id", "seq", f"{EXPIRY} as expiry"))
    winners = standing.groupBy("pending_id").agg(F.min(F.struct("seq", "expiry")).alias("_won")).withColumnRenamed("pending_id", "_resolved")
    resolved = matched.join(winners, F.expr("pending_id = _resolved"), "left")
    lost = "_won.seq < seq"
    if fallen is not None:
        own = claims.filter("_fallen").groupBy("pending_id", "chain_id").agg(F.min("seq").alias("_own")).toDF("_own_p", "_own_chain", "_own")
        resolved = resolved.join(own, F.expr("_fallen and pending_id = _own_p and chain_id = _own_chain"), "left")
        lost = "_won.seq < seq or _own < seq"
    resolved = resolved.selectExpr(
        *[c for c in matched.columns if c not in ("error", "_fallen")],
        f"coalesce(error, case when {lost} then {lost_to('coalesce(_won.seq < seq and _won.expiry, false)')} end) as error",
    )
    return resolved.unionByName(plain.drop("_fallen"), allowMissingColumns=True)


def post(events: DataFrame, accounts: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """One row per transfer id: its first event, its ``error`` (NULL when applied).

    With ``earlier`` posted rows, ids that are already decided are left out.

    A chain falls with any of its legs, a post or void too. Whether such a leg
    fails may depend on whether an earlier chain fell, so chains with posts or
    voids are judged in rounds, until no verdict changes; the n-th round is right
    for every chain with fewer than n such chains before it that it depends on.
    """
    if earlier is None and events.filter(f"chain_id is not null and {RESOLVES}").isEmpty():
        # written once: the rules below look at these rows from several sides
        return two_phase(stage(_checked(events, accounts), "checked"))
    firsts = first_copies(events)
    if earlier is not None:
        firsts = firsts.join(earlier.select(F.col("id").alias("_e")), F.expr("id = _e"), "left_anti")
    checked = stage(account_errors(firsts, accounts, events), "checked")
    fallen = checked.filter("error is not null and chain_id is not null").select("chain_id").distinct()
    if checked.filter(f"chain_id is not null and {RESOLVES}").isEmpty():
        return two_phase(chain_errors(checked), earlier)
    fallen = stage(fallen, "fallen")
    while True:
        judged = two_phase(checked, earlier, fallen)
        now = stage(judged.filter("error is not null and chain_id is not null").select("chain_id").distinct(), "fallen")
        settled = now.join(fallen, "chain_id", "left_anti").isEmpty() and fallen.join(now, "chain_id", "left_anti").isEmpty()
        if settled:
            return chain_errors(judged)
        fallen = now


def outcomes(events: DataFrame, posted: DataFrame) -> DataFrame:
    """Outcome of every event: a repeated id gets the outcome of its first event."""
    verdict = posted.selectExpr("id as _id", "error")
    return events.join(verdict, F.expr("id = _id")).selectExpr(
        *events.columns, "if(error is null, 'ok', 'rejected') as status", "error"
    )


def legs(posted: DataFrame) -> DataFrame:
    """What every applied event does to its two accounts, as signed limb deltas."""
    pending = (
        f"case when (flags & {v.PENDING}) <> 0 then amount when {RESOLVES} then"
        f" named_struct('hi', -p_amount.hi, 'lo', -p_amount.lo) else {u128.ZERO} end"
    )
    booked = (
        f"case when (flags & {v.PENDING | v.VOID}) <> 0 then {u128.ZERO} else amount end"
    )
    wide = "struct<hi:decimal(22,0),lo:decimal(19,0)>"
    return (
        posted.filter("error is null")
        .selectExpr(
            "seq", "id", "coalesce(p_debit, debit_account_id) as debit",
            "coalesce(p_credit, credit_account_id) as credit",
            f"cast({pending} as {wide}) as pending", f"cast({booked} as {wide}) as booked",
        )
        .selectExpr(
            "seq", "id", "pending", "booked",
            "inline(array(named_struct('side', 'debit', 'account_id', debit),"
            " named_struct('side', 'credit', 'account_id', credit)))",
        )
    )


BUCKETS = {
    "debits_pending": ("debit", "pending"), "debits_posted": ("debit", "booked"),
    "credits_pending": ("credit", "pending"), "credits_posted": ("credit", "booked"),
}


def balances(account_legs: DataFrame) -> DataFrame:
    """The four balances of every account that moved, as limbs."""
    return account_legs.groupBy("account_id").agg(
        *[
            F.expr(u128.sum_limbs(what, f"side = '{side}'")).alias(name)
            for name, (side, what) in BUCKETS.items()
        ]
    )


def expired(posted: DataFrame, as_of: int, ticks_per_second: int) -> DataFrame:
    """Pending transfers that nothing resolved and whose time is up at ``as_of``, for an order whose ``seq`` is its clock.

    ``expiry.merge`` puts timers into the order before posting; this looks at posted rows at one moment.

    They get sequence numbers after ``as_of``, in order of expiry; as a release
    they look like a void of the pending transfer, under its own id.
    """
    from ledgerweave.operators.scan import number_rows

    resolved = posted.filter(f"error is null and {RESOLVES}").selectExpr("pending_id as _done")
    due = (
        posted.filter(f"error is null and (flags & {v.PENDING}) <> 0 and timeout_s > 0")
        .join(resolved, F.expr("id = _done"), "left_anti")
        .withColumn("expires_at", F.expr(f"seq + timeout_s * {ticks_per_second}"))
        .filter(f"expires_at <= {as_of}")
    )
    return number_rows(due, ["expires_at", "seq"], "_rank").withColumn(
        "expired_seq", F.expr(f"{as_of}L + _rank")
    ).drop("_rank")


def releases(due: DataFrame) -> DataFrame:
    """Expired pending transfers as events that release what was reserved."""
    return due.selectExpr(
        *[c for c in due.columns if c not in
          ("seq", "flags", "p_amount", "p_debit", "p_credit", "expired_seq", "expires_at")],
        "expired_seq as seq", f"{v.VOID} as flags", "amount as p_amount",
        "debit_account_id as p_debit", "credit_account_id as p_credit",
    )
