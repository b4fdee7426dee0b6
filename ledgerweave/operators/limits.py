"""Posting with spending limits, linked chains and two-phase transfers together.

A limit makes every verdict depend on the verdicts before it. Instead of
replaying a ledger, rounds bracket the room an account has before each event: at
worst, if of the undecided events only those that shrink it apply, at best, if
only those that widen it do. The touches of an account are cut into buckets of
bounded size along their order. Prefix sums over bucket totals give the bracket a
bucket starts with; inside the bucket it is carried from chain to chain, and a
chain whose verdict hangs on this account alone settles at once and narrows it for
the next. A hot account is as many tasks as it has buckets, and its first open
bucket, which starts with an exact room, is decided whole in every round.

What is decided leaves the working set: accepted effects are folded into the room
each remaining touch carries, and the verdicts on pending transfers and on their
claims into the rows that wait for them. Every round writes what is left, which
becomes less, and decides at least the first undecided chain, so the result is
exactly that of a replay in ``seq`` order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.operators import posting
from ledgerweave.operators.scan import number_rows, running_sums
from ledgerweave.session import stage

UNDECIDED, ACCEPTED, REJECTED = 0, 1, 2
#: Touches of one account that one task carries through in order; a chain is never cut.
BUCKET = 1 << 14
_WIDE = "struct<hi:decimal(22,0),lo:decimal(19,0)>"
_SUM = "decimal(32,0)"
_CAPPED = f"(flags & {v.DEBITS_CAPPED | v.CREDITS_CAPPED}) <> 0"


def settle(
    events: DataFrame, accounts: DataFrame, earlier: DataFrame | None = None, opening: DataFrame | None = None,
    bucket: int = BUCKET, on_round: Callable[[int], None] | None = None,
) -> DataFrame:
    """One row per transfer id with its ``error``, limits included.

    ``earlier`` holds rows a previous call returned, for a stream posted in
    batches: ids decided there are left out, pending transfers there can be
    resolved. ``opening`` holds the balances (``account_id`` and the four limb
    columns) those rows led to. Events of a chain count at the place of its first
    one. An account with both limit flags does not exist:
    no ledger creates it. ``on_round`` is told how many events a round left.
    """
    accounts = accounts.filter(f"not ({posting.BOTH_CAPS})")
    firsts = stage(_prepared(events, accounts, earlier), "limits-firsts")
    rows = firsts.select(*_ROW)
    legs = stage(_placed(_legs(firsts, opening, accounts), bucket), "limits-legs")
    verdicts, placed, still = [], None, 0
    while True:
        judged = stage(_judged(rows, legs), "limits-round")
        verdicts.append(judged.filter("done").select("seq", "error"))
        left, moved = judged.filter("not done").agg(F.count("*"), F.count(F.expr("if(status <> _was, 1, null)"))).first()
        still = 0 if moved or judged.filter("done").select("seq").head(1) else still + 1
        if still > 2:
            raise RuntimeError(f"{left} events wait for each other")  # an order in which an event hangs on a later one
        if on_round:
            on_round(left)
        if not left:
            break
        rows, legs = stage(_remaining(judged), "limits-rows"), _folded(legs, judged)
        if placed is None or left * 2 < placed:  # buckets that have emptied are filled up again
            placed, legs = left, _placed(legs.drop("place"), bucket)
        legs = stage(legs, "limits-legs")
    known = reduce(DataFrame.unionByName, verdicts)
    return firsts.join(known, "seq").selectExpr(
        *["seq0 as seq" if c == "seq" else f"`{c}`" for c in events.columns], "p_amount", "p_debit", "p_credit", "error")


# --- preparation ----------------------------------------------------------------

#: What a round needs of an event.
_ROW = ["seq", "id", "chain_key", "chain_size", "flags", "pending_id", "e1", "status", "p_chain", "p_state", "taken"]


def _prepared(events: DataFrame, accounts: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """First copies with their static errors, their pending transfer and their limited accounts."""
    firsts = posting.first_copies(events)
    if earlier is not None:
        firsts = firsts.join(earlier.select(F.col("id").alias("_e")), F.expr("id = _e"), "left_anti")
    checked = posting.account_errors(firsts, accounts, events).withColumnRenamed("error", "e1").withColumn(
        "chain_key", F.expr("coalesce(chain_id, -seq)"))
    # a chain stands whole at the place of its first event, whatever lies between its events
    start = events.agg(F.min("seq")).first()[0] or 0
    begins = F.min("seq").over(Window.partitionBy("chain_key"))
    # places are found on narrow rows, so that the events themselves move once, by ``seq``
    ranks = number_rows(firsts.selectExpr("seq", "coalesce(chain_id, -seq) as chain_key").withColumn("_first", begins), ["_first", "seq"], "_rank", ["seq"])
    if _unique(accounts, "id") and _unique(ranks, "seq"):
        placed = stage(checked.join(ranks.withColumnRenamed("seq", "_s"), F.expr("seq = _s")).drop("_s"), "limits-placed")
    else:  # rows that share a place each have their own number
        placed = number_rows(checked.withColumn("_first", begins), ["_first", "seq"], "_rank").drop("_first")
    checked = placed.withColumn("seq0", F.col("seq")).withColumn("seq", F.expr(f"{start - 1}L + _rank")).drop("_rank")
    target = ["id as _p", "seq as _p_seq", "flags as _p_flags", "amount as p_amount",
              "debit_account_id as p_debit", "credit_account_id as p_credit"]
    targets = checked.filter(f"not ({posting.RESOLVES})").selectExpr(
        *target, "chain_key as p_chain", f"if(e1 is null, {UNDECIDED}, {REJECTED}) as p_state")
    claimed = None
    if earlier is not None:
        targets = targets.unionByName(earlier.filter(f"error is null and not ({posting.RESOLVES})").selectExpr(
            *target, "cast(null as bigint) as p_chain", f"{ACCEPTED} as p_state"))
        claimed = _claims(earlier.filter(f"error is null and {posting.RESOLVES}"))
    plain = checked.filter(f"not ({posting.RESOLVES})").selectExpr(
        "*", f"cast(null as {u128.LIMBS}) as p_amount", "cast(null as string) as p_debit", "cast(null as string) as p_credit",
        "cast(null as bigint) as p_chain", "cast(null as int) as p_state")
    resolving = checked.filter(posting.RESOLVES).join(
        targets, F.expr("pending_id = _p and _p_seq < seq"), "left"
    ).selectExpr(
        *[c for c in checked.columns if c != "e1"],
        "coalesce(e1, case when _p is null then 'pending_transfer_not_found'"
        f" when (_p_flags & {v.PENDING}) = 0 then 'pending_transfer_not_pending'"
        f" when (flags & {v.POST}) <> 0 and amount > p_amount then 'exceeds_pending_transfer_amount' end) as e1",
        "p_amount", "p_debit", "p_credit", "p_chain", "p_state",
    )
    out = plain.unionByName(resolving)
    # a chain that resolves one pending transfer twice fails at the second leg
    again = Window.partitionBy("chain_key", "pending_id").orderBy("seq")
    out = out.withColumn("_nth", F.row_number().over(again)).withColumn("e1", F.expr(
        f"coalesce(e1, case when {posting.RESOLVES} and _nth > 1 then 'pending_transfer_already_resolved' end)"
    )).withColumn("chain_size", F.count("*").over(Window.partitionBy("chain_key"))).drop("_nth")
    limited = accounts.filter(_CAPPED).selectExpr("id as _a", f"if((flags & {v.DEBITS_CAPPED}) <> 0, 'd', 'c') as cap")
    for side in ("debit", "credit"):
        known = limited.selectExpr("_a as _id", f"cap as {side}_cap")
        out = out.join(known, F.expr(f"coalesce(p_{side}, {side}_account_id) = _id"), "left").drop("_id")
    if claimed is None:
        out = out.withColumn("taken", F.lit(None).cast("struct<seq:bigint,expiry:boolean>"))
    else:
        out = out.join(claimed, F.expr("pending_id = _r"), "left").drop("_r")
    return out.withColumn("status", F.lit(UNDECIDED))


def _unique(rows: DataFrame, key: str) -> bool:
    return rows.groupBy(key).count().filter("count > 1").isEmpty()


def _claims(rows: DataFrame) -> DataFrame:
    """The first claim of each pending transfer, and whether it was an expiry."""
    return rows.groupBy("pending_id").agg(F.min(F.expr(f"named_struct('seq', seq, 'expiry', {posting.EXPIRY})")).alias("taken")).withColumnRenamed("pending_id", "_r")


def _opening_rooms(opening: DataFrame, accounts: DataFrame) -> DataFrame:
    """Room of limited accounts before the first event."""
    limited = accounts.filter(_CAPPED).selectExpr("id as account_id", f"(flags & {v.DEBITS_CAPPED}) <> 0 as d")

    def room(part: str) -> str:
        return (
            f"if(d, credits_posted.{part} - debits_posted.{part} - debits_pending.{part},"
            f" debits_posted.{part} - credits_posted.{part} - credits_pending.{part})"
        )

    return opening.join(limited, "account_id").selectExpr(
        "account_id as _o", f"{room('hi')} as o_hi", f"{room('lo')} as o_lo")


def _limb(sign: str, amount: str) -> str:
    return f"cast(named_struct('hi', {sign}{amount}.hi, 'lo', {sign}{amount}.lo) as {_WIDE})"


def _minus(a: str, b: str) -> str:
    return f"cast(named_struct('hi', {a}.hi - {b}.hi, 'lo', {a}.lo - {b}.lo) as {_WIDE})"


def _effect(limited_side: bool) -> str:
    """What an event does to the room of an account limited on this side, or on the other one."""
    zero = f"cast({u128.ZERO} as {_WIDE})"
    if limited_side:
        return (
            f"case when (flags & {v.POST}) <> 0 then {_minus('p_amount', 'amount')}"
            f" when (flags & {v.VOID}) <> 0 then {_limb('', 'p_amount')} else {_limb('-', 'amount')} end"
        )
    return f"case when (flags & {v.PENDING | v.VOID}) <> 0 then {zero} else {_limb('', 'amount')} end"


def _legs(firsts: DataFrame, opening: DataFrame | None, accounts: DataFrame) -> DataFrame:
    """Every touch of a limited account: its effect on the room, whether it is checked, and the room without this call's events.

    ``sole``: the verdict on the whole chain hangs on checks of this account alone. ``sure``: it hangs on none.
    """
    def leg(side: str, own: str) -> str:
        return (
            f"named_struct('account', coalesce(p_{side}, {side}_account_id), 'cap', {side}_cap,"
            f" 'effect', case when {side}_cap = '{own}' then {_effect(True)} else {_effect(False)} end,"
            f" 'checked', {side}_cap = '{own}' and not ({posting.RESOLVES}), 'name', '{side}')"
        )

    chain = Window.partitionBy("chain_key")
    looked = (f"if({posting.RESOLVES}, array(), array_compact(array(if(debit_cap = 'd', debit_account_id, null),"
              f" if(credit_cap = 'c', credit_account_id, null))))")
    marked = firsts.withColumn("_checked", F.size(F.array_distinct(F.flatten(F.collect_list(F.expr(looked)).over(chain))))).withColumn(
        "_bad", F.max(F.expr("e1 is not null")).over(chain)).withColumn("_phased", F.max(F.expr(posting.RESOLVES)).over(chain))
    legs = marked.filter("debit_cap is not null or credit_cap is not null").selectExpr(
        "seq", "chain_key", f"if(_bad, {REJECTED}, {UNDECIDED}) as status", "amount", "not _phased and _checked = 1 as sole", "not _phased and _checked = 0 as sure",
        f"inline(array({leg('debit', 'd')}, {leg('credit', 'c')}))"
    ).filter("cap is not null").selectExpr(
        "account", "seq", "chain_key", "status", "name", "checked", "sole", "sure", "effect.hi as e_hi", "effect.lo as e_lo",
        "amount.hi as a_hi", "amount.lo as a_lo")
    if opening is None:
        return legs.selectExpr("*", f"cast(0 as {_SUM}) as r_hi", f"cast(0 as {_SUM}) as r_lo")
    return legs.join(_opening_rooms(opening, accounts), F.expr("account = _o"), "left").selectExpr(
        *legs.columns, *[f"cast(coalesce(o_{p}, 0BD) as {_SUM}) as r_{p}" for p in ("hi", "lo")])


def _placed(legs: DataFrame, bucket: int) -> DataFrame:
    """Add ``place``: buckets along each account's order; a chain lies in the bucket of its first touch."""
    ranked = number_rows(legs, ["account", "seq", "name"], "_rank")
    first = F.min("_rank").over(Window.partitionBy("account", "chain_key"))
    return ranked.withColumn("place", F.floor(first / bucket)).drop("_rank")


# --- one round --------------------------------------------------------------------

def _sides(part: str) -> tuple[str, str]:
    """What a touch counts at worst and at best before it is looked at more closely."""
    negative = f"(e_hi + {u128.floor_div('e_lo')} < 0)"
    return tuple(
        f"case when status = {REJECTED} then 0BD when sure or {test} then e_{part} else 0BD end"
        for test in (negative, f"not {negative}"))


def _carried(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Carry the bracket along sorted touches, chain by chain; one row (seq, name, passed, failed) per check."""
    import pandas as pd

    base, here, chain_here = 10 ** 18, None, None
    low = high = applied = 0
    kind = passes = fails = None

    def end_of_chain() -> tuple[int, int]:
        """What the chain adds to the bracket: its legs apply together or not at all.

        Without a check on this account (``passes`` is None) its verdict is found elsewhere.
        """
        if kind == "rejected" or kind == "sole" and fails:
            return 0, 0
        if kind == "sure" or kind == "sole" and passes:
            return applied, applied
        return min(applied, 0), max(applied, 0)

    for pdf in batches:
        checks = []
        for account, b, seq, chain, status, name, checked, sole, sure, e_hi, e_lo, a_hi, a_lo, r_hi, r_lo, l_hi, l_lo, h_hi, h_lo in zip(
                *[pdf[c] for c in _CARRIED], strict=True):
            fresh = (account, b) != here
            if fresh or chain != chain_here:
                worst, best = end_of_chain()
                low, high = low + worst, high + best
                chain_here, applied, passes, fails = chain, 0, None, False
                kind = "rejected" if status == 2 else "sure" if sure else "sole" if sole else "open"
            if fresh:
                here, low, high = (account, b), int(l_hi) * base + int(l_lo), int(h_hi) * base + int(h_lo)
            if checked:
                # inside its own chain an event sees the legs before it as applied, whatever becomes of the chain
                spare = int(r_hi) * base + int(r_lo) - int(a_hi) * base - int(a_lo) + applied
                passed, failed = spare + low >= 0, spare + high < 0
                passes, fails = passed and passes is not False, fails or failed
                checks.append((seq, name, passed, failed))
            applied += int(e_hi) * base + int(e_lo)
        yield pd.DataFrame(checks, columns=["seq", "name", "passed", "failed"])


_CARRIED = ["account", "place", "seq", "chain_key", "status", "name", "checked", "sole", "sure", "e_hi", "e_lo", "a_hi", "a_lo", "r_hi", "r_lo",
            "low_hi", "low_lo", "high_hi", "high_lo"]


def _checks(legs: DataFrame) -> DataFrame:
    """(seq, enough, over, unsure) of every event with a check: certainly room, or which limit is certainly exceeded.

    The debit side is checked first: while its check is open, a failing credit side is not yet the reason.
    """
    ends = {f"{end}_{p}": side for p in ("hi", "lo") for end, side in zip(("low", "high"), _sides(p), strict=True)}
    totals = legs.groupBy("account", "place").agg(*[F.expr(f"sum({e})").alias(n) for n, e in ends.items()])
    before = Window.partitionBy("account").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("account", "place", *[F.coalesce(F.sum(n).over(before), F.lit(0)).cast("decimal(38,0)").alias(n) for n in ends])
    # a number along every bucket keeps each whole and in order in one task; a mere repartition may give way to the join's own layout
    along = Window.partitionBy("account", "place").orderBy("seq", "name")
    carried = legs.join(starts, ["account", "place"]).withColumn("nth", F.row_number().over(along)).select(*_CARRIED, "nth")
    checks = carried.mapInPandas(_shipped(_carried), "seq bigint, name string, passed boolean, failed boolean")
    return checks.groupBy("seq").agg(
        F.expr("bool_and(passed)").alias("enough"),
        F.expr("min(case when failed then if(name = 'debit', 'exceeds_credits', 'exceeds_debits') end)").alias("over"),
        F.expr("bool_or(name = 'debit' and not passed and not failed)").alias("unsure"))


def _shipped(function):
    """A function of this module for workers that need not have this package."""
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return function


def _judged(rows: DataFrame, legs: DataFrame) -> DataFrame:
    """The rows with their new ``status``, and for those that are ``done`` the ``error``."""
    checks = _checks(legs).withColumnRenamed("seq", "_c")
    base = rows.join(checks, F.expr("seq = _c"), "left")
    resolving = base.filter(posting.RESOLVES)
    open_ = rows.filter(f"{posting.RESOLVES} and e1 is null and status = {UNDECIDED}").groupBy("pending_id").agg(
        F.min("seq").alias("_open")).withColumnRenamed("pending_id", "_r")
    resolving = resolving.join(open_, F.expr("pending_id = _r"), "left")
    both = resolving.unionByName(base.filter(f"not ({posting.RESOLVES})"), allowMissingColumns=True)
    judged = both.selectExpr(
        *rows.columns,
        f"e1 is null and coalesce(enough, true) and (not ({posting.RESOLVES}) or"
        f" ((p_state = {ACCEPTED} or coalesce(p_chain = chain_key, false)) and coalesce(_open, seq) >= seq and coalesce(taken.seq, seq) >= seq)) as passes",
        f"case when p_state = {REJECTED} and coalesce(p_chain <> chain_key, true) then 'pending_transfer_not_found' else coalesce(e1, over,"
        f" case when taken.seq < seq then {posting.lost_to('taken.expiry')} end) end as fails",
        # whether the pending transfer stands may still change why a post or void fails
        f"if({posting.RESOLVES}, coalesce(p_state <> {UNDECIDED} or p_chain = chain_key, true), not coalesce(unsure and e1 is null, false)) as named",
    )
    chain = judged.groupBy("chain_key").agg(
        F.expr("bool_and(passes)").alias("_all"), F.expr("bool_or(fails is not null)").alias("_any"),
        F.expr("min(case when not passes then struct(seq, if(named, fails, null) as why) end)").alias("_first"))
    # a chain that certainly fails moves nothing from now on; which leg failed first may show only later
    return judged.join(chain, "chain_key").selectExpr(
        *[c for c in rows.columns if c != "status"], "status as _was",
        f"case when status <> {UNDECIDED} then status when _any then {REJECTED} when _all then {ACCEPTED} else {UNDECIDED} end as status",
        "_first.seq as _bad", "_first.why as _why",
    ).selectExpr(
        "*", f"status = {ACCEPTED} or (status = {REJECTED} and _why is not null) as done",
        f"case when status = {ACCEPTED} then null when seq = _bad then _why else 'linked_event_failed' end as error",
    )


def _remaining(judged: DataFrame) -> DataFrame:
    """Rows for the next round; what they wait for is written into them."""
    news = judged.filter(f"status <> {UNDECIDED} and _was = {UNDECIDED}")
    states = news.filter(f"not ({posting.RESOLVES})").selectExpr("id as _q", "status as _state")
    claims = _claims(news.filter(f"{posting.RESOLVES} and status = {ACCEPTED}")).withColumnRenamed("taken", "_taken")
    left = judged.filter("not done")
    waiting = left.filter(posting.RESOLVES).join(states, F.expr("pending_id = _q"), "left").join(
        claims, F.expr("pending_id = _r"), "left").selectExpr(
        *[c for c in _ROW if c not in ("p_state", "taken")], "coalesce(_state, p_state) as p_state", "least(taken, _taken) as taken")
    return left.filter(f"not ({posting.RESOLVES})").select(*_ROW).unionByName(waiting)


def _folded(legs: DataFrame, judged: DataFrame) -> DataFrame:
    """The touches of the remaining events, the accepted effects before them in their room."""
    verdict = judged.selectExpr("seq as _s", "status as _now", "done")
    known = legs.drop("status").join(verdict, F.expr("seq = _s")).drop("_s")
    sums = {f"_f_{p}": f"case when done and _now = {ACCEPTED} then e_{p} else 0BD end" for p in ("hi", "lo")}
    # an event that touches an account twice is one place in its order
    folded = running_sums(known.withColumn("_at", F.struct("seq", "name")), ["account"], "_at", sums, bucket="place")
    return folded.filter("not done").selectExpr(
        *[c for c in legs.columns if c not in ("status", "r_hi", "r_lo")], "_now as status",
        *[f"cast(r_{p} + _f_{p} as {_SUM}) as r_{p}" for p in ("hi", "lo")])
