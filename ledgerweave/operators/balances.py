"""Balances as of every event, and the change events that carry them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.operators import posting
from ledgerweave.operators.scan import running_sums

NAMES = list(posting.BUCKETS)


def running_balances(account_legs: DataFrame, opening: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame:
    """Every leg with its account's four balances once the event is applied.

    A two-level prefix sum: a hot account is spread over buckets of ``seq``.
    ``opening`` holds the balances of accounts before the first leg. Columns of
    ``account_legs`` beyond those of ``posting.legs`` ride along, and those of
    ``facts``, at most one row per ``account_id``.
    """
    scanned, shown = _scanned(account_legs, opening, facts)
    more = [c for c in account_legs.columns if c not in ("seq", "id", "side", "account_id", "pending", "booked")]
    more += [c for c in facts.columns if c != "account_id"] if facts is not None else []
    return scanned.selectExpr("seq", "id", "side", "account_id", *[f"{shown(f'_{n}')} as {n}" for n in NAMES], *more)


def _scanned(account_legs: DataFrame, opening: DataFrame | None, facts: DataFrame | None):
    """The legs with their running sums in ``_<balance>`` columns, and what makes limbs of such a column.

    Sums that fit are plain longs (8 bytes each, added natively), others are limbs already carried.
    """
    if opening is None and _fits_long(account_legs):
        sums = {f"_{n}": f"if(side = '{side}', cast({what}.lo as bigint), 0L)" for n, (side, what) in posting.BUCKETS.items()}
        return running_sums(account_legs, ["account_id"], "seq", sums, facts=facts), _limbs_of
    sums = {}
    for name, (side, what) in posting.BUCKETS.items():
        for part in ("hi", "lo"):
            sums[f"_{name}_{part}"] = f"if(side = '{side}', {what}.{part}, 0BD)"
    scanned = running_sums(account_legs, ["account_id"], "seq", sums, facts=facts)
    start = {n: "" for n in sums}
    if opening is not None:
        before = opening.selectExpr("account_id as _o", *[f"{n} as _open_{n}" for n in NAMES])
        scanned = scanned.join(before, F.expr("account_id = _o"), "left")
        start = {f"_{n}_{part}": f" + coalesce(_open_{n}.{part}, 0BD)" for n in NAMES for part in ("hi", "lo")}
    scanned = scanned.selectExpr("*", *[f"cast({n}{more} as decimal(37,0)) as _s{n}" for n, more in start.items()])
    return scanned.withColumns({f"_{n}": F.expr(u128.carry(f"_s_{n}_hi", f"_s_{n}_lo")) for n in NAMES}), lambda column: column


def _limbs_of(total: str) -> str:
    """SQL text of a BIGINT sum as limbs."""
    small = u128.make("cast(0 as decimal(38,0))", f"cast({total} as decimal(18,0))")
    return f"if({total} between 0 and 999999999999999999, {small}, {u128.carry('0BD', total)})"


def _fits_long(account_legs: DataFrame) -> bool:
    """Whether no sum of these legs can leave 64 bits: none has a high limb or is missing, and all of them at the largest amount still fit."""
    parts = [f"{what}.{part}" for what in ("pending", "booked") for part in ("hi", "lo")]
    n, *found = account_legs.agg(
        F.count("*"), *[F.count(p) for p in parts], *[F.expr(f"max(abs({p}))") for p in parts]).first()
    if not n:
        return False
    known, (p_hi, p_lo, b_hi, b_lo) = found[:4], [x or 0 for x in found[4:]]
    return all(k == n for k in known) and p_hi == b_hi == 0 and n * int(max(p_lo, b_lo)) < 1 << 63


def closing_balances(account_legs: DataFrame, opening: DataFrame) -> DataFrame:
    """New balances of the accounts that moved: the opening ones and the sum of the legs."""
    start = [f"named_struct('hi', cast({n}.hi as decimal(22,0)), 'lo', cast({n}.lo as decimal(19,0))) as {n}" for n in NAMES]
    none = "cast(null as struct<hi:decimal(22,0),lo:decimal(19,0)>)"
    moved = account_legs.selectExpr("account_id", *[
        f"if(side = '{side}', {what}, {none}) as {n}" for n, (side, what) in posting.BUCKETS.items()])
    touched = opening.join(account_legs.select("account_id").distinct(), "account_id", "left_semi").selectExpr("account_id", *start)
    return moved.unionByName(touched).groupBy("account_id").agg(*[F.expr(u128.sum_limbs(n)).alias(n) for n in NAMES])


def change_events(
    posted: DataFrame, accounts: DataFrame, due: DataFrame | None = None, opening: DataFrame | None = None,
) -> DataFrame:
    """One event per applied transfer (and per expiry), both accounts as of the event.

    ``opening``: the accounts' balances before these rows, for a ledger that is
    posted in batches.
    """
    kind = (
        f"case when {posting.EXPIRY} then 4 when (flags & {v.PENDING}) <> 0 then 1 when (flags & {v.POST}) <> 0 then 2"
        f" when (flags & {v.VOID}) <> 0 then 3 else 0 end"
    )
    applied = posted.filter("error is null").withColumn("type", F.expr(kind))
    shown = applied
    if due is not None:
        gone = posting.releases(due).withColumn("error", F.lit(None).cast("string"))
        applied = applied.unionByName(gone.withColumn("type", F.lit(4)))
        again = due.drop("expires_at").withColumn("type", F.lit(4)).withColumn(
            "p_amount", F.col("amount")).drop("seq").withColumnRenamed("expired_seq", "seq")
        shown = shown.unionByName(again, allowMissingColumns=True)
    about = accounts.select(
        F.col("id").alias("account_id"), F.struct(
            F.expr("cast(coalesce(user_data_64, 0) as decimal(20,0))" if "user_data_64" in accounts.columns else "0BD").alias("user_data_64"),
            "code", "flags", "created").alias("about"))
    # what is known of an account rides along with its legs, which are brought together once an event
    legs = posting.legs(applied)
    if not about.groupBy("account_id").count().filter("count > 1").isEmpty():  # an id that repeats multiplies its legs
        legs, about = legs.join(about, "account_id", "left"), None
    scanned, balance = _scanned(legs, opening, about)
    # both legs of an event meet as they are: nothing of them could be merged before they move
    both = scanned.select("seq", "side", "account_id", *[f"_{n}" for n in NAMES], "about").repartition("seq").groupBy("seq").agg(*[
        F.max(F.when(F.col("side") == side, F.struct("account_id", *[f"_{n}" for n in NAMES], "about"))).alias(side)
        for side in ("debit", "credit")
    ])
    rows = shown.join(both.withColumnRenamed("seq", "_seq"), F.expr("seq = _seq"))

    def column(name: str) -> str:
        return name if name in posted.columns else "cast(null as string)"

    sides = []
    for side in ("debit", "credit"):
        sides += [
            f"{side}.account_id as {side}_account_id",
            *[f"{balance(f'{side}._{n}')} as {side}_account_{n}" for n in NAMES],
            f"cast(null as string) as {side}_account_user_data_128",
            f"cast(coalesce({side}.about.user_data_64, 0) as decimal(20,0)) as {side}_account_user_data_64",
            f"0L as {side}_account_user_data_32",
            f"coalesce({side}.about.code, 0) as {side}_account_code",
            f"coalesce({side}.about.flags, 0) as {side}_account_flags",
            f"coalesce({side}.about.created, 0L) as {side}_account_timestamp",
        ]
    released = f"if({posting.EXPIRY}, pending_id, id)"
    return rows.selectExpr(
        "type", "seq as timestamp", "ledger_id as ledger", f"{released} as transfer_id",
        "amount as transfer_amount", f"if({posting.EXPIRY}, null, pending_id) as transfer_pending_id",
        f"{column('user_data_128')} as transfer_user_data_128",
        f"cast({'user_data_64' if 'user_data_64' in posted.columns else '0'} as decimal(20,0)) as transfer_user_data_64",
        f"cast({'user_data_32' if 'user_data_32' in posted.columns else '0'} as bigint) as transfer_user_data_32",
        "timeout_s as transfer_timeout", "code as transfer_code", "flags as transfer_flags",
        "seq as transfer_timestamp", *sides,
    )
