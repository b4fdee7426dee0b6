"""Lookups by name, by id and by attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ledger_by_name(names: DataFrame, ledgers: DataFrame) -> DataFrame:
    """Add ``ledger_id, scale, error``; a name that is not registered is an error, never a guess."""
    known = ledgers.selectExpr("name as _n", "id as ledger_id", "scale")
    return names.join(known, F.expr("ledger = _n"), "left").selectExpr(
        *names.columns, "ledger_id", "scale",
        "case when _n is null then concat('unknown ledger \"', ledger, '\"') end as error",
    )


def code_by_name(names: DataFrame, codes: DataFrame) -> DataFrame:
    known = codes.selectExpr("name as _n", "value as code_value")
    return names.join(known, F.expr("code = _n"), "left").selectExpr(
        *names.columns, "code_value",
        "case when _n is null then concat('unknown code \"', code, '\"') end as error",
    )


def by_ids(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """The objects with the wanted ids; ids without an object are simply absent."""
    return objects.join(wanted.select("id").distinct(), "id", "left_semi")


def account_transfers(transfers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every transfer that touches a wanted account on either side, once per account and side."""
    sides = transfers.selectExpr(
        "*", "inline(array(named_struct('side', 'debit', 'account_id', debit_account_id),"
        " named_struct('side', 'credit', 'account_id', credit_account_id)))"
    )
    accounts = wanted.select(F.col("id").alias("account_id")).distinct()
    return sides.join(accounts, "account_id", "left_semi")


def query(objects: DataFrame, limit: int | None = None, newest_first: bool = False, **equals) -> DataFrame:
    """Objects whose columns equal the given values; ``since``/``until`` bound ``seq``."""
    since, until = equals.pop("since", None), equals.pop("until", None)
    out = objects
    for name, value in equals.items():
        out = out.filter(F.col(name) == value)
    if since is not None:
        out = out.filter(F.col("seq") >= since)
    if until is not None:
        out = out.filter(F.col("seq") <= until)
    if limit is not None:
        out = out.orderBy(F.desc("seq") if newest_first else F.asc("seq")).limit(limit)
    return out
