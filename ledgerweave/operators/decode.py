"""Command records → typed, validated events, or poison with a reason.

The whole decode is one narrow pass: no join, no shuffle, no Python. Records
stay rows with an array of events until ``explode_events``, because the verdict
belongs to the record: one bad event poisons all of it.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import strict_json as sj
from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.sources.registry import Registry

CREATE_TRANSFERS, CREATE_ACCOUNTS = "create_transfers", "create_accounts"

# A codec turns the value column into COMMAND_TYPE; a non-NULL ``error`` is poison.
Codec = Callable[[Column], Column]
_CODECS: dict[str, Codec | None] = {"json": None}


def register_codec(name: str, codec: Codec) -> None:
    """Add a codec: any column expression or pandas UDF from BINARY to a command.

    It must report bad payloads in ``error`` rather than raise; see
    ``contained`` for a wrapper that guarantees that for Python functions.
    """
    _CODECS[name] = codec


def contained(decode_one: Callable[[bytes], dict]) -> Codec:
    """A Python function as a codec: whatever it raises becomes a panic poison."""

    @F.pandas_udf(sj.COMMAND_TYPE)
    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for value in values:
            row = {"error": None, "op": None, "transfers": None, "accounts": None}
            if value is not None:
                try:
                    row.update(decode_one(bytes(value)))
                except Exception as problem:  # noqa: BLE001 - poison, never a failed task
                    row["error"] = f"panic while decoding: {problem}"
            rows.append(row)
        return pd.DataFrame(rows, columns=["error", "op", "transfers", "accounts"])

    return run


@dataclass(frozen=True)
class Limits:
    max_bytes: int = 1 << 20
    max_events: int = 8189
    max_depth: int = 32


@dataclass(frozen=True)
class DecodeOptions:
    registry: Registry
    routes: dict[str, str] = field(default_factory=dict)  # topic -> codec
    limits: Limits = Limits()


def decode(records: DataFrame, options: DecodeOptions) -> DataFrame:
    """Add ``error, detail, op, events`` to envelope records.

    ``error`` is NULL for a usable record; otherwise it is the poison class and
    ``detail`` the first rule that failed. ``events`` is NULL for poison.
    """
    missing = set(options.routes.values()) - set(_CODECS)
    if missing:
        raise ValueError(f"no such codec: {sorted(missing)}")
    df = records.selectExpr("*", f"{_routed(options.routes)} as _codec")
    df = _json_commands(df, options.limits)
    for name in sorted(set(options.routes.values()) - {"json"}):
        df = _custom_commands(df, name)
    df = df.selectExpr("*", f"coalesce(_json_problem, {_shape_error(options.limits)}) as _problem")
    df = _checked_events(df, options.registry)
    kept = [f"`{c}`" for c in records.columns]
    df = df.selectExpr(
        *kept, "_codec", "_cmd", "_events",
        "case when _codec is null then concat('no decoder registered for topic \"', topic, '\"')"
        " else coalesce(_problem, get(filter(_events, e -> e.error is not null), 0).error) end as detail",
    )
    # A generator is a fence: a filter on the verdict stays above it, where pushing
    # it down would copy the whole rule set into the predicate.
    verdict = (
        "named_struct('error', case when detail is null then null when _codec is null"
        " then 'unknown_topic' else 'decode' end, 'detail', detail,"
        " 'op', case when detail is null then _cmd.operation end,"
        " 'events', case when detail is null then _events end)"
    )
    return df.selectExpr(*kept, f"inline_outer(array({verdict}))")


def _routed(routes: dict[str, str]) -> str:
    if not routes:
        return "cast(null as string)"
    cases = " ".join(f"when {v.text(t)} then {v.text(c)}" for t, c in routes.items())
    return f"case topic {cases} end"


# --- bytes → raw command ------------------------------------------------------

def _json_commands(df: DataFrame, limits: Limits) -> DataFrame:
    """Add ``_cmd`` and ``_json_problem`` for the records of the JSON codec."""
    size = "octet_length(value)"
    too_large = (
        f"case when _codec = 'json' and {size} > {limits.max_bytes}"
        f" then concat('message too large: ', {size}, ' bytes, limit {limits.max_bytes}') end"
    )
    df = df.selectExpr("*", f"{too_large} as _size_problem")
    df = df.selectExpr(
        "*",
        "case when _codec = 'json' and _size_problem is null"
        " then coalesce(cast(value as string), '') end as _text",
    )
    df = df.selectExpr("*", f"{sj.parse_document('_text')} as _doc")
    df = df.selectExpr("*", f"({sj.contract('_doc')} and {sj.single('_doc')}) as _contract")
    shallow = "true" if limits.max_depth < sj.CONTRACT_DEPTH else f"not _contract or {sj.doubtful('_text')}"
    df = df.selectExpr("*", f"case when {shallow} then {sj.outside_strings('_text')} end as _skeleton")
    df = df.selectExpr("*", f"case when _skeleton is not null then {sj.nesting('_skeleton')} end as _depth")
    broken = (
        f"case when not {sj.single('_doc')} then 'json: parse error'"
        f" else coalesce(concat('json: unknown field \"', {sj.unknown_field('_doc')}, '\"'),"
        f" 'json: value of the wrong type') end"
    )
    df = df.selectExpr(
        "*",
        f"coalesce(_size_problem, case when _text is null then null"
        f" when _depth.top > {limits.max_depth} then 'json nesting too deep: limit {limits.max_depth}'"
        f" when not _contract then {broken}"
        f" when _depth is not null then {sj.scan_error('_skeleton', '_depth')} end) as _doc_problem",
    )
    df = df.selectExpr(
        "*", f"case when _text is not null and _doc_problem is null then coalesce({sj.command('_doc')},"
        f" cast(named_struct('operation', '', 'transfers', null, 'accounts', null) as {sj.COMMAND})) end as _raw",
    )
    df = df.selectExpr(
        "*", f"coalesce(_doc_problem, case when {_out_of_range('_raw.transfers')} or"
        f" {_out_of_range('_raw.accounts')} then 'json: unsigned integer out of range' end) as _json_problem",
        "named_struct('operation', coalesce(_raw.operation, ''), 'transfers', _raw.transfers,"
        " 'accounts', _raw.accounts) as _json_cmd",
    )
    return df.withColumn("_cmd", F.expr("case when _raw is not null then _json_cmd end")).drop(
        "_size_problem", "_text", "_doc", "_contract", "_skeleton", "_depth", "_doc_problem", "_raw", "_json_cmd"
    )


def _out_of_range(items: str) -> str:
    """True when an integer of some element does not fit its unsigned type."""
    return (
        f"coalesce(exists({items}, e -> not (coalesce(e.user_data_64, 0BD) between 0BD and 18446744073709551615BD)"
        f" or not (coalesce(e.user_data_32, 0BD) between 0BD and 4294967295BD)), false)"
    )


def _custom_commands(df: DataFrame, name: str) -> DataFrame:
    """Run another codec over the records routed to it, and only over those."""
    mine = F.col("_codec") == name
    df = df.withColumn("_custom", _CODECS[name](F.when(mine, F.col("value"))))
    own = (
        f"case when _codec = {v.text(name)} then named_struct('operation', coalesce(_custom.op, ''),"
        f" 'transfers', _custom.transfers, 'accounts', _custom.accounts) else _cmd end"
    )
    problem = (
        f"case when _codec = {v.text(name)} then coalesce(_custom.error, case when {_out_of_range('_custom.transfers')}"
        f" or {_out_of_range('_custom.accounts')} then 'unsigned integer out of range' end)"
        f" else _json_problem end"
    )
    return df.withColumns({"_cmd": F.expr(own), "_json_problem": F.expr(problem)}).drop("_custom")


def _shape_error(limits: Limits) -> str:
    """Operation dispatch and the rules on the arrays."""
    def count_error(items: str, name: str) -> str:
        n = f"coalesce(array_size({items}), 0)"
        return (
            f"case when {n} = 0 then '{name}: empty' when {n} > {limits.max_events}"
            f" then concat('too many events: ', {n}, ', limit {limits.max_events}') end"
        )

    def dispatch(op: str, own: str, other: str) -> str:
        return (
            f"when _cmd.operation = '{op}' then case when array_size(_cmd.{other}) > 0"
            f" then 'operation {op} must not carry {other}' else {count_error('_cmd.' + own, own)} end"
        )

    return (
        f"case when _cmd is null then null {dispatch(CREATE_TRANSFERS, 'transfers', 'accounts')}"
        f" {dispatch(CREATE_ACCOUNTS, 'accounts', 'transfers')}"
        f" else concat('unknown operation \"', _cmd.operation, '\"') end"
    )


# --- raw command → events -----------------------------------------------------

_IDS = ("id", "debit_account_id", "credit_account_id", "pending_id", "user_data_128")
_TEXTS = ("amount", "ledger", "code", "timeout")


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def _prepared(registry: Registry, fields: dict[str, str]) -> str:
    """First pass over an element ``e``: defaults and lookups, each evaluated once."""
    out = {}
    for name in _IDS + _TEXTS:
        out[name + "_t"] = f"coalesce(e.{name}, '')" if name in fields else "''"
    for name in _IDS:
        out[name] = v.canonical_id(f"e.{name}") if name in fields else "cast(null as string)"
    out["ledger"] = f"try_element_at({registry.ledger_map()}, coalesce(e.ledger, ''))"
    out["code"] = f"try_element_at({registry.code_map()}, coalesce(e.code, ''))"
    out["names"] = (
        "case when e.flags is null then cast(array() as array<string>)"
        " else transform(e.flags, f -> coalesce(f, '')) end"
    )
    out["user_data_64"] = "try_cast(coalesce(e.user_data_64, 0BD) as decimal(20,0))"
    out["user_data_32"] = "try_cast(coalesce(e.user_data_32, 0BD) as bigint)"
    out["nanos"] = (
        f"case when e.timeout <> '' then {v.timeout_nanos('e.timeout')} end"
        if "timeout" in fields else "cast(null as decimal(38,0))"
    )
    return _struct(out)


def _optional_id(name: str) -> str:
    return f"case when x.{name}_t <> '' then {v.id_error(f'x.{name}_t', f'x.{name}')} end"


_REGISTRY_ERRORS = (
    "case when x.ledger is null then concat('unknown ledger \"', x.ledger_t, '\"') end,"
    " case when x.code is null then concat('unknown code \"', x.code_t, '\"') end"
)


def _transfer_error() -> str:
    """The first broken rule of a transfer, short of the amount's magnitude and what follows it."""
    resolves = (
        "size(x.names) > 0 and (array_contains(x.names, 'post_pending_transfer')"
        " or array_contains(x.names, 'void_pending_transfer'))"
    )
    pending = (
        f"case when {resolves} then coalesce("
        f"case when x.pending_id_t = '' then 'pending_id required for post/void' end,"
        f" {v.id_error('x.pending_id_t', 'x.pending_id')},"
        f" {_optional_id('debit_account_id')}, {_optional_id('credit_account_id')})"
        f" else coalesce("
        f"case when x.pending_id_t <> '' then 'pending_id only valid with post/void flags' end,"
        f" {v.id_error('x.debit_account_id_t', 'x.debit_account_id')},"
        f" {v.id_error('x.credit_account_id_t', 'x.credit_account_id')}) end"
    )
    return (
        f"coalesce({v.id_error('x.id_t', 'x.id')}, {v.flag_error('x.names', v.TRANSFER_FLAGS, 'transfer')},"
        f" {pending}, {_REGISTRY_ERRORS}, {v.amount_error('x.amount_t', 'x.ledger.scale')})"
    )


def _late_transfer_error() -> str:
    return (
        f"coalesce(y.problem, {v.overflow_error('x.amount_t', 'y.minor').replace('x.', 'y.x.')},"
        f" concat('user_data_128: ', {_optional_id('user_data_128').replace('x.', 'y.x.')}),"
        f" case when y.x.timeout_t <> '' then {v.timeout_error('y.x.timeout_t', 'y.x.nanos')} end)"
    )


def _account_error() -> str:
    """Error with its separator, since the last rule names its field in the path."""
    return (
        f"coalesce(concat(': ', coalesce({v.id_error('x.id_t', 'x.id')}, {_REGISTRY_ERRORS},"
        f" {v.flag_error('x.names', v.ACCOUNT_FLAGS, 'account')})),"
        f" concat('.user_data_128: ', {_optional_id('user_data_128')}))"
    )


def _event(x: str, size: str, table: list[str], error: str, amount: str) -> str:
    mask = v.flag_mask(f"{x}.names", table)
    return _struct({
        "error": error,
        "idx": "i",
        "id_text": f"{x}.id_t",
        **{n: f"{x}.{n}" for n in ("id", "debit_account_id", "credit_account_id", "pending_id")},
        "amount": amount,
        "ledger_id": f"{x}.ledger.id",
        "code": f"{x}.code",
        # a chain cannot stay open at the end of its command
        "flags": f"if(i = {size} - 1, ({mask}) & ~{v.LINKED}, {mask})",
        "user_data_128": f"{x}.user_data_128",
        "user_data_64": f"{x}.user_data_64",
        "user_data_32": f"{x}.user_data_32",
        "timeout_s": f"coalesce({v.timeout_seconds(f'{x}.nanos')}, 0L)",
    })


def _checked_events(df: DataFrame, registry: Registry) -> DataFrame:
    minor = (
        f"case when x.ledger is not null and p is null then"
        f" {v.amount_digits('x.amount_t', 'x.ledger.scale')} end"
    )
    df = df.selectExpr(
        "*",
        f"case when _problem is null and _cmd.operation = '{CREATE_TRANSFERS}' then"
        f" transform(_cmd.transfers, e -> {_prepared(registry, sj.TRANSFER_FIELDS)}) end as _t",
        f"case when _problem is null and _cmd.operation = '{CREATE_ACCOUNTS}' then"
        f" transform(_cmd.accounts, e -> {_prepared(registry, sj.ACCOUNT_FIELDS)}) end as _a",
    )
    df = df.selectExpr("*", f"transform(_t, x -> named_struct('x', x, 'problem', {_transfer_error()})) as _p")
    df = df.selectExpr(
        "*",
        "transform(_p, q -> named_struct('x', q.x, 'problem', q.problem, 'minor', "
        + minor.replace("p is null", "q.problem is null").replace("x.", "q.x.")
        + ")) as _q",
    )
    transfer_events = (
        f"transform(_q, (y, i) -> "
        + _event("y.x", "array_size(_q)", v.TRANSFER_FLAGS,
                 f"concat('transfers[', i, ']: ', {_late_transfer_error()})",
                 f"case when y.problem is null then {u128.limbs('y.minor')} end")
        + ")"
    )
    account_events = (
        f"transform(_a, (x, i) -> "
        + _event("x", "array_size(_a)", v.ACCOUNT_FLAGS,
                 f"concat('accounts[', i, ']', {_account_error()})", f"cast(null as {u128.LIMBS})")
        + ")"
    )
    return df.selectExpr("*", f"coalesce({transfer_events}, {account_events}) as _events")


def explode_events(decoded: DataFrame, *more: str) -> DataFrame:
    """One row per event of every usable record, the record's position (and columns ``more``) kept."""
    return (
        decoded.selectExpr("topic", "partition", "offset", "op", *more, "inline_outer(events)")
        .filter("idx is not null").drop("error")
    )
