"""Value contract over whole tables."""

from __future__ import annotations

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.plans import duck
from ledgerweave.sources import registry as reg
from ledgerweave.sources import tables as t

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("registry", f"""WITH {duck.LEDGERS}, {duck.CODES}
SELECT 'ledger' AS kind, name, id AS value, scale FROM ledgers
UNION ALL SELECT 'code', name, value, NULL FROM codes""")
def registry(spark, sf):
    return t.ledgers(spark, sf).selectExpr("'ledger' as kind", "name", "id as value", "scale").unionByName(
        t.codes(spark).selectExpr("'code' as kind", "name", "cast(value as bigint) as value", "cast(null as int) as scale"))


# a registry candidate per customer: names, ids and scales that break every rule now and then
@query("bad_ledgers", """WITH l AS (SELECT c_name AS name, c_custkey // 3 * (CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE c_custkey % 3 + 5 END) AS id,
 c_custkey % 20 - 1 AS scale FROM customer)
SELECT name, id, 'id must not be zero' AS problem FROM l WHERE id = 0
UNION ALL SELECT name, id, 'scale out of range' FROM l WHERE scale < 0 OR scale > 18
UNION ALL SELECT min(name), id, 'duplicate id' FROM l GROUP BY id HAVING count(*) > 1""")
def bad_ledgers(spark, sf):
    return reg.bad_ledgers(t.load(spark, sf, "customer").selectExpr(
        "c_name as name",
        "(c_custkey div 3) * (case when c_custkey % 3 = 2 then 1 else c_custkey % 3 + 5 end) as id",
        "cast(c_custkey % 20 - 1 as int) as scale"))


@query("bad_codes", """WITH c AS (SELECT p_name || p_partkey AS name, p_partkey * 7 % 1000 AS value FROM part)
SELECT name, value, 'value must not be zero' AS problem FROM c WHERE value = 0
UNION ALL SELECT min(name), value, 'duplicate value' FROM c GROUP BY value HAVING count(*) > 1""")
def bad_codes(spark, sf):
    return reg.bad_codes(t.load(spark, sf, "part").selectExpr(
        "concat(p_name, p_partkey) as name", "p_partkey * 7 % 1000 as value"))


_ID_FORMS = [
    ("good", "good"), ("upper(good)", "good"), ("concat('urn:uuid:', good)", "good"),
    ("concat('{', good, '}')", "good"), ("replace(good, '-', '')", "good"), ("substr(good, 1, 35)", None),
    (f"'{v.NIL_ID}'", None), ("concat(good, 'x')", None),
]


@query("parse_id", f"""WITH x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_partkey % 8 AS form,
 {duck.uid(3, 'l_linenumber', 'l_orderkey')} AS good FROM lineitem),
y AS (SELECT *, CASE form WHEN 5 THEN substr(good, 1, 35) WHEN 6 THEN '{v.NIL_ID}' WHEN 7 THEN good || 'x' END AS bad FROM x)
SELECT k, n, p, CASE WHEN form < 5 THEN good END AS id, CASE WHEN form = 6 THEN 'id must not be zero'
 WHEN form > 4 THEN 'parse id "' || bad || '": invalid UUID' END AS error FROM y""")
def parse_id(spark, sf):
    forms = " ".join(f"when {i} then {f}" for i, (f, _) in enumerate(_ID_FORMS))
    return (
        t.load(spark, sf, "lineitem")
        .selectExpr("l_orderkey as k", "l_linenumber as n", "l_partkey as p",
                    f"{t.object_id(3, 'l_linenumber', 'l_orderkey')} as good")
        .selectExpr("k", "n", "p", f"case p % 8 {forms} end as raw")
        .selectExpr("k", "n", "p", "raw", f"{v.canonical_id('raw')} as cid")
        .selectExpr("k", "n", "p", "cid", f"{v.id_error('raw', 'cid')} as error")
        .selectExpr("k", "n", "p", "if(error is null, cid, null) as id", "error")
    )


# the price text followed by up to 36 zeros, at scales 0..19: all rules, all magnitudes
@query("parse_amount", """WITH x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, (l_orderkey % 20)::INT AS scale,
 CAST(round(l_extendedprice * 100) AS BIGINT) AS m, (l_partkey % 37)::INT AS z, (l_suppkey % 10)::INT AS form FROM lineitem),
y AS (SELECT *, CASE form WHEN 0 THEN '' WHEN 1 THEN (m // 100)::VARCHAR || '.' WHEN 2 THEN '-' || m::VARCHAR WHEN 3 THEN m::VARCHAR || '.0.1'
  WHEN 4 THEN '.' || m::VARCHAR WHEN 5 THEN m::VARCHAR || 'e2' WHEN 6 THEN repeat('0', 40) || m::VARCHAR
  WHEN 7 THEN (m // 100)::VARCHAR || '.' || lpad((m % 100)::VARCHAR, 2, '0') ELSE m::VARCHAR || repeat('0', z) END AS s FROM x),
w AS (SELECT *, CASE WHEN scale > 18 THEN 'amount "' || s || '": unsupported scale ' || scale WHEN form = 0 THEN 'amount: empty'
  WHEN form IN (1, 4) THEN 'amount "' || s || '": malformed' WHEN form IN (2, 3, 5) THEN 'amount "' || s || '": only digits and one dot allowed'
  WHEN form = 7 AND scale < 2 THEN 'amount "' || s || '": has 2 decimals, scale is ' || scale END AS e0,
  CASE WHEN form = 7 THEN m::VARCHAR || repeat('0', scale - 2) ELSE m::VARCHAR || repeat('0', CASE WHEN form = 6 THEN 0 ELSE z END + scale) END AS d FROM y)
SELECT k, n, p, coalesce(e0, CASE WHEN try_cast(d AS UHUGEINT) IS NULL THEN 'amount "' || s || '": exceeds uint128' END) AS error,
 CASE WHEN e0 IS NULL THEN try_cast(d AS UHUGEINT)::VARCHAR END AS minor FROM w""")
def parse_amount(spark, sf):
    return (
        t.load(spark, sf, "lineitem")
        .selectExpr("l_orderkey as k", "l_linenumber as n", "l_partkey as p", "cast(l_orderkey % 20 as int) as scale",
                    f"{t.minor('l_extendedprice')} as m", "cast(l_partkey % 37 as int) as z", "l_suppkey % 10 as form")
        .selectExpr("k", "n", "p", "scale",
                    f"case form when 0 then '' when 1 then concat(m div 100, '.') when 2 then concat('-', m)"
                    f" when 3 then concat(m, '.0.1') when 4 then concat('.', m) when 5 then concat(m, 'e2')"
                    f" when 6 then concat(repeat('0', 40), m) when 7 then {t.money_text('m')}"
                    f" else concat(m, repeat('0', z)) end as s")
        .selectExpr("*", f"{v.amount_error('s', 'scale')} as shape")
        .selectExpr("*", f"case when shape is null then {v.amount_digits('s', 'scale')} end as d")
        .selectExpr("k", "n", "p", "d", f"coalesce(shape, {v.overflow_error('s', 'd')}) as error")
        .selectExpr("k", "n", "p", "error", f"case when error is null then {u128.limbs('d')} end as amount")
        .selectExpr("k", "n", "p", "error", f"{u128.digits('amount')} as minor")
    )


@query("format_amount", f"""WITH x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, (l_partkey % 19)::INT AS scale,
 CAST(round(l_extendedprice * 100) AS BIGINT)::HUGEINT * (CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 1000000000000000000 END)::HUGEINT + l_suppkey AS m FROM lineitem)
SELECT k, n, p, {duck.fmt('m', 'scale')} AS amount FROM x""")
def format_amount(spark, sf):
    big = ("case when l_suppkey % 2 = 0 then cast({m} + l_suppkey as string)"
           " else concat({m}, lpad(cast(l_suppkey as string), 18, '0')) end").format(m=t.minor("l_extendedprice"))
    return (
        t.load(spark, sf, "lineitem")
        .selectExpr("l_orderkey as k", "l_linenumber as n", "l_partkey as p", "cast(l_partkey % 19 as int) as scale",
                    f"{big} as d")
        .selectExpr("k", "n", "p", "scale", f"{u128.limbs('d')} as a")
        .selectExpr("k", "n", "p", f"{v.format_amount('a', 'scale')} as amount")
    )


@query("parse_timeout", """WITH x AS (SELECT event_id AS k, event_id % 11 AS form, event_id AS n, user_id AS u FROM events),
y AS (SELECT *, CASE form WHEN 0 THEN n || 's' WHEN 1 THEN n || 'm' || u || 's' WHEN 2 THEN n || 'h' WHEN 3 THEN n || 'ms' WHEN 4 THEN '-' || n || 's'
 WHEN 5 THEN n::VARCHAR WHEN 6 THEN n || '.5m' WHEN 7 THEN n || 'h' || u || 'm0.25s'
 WHEN 9 THEN '0.000277777777777' || repeat('7', (n % 40)::INT) || CASE WHEN n % 2 = 0 THEN '8h' ELSE '7h' END WHEN 10 THEN '1.' || repeat('0', (n % 30)::INT) || '5s' ELSE n || ' s' END AS s,
 CASE form WHEN 0 THEN n * 1000 WHEN 1 THEN n * 60000 + u * 1000 WHEN 2 THEN n * 3600000 WHEN 3 THEN n WHEN 4 THEN -n * 1000
  WHEN 5 THEN CASE WHEN n = 0 THEN 0 END WHEN 6 THEN n * 60000 + 30000 WHEN 7 THEN n * 3600000 + u * 60000 + 250
  WHEN 9 THEN CASE WHEN n % 2 = 0 THEN 1000 ELSE 999 END WHEN 10 THEN 1000 + CASE WHEN n % 30 = 0 THEN 500 ELSE 0 END END AS ms FROM x),
z AS (SELECT *, CASE WHEN ms IS NULL OR ms > 9223372036854 THEN 'time: invalid duration "' || s || '"' WHEN ms <= 0 THEN 'must be positive'
 WHEN ms < 1000 OR ms > 4294967295999 THEN 'out of range for uint32 seconds' END AS e FROM y)
SELECT k, CASE WHEN e IS NULL THEN ms // 1000 END AS seconds, CASE WHEN e IS NOT NULL THEN 'timeout "' || s || '": ' || e END AS error FROM z""")
def parse_timeout(spark, sf):
    return (
        t.load(spark, sf, "events").selectExpr(
            "event_id as k",
            "case event_id % 11 when 0 then concat(event_id, 's') when 1 then concat(event_id, 'm', user_id, 's')"
            " when 2 then concat(event_id, 'h') when 3 then concat(event_id, 'ms') when 4 then concat('-', event_id, 's')"
            " when 5 then cast(event_id as string) when 6 then concat(event_id, '.5m')"
            " when 7 then concat(event_id, 'h', user_id, 'm0.25s')"
            " when 9 then concat('0.000277777777777', repeat('7', cast(event_id % 40 as int)), if(event_id % 2 = 0, '8h', '7h'))"
            " when 10 then concat('1.', repeat('0', cast(event_id % 30 as int)), '5s') else concat(event_id, ' s') end as s")
        .selectExpr("k", "s", f"{v.timeout_nanos('s')} as nanos")
        .selectExpr("k", "nanos", f"{v.timeout_error('s', 'nanos')} as error")
        .selectExpr("k", f"case when error is null then {v.timeout_seconds('nanos')} end as seconds", "error")
    )


@query("format_timeout", """SELECT event_id AS k, CASE WHEN s = 0 THEN NULL WHEN s >= 3600 THEN (s // 3600) || 'h' || (s % 3600 // 60) || 'm' || (s % 60) || 's'
 WHEN s >= 60 THEN (s // 60) || 'm' || (s % 60) || 's' ELSE s || 's' END AS timeout
FROM (SELECT event_id, event_id * 7 % 10007 AS s FROM events)""")
def format_timeout(spark, sf):
    return t.load(spark, sf, "events").selectExpr("event_id as k", "event_id * 7 % 10007 as s").selectExpr(
        "k", f"{v.format_timeout('s')} as timeout")


def _flag_query(table: list[str], kind: str):
    pool = table + ["balancing_debt"]
    picks = ", ".join(f"if((bits & {1 << i}) <> 0, '{n}', null)" for i, n in enumerate(pool))

    def run(spark, sf):
        return (
            t.load(spark, sf, "events")
            .selectExpr("event_id as k", f"cast(if(event_id % 3 = 0, event_id, event_id & {_writable(table)}) % {1 << len(pool)} as int) as bits")
            .selectExpr("k", f"array_compact(array({picks})) as names")
            .selectExpr("k", f"{v.flag_error('names', table, kind)} as problem", f"{v.flag_mask('names', table)} as m")
            .selectExpr("k", "if(problem is null, m, null) as mask", "problem")
        )

    read_only = 1 << table.index("imported")
    unknown = 1 << len(table)
    oracle = f"""WITH x AS (SELECT event_id AS k, ((CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id & {_writable(table)} END) % {1 << len(pool)})::INT AS bits FROM events)
SELECT k, CASE WHEN bits & {read_only | unknown} = 0 THEN bits END AS mask,
 CASE WHEN bits & {read_only} <> 0 THEN '{kind} flag "imported" is read-only in this connector: {v.READ_ONLY_REASON}'
  WHEN bits & {unknown} <> 0 THEN 'unknown {kind} flag "balancing_debt"' END AS problem FROM x"""
    return run, oracle


def _writable(table: list[str]) -> int:
    return sum(1 << i for i, n in enumerate(table) if n != "imported")


for _name, _table, _kind in (("transfer_flags", v.TRANSFER_FLAGS, "transfer"), ("account_flags", v.ACCOUNT_FLAGS, "account")):
    QUERIES[_name], ORACLES[_name] = _flag_query(_table, _kind)


def _names_sql(table: list[str], mask: str) -> str:
    parts = ", ".join(
        f"CASE WHEN ({mask}) & {1 << b} <> 0 THEN '{table[b] if b < len(table) else f'bit_{b}'}' END" for b in range(16))
    return f"concat_ws(',', {parts})"


@query("flag_names", f"""SELECT event_id AS k, {_names_sql(v.TRANSFER_FLAGS, 'event_id * 7919 % 65536')} AS transfer_flags,
 {_names_sql(v.ACCOUNT_FLAGS, 'event_id * 7919 % 65536')} AS account_flags FROM events""")
def flag_names(spark, sf):
    return t.load(spark, sf, "events").selectExpr("event_id as k", "cast(event_id * 7919 % 65536 as int) as m").selectExpr(
        "k", f"array_join({v.flag_names('m', v.TRANSFER_FLAGS)}, ',') as transfer_flags",
        f"array_join({v.flag_names('m', v.ACCOUNT_FLAGS)}, ',') as account_flags")


_STATUSES = [  # fixed values: raw status, type prefix, expected name
    ("TransferCreated", "Transfer", "created"), ("TransferExists", "Transfer", "exists"),
    ("TransferExceedsCredits", "Transfer", "exceeds_credits"), ("AccountIDMustNotBeZero", "Account", "id_must_not_be_zero"),
    ("TransferLinkedEventFailed", "Transfer", "linked_event_failed"),
    ("CreateTransferStatus(1)", "Transfer", "unknown_status_CreateTransferStatus(1)"), ("AccountCreated", "Account", "created"),
]
_RAW = " ".join(f"when {i} then '{r}'" for i, (r, _, _) in enumerate(_STATUSES))
_ACCOUNT_ROWS = ", ".join(str(i) for i, (_, p, _) in enumerate(_STATUSES) if p == "Account")


@query("status_name", "SELECT event_id AS k, CASE event_id % 7 "
       + " ".join(f"WHEN {i} THEN '{w}'" for i, (_, _, w) in enumerate(_STATUSES)) + " END AS status FROM events")
def status_name(spark, sf):
    return t.load(spark, sf, "events").selectExpr("event_id as k", "event_id % 7 as f", f"case event_id % 7 {_RAW} end as raw").selectExpr(
        "k", f"case when f in ({_ACCOUNT_ROWS}) then {v.status_name('raw', 'Account')} else {v.status_name('raw', 'Transfer')} end as status")


@query("outcome_class", """SELECT CASE WHEN event_id % 7 IN (0, 1, 6) THEN 'ok' ELSE 'rejected' END AS class, count(*) AS n
FROM events GROUP BY 1""")
def outcome_class(spark, sf):
    return t.load(spark, sf, "events").selectExpr(f"case event_id % 7 {_RAW} end as raw").selectExpr(
        f"{v.status_class('raw')} as class").groupBy("class").count().withColumnRenamed("count", "n")


@query("event_type_name", """SELECT event_id AS k, CASE event_id % 7 WHEN 0 THEN 'single_phase' WHEN 1 THEN 'two_phase_pending' WHEN 2 THEN 'two_phase_posted'
 WHEN 3 THEN 'two_phase_voided' WHEN 4 THEN 'two_phase_expired' ELSE (event_id % 7)::VARCHAR END AS type FROM events""")
def event_type_name(spark, sf):
    return t.load(spark, sf, "events").selectExpr("event_id as k", "event_id % 7 as c").selectExpr(
        "k", f"{v.event_type_name('c')} as type")


@query("rfc3339", """SELECT event_id AS k, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z' AS at FROM events""")
def rfc3339(spark, sf):
    return t.load(spark, sf, "events").selectExpr("event_id as k", f"{v.rfc3339('ts')} as at")


@query("checkpoint_parse", """WITH x AS (SELECT event_id AS k, CASE event_id % 6 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN '-' || event_id WHEN 2 THEN ''
 WHEN 3 THEN event_id || '00000000000000000' WHEN 4 THEN repeat('0', 30) || event_id ELSE 'at ' || event_id END AS s FROM events)
SELECT k, CASE WHEN regexp_full_match(s, '[0-9]+') AND try_cast(s AS HUGEINT) <= 18446744073709551615 THEN try_cast(s AS HUGEINT)::VARCHAR END AS checkpoint FROM x""")
def checkpoint_parse(spark, sf):
    return t.load(spark, sf, "events").selectExpr(
        "event_id as k",
        "case event_id % 6 when 0 then cast(event_id as string) when 1 then concat('-', event_id) when 2 then ''"
        " when 3 then concat(event_id, '00000000000000000') when 4 then concat(repeat('0', 30), event_id)"
        " else concat('at ', event_id) end as s").selectExpr("k", f"cast({v.parse_checkpoint('s')} as string) as checkpoint")
