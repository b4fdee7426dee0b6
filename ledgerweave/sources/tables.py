"""The driver's tables as ledger inputs: registries, accounts, events, envelopes.

Orders and line items become typed transfer events, the event table becomes a
topic of JSON commands. Every mapping is plain arithmetic on the row, so that
an independent SQL engine can restate it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.operators.decode import DecodeOptions, Limits
from ledgerweave.operators.scan import number_rows
from ledgerweave.session import configure, spread, stage
from ledgerweave.sources.registry import CODE_SCHEMA, Registry

# Fixed values of the mapping.
CODES = {"returned": 1, "new": 2, "refused": 3}
TOPIC, UNROUTED = "ledger.commands", "ledger.unrouted"
LIMITS = Limits(max_bytes=4096, max_events=3, max_depth=32)
SEQ_BASE = 1_000_000_000_000
CUSTOMER, SUPPLIER, TRANSFER, RESOLVER, FUNDING, BANK = 1, 2, 3, 4, 5, 6

_staged: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """A derived table written once per application and read by many queries."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _staged:
        _staged[key] = stage(build(spark, sf_dir), label)
    return _staged[key]


def hex12(value: str) -> str:
    return f"lpad(lower(hex({value})), 12, '0')"


def object_id(namespace: int, b: str, a: str | None = None) -> str:
    """SQL text of the UUID of (namespace, a, b); ``a`` is zero when left out."""
    if a is None:
        return f"concat('{namespace:08x}-0000-0000-0000-', {hex12(b)})"
    high = hex12(a)
    return (
        f"concat('{namespace:08x}-', substr({high}, 1, 4), '-', substr({high}, 5, 4), '-',"
        f" substr({high}, 9, 4), '-', {hex12(b)})"
    )


def minor(money: str) -> str:
    """A two-decimal DOUBLE of the test tables as whole minor units, converted once."""
    return f"cast(round({money} * 100) as bigint)"


def money_text(units: str) -> str:
    return f"concat({units} div 100, '.', lpad(cast({units} % 100 as string), 2, '0'))"


# --- registry -----------------------------------------------------------------

def ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").selectExpr(
        "r_name as name", "cast(r_regionkey + 1 as bigint) as id",
        "case when r_regionkey < 3 then 2 when r_regionkey = 3 then 0 else 3 end as scale",
    )


def codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CODES.items()), CODE_SCHEMA)


def registry(spark: SparkSession, sf_dir: str) -> Registry:
    rows = ledgers(spark, sf_dir).collect()  # five regions: configuration, not data
    return Registry(tuple((r.name, r.id, r.scale) for r in rows), tuple(CODES.items()))


def decode_options(spark: SparkSession, sf_dir: str) -> DecodeOptions:
    return DecodeOptions(registry(spark, sf_dir), {TOPIC: "json"}, LIMITS)


# --- typed events from orders -------------------------------------------------

LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
]


LINE_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus"]


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_returnflag", "l_linestatus")
    return number_rows(lines, LINE_ORDER, keep=LINE_FIELDS)


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "customer")
        .join(load(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr("c_custkey", "n_regionkey as region", "c_mktsegment", "c_acctbal")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered line items with the customer and the place in their order, brought together once."""
    return staged(spark, sf_dir, "lines", _placed_lines)


def _placed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _numbered_lines(spark, sf_dir)
    bounds = numbered.groupBy("l_orderkey").agg(
        F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn")
    )
    placed = (
        load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(bounds, F.expr("o_orderkey = l_orderkey"))
        .join(customer_regions(spark, sf_dir), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "o_custkey", "region", "first_rn", "last_rn")
    )
    return numbered.join(placed, F.expr("l_orderkey = o_orderkey")).drop("o_orderkey")


EVENT_FIELDS = (
    "seq", "topic", "partition", "offset", "idx", "id", "debit_account_id", "credit_account_id",
    "pending_id", "amount", "ledger_id", "code", "flags", "timeout_s", "chain_id",
)


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transfer per line item; natural duplicate ids, pending lines, chained orders."""
    units = minor("l_extendedprice")
    return lines(spark, sf_dir).selectExpr(
        f"{SEQ_BASE} + 2 * rn as seq", f"'{TOPIC}' as topic",
        "cast(l_orderkey % 4 as int) as partition", "l_orderkey as offset",
        "cast(rn - first_rn as int) as idx",
        f"{object_id(TRANSFER, 'l_linenumber', 'l_orderkey')} as id",
        f"{object_id(CUSTOMER, 'o_custkey')} as debit_account_id",
        f"case when l_partkey % 50 = 0 then {object_id(CUSTOMER, 'o_custkey + 1')}"
        f" else {object_id(SUPPLIER, 'l_suppkey')} end as credit_account_id",
        "cast(null as string) as pending_id",
        f"{u128.from_long(units)} as amount",
        "cast(region + 1 as bigint) as ledger_id",
        "case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as code",
        "if(l_linestatus = 'O', 2, 0) + if(l_orderkey % 3 = 0 and rn < last_rn, 1, 0) as flags",
        "if(l_linestatus = 'O', 30L * l_linenumber, 0L) as timeout_s",
        "if(l_orderkey % 3 = 0, l_orderkey, null) as chain_id",
    )


def resolvers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and voids of pending lines: even line numbers post, the third is voided."""
    units = minor("l_extendedprice")
    return lines(spark, sf_dir).filter("l_linestatus = 'O' and (l_linenumber % 2 = 0 or l_linenumber = 3)").selectExpr(
        f"{SEQ_BASE} + 2 * rn + 1 as seq", f"'{TOPIC}' as topic",
        "cast(l_orderkey % 4 as int) as partition", "l_orderkey as offset",
        "cast(rn - first_rn as int) as idx",
        f"{object_id(RESOLVER, 'l_linenumber', 'l_orderkey')} as id",
        "cast(null as string) as debit_account_id", "cast(null as string) as credit_account_id",
        f"{object_id(TRANSFER, 'l_linenumber', 'l_orderkey')} as pending_id",
        f"{u128.from_long(units)} as amount",
        "cast(region + 1 as bigint) as ledger_id",
        "case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as code",
        "if(l_linenumber % 2 = 0, 4, 8) as flags", "0L as timeout_s", "cast(null as bigint) as chain_id",
    )


def fundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One opening transfer per customer, before everything else."""
    units = f"50000000 + {minor('c_acctbal')}"
    return customer_regions(spark, sf_dir).selectExpr(
        "c_custkey + 1 as seq", f"'{TOPIC}' as topic", "cast(c_custkey % 4 as int) as partition",
        "c_custkey - 1000000000000 as offset", "0 as idx",
        f"{object_id(FUNDING, 'c_custkey')} as id",
        f"{object_id(BANK, 'region')} as debit_account_id",
        f"{object_id(CUSTOMER, 'c_custkey')} as credit_account_id",
        "cast(null as string) as pending_id", f"{u128.from_long(f'({units})')} as amount",
        "cast(region + 1 as bigint) as ledger_id", "2 as code", "0 as flags", "0L as timeout_s",
        "cast(null as bigint) as chain_id",
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fundings(spark, sf_dir).unionByName(transfers(spark, sf_dir))
        .unionByName(resolvers(spark, sf_dir))
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of customers, suppliers and banks; some missing, some created late."""
    customers = customer_regions(spark, sf_dir).filter("c_custkey % 10 <> 3").selectExpr(
        f"{object_id(CUSTOMER, 'c_custkey')} as id", "cast(region + 1 as bigint) as ledger_id", "1 as code",
        "if(c_mktsegment = 'BUILDING', 2, 0) + if(c_custkey % 2 = 0, 8, 0) as flags",
        f"if(c_custkey % 7 = 5, {SEQ_BASE} + 80 * c_custkey, 0L) as created",
        "c_custkey as user_data_64",
    )
    suppliers = (
        load(spark, sf_dir, "supplier").filter("s_suppkey % 25 <> 7")
        .join(load(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .selectExpr(
            f"{object_id(SUPPLIER, 's_suppkey')} as id", "cast(n_regionkey + 1 as bigint) as ledger_id",
            "2 as code", "if(s_suppkey % 2 = 0, 8, 0) as flags", "0L as created", "0L as user_data_64",
        )
    )
    banks = load(spark, sf_dir, "region").selectExpr(
        f"{object_id(BANK, 'cast(r_regionkey as bigint)')} as id", "cast(r_regionkey + 1 as bigint) as ledger_id",
        "3 as code", "0 as flags", "0L as created", "0L as user_data_64",
    )
    return customers.unionByName(suppliers).unionByName(banks)


# --- a topic of JSON commands from the event table ------------------------------

def _transfer_json(ident: str, **changes: str) -> str:
    fields = {
        "id": ident, "debit_account_id": "debit", "credit_account_id": "credit", "amount": "amount",
        "ledger": "r_name", "code": "'new'", **changes,
    }
    parts = []
    for name, value in fields.items():
        if value is None:
            continue
        quote = "" if name in ("flags", "user_data_64") or name.startswith("!") else '"'
        parts.append(f"'\"{name.lstrip('!')}\":{quote}', {value}, '{quote}'")
    return "concat('{', " + ", ',', ".join(parts) + ", '}')"


def _transfers_json(*items: str) -> str:
    return (
        "concat('{\"operation\":\"create_transfers\",\"transfers\":[', "
        + ", ',', ".join(items) + ", ']}')"
    )


def _message() -> str:
    one, two = "ident", object_id(TRANSFER, "1", "event_id")
    plain = _transfer_json(one)
    garbage = [
        "'not json at all'",
        _transfers_json(_transfer_json(one, amont="amount")),
        _transfers_json(_transfer_json(one, amount="'12.3456'")),
        _transfers_json(_transfer_json("'no-identity'")),
        _transfers_json(_transfer_json(one, ledger="'ATLANTIS'")),
        _transfers_json(_transfer_json(one, code="'unlisted'")),
        _transfers_json(_transfer_json(one, flags="'[\"balancing_debt\"]'")),
        "'{\"operation\":\"create_transfers\",\"transfers\":[]}'",
        "'{\"operation\":\"rename_ledger\",\"transfers\":[]}'",
        f"concat('{{\"operation\":\"create_transfers\",\"transfers\":[', {plain},"
        " '],\"accounts\":[{\"id\":\"', debit, '\",\"ledger\":\"', r_name, '\",\"code\":\"new\"}]}')",
        _transfers_json(_transfer_json("'00000000-0000-0000-0000-000000000000'")),
        "concat('{\"operation\":\"create_transfers\",\"transfers\":[{\"code\":\"new\",\"id\":\"', ident)",
        _transfers_json(_transfer_json(one, pending_id=two)),
        _transfers_json(_transfer_json(one, flags="'[\"post_pending_transfer\"]'")),
        f"concat({_transfers_json(plain)}, repeat(' ', 5000))",
        "concat(repeat('[', 40), repeat(']', 40))",
        _transfers_json(plain, plain, plain, plain),
        _transfers_json(_transfer_json(one, amount="if(scale = 0, '1', '1.0')", timeout="'soon'")),
        _transfers_json(_transfer_json(one, flags="'[\"imported\"]'")),
        _transfers_json(_transfer_json(one, amount=None, **{"!amount": "'1.5'"})),
    ]
    broken = " ".join(f"when {i} then {g}" for i, g in enumerate(garbage))
    broken = broken.replace("'\"amount\":\"', '1.5', '\"'", "'\"amount\":', '1.5', ''")
    return (
        "case event_type"
        " when 'signup' then concat('{\"operation\":\"create_accounts\",\"accounts\":[{\"id\":\"', debit,"
        " '\",\"ledger\":\"', r_name, '\",\"code\":\"returned\",\"flags\":[', if(event_id % 2 = 0, '\"history\"', ''), ']}]}')"
        f" when 'purchase' then if(event_id % 10 = 1,"
        f" {_transfers_json(_transfer_json(one, flags=_LINKED), _transfer_json(two))},"
        f" {_transfers_json(_transfer_json(one, user_data_64='event_id'))})"
        f" when 'view' then {_transfers_json(_transfer_json(one, flags=_PENDING, timeout=_TIMEOUT))}"
        f" when 'click' then {_transfers_json(_transfer_json(one, debit_account_id=None, credit_account_id=None, pending_id=_EARLIER, flags=_POSTED))}"
        f" else case event_id % 20 {broken} end end"
    )


_LINKED = "'[\"linked\"]'"
_PENDING = "'[\"pending\"]'"
_POSTED = "'[\"post_pending_transfer\"]'"
_TIMEOUT = "concat(1 + event_id % 300, 's')"
_EARLIER = object_id(TRANSFER, "0", "event_id - 1")


def command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope records: one JSON command per row of the event table."""
    users = customer_regions(spark, sf_dir).join(
        load(spark, sf_dir, "region"), F.expr("region = r_regionkey")
    ).selectExpr("c_custkey", "r_name", "case when region < 3 then 2 when region = 3 then 0 else 3 end as scale")
    source = load(spark, sf_dir, "events")
    rows = source.join(users, F.expr("user_id = c_custkey")).select("event_id", "ts", "user_id", "event_type", "value", "r_name", "scale")
    return spread(rows, "event_id", source).selectExpr(
        "event_id", "ts", "user_id", "event_type", "r_name", "scale",
        f"{money_text(minor('value'))} as amount",
        f"{object_id(TRANSFER, '0', 'event_id')} as ident",
        f"{object_id(CUSTOMER, 'user_id')} as debit",
        f"{object_id(SUPPLIER, 'event_id % 100')} as credit",
    ).selectExpr(
        "cast(debit as binary) as key", f"cast({_message()} as binary) as value",
        f"if(event_id % 50 = 7, '{UNROUTED}', '{TOPIC}') as topic",
        "cast(user_id % 4 as int) as partition", "event_id as offset",
        "cast(ts as timestamp) as timestamp", "0 as timestampType",
        "cast(null as array<struct<key:string,value:binary>>) as headers",
    )
