"""Decoding, dead letters, results and counters over a topic of commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.functions import strict_json as sj
from ledgerweave.functions import uint128 as u128
from ledgerweave.operators import batches, emit, lookups, metrics, posting
from ledgerweave.operators import decode as dec
from ledgerweave.plans import duck, inputs
from ledgerweave.schemas import header
from ledgerweave.sources import kafka
from ledgerweave.sources import tables as t

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


# --- poison, one query per rule -------------------------------------------------

def _poison(name: str, predicate: str, duck_predicate: str):
    def run(spark, sf):
        return inputs.decoded(spark, sf).filter(f"error is not null and ({predicate})").selectExpr(
            "topic", "partition", "offset", "error", "detail")

    QUERIES[name] = run
    ORACLES[name] = (
        f"WITH {duck.CMD} SELECT topic, partition, e AS \"offset\", error, detail FROM cmd"
        f" WHERE error IS NOT NULL AND ({duck_predicate})"
    )


_FORM = "topic <> 'ledger.unrouted' AND et = 'error' AND form"
_poison("unknown_topic", "error = 'unknown_topic'", "topic = 'ledger.unrouted'")
_poison("poison_size", "detail like 'message too large%'", f"{_FORM} = 14")
_poison("poison_depth", "detail like 'json nesting%'", f"{_FORM} = 15")
_poison("poison_json", "detail like 'json: %'", f"{_FORM} IN (0, 1, 11, 19)")
_poison("poison_operation", "detail like 'unknown operation%'", f"{_FORM} = 8")
_poison("poison_mixed", "detail like 'operation % must not carry %'", f"{_FORM} = 9")
_poison("poison_cardinality", "detail like '%: empty' and detail not like 'transfers[%' or detail like 'too many events%'",
        f"{_FORM} IN (7, 16)")
_poison("poison_ids", "detail like '%parse id%' or detail like '%must not be zero'", f"{_FORM} IN (3, 10)")
_poison("poison_registry", "detail like '%unknown ledger%' or detail like '%unknown code%'", f"{_FORM} IN (4, 5)")
_poison("poison_flags", "detail like '%transfer flag%'", f"{_FORM} IN (6, 18)")
_poison("poison_pending", "detail like '%pending_id %'", f"{_FORM} IN (12, 13)")
_poison("poison_amount", "detail like '%: amount %'",
        "topic <> 'ledger.unrouted' AND (et IN ('purchase', 'view', 'click') OR (et = 'error' AND form = 2))")
_poison("poison_timeout", "detail like '%: timeout %'", f"{_FORM} = 17")


@query("poison_by_error", f"WITH {duck.CMD} SELECT error, count(*) AS n FROM cmd WHERE error IS NOT NULL GROUP BY 1")
def poison_by_error(spark, sf):
    return inputs.decoded(spark, sf).filter("error is not null").groupBy("error").agg(F.count("*").alias("n"))


# documents quoted into nested brackets: the scan has to ignore what is inside strings
@query("json_depth", r"""SELECT doc_id, (doc_id % 40 + 1)::INT AS depth FROM documents""")
def json_depth(spark, sf):
    quoted = r"""concat('"', replace(replace(text, '\\', '\\\\'), '"', '\\"'), '"')"""
    return (
        t.load(spark, sf, "documents")
        .selectExpr("doc_id", f"concat(repeat('[', int(doc_id % 40 + 1)), {quoted}, repeat(']', int(doc_id % 40 + 1))) as s")
        .selectExpr("doc_id", f"{sj.outside_strings('s')} as k")
        .selectExpr("doc_id", f"{sj.nesting('k')} as d").selectExpr("doc_id", "d.top as depth")
    )


# --- usable commands --------------------------------------------------------------

@query("command_scan", f"""WITH {duck.CMD}
SELECT topic, partition, count(*) AS n, min(e) AS first_offset, max(e) AS last_offset FROM cmd WHERE topic = 'ledger.commands' GROUP BY ALL""")
def command_scan(spark, sf):
    log = t.staged(spark, sf, "log", t.command_log)
    source = kafka.topics(log, ["ledger.commands"])
    return source.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


_EVENT_COLUMNS = """topic, partition, e AS "offset", idx, op, id, debit AS debit_account_id, credit AS credit_account_id, pending_id,
 amt::VARCHAR AS minor, ledger AS ledger_id, code, flags, ud64::VARCHAR AS user_data_64, timeout_s"""


@query("events_exploded", f"WITH {duck.CMD_EVENTS} SELECT {_EVENT_COLUMNS} FROM ce")
def events_exploded(spark, sf):
    return dec.explode_events(inputs.decoded(spark, sf)).selectExpr(
        "topic", "partition", "offset", "idx", "op", "id", "debit_account_id", "credit_account_id", "pending_id",
        f"{u128.digits('amount')} as minor", "ledger_id", "code", "flags", "cast(user_data_64 as string) as user_data_64",
        "timeout_s")


@query("linked_cleared", f"""WITH {duck.CMD_EVENTS} SELECT topic, partition, e AS "offset", n AS events, 0 AS linked_last, n - 1 AS linked
FROM ce WHERE idx = 0""")
def linked_cleared(spark, sf):
    return inputs.decoded(spark, sf).filter("error is null").selectExpr(
        "topic", "partition", "offset", "size(events) as events", "element_at(events, -1).flags & 1 as linked_last",
        "size(filter(events, e -> (e.flags & 1) = 1)) as linked")


@query("chains", f"""WITH {duck.CMD_EVENTS} SELECT e * 4 + idx AS seq, id, CASE WHEN n = 2 THEN e * 4 END AS chain_id FROM ce""")
def chains(spark, sf):
    return inputs.command_events(spark, sf).select("seq", "id", "chain_id")


@query("partition_order", f"""WITH {duck.CMD_EVENTS} SELECT topic, partition, e AS "offset", idx, id FROM ce""")
def partition_order(spark, sf):
    from ledgerweave.operators.progress import partition_order as ordered
    return ordered(inputs.command_events(spark, sf), "offset", "idx").select("topic", "partition", "offset", "idx", "id")


@query("ledger_lookup", f"""WITH {duck.LEDGERS}, x AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 6 THEN lower(r_name) ELSE r_name END AS ledger
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT k, ledger, id AS ledger_id, scale, CASE WHEN id IS NULL THEN 'unknown ledger "' || ledger || '"' END AS error FROM x LEFT JOIN ledgers ON name = ledger""")
def ledger_lookup(spark, sf):
    names = (
        t.load(spark, sf, "orders").join(t.customer_regions(spark, sf), F.expr("o_custkey = c_custkey"))
        .join(t.load(spark, sf, "region"), F.expr("region = r_regionkey"))
        .selectExpr("o_orderkey as k", "if(o_orderkey % 7 = 6, lower(r_name), r_name) as ledger"))
    return lookups.ledger_by_name(names, t.ledgers(spark, sf))


@query("code_lookup", f"""WITH {duck.CODES}, x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p,
 CASE WHEN l_partkey % 11 = 0 THEN 'unlisted' WHEN l_returnflag = 'A' THEN 'returned' WHEN l_returnflag = 'N' THEN 'new' ELSE 'refused' END AS code FROM lineitem)
SELECT k, n, p, code, value AS code_value, CASE WHEN value IS NULL THEN 'unknown code "' || code || '"' END AS error FROM x LEFT JOIN codes ON name = code""")
def code_lookup(spark, sf):
    names = t.load(spark, sf, "lineitem").selectExpr(
        "l_orderkey as k", "l_linenumber as n", "l_partkey as p",
        "case when l_partkey % 11 = 0 then 'unlisted' when l_returnflag = 'A' then 'returned'"
        " when l_returnflag = 'N' then 'new' else 'refused' end as code")
    return lookups.code_by_name(names, t.codes(spark))


# --- outcomes, dead letters, results, counters -------------------------------------

@query("command_outcomes", f"""WITH {duck.CMD_OUTCOMES} SELECT topic, partition, e AS "offset", idx, id,
 CASE WHEN error IS NULL THEN 'ok' ELSE 'rejected' END AS status, error FROM oc""")
def command_outcomes(spark, sf):
    return inputs.command_outcomes(spark, sf).select("topic", "partition", "offset", "idx", "id", "status", "error")


_ATTEMPT = "timestamp'2024-06-01 00:00:00'"


def _letters(spark, sf):
    decoded = inputs.decoded(spark, sf)
    return emit.dead_letters(decoded, inputs.command_outcomes(spark, sf), "ledger.dlq", _ATTEMPT)


@query("dlq_records", f"""WITH {duck.CMD_OUTCOMES},
dl AS (SELECT 'poison' AS reason, error, detail, topic, partition, e, -1 AS idx, ts, debit AS key FROM cmd WHERE error IS NOT NULL
 UNION ALL SELECT 'reject', o.error, 'event ' || o.idx || ' (id ' || o.id || '): ' || o.error, o.topic, o.partition, o.e, o.idx, o.ts, {duck.uid(1, 'o.u')}
 FROM oc o WHERE o.error IS NOT NULL)
SELECT key, reason, error, detail, topic AS src_topic, partition::VARCHAR AS src_partition, e::VARCHAR AS src_offset, idx,
 regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z' AS src_timestamp, '2024-06-01T00:00:00Z' AS attempt_ts, 8 AS n_headers FROM dl""")
def dlq_records(spark, sf):
    h = [(n, header("headers", emit.PREFIX + n)) for n in (
        "reason", "error", "detail", "src-topic", "src-partition", "src-offset", "src-timestamp", "attempt-ts")]
    return emit.in_source_order(_letters(spark, sf)).selectExpr(
        "cast(key as string) as key", "idx", "size(headers) as n_headers",
        *[f"{e} as {n.replace('-', '_')}" for n, e in h])


@query("dlq_replay", f"""WITH {duck.CMD_OUTCOMES}
SELECT topic, partition, e AS src_offset, true AS byte_identical, count(*) AS n FROM (
 SELECT topic, partition, e FROM cmd WHERE error IS NOT NULL UNION ALL SELECT topic, partition, e FROM oc WHERE error IS NOT NULL) GROUP BY ALL""")
def dlq_replay(spark, sf):
    replayed = emit.replay(_letters(spark, sf)).selectExpr("topic", "partition", "src_offset", "key as k2", "value as v2")
    source = inputs.decoded(spark, sf).selectExpr("topic", "partition", "offset as src_offset", "key", "value")
    return replayed.join(source, ["topic", "partition", "src_offset"]).selectExpr(
        "topic", "partition", "src_offset", "k2 = key and v2 = value as byte_identical").groupBy(
        "topic", "partition", "src_offset", "byte_identical").agg(F.count("*").alias("n"))


@query("results_messages", f"""WITH {duck.CMD_OUTCOMES},
r AS (SELECT topic, partition, e, string_agg('{{"index":' || idx || ',"id":"' || id || '","status":"' || CASE WHEN error IS NULL THEN 'ok"' ELSE 'rejected","error":"' || error || '"' END || '}}', ',' ORDER BY idx) AS items, min(u) AS u
 FROM oc GROUP BY ALL)
SELECT {duck.uid(1, 'u')} AS key, 'ledger.results' AS topic, '{{"source":{{"topic":"' || topic || '","partition":' || partition || ',"offset":' || e || '}},"results":[' || items || '],"emitted_at":"2024-06-01T00:00:00Z"}}' AS value
FROM (SELECT topic, partition, e, string_agg(items, '') AS items, min(u) AS u FROM r GROUP BY topic, partition, e)""")
def results_messages(spark, sf):
    return emit.results(
        inputs.decoded(spark, sf), inputs.command_outcomes(spark, sf), "ledger.results", _ATTEMPT
    ).selectExpr("cast(key as string) as key", "cast(value as string) as value", "topic")


@query("records_total", f"""WITH {duck.CMD_OUTCOMES}
SELECT 'poison' AS result, count(*) AS n FROM cmd WHERE error IS NOT NULL
UNION ALL SELECT result, count(*) FROM (SELECT CASE WHEN count(error) > 0 THEN 'rejected' ELSE 'ok' END AS result FROM oc GROUP BY e) GROUP BY 1""")
def records_total(spark, sf):
    return metrics.records_total(inputs.decoded(spark, sf), inputs.command_outcomes(spark, sf))


@query("events_total", f"""WITH {duck.CMD_OUTCOMES} SELECT CASE WHEN error IS NULL THEN 'ok' ELSE 'rejected' END AS status, count(*) AS n FROM oc GROUP BY 1""")
def events_total(spark, sf):
    return metrics.events_total(inputs.command_outcomes(spark, sf))


@query("dlq_total", f"""WITH {duck.CMD_OUTCOMES} SELECT 'poison' AS reason, error, count(*) AS n FROM cmd WHERE error IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'reject', error, count(*) FROM oc WHERE error IS NOT NULL GROUP BY ALL""")
def dlq_total(spark, sf):
    return metrics.dlq_total(inputs.decoded(spark, sf), inputs.command_outcomes(spark, sf))


# --- runs, batches, alignment --------------------------------------------------------

def _commands(spark, sf):
    return inputs.decoded(spark, sf).filter("error is null").selectExpr(
        "topic", "partition", "offset", "op", "size(events) as n_events")


@query("op_runs", f"""WITH {duck.CMD_EVENTS}, x AS (SELECT DISTINCT topic, partition, e, op FROM ce),
y AS (SELECT *, CASE WHEN lag(op) OVER w IS DISTINCT FROM op THEN 1 ELSE 0 END AS s FROM x WINDOW w AS (PARTITION BY topic, partition ORDER BY e))
SELECT topic, partition, e AS "offset", op, sum(s) OVER (PARTITION BY topic, partition ORDER BY e)::BIGINT AS run FROM y""")
def op_runs(spark, sf):
    return batches.op_runs(_commands(spark, sf)).select("topic", "partition", "offset", "op", "run")


@query("command_batches", f"""WITH RECURSIVE {duck.CMD_EVENTS}, x AS (SELECT topic, partition, e, op, count(*) AS n FROM ce GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY e) AS i FROM x WHERE n <= 8),
w AS (SELECT topic, partition, i, e, op, n, n AS filled, 0::BIGINT AS batch FROM o WHERE i = 1
 UNION ALL SELECT o.topic, o.partition, o.i, o.e, o.op, o.n,
  CASE WHEN o.op = w.op AND w.filled + o.n <= 8 THEN w.filled + o.n ELSE o.n END,
  CASE WHEN o.op = w.op AND w.filled + o.n <= 8 THEN w.batch ELSE w.batch + 1 END
 FROM w JOIN o ON o.topic = w.topic AND o.partition = w.partition AND o.i = w.i + 1)
SELECT topic, partition, e AS "offset", op, n::INT AS n_events, batch, NULL::VARCHAR AS error FROM w
UNION ALL SELECT topic, partition, e, op, n::INT, NULL, 'command_too_large' FROM x WHERE n > 8""")
def command_batches(spark, sf):
    return batches.command_batches(_commands(spark, sf), 8, block=1000)


@query("batch_size_hist", f"""WITH {duck.LINES}, s AS (SELECT l_orderkey, count(*) AS n FROM le GROUP BY 1),
b(le, bound) AS (VALUES ('1', 1), ('10', 10), ('100', 100), ('500', 500), ('1000', 1000), ('2000', 2000), ('4000', 4000), ('8189', 8189), ('+Inf', 9999999999))
SELECT le, (SELECT count(*) FROM s WHERE n <= bound) AS n FROM b""")
def batch_size_hist(spark, sf):
    sizes = t.load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("size"))
    return metrics.histogram(sizes, "size", metrics.BATCH_BOUNDS)


@query("latency_hist", """WITH x AS (SELECT event_type AS op, event_id % 9000 * 0.001::DOUBLE AS s FROM events),
b AS (SELECT i, 0.001::DOUBLE * (2 ** i) AS bound FROM range(14) t(i))
SELECT op, i::BIGINT AS bucket, (SELECT count(*) FROM x WHERE x.op = o.op AND s <= bound) AS n FROM (SELECT DISTINCT op FROM x) o, b
UNION ALL SELECT op, 14, count(*) FROM x GROUP BY op""")
def latency_hist(spark, sf):
    seconds = t.load(spark, sf, "events").selectExpr("event_type as op", "event_id % 9000 * 0.001D as s")
    bounds = {repr(b): i for i, b in enumerate(metrics.LATENCY_BOUNDS)}
    cases = " ".join(f"when '{b}' then {i}L" for b, i in bounds.items())
    return metrics.histogram(seconds, "s", metrics.LATENCY_BOUNDS, ["op"]).selectExpr(
        "op", f"case le {cases} else 14L end as bucket", "n")


@query("batch_stats", """SELECT event_type AS op, count(*) AS n, sum(m)::BIGINT AS total, round(quantile_cont(m, 0.5) * 1000)::BIGINT AS p50,
 round(quantile_cont(m, 0.95) * 1000)::BIGINT AS p95, round(quantile_cont(m, 0.99) * 1000)::BIGINT AS p99
FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS m FROM events) GROUP BY 1""")
def batch_stats(spark, sf):
    values = t.load(spark, sf, "events").selectExpr("event_type as op", f"{t.minor('value')} as m")
    return metrics.statistics(values, "m", ["op"]).selectExpr(
        "op", "n", "total", *[f"cast(round({p} * 1000) as bigint) as {p}" for p in ("p50", "p95", "p99")])


# every order is one command of a batch of 64 orders; replies are dense and positional
@query("outcome_align", f"""WITH {duck.LINES}, x AS (SELECT l_orderkey // 64 AS batch_id, l_orderkey AS k, rn - first_rn AS idx, l_returnflag AS f FROM le)
SELECT k, idx::INT AS idx, row_number() OVER (PARTITION BY batch_id ORDER BY k, idx) - 1 AS pos, CASE f WHEN 'A' THEN 'created' WHEN 'N' THEN 'exists' ELSE 'exceeds_credits' END AS status FROM x""")
def outcome_align(spark, sf):
    from ledgerweave.functions import values as v

    lines = t.lines(spark, sf).selectExpr(
        "l_orderkey div 64 as batch_id", "l_orderkey", "rn", "first_rn", "last_rn", "l_returnflag")
    bounds = lines.groupBy("batch_id").agg(F.min("rn").alias("b0"), F.count("*").alias("batch_size"))
    rows = lines.join(bounds, "batch_id")
    commands = rows.selectExpr(
        "batch_id", "l_orderkey as k", "batch_size", "first_rn - b0 as start", "cast(rn - first_rn as int) as idx")
    replies = rows.selectExpr(
        "batch_id", "rn - b0 as pos",
        "case l_returnflag when 'A' then 'TransferCreated' when 'N' then 'TransferExists' else 'TransferExceedsCredits' end as raw")
    return batches.align_outcomes(commands, replies).selectExpr(
        "k", "idx", "pos", f"{v.status_name('raw', 'Transfer')} as status")
