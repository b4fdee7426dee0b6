"""The table mapping restated for an independent SQL engine (DuckDB).

These texts share no logic with the library: ids come from ``printf``, amounts
from HUGEINT arithmetic, expected verdicts from the row the message was made of.
"""

from __future__ import annotations

BASE = 1_000_000_000_000


def uid(ns: int, b: str, a: str | None = None) -> str:
    if a is None:
        return f"'{ns:08x}-0000-0000-0000-' || printf('%012x', {b})"
    h = f"printf('%012x', {a})"
    return (
        f"'{ns:08x}-' || substr({h},1,4) || '-' || substr({h},5,4) || '-' || substr({h},9,4)"
        f" || '-' || printf('%012x', {b})"
    )


def money(m: str, scale: int = 2) -> str:
    return f"(({m}) // 100)::VARCHAR || '.' || lpad((({m}) % 100)::VARCHAR, 2, '0')"


def fmt(m: str, scale: str) -> str:
    """Integer minor units as decimal text at a scale column."""
    p = f"(10::HUGEINT ** ({scale}))::HUGEINT"
    return (
        f"CASE WHEN ({scale}) = 0 THEN ({m})::VARCHAR ELSE (({m})::HUGEINT // {p})::VARCHAR || '.'"
        f" || lpad((({m})::HUGEINT % {p})::VARCHAR, ({scale})::INT, '0') END"
    )


LEDGERS = """ledgers AS (
 SELECT r_name AS name, CAST(r_regionkey + 1 AS BIGINT) AS id,
  CASE WHEN r_regionkey < 3 THEN 2 WHEN r_regionkey = 3 THEN 0 ELSE 3 END AS scale FROM region)"""
CODES = "codes AS (SELECT * FROM (VALUES ('returned', 1), ('new', 2), ('refused', 3)) t(name, value))"

CUST = """cust AS (SELECT c_custkey, n_regionkey AS region, c_mktsegment, c_acctbal, r_name,
  CASE WHEN n_regionkey < 3 THEN 2 WHEN n_regionkey = 3 THEN 0 ELSE 3 END AS scale
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LINES = f"""{CUST},
ln AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_shipdate) AS rn, CAST(round(l_extendedprice * 100) AS BIGINT) AS amt FROM lineitem),
le AS (SELECT ln.*, min(rn) OVER (PARTITION BY l_orderkey) AS first_rn, max(rn) OVER (PARTITION BY l_orderkey) AS last_rn,
  o_custkey, region FROM ln JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey)"""

EVENTS = f"""{LINES},
ev AS (
 SELECT c_custkey + 1 AS seq, {uid(5, 'c_custkey')} AS id, {uid(6, 'region')} AS debit, {uid(1, 'c_custkey')} AS credit,
  CAST(NULL AS VARCHAR) AS pending_id, 50000000 + CAST(round(c_acctbal * 100) AS BIGINT) AS amt, region + 1 AS ledger,
  2 AS code, 0 AS flags, 0 AS timeout_s, CAST(NULL AS BIGINT) AS chain_id FROM cust
 UNION ALL
 SELECT {BASE} + 2 * rn, {uid(3, 'l_linenumber', 'l_orderkey')}, {uid(1, 'o_custkey')},
  CASE WHEN l_partkey % 50 = 0 THEN {uid(1, 'o_custkey + 1')} ELSE {uid(2, 'l_suppkey')} END, NULL, amt, region + 1,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END,
  CASE WHEN l_linestatus = 'O' THEN 2 ELSE 0 END + CASE WHEN l_orderkey % 3 = 0 AND rn < last_rn THEN 1 ELSE 0 END,
  CASE WHEN l_linestatus = 'O' THEN 30 * l_linenumber ELSE 0 END, CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey END FROM le
 UNION ALL
 SELECT {BASE} + 2 * rn + 1, {uid(4, 'l_linenumber', 'l_orderkey')}, NULL, NULL, {uid(3, 'l_linenumber', 'l_orderkey')}, amt,
  region + 1, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END,
  CASE WHEN l_linenumber % 2 = 0 THEN 4 ELSE 8 END, 0, NULL FROM le
 WHERE l_linestatus = 'O' AND (l_linenumber % 2 = 0 OR l_linenumber = 3))"""

ACCOUNTS = f"""acc AS (
 SELECT {uid(1, 'c_custkey')} AS id, region + 1 AS ledger, 1 AS code,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 0 END + CASE WHEN c_custkey % 2 = 0 THEN 8 ELSE 0 END AS flags,
  CASE WHEN c_custkey % 7 = 5 THEN {BASE} + 80 * c_custkey ELSE 0 END AS created, c_custkey AS ud64
 FROM cust WHERE c_custkey % 10 <> 3
 UNION ALL SELECT {uid(2, 's_suppkey')}, n_regionkey + 1, 2, CASE WHEN s_suppkey % 2 = 0 THEN 8 ELSE 0 END, 0, 0
 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 25 <> 7
 UNION ALL SELECT {uid(6, 'r_regionkey')}, r_regionkey + 1, 3, 0, 0, 0 FROM region)"""

POSTED = f"""{EVENTS}, {ACCOUNTS},
fst AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1),
s1 AS (SELECT f.*, CASE WHEN flags IN (4, 8) THEN NULL
   WHEN NOT EXISTS (SELECT 1 FROM acc a WHERE a.id = f.debit AND a.created < f.seq) THEN 'debit_account_not_found'
   WHEN NOT EXISTS (SELECT 1 FROM acc a WHERE a.id = f.credit AND a.created < f.seq) THEN 'credit_account_not_found'
  END AS e1 FROM fst f),
s2 AS (SELECT *, CASE WHEN chain_id IS NULL THEN e1 WHEN bad IS NULL THEN NULL WHEN seq = bad THEN e1
   ELSE 'linked_event_failed' END AS e2
  FROM (SELECT *, min(CASE WHEN e1 IS NOT NULL THEN seq END) OVER (PARTITION BY chain_id) AS bad FROM s1)),
s3 AS (SELECT r.*, p.amt AS p_amt, p.debit AS p_debit, p.credit AS p_credit,
   CASE WHEN p.id IS NULL THEN 'pending_transfer_not_found' WHEN p.flags & 2 = 0 THEN 'pending_transfer_not_pending'
    WHEN r.flags = 4 AND r.amt > p.amt THEN 'exceeds_pending_transfer_amount' END AS e3
  FROM s2 r LEFT JOIN s2 p ON r.pending_id = p.id AND p.flags NOT IN (4, 8) AND p.e2 IS NULL AND p.seq < r.seq
  WHERE r.flags IN (4, 8)),
posted AS (
 SELECT seq, id, debit, credit, pending_id, amt, ledger, code, flags, timeout_s, chain_id, NULL::BIGINT AS p_amt,
  NULL::VARCHAR AS p_debit, NULL::VARCHAR AS p_credit, e2 AS error FROM s2 WHERE flags NOT IN (4, 8)
 UNION ALL
 SELECT seq, id, debit, credit, pending_id, amt, ledger, code, flags, timeout_s, chain_id, p_amt, p_debit, p_credit,
  coalesce(e3, CASE WHEN row_number() OVER (PARTITION BY pending_id, e3 IS NULL ORDER BY seq) > 1
   THEN 'pending_transfer_already_resolved' END)
 FROM s3)"""

LEGS = f"""{POSTED},
mv AS (SELECT seq, id, coalesce(p_debit, debit) AS debit, coalesce(p_credit, credit) AS credit,
  CASE WHEN flags & 2 <> 0 THEN amt WHEN flags IN (4, 8) THEN -p_amt ELSE 0 END AS pend,
  CASE WHEN flags & 2 <> 0 OR flags = 8 THEN 0 ELSE amt END AS book FROM posted WHERE error IS NULL),
legs AS (SELECT seq, id, 'debit' AS side, debit AS account_id, pend, book FROM mv
 UNION ALL SELECT seq, id, 'credit', credit, pend, book FROM mv)"""

DUE = """due AS (SELECT *, row_number() OVER (ORDER BY expires_at, seq) + 1000000000000000000 AS xseq FROM (
  SELECT *, seq + timeout_s AS expires_at FROM posted p WHERE error IS NULL AND flags & 2 <> 0 AND timeout_s > 0
   AND NOT EXISTS (SELECT 1 FROM posted r WHERE r.error IS NULL AND r.flags IN (4, 8) AND r.pending_id = p.id))
  WHERE expires_at <= 1000000000000000000)"""

CHANGES = f"""{POSTED}, {DUE},
app AS (SELECT seq, id, coalesce(p_debit, debit) AS debit, coalesce(p_credit, credit) AS credit, pending_id, amt, ledger, code,
  flags, timeout_s, CASE WHEN flags & 2 <> 0 THEN 1 WHEN flags & 4 <> 0 THEN 2 WHEN flags & 8 <> 0 THEN 3 ELSE 0 END AS type,
  CASE WHEN flags & 2 <> 0 THEN amt WHEN flags IN (4, 8) THEN -p_amt ELSE 0 END AS pend,
  CASE WHEN flags & 2 <> 0 OR flags = 8 THEN 0 ELSE amt END AS book FROM posted WHERE error IS NULL
 UNION ALL
 SELECT xseq, id, debit, credit, pending_id, amt, ledger, code, flags, timeout_s, 4, -amt, 0 FROM due),
lg AS (SELECT seq, 'debit' AS side, debit AS account_id, pend, book FROM app
 UNION ALL SELECT seq, 'credit', credit, pend, book FROM app),
run AS (SELECT seq, side, account_id,
  sum(CASE WHEN side = 'debit' THEN pend ELSE 0 END) OVER w AS dp, sum(CASE WHEN side = 'debit' THEN book ELSE 0 END) OVER w AS db,
  sum(CASE WHEN side = 'credit' THEN pend ELSE 0 END) OVER w AS cp, sum(CASE WHEN side = 'credit' THEN book ELSE 0 END) OVER w AS cb
 FROM lg WINDOW w AS (PARTITION BY account_id ORDER BY seq)),
chg AS (SELECT app.*, d.dp AS d_dp, d.db AS d_db, d.cp AS d_cp, d.cb AS d_cb, c.dp AS c_dp, c.db AS c_db, c.cp AS c_cp, c.cb AS c_cb,
  da.code AS d_code, da.flags AS d_flags, da.created AS d_created, da.ud64 AS d_ud,
  ca.code AS c_code, ca.flags AS c_flags, ca.created AS c_created, ca.ud64 AS c_ud
 FROM app JOIN run d ON d.seq = app.seq AND d.side = 'debit' JOIN run c ON c.seq = app.seq AND c.side = 'credit'
 LEFT JOIN acc da ON da.id = app.debit LEFT JOIN acc ca ON ca.id = app.credit)"""


def _el(**kw: str | None) -> str:
    fields = {"id": "ident", "debit_account_id": "debit", "credit_account_id": "credit", "amount": "amount",
              "ledger": "r_name", "code": "'new'", **kw}
    parts = []
    for n, e in fields.items():
        if e is not None:
            parts.append(f"'\"{n}\":\"' || {e} || '\"'")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


CMD = f"""{CUST},
c0 AS (SELECT event_id AS e, ts, user_id AS u, event_type AS et, r_name, scale, region, CAST(round(value * 100) AS BIGINT) AS m,
  {uid(3, '0', 'event_id')} AS ident, {uid(1, 'user_id')} AS debit, {uid(2, 'event_id % 100')} AS credit,
  event_id % 20 AS form, CASE WHEN event_id % 50 = 7 THEN 'ledger.unrouted' ELSE 'ledger.commands' END AS topic,
  CAST(user_id % 4 AS INT) AS partition FROM events JOIN cust ON user_id = c_custkey),
c1 AS (SELECT *, {money('m')} AS amount FROM c0),
c2 AS (SELECT *, CASE WHEN scale = 0 THEN 'transfers[0]: amount "' || amount || '": has 2 decimals, scale is 0' END AS dec0,
  length({_el()}) AS el_len FROM c1),
cmd AS (SELECT *, CASE WHEN topic = 'ledger.unrouted' THEN 'unknown_topic' WHEN detail0 IS NOT NULL THEN 'decode' END AS error,
  CASE WHEN topic = 'ledger.unrouted' THEN 'no decoder registered for topic "ledger.unrouted"' ELSE detail0 END AS detail
 FROM (SELECT *, CASE et WHEN 'signup' THEN NULL WHEN 'purchase' THEN dec0 WHEN 'view' THEN dec0 WHEN 'click' THEN dec0
  ELSE CASE form WHEN 0 THEN 'json: parse error' WHEN 1 THEN 'json: unknown field "amont"'
   WHEN 2 THEN 'transfers[0]: amount "12.3456": has 4 decimals, scale is ' || scale
   WHEN 3 THEN 'transfers[0]: parse id "no-identity": invalid UUID' WHEN 4 THEN 'transfers[0]: unknown ledger "ATLANTIS"'
   WHEN 5 THEN 'transfers[0]: unknown code "unlisted"' WHEN 6 THEN 'transfers[0]: unknown transfer flag "balancing_debt"'
   WHEN 7 THEN 'transfers: empty' WHEN 8 THEN 'unknown operation "rename_ledger"'
   WHEN 9 THEN 'operation create_transfers must not carry accounts' WHEN 10 THEN 'transfers[0]: id must not be zero'
   WHEN 11 THEN 'json: parse error' WHEN 12 THEN 'transfers[0]: pending_id only valid with post/void flags'
   WHEN 13 THEN 'transfers[0]: pending_id required for post/void'
   WHEN 14 THEN 'message too large: ' || (el_len + 47 + 5000) || ' bytes, limit 4096'
   WHEN 15 THEN 'json nesting too deep: limit 32' WHEN 16 THEN 'too many events: 4, limit 3'
   WHEN 17 THEN 'transfers[0]: timeout "soon": time: invalid duration "soon"'
   WHEN 18 THEN 'transfers[0]: transfer flag "imported" is read-only in this connector: imported objects bring times of their own, and a command has no field for them'
   ELSE 'json: value of the wrong type' END END AS detail0 FROM c2))"""

# expected events of usable commands: idx, id, flags, ...
CMD_EVENTS = f"""{CMD},
ce AS (
 SELECT e, topic, partition, 0 AS idx, 'create_accounts' AS op, debit AS id, NULL::VARCHAR AS debit, NULL::VARCHAR AS credit,
  NULL::VARCHAR AS pending_id, NULL::BIGINT AS amt, region + 1 AS ledger, 1 AS code, CASE WHEN e % 2 = 0 THEN 8 ELSE 0 END AS flags,
  0 AS ud64, 0 AS timeout_s, u, ts, 1 AS n FROM cmd WHERE error IS NULL AND et = 'signup'
 UNION ALL
 SELECT e, topic, partition, i.idx, 'create_transfers', CASE WHEN i.idx = 1 THEN {uid(3, '1', 'e')} ELSE ident END,
  CASE WHEN et <> 'click' THEN debit END, CASE WHEN et <> 'click' THEN credit END,
  CASE WHEN et = 'click' THEN {uid(3, '0', '(e - 1)')} END, CASE WHEN scale = 3 THEN m * 10 ELSE m END, region + 1, 2,
  CASE WHEN et = 'view' THEN 2 WHEN et = 'click' THEN 4 WHEN e % 10 = 1 AND i.idx = 0 THEN 1 ELSE 0 END,
  CASE WHEN et = 'purchase' AND e % 10 <> 1 THEN e ELSE 0 END, CASE WHEN et = 'view' THEN 1 + e % 300 ELSE 0 END, u, ts,
  CASE WHEN et = 'purchase' AND e % 10 = 1 THEN 2 ELSE 1 END
 FROM cmd JOIN (VALUES (0), (1)) i(idx) ON i.idx = 0 OR (et = 'purchase' AND e % 10 = 1)
 WHERE error IS NULL AND et IN ('purchase', 'view', 'click'))"""

CMD_OUTCOMES = f"""{CMD_EVENTS},
o1 AS (SELECT ce.*, CASE WHEN op = 'create_accounts' OR flags = 4 THEN NULL
   WHEN u % 10 = 3 OR u % 7 = 5 THEN 'debit_account_not_found'
   WHEN (e % 100) % 25 = 7 OR NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = e % 100) THEN 'credit_account_not_found'
  END AS e1 FROM ce),
oc AS (SELECT o.*, CASE WHEN o.flags = 4 THEN CASE WHEN p.e IS NULL THEN 'pending_transfer_not_found'
    WHEN p.flags & 2 = 0 THEN 'pending_transfer_not_pending' WHEN o.amt > p.amt THEN 'exceeds_pending_transfer_amount' END
   WHEN o.n = 2 AND o.idx = 1 AND o.e1 IS NOT NULL THEN 'linked_event_failed' ELSE o.e1 END AS error
  FROM o1 o LEFT JOIN o1 p ON o.flags = 4 AND p.op = 'create_transfers' AND p.idx = 0 AND p.e = o.e - 1 AND p.flags <> 4 AND p.e1 IS NULL)"""
