"""Strict decode: accepted forms, poison forms, order of the rules."""

import json

import pytest
from ledgerweave.functions import uint128 as u128
from ledgerweave.operators import decode as d
from ledgerweave.sources.registry import Registry

REG = Registry.of({"USD": (1, 2), "JPY": (2, 0), "BTC": (3, 8)}, {"payment": 1, "fee": 7})
ID = "0193f8a1-7c2e-7000-8000-00000000000"
T = {"id": ID + "1", "debit_account_id": ID + "2", "credit_account_id": ID + "3", "amount": "12.34",
     "ledger": "USD", "code": "payment"}
A = {"id": ID + "9", "ledger": "USD", "code": "payment", "flags": ["history"]}


def msg(*transfers, **more):
    return json.dumps({"operation": "create_transfers", "transfers": list(transfers), **more})


def acc(*accounts, **more):
    return json.dumps({"operation": "create_accounts", "accounts": list(accounts), **more})


def run(spark, texts, limits=d.Limits(), topic="cmd", routes=None):
    rows = [(t if isinstance(t, bytes) else t.encode(), topic, 0, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    options = d.DecodeOptions(REG, routes or {"cmd": "json"}, limits)
    return d.decode(df, options)


def details(spark, texts, **kw):
    out = run(spark, texts, **kw).orderBy("offset").collect()
    return [(r.error, r.detail) for r in out]


def test_accepted(spark):
    out = d.explode_events(run(spark, [
        msg({**T, "flags": ["linked"]}, {**T, "id": (ID + "4").upper(), "flags": ["linked", "pending"],
                                         "timeout": "1m30s"}),
        acc(A, {**A, "user_data_64": 2**64 - 1, "user_data_32": 2**32 - 1, "flags": None}),
        msg({**T, "amount": "0.5", "ledger": "BTC", "user_data_128": ID + "5"}),
        msg({"id": ID + "6", "pending_id": ID + "1", "flags": ["post_pending_transfer"],
             "amount": "1", "ledger": "JPY", "code": "fee"}),
        '  {"operation":"create_accounts","accounts":[{"id":"x","id":"' + ID + '7","ledger":"USD","code":"fee"}]}\n',
    ])).selectExpr("*", f"{u128.digits('amount')} as minor")
    rows = {(r.offset, r.idx): r for r in out.collect()}
    assert len(rows) == 7
    assert rows[0, 0].flags == 1 and rows[0, 1].flags == 2
    assert rows[0, 1].id == ID + "4" and rows[0, 1].id_text == (ID + "4").upper()
    assert rows[0, 0].minor == "1234" and rows[0, 1].timeout_s == 90
    assert rows[1, 0].flags == 8 and rows[1, 0].amount is None
    assert int(rows[1, 1].user_data_64) == 2**64 - 1 and rows[1, 1].user_data_32 == 2**32 - 1
    assert rows[2, 0].minor == "50000000" and rows[2, 0].user_data_128 == ID + "5"
    assert rows[3, 0].debit_account_id is None and rows[3, 0].pending_id == ID + "1"
    assert rows[4, 0].id == ID + "7"


POISON = [
    ("not json", "json: "), ("", "json: "), ('{"operation":"create_transfers"', "json: "),
    (msg(T) + " x", "json: "), (msg(T) + "],[x", "json: "), (msg(T) + "," + msg(T), "json: "),
    (msg({**T, "amont": "1"}), 'json: unknown field "amont"'),
    (msg(T, extra=1), 'json: unknown field "extra"'),
    (msg(T, amount="1"), 'json: unknown field "amount"'),
    (msg({**T, "operation": "x"}), 'json: unknown field "operation"'),
    (acc({**A, "amount": "1"}), 'json: unknown field "amount"'),
    (msg({**T, "amount": 12.34}), "json: value"), (msg({**T, "amount": 12}), "json: value"),
    (msg({**T, "user_data_64": 1.0}), "json: value"), (msg({**T, "user_data_64": "1"}), "json: value"),
    (msg({**T, "user_data_64": 5}, {**T, "user_data_64": 1.0}), "json: value"),
    (msg({**T, "user_data_64": -1}), "json: "), (msg({**T, "user_data_64": 2**64}), "json: "),
    (msg({**T, "user_data_32": 2**32}), "json: "), (msg({**T, "flags": "linked"}), "json: value"),
    (msg({**T, "flags": [1]}), "json: value"), ('{"operation":"create_transfers","transfers":{}}', "json: value"),
    ("[]", "json: "), ("5", "json: "),
    ("null", 'unknown operation ""'), ("{}", 'unknown operation ""'),
    ('{"operation":"bogus","transfers":[]}', 'unknown operation "bogus"'),
    (msg(), "transfers: empty"), (acc(), "accounts: empty"),
    ('{"operation":"create_transfers","transfers":null}', "transfers: empty"),
    (msg(T, accounts=[A]), "operation create_transfers must not carry accounts"),
    (acc(A, transfers=[T]), "operation create_accounts must not carry transfers"),
    (msg({**T, "id": "bad"}), 'transfers[0]: parse id "bad"'),
    (msg(T, {**T, "id": "00000000-0000-0000-0000-000000000000"}), "transfers[1]: id must not be zero"),
    (msg(T, None), 'transfers[1]: parse id ""'),
    (msg({**T, "flags": ["balancing_debt"]}), 'transfers[0]: unknown transfer flag "balancing_debt"'),
    (msg({**T, "flags": ["imported"]}), 'transfers[0]: transfer flag "imported" is read-only'),
    (msg({**T, "pending_id": ID + "8"}), "transfers[0]: pending_id only valid with post/void flags"),
    (msg({**T, "flags": ["void_pending_transfer"]}), "transfers[0]: pending_id required for post/void"),
    (msg({k: x for k, x in T.items() if k != "debit_account_id"}), 'transfers[0]: parse id ""'),
    (msg({**T, "ledger": "usd"}), 'transfers[0]: unknown ledger "usd"'),
    (msg({**T, "code": "nope"}), 'transfers[0]: unknown code "nope"'),
    (msg({**T, "amount": "12.345"}), 'transfers[0]: amount "12.345": has 3 decimals, scale is 2'),
    (msg({**T, "amount": "1.2", "ledger": "JPY"}), 'transfers[0]: amount "1.2": has 1 decimals, scale is 0'),
    (msg({**T, "amount": str(2**128), "ledger": "JPY"}), "exceeds uint128"),
    (msg({**T, "user_data_128": "u"}), 'transfers[0]: user_data_128: parse id "u"'),
    (msg({**T, "timeout": "soon"}), 'transfers[0]: timeout "soon"'),
    (acc({**A, "flags": ["pending"]}), 'accounts[0]: unknown account flag "pending"'),
    (acc(A, {**A, "user_data_128": "u"}), 'accounts[1].user_data_128: parse id "u"'),
    # two faults in one element: the earlier rule speaks
    (msg({**T, "ledger": "x", "code": "y", "amount": "z"}), 'unknown ledger "x"'),
    (msg({**T, "amount": "z", "timeout": "z"}), 'amount "z"'),
    (msg({**T, "id": "z", "flags": ["z"]}), 'parse id "z"'),
    (msg({**T, "flags": ["z"], "pending_id": ID}), 'unknown transfer flag "z"'),
    (acc({**A, "flags": ["z"], "code": "z"}), 'unknown code "z"'),
    (b'\xff\xfe{"a', "json: "),
]


def test_poison(spark):
    got = details(spark, [t for t, _ in POISON])
    for (text, want), (error, detail) in zip(POISON, got):
        assert error == "decode" and want in (detail or ""), (text, want, detail)


def test_limits(spark):
    big = msg(T)
    n = len(big)
    assert details(spark, [big], limits=d.Limits(max_bytes=16)) == [
        ("decode", f"message too large: {n} bytes, limit 16")]
    assert details(spark, [big], limits=d.Limits(max_bytes=n)) == [(None, None)]
    assert details(spark, [msg(T, T)], limits=d.Limits(max_events=1)) == [
        ("decode", "too many events: 2, limit 1")]
    deep = "[" * 9 + "]" * 9
    assert details(spark, [deep, big, '{"operation":"' + "[" * 50 + '\\"{{"}'], limits=d.Limits(max_depth=8)) == [
        ("decode", "json nesting too deep: limit 8"), (None, None),
        ("decode", 'unknown operation "' + "[" * 50 + '"{{"')]


def test_huge_strings_and_deep_nesting(spark):
    texts = ["[" * 5000, '{"operation":"' + "\\\\" * 300_000 + '"}', '{"operation":"' + "x" * 1_000_000]
    got = details(spark, texts, limits=d.Limits(max_bytes=1 << 24))
    assert got[0][1] == "json nesting too deep: limit 32"
    assert got[1][1].startswith("unknown operation") and got[2][1] == "json: parse error"


def test_unknown_topic_and_codecs(spark):
    assert details(spark, [msg(T)], topic="other") == [
        ("unknown_topic", 'no decoder registered for topic "other"')]
    with pytest.raises(ValueError):
        run(spark, [msg(T)], routes={"cmd": "nope"})

    def semicolons(payload):
        ident, debit, credit, amount = payload.decode().split(";")
        return {"op": "create_transfers", "transfers": [{
            "id": ident, "debit_account_id": debit, "credit_account_id": credit, "amount": amount,
            "ledger": "USD", "code": "fee"}]}

    d.register_codec("semicolons", d.contained(semicolons))
    out = run(spark, [f"{ID}1;{ID}2;{ID}3;5.00", "boom", f"{ID}1;{ID}2;{ID}3;x"],
              routes={"cmd": "semicolons", "j": "json"}).orderBy("offset").collect()
    assert out[0].error is None and out[0].events[0].code == 7
    assert out[1].detail.startswith("panic while decoding")
    assert 'amount "x"' in out[2].detail
