"""Value contract: amounts, ids, timeouts, flags, names, checkpoints."""

import datetime

from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v

MAX = 2**128 - 1
MINOR = v.amount_digits("t", "s")
AMOUNT_ERROR = f"coalesce({v.amount_error('t', 's')}, {v.overflow_error('t', MINOR)})"
LIMBS_OF_T = u128.limbs(MINOR)


def evaluate(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr(*[f"{sql} as {name}" for name, sql in columns.items()]).collect()


def expected_amount(text, scale):
    """Independent restatement with Python integers."""
    whole, dot, frac = text.partition(".")
    if not 0 <= scale <= 18:
        return None
    if not whole or (dot and not frac):
        return None
    if not (whole + frac).isascii() or not (whole + frac).isdigit() or len(frac) > scale:
        return None
    value = int(whole + frac + "0" * (scale - len(frac)))
    return value if value <= MAX else None


def test_amounts_against_python_integers(spark):
    texts = ["0", "12.34", "12.3", "12", "0.01", "", "abc", "-1", "+1", "1e3", " 1", "1 ", ".", "1.",
             ".5", "1.2.3", "٣", "1_000", "0x10", "NaN", "1\n", "0" * 64 + "7", "12.345",
             "1,5", "0" * 40]
    for edge in (2**64, 2**128, 10**18, 10**36, 10**19):
        texts += [str(edge - 1), str(edge), str(edge + 1)]
    texts += [str(MAX)[:-2] + "." + str(MAX)[-2:], str(MAX)[:-18] + "." + str(MAX)[-18:]]
    rows = [(t, s) for t in texts for s in range(-1, 20)]
    got = evaluate(
        spark, rows, "t string, s int", t="t", s="s",
        e=AMOUNT_ERROR, d=f"case when {AMOUNT_ERROR} is null then {u128.digits('(' + LIMBS_OF_T + ')')} end",
    )
    for row in got:
        want = expected_amount(row.t, row.s)
        assert (None if row.d is None else int(row.d)) == want, (row.t, row.s, row)
        assert (row.e is None) == (want is not None), row


def test_amount_error_texts(spark):
    rows = [("", 2, "amount: empty"), ("1.", 2, 'amount "1.": malformed'),
            ("1.2.3", 2, 'amount "1.2.3": only digits and one dot allowed'),
            ("12.345", 2, 'amount "12.345": has 3 decimals, scale is 2'),
            (str(MAX + 1), 0, f'amount "{MAX + 1}": exceeds uint128'),
            ("1", 19, 'amount "1": unsupported scale 19')]
    got = evaluate(spark, rows, "t string, s int, e string", e="e",
                   g=AMOUNT_ERROR)
    assert [r.g for r in got] == [r.e for r in got]


def test_format_amount(spark):
    rows = [("18446744073709551615", 2, "184467440737095516.15"),
            ("18446744073709551616", 2, "184467440737095516.16"),
            ("0", 2, "0.00"), ("1", 2, "0.01"), ("7", 0, "7"), ("5", 18, "0." + "0" * 17 + "5"),
            (str(MAX), 2, str(MAX)[:-2] + "." + str(MAX)[-2:]), (str(MAX), 0, str(MAX))]
    got = evaluate(spark, rows, "d string, s int, e string", e="e",
                   g=v.format_amount(f"({u128.limbs('d')})", "s"))
    assert [r.g for r in got] == [r.e for r in got]


def test_limb_sums_and_differences(spark):
    values = [MAX, MAX, 10**18 - 1, 1, 10**18, 0, 999, 10**37]
    df = spark.createDataFrame([(str(x),) for x in values], "d string")
    total = (
        df.selectExpr(f"{u128.limbs('d')} as a").groupBy().agg(F.expr(u128.sum_limbs("a")).alias("s"))
        .selectExpr(f"{u128.digits('s')} as t").first().t
    )
    assert int(total) == sum(values)
    for near in ([10**18 - 1], [10**18 - 1, 1], [10**18 - 2, 1], [2 * 10**18 - 1], [10**36 - 1, 0]):
        rows = [(str(x),) for x in near]
        total = (
            spark.createDataFrame(rows, "d string").selectExpr(f"{u128.limbs('d')} as a")
            .groupBy().agg(F.expr(u128.sum_limbs("a")).alias("s")).selectExpr(f"{u128.digits('s')} as t").first().t
        )
        assert int(total) == sum(near)
    pairs = [(str(a), str(b)) for a in values for b in values]
    got = evaluate(spark, pairs, "a string, b string", a="a", b="b",
                   g=u128.difference(f"({u128.limbs('a')})", f"({u128.limbs('b')})"))
    for r in got:
        assert int(r.g) == int(r.a) - int(r.b)
    longs = [0, 1, 10**18 - 1, 10**18, 10**18 + 1, 2**63 - 1]
    got = evaluate(spark, [(x,) for x in longs], "x long", g=u128.digits(f"({u128.from_long('x')})"))
    assert [int(r.g) for r in got] == longs


def test_ids(spark):
    one = "0193f8a1-7c2e-7000-8000-000000000001"
    rows = [(one, one), (one.upper(), one), ("urn:uuid:" + one, one), ("{" + one + "}", one),
            (one.replace("-", ""), one), ("", None), ("not-a-uuid", None), (one[:-1], None),
            (v.NIL_ID, None), (one + "\n", None)]
    got = evaluate(spark, rows, "t string, e string", e="e", g=v.canonical_id("t"), err=v.id_error("t", f"({v.canonical_id('t')})"))
    for r in got:
        assert (r.g if r.err is None else None) == r.e
        assert (r.err is None) == (r.e is not None)
    assert [r.err for r in got][-2] == "id must not be zero"


def test_timeouts(spark):
    rows = [("1m30s", 90), ("1s", 1), ("1h", 3600), ("1.5h", 5400), ("1500ms", 1), ("90s", 90),
            ("999ms", None), ("0", None), ("-1s", None), ("", None), ("5", None), ("1x", None),
            ("4294967295s", 4294967295), ("4294967296s", None), ("99999999999999999999h", None),
            ("1s\n", None), ("+2s", 2), (".5m", 30), ("2m0.5s", 120), ("3000000us", 3),
            ("3000000µs", 3), ("2000000000ns", 2), ("1999999999ns", 1), ("59.9999999999s", 59)]
    got = evaluate(spark, rows, "t string, e long", t="t", e="e",
                   g=v.timeout_seconds(f"({v.timeout_nanos('t')})"),
                   err=v.timeout_error("t", f"({v.timeout_nanos('t')})"))
    for r in got:
        assert (r.g if r.err is None else None) == r.e, r
        assert (r.err is None) == (r.e is not None), r
    rows = [(90, "1m30s"), (60, "1m0s"), (3600, "1h0m0s"), (1, "1s"), (0, None), (86399, "23h59m59s")]
    got = evaluate(spark, rows, "s long, e string", e="e", g=v.format_timeout("s"))
    assert [r.g for r in got] == [r.e for r in got]


def test_flags(spark):
    for table, kind in ((v.TRANSFER_FLAGS, "transfer"), (v.ACCOUNT_FLAGS, "account")):
        writable = [f for f in table if f != v.READ_ONLY_FLAG]
        rows = [([f, f],) for f in writable] + [(writable,), ([],)]
        got = evaluate(spark, rows, "n array<string>", n="n",
                       m=v.flag_mask("n", table), e=v.flag_error("n", table, kind),
                       back=v.flag_names(f"({v.flag_mask('n', table)})", table))
        for r in got:
            assert r.e is None
            assert r.back == [f for f in table if f in r.n]
            assert r.m == sum(1 << table.index(f) for f in set(r.n))
    got = evaluate(spark, [(["linked", "balancing_debt", "imported"],), (["imported"],)],
                   "n array<string>", e=v.flag_error("n", v.TRANSFER_FLAGS, "transfer"))
    assert got[0].e == 'unknown transfer flag "balancing_debt"'
    assert "read-only" in got[1].e
    got = evaluate(spark, [(1 << 15 | 1 << 8,)], "m int",
                   n=v.flag_names("m", v.TRANSFER_FLAGS))
    assert got[0].n == ["imported", "bit_15"]


def test_names(spark):
    rows = [("AccountIDMustNotBeZero", "Account", "id_must_not_be_zero"),
            ("TransferExceedsCredits", "Transfer", "exceeds_credits"),
            ("CreateTransferStatus(1)", "Transfer", "unknown_status_CreateTransferStatus(1)"),
            ("TransferUserData128Bad", "Transfer", "user_data128_bad"),
            ("TransferOK", "Transfer", "ok"), ("TransferIDs", "Transfer", "i_ds")]
    for raw, prefix, want in rows:
        got = evaluate(spark, [(raw,)], "r string", g=v.status_name("r", prefix))
        assert got[0].g == want
    got = evaluate(spark, [(i,) for i in (0, 1, 2, 3, 4, 200)], "c int",
                   g=v.event_type_name("c"))
    assert [r.g for r in got] == v.EVENT_TYPES + ["200"]


def test_time_and_checkpoint(spark):
    t = datetime.datetime
    rows = [(t(2024, 1, 1),), (t(2024, 1, 1, 10, 20, 30, 120000),), (t(2024, 1, 1, 0, 0, 7, 179575),),
            (None,)]
    got = evaluate(spark, rows, "t timestamp_ntz", g=v.rfc3339("t"))
    assert [r.g for r in got] == ["2024-01-01T00:00:00Z", "2024-01-01T10:20:30.12Z",
                                  "2024-01-01T00:00:07.179575Z", "0001-01-01T00:00:00Z"]
    rows = [("123", 123), ("007", 7), ("x", None), ("", None), (None, None), ("-1", None),
            (str(2**64), None), (str(2**64 - 1), 2**64 - 1), ("0" * 60 + "5", 5), ("1\n", None)]
    rows = [(t, None if e is None else str(e)) for t, e in rows]
    got = evaluate(spark, rows, "t string, e string", e="cast(e as decimal(20,0))",
                   g=v.parse_checkpoint("t"))
    assert [r.g for r in got] == [r.e for r in got]
