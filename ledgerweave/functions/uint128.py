"""Unsigned 128-bit amounts as two decimal limbs: ``hi * 10^18 + lo``.

DECIMAL(38,0) cannot hold 2^128 - 1 (39 digits). With base 10^18 the low limb
is a DECIMAL(18,0), which Spark keeps as a plain 8-byte long, and the high limb
of every everyday amount is zero.

All functions take and return Spark SQL text, for ``expr`` and ``selectExpr``.
"""

from __future__ import annotations

# 2^128 - 1 and the limb layout.
MAX_UINT128 = "340282366920938463463374607431768211455"
BASE = "1000000000000000000BD"
LIMBS = "struct<hi:decimal(21,0),lo:decimal(18,0)>"


def make(hi: str, lo: str) -> str:
    return f"named_struct('hi', {hi}, 'lo', {lo})"


ZERO = make("cast(0 as decimal(21,0))", "cast(0 as decimal(18,0))")


def floor_div(value: str) -> str:
    """Whole multiples of the limb base in a signed decimal; decimal ``/`` would round."""
    return f"(({value} - pmod({value}, {BASE})) div {BASE})"


def strip_zeros(digits: str) -> str:
    """Digit text without leading zeros; ``0`` stays ``0``."""
    return f"regexp_replace({digits}, '^0+(?=[0-9])', '')"


def fits(digits: str) -> str:
    """True when digit text is at most 2^128 - 1, whatever its leading zeros."""
    s = strip_zeros(digits)
    return (
        f"(length({digits}) < 39 or length({s}) < 39"
        f" or (length({s}) = 39 and {s} <= '{MAX_UINT128}'))"
    )


def limbs(digits: str) -> str:
    """Digit text that ``fits`` as limbs, NULL for longer text."""
    s = strip_zeros(digits)
    padded = f"lpad({s}, 39, '0')"
    small = make("cast(0 as decimal(21,0))", f"try_cast({digits} as decimal(18,0))")
    large = make(
        f"try_cast(substr({padded}, 1, 21) as decimal(21,0))",
        f"try_cast(substr({padded}, 22, 18) as decimal(18,0))",
    )
    return f"case when length({digits}) <= 18 then {small} when length({s}) <= 39 then {large} end"


def from_long(minor: str) -> str:
    """Non-negative BIGINT minor units as limbs."""
    wide = f"cast({minor} as decimal(38,0))"
    large = make(
        f"cast({floor_div(wide)} as decimal(21,0))", f"cast({wide} % {BASE} as decimal(18,0))"
    )
    small = make("cast(0 as decimal(21,0))", f"cast({minor} as decimal(18,0))")
    return f"case when {minor} < 1000000000000000000 then {small} else {large} end"


def carry(hi: str, lo: str) -> str:
    """Normalise summed limbs to limbs again; ``lo`` may have any size and sign."""
    wide = f"cast({lo} as decimal(38,0))"
    return make(
        f"cast(cast({hi} as decimal(37,0)) + {floor_div(wide)} as decimal(38,0))",
        f"cast(pmod({wide}, {BASE}) as decimal(18,0))",
    )


def sum_limbs(amount: str, keep: str = "true") -> str:
    """Exact sum of limb amounts, partially aggregated like any Spark sum."""
    return carry(
        f"coalesce(sum({amount}.hi) filter (where {keep}), 0)",
        f"coalesce(sum({amount}.lo) filter (where {keep}), 0)",
    )


def digits(amount: str) -> str:
    """Limbs as decimal digit text."""
    return (
        f"case when {amount}.hi = 0 then cast({amount}.lo as string)"
        f" else concat({amount}.hi, lpad(cast({amount}.lo as string), 18, '0')) end"
    )


def difference(left: str, right: str) -> str:
    """``left - right`` as signed digit text (a net balance may be negative)."""

    def minus(a: str, b: str) -> str:
        hi = f"({a}.hi - {b}.hi - if({a}.lo < {b}.lo, 1, 0))"
        lo = f"({a}.lo - {b}.lo + if({a}.lo < {b}.lo, {BASE}, 0BD))"
        return (
            f"case when {hi} = 0 then cast(cast({lo} as decimal(18,0)) as string)"
            f" else concat(cast({hi} as decimal(38,0)),"
            f" lpad(cast(cast({lo} as decimal(18,0)) as string), 18, '0')) end"
        )

    return (
        f"case when {left}.hi < {right}.hi or ({left}.hi = {right}.hi and {left}.lo < {right}.lo)"
        f" then concat('-', {minus(right, left)}) else {minus(left, right)} end"
    )
