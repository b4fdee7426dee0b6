"""The value contract as Spark SQL fragments.

Ids travel as UUID text, amounts as decimal text scaled per ledger, flags as
name lists, timeouts as duration text. Every function takes and returns SQL
text for ``expr``/``selectExpr``, so a whole rule set is one expression for
Catalyst and a handful of calls for the driver. Nothing here throws on bad
data: ``*_error`` is NULL exactly when the value is usable.
"""

from __future__ import annotations

from ledgerweave.functions import uint128 as u128

# --- fixed values of the wire vocabulary ------------------------------------
NIL_ID = "00000000-0000-0000-0000-000000000000"
TRANSFER_FLAGS = [
    "linked", "pending", "post_pending_transfer", "void_pending_transfer",
    "balancing_debit", "balancing_credit", "closing_debit", "closing_credit", "imported",
]
ACCOUNT_FLAGS = [
    "linked", "debits_must_not_exceed_credits", "credits_must_not_exceed_debits",
    "history", "imported", "closed",
]
READ_ONLY_FLAG = "imported"
EVENT_TYPES = [
    "single_phase", "two_phase_pending", "two_phase_posted", "two_phase_voided", "two_phase_expired",
]
LINKED, PENDING, POST, VOID = 1, 2, 4, 8
DEBITS_CAPPED, CREDITS_CAPPED, HISTORY = 2, 4, 8
MAX_SCALE = 18
# ----------------------------------------------------------------------------


_HEX = "[0-9a-fA-F]"
_UUID = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
_UUID_OTHER = rf"^(?:(?i:urn:uuid:){_UUID}|\{{{_UUID}\}}|{_HEX}{{32}})\z"
_DURATION = r"^[+-]?(?:0|(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:ns|us|µs|μs|ms|s|m|h))+)\z"
_DURATION_PART = r"([0-9]*\.?[0-9]*)(ns|us|µs|μs|ms|s|m|h)"


def text(value: str) -> str:
    """A Python string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def names_array(names: list[str]) -> str:
    return "array(" + ", ".join(text(n) for n in names) + ")"


# --- ids ---------------------------------------------------------------------

def canonical_id(value: str) -> str:
    """Lower-case 36-character UUID, or NULL when the text is not a UUID.

    Besides the hyphenated form, the URN, braced and bare-hex spellings of a
    UUID are understood.
    """
    bare = f"lower(regexp_replace({value}, r'(?i)^urn:uuid:|[{{}}-]', ''))"
    shaped = (
        f"regexp_replace({bare}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
    )
    return (
        f"case when length({value}) = 36 and {value} rlike r'^{_UUID}\\z' then lower({value})"
        f" when length({value}) in (32, 38, 45) and {value} rlike r'{_UUID_OTHER}' then {shaped} end"
    )


def id_error(value: str, canonical: str) -> str:
    """Why ``value`` is not an id, NULL when it is one."""
    return (
        f"case when {canonical} is null then concat('parse id \"', coalesce({value}, ''), '\": invalid UUID')"
        f" when {canonical} = '{NIL_ID}' then 'id must not be zero' end"
    )


def optional_id(value: str) -> str:
    """The id, or NULL for the zero id, so that an encoder leaves the field out."""
    return f"nullif({value}, '{NIL_ID}')"


# --- amounts -----------------------------------------------------------------

def whole_part(value: str) -> str:
    return f"substring_index({value}, '.', 1)"


def fraction_part(value: str) -> str:
    return f"if(contains({value}, '.'), substr({value}, instr({value}, '.') + 1), '')"


def amount_error(value: str, scale: str) -> str:
    """Everything that can be wrong with an amount short of its magnitude."""
    whole, frac = whole_part(value), fraction_part(value)
    said = f"concat('amount \"', {value}, '\": "
    return (
        f"case when {scale} < 0 or {scale} > {MAX_SCALE} then {said}unsupported scale ', {scale})"
        f" when {value} = '' then 'amount: empty'"
        f" when {value} like '.%' or {value} rlike r'^[^.]*\\.\\z' then {said}malformed')"
        f" when not {value} rlike r'^[0-9]+(?:\\.[0-9]+)?\\z' then {said}only digits and one dot allowed')"
        f" when length({frac}) > {scale}"
        f" then {said}has ', length({frac}), ' decimals, scale is ', {scale}) end"
    )


def amount_digits(value: str, scale: str) -> str:
    """Minor-unit digit text of an amount without ``amount_error``; no rounding, no float."""
    return f"concat({whole_part(value)}, rpad({fraction_part(value)}, {scale}, '0'))"


def overflow_error(value: str, minor: str) -> str:
    return (
        f"case when not {u128.fits(minor)} then concat('amount \"', {value}, '\": exceeds uint128') end"
    )


def format_digits(minor: str, scale: str) -> str:
    """Minor-unit digit text as decimal text with exactly ``scale`` decimals."""
    return (
        f"case when {scale} = 0 then {minor} when length({minor}) > {scale} then"
        f" concat(left({minor}, length({minor}) - {scale}), '.', right({minor}, {scale}))"
        f" else concat('0.', lpad({minor}, {scale}, '0')) end"
    )


def format_amount(amount: str, scale: str) -> str:
    """Limb amount as decimal text at ``scale``."""
    return format_digits(u128.digits(amount), scale)


# --- timeouts ----------------------------------------------------------------

def timeout_nanos(value: str) -> str:
    """Nanoseconds of a duration text, NULL when it is not one."""
    unit = (
        "case u when 'h' then 3600000000000BD when 'm' then 60000000000BD when 's' then 1000000000BD"
        " when 'ms' then 1000000BD when 'ns' then 1BD else 1000BD end"
    )
    # whole and fraction apart. The fraction times the unit is exact for any number of digits: 24 digits
    # at a time from the right, each part hands on what it has in whole units of the next
    whole = "try_cast(coalesce(nullif(substring_index(n, '.', 1), ''), '0') as decimal(20,0))"
    frac = (
        "aggregate(reverse(regexp_extract_all(if(contains(n, '.'), substring_index(n, '.', -1), ''), '[0-9]{1,24}', 0)),"
        f" cast(0 as decimal(20,0)), (c, d) -> cast((cast(rpad(d, 24, '0') as decimal(24,0)) * cast({unit} as decimal(13,0)) + c)"
        " div 1000000000000000000000000BD as decimal(20,0)))"
    )
    parts = (
        f"zip_with(regexp_extract_all({value}, r'{_DURATION_PART}', 1),"
        f" regexp_extract_all({value}, r'{_DURATION_PART}', 2),"
        f" (n, u) -> cast(try_add(try_multiply({whole}, cast({unit} as decimal(14,0))),"
        f" {frac}) as decimal(38,0)))"
    )
    total = (
        f"aggregate({parts}, cast(0 as decimal(38,0)), (a, x) -> cast(try_add(a, x) as decimal(38,0)))"
    )
    return f"case when {value} rlike r'{_DURATION}' then {total} end"


def timeout_error(value: str, nanos: str) -> str:
    """Why a duration text is not a usable timeout."""
    said = f"concat('timeout \"', {value}, '\": "
    return (
        f"case when {nanos} is null or {nanos} > 9223372036854775807"
        f" then {said}time: invalid duration \"', {value}, '\"')"
        f" when {nanos} <= 0 or {value} like '-%' then {said}must be positive')"
        f" when {nanos} < 1000000000 or {nanos} > 4294967295999999999"
        f" then {said}out of range for uint32 seconds') end"
    )


def timeout_seconds(nanos: str) -> str:
    return f"case when {nanos} <= 9223372036854775807 then {nanos} div 1000000000BD end"


def format_timeout(seconds: str) -> str:
    """Seconds as duration text (``1m30s``, ``1h0m0s``); NULL for zero."""
    h, m, s = f"{seconds} div 3600", f"{seconds} % 3600 div 60", f"{seconds} % 60"
    return (
        f"case when {seconds} = 0 then null"
        f" when {seconds} >= 3600 then concat({h}, 'h', {m}, 'm', {s}, 's')"
        f" when {seconds} >= 60 then concat({m}, 'm', {s}, 's') else concat({s}, 's') end"
    )


# --- flags -------------------------------------------------------------------

#: Why the read-only flag cannot be written.
READ_ONLY_REASON = "imported objects bring times of their own, and a command has no field for them"


def flag_error(names: str, table: list[str], kind: str) -> str:
    """The first flag name that may not be written, as an error text."""
    writable = names_array([n for n in table if n != READ_ONLY_FLAG])
    bad = f"try_element_at(array_except({names}, {writable}), 1)"
    return (
        f"case when size({names}) = 0 then null when {bad} = '{READ_ONLY_FLAG}' then concat('{kind} flag \"', {bad},"
        f" '\" is read-only in this connector: {READ_ONLY_REASON}')"
        f" when {bad} is not null then concat('unknown {kind} flag \"', {bad}, '\"') end"
    )


def flag_mask(names: str, table: list[str]) -> str:
    """Bit mask of a list of flag names; repeats count once."""
    bits = " + ".join(
        f"if(array_contains({names}, '{name}'), {1 << bit}, 0)"
        for bit, name in enumerate(table) if name != READ_ONLY_FLAG
    )
    return f"if(size({names}) = 0, 0, {bits})"


def flag_names(mask: str, table: list[str]) -> str:
    """Names of the set bits in bit order; a bit without a name is ``bit_N``."""
    labels = [table[b] if b < len(table) else f"bit_{b}" for b in range(16)]
    picked = ", ".join(f"if(({mask} & {1 << b}) != 0, '{label}', null)" for b, label in enumerate(labels))
    return f"if({mask} = 0, cast(array() as array<string>), split(concat_ws(',', {picked}), ','))"


# --- names of statuses and event types ---------------------------------------

def status_name(raw: str, prefix: str) -> str:
    """``TransferExceedsCredits`` → ``exceeds_credits``."""
    bare = f"substr({raw}, {len(prefix) + 1})"
    edges = "(?<=[^A-Z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
    return (
        f"if({raw} like '{prefix}%', lower(regexp_replace({bare}, '{edges}', '_')),"
        f" concat('unknown_status_', {raw}))"
    )


def status_class(raw: str) -> str:
    """``ok`` for a created or already existing object, ``rejected`` otherwise."""
    good = "('TransferCreated', 'TransferExists', 'AccountCreated', 'AccountExists')"
    return f"if({raw} in {good}, 'ok', 'rejected')"


def event_type_name(code: str) -> str:
    """Name of a change-event type; an unknown one keeps its number."""
    cases = " ".join(f"when {i} then '{n}'" for i, n in enumerate(EVENT_TYPES))
    return f"case {code} {cases} else cast({code} as string) end"


# --- time and checkpoints ----------------------------------------------------

def rfc3339(ts: str) -> str:
    """UTC time with its fraction's trailing zeros removed; NULL is year one."""
    shown = f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    return (
        f"coalesce(concat(regexp_replace({shown}, r'\\.?0+$', ''), 'Z'), '0001-01-01T00:00:00Z')"
    )


def parse_checkpoint(value: str) -> str:
    """Checkpoint text as an unsigned 64-bit number, NULL when unusable."""
    number = f"try_cast({u128.strip_zeros(value)} as decimal(20,0))"
    return (
        f"case when {value} rlike r'^[0-9]+\\z' and {number} <= 18446744073709551615BD then {number} end"
    )
