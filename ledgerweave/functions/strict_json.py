"""Strict command JSON as Spark SQL fragments.

One parse into VARIANT, then one look at the document's own schema decides
whether every field is known and has the right type, at every level at once.
Only documents that this leaves in doubt are scanned bracket by bracket.
"""

from __future__ import annotations

# --- fixed values: the command contract --------------------------------------
TRANSFER_FIELDS = {
    "id": "string", "debit_account_id": "string", "credit_account_id": "string",
    "pending_id": "string", "amount": "string", "ledger": "string", "code": "string",
    "flags": "array<string>", "user_data_128": "string",
    "user_data_64": "decimal(38,0)", "user_data_32": "decimal(38,0)", "timeout": "string",
}
ACCOUNT_FIELDS = {
    "id": "string", "ledger": "string", "code": "string", "flags": "array<string>",
    "user_data_128": "string", "user_data_64": "decimal(38,0)", "user_data_32": "decimal(38,0)",
}
ROOT_FIELDS = ("operation", "transfers", "accounts")
# -----------------------------------------------------------------------------


def struct_type(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"


TRANSFERS_TYPE = f"array<{struct_type(TRANSFER_FIELDS)}>"
ACCOUNTS_TYPE = f"array<{struct_type(ACCOUNT_FIELDS)}>"
COMMAND_TYPE = f"struct<error:string,op:string,transfers:{TRANSFERS_TYPE},accounts:{ACCOUNTS_TYPE}>"

_SCHEMA_OF = {
    "string": "(?:STRING|VOID)",
    "array<string>": "(?:VOID|ARRAY<(?:STRING|VOID)>)",
    "decimal(38,0)": r"(?:BIGINT|VOID|DECIMAL\([0-9]+,0\))",
}


def _object(fields: dict[str, str]) -> str:
    body = "".join(f"(?:{n}: {fields[n]}(?:, )?)?" for n in sorted(fields))
    return f"(?:VOID|OBJECT<{body}>)"


def _elements(fields: dict[str, str]) -> str:
    return f"(?:VOID|ARRAY<{_object({n: _SCHEMA_OF[t] for n, t in fields.items()})}>)"


DOCUMENT = "^ARRAY<ARRAY<" + _object({
    "operation": _SCHEMA_OF["string"],
    "transfers": _elements(TRANSFER_FIELDS),
    "accounts": _elements(ACCOUNT_FIELDS),
}) + r">>\z"
# nesting of a document that has the contract's schema
CONTRACT_DEPTH = 4


def outside_strings(doc_text: str) -> str:
    """The document without its string contents (two flat passes, no backtracking)."""
    unescaped = rf"regexp_replace({doc_text}, r'(?s)\\.', '')"
    return rf"regexp_replace({unescaped}, r'\"[^\"]*(?:\"|\z)', '')"


def nesting(skeleton: str) -> str:
    """``struct<now, top, low>``: bracket depth at the end, highest and lowest."""
    step = "case when c in ('{', '[') then 1 when c = '' then 0 else -1 end"
    return (
        f"aggregate(split(regexp_replace({skeleton}, r'[^\\[\\]{{}}]+', ''), ''),"
        f" named_struct('now', 0, 'top', 0, 'low', 0),"
        f" (s, c) -> named_struct('now', s.now + {step}, 'top', greatest(s.top, s.now + {step}),"
        f" 'low', least(s.low, s.now + {step})))"
    )


def parse_document(doc_text: str) -> str:
    """The document inside two arrays, so that trailing data shows."""
    return f"try_parse_json(concat('[[', {doc_text}, ']]'))"


def single(doc: str) -> str:
    """True when a wrapped document holds exactly one value."""
    return (
        f"coalesce(size(try_cast({doc} as array<variant>)) = 1"
        f" and size(try_variant_get({doc}, '$[0]', 'array<variant>')) = 1, false)"
    )


def doubtful(doc_text: str) -> str:
    """True when only a scan outside strings can tell that a document is strict.

    Two closing brackets in a row could close the wrapping arrays early, and a
    fraction or an exponent is not an integer even where its value is one.
    """
    return f"{doc_text} rlike r'\\]\\s*\\]|:\\s*-?[0-9]+[.eE]'"


def contract(doc: str) -> str:
    """True when every field of a wrapped document is known and has its type."""
    return f"coalesce(schema_of_variant({doc}) rlike r'{DOCUMENT}', false)"


def scan_error(skeleton: str, depth: str) -> str:
    """What a scan outside strings finds wrong with a document of the right schema."""
    return (
        f"case when {depth}.low < 0 then 'json: parse error'"
        f" when {skeleton} rlike '[0-9][.eE]' then 'json: value of the wrong type' end"
    )


def unknown_field(doc: str) -> str:
    """Name of the first unknown field; only evaluated for documents already refused."""

    def first(names: str, allowed) -> str:
        known = ", ".join(f"'{n}'" for n in allowed)
        return f"try_element_at(array_except({names}, array({known})), 1)"

    def inside(field: str, allowed) -> str:
        items = f"try_variant_get({doc}, '$[0][0].{field}', 'array<variant>')"
        keys = f"transform({items}, e -> map_keys(try_cast(e as map<string,variant>)))"
        return first(f"flatten(array_compact({keys}))", allowed)

    root = f"map_keys(try_variant_get({doc}, '$[0][0]', 'map<string,variant>'))"
    return (
        f"coalesce({first(root, ROOT_FIELDS)}, {inside('transfers', TRANSFER_FIELDS)},"
        f" {inside('accounts', ACCOUNT_FIELDS)})"
    )


COMMAND = f"struct<operation:string,transfers:{TRANSFERS_TYPE},accounts:{ACCOUNTS_TYPE}>"


def command(doc: str) -> str:
    return f"try_variant_get({doc}, '$[0][0]', '{COMMAND}')"
