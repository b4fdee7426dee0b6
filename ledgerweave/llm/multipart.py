"""Secrets by linking the parts of a credential.

Strict forms (assigned passwords and tokens, access keys, long hexadecimal
numbers) are always secrets. Credentials also come in parts that prove nothing
alone: an identifier, a secret and an endpoint. Each text is cut into scopes at
blank lines; parts are intervals of a scope. A weak part is reported only if
complementary parts stand near it in its scope: parts of both other roles, or a
part of one of them that its own form proves.

The interval join never makes pairs. Starts fall into bins as wide as the reach;
a bin is reduced to the first and last start of each role, handed to itself and
its two neighbours, and every weak part meets one row: all of its own bin is
within reach, of the bin before the last start counts, of the bin after the
first. A scope with any number of parts is spread over its bins.

Offsets are code points, ends exclusive. Null texts count as empty. Equal rows
stay equal rows. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, ship, vectorised, without
from ledgerweave.session import stage

ship(__name__)

#: Proven forms first, then the weak parts.
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
BASE = 3
#: Starts of complementary parts are so many code points apart at most.
REACH = 240

IDENTIFIER, SECRET, ENDPOINT = 0, 1, 2
#: Role of each kind, and whether its form proves it.
ROLES, PROVEN = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, ENDPOINT), (True, True, False, False, False, False)

PART = "struct<kind:int,start:int,end:int,scope:int>"
_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
_IDENT = re.compile(
    r"(?<![A-Za-z0-9])(?:user(?:_?name)?|login|account|client_?id|(?:access_?)?key_?id)[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Za-z0-9@._-]{3,}+", re.I | re.A)
_ENDPOINT = re.compile(
    r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s\"'<>]++"
    r"|(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint)[\"']?+\x20*+[:=]\x20*+[\"']?+[A-Za-z0-9._:/-]{3,}+", re.I | re.A)
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
_MIXED = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
_BLANK = re.compile(r"\n[ \t\r]*+\n")


def proven(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every secret whose form proves it, ascending. Linear in the text."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _clear(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``spans`` those that overlap none of ``taken``; both ascend."""
    out, i, reach = [], 0, 0
    for a, kind, b in spans:
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][2])
            i += 1
        if reach <= a:
            out.append((a, kind, b))
    return out


def parts(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, scope) of proven secrets and of weak parts, by start and kind."""
    base = proven(text)
    ends = [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    names = _clear([(m.start(), 3, m.end()) for m in _IDENT.finditer(text)], base)
    tokens = [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text) if all(kind.search(m.group()) for kind in _MIXED)]
    tokens = _clear(tokens, sorted([*base, *ends, *names]))
    found = sorted([*base, *ends, *names, *tokens])
    if not found:
        return []
    out, scope, blanks = [], 0, [m.start() for m in _BLANK.finditer(text)]
    for a, kind, b in found:
        while scope < len(blanks) and blanks[scope] < a:
            scope += 1
        out.append((kind, a, b, scope))
    return out


@vectorised(f"array<{PART}>")
def _scan(texts):
    import pandas as pd

    return pd.Series([parts(t) if t else [] for t in texts])


def _near(role: int, seen: str) -> Column:
    """Whether a part of this role (``seen``: any, or proven) starts within reach of the weak part's start."""
    name, start = f"{seen}_{role}", F.col("start")
    return F.col(f"own_{name}") | (start - F.col(f"last_{name}") <= REACH) | (F.col(f"first_{name}") - start <= REACH)


def _linked(scan: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the weak parts that have their complements."""
    flat = scan.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    of = lambda table: F.element_at(F.array(*map(F.lit, table)), F.col("kind") + 1)
    flat = flat.select("*", of(ROLES).alias("role"), of(PROVEN).alias("sure"), F.floor(F.col("start") / REACH).alias("bin"))
    bins = flat.groupBy("row", "scope", "bin", "role", "sure").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    sent = bins.select("*", F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)])).alias("by")).withColumn("bin", F.col("bin") + F.col("by"))
    wanted = []
    for role in (IDENTIFIER, SECRET, ENDPOINT):
        for seen, test in (("any", F.lit(True)), ("proven", F.col("sure"))):
            mine = (F.col("role") == role) & test
            wanted += [F.coalesce(F.max(mine & (F.col("by") == 0)), F.lit(False)).alias(f"own_{seen}_{role}"),
                       F.coalesce(F.max(F.when(mine & (F.col("by") == 1), F.col("high"))), F.lit(-2 * REACH)).alias(f"last_{seen}_{role}"),
                       F.coalesce(F.min(F.when(mine & (F.col("by") == -1), F.col("low"))), F.lit(2 ** 40)).alias(f"first_{seen}_{role}")]
    around = sent.groupBy("row", "scope", "bin").agg(*wanted)
    met = flat.where(F.col("kind") >= BASE).join(around, ["row", "scope", "bin"])
    rule = F.lit(False)
    for role in (IDENTIFIER, SECRET, ENDPOINT):
        a, b = (r for r in (IDENTIFIER, SECRET, ENDPOINT) if r != role)
        complete = (_near(a, "any") & _near(b, "any")) | _near(a, "proven") | _near(b, "proven")
        rule = rule | ((F.col("role") == role) & complete)
    return met.where(rule).select("row", "kind", "start", "end")


def find(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with secrets_base and secrets, arrays of (kind, start, end) by start, then kind as in KINDS.

    secrets_base has the proven secrets; secrets has them and the linked parts.
    Without ``keep_text`` the column ``text`` is left out of the written table and the result.
    """
    batches_of(docs.sparkSession)
    docs = without(docs, "secrets", "secrets_base")
    columns = [c for c in docs.columns if keep_text or c != text]
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    scan = stage(docs.select(*kept, _scan(F.col(f"`{text}`").cast("string")).alias("parts"), F.monotonically_increasing_id().alias("row")), "multipart-scan")
    more = _linked(scan).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    more = stage(more, "multipart-linked")
    base = F.transform(F.filter("parts", lambda p: p.kind < BASE), lambda p: F.struct(p.start.alias("start"), p.kind.alias("kind"), p.end.alias("end")))
    ordered = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    both = F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return (scan.withColumn("base", base).join(more, "row", "left")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], ordered(F.col("base")).alias("secrets_base"), ordered(both).alias("secrets")))


def digest(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
