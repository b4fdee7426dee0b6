"""Personal data by bootstrapped contextual extraction.

Entities that a strict form proves (e-mail, IPv4 address, card number, phone
number) are seeds. The word before and the word after each seed are lexical
patterns; where a seed is glued to a word (tel:020..., or a number and its comma),
the part of the word beside it is one, as the beginning or the end of a word.
Patterns and instances (identifier-like strings) form a graph that Spark scores
in rounds: a pattern's confidence in a kind is the weight of that kind's instances
it surrounds over all occurrences of its word, beginning or end in the corpus;
an instance that is no seed gets, for each kind its form allows, the
probability that at least one of its trusted patterns is right. Instances above
the threshold are accepted with that weight: in the next round they induce
patterns as seeds do, so each round reaches one context further. What the last
round accepts is personal data wherever it occurs.

Offsets are code points, ends exclusive. Null texts count as empty. Columns of
the input named like a result are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, ship, vectorised, without, word_counts
from ledgerweave.session import stage

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
#: Rounds of the pattern-instance graph: from the seeds, so many contexts far.
ROUNDS = 3
#: A pattern counts for a kind if it surrounds so many different seeds or accepted instances of it.
LEAST_SEEDS = 3
#: From this score on an instance is personal data.
ACCEPT = 0.5
#: Added to a pattern's occurrences: a few are not yet proof.
SMOOTHING = 2.0

SPAN = "struct<kind:int,start:int,end:int,value:string,before:binary,after:binary,glued:tinyint>"
_AFTER_AT = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What may be an identifier of some kind: something around an @, or a run of at least six digits.
_LIKE = re.compile(r"(?<![^\s<(\[\"',;:])[^\s<>()\[\]\"',;:@]{1,64}@[^\s<>()\[\]\"',;:@]{2,255}|(?<![\w@.+-])[(+]?[0-9](?:[ ().-]{0,2}[0-9]){5,}(?![\w@])")
_NEAR = re.compile(r"[^ \t-\r]+")
#: Sides of a pattern: before and after, as a word of its own or glued to the instance.
BEFORE, AFTER, GLUED = 0, 1, 2
_SPACE = " \t\n\x0b\x0c\r"
#: What may stand directly before and directly after an identifier-like string.
_OPENS, _CLOSES = re.compile(r"[^\w@.+-]"), re.compile(r"\W")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def proven(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every entity whose form proves it, ascending. Linear in the text."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _AFTER_AT.match(text, at + 1)):
            end = m.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _beside(text: str, start: int, end: int) -> tuple[bytes, bytes, int]:
    """The nearest words before and after, at most 64 characters away; empty where there is none. Last, which of them are
    parts of words that are glued to text[start:end]: bit 0 before, bit 1 after."""
    left = _NEAR.findall(text, max(0, start - 64), start)
    right = _NEAR.search(text, end, end + 64)
    return (left[-1].encode("utf-8", "replace").lower() if left else b"", right.group().encode("utf-8", "replace").lower() if right else b"",
            (start > 0 and text[start - 1] not in _SPACE) + 2 * (end < len(text) and text[end] not in _SPACE))


def _spans(text: str) -> list[tuple]:
    """Proven entities, and identifier-like strings (kind -1) that touch none of them."""
    base = proven(text)
    out = [(k, a, b, text[a:b], *_beside(text, a, b)) for a, k, b in base]
    i, reach = 0, 0
    for m in _LIKE.finditer(text):
        a, b = m.span()
        while i < len(base) and base[i][0] < b:
            reach = max(reach, base[i][2])
            i += 1
        if reach <= a:
            out.append((-1, a, b, m.group(), *_beside(text, a, b)))
    return out


@vectorised(f"array<{SPAN}>")
def _scan(texts):
    import pandas as pd

    return pd.Series([_spans(t) if t else [] for t in texts])


def _occurrences(batches):
    """(side, word, n): words as BEFORE, their beginnings and ends that may be glued to an instance as GLUED + BEFORE and AFTER."""
    import pandas as pd

    for pdf in word_counts(batches):
        parts: Counter = Counter()
        for word, n in zip(pdf["word"], pdf["n"], strict=True):
            if word.isalnum():
                continue
            w = word.decode("utf-8", "replace")
            for m in _OPENS.finditer(w, 0, min(64, len(w) - 1)):
                parts[GLUED + BEFORE, w[:m.end()]] += n
            for m in _CLOSES.finditer(w, max(1, len(w) - 64)):
                parts[GLUED + AFTER, w[m.start():]] += n
        yield pd.concat([pdf.assign(side=BEFORE), pd.DataFrame(
            {"word": [w.encode() for _, w in parts], "n": list(parts.values()), "side": [s for s, _ in parts]})])[["side", "word", "n"]]


def _fits() -> Column:
    """Kinds that the form of an instance allows."""
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    return F.when(F.col("value").contains("@"), F.array(F.lit(0))).otherwise(F.filter(F.array(
        F.when(F.col("value").rlike(r"^[0-9]+([.][0-9]+){3}$"), 1), F.when(digits.between(12, 19), 2), F.when(digits.between(7, 15), 3)),
        lambda k: k.isNotNull()))


def _discovered(scan: DataFrame, counts: DataFrame) -> DataFrame:
    """(value, kind) of instances that are no seeds and whose patterns speak for a kind."""
    seen = scan.select(F.explode("found").alias("s")).select("s.kind", "s.value", "s.before", "s.after", F.col("s.glued").cast("int").alias("glued"))
    side = lambda of, bit: (of + GLUED * F.col("glued").bitwiseAND(bit) / bit).cast("int").alias("side")
    sides = F.explode(F.array(F.struct(side(BEFORE, 1), F.col("before").alias("word")), F.struct(side(AFTER, 2), F.col("after").alias("word"))))
    edges = seen.select("kind", "value", sides.alias("p")).select("kind", "value", "p.*").where("length(word) > 0")
    edges = stage(edges.groupBy("kind", "value", "side", "word").agg(F.count("*").alias("n")), "pii-edges")
    # a word of its own is counted once for both sides
    counted = F.when(F.col("side") < GLUED, BEFORE).otherwise(F.col("side")).alias("counted")
    occurs = counts.select(F.col("side").alias("counted"), "word", F.col("n").alias("occurs"))
    # merged at every size: the words beside instances grow with the corpus, so they are no broadcast
    occurs = stage(occurs.join(edges.select(counted, "word").distinct().hint("merge"), ["counted", "word"], "left_semi"), "pii-occurs")
    proof = seeds = edges.where("kind >= 0").withColumn("score", F.lit(1.0))
    open_ = stage(edges.where("kind < 0").withColumn("kind", F.explode(_fits())), "pii-open")
    accepted = None
    for _ in range(ROUNDS):
        if accepted is not None:
            proof = seeds.unionByName(open_.join(accepted, ["value", "kind"]))
        patterns = proof.groupBy("side", "word", "kind").agg(F.countDistinct("value").alias("members"), F.sum(F.col("n") * F.col("score")).alias("weight"))
        patterns = patterns.where(F.col("members") >= LEAST_SEEDS).select("*", counted).join(occurs, ["counted", "word"], "left")
        total = F.greatest("weight", F.coalesce("occurs", F.lit(0)))
        trust = F.least(F.lit(0.999), F.col("weight") / (total + SMOOTHING)).alias("trust")
        scores = open_.join(patterns.select("side", "word", "kind", trust), ["side", "word", "kind"]).groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
        best = scores.where(F.col("score") >= ACCEPT).groupBy("value").agg(F.min(F.struct((-F.col("score")).alias("minus"), "kind")).alias("best"))
        accepted = stage(best.select("value", "best.kind", (-F.col("best.minus")).alias("score")), "pii-accepted")
    return accepted.select("value", "kind")


def extract(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with pii_base and pii, arrays of (kind, start, end) by start, then kind as in KINDS.

    pii_base has the proven entities; pii has them and the discovered ones. Without
    ``keep_text`` the column ``text`` is left out of the written tables and the result.
    Equal rows stay equal rows; a text without personal data has empty arrays.
    """
    batches_of(docs.sparkSession)
    docs = without(docs, "pii", "pii_base")
    columns = [c for c in docs.columns if keep_text or c != text]
    kept = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")
    scan = stage(docs.select(kept, _scan(F.col(f"`{text}`")).alias("found")).withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    counts = (docs.select(F.col(f"`{text}`").alias("text")).mapInPandas(_occurrences, "side int, word binary, n long")
              .groupBy("side", "word").agg(F.sum("n").alias("n")))
    unknown = scan.select("row", F.explode("found").alias("s")).where("s.kind < 0").select("row", "s.value", "s.start", "s.end")
    found = unknown.join(_discovered(scan, counts), "value")
    found = stage(found.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")), "pii-found")
    base = F.transform(F.filter("found", lambda s: s.kind >= 0), lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    ordered = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    both = F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return (scan.withColumn("base", base).join(found, "row", "left")
            .select(*[F.col(f"doc.`{c}`") for c in columns], ordered(F.col("base")).alias("pii_base"), ordered(both).alias("pii")))


def digest(spans: str | Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


@vectorised("string")
def _masked(texts, spans):
    import pandas as pd

    out = []
    for text, found in zip(texts, spans, strict=True):
        if found is None or not len(found):
            out.append(text)
            continue
        parts, at = [], 0
        for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
            if s["end"] > at:  # overlapping spans share one mask
                if s["start"] >= at:
                    parts += [text[at:s["start"]], f"[{KINDS[s['kind']]}]"]
                at = s["end"]
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out, dtype=object)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; null stays null."""
    found = extract(docs, text)
    return found.withColumn(text, _masked(F.col(f"`{text}`"), "pii")).drop("pii", "pii_base")
