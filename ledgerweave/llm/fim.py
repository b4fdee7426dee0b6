"""Fill-in-the-middle transformation; cuts are found through a learned rank index.

A cut is a number of code points, but texts are UTF-8. The index maps ranks of
code points to byte offsets: over the boundary offsets of all code points of a
block of texts, error-bounded linear segments are fitted greedily (the cone of
slopes that keep every offset within ``ERROR``), and what the prediction of each
boundary misses is stored in one byte. A cut's offset is predicted from its
segment and corrected by its residual, which makes it exact. The fit takes time
in proportion to the bytes; a segment is found by galloping, so plain ASCII is
one segment.

The two cuts and the form come from the sha256 of the seed and the id. Marks: a
text that is empty or already holds one of them stays plain. Null texts count as
empty, a null id as the empty text. Equal rows stay equal rows. Columns of the
input named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, id_text, runs, ship, without

ship(__name__)

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A prediction misses a boundary by so many bytes at most; with rounding it fits one byte.
ERROR = 63
#: Bytes of text that are indexed at once; a longer text is a block of its own.
BLOCK = 4 << 20


@dataclass
class RankIndex:
    """Segments (first rank, its offset, slope) and a residual for every boundary."""

    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, ranks: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return self.offset[segment] + np.rint(self.slope[segment] * (ranks - self.first[segment])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of boundaries given by rank."""
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return self.predict(ranks, segment) + self.residual[ranks]


def fit(boundaries: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index over ascending offsets; their ranks are their places."""
    first, slopes, n, start = [], [], len(boundaries), 0
    residual = np.empty(n, np.int8)
    while start < n:
        low, high, end, step = -np.inf, np.inf, start + 1, 64
        while end < n:
            stop = min(n, end + step)
            far = np.arange(end - start, stop - start)
            up = boundaries[end:stop] - boundaries[start]
            lows = np.maximum(np.maximum.accumulate((up - error) / far), low)
            highs = np.minimum(np.minimum.accumulate((up + error) / far), high)
            if lows[-1] > highs[-1]:  # the cone closes somewhere in here, and stays closed
                cut = int(np.argmax(lows > highs))
                if cut:
                    low, high = lows[cut - 1], highs[cut - 1]
                end += cut
                break
            low, high, end, step = lows[-1], highs[-1], stop, step * 2
        slope = (low + high) / 2 if end > start + 1 else 0.0
        guess = np.rint(slope * np.arange(end - start)).astype(np.int64)
        residual[start:end] = boundaries[start:end] - boundaries[start] - guess
        first.append(start)
        slopes.append(slope)
        start = end
    at = np.array(first, np.int64)
    return RankIndex(at, boundaries[at] if n else at, np.array(slopes), residual)


def _cut(texts, low, high, form):
    """The outputs: pieces of the texts between marks, cut at code points ``low`` and ``high``."""
    import pyarrow as pa

    starts = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2] if len(texts) and starts[-1] > starts[0] else None
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low, high = low.to_numpy(zero_copy_only=False), high.to_numpy(zero_copy_only=False)
    forms, out = form.to_pylist(), []
    for i, j in runs(np.diff(starts).tolist(), BLOCK):
        begin = int(starts[i]) if i < len(starts) else 0
        block = whole[begin:int(starts[j])]
        # a code point starts at every byte that continues none; the block's end is a boundary, too
        boundaries = np.append(np.flatnonzero((block & 0xC0) != 0x80), len(block))
        rank = np.searchsorted(boundaries, starts[i:j] - begin)
        index = fit(boundaries)
        del boundaries
        a, b = index.offsets(rank + low[i:j]), index.offsets(rank + high[i:j])
        held = block.tobytes()
        for s, e, p, q, kind in zip((starts[i:j] - begin).tolist(), (starts[i + 1:j + 1] - begin).tolist(), a.tolist(), b.tolist(), forms[i:j], strict=True):
            if kind == "plain":
                out.append(held[s:e])
            elif kind == "psm":
                out.append(b"".join((PREFIX.encode(), held[s:p], SUFFIX.encode(), held[q:e], MIDDLE.encode(), held[p:q])))
            else:
                out.append(b"".join((SUFFIX.encode(), held[q:e], PREFIX.encode(), held[s:p], MIDDLE.encode(), held[p:q])))
    return pa.array(out, pa.string())


def transform(docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 1, cut_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``docs`` with fim_chars, fim_form (plain, psm or spm), fim_prefix_chars, fim_middle_chars and fim_text."""
    batches_of(docs.sparkSession)
    docs = without(docs, "fim_chars", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_text")
    columns = docs.columns
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"),
                       F.sha2(F.concat(F.lit(f"{seed}:"), id_text(f"`{id_column}`")), 256).alias("hash"))
    draw = lambda i: F.conv(F.substring("hash", 8 * i - 7, 8), 16, 10).cast("bigint")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("t").contains(mark)
    kept = kept.withColumn("n", F.char_length("t").cast("bigint"))
    one, two = draw(1) % (F.col("n") + 1), draw(2) % (F.col("n") + 1)
    kept = kept.select(
        "doc", "t", "n", F.least(one, two).alias("low"), F.greatest(one, two).alias("high"),
        F.when((F.col("n") == 0) | marked | (draw(3) % 100 >= cut_percent), "plain").when(draw(4) % 100 < spm_percent, "spm").otherwise("psm").alias("form"))
    cut = F.col("form") != "plain"
    return kept.select(
        *[F.col(f"doc.`{c}`") for c in columns], F.col("n").alias("fim_chars"), F.col("form").alias("fim_form"),
        F.when(cut, F.col("low")).alias("fim_prefix_chars"), F.when(cut, F.col("high") - F.col("low")).alias("fim_middle_chars"),
        F.arrow_udf(_cut, "string")("t", "low", "high", "form").alias("fim_text"))


def restored(output: Column, form: Column) -> Column:
    """The exact text again, from the output and its form alone."""
    part = lambda i: F.get(F.split(output, "<[PSM]>", -1), F.lit(i))
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(1), part(3), part(2))).otherwise(F.concat(part(2), part(3), part(1)))


def oracle() -> str:
    """The digests of the transformed documents in plain SQL."""
    return """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
    h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
      CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
      CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
    c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
      CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
           WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, substring(t, 1, lo) AS a, substring(t, lo + 1, hi - lo) AS m, substring(t, hi + 1, n - hi) AS z FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
             ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
    FROM p"""
