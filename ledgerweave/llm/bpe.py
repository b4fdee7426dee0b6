"""BPE encoding with content-defined chunks that documents share, and decoding.

A rolling hash over the last four bytes decides after which white space a text
is cut, so equal passages are cut alike wherever they stand. Each task encodes a
chunk once, whatever the number of its documents that share it, into a store of
bounded size; nothing is shuffled. New chunks of plain letters, digits and signs
share a second store, of the pieces that the tokenizer's own splitting makes of
them: only new pieces go through the merges. A document's ids are its chunks' ids
one after another. Every kind of join (the two characters that meet) is tried when
it first occurs, by encoding the two chunks as one text; where that disagrees,
chunks are merged with their neighbours and encoded again until the ids on both
sides agree.

Results equal those of the tokenizers library on the whole text, with
add_special_tokens=False and without truncation or padding. Null texts count as
empty and have no ids. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Shared, batches_of, ship, vectorised, without

ship(__name__)

#: Chunks a task keeps, about, and pieces; beyond it the store is emptied.
KEPT = 400_000

#: The preparation of texts whose pieces ``Encoder`` finds by itself in plain chunks; those of other tokenizers are encoded whole.
_PREPARED = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Printable ASCII without "<", where added tokens begin, white space, and the letters U+00C0 to U+00FF: nothing here is composed.
_PLAIN = re.compile(rb"(?:[\t-\r -;=-~]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*+")
#: The pattern of ``_PREPARED`` on plain chunks in lower case, with "<" between them.
_PIECES = re.compile("<|'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\t-\r 0-9<a-z\xdf-\xf6\xf8-\xff]+")



def cut(text: str) -> tuple[bytes, list[int], np.ndarray]:
    """The text as UTF-8, where its chunks end, and the kind of each join: the last byte before it and
    the first character after it, packed. Linear in the text."""
    raw = text.encode("utf-8", "surrogatepass")
    x = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero((x == 32) | ((x >= 9) & (x <= 13))) + 1
    rolled = np.zeros(len(ends), np.uint32)
    for back in (4, 3, 2, 1):
        at = ends - back
        rolled = rolled * np.uint32(0x01000193) + np.where(at >= 0, x[np.maximum(at, 0)], 0).astype(np.uint32)
    ends = ends[(rolled >> np.uint32(7)) % 16 != 0]
    joins = ends[ends < len(raw)]
    first = x[joins].astype(np.int64)
    kinds = (x[joins - 1].astype(np.int64) << 32) | first
    wide = np.flatnonzero(first >= 0xC0)  # two to four bytes
    for back in (1, 2, 3):
        more = wide[first[wide] >= (0xC0, 0xE0, 0xF0)[back - 1]]
        kinds[more] |= x[joins[more] + back].astype(np.int64) << (8 * back)
    return raw, [*joins.tolist(), len(raw)], kinds


def chunks(text: str) -> list[bytes]:
    """The text's chunks as UTF-8; joined they are the text."""
    raw, ends, _ = cut(text)
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Encoder:
    """Encodes whole texts with a store of chunks and of tried joins. Ids are kept as 32-bit numbers in bytes."""

    def __init__(self, definition: str) -> None:
        self.definition = definition

    def open(self) -> Encoder:
        import os

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        self.tokenizer = Tokenizer.from_str(self.definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.store: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        spelled = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: spelled(chr(c))[0][0] for c in range(0xC0, 0x100)}  # as the merges know them
        known = json.loads(self.definition)
        self.plain = all(known.get(k) == v for k, v in _PREPARED.items()) and not known.get("post_processor") and all(
            t["content"].startswith("<") and not t["normalized"] for t in known["added_tokens"])
        self.joins: dict[int, bool] = {}
        return self

    def whole(self, raw: list[bytes]) -> list[bytes]:
        texts = [r.decode("utf-8", "surrogatepass") for r in raw]
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)  # without offsets where it can
        return [array("i", e.ids).tobytes() for i in range(0, len(texts), 2000)
                for e in batch(texts[i:i + 2000], add_special_tokens=False)]

    def _new(self, raw: list[bytes]) -> list[bytes]:
        """Ids of chunks that are not in the store: of plain ones piece by piece, of others whole."""
        if not self.plain:
            return self.whole(raw)
        plain = raw if _PLAIN.fullmatch(b" ".join(raw)) else [r for r in raw if _PLAIN.fullmatch(r)]
        if not plain:
            return self.whole(raw)
        found = _PIECES.findall(b"<".join(plain).decode().lower())
        if len(self.pieces) > KEPT:
            self.pieces.clear()
        pieces, merge = self.pieces, self.tokenizer.model.tokenize
        for p in set(found).difference(pieces):
            pieces[p] = array("i", [t.id for t in merge(p if p.isascii() else p.translate(self.letters))]).tobytes()
        pieces["<"] = array("i", [-1]).tobytes()
        ids = b"".join(map(pieces.__getitem__, found))
        ends = (np.flatnonzero(np.frombuffer(ids, np.int32) == -1) * 4).tolist()
        of = [ids[a + 4:b] for a, b in zip([-4, *ends], [*ends, len(ids)], strict=True)]
        if len(plain) == len(raw):
            return of
        known = dict(zip(plain, of, strict=True))
        others = [r for r in raw if r not in known]
        known.update(zip(others, self.whole(others), strict=True))
        return [known[r] for r in raw]

    def _agrees(self, left: bytes, right: bytes) -> bool:
        """Whether the join leaves the ids of both sides as they are."""
        a, b, both = self.whole([left, right, left + right])
        return a + b == both

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        kinds, pieces = [], []
        for t in texts:
            raw, ends, kind = cut(t) if t else (b"", [], np.empty(0, np.int64))
            pieces.append([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)])
            kinds.append(kind)
        if len(self.store) > KEPT:
            self.store.clear()
        store = self.store
        new = list(set().union(*pieces).difference(store))
        store.update(zip(new, self._new(new), strict=True))
        out = []
        for found, kind in zip(pieces, kinds, strict=True):
            some, where = np.unique(kind, return_index=True)
            for k, i in zip(some.tolist(), where.tolist(), strict=True):
                if k not in self.joins:
                    self.joins[k] = self._agrees(found[i], found[i + 1])
            bad = [k for k in some.tolist() if not self.joins[k]]
            if bad:
                ids = self._repaired(found, set((np.flatnonzero(np.isin(kind, bad)) + 1).tolist()))
            else:
                ids = b"".join(map(store.__getitem__, found))
            out.append(np.frombuffer(ids, np.int32))
        return out

    def _repaired(self, found: list[bytes], broken: set[int]) -> bytes:
        """Merge across the joins that disagree; try the joins of what came out until all agree."""
        while broken:
            merged: list[bytes] = []
            for i, c in enumerate(found):
                if i in broken:
                    merged[-1] += c
                else:
                    merged.append(c)
            found = merged
            parts = self.whole(found)
            pairs = self.whole([a + b for a, b in zip(found, found[1:], strict=False)])
            broken = {i + 1 for i, both in enumerate(pairs) if parts[i] + parts[i + 1] != both}
        return b"".join(self.whole(found))


def encode(docs: DataFrame, path: str, text: str = "text", and_decode: bool = False) -> DataFrame:
    """``docs`` with token_ids, the ids of the tokenizer file at ``path`` for each whole text; with
    ``and_decode`` also with decoded, as ``decode`` would add it, in the same pass."""
    batches_of(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    shared = Shared(docs.sparkSession, Encoder(definition))

    def run(batches):
        import pandas as pd

        encoder = shared.value.open()
        for texts in batches:
            whole, out, back = list(texts), [], []
            for i in range(0, len(whole), 250):
                ids = encoder.encode(whole[i:i + 250])
                out += ids
                back += [encoder.tokenizer.decode(x.tolist(), skip_special_tokens=False) if and_decode else None for x in ids]
            yield pd.DataFrame({"token_ids": out, "decoded": pd.Series(back, dtype=object)})

    udf = F.pandas_udf(run, "token_ids array<int>, decoded string", F.PandasUDFType.SCALAR_ITER)
    coded = without(docs, "token_ids", *(["decoded"] if and_decode else [])).withColumn("_coded", udf(F.col(f"`{text}`")))
    more = [F.col("_coded.token_ids").alias("token_ids")] + [F.col("_coded.decoded").alias("decoded")] * and_decode
    return coded.select(*[F.col(f"`{c}`") for c in coded.columns if c != "_coded"], *more)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with decoded, the tokenizer's text for token_ids, special tokens included."""
    with open(path, encoding="utf-8") as f:
        shared = Shared(encoded.sparkSession, f.read())

    def run(batches):
        import pandas as pd
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        for ids in batches:
            yield pd.Series([tokenizer.decode([] if i is None else i.tolist(), skip_special_tokens=False) for i in ids], dtype=object)

    udf = F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)
    return without(encoded, "decoded").withColumn("decoded", udf("token_ids"))
