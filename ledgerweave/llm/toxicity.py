"""Toxicity by two Kneser-Ney language models, one for toxic and one for ordinary documents.

Words are spelt by both models letter by letter (UTF-8 bytes), each letter
after up to six letters of its word, so that an unseen form of a known
expression is still recognised. Each class has its own discounted counts for
the longest context that was seen; what the discount leaves goes to one model
that both classes share, an interpolated Kneser-Ney model over the counts of
both, whose lower orders count distinct continuations. Where a class has too
few counts to speak, both give the same probability and the ratio is neutral.
A document's evidence is the difference of its two log-likelihoods divided by
its number of words. One logistic curve, fitted on labelled documents that the
models have not counted, turns it into a score.

Only labelled rows are learnt from, and of each class at most ``per_class``
(those with the smallest hash of their id), which bounds the models. Every
document is scored over its whole text.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Shared, batches_of, runs, ship, without, words
from ledgerweave.session import stage

ship(__name__)

#: Labelled rows learnt from, in each class. The bound that keeps the models small.
PER_CLASS = 4000
#: One in so many of the sampled rows calibrates instead of being counted.
CALIBRATE_ONE_IN = 3
#: Letters of an n-gram, the predicted one included: 7 bytes and the order fit into 64 bits.
ORDER = 7
#: What the shared backoff takes from every count of a class, and from its own counts.
CLASS_DISCOUNT, SHARED_DISCOUNT = 1.5, 0.75
#: A letter's log ratio counts as far as it exceeds this: the classes must differ by a factor of
#: e^LEAST_RATIO, since smaller differences between frequent letters are noise of the sample.
LEAST_RATIO = 1.0
#: N-grams seen fewer times in both classes together are left to the shared counts.
LEAST_SEEN = 2
_LOW = (1 << 56) - 1


def grams(spelt: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 1: the packed n-gram that ends at each letter, whether it is
    inside its word, and the index of the word. A word is its letters between a space and a line feed."""
    text = np.frombuffer(b"".join(b" %b\n" % w for w in spelt), np.uint8)
    sizes = np.fromiter((len(w) + 2 for w in spelt), np.int64, len(spelt))
    of = np.repeat(np.arange(len(spelt)), sizes)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, packed = [], text.astype(np.int64)
    for k in range(1, ORDER + 1):
        if k > 1:
            shifted = np.zeros(len(text), np.int64)
            shifted[k - 1:] = text[: max(0, len(text) - k + 1)]
            packed = packed | (shifted << (8 * (k - 1)))
        out.append((packed | (k << 56), (inside >= k - 1) & (inside > 0), of))
    return out


class Model:
    """What the two class models say of a letter in its context, as logarithms of their ratio."""

    def __init__(self, contexts: np.ndarray, keys: np.ndarray, ratio: np.ndarray) -> None:
        self.contexts, self.keys, self.ratio = contexts, keys, ratio  # the first two ascending
        self.slope, self.shift = 1.0, 0.0
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def spell(self, spelt: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) for each word."""
        levels = grams(spelt)
        out = np.zeros(len(spelt))
        open_ = np.flatnonzero(levels[0][1])
        for k in range(ORDER, 0, -1):
            packed, inside, of = levels[k - 1]
            at = open_[inside[open_]] if k > 1 else open_
            context = ((packed[at] & _LOW) >> 8) | ((k - 1) << 56)
            seen = _member(self.contexts, context) >= 0
            at = at[seen]
            place = _member(self.keys, packed[at])
            np.add.at(out, of[at], np.where(place >= 0, self.ratio[place], 0.0))
            mark = np.zeros(len(packed), bool)
            mark[at] = True
            open_ = open_[~mark[open_]]
        return out

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Mean of ``spell`` over the words of each text; 0 without words."""
        out = np.zeros(len(texts))
        for a, b in runs((len(t or "") for t in texts), 1_000_000):
            docs = [words(t) for t in texts[a:b]]
            if len(self.known) > 200_000:  # what is kept for speed stays small
                self.known = {}
            new = sorted(set().union(*docs).difference(self.known))
            for i, j in runs((len(w) for w in new), 100_000) if new else ():
                self.known.update(zip(new[i:j], self.spell(new[i:j]).tolist(), strict=True))
            known = self.known
            for i, found in enumerate(docs, a):
                if found:
                    out[i] = sum(map(known.__getitem__, found)) / len(found)
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence(texts) + self.shift, -40, 40)))


def _member(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The index of each wanted value in an ascending array, or -1."""
    if not len(ordered):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def _counted(batches):
    """How many documents of each class hold each n-gram's word, for every n-gram, with repeats inside words."""
    import pandas as pd

    for pdf in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
            counts[int(toxic)].update(set(words(text)))
        spelt = sorted(counts[0].keys() | counts[1].keys())
        for a, b in runs((len(w) for w in spelt), 150_000) if spelt else ():
            n = np.array([[c[w] for w in spelt[a:b]] for c in counts])
            found = [(packed[ok], of[ok]) for packed, ok, of in grams(spelt[a:b])]
            gram, back = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            of = np.concatenate([o for _, o in found])
            yield pd.DataFrame({"gram": gram} | {f"n{c}": np.bincount(back, n[c][of], len(gram)).astype(np.int64) for c in (0, 1)})


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on documents (doc_id, text) and their labels (doc_id, toxic): a bounded sample, see the module.

    Rows whose label is neither 0 nor 1 or whose id is null are left out, of
    repeated ids the larger label holds; null texts count as empty. Without words
    of both classes every document gets the same score.
    """
    spark = docs.sparkSession
    batches_of(spark)
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    ids = F.broadcast(stage(chosen[0].union(chosen[1]), "toxic-ids"))  # 2 * per_class rows at most
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(CALIBRATE_ONE_IN)) == 0
    # a text that was copied counts once
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    sample = stage(sample.groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).withColumn("held", held), "toxic-sample")
    at_once = 2 * spark.sparkContext.defaultParallelism
    counts = stage(sample.where(~F.col("held")).repartition(at_once).mapInPandas(_counted, "gram long, n0 long, n1 long")
                   .groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxic-grams")
    order_of = F.shiftright("gram", 56)
    context = F.shiftright(F.col("gram").bitwiseAND(F.lit(_LOW)), 8).bitwiseOR(F.shiftleft(order_of - 1, 56))
    kept = [F.sum(F.greatest(F.col(f"n{c}") - CLASS_DISCOUNT, F.lit(0.0))).alias(f"kept{c}") for c in (0, 1)]
    contexts = (counts.groupBy(context.alias("context")).agg(*[F.sum(f"n{c}").alias(f"total{c}") for c in (0, 1)], *kept)
                .where(F.col("total0") + F.col("total1") >= LEAST_SEEN).toArrow())
    contexts = contexts.sort_by("context")
    stored = counts.where(F.col("n0") + F.col("n1") >= LEAST_SEEN).toArrow().sort_by("gram")
    model = _ratios(contexts, stored)
    tried = _with_evidence(sample.where("held").repartition(at_once), Shared(spark, model)).toArrow()
    model.slope, model.shift = _logistic(tried["evidence"].to_numpy(), tried["toxic"].to_numpy().astype(float))
    return model


def _ratios(contexts, stored) -> Model:
    keys, n = stored["gram"].to_numpy(), np.stack([stored[f"n{c}"].to_numpy().astype(float) for c in (0, 1)], 1)
    contexts = {name: contexts[name].to_numpy() for name in contexts.column_names}
    size = len(contexts["context"])
    order = keys >> 56
    first = (keys & _LOW) >> (8 * (order - 1))
    of = _member(contexts["context"], ((keys & _LOW) >> 8) | ((order - 1) << 56))
    suffix = _member(keys, (keys & ((1 << (8 * (order - 1))) - 1)) | ((order - 1) << 56))
    continued = np.bincount(suffix[suffix >= 0], minlength=len(keys))
    counted = np.where((order == ORDER) | (first == 32), n.sum(1), continued)
    shared = np.zeros(len(keys))
    for k in range(1, ORDER + 1):
        here = np.flatnonzero(order == k)
        lower = shared[suffix[here]] if k > 1 else np.full(len(here), 1 / 256)
        total = np.bincount(of[here], counted[here], size)
        cut = np.minimum(counted[here], SHARED_DISCOUNT)
        given = np.bincount(of[here], cut, size)
        base = np.maximum(total[of[here]], 1e-9)
        shared[here] = (counted[here] - cut + given[of[here]] * lower) / base
    shared = np.maximum(shared, 1e-9)
    by_class = []
    for c in (0, 1):
        total = contexts[f"total{c}"][of]
        left = 1 - contexts[f"kept{c}"][of] / np.maximum(total, 1)
        by_class.append(np.maximum(n[:, c] - CLASS_DISCOUNT, 0) / np.maximum(total, 1) + left * shared)
    ratio = np.log(by_class[1]) - np.log(by_class[0])
    ratio = np.sign(ratio) * np.maximum(np.abs(ratio) - LEAST_RATIO, 0)
    return Model(contexts["context"], keys, ratio)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(toxic | x) with both classes weighted alike, by Newton's steps with a small ridge.

    With no row of one class the curve is steep around a fixed small evidence."""
    if not (y == 1).any() or not (y == 0).any():
        return 100.0, -2.0
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones_like(x)], 1)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    b, ridge = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -40, 40)))
        g = z.T @ (weight * (p - y)) + ridge * b
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0] / scale), 0.0), float(b[1])


def _with_evidence(df: DataFrame, model: Shared) -> DataFrame:
    """toxic and the evidence of the column text."""
    def run(batches):
        for pdf in batches:
            yield pdf[["toxic"]].assign(evidence=model.value.evidence(list(pdf["text"])))

    return df.select("text", F.col("toxic").cast("long")).mapInPandas(run, "toxic long, evidence double")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column toxic_score (0 to 1); null and empty texts are judged by no evidence.

    A column of that name is replaced. One narrow pass, nothing is shuffled.
    """
    batches_of(docs.sparkSession)
    shared = Shared(docs.sparkSession, model)
    docs = without(docs, "toxic_score")

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series(shared.value.score(list(texts)))

    return docs.withColumn("toxic_score", scored(F.col(f"`{text}`")))
