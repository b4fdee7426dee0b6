"""Hidden Markov language model over words.

Tokens are the words of ``common.words`` and one end for each text. Frequent
words (at most ``HEAD``) and the end are classes of their own; every other word
belongs to one of ``TAILS`` classes by its last three bytes. A state emits a
class, a class its words by their training counts, with one unknown word a
class: P(word | state) = P(class | state) * (c + 0.1) / (C + 0.1 * (V + 1)),
where C and V are the class's tokens and distinct words.

States are trained by Baum-Welch: each task runs the scaled forward and
backward recursion over its training documents and returns expected counts for
each class and transition, which Spark sums. All training documents count in
every iteration. The score of a text is the exact log10 likelihood by the scaled
forward recursion over the whole text, its end included.

The counts of the vocabulary stay a Spark table; only the frequent words and
the states' parameters, both bounded, are sent to tasks. Rare words of a text
meet their counts in a join. Null texts count as empty.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Shared, batches_of, runs, ship, word_counts, words
from ledgerweave.session import stage

ship(__name__)

STATES, ITERATIONS = 8, 5
HEAD, TAILS = 1 << 15, 256
#: Added to every count.
ADDED = 0.1
#: Tokens worked on at once in a task.
AT_ONCE = 250_000


@dataclass
class Vocabulary:
    """What tasks need to know of the training words."""

    head: dict[bytes, int]
    head_logs: np.ndarray      # log10(c + ADDED) of the frequent words, then of the end
    tail_logs: np.ndarray      # log10 of each rare class's denominator
    shares: np.ndarray         # of all classes in the training tokens
    tokens: int
    types: int
    documents: int

    @property
    def end(self) -> int:
        return len(self.head) + len(self.tail_logs)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray           # (classes, states)


def _tail(word: Column) -> Column:
    return F.crc32(F.substring(word, -3, 3)) % TAILS


def vocabulary(training: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """Of the column text; and the table (word, n) of the words that are not frequent."""
    counts = stage(training.select("text").mapInPandas(word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    documents = training.count()
    power = F.floor(F.log2("n") * 4)
    sizes = counts.groupBy(power.alias("p")).count().orderBy(F.desc("p")).collect()  # 256 rows at most
    least, total = 1 << 20, 0
    for p, n in sizes:
        if total + n > HEAD:
            break
        least, total = p, total + n
    head = counts.where(power >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    tail = counts.where(power < least)
    found = {int(r["g"]): (r["c"], r["v"]) for r in tail.groupBy(_tail(F.col("word")).alias("g")).agg(F.sum("n").alias("c"), F.count("*").alias("v")).collect()}
    c, v = (np.array([found.get(g, (0, 0))[k] for g in range(TAILS)], float) for k in (0, 1))
    n = np.array([*head["n"].to_pylist(), documents], float)
    shares = np.concatenate([n[:-1], c, n[-1:]]) + ADDED
    return Vocabulary({w: i for i, w in enumerate(head["word"].to_pylist())}, np.log10(n + ADDED), np.log10(c + ADDED * (v + 1)),
                      shares / shares.sum(), int(n.sum() + c.sum()), int(len(n) - (documents == 0) + v.sum()), documents), tail


def _coded(shared: Shared):
    """A text's classes, its number of tokens, what its frequent words add to the scores, and its rare words."""
    def run(batches):
        import pandas as pd

        vocab = shared.value
        get, h, cls, dens = vocab.head.get, len(vocab.head), {}, vocab.tail_logs
        for texts in batches:
            out = []
            for text in texts:
                found = words(text)
                ids = [get(w, -1) for w in found]
                rare = [w for w, i in zip(found, ids, strict=True) if i < 0]
                if len(cls) > 200_000:  # what is kept for speed stays small
                    cls.clear()
                for w in set(rare).difference(cls):
                    cls[w] = zlib.crc32(w[-3:]) % TAILS
                seq = np.array([*ids, vocab.end], np.int32)
                tails = np.array([cls[w] for w in rare], np.int32)
                common = seq[:-1][seq[:-1] >= 0]
                logs = float(vocab.head_logs[common].sum() + vocab.head_logs[-1])
                seq[:-1][seq[:-1] < 0] = tails + h
                out.append((seq.astype(np.uint16).tobytes(), len(seq), logs, len(common) + (vocab.documents > 0), float(dens[tails].sum()), rare))
            yield pd.DataFrame(out, columns=["seq", "n_tokens", "head_logs", "head_known", "tail_dens", "rare"])

    return F.pandas_udf(run, "seq binary, n_tokens long, head_logs double, head_known long, tail_dens double, rare array<binary>", F.PandasUDFType.SCALAR_ITER)


def _groups(seqs):
    """Index arrays over sequences, longest first, of AT_ONCE tokens or one sequence."""
    sizes = np.fromiter((len(s) // 2 for s in seqs), np.int64, len(seqs))
    by = np.argsort(-sizes, kind="stable")
    for a, b in runs(sizes[by].tolist(), AT_ONCE) if len(by) else ():
        yield by[a:b], sizes[by[a:b]]


class Lattice:
    """The scaled recursions over some sequences at once, longest first, one step of all in each move."""

    def __init__(self, seqs: list[bytes], sizes: np.ndarray, model: Model) -> None:
        self.model, self.sizes = model, sizes
        longest = int(sizes[0])
        self.active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
        self.first = np.concatenate([[0], np.cumsum(self.active)])
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.place = self.first[step] + self.of
        self.classes = np.empty(len(step), np.int64)
        self.classes[self.place] = np.frombuffer(b"".join(seqs), np.uint16)
        self.emitted = np.take(model.emit, self.classes, axis=0)

    def forward(self) -> np.ndarray:
        """Natural log likelihood of each sequence."""
        first, move = self.first.tolist(), self.model.move
        self.alpha, self.scale = self.emitted.copy(), np.empty(len(self.classes))
        now = self.alpha[: first[1]]
        now *= self.model.start
        ones = np.ones(move.shape[0])
        for t in range(len(first) - 1):
            a, b = first[t], first[t + 1]
            if t:
                before, now = now, self.alpha[a:b]
                now *= before[: b - a] @ move
            s = self.scale[a:b]
            np.dot(now, ones, out=s)
            now /= s[:, None]
        return np.bincount(self.of, np.log(self.scale)[self.place], len(self.sizes))

    def expected(self, emission: np.ndarray, moves: np.ndarray, start: np.ndarray) -> None:
        """Adds the expected counts; after ``forward``."""
        first, move = self.first.tolist(), self.model.move
        weighted = self.emitted / self.scale[:, None]
        beta = np.ones((first[1], move.shape[0]))
        moved = np.zeros_like(move)
        for t in range(len(first) - 2, -1, -1):
            a, b = first[t], first[t + 1]
            if t + 2 < len(first):
                n = first[t + 2] - b
                ahead = weighted[b: b + n]
                ahead *= beta[:n]
                moved += self.alpha[a: a + n].T @ ahead
                beta[:n] = ahead @ move.T
            self.alpha[a:b] *= beta[: b - a]
        moves += moved * move
        start += self.alpha[: first[1]].sum(0)
        for s, share in enumerate(np.ascontiguousarray(self.alpha.T)):
            emission[:, s] += np.bincount(self.classes, share, len(emission))


def _expected(shared: Shared):
    def run(batches):
        import pandas as pd

        model = shared.value
        states = len(model.start)
        emission, moves, start = np.zeros_like(model.emit), np.zeros((states, states)), np.zeros(states)
        for pdf in batches:
            seqs = list(pdf["seq"])
            for which, sizes in _groups(seqs):
                lattice = Lattice([seqs[i] for i in which], sizes, model)
                lattice.forward()
                lattice.expected(emission, moves, start)
        rows = np.concatenate([emission, moves, start[None]])
        some = np.flatnonzero(rows.any(1))
        yield pd.DataFrame({"g": some} | {f"s{s}": rows[some, s] for s in range(states)})

    return run


def train(coded: DataFrame, vocab: Vocabulary, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over all rows of ``coded`` (seq)."""
    draw = np.random.Generator(np.random.PCG64(3))
    classes = len(vocab.shares)
    emit = vocab.shares[:, None] * np.exp(0.7 * draw.standard_normal((classes, states)))
    model = Model(np.full(states, 1 / states), np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - 0.1 / max(1, states - 1)), emit / emit.sum(0))
    model.move /= model.move.sum(1, keepdims=True)
    names = [f"s{s}" for s in range(states)]
    for _ in range(iterations):
        summed = (coded.select("seq").mapInPandas(_expected(Shared(coded.sparkSession, model)), "g int, " + ", ".join(f"{n} double" for n in names))
                  .groupBy("g").agg(*[F.sum(n).alias(n) for n in names]).toArrow())
        rows = np.zeros((classes + states + 1, states))
        if summed.num_rows:
            rows[summed["g"].to_numpy()] = np.stack([summed[n].to_numpy() for n in names], 1)
        # a state leans on the corpus with the weight of one token for each class it emits
        emit = rows[:classes] + (1 + np.minimum(rows[:classes], 1).sum(0)) * vocab.shares[:, None]
        move, start = rows[classes:-1] + ADDED, rows[-1] + ADDED
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def _likelihood(shared: Shared):
    def run(batches):
        import pandas as pd

        for column in batches:
            seqs = list(column)
            out = np.zeros(len(seqs))
            for which, sizes in _groups(seqs):
                out[which] = Lattice([seqs[i] for i in which], sizes, shared.value).forward() / np.log(10)
            yield pd.Series(out)

    return F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)


def score(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_tokens, n_known, train_tokens, base_score and score; learnt
    from the rows where ``training`` holds. Columns of the input named like a result are replaced."""
    results = {"n_tokens", "n_known", "train_tokens", "base_score", "score", text.lower()}
    columns = [c for c in docs.columns if c.lower() not in results]
    spark = docs.sparkSession
    batches_of(spark, 10_000)  # sequences are short numbers; the more of them, the fewer steps a batch takes
    body = F.col(f"`{text}`")
    vocab, tail = vocabulary(docs.where(training).select(body.alias("text")))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")
    coded = stage(docs.select(kept, F.coalesce(training, F.lit(False)).alias("training"), _coded(Shared(spark, vocab))(body).alias("c"))
                  .select("doc", "training", F.monotonically_increasing_id().alias("row"), "c.*"), "lm-coded")
    model = train(coded.where("training"), vocab)
    rare = coded.select("row", F.explode("rare").alias("word")).join(tail, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + ADDED)).alias("tail_logs"), F.count("n").alias("tail_known"))
    scored = coded.select("row", "doc", "n_tokens", "head_logs", "head_known", "tail_dens", _likelihood(Shared(spark, model))("seq").alias("log10"))
    joined = scored.join(rare, "row", "left")
    logs = F.coalesce("tail_logs", F.lit(0.0))
    whole = float(np.log10(vocab.tokens + ADDED * (vocab.types + 1)))
    return joined.select(
        *[F.col(f"doc.`{c}`") for c in columns], "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), (F.col("head_logs") + logs - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("log10") + logs - F.col("tail_dens")).alias("score"))
