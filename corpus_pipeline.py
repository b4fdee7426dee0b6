"""From raw documents to token ids: toxicity, near-duplicates, personal data, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``, whatever further columns those are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm import bpe, hyperminhash, mixing, pii, queries, toxicity
from ledgerweave.llm.common import table
from ledgerweave.session import stage

#: Documents scored at or above this are rejected.
TOXIC = 0.7


def _within(docs: DataFrame, needed: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the ``needed`` columns; the others ride along in one struct, so that no name can clash."""
    rest = [c for c in docs.columns if c not in needed]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("string")
    done = work(docs.select(*needed, packed.alias("rest")))
    return done.select(*[F.col(f"rest.`{c}`") if c in rest else F.col(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not reject, learnt as in op5."""
    model = queries.toxicity_model(spark, sf_dir, docs.select("doc_id", "text"))
    return _within(docs, ["text"], lambda d: toxicity.score(d, model).where(F.col("toxic_score") < TOXIC))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return _within(docs, ["doc_id", "text"], lambda d: hyperminhash.cluster(d).where("first_of_component"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data masked and n_chars counted anew."""
    return _within(docs, ["text", "n_chars"], lambda d: pii.mask(d).withColumn("n_chars", F.length("text").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with raked probabilities."""
    needed = ["doc_id", "text", "lang", "source"]
    return _within(docs, needed, lambda d: mixing.mix(d).where("mix_kept"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with token_ids, n_tokens and decoded."""
    coded = bpe.encode(docs, queries.tokenizer_path(), and_decode=True)
    return coded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The learnt and sketched stages have no SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
