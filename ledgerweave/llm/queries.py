"""Queries that apply the operators of this subpackage to their whole tables, and SQL for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.llm import (bpe, fim, hmm, hyperminhash, mixing, multi_index, multipart, pca_filter, pii, rp_forest, sharding, toxicity,
                             wrapper)
from ledgerweave.llm.common import id_fold, table


#: The tokenizer file of op7 and of the pipeline.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _counts(spans, kinds):
    """How many of ``spans`` are of each kind, as columns n_<kind>."""
    of = lambda kind: lambda s: s.kind == kind  # noqa: E731 - a second parameter would be the index
    return [F.size(F.filter(spans, of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(kinds)]


def op1_bootstrapped_contexts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.extract(docs, keep_text=False)
    counts = _counts("pii_base", pii.KINDS)
    return found.select("doc_id", *counts, F.sha2(pii.digest("pii_base"), 256).alias("base_sha256"), pii.digest("pii").alias("spans"))


def op2_kd_tree(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    placed = sharding.shard(docs, ["source", "lang", "size"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_multi_index(spark, sf_dir):
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))\
        .select("vec_id", "n_links", "component_id", "kept")


def op4_baum_welch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = hmm.score(docs, id_fold(10) != 0)
    return scored.select("doc_id", (id_fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def toxicity_model(spark, sf_dir, docs):
    """Learnt from the labelled documents whose fold of three is not 1."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels").where(id_fold(3) != 1))


def op5_class_kneser_ney(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id", (id_fold(3) == 1).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"))


def op6_wrapper_induction(spark, sf_dir):
    found = wrapper.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op7_chunk_reuse(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_path(), and_decode=True)
    digits = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_projection_forest(spark, sf_dir):
    return rp_forest.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


def op9_hyperminhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyperminhash.cluster(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op10_raking(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), keep_text=False)
    return mixed.select("doc_id", "topic", "tokens", F.round("mix_probability", 6).alias("probability"), F.col("mix_kept").alias("kept"))


def op11_pca_filter(spark, sf_dir):
    return pca_filter.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


def op12_rank_index(spark, sf_dir):
    cut = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", F.col("fim_chars").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("fim_text"), F.col("fim_form")), 256).alias("restored_sha256"))


def op13_multipart_linking(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = multipart.find(docs, keep_text=False)
    counts = _counts("secrets_base", multipart.KINDS[:multipart.BASE])
    return found.select("doc_id", *counts, F.sha2(multipart.digest("secrets_base"), 256).alias("base_sha256"), multipart.digest("secrets").alias("spans"))


QUERIES = {
    "op1_bootstrapped_contexts": op1_bootstrapped_contexts,
    "op2_kd_tree": op2_kd_tree,
    "op3_multi_index": op3_multi_index,
    "op4_baum_welch": op4_baum_welch,
    "op5_class_kneser_ney": op5_class_kneser_ney,
    "op6_wrapper_induction": op6_wrapper_induction,
    "op7_chunk_reuse": op7_chunk_reuse,
    "op8_projection_forest": op8_projection_forest,
    "op9_hyperminhash": op9_hyperminhash,
    "op10_raking": op10_raking,
    "op11_pca_filter": op11_pca_filter,
    "op12_rank_index": op12_rank_index,
    "op13_multipart_linking": op13_multipart_linking,
}
ORACLES: dict[str, str] = {"op10_raking": mixing.oracle(), "op11_pca_filter": pca_filter.oracle(), "op12_rank_index": fim.oracle()}
