import pytest

from pyspark.sql import functions as F

#: Texts that every text operator must survive: null, empty, blank, very long, repeated, unusual characters.
ODD = [None, "", " \n\t ", "one", "a b c d", "a b c d e", "a b c d e", "x" * 30000, "word " * 6000, "Ünïcödé ☃ 日本 ́ end", "A b C d E", None]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """(doc_id, text, lang, source, n_chars) with null ids, repeated rows and columns that clash with results."""
    rows = [(i if i % 5 else None, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", len(t or "")) for i, t in enumerate(ODD)]
    rows += rows[:6]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["row", "kept", "size", "shard", "tokens", "topic", "spans", "pii", "score", "token_ids", "component_id", "doc", "n", "a.b"]
    return docs.withColumns({c: F.lit("mine") for c in clash})


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
