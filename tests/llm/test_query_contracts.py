"""Every column of the queries themselves against plain versions, on the whole of a small table."""

import hashlib
import zlib

import numpy as np
import pytest

from ledgerweave.llm import pii, queries

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(sample):
    return {r["doc_id"]: r["text"] or "" for r in sample.select("doc_id", "text").collect()}


def by_id(found, key="doc_id"):
    rows = found.collect()
    got = {r[key]: r for r in rows}
    assert len(got) == len(rows)
    return got


def test_personal_data(spark, texts):
    from test_text_operators import plain_entities

    got = by_id(queries.op1_bootstrapped_contexts(spark, SF))
    assert got.keys() == texts.keys()
    for i, r in got.items():
        base = plain_entities(texts[i])
        named = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r[f"n_{name}"] for name in pii.KINDS] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert r["base_sha256"] == sha(",".join(named))
        spans = r["spans"].split(",") if r["spans"] else []
        order = [(int(a), pii.KINDS.index(k)) for k, a, _ in (s.split(":") for s in spans)]
        assert set(named) <= set(spans) and order == sorted(order)


def test_links_of_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    least = ids.copy()
    while True:
        lower = np.minimum(least, np.where(linked, least[None, :], least.max()).min(1))
        if (lower == least).all():
            break
        least = lower
    got = by_id(queries.op3_multi_index(spark, SF), "vec_id")
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        int(i): (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, linked.sum(1), least, strict=True)}


def test_language_model(spark, texts):
    got = by_id(queries.op4_baum_welch(spark, SF))
    assert {i: r["held_out"] for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    assert all(r["n_tokens"] == len(texts[i].encode().lower().split()) + 1 for i, r in got.items())


def test_toxicity(spark, texts):
    got = by_id(queries.op5_class_kneser_ney(spark, SF))
    assert {i: r["held_out"] for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in texts}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_main_text(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = by_id(queries.op6_wrapper_induction(spark, SF), "page_id")
    assert {i: r["url"] for i, r in got.items()} == pages
    for r in got.values():
        blocks = r["text"].split("\n\n") if r["text"] else []
        assert r["n_chars"] == len(r["text"]) and all(b and b == " ".join(b.split()) for b in blocks)


def test_encoding(spark, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path())
    whole.no_truncation()
    whole.no_padding()
    got = by_id(queries.op7_chunk_reuse(spark, SF))
    assert got.keys() == texts.keys()
    for i, r in got.items():
        ids = whole.encode(texts[i], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(" ".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(whole.decode(ids, skip_special_tokens=False))


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in rows}
    cosine = lambda a, b: float(a @ b / np.sqrt((a @ a) * (b @ b)))
    lists = {}
    for r in queries.op8_projection_forest(spark, SF).collect():
        assert abs(r["score"] - cosine(x[r["query_id"]], x[r["vec_id"]])) < 1e-12
        lists.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert lists.keys() == {i for i in x if i % 50 == 0}
    caught = 0
    for q, found in lists.items():
        found.sort()
        assert [k for k, _, _ in found] == [1, 2, 3, 4, 5] and [f[1:] for f in found] == sorted(f[1:] for f in found)
        best = sorted((-cosine(x[q], v), i) for i, v in x.items() if i != q)[:5]
        caught += len({i for _, i in best} & {i for _, _, i in found})
    assert caught >= 0.9 * 5 * len(lists)


def test_near_duplicates(spark, texts):
    from test_text_operators import plain_components

    ids = sorted(texts)
    sets, group = plain_components([texts[i] for i in ids])
    got = by_id(queries.op9_hyperminhash(spark, SF))
    least = {g: ids[group.index(g)] for g in set(group)}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(s), least[g], i == least[g]) for i, s, g in zip(ids, sets, group, strict=True)}


def test_counts_by_kind_do_not_depend_on_places(spark):
    docs = spark.createDataFrame([(1, [2, 2, 0, 2]), (2, [1]), (3, [])], "doc_id long, kinds array<int>")
    spans = docs.selectExpr("doc_id", "transform(kinds, k -> named_struct('kind', k)) as spans")
    got = spans.select("doc_id", *queries._counts("spans", ("a", "b", "c"))).collect()
    assert {r["doc_id"]: (r["n_a"], r["n_b"], r["n_c"]) for r in got} == {1: (1, 0, 3), 2: (0, 1, 0), 3: (0, 0, 0)}
