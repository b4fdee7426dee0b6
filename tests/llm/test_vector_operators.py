"""Vector near-duplicates and nearest neighbours against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import multi_index, queries, rp_forest


def table(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.Generator(np.random.PCG64(5))
    x = draw.standard_normal((400, 16))
    for c in range(6):  # groups around the threshold, and a chain
        x[50 * c:50 * c + 20] = x[50 * c] + draw.standard_normal((20, 16)) * (0.1 + 0.08 * c)
    x[390:] = x[389]
    return x.astype(np.float32)


ODD = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] + [1.0] * 15), (1005, [None] + [1.0] * 15), (1006, [1.0, 2.0]), (None, [0.5] * 16), (None, [0.5] * 16)]


@pytest.mark.parametrize("members", [1024, 16])
def test_links_equal_brute_force(spark, monkeypatch, clustered, members):
    monkeypatch.setattr(multi_index, "MEMBERS", members)
    monkeypatch.setattr(multi_index, "VISITORS", members)
    u = clustered.astype(float) / np.linalg.norm(clustered.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    root = np.arange(len(u))
    for _ in range(len(u)):
        new = np.minimum(root, np.where(near, root[None], len(u)).min(1))
        if (new == root).all():
            break
        root = new
    odd = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    rows = multi_index.near_duplicates(table(spark, clustered).union(odd).withColumn("row", F.lit("mine"))).collect()
    assert len(rows) == len(u) + len(ODD) and all(r["row"] == "mine" for r in rows)
    got = {r["vec_id"]: r for r in rows if r["vec_id"] is not None}
    links = np.array([got[i]["n_links"] for i in range(len(u))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.98 * near.sum()
    if (links == near.sum(1)).all():
        assert [got[i]["component_id"] for i in range(len(u))] == root.tolist()
    for i in range(1000, 1007):
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    nulls = [r for r in rows if r["vec_id"] is None]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in nulls] == [(1, None, False)] * 2


def test_each_length_is_compared_with_its_own_kind(spark):
    rows = [(i, [float(i == j) for j in range(8)]) for i in range(8)] + [(20, [1.0, 2.0]), (21, [1.0, 2.0]), (22, [1.0, 2.1]), (23, [1.0, 0.0, 0.0]), (24, [3.0]), (25, [2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in multi_index.near_duplicates(vectors).collect()}
    assert got == {**{i: (0, i) for i in (*range(8), 23)}, **{i: (2, 20) for i in (20, 21, 22)}, 24: (1, 24), 25: (1, 24)}
    near = rp_forest.nearest(vectors, F.col("vec_id") >= 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in near) == [(20, 1, 21), (20, 2, 22), (21, 1, 20), (21, 2, 22), (22, 1, 20), (22, 2, 21), (24, 1, 25), (25, 1, 24)]


def test_rows_that_repeat_an_id_each_have_a_ranking(spark):
    vectors = spark.createDataFrame([(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])], "vec_id long, embedding array<float>")
    near = sorted((r["rank"], r["vec_id"], round(r["score"], 3)) for r in rp_forest.nearest(vectors, F.col("vec_id") == 50, k=2).collect())
    assert near == [(1, 1, 0.995), (1, 2, 0.995), (2, 1, 0.1), (2, 2, 0.1)]


def test_indexes_grow_with_the_table_and_open_a_smaller_part():
    assert [multi_index.codes_for(n) for n in (100, 10**6, 10**8)] == [16, 88, 500]
    assert [rp_forest.leaves_for(n) for n in (100, 10**5, 10**8)] == [64, 500, 2500]
    draw = np.random.default_rng(3)
    parts = []
    for n in (1000, 16000):
        x = draw.standard_normal((60, 32))[draw.integers(0, 60, n)] + draw.standard_normal((n, 32)) * 0.5
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        forest = rp_forest.fit(x, 5, leaves=rp_forest.leaves_for(n))
        places = [t.place(x) for t in forest.trees]
        parts.append(np.mean([np.any([places[t] == leaf for t, leaf in forest.order(q, forest.visits)], axis=0).mean() for q in x[:40]]))
    assert parts[1] < 0.8 * parts[0]


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert multi_index.near_duplicates(empty).count() == 0
    assert rp_forest.nearest(empty, F.lit(True)).count() == 0


def test_traversal_visits_cells_nearest_first(clustered):
    u = clustered.astype(float) / np.linalg.norm(clustered.astype(float), axis=1, keepdims=True)
    index = multi_index.fit(u, codes=8)
    index.margin = np.inf
    costs = index.costs(u[:5])
    for a, b in zip(*costs, strict=True):
        seen = index.visits(a, b)
        assert sorted(seen) == list(range(64))
        order = [a[c // 8] + b[c % 8] for c in seen]
        assert order == sorted(order)


def test_neighbours_are_exact_among_few(spark, clustered):
    u = clustered.astype(float) / np.linalg.norm(clustered.astype(float), axis=1, keepdims=True)
    odd = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    rows = rp_forest.nearest(table(spark, clustered).union(odd), F.col("vec_id") % 50 == 0, k=5).collect()
    hits = total = 0
    for q in range(0, len(u), 50):
        score = u @ u[q]
        score[q] = -2
        wanted = np.lexsort((np.arange(len(u)), -np.round(score, 9)))[:5]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == q)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in got)
        hits += len({g[1] for g in got} & set(wanted.tolist()))
        total += 5
    assert hits / total >= 0.9


def test_copies_are_neighbours_by_id_and_few_candidates_give_few_rows(spark):
    x = np.array([[1, 2, 3]] * 12 + [[-1, 0, 1]])
    rows = rp_forest.nearest(table(spark, x), F.col("vec_id") == 7, k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in rows] == [0, 1, 2, 3, 4]
    rows = rp_forest.nearest(table(spark, x[10:], 50), F.col("vec_id") % 50 == 0, k=5).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in rows] == [(50, 51), (50, 52)]


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op8_projection_forest(spark, sf).collect()
    data = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack(data.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, hits, total = data.vec_id.to_numpy(), 0, 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = x @ x[i]
        score[i] = -2
        hits += len({r["vec_id"] for r in found if r["query_id"] == ids[i]} & set(ids[np.argsort(-score)[:5]].tolist()))
        total += 5
    assert hits / total >= 0.9


def test_only_the_nearest_go_for_their_ids(spark, clustered):
    plan = rp_forest.nearest(table(spark, clustered), F.col("vec_id") % 20 == 0)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner, (node"):]  # what the rows that meet the ids are made of
    assert "row_number()" in below


def test_leaves_opened_later_return_only_what_may_be_nearest():
    draw = np.random.Generator(np.random.PCG64(7))
    x = draw.standard_normal((30, 8))
    unit = pd.DataFrame({"member": [i > 0 for i in range(30)], "node": range(30), "first": range(30), "vector": list(x), "least": -2.0})
    whole = rp_forest._scored(5)(unit)
    assert len(whole) == 6
    unit["least"] = whole["score"].iloc[2]
    assert rp_forest._scored(5)(unit).equals(whole.iloc[:3])
    unit["least"] = 2.0
    assert rp_forest._scored(5)(unit).empty
