"""Toxicity, near-duplicates, personal data, mixing and encoding against plain versions."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import bpe, hyperminhash, mixing, pii, queries, toxicity


def words(text):
    return (text or "").encode().lower().split()


# -- personal data ---------------------------------------------------------------------------------

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_entities(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = "".join(c for c in m.group() if c in "0123456789")
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii._luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_proven_entities_equal_the_plain_patterns():
    import random

    draw = random.Random(4)
    for _ in range(20000):
        text = "".join(draw.choice("a@b.1 +-(2é5.9@)") for _ in range(draw.randint(0, 30)))
        assert pii.proven(text) == plain_entities(text), text


def test_proven_entities_are_linear_in_hostile_texts():
    import time

    began = time.time()
    for text in ("a" * 200000, "1" * 200000, "a.1-" * 50000, "+1 " * 60000, "1.2." * 50000, "@a" * 100000):
        pii._spans(text)
    assert time.time() - began < 20


def test_contexts_of_seeds_discover_unseen_identifiers(spark):
    rows = [(i, f"please call +1 (555) 555-{1000 + i} now") for i in range(6)]
    rows += [(10, "please call 020 7946 0958 now, the year 12345678 was fine"), (11, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: r[1] for r in pii.extract(docs).select("doc_id", pii.digest("pii")).collect()}
    assert found[10] == "phone:12:25" and found[11] == found[12] == "" and found[0] == "phone:12:29"
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert masked[10] == "please call [phone] now, the year 12345678 was fine" and masked[11] is None and masked[12] == ""


def test_accepted_instances_induce_patterns_of_their_own(spark, monkeypatch):
    """Seeds teach "mail"; what stands after it teaches "badge"; what stands before that stands after no known word itself."""
    rows = [f"mail person{i}@example.org soon" for i in range(30)] + [f"mail worker{i}@intranet badge" for i in range(8)]
    rows += ["visit guest@lobby badge", "visit other@place maybe"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r[0]: r[1] for r in pii.extract(docs).select("doc_id", pii.digest("pii")).collect()}
    assert all(found[i].startswith("email:5:") for i in range(38))
    assert found[38] == "email:6:17" and found[39] == ""
    monkeypatch.setattr(pii, "ROUNDS", 1)  # one context far only
    found = {r[0]: r[1] for r in pii.extract(docs).select("doc_id", pii.digest("pii")).collect()}
    assert all(found[i] for i in range(38)) and found[38] == ""


def test_glued_contexts_are_counted_as_they_are_cut(spark):
    """Beginnings such as tel: prove a number; a full stop proves none, however rarely it stands alone."""
    rows = [f"Ring tel:+44 20 7946 {1000 + i} now" for i in range(20)] + ["Ring tel:020 7946 0958 now", "Ring fax:020 7946 0123 yet"]
    rows += [f"Reach us on +44 20 7946 {2000 + i}. Then" for i in range(20)] + [f"The end of sentence {i} here. Yes" for i in range(400)]
    rows += ["Lot 12 345 678. Then", "A stop . alone", "Another . alone"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r[0]: r[1] for r in pii.extract(docs).select("doc_id", pii.digest("pii")).collect()}
    assert found[20] == "phone:9:22" and found[21] == ""
    assert found[442] == "" and all(found[i] for i in range(20))
    odd = ["", "a", ":", "::", "a:", ":a", "a:b", "é：b", "(" * 5000]
    import pandas as pd
    got = pd.concat(pii._occurrences([pd.DataFrame({"text": odd})]))
    glued = {(s, w.decode()): n for s, w, n in got.itertuples(index=False) if s >= pii.GLUED and len(w) < 4}
    assert glued[2, ":"] == 2 and glued[3, ":"] == 2 and glued[2, "a:"] == 1 and glued[3, ":b"] == 1


def test_base_spans_of_whole_texts(spark, sample):
    rows = pii.extract(sample).select("text", "pii_base", "pii").collect()
    assert len(rows) == sample.count()
    for r in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in r["pii_base"]] == plain_entities(r["text"])
        assert {tuple(s) for s in r["pii_base"]} <= {tuple(s) for s in r["pii"]}


# -- near-duplicates -------------------------------------------------------------------------------

def plain_components(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append(set(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return sets, group


def near_copies():
    """A chain of slowly changing texts, a family around the threshold, copies, and strangers."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base), " ".join(base).upper()]
    for k in range(12):
        base = base[:]
        base[5 * k] = f"changed{k}"
        texts.append(" ".join(base))
    for k in range(25):
        family = [f"f{i}" for i in range(80)]
        family[3 * k] = f"new{k}"
        family[3 * k + 2] = f"newer{k}"
        texts.append(" ".join(family))
    return texts + [" ".join(f"s{k}x{i}" for i in range(30)) for k in range(5)] + ["short text", "short text", "", None, "short"]


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK_NODES", block)
    texts = near_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, group = plain_components(texts)
    rows = {r["doc_id"]: r for r in hyperminhash.cluster(docs).collect()}
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        assert rows[i]["n_shingles"] == len(sets[i]), i
        assert rows[i]["component_id"] == group.index(group[i]), i
        assert rows[i]["kept"] == rows[i]["first_of_component"] == (group.index(group[i]) == i)


def test_near_duplicates_of_the_table_equal_brute_force(spark, sample):
    rows = sorted((r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect())
    _, group = plain_components([t for _, t in rows])
    found = {r["doc_id"]: r["component_id"] for r in hyperminhash.cluster(sample.select("doc_id", "text")).collect()}
    assert found == {i: rows[group.index(g)][0] for (i, _), g in zip(rows, group, strict=True)}


def test_registers_estimate_similarity():
    import numpy as np

    factors = hyperminhash._factors()
    draw = np.random.Generator(np.random.PCG64(1))
    for shared in (0, 500, 1500, 2000):
        one = draw.integers(0, 2**63, 2000, np.uint64)
        two = np.concatenate([one[:shared], draw.integers(0, 2**63, 2000 - shared, np.uint64)])
        equal = (hyperminhash.registers(one, factors) == hyperminhash.registers(two, factors)).sum()
        size = hyperminhash._size_class(np.array([2000]))
        chance = hyperminhash._chances(size, size)[size[0], size[0]]
        assert abs(hyperminhash.estimate(equal, chance) - shared / (4000 - shared)) < 0.2


# -- toxicity --------------------------------------------------------------------------------------

def test_rare_forms_of_toxic_expressions_are_recognised(spark):
    import random

    draw = random.Random(2)
    plain = [f"{a}{b}{c}" for a in ("ta", "re", "mi", "so") for b in ("lo", "ne", "du") for c in ("st", "m", "ra")]
    rows = []
    for i in range(240):
        text = [draw.choice(plain) for _ in range(40)]
        if i % 2:
            text[7], text[21] = "grukk" + draw.choice(plain), "grukk" + draw.choice(plain)
        rows.append((i, " ".join(text), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learnt = docs.where("doc_id % 3 <> 1")
    model = toxicity.fit(learnt.select("doc_id", "text"), learnt.select("doc_id", "toxic"))
    held = toxicity.score(docs.where("doc_id % 3 = 1"), model).collect()
    right = sum((r["toxic_score"] >= 0.7) == (r["toxic"] == 1) for r in held)
    assert right / len(held) > 0.9
    unseen = toxicity.score(spark.createDataFrame([("grukkxyz " + " ".join(plain[:20]),), (" ".join(plain[:20]),)], "text string"), model).collect()
    assert unseen[0]["toxic_score"] > unseen[1]["toxic_score"]


def test_toxicity_without_labels_gives_one_defined_score(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs.select("doc_id", "text"), none)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["toxic_score"] <= 1 for r in rows)


# -- mixing ----------------------------------------------------------------------------------------

def test_raking_reaches_all_marginals(spark):
    cells = spark.createDataFrame([(s, l, t, 10 + 7 * i) for i, (s, l, t) in enumerate((s, l, t) for s in "abc" for l in "xy" for t in (0, 1))], "source string, lang string, topic int, tokens long")
    share = lambda c, kind, values: spark.createDataFrame(values, f"{c} {kind}, share double")
    targets = {"source": share("source", "string", [("a", 0.5), ("b", 0.3), ("c", 0.2)]), "lang": share("lang", "string", [("x", 0.6), ("y", 0.4)]), "topic": share("topic", "int", [(0, 0.25), (1, 0.75)])}
    raked = mixing.rake(cells, targets, rounds=30).toPandas()
    total = raked.tokens.sum()
    for d, wanted in {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {0: 0.25, 1: 0.75}}.items():
        for value, s in wanted.items():
            assert abs(raked[raked[d] == value].weight.sum() / total - s) < 1e-9


def test_mixing_keeps_every_row_and_the_same_ids(spark, odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["mix_probability"] <= 1 for r in rows)
    assert all(not r["mix_kept"] for r in rows if not r["mix_probability"])
    by_row = collections.defaultdict(set)
    for r in rows:
        by_row[r["doc_id"], r["text"], r["source"], r["lang"]].add(r["mix_kept"])
    assert all(len(v) == 1 for v in by_row.values())


def test_plans_of_rounds_stay_small(spark, monkeypatch):
    """Each step of the rounds is written: a plan of several doubles with each, and the driver's memory with it (pipeline: over 1,500 MB)."""
    from ledgerweave.llm import components

    plans, written = [], components.stage

    def stage(df, label="stage"):
        plans.append(df._jdf.queryExecution().analyzed().toString().count("Join "))
        return written(df, label)

    monkeypatch.setattr(components, "stage", stage)
    monkeypatch.setattr(mixing, "stage", stage)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 51), (None, 3)], "a long, b long")
    found = dict(components.components(links).collect())
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 51: 50} and max(plans) <= 1
    cells = spark.createDataFrame([("a", "x", 0, 5), ("b", "x", 1, 7), ("b", "y", 0, 1)], "source string, lang string, topic int, tokens long")
    raked = mixing.rake(cells, {d: mixing.tempered(cells, d) for d in mixing.DIMENSIONS}, rounds=2)
    assert raked.count() == 3 and max(plans) <= 2


# -- encoding --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_encoding_equals_the_library(spark, odd_docs, sample, tokenizer):
    texts = ["a ́b c", "x <|endoftext|> y <|startoftext|>z", "Σ Σ\t\n\r x", "don't  I'll   we 've", "\x1c a \x85 b   c　", "1 2 3 ١٢", "👍🏽 ok"]
    for docs in (odd_docs, sample, spark.createDataFrame([(t,) for t in texts], "text string")):
        coded = bpe.decode(bpe.encode(docs, queries.tokenizer_path(), and_decode=True).withColumnRenamed("decoded", "also"), queries.tokenizer_path())
        for r in coded.select("text", "token_ids", "decoded", "also").collect():
            assert r["also"] == r["decoded"]
            ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
            assert ids == list(r["token_ids"]) and tokenizer.decode(ids, skip_special_tokens=False) == r["decoded"]


def test_chunks_are_cut_by_content_and_repair_reaches_agreement(tokenizer):
    text = "the same passage of many words " * 40
    assert b"".join(bpe.chunks(text)) == text.encode()
    inner = set(bpe.chunks("intro " + text)) & set(bpe.chunks("another beginning, longer " + text))
    assert len(inner) >= 0.8 * len(set(bpe.chunks(text)))
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read()).open()
    pieces = [b"un", b"believ", b"able wo", b"rds do", b"n't e", b"nd"]
    wrong = {i for i in range(1, len(pieces)) if not encoder._agrees(pieces[i - 1], pieces[i])}
    ids = tokenizer.encode("unbelievable words don't end", add_special_tokens=False).ids
    assert np.frombuffer(encoder._repaired(pieces, wrong), np.int32).tolist() == ids


def test_plain_chunks_go_through_the_tokenizer_piece_by_piece(tokenizer, monkeypatch):
    """Only joins are tried by whole texts; new chunks need merges for new pieces alone (op7: 1,280 CPU seconds a GB, budget 900)."""
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read()).open()
    whole, sent = encoder.whole, []
    monkeypatch.setattr(encoder, "whole", lambda raw: sent.extend(raw) or whole(raw))
    plain = [f"Word{i} don't CAFÉ-{i % 7}, naïve x{i}\tÿ. I'LL? " for i in range(300)]
    odd = ["a < b <|endoftext|>c ", "e ́ x\x1cy z ", "１２ 日本 ", "ſ K İ Σ ", "a\x85b ½ ", "", " \n"]
    for texts in (plain, odd, plain + odd, []):
        got = encoder.encode(texts)
        assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        if texts is plain:
            assert len(sent) < 200 < len(encoder.store)  # joins of a few kinds


# -- all of them -----------------------------------------------------------------------------------

OPERATORS = {
    "pii": lambda d: pii.extract(d),
    "minhash": lambda d: hyperminhash.cluster(d),
    "mix": lambda d: mixing.mix(d),
    "bpe": lambda d: bpe.encode(d, queries.tokenizer_path()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_stay_and_empty_tables_stay_empty(odd_docs, name):
    out = OPERATORS[name](odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where(F.col("`a.b`") == "mine").count() == odd_docs.count()
    assert OPERATORS[name](odd_docs.where("1 = 0")).count() == 0
