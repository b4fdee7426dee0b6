"""Sharding, the language model, wrapper induction and the pipeline against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import hmm, queries, sharding, wrapper


# -- sharding --------------------------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 5, 8])
def test_shards_have_near_equal_bytes_and_gapless_slots(spark, shards):
    rows = [(1, "a", 10)] * 300 + [(None, None, 7)] * 40 + [(i, f"s{i % 7}", 1 + i % 50) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, row string, size long")
    out = sharding.shard(docs, ["row", "size"], shards=shards).toPandas()
    assert len(out) == len(rows)
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == shards and sizes.max() - sizes.min() <= 2 * 50
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_target_bytes_decide_the_number_of_shards(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size"))
    out = sharding.shard(docs, ["doc_id"], target_bytes=1500).toPandas()
    assert out.shard.nunique() == 7 and out.groupby("shard")["size"].sum().max() <= 1500
    # without ties a k-d cut is a cut of the coordinate
    spans = sorted((g.doc_id.min(), g.doc_id.max()) for _, g in out.groupby("shard"))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_long_common_prefixes_and_negative_numbers_keep_their_order(spark):
    rows = [(i, f"commoncrawl-{i % 8}", 10) for i in range(800)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, source string, size long"), ["source"], shards=8).toPandas()
    assert all(g.source.nunique() == 1 for _, g in out.groupby("shard")) and out.groupby("shard").source.first().is_monotonic_increasing
    rows = [(i, (i * 37 % 1000) - 500, (i * 37 % 1000 - 500) / 7, 10) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, whole long, part double, size long")
    for dimension in ("whole", "part"):
        spans = [(g[dimension].min(), g[dimension].max()) for _, g in sharding.shard(docs, [dimension], shards=8).toPandas().groupby("shard")]
        assert len(spans) == 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_coordinates_keep_order_over_the_whole_range(spark):
    values = [-(1 << 63), -(1 << 62), -1, 0, 5, 1 << 62, (1 << 63) - 1]
    rows = sharding.coordinates(spark.createDataFrame([(v, str(v)) for v in values] + [(None, None)], "d0 long, d1 string"), ["d0", "d1"]).collect()
    got = {r["d0"]: r["c0"] for r in rows}
    assert got.pop(None) == 0 and [got[v] for v in values] == sorted(got.values())
    assert max(got.values()) <= 1 << sharding.WIDTH and got[-(1 << 63)] < got[-(1 << 62)] < got[-1] and got[5] < got[1 << 62]
    texts = sorted((r["d1"] or "", r["c1"]) for r in rows)
    assert [c for _, c in texts] == list(range(8))


def test_shard_query_equals_a_plain_account_of_the_table(spark, sample):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in sample.collect()}
    rows = queries.op2_kd_tree(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == {i: (len(t) + 1, zlib.crc32(t), "bytes", None) for i, t in docs.items()}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert sorted(slots) == list(range(8)) and all(sorted(s for s, _ in part) == list(range(len(part))) for part in slots.values())
    sizes = [sum(n for _, n in part) for part in slots.values()]
    assert max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for t in docs.values())


def test_no_rows_no_shards(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, size long"), ["size"], shards=8).count() == 0


# -- language model --------------------------------------------------------------------------------

def test_forward_and_backward_equal_enumeration():
    from itertools import product

    draw = np.random.Generator(np.random.PCG64(9))
    model = hmm.Model(draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(5), 3).T)
    seqs = [np.array(s, np.uint16) for s in ([0, 1, 2, 4], [3, 4], [4], [2, 2, 0, 1, 4])]
    seqs.sort(key=len, reverse=True)
    lattice = hmm.Lattice([s.tobytes() for s in seqs], np.array([len(s) for s in seqs]), model)
    found = lattice.forward()
    emission, moves, start = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
    for s, log in zip(seqs, found, strict=True):
        whole = 0.0
        e, m, b = np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)
        for path in product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            whole += p
            b[path[0]] += p
            for t, state in enumerate(path):
                e[s[t], state] += p
                if t:
                    m[path[t - 1], state] += p
        assert abs(np.log(whole) - log) < 1e-9
        emission, moves, start = emission + e / whole, moves + m / whole, start + b / whole
    got = [np.zeros((5, 3)), np.zeros((3, 3)), np.zeros(3)]
    lattice.expected(*got)
    for a, b in zip(got, (emission, moves, start), strict=True):
        assert np.allclose(a, b)


def test_scores_beat_the_base_on_held_out_documents(spark, sample):
    rows = hmm.score(sample.select("doc_id", "text"), F.crc32(F.col("doc_id").cast("string")) % 10 != 0).collect()
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    learnt = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in learnt for w in texts[i].encode().lower().split())
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    better = {True: 0.0, False: 0.0}
    for r in rows:
        found = texts[r["doc_id"]].encode().lower().split()
        logs = [np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found] + [np.log10((len(learnt) + 0.1) / (n + 0.1 * (v + 1)))]
        assert r["n_tokens"] == len(found) + 1 and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in found) + 1
        assert abs(r["base_score"] - sum(logs)) < 1e-6 * abs(sum(logs))
        better[r["doc_id"] in set(learnt)] += r["score"] - r["base_score"]
    assert better[True] > 0 and better[False] > 0


def test_language_model_on_odd_rows(spark, odd_docs):
    rows = hmm.score(odd_docs, F.col("doc_id").isNotNull()).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in rows)
    nothing = hmm.score(odd_docs.select("doc_id", "text"), F.lit(False)).collect()
    assert len(nothing) == len(rows) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in nothing)
    assert hmm.score(odd_docs.where("1 = 0"), F.lit(True)).count() == 0


# -- wrapper induction -----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>var a="</p>";</script></head><body class="x">
<header>top</header><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">buy</div><div id="cookie-notice">cookies</div>
<main><article><h1>Title &amp; more</h1><p>First <b>bold<br>line</b> x&nbsp;y<p>Second &lt;p&gt;<ul><li>one<li>two</ul>
<form>f<input></form><aside>side</aside><div class="comments"><p>reader</p></div></article></main><footer>&copy; end"""


def test_semantic_elements_and_blocks():
    assert [t for _, t in wrapper.parse(PAGE)[1]] == ["Title & more", "First bold line x y", "Second <p>", "one", "two"]


@pytest.mark.parametrize(("page", "kept"), [
    ("<article>Intro text<video><p>Fallback</p></video> and more</article>", ["Intro text", "and more"]),
    ("<article><p>Text <span class=share>Share</p><p>next</article>", ["Text", "next"]),
    ("<article><p>Text <label>dropped<br></label>goes on</article>", ["Text goes on"]),
    ("<article><div>a <ins class=ad>buy<div>now</div></ins> b</div></article>", ["a", "b"]),
    ("<article><button>go<p>x</p></button><p>only</article>", ["only"]),
])
def test_text_beside_dropped_elements_is_kept(page, kept):
    assert [t for _, t in wrapper.parse(page)[1]] == kept


def test_all_roots_are_kept_and_a_card_bounds_nothing():
    parts = "<body><p>chrome</p><article><p>Part one</p></article><div><p>x</p></div><article><p>Part two is longer</p></article></body>"
    assert [t for _, t in wrapper.parse(parts)[1]] == ["Part one", "Part two is longer"]
    card = "<body><div><p>The whole story stands in a plain div</p><p>and goes on</p></div><article><a href=/x>Card</a></article></body>"
    assert [t for _, t in wrapper.parse(card)[1]] == ["The whole story stands in a plain div", "and goes on", "Card"]


def test_a_host_supports_its_article_on_pages_where_it_is_short(spark):
    html = "<body><div class=m><p>sidelong words of page {}</p></div><article><p>{}</p></article></body>"
    rows = [(i, f"http://s.example/{i}", html.format(i, f"article {i} " * (1 if i == 3 else 20))) for i in range(12)]
    # cards at one place on every page of a host are no support
    rows += [(100 + i, f"http://c.example/{i}", f"<body><div><p>{f'story {i} ' * 9}</p></div><article>card {i}</article></body>") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in wrapper.main_text(pages).collect()}
    assert got[3] == "article 3" and all(got[i] == ("article %d " % i * 20).strip() for i in range(12) if i != 3)
    assert all(got[100 + i] == ("story %d " % i * 9).strip() + f"\n\ncard {i}" for i in range(12))


@pytest.mark.parametrize("part", [
    '<section id="discussion"><p>kept</p></section>', '<h2 id="related-work">kept</h2>', '<h2 class="notice">kept</h2>',
    '<div class="section" id="search"><p>kept</p></div>', '<div class="social-history"><p>kept</p></div>',
    '<p id="reply-to-critics">kept</p>', '<section class="discussion"><p>kept</p></section>',
])
def test_names_of_the_articles_subject_drop_nothing(part):
    texts = [t for _, t in wrapper.parse(f"<article><p>first</p>{part}<p>last</p></article>")[1]]
    assert texts == ["first", "kept", "last"]


@pytest.mark.parametrize("part", ["<div class='comments'>x</div>", "<ul class='related-posts'><li>x</ul>", "<div class='box shareButtons'>x</div>", "<nav>x</nav>"])
def test_whole_class_names_of_boxes_still_drop(part):
    assert [t for _, t in wrapper.parse(f"<article><p>first</p>{part}</article>")[1]] == ["first"]


def test_sections_of_pages_without_an_article_keep_their_text():
    assert [t for _, t in wrapper.parse('<body><h2 id="discussion">Head</h2><section class="level2" id="search"><p>text</p></section><div id="search">x</div>')[1]] == ["Head", "text"]


def test_tree_matching_finds_the_largest_ordered_alignment():
    a = "0:html 1:body 2:nav 2:div 2:p"
    assert wrapper.align(a, "0:html 1:body 2:div 2:p 2:footer") == [0, 1, 2, -1, 3, 4]
    assert wrapper.align(a, a) == list(range(6))
    assert wrapper.align("", a) == [0]


def matched(a, b):
    """Most nodes that match between two trees (signature, children), by trying every ordered matching of the children."""
    if a[0] != b[0]:
        return 0
    best = {(0, 0): 0}
    for i in range(len(a[1]) + 1):
        for j in range(len(b[1]) + 1):
            ways = [best[i - 1, j]] if i else []
            ways += [best[i, j - 1]] if j else []
            ways += [best[i - 1, j - 1] + matched(a[1][i - 1], b[1][j - 1])] if i and j else []
            best[i, j] = max(ways, default=0)
    return 1 + best[len(a[1]), len(b[1])]


def some_tree(draw, depth=3):
    return ["xyz"[draw.integers(0, 3 if depth < 3 else 2)], [some_tree(draw, depth - 1) for _ in range(draw.integers(0, 4))] if depth else []]


def as_skeleton(tree):
    parents = []

    def add(node, parent):
        parents.append(f"{parent}:{node[0]}")
        number = len(parents)
        for child in node[1]:
            add(child, number)

    for child in tree[1]:
        add(child, 0)
    return " ".join(parents)


@pytest.mark.parametrize("stored", [500_000, 2])
def test_tree_matching_equals_brute_force(monkeypatch, stored):
    monkeypatch.setattr(wrapper, "STORED", stored)
    draw = np.random.default_rng(5)
    for _ in range(300):
        a, b = (["#", some_tree(draw)[1]] for _ in range(2))
        one, two = as_skeleton(a), as_skeleton(b)
        found = wrapper.align(one, two)
        assert sum(m >= 0 for m in found) == matched(a, b)
        (parents, names), (others, theirs) = ([list(x) for x in zip(*(i.split(":") for i in t.split()), strict=True)] or [[], []] for t in (one, two))
        pairs = [(i, m) for i, m in enumerate(found) if m > 0]
        assert len({m for _, m in pairs}) == len(pairs)
        for i, m in pairs:
            assert names[i - 1] == theirs[m - 1] and found[int(parents[i - 1])] == int(others[m - 1])
        for i, m in pairs:  # siblings stay in order
            assert all((i < k) == (m < n) for k, n in pairs if parents[k - 1] == parents[i - 1] and k != i)


def test_wide_and_deep_pages_align_in_little_memory():
    import time
    import tracemalloc

    wide = "<div><{0}>head</{0}>" + "<p>x</p><div class=b>y</div>" * 2500 + "<{1}>end</{1}></div>"
    pages = [(wide.format("h1", "h2"), wide.format("h3", "h4")), ("<div><p>a</p>" * 2000, "<div><h1>a</h1>" * 2000)]
    for one, two, least in [(*(wrapper.scan(p)[0] for p in pages[0]), 5002), (*(wrapper.scan(p)[0] for p in pages[1]), 2001)]:
        began = time.time()
        assert sum(m >= 0 for m in wrapper.align(one, two)) == least
        assert time.time() - began < 10
        tracemalloc.start()
        wrapper.align(one, two)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6


@pytest.mark.parametrize(("page", "kept"), [
    (f'<p title="{"a" * 5000} > leaked">text</p>', ["text"]),
    ('<body><div id="search-for-meaning"><p>Whole article</p></div>', ["Whole article"]),
    ('<div class="social-history">article</div><p>tail</p>', ["article", "tail"]),
    ('<p>Story <a href=x>of a long link to another text</a>.</p><div><a href=y>Menu</a></div>', ["Story of a long link to another text."]),
    ('<div id="site-header">x</div><div class="left-sidebar">x</div><div class="comments-2">x</div><p>text</p>', ["text"]),
    ('<p a="1>text</p>', ["text"]),
])
def test_long_values_names_among_words_and_links_in_text(page, kept):
    assert [t for _, t in wrapper.parse(page)[1]] == kept


def test_links_that_vary_on_a_host_are_no_menu(spark):
    html = "<body><ul class=m><li><a href=/>Home</a></li></ul><div class=s><a href=/{0}>The story {0} that is one link</a></div><p>text {0}</p></body>"
    pages = spark.createDataFrame([(i, f"http://v.example/{i}", html.format(i)) for i in range(8)], "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in wrapper.main_text(pages).collect()}
    assert got == {i: f"The story {i} that is one link\n\ntext {i}" for i in range(8)}


def test_constant_slots_are_template_and_copies_are_not(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class=x><p>Same notice</p></div><div class=y><p>own words {i} and more of {i}</p></div></body>") for i in range(12)]
    rows += [(100 + i, "http://copy.example/", "<p>copied article</p><p>copied too</p>") for i in range(12)]
    rows += [(50, None, None), (51, "", ""), (52, "not a url", "<p>alone</p>"), (53, "http://h.example/z", "<p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r["main_text"] for r in wrapper.main_text(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"own words {i} and more of {i}" for i in range(12))
    assert all(got[100 + i] == "copied article\n\ncopied too" for i in range(12))
    assert (got[50], got[51], got[52], got[53]) == ("", "", "alone", "")
    assert wrapper.main_text(pages.where("1 = 0")).count() == 0


def test_each_layout_and_small_host_has_its_template(spark):
    one = "<body><div class=a><p>Menu of one layout</p></div><div class=t><p>story {}</p></div></body>"
    two = "<body><table class=b><tr><td>Menu of the other layout</td></tr></table><ul class=u><li>tale {}</li></ul></body>"
    rows = [(i, f"http://h.example/{i}", (one if i % 2 else two).format(i)) for i in range(24)]
    rows += [(100 + i, f"http://small.example/{i}", one.format(100 + i)) for i in range(4)]
    versions = "<article><p>The long article that all the versions of it share, word for word</p><p>v{}</p></article>"
    rows += [(200 + i, f"http://versions.example/{i}", versions.format(i)) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in wrapper.main_text(pages).collect()}
    assert all(got.pop(200 + i) == f"The long article that all the versions of it share, word for word\n\nv{i}" for i in range(5))
    # the menu is longer than the text of every page
    assert got == {i: f"{'story' if i % 2 or i >= 100 else 'tale'} {i}" for i in got} and len(got) == 28


def test_rounds_without_a_wrapper_drop_no_page(spark):
    """Forty layouts of one page each come before one that four pages share, which differ a little."""
    odd = [("h", f"0:a{i} 1:b{i} 2:c{i}", 1) for i in range(40)]
    alike = [("h", f"0:z 1:y 2:x 2:w 2:v{i}", 1) for i in range(4)]
    few = [("few", "0:z 1:y", 1), ("few", "0:q", 1)]
    shapes = spark.createDataFrame([*odd, *alike, *few], "host string, skeleton string, n long")
    got = wrapper._grouped(shapes).collect()
    assert sorted(r["skeleton"] for r in got) == [s for _, s, _ in alike]
    assert {r["wrapper"] for r in got} == {alike[0][1]} and {r["pages"] for r in got} == {4}


def test_skeletons_are_passed_over_only_where_they_cannot_be_similar():
    draw = random.Random(5)
    for _ in range(300):
        one, two = (" ".join(f"{draw.randrange(i)}:{draw.choice('abc')}" for i in range(1, draw.randrange(2, 9))) for _ in range(2))
        if wrapper.similarity(one, two)[0] >= wrapper.SIMILAR:
            assert wrapper._may_be_similar(wrapper._names(one), wrapper._names(two))


def test_hostile_pages_take_little_time():
    import time

    began = time.time()
    for page in ("<a \"'" * 10000, "<a \">\" " * 100000, "<p>" * 20000, "<" * 50000, "<div>" * 2000, "<!--" * 20000, "<b>" * 10000 + "<p>" * 10000):
        wrapper.parse(page)
    assert time.time() - began < 20


# -- pipeline --------------------------------------------------------------------------------------

def test_stages_keep_columns_and_take_effect(spark, odd_docs):
    import corpus_pipeline

    sf, docs = "/root/testdata/sf0.001", odd_docs
    for name, work in corpus_pipeline.STAGES:
        out = work(spark, docs, sf)
        assert name == "bpe" or out.columns == docs.columns, name
        assert work(spark, docs.where("1 = 0"), sf).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "pii", "mixing", "bpe"]
    kept = corpus_pipeline.drop_near_duplicates(spark, odd_docs, sf).collect()
    copies = [r for r in kept if (r["text"] or "").split() == list("abcde")]
    assert len(copies) == 1
