"""Main text of web pages by wrapper induction.

Every page becomes a skeleton: its block elements as a tree, repeated siblings
as one node. Skeletons of a host that are similar by simple tree matching share a
wrapper, the most frequent of them; a host has as many wrappers as it has layouts.
Skeletons are aligned with their wrapper, and Spark counts, for every wrapper node,
on how many different pages the same block of text stands there. Blocks that most
of a wrapper's pages share are template; the slots that vary are content. Equal
pages are copies of one article and count as one page, and an article or main
element that is nearly all constant holds versions of one article.

What HTML itself says comes first: elements that are menus, headers, footers,
sidebars, notices, adverts, forms, comments of readers or no text at all, by
their name, role or class, are never content; main or else article elements, all of
them, bound it where they hold most of the page's text or stand at a wrapper node
that holds most of the host's varying text. Where they do not, every other block
counts as well, except lists of links at places no wrapper knows. By class or id
an element is dropped only where a whole token says so, never for one word of it.

Blocks are the text between borders of block elements, character references
decoded, white space (a line break, too) turned into one space. Null pages and
hosts are allowed: a page without a host is judged alone. Columns of the input
named like a result are replaced.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, ship, vectorised, without
from ledgerweave.session import stage

ship(__name__)

#: A block is template if it stands at one node on this part of a wrapper's different pages, of which there are at least so many.
SHARE, LEAST_PAGES = 0.8, 3
#: Skeletons of which this part of the nodes match share a wrapper; most new wrappers of a host in one round, and in one
#: after rounds that gave none (the size of a row's list; rounds go on until no pages are left that could share a wrapper).
SIMILAR, LEADERS, MOST_LEADERS = 0.6, 8, 32
#: Rounds whose results are read as tables of their own, before they are written as one.
APART = 16
LINKS = 0.6
#: Weights of pairs of subtrees a tree matching keeps at once.
STORED = 500_000
#: Kinds of content roots.
ARTICLE, MAIN = 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
#: The rest of a tag with quoted values of any length, and one whose quotes mean nothing.
_QUOTED, _PLAIN = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>"), re.compile(r"[^>]*+(?:>|\Z)")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
_RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math canvas object select".split())
_NEVER = frozenset("head nav footer aside form menu dialog button search label input video audio".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
_OUTER = frozenset("header banner head top masthead".split())
_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager footer sidebar aside ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social comment comments commentlist reply replies respond disqus discussion related recommended "
    "widget widgets toolbar search copyright banner".split())
_BOXES = frozenset("list area box container wrapper wrap inner bar button buttons link links post posts stories form item items slot unit".split())
#: Words for the place of a box, which outside articles say no more than _BOXES do.
_PLACES = frozenset("site page main global top bottom left right primary secondary mobile desktop block section region row column col".split())
#: What is not dropped for the names in its id, nor, inside an article, for those in its class.
_TEXT = frozenset("h1 h2 h3 h4 h5 h6 hgroup section".split())
#: What holds running text: a link may fill it without making it a menu.
_PROSE = frozenset("p blockquote pre figcaption caption h1 h2 h3 h4 h5 h6 dd".split())
#: Which open elements the start of an element ends, and at which they stop looking.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
         "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}


class _Element:
    __slots__ = ("name", "node", "dropped", "root", "link")

    def __init__(self, name, node, dropped, root, link):
        self.name, self.node, self.dropped, self.root, self.link = name, node, dropped, root, link


def _dropped(name: str, attributes: dict[str, str], rooted: bool) -> bool:
    """Whether an element is no content by its name, role, class or id; of these only whole tokens count, inside an article those of its class."""
    if name in ("html", "body", "article", "main") and not attributes:
        return False
    if name in _NEVER or name == "header" and not rooted:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in _ROLES:
        return True
    if name in ("html", "body", "main"):
        return False
    if rooted:  # ids are often slugs of headings, class names those of the article's subject
        return name not in _TEXT and any(_names_all(c) for c in attributes.get("class", "").split())
    tokens = attributes.get("class", "").split() + ([] if name in _TEXT else attributes.get("id", "").split())
    return any(_names_all(t, _OUTER, _PLACES) for t in tokens)


def _names_all(token: str, names: frozenset = frozenset(), boxes: frozenset = frozenset()) -> bool:
    """Whether a class or id is made of names of what is no content, and of words for boxes: comments, related-posts, ad-box-2.
    One such name among other words (search-for-meaning, social-history) says nothing."""
    parts = {p.lower() for p in _PART.findall(token) if not p.isdigit()}
    names = _NAMES | names
    return not parts.isdisjoint(names) and parts <= names | _BOXES | boxes


def scan(page: str) -> tuple[str, list[tuple[int, str, bool, int, int]]]:
    """The page's skeleton and its blocks outside dropped elements: skeleton node, text, whether it consists of links,
    kind and skeleton node of the outermost content root around it (0 and -1 if there is none)."""
    nodes: list[tuple[int, str]] = [(-1, "#")]       # parent and signature, in page order
    last: list[int] = [-1]                           # the last child of each node
    stack = [_Element("#", 0, False, (0, -1), False)]
    blocks: list[tuple] = []
    text: list[tuple[str, _Element]] = []            # with the element it stands in

    def flush() -> None:
        for (node, root), group in groupby(text, lambda piece: (piece[1].node, piece[1].root)):
            pieces = list(group)
            joined = " ".join(html.unescape("".join(t for t, _ in pieces)).split())
            if joined:
                linked = sum(len(t) for t, e in pieces if e.link) / max(1, sum(len(t) for t, _ in pieces))
                blocks.append((node, joined, linked >= LINKS and nodes[node][1].partition(".")[0] not in _PROSE, *root))
        text.clear()

    def close(name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name == name:
                if any(e.name in _BLOCK for e in stack[i:]):
                    flush()
                del stack[i:]
                return

    at, end, quoted = 0, len(page), True
    for m in iter(lambda: _TAG.search(page, at), None):
        if m.start() > at and not stack[-1].dropped:
            text.append((page[at:m.start()], stack[-1]))
        at = m.end()
        name = m.group(2)
        if not name:
            continue
        name = name.lower()
        rest = _QUOTED.match(page, at) if quoted else None
        if not rest:  # a quote that is never closed: from here on quotes mean nothing, so a page is read to its end once
            quoted, rest = False, _PLAIN.match(page, at)
        at = rest.end()
        if m.group(1):
            close(name)
            continue
        if name == "br":
            if not stack[-1].dropped:
                text.append((" ", stack[-1]))
            continue
        if name in _BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in _BLOCK:
                    break
        if name in _ENDS:
            ended, stops = _ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ended:
                    flush()
                    del stack[i:]
                    break
                if stack[i].name in stops:
                    break
        if name in _RAW:
            close_at = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if rest.group()[-2:] != "/>":
                at = page.find(">", close_at.start()) + 1 or end if close_at else end
            continue
        if name in _VOID:
            continue
        top = stack[-1]
        raw = rest.group().rstrip("/>").strip()
        attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)} if raw else {}
        dropped = top.dropped or _dropped(name, attributes, top.root[0] > 0)
        node, root = top.node, top.root
        if name in _BLOCK:
            signature = re.sub(r"[(),\s]+", ".", " ".join([name, *sorted(attributes.get("class", "").split())]))
            if last[top.node] >= 0 and nodes[last[top.node]][1] == signature:
                node = last[top.node]
            else:
                node = len(nodes)
                nodes.append((top.node, signature))
                last.append(-1)
                last[top.node] = node
            if not dropped and (name in ("article", "main") or attributes.get("role") == "main") and not root[0]:
                root = (ARTICLE if name == "article" else MAIN, node)
        stack.append(_Element(name, node, dropped, root, top.link or name == "a"))
    if at < end and not stack[-1].dropped:
        text.append((page[at:], stack[-1]))
    flush()
    return _written(nodes), blocks


def parse(page: str) -> tuple[str, list[tuple[int, str]]]:
    """The page's skeleton and its content blocks, each with its skeleton node, the page judged alone."""
    skeleton, blocks = scan(page)
    kept = _bounded([len(t) for _, t, *_ in blocks], *([b[i] for b in blocks] for i in (2, 3, 4)), set())
    return skeleton, [tuple(blocks[i][:2]) for i in kept]


def _bounded(sizes, links, kinds, roots, supported: set[int]) -> list[int]:
    """Numbers of the blocks that are content: those in main or else in article elements, all of that kind, where they hold
    most of the text or ``supported`` has one of their nodes; else all but unbounded blocks of links."""
    free = [i for i in range(len(sizes)) if kinds[i] or not links[i]]
    whole = sum(sizes[i] for i in free)
    for kind in (MAIN, ARTICLE):
        inside = [i for i in free if kinds[i] == kind]
        if inside and (2 * sum(sizes[i] for i in inside) > whole or any(roots[i] in supported for i in inside)):
            return inside
    return free


def _written(nodes: list[tuple[int, str]]) -> str:
    """parent:signature of each node but the first, in page order."""
    return " ".join(f"{p}:{s}" for p, s in nodes[1:])


class _Trees:
    """Skeletons read into one table of subtrees: equal subtrees have one number, whichever skeleton they stand in."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.signatures: dict[str, int] = {}
        self.signature: list[int] = []
        self.below: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.weights: dict[tuple[int, int], int] = {}

    def read(self, skeleton: str) -> tuple[list[int], list[list[int]]]:
        """The subtree and the children of each node, in page order."""
        names, children = ["#"], [[]]
        for i, item in enumerate(skeleton.split(" ") if skeleton else (), 1):
            parent, _, name = item.partition(":")
            names.append(name)
            children.append([])
            children[int(parent)].append(i)
        of = [0] * len(names)
        for i in range(len(names) - 1, -1, -1):  # children have larger numbers than parents
            key = (self.signatures.setdefault(names[i], len(self.signatures)), *(of[c] for c in children[i]))
            of[i] = self.known.setdefault(key, len(self.known))
            if of[i] == len(self.signature):
                self.signature.append(key[0])
                self.below.append(key[1:])
                self.size.append(1 + sum(self.size[c] for c in key[1:]))
        return of, children

    def alike(self, xs, ys) -> tuple[int, int]:
        """How many equal subtrees two rows of siblings begin and end with: matching these is always best."""
        most, first, last = min(len(xs), len(ys)), 0, 0
        while first < most and xs[first] == ys[first]:
            first += 1
        while last < most - first and xs[-1 - last] == ys[-1 - last]:
            last += 1
        return first, last

    def row(self, x: int, ys: np.ndarray, at: np.ndarray):
        """Weights of subtree ``x`` with the siblings ``ys[at]``; what is not known yet is asked for."""
        found = np.array([self.signature[y] == self.signature[x] for y in ys], np.int32)
        if self.below[x]:
            for k in np.flatnonzero(found):
                y = int(ys[k])
                if self.below[y]:
                    found[k] = self.size[x] if x == y else self.weights.get((x, y)) or (yield x, y)
        return found[at]

    def weight(self, x: int, y: int):
        """Nodes that match between two subtrees of one signature."""
        xs, ys = self.below[x], self.below[y]
        first, last = self.alike(xs, ys)
        total = 1 + sum(self.size[c] for c in xs[:first] + xs[len(xs) - last:])
        xs, ys = xs[first:len(xs) - last], ys[first:len(ys) - last]
        if xs and ys:
            ys, at = np.unique(ys, return_inverse=True)
            best = np.zeros(len(at) + 1, np.int32)
            for c in xs:
                best = _next(best, (yield from self.row(c, ys, at)))
            total += int(best[-1])
        return total

    def run(self, asking):
        """The value of a computation that asks for weights, which ask for others: any depth, no recursion."""
        open_, answer = [(asking, None)], None
        while True:
            try:
                pair = open_[-1][0].send(answer)
                open_.append((self.weight(*pair), pair))
                answer = None
            except StopIteration as done:
                _, pair = open_.pop()
                answer = done.value
                if not open_:
                    return answer
                if len(self.weights) >= STORED:  # worked out again where needed
                    self.weights.clear()
                self.weights[pair] = answer

    def siblings(self, xs: list[int], ys: list[int]):
        """Pairs of positions that match between two rows of siblings. Of the table of best sums only every so many rows
        are kept, and the rows between them are worked out again on the way back."""
        kinds, at = np.unique(ys, return_inverse=True)
        step = math.isqrt(len(xs)) + 1
        kept, best = [], np.zeros(len(ys) + 1, np.int32)
        for i, x in enumerate(xs):
            if i % step == 0:
                kept.append(best)
            best = _next(best, (yield from self.row(x, kinds, at)))
        pairs, k = [], len(ys)
        for block in range(len(kept) - 1, -1, -1):
            rows = [kept[block]]
            for x in xs[block * step:(block + 1) * step]:
                rows.append(_next(rows[-1], (yield from self.row(x, kinds, at))))
            for i in range(len(rows) - 1, 0, -1):
                here, over = rows[i], rows[i - 1]
                k = int(np.searchsorted(here[:k + 1], here[k]))  # sums never fall along a row: the first place of this one
                if here[k] != over[k]:
                    k -= 1
                    pairs.append((block * step + i - 1, k))
        return pairs


def _next(best: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The next row of best sums of an ordered matching."""
    out = best.copy()
    np.maximum(out[1:], best[:-1] + weights, out=out[1:])
    return np.maximum.accumulate(out)


def align(skeleton: str, other: str) -> list[int]:
    """For each node of ``skeleton`` the node of ``other`` it matches, or -1, by simple tree matching:
    roots must have one signature, children are matched in order so that most nodes match."""
    trees = _Trees()
    (a, below_a), (b, below_b) = trees.read(skeleton), trees.read(other)
    out = [-1] * len(a)
    work = [(0, 0)]
    while work:
        i, j = work.pop()
        out[i] = j
        p, q = below_a[i], below_b[j]
        first, last = trees.alike([a[c] for c in p], [b[c] for c in q])
        work += zip(p[:first] + p[len(p) - last:], q[:first] + q[len(q) - last:], strict=True)
        p, q = p[first:len(p) - last], q[first:len(q) - last]
        if p and q:
            work += [(p[x], q[y]) for x, y in trees.run(trees.siblings([a[c] for c in p], [b[c] for c in q]))]
    return out


@vectorised("skeleton string, blocks array<struct<node:int,text:string,links:boolean,kind:tinyint,root:int>>")
def _parsed(pages):
    import pandas as pd

    found = [scan(p) if p else ("", []) for p in pages]
    names = ("node", "text", "links", "kind", "root")
    return pd.DataFrame({"skeleton": [s for s, _ in found], "blocks": [[dict(zip(names, b, strict=True)) for b in bs] for _, bs in found]})


def similarity(skeleton: str, other: str) -> tuple[float, list[int]]:
    """The part of both skeletons' nodes that match, and the matches."""
    matches = align(skeleton, other)
    return 2 * (sum(m >= 0 for m in matches) - 1) / max(1, len(skeleton.split()) + len(other.split())), matches


def _names(skeleton: str) -> Counter:
    """How often each signature stands in a skeleton."""
    return Counter(item.partition(":")[2] for item in skeleton.split())


def _may_be_similar(names: Counter, others: Counter) -> bool:
    """Whether two skeletons have enough nodes of one signature: nodes of different signatures never match."""
    return 2 * (names & others).total() / max(1, names.total() + others.total()) >= SIMILAR


@vectorised("array<string>")
def _leaders(candidates):
    """Of skeletons in order those that are similar to none before them."""
    import pandas as pd

    out = []
    for skeletons in candidates:
        found: dict[str, Counter] = {}
        for s in skeletons:
            names = _names(s)
            if all(s != f and not (_may_be_similar(names, others) and similarity(s, f)[0] >= SIMILAR) for f, others in found.items()):
                found[s] = names
        out.append(list(found))
    return pd.Series(out)


@vectorised("wrapper string, matches array<int>")
def _nearest(skeletons, leaders):
    """The most similar wrapper, or null if none is similar, and the matches."""
    import pandas as pd

    out, known = [], {}
    for skeleton, wrappers in zip(skeletons, leaders, strict=True):
        names, best = _names(skeleton), (-1.0, None, None)
        for w in wrappers:
            if w not in known:
                known[w] = _names(w)
            if w == skeleton or _may_be_similar(names, known[w]):
                score, matches = similarity(skeleton, w)
                if score > best[0] and (score >= SIMILAR or w == skeleton):
                    best = (score, w, matches)
        out.append({"wrapper": best[1], "matches": best[2]})
    return pd.DataFrame(out, columns=["wrapper", "matches"])


def _grouped(shapes: DataFrame) -> DataFrame:
    """(host, skeleton, wrapper, matches, pages) of skeletons (host, skeleton, n) that share a wrapper on LEAST_PAGES pages.

    In rounds, each host's most frequent skeletons that are not similar to each other become wrappers. A host goes on with the
    skeletons that are similar to none until what is left has too few pages for a wrapper; a round that gave none with enough
    pages is followed by one with twice as many candidates. Every round takes at least one skeleton out of each host."""
    done, left, rounds = None, shapes.withColumn("most", F.lit(LEADERS)), 0
    while True:
        order = Window.partitionBy("host").orderBy(F.col("n").desc(), "skeleton")
        first = left.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= MOST_LEADERS) & (F.col("rank") <= F.col("most")))
        first = first.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "skeleton"))).alias("first")).select("host", _leaders("first.skeleton").alias("leaders"))
        near = left.join(first, "host").select("host", "skeleton", "n", "most", _nearest("skeleton", "leaders").alias("w"))
        near = stage(near.select("host", "skeleton", "n", "most", "w.*"), "pages-aligned")
        pages = near.where("wrapper IS NOT NULL").groupBy("host", "wrapper").agg(F.sum("n").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
        found = near.join(pages, ["host", "wrapper"]).select("host", "skeleton", "wrapper", "matches", "pages")
        done, rounds = found if done is None else done.unionByName(found), rounds + 1
        if rounds % APART == 0:
            done = stage(done, "pages-grouped")
        hosts = near.where("wrapper IS NULL").groupBy("host").agg(F.sum("n").alias("rest"), F.max("most").alias("most")).where(F.col("rest") >= LEAST_PAGES)
        gave = pages.select("host").distinct().withColumn("gave", F.lit(True))
        hosts = hosts.join(gave, "host", "left").select("host", F.when(F.col("gave"), LEADERS).otherwise(F.least(2 * F.col("most"), F.lit(MOST_LEADERS))).alias("most"))
        left = near.where("wrapper IS NULL").select("host", "skeleton", "n").join(hosts, "host")
        if left.isEmpty():
            return done


@vectorised("array<int>")
def _chosen(nodes, hashes, sizes, links, kinds, roots, matches, at, constant, supported):
    """Numbers of a page's content blocks, by what is constant on its host and which roots the host supports."""
    import pandas as pd

    out = []
    for node, hashed, size, link, kind, root, match, *known in zip(nodes, hashes, sizes, links, kinds, roots, matches, at, constant, supported, strict=True):
        blocks, held = range(len(node)), set()
        if match is not None:
            template = set(zip(known[0].tolist(), known[1].tolist(), strict=True))
            blocks = [i for i in blocks if (match[node[i]], hashed[i]) not in template]
            held = {i for i, m in enumerate(match) if m in known[2]}
            link = link & np.array([match[n] < 0 for n in node], bool)  # links that vary at a wrapper's node are no menu
        blocks = list(blocks)
        out.append([blocks[i] for i in _bounded(size[blocks], link[blocks], kind[blocks], root[blocks], held)])
    return pd.Series(out)


def main_text(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``pages`` without the HTML, with host, main_text (blocks joined by an empty line; empty if none)."""
    batches_of(pages.sparkSession)
    pages = without(pages, "host", "main_text")
    columns = [c for c in pages.columns if c != page]
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")
    parsed = stage(pages.select(kept, host.alias("host"), _parsed(F.col(f"`{page}`")).alias("p")).select("doc", "host", "p.*"), "pages-parsed")
    hosted = parsed.where("host <> ''")
    # a block counts once on a page for each node; equal pages count as one page
    marks = F.array_distinct(F.transform("blocks", lambda b: F.struct(
        b.node.alias("node"), F.xxhash64(b.text).alias("hash"), b.root.alias("root"), F.when((b.kind > 0) | ~b.links, F.length(b.text)).otherwise(0).alias("size"))))
    bounded = F.filter("blocks", lambda b: b.kind > 0)
    same = F.xxhash64(F.when(F.size(bounded) > 0, bounded).otherwise(F.col("blocks")))
    distinct = stage(hosted.select("host", "skeleton", same.alias("page"), marks.alias("marks")).groupBy("host", "skeleton", "page").agg(F.min("marks").alias("marks")), "pages-distinct")
    # one row for each skeleton of a host: the partial counts take care of large hosts
    shapes = stage(_grouped(stage(distinct.groupBy("host", "skeleton").agg(F.count("*").alias("n")), "pages-shapes")), "pages-grouped")
    standing = distinct.select("host", "skeleton", F.explode("marks").alias("m")).select("host", "skeleton", "m.*")
    counted = standing.groupBy("host", "skeleton", "node", "hash", "root", "size").agg(F.count("*").alias("n")).join(shapes, ["host", "skeleton"])
    # nodes and roots by their numbers in the wrapper; -1 no match, -2 no root
    matched = lambda c: F.get("matches", F.col(c))
    counted = counted.withColumns({"at": matched("node"), "root_at": F.when(F.col("root") < 0, -2).otherwise(matched("root"))})
    counted = counted.groupBy("host", "wrapper", "at", "hash", "root_at", "size").agg(F.sum("n").alias("n"), F.max("pages").alias("pages"))
    constant = (F.col("at") >= 0) & (F.col("n") >= SHARE * F.col("pages"))
    # at most a page's blocks over SHARE for each host; the varying text of each root
    counted = counted.groupBy("host", "wrapper", "root_at").agg(
        F.collect_list(F.when(constant, F.struct("at", "hash"))).alias("constant"), F.sum(F.when(constant, 0).otherwise(F.col("n") * F.col("size"))).alias("own"),
        F.sum(F.when(constant, F.col("n") * F.col("size")).otherwise(0)).alias("same"))
    # a root that is constant nearly throughout holds versions of one article
    copies = (F.col("root_at") >= -1) & (F.col("same") >= SHARE * (F.col("same") + F.col("own")))
    counted = counted.withColumns({"constant": F.when(copies, F.array().cast("array<struct<at:int,hash:bigint>>")).otherwise(F.col("constant")),
                                   "own": F.col("own") + F.when(copies, F.col("same")).otherwise(0)})
    counted = counted.groupBy("host", "wrapper").agg(F.flatten(F.collect_list("constant")).alias("constant"), F.sum("own").alias("own"), F.collect_list(F.struct("root_at", "own")).alias("roots"))
    supported = F.transform(F.filter("roots", lambda r: (r.root_at >= 0) & (2 * r.own > F.col("own"))), lambda r: r.root_at)
    template = stage(shapes.join(counted, ["host", "wrapper"]).select("host", "skeleton", "matches", "constant", supported.alias("supported")), "pages-template")
    joined = parsed.join(template, ["host", "skeleton"], "left")
    hashes, sizes = F.transform("blocks", lambda b: F.xxhash64(b.text)), F.transform("blocks", lambda b: F.length(b.text))
    joined = joined.withColumn("chosen", _chosen("blocks.node", hashes, sizes, "blocks.links", "blocks.kind", "blocks.root", "matches", "constant.at", "constant.hash", "supported"))
    texts = F.transform("chosen", lambda i: F.get("blocks", i).text)
    return joined.select(*[F.col(f"doc.`{c}`") for c in columns], "host", F.array_join(texts, "\n\n").alias("main_text"))
