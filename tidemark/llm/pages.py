"""Main text of HTML pages by a tree-structured graphical model.

A page is parsed into its DOM tree of elements and text leaves. Every node is
content or not; a node's own potential is linear in its features (tag, words of
class, id and role, size, share of link text, punctuation), and parent-child potentials
(one table each for text, inline and block children) tie a node to the one
above. Sum-product messages, first from the leaves up and then from the root
down, give every node its exact marginal; text leaves of at least 0.5 are kept.

Weights are fitted by the likelihood of labelled trees (observed minus expected
features, the expectations from the same messages): a bounded sample of
``max_pages`` given pages that mark their article with ``<article>`` or
``<main>``, and ``layouts`` labelled pages written by ``training_page``, which
show the same parts under other tags and class names. Features of the sample are made
in tasks; the driver gets node numbers, not pages.

Text is decoded (character references) and cut into blocks at block-level
tags; ``<br>`` is white space. Scripts, styles, comments, the head and other elements
that hold no page text have no leaves. Unclosed and stray tags are closed as browsers do.
NULL and empty pages have an empty text. Pages are never cut; repeated rows are repeated and
get equal texts; other columns are kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NO_TEXT = frozenset("head script style textarea title xmp iframe noembed noframes template noscript svg object "
                    "audio video canvas".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
                  "menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split())
# an opening tag of the key closes an open element of the value, up to a border
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "thead": {"thead", "tbody", "tfoot", "tr", "td", "th"},
          "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
          "option": {"option"}, "body": {"head"}}
BORDER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
# Words that name a part of a page in class, id or role.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar aside header masthead footer foot comment comments reply replies "
    "disqus respond discussion cookie cookies consent gdpr notice notices alert popup modal overlay share sharing "
    "social related recommended recommendations widget subscribe subscription newsletter signup login signin search "
    "form copyright legal disclaimer pagination pager toolbar tags toc complementary contentinfo skip links".split())
CONTENT_WORDS = frozenset("content article post entry story main text body prose page".split())
BOILER_TAGS = frozenset("nav aside footer header form dialog menu".split())
CONTENT_TAGS = frozenset("article main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(class|id|role|data-keep)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
LETTERS = re.compile("[a-z]+")
ENDS = tuple(".!?:;…»\"'”")


@dataclass
class Tree:
    parent: list = field(default_factory=lambda: [-1])
    depth: list = field(default_factory=lambda: [0])
    edge: list = field(default_factory=lambda: [2])          # 0 text leaf, 1 inline, 2 block
    names: list = field(default_factory=lambda: [["tag=root"]])
    keep: list = field(default_factory=lambda: [None])       # label given by markup, None: as the parent
    leaf: list = field(default_factory=list)                 # (node, block, text) in page order


def _names(tag: str, attributes: str) -> tuple[list, int | None]:
    """Features of an element's own markup, and the label markup gives it."""
    out, words, told = ["tag=" + tag], [], None
    if attributes and "=" in attributes:
        for m in NAMED.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "data-keep":
                told = int(value == "1")
            else:
                words += LETTERS.findall(value)
    boiler = tag in BOILER_TAGS or not BOILER_WORDS.isdisjoint(words)
    content = tag in CONTENT_TAGS or not CONTENT_WORDS.isdisjoint(words)
    if boiler:
        out.append("boiler")
    elif content:
        out.append("content")
    out += ["word=" + w for w in set(words) if w in BOILER_WORDS or w in CONTENT_WORDS]
    if told is None:
        told = 0 if boiler else 1 if tag in CONTENT_TAGS else None
    return out, told


def parse(page: str | None) -> Tree:
    """The tree of a page; text leaves carry the number of their block."""
    tree, page = Tree(), page or ""
    stack, block, hidden, at, size = [("root", 0)], 0, 0, 0, len(page)

    def text(raw):
        if hidden or not raw:
            return
        here = stack[-1][1]
        shown = entities.unescape(raw) if "&" in raw else raw
        if shown.isspace():
            if tree.leaf and tree.leaf[-1][1] == block:          # a space between words of one block
                tree.leaf.append((-1, block, " "))
            return
        tree.parent.append(here)
        tree.depth.append(tree.depth[here] + 1)
        tree.edge.append(0)
        tree.names.append([])
        tree.keep.append(None)
        tree.leaf.append((len(tree.parent) - 1, block, shown))

    def close(upto):
        nonlocal hidden
        while len(stack) > upto:
            hidden -= stack.pop()[0] in NO_TEXT

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag not in BLOCK
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
                if inline and stack[k][0] in BLOCK:         # never closes a block around it
                    break
            block += not inline
            continue
        if tag == "br":
            text(" ")
            continue
        if not inline:
            block += 1
            for k in range(len(stack) - 1, 0, -1):               # a block ends an open paragraph
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        ends = CLOSES.get(tag)
        if ends:
            borders = BORDER.get(tag, {"table"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in borders:
                    break
                if stack[k][0] in ends:
                    close(k)
                    if tag in ("li", "dt", "dd", "option", "td", "th"):
                        break
        if tag in VOID or (m[3] or "").endswith("/") and tag in ("svg", "path"):
            continue
        here = stack[-1][1]
        names, told = _names(tag, m[3])
        tree.parent.append(here)
        tree.depth.append(tree.depth[here] + 1)
        tree.edge.append(1 if inline else 2)
        tree.names.append(names)
        # inside a part that markup rules out nothing is content again
        tree.keep.append(0 if tree.keep[here] == 0 else tree.keep[here] if told is None else told)
        stack.append((tag, len(tree.parent) - 1))
        hidden += tag in NO_TEXT
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else size
    _measure(tree)
    return tree


def _measure(tree: Tree) -> None:
    """Add the features that the text below a node gives."""
    n = len(tree.parent)
    chars, linked, words = np.zeros(n), np.zeros(n), np.zeros(n)
    for node, _, text in tree.leaf:
        if node >= 0:
            count = len(text.split())
            chars[node], words[node] = len(text), count
            tree.names[node] += [f"words{min(count, 32).bit_length()}", "ends" if text.rstrip().endswith(ENDS) else "open"]
    for k in range(n - 1, 0, -1):
        if "tag=a" in tree.names[k]:
            linked[k] = chars[k]
        up = tree.parent[k]
        chars[up] += chars[k]
        linked[up] += linked[k]
        words[up] += words[k]
    for k in range(n):
        if tree.edge[k] == 2:
            share = linked[k] / chars[k] if chars[k] else 0.0
            tree.names[k] += [f"links{int(share * 3.999)}", f"size{min(int(words[k]), 500).bit_length() // 2}"]


@dataclass
class Forest:
    """Trees side by side: the arrays that messages run over, level by level."""
    parent: np.ndarray
    edge: np.ndarray
    levels: list             # node numbers by depth, from depth 1
    row: np.ndarray          # (row, column) of every feature
    col: np.ndarray


def forest(parents, depths, edges, columns) -> Forest:
    depth = np.concatenate(depths)
    starts = np.cumsum([0] + [len(p) for p in parents[:-1]])
    parent = np.concatenate([np.where(np.asarray(p) < 0, -1, np.asarray(p) + s) for p, s in zip(parents, starts)])
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, depth.max() + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    sizes = np.fromiter((len(c) for c in columns), dtype=np.int64, count=len(columns))
    col = np.fromiter((c for cs in columns for c in cs), dtype=np.int64, count=int(sizes.sum()))
    return Forest(parent, np.concatenate(edges), levels, np.repeat(np.arange(len(columns)), sizes), col)


def messages(f: Forest, unary: np.ndarray, tables: np.ndarray):
    """(marginal of state 1 per node, edge marginals per node to its parent) by
    sum-product; ``tables`` are log potentials [edge class, parent, child]."""
    n = len(unary)
    up = np.zeros((n, 2))
    up[:, 1] = unary
    sent = np.zeros((n, 2))
    for level in reversed(f.levels):
        both = up[level][:, None, :] + tables[f.edge[level]]
        sent[level] = np.logaddexp(both[:, :, 0], both[:, :, 1])
        np.add.at(up, f.parent[level], sent[level])
    whole, pairs = up.copy(), np.zeros((n, 2, 2))
    for level in f.levels:
        above = whole[f.parent[level]] - sent[level]
        both = above[:, :, None] + tables[f.edge[level]]
        whole[level] += np.logaddexp(both[:, 0], both[:, 1])
        joint = both + up[level][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        pairs[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(whole[:, 0] - whole[:, 1], -500, 500))), pairs


@dataclass
class PageModel:
    columns: dict            # feature -> column
    weights: np.ndarray
    tables: np.ndarray


def fit(trees: list[tuple], steps: int = 120, l2: float = 1e-4, rate: float = 0.1,
        most_nodes: int = 200) -> PageModel:
    """Fit on (parent, depth, edge, names, label) trees by the gradient of their likelihood."""
    columns = {name: k for k, name in enumerate(sorted({x for t in trees for names in t[3] for x in names}))}
    f = forest(*([t[k] for t in trees] for k in range(3)), [[columns[x] for x in names] for t in trees for names in t[3]])
    y = np.concatenate([t[4] for t in trees]).astype(np.float64)
    child = np.concatenate(f.levels) if f.levels else np.zeros(0, dtype=np.int64)
    # a tree counts as ``most_nodes`` nodes at most, so that no long page outweighs all others
    share = np.concatenate([np.full(len(t[0]), min(1.0, most_nodes / len(t[0]))) for t in trees])
    share /= share.sum()
    seen = np.zeros((3, 2, 2))
    np.add.at(seen, (f.edge[child], y[f.parent[child]].astype(int), y[child].astype(int)), share[child])
    p = [np.zeros(len(columns)), np.zeros((3, 2, 2))]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        unary = np.bincount(f.row, p[0][f.col], minlength=len(y))
        marginal, pairs = messages(f, unary, p[1])
        expected = np.zeros((3, 2, 2))
        np.add.at(expected, f.edge[child], pairs[child] * share[child, None, None])
        grads = [np.bincount(f.col, ((y - marginal) * share)[f.row], minlength=len(columns)) - l2 * p[0],
                 seen - expected - l2 * p[1]]
        for k, g in enumerate(grads):               # Adam, uphill
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] + rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    return PageModel(columns, p[0], p[1])


def marginals(model: PageModel, trees: list[Tree]) -> list[np.ndarray]:
    """Content probability of every node, per tree."""
    known = model.columns
    f = forest([t.parent for t in trees], [t.depth for t in trees], [t.edge for t in trees],
               [[known[x] for x in names if x in known] for t in trees for names in t.names])
    unary = np.bincount(f.row, model.weights[f.col], minlength=len(f.parent))
    p, _ = messages(f, unary, model.tables)
    return np.split(p, np.cumsum([len(t.parent) for t in trees])[:-1])


def text_of(tree: Tree, p: np.ndarray, least: float = 0.5) -> str:
    """Kept leaves, one line a block."""
    blocks, last = [], None
    for node, block, text in tree.leaf:
        if node < 0 or p[node] >= least:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks)
    return "\n".join(line for line in lines if line)


def training_page(rng) -> str:
    """A labelled page: ``data-keep`` marks the article (1) and what is not part of it (0)."""
    def words(lo, hi):
        return " ".join("w" * int(k) for k in rng.integers(1, 9, int(rng.integers(lo, hi))))

    def sentence(lo=4, hi=30):
        return words(lo, hi) + rng.choice([".", "!", "?", ".", ""])

    def pick(*options):
        return str(rng.choice(options))

    def paragraph():
        inner = pick(sentence(1, 4), sentence(), sentence() + " " + sentence(), sentence() + " " + sentence(10, 60),
                     f"{words(2, 8)} <a href='#'>{words(1, 4)}</a> {sentence()}", f"<b>{words(1, 5)}</b> {sentence()}")
        return f"<{(t := pick('p', 'p', 'p', 'p', 'div', 'blockquote'))}>{inner}</{t}>"

    def link_list(least=2):
        return "<ul>" + "".join(f"<li><a href='#'>{words(1, 4)}</a></li>" for _ in range(rng.integers(least, 9))) + "</ul>"

    def boiler():
        inside = pick(link_list(), sentence(3, 25), f"<p>{sentence()}</p>", f"<p>{sentence()}</p><p>{sentence()}</p>",
                      f"<h3>{words(1, 4)}</h3>" + link_list(), f"&copy; {words(1, 6)}")
        comments = "".join(f"<div><b>{words(1, 3)}</b><p>{sentence()}</p></div>" for _ in range(rng.integers(1, 6)))
        return pick(
            f"<nav data-keep=0>{link_list()}</nav>", f"<footer data-keep=0>{inside}</footer>",
            f"<header data-keep=0><h1>{words(1, 6)}</h1>{inside}</header>", f"<aside data-keep=0>{inside}</aside>",
            f"<form data-keep=0><label>{words(1, 3)}</label><input><button>{words(1, 2)}</button>{inside}</form>",
            f"<div class='{pick('ad', 'advert', 'banner', 'sponsored', 'promo')}' data-keep=0>{inside}</div>",
            f"<div id='{pick('sidebar', 'menu', 'nav', 'footer', 'header', 'related', 'links')}' data-keep=0>{inside}</div>",
            f"<div class='{pick('cookie-notice', 'alert', 'newsletter', 'popup', 'share', 'social')}' data-keep=0>{inside}</div>",
            f"<{(t := pick('section', 'div', 'ol'))} class='{pick('comments', 'comment-list', 'replies')}' "
            f"data-keep=0>{comments}</{t}>", f"<ul class='{pick('menu', 'breadcrumbs', 'tags', 'pagination')}' data-keep=0>"
            f"<li><a href='#'>{words(1, 3)}</a></li></ul>")

    def body():
        out = [f"<{(t := pick('h1', 'h1', 'h2'))}>{words(2, 9)}</{t}>"] if rng.random() < 0.8 else []
        for _ in range(rng.integers(1, 9)):
            out.append(paragraph())
            if rng.random() < 0.3:
                out.append(pick(f"<h2>{words(1, 6)}</h2>", f"<ul><li>{sentence()}</li><li>{sentence()}</li></ul>", link_list(1),
                                f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>",
                                f"<pre>{words(3, 12)}</pre>", boiler(), boiler(), boiler(), boiler()))
        return "".join(out)
    shell = pick("<article data-keep=1>{}</article>", "<main data-keep=1>{}</main>", "<main><article data-keep=1>{}</article></main>",
                 "<div class='content' data-keep=1>{}</div>", "<div id='main'><div class='post' data-keep=1>{}</div></div>",
                 "<section class='story' data-keep=1>{}</section>", "<div class='entry-content' data-keep=1>{}</div>",
                 "<div class='wrap'><article data-keep=1>{}</article></div>", "<div data-keep=1>{}</div>")
    before = "".join(boiler() for _ in range(rng.integers(0, 4)))
    after = "".join(boiler() for _ in range(rng.integers(0, 4)))
    return f"<html><head><title>{words(1, 5)}</title></head><body>{before}{shell.format(body())}{after}</body></html>"


def _labelled(tree: Tree) -> tuple:
    """(parent, depth, edge, names, label) with every node labelled as markup says."""
    label = [0] * len(tree.parent)
    for k in range(1, len(label)):
        label[k] = label[tree.parent[k]] if tree.keep[k] is None else tree.keep[k]
    return tree.parent, tree.depth, tree.edge, tree.names, label


def _training(rng, layouts: int) -> list[tuple]:
    return [_labelled(parse(training_page(rng))) for _ in range(layouts)]


def sample_trees(pages: DataFrame, html_col: str, most: int) -> list[tuple]:
    """Labelled trees of at most ``most`` distinct pages with an article, first in hash order."""
    marked = pages.select(F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    picked = (marked.withColumn("h", F.xxhash64("html")).groupBy("h").agg(F.min("html").alias("html"))
              .orderBy("h").limit(most))

    def run(batches):
        for batch in batches:
            trees = [_labelled(parse(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "parent": pa.array([t[0] for t in trees], pa.list_(pa.int32())),
                "depth": pa.array([t[1] for t in trees], pa.list_(pa.int32())),
                "edge": pa.array([t[2] for t in trees], pa.list_(pa.int32())),
                "names": pa.array([t[3] for t in trees], pa.list_(pa.list_(pa.string()))),
                "label": pa.array([t[4] for t in trees], pa.list_(pa.int32()))})
    rows = picked.select("html").mapInArrow(
        run, "parent array<int>, depth array<int>, edge array<int>, names array<array<string>>, label array<int>").collect()
    return [tuple(r) for r in rows]


def main_text(pages: DataFrame, *, html_col: str = "html", text_col: str = "text", training: DataFrame | None = None,
              max_pages: int = 200, layouts: int = 300, seed: int = 5, at_once: int = 2_000_000) -> DataFrame:
    """``pages`` with the main text of the whole html. ``training`` gives other
    pages to learn from (default: these); ``at_once`` bounds the characters of
    the pages whose trees are in memory together, one page at least."""
    real = sample_trees(pages if training is None else training, html_col, max_pages)
    model = fit(_training(np.random.default_rng(seed), layouts) + real)
    shared = pages.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        model = PageModel(**shared.value)

        def run(texts):
            out, held, size = [], [], 0
            for k, t in enumerate(texts):
                held.append(t)
                size += len(t or "")
                if size >= at_once or k + 1 == len(texts):
                    trees = [parse(h) for h in held]
                    out += [text_of(tree, p) for tree, p in zip(trees, marginals(model, trees))]
                    held, size = [], 0
            return {text_col: out}
        return run
    return add_columns(pages, html_col, {text_col: "string"}, make)
