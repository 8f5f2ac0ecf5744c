"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements; inline markup only marks link text, and
scripts, styles, comments and the head hold no text.  Every node gets features
of its subtree (text, link and tag density), its attribute tokens, its depth and
ancestors, and its siblings.  Trees fitted by Spark's ``GBTClassifier`` give the
log-odds that a node belongs to the article.  Decoding picks the best labelling
in which nothing below a dropped node is kept: a node's score counts for keeping
or against dropping it, and the choice for a subtree is made bottom-up.

The trees are fitted on generated pages whose nodes are labelled by their making:
``SAMPLE_PAGES`` pages of layouts with menus, headers, footers, sidebars, notices,
adverts, forms and reader comments in random order, nesting and naming.  That
bounds the fitting; extraction covers every page whole.

Defined results: a null or empty page, and one without a kept node, has empty
text; truncated and unbalanced markup is read as far as it goes; pages are read
one by one, so repeated rows give repeated results; other columns are carried
along, but one with the name of a result column is replaced.  ``br`` ends a block.
"""

from __future__ import annotations

import html
import math
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradetide.llm.bpe import per_batch, texts_of

SAMPLE_PAGES, TREES, DEPTH, SEED = 600, 24, 4, 11
# What it costs to drop a node inside one that is surely of the article: weak evidence doesn't cut
# an article.  Pages and bodies hold both kinds; dropping parts of them is free.
CUT, WHOLE = 16.0, {"#page", "html", "body"}
PAGES_AT_ONCE = 500

# Element kinds; everything else is inline.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "math", "object", "canvas"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
PARAGRAPH = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "td", "th", "dd", "dt", "figcaption"]
CONTAINER = ["html", "body", "div", "section", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "center",
             "fieldset", "figure", "details", "summary", "address", "hgroup", "head", "menu", "dialog"]
SEMANTIC = ["article", "main", "nav", "header", "footer", "aside", "form", "button", "select", "option", "label"]
BLOCKS = {*PARAGRAPH, *CONTAINER, *SEMANTIC}
# What an opening tag closes, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
# Words in class, id and role attributes, by what they tell.
TOKENS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs tabs toc pagination pager",
    "head": "header masthead topbar logo branding site toolbar",
    "foot": "footer foot copyright legal colophon contentinfo bottom",
    "side": "sidebar aside side rail widget related recommended trending complementary popular tags",
    "ad": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner dfp outbrain taboola",
    "notice": "notice cookie cookies consent gdpr alert modal popup overlay subscribe newsletter paywall hidden warning",
    "form": "form search login signup register input contact",
    "talk": "comment comments reply replies discussion disqus respond feedback reviews review",
    "share": "share sharing social follow twitter facebook",
    "good": "article content main post entry story text body paragraph blog page prose",
}
KIND_OF = {word: kind for kind, words in TOKENS.items() for word in words.split()}
BAD = [k for k in TOKENS if k != "good"]

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: set[str]
    index: int = 0
    children: int = 0
    chars: int = 0
    link_chars: int = 0
    stops: int = 0
    tags: int = 1
    runs: list[tuple[int, str]] = field(default_factory=list)


def tokens_of(attributes: str) -> set[str]:
    kinds = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            kinds.add("notice")
        elif name != "style":
            kinds |= {KIND_OF[w] for w in map(str.lower, WORD.findall(value)) if w in KIND_OF}
    return kinds


def parse(page: str) -> list[Node]:
    """Block elements in page order, each after its parent; node 0 is the page."""
    nodes = [Node("#page", -1, 0, set())]
    stack, links, order, at = [0], 0, 0, 0
    buffer: list[str] = []

    def flush():
        nonlocal order
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                nodes[stack[-1]].runs.append((order, text))
                order += 1

    def pop(to: int):
        flush()
        del stack[to:]

    size = len(page)
    while at < size:
        found = TAG.search(page, at)
        piece = page[at:found.start()] if found else page[at:]
        if piece:
            buffer.append(piece)
            if links:
                nodes[stack[-1]].link_chars += len(piece)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = bool(found[1])
        if tag in RAW and not closing:
            if not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
        elif tag == "br" or tag == "hr":
            flush()
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in BLOCKS:
            links = 0
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if nodes[stack[i]].tag == tag:
                        pop(i)
                        break
                continue
            ends, within = CLOSES.get(tag, ((), ()))
            for i in range(len(stack) - 1, 0, -1):
                if nodes[stack[i]].tag in ends:
                    pop(i)
                    break
                if nodes[stack[i]].tag in within:
                    break
            if nodes[stack[-1]].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                pop(len(stack) - 1)
            flush()
            parent = stack[-1]
            nodes.append(Node(tag, parent, nodes[parent].depth + 1, tokens_of(found[3]) if found[3] else set(),
                              nodes[parent].children))
            nodes[parent].children += 1
            stack.append(len(nodes) - 1)
    flush()
    return nodes


FEATURES = [
    *(f"is_{t}" for t in SEMANTIC), "paragraph", "heading", "item", "container",
    *(f"own_{k}" for k in TOKENS), *(f"above_{k}" for k in TOKENS),
    "in_article", "in_nav", "in_header", "in_footer", "in_aside", "in_form",
    "depth", "children", "index", "log_chars", "link_density", "stop_density", "chars_per_tag", "share_of_siblings",
    "share_of_page", "links_of_siblings",
]


def features(nodes: list[Node]) -> np.ndarray:
    """A row of FEATURES for each node."""
    for node in nodes:
        node.chars = sum(len(t) for _, t in node.runs)
        node.stops = sum(t.count(".") + t.count(",") for _, t in node.runs)
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.chars += node.chars
        above.link_chars += node.link_chars
        above.stops += node.stops
        above.tags += node.tags
    groups: list[list[float]] = [[0.0, 0.0] for _ in nodes]
    for node in nodes[1:]:
        groups[node.parent][0] += node.chars
        groups[node.parent][1] += node.link_chars
    inherited: list[tuple[set[str], set[str]]] = [(set(), set())]
    rows = np.zeros((len(nodes), len(FEATURES)))
    for i, node in enumerate(nodes):
        if i:
            tokens, tags = inherited[node.parent]
            above = nodes[node.parent]
            own = tokens | above.tokens if above.tokens - tokens else tokens
            named = tags | {above.tag} if above.tag in SEMANTIC and above.tag not in tags else tags
            inherited.append((own, named))
        tokens, tags = inherited[i]
        chars, links = groups[node.parent] if i else (node.chars, node.link_chars)
        rows[i] = [
            *(node.tag == t for t in SEMANTIC), node.tag in PARAGRAPH, node.tag[0] == "h" and node.tag[1:].isdigit(),
            node.tag in ("li", "td", "th", "dd", "dt"), node.tag in CONTAINER,
            *(k in node.tokens for k in TOKENS), *(k in tokens for k in TOKENS),
            "article" in tags or "main" in tags, "nav" in tags, "header" in tags, "footer" in tags, "aside" in tags,
            "form" in tags,
            min(node.depth, 30), min(node.children, 50), min(node.index, 50), math.log1p(node.chars),
            node.link_chars / max(1, node.chars), node.stops / max(1, node.chars), node.chars / node.tags,
            node.chars / max(1, chars), node.chars / max(1, nodes[0].chars), links / max(1, chars)]
    return rows


Tree = tuple  # (feature, threshold, left, right) inside, (value,) at a leaf


def log_odds(trees: list[tuple[float, Tree]], rows: np.ndarray) -> np.ndarray:
    """Sum of the trees' values, doubled: the scale on which the fitting's loss gives log-odds."""
    total = np.zeros(len(rows))

    def descend(tree: Tree, at: np.ndarray, weight: float):
        if len(tree) == 1:
            total[at] += weight * tree[0]
            return
        left = rows[at, tree[0]] <= tree[1]
        for branch, part in ((tree[2], at[left]), (tree[3], at[~left])):
            if len(part):
                descend(branch, part, weight)

    for weight, tree in trees:
        descend(tree, np.arange(len(rows)), weight)
    return 2 * total


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which nodes are kept: the best sum of scores, less what cuts cost, in which nothing
    below a dropped node is kept.

    A node's score is its bounded log-odds.  Nodes with text of their own count by
    its logarithm, and nodes that only hold others for little, so that content decides
    for them.
    """
    weights = [1 + math.log1p(sum(len(t) for _, t in n.runs)) if n.runs else 0.1 for n in nodes]
    odds = np.clip(odds, -4, 4)
    scores = odds * np.array(weights)
    keep, drop = scores.tolist(), (-scores).tolist()
    cut = [0.0 if n.tag in WHOLE else CUT * max(0.0, o) / 4 for n, o in zip(nodes, odds.tolist())]
    for i in range(len(nodes) - 1, 0, -1):
        above = nodes[i].parent
        keep[above] += max(keep[i], drop[i] - cut[above])
        drop[above] += drop[i]
    kept = [keep[0] > drop[0]]
    for i in range(1, len(nodes)):
        above = nodes[i].parent
        kept.append(kept[above] and keep[i] > drop[i] - cut[above])
    return kept


def texts(pages: list[str], trees: list[tuple[float, Tree]]) -> list[str]:
    """Main text of each page."""
    out = []
    for at in range(0, len(pages), PAGES_AT_ONCE):
        parsed = [parse(p) for p in pages[at:at + PAGES_AT_ONCE]]
        odds = log_odds(trees, np.concatenate([features(nodes) for nodes in parsed]))
        first = 0
        for nodes in parsed:
            kept = decode(nodes, odds[first:first + len(nodes)])
            first += len(nodes)
            runs = sorted(r for node, k in zip(nodes, kept) if k for r in node.runs)
            out.append("\n".join(t for _, t in runs))
    return out


def sample_page(rng: random.Random) -> tuple[str, str]:
    """A generated page and its article's text.  Words ending in x mark the rest."""
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ou", "é", "ü", "ción", "ß", "st", "en"]

    def words(low, high, end=""):
        return [("".join(rng.choices(syllables, k=rng.randint(1, 4))) + end) for _ in range(rng.randint(low, high))]

    def sentence(low, high, end=""):
        return " ".join(words(low, high, end)).capitalize() + rng.choice([".", ".", ".", "", "!"])

    def named(kind):
        word = rng.choice(TOKENS[kind].split())
        attribute = rng.choice(["class", "class", "id"])
        return f' {attribute}="{rng.choice(["", "site-", "js "])}{word}{rng.choice(["", "-box", " wide", "_1"])}"'

    def links(n):
        return "".join(f'<li><a href="/{i}">{" ".join(words(1, 3, "x"))}</a></li>' for i in range(n))

    def rest(kind):
        plain = lambda: sentence(2, 25, "x")
        tag, inner = {
            "menu": ("nav", f"<ul>{links(rng.randint(3, 12))}</ul>"),
            "head": ("header", f"<h1>{' '.join(words(1, 4, 'x'))}</h1><p>{plain()}</p>"),
            "foot": ("footer", rng.choice([f"&copy; {plain()}", f"<p>{plain()}</p><ul>{links(3)}</ul>"])),
            "side": ("aside", f"<h3>{' '.join(words(1, 3, 'x'))}</h3><ul>{links(5)}</ul><p>{plain()}</p>"),
            "ad": ("div", rng.choice([plain(), f"<p>{plain()}</p>", f'<a href="/ad">{plain()}</a>'])),
            "notice": ("div", f"<p>{plain()}</p><button>{' '.join(words(1, 2, 'x'))}</button>"),
            "form": ("form", f"<label>{' '.join(words(1, 3, 'x'))}</label><input><button>Gox</button><p>{plain()}</p>"),
            "talk": ("section", "".join(
                f"<div{named('talk')}><p>{sentence(3, 40, 'x')}</p></div>" for _ in range(rng.randint(1, 4)))),
            "share": ("div", f"<ul>{links(4)}</ul>"),
        }[kind]
        semantic = tag not in ("div", "section")
        if semantic and rng.random() < 0.4:
            tag, semantic = "div", False
        return f"<{tag}{named(kind) if not semantic or rng.random() < 0.5 else ''}>{inner}</{tag}>"

    article, lines = [], []

    def add(text, markup):
        lines.append(" ".join(text.split()))
        article.append(markup)

    title = " ".join(words(2, 10)).capitalize()
    if rng.random() < 0.9:
        add(title, f"<h1>{html.escape(title)}</h1>")
    short = rng.random() < 0.25
    for _ in range(rng.choice([1, 1, 2, 3, 5, 9])):
        text = sentence(1, 5) if short else " ".join(sentence(1, 30) for _ in range(rng.randint(1, 5)))
        add(text, rng.choice([
            f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<blockquote>{text}</blockquote>",
            f"<h2>{text}</h2>", f"<ul><li>{text}</li></ul>", f'<p><a href="/x">{text}</a></p>']))
        if rng.random() < 0.12:
            article.append(rest(rng.choice(["ad", "share", "notice", "form"])))
    wrap = rng.choice(["article", "article", "article", "main", "div", "section"])
    mark = named("good") if wrap in ("div", "section") or rng.random() < 0.3 else ""
    body = f"<{wrap}{mark}>{''.join(article)}</{wrap}>"
    if rng.random() < 0.3:
        body = f'<div{rng.choice(["", named("good")])}>{body}</div>'
    before = [rest(k) for k in rng.sample(["head", "menu", "notice", "ad", "side", "form"], rng.randint(1, 4))]
    after = [rest(k) for k in rng.sample(["talk", "side", "share", "ad", "form", "notice", "menu"], rng.randint(0, 3))]
    after.append(rest("foot"))
    page = ("<!DOCTYPE html><html><head><title>t</title></head><body>"
            + "".join(before) + body + "".join(after) + "</body></html>")
    return page, "\n".join(lines)


def labelled_nodes(pages: int = SAMPLE_PAGES, seed: int = SEED):
    """(features, label) of the nodes of generated pages; nodes that hold both kinds have none."""
    rng = random.Random(seed)
    for _ in range(pages):
        nodes = parse(sample_page(rng)[0])
        rows = features(nodes)
        inside = [[0, 0] for _ in nodes]
        for i in range(len(nodes) - 1, -1, -1):
            for _, text in nodes[i].runs:
                other = all(w.rstrip(".!,").endswith("x") for w in text.split() if w != "©")
                inside[i][not other] += 1
            if i:
                for k in (0, 1):
                    inside[nodes[i].parent][k] += inside[i][k]
        for row, (other, good) in zip(rows, inside):
            if bool(other) != bool(good):
                yield row, float(bool(good))


def fit(spark: SparkSession, pages: int = SAMPLE_PAGES) -> list[tuple[float, Tree]]:
    """Trees and their weights; a few thousand labelled nodes go in, TREES small trees come out."""
    sample = spark.createDataFrame(
        [(Vectors.dense(row), label) for row, label in labelled_nodes(pages)], ["features", "label"]).coalesce(1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=SEED).fit(sample.cache())
    sample.unpersist()

    def read(node) -> Tree:
        if node.subtreeDepth() == 0:
            return (node.prediction(),)
        split = node.split()
        return (split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild()))

    return [(w, read(tree._call_java("rootNode"))) for w, tree in zip(model.treeWeights, model.trees)]


def extract(pages: DataFrame, trees: list[tuple[float, Tree]], column: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the markup."""

    def convert(batch):
        return [pa.array(texts(list(texts_of(batch, column)), trees), pa.string())]

    return per_batch(pages, convert, [column], [T.StructField("text", T.StringType())])
