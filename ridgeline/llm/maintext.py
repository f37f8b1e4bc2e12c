"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements; runs of text between them are the
leaves. Each node has features of its own (depth, text, links, density of its subtree),
of its siblings, and of the tokens in its and its ancestors' names, classes, ids and
roles. Gradient-boosted trees give the probability that a node's subtree is main text.

Decoding picks the likeliest labelling in which no node contradicts its ancestors: a node
is *passed through* (its children decide), *content* (its children are content unless
dropped) or *dropped* (with all below). One pass up the tree finds the best score of each
state, one pass down reads the labels.

The trees are fitted by Spark on pages composed here: layouts with known roles, filled
with texts of a bounded sample of the given pages. Nothing of a real page's structure is
taken as truth.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.texts import Texts, map_texts
from ridgeline.runtime import materialize

# Pages whose texts fill the training pages, and how many of those there are.
SAMPLE_PAGES = 200
TRAINING_PAGES = 400
TREES, DEPTH = 24, 4

BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
# Never text: what stands between start and end tag is skipped.
SKIPPED = frozenset("script style noscript template title textarea svg iframe object head math canvas audio video".split())
_RAW = frozenset("script style title textarea iframe".split())
# Start tags that end an open element of these names, and where the search for it stops.
_ENDS_P = BLOCKS - frozenset("body html button option select td th tr tbody thead tfoot caption legend summary".split())
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S)
# Tags of the elements that are skipped as a whole, past comments and raw texts.
_PAIRED = SKIPPED - _RAW - {"head"}
_PAIRS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(sorted(_RAW))})\b.*?(?:</\1\b|\Z)|<(/?)({'|'.join(sorted(_PAIRED))})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S | re.I
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[A-Za-z][a-z]+|[A-Z]+")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII = re.compile("[\x00-\x7f]+")
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


@dataclass
class Node:
    """A block element, or a run of text (then ``text`` is set)."""

    tag: str
    parent: int
    depth: int
    tokens: list[str]
    text: str = ""
    links: int = 0
    children: list[int] = field(default_factory=list)
    role: int = -1


def _ended(page: str) -> dict[int, int]:
    """For each start tag of a skipped element that is ended: where it begins, and where its end tag does end."""
    open_at: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for found in _PAIRS.finditer(page):
        name = (found[3] or "").lower()
        if not name:
            continue
        starts = open_at.setdefault(name, [])
        if not found[2]:
            if not found[4].rstrip().endswith("/"):
                starts.append(found.start())
        elif starts:
            out[starts.pop()] = found.end()
    return out


def parse(page: str) -> list[Node]:
    """The nodes of a page in document order; a parent stands before its children."""
    nodes = [Node("html", -1, 0, [])]
    stack = [0]
    runs: list[str] = []
    anchor, linked = False, 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(runs)).split())
        if text:
            top = stack[-1]
            nodes[top].children.append(len(nodes))
            nodes.append(Node("#text", top, nodes[top].depth + 1, [], text, min(linked, len(text))))
        runs.clear()
        linked = 0

    def close(names: set[str], until: set[str]) -> None:
        """Ends the outermost open element of ``names`` above the nearest of ``until``."""
        for i in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[i]].tag
            if tag in until:
                break
            if tag in names:
                flush()
                del stack[i:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            runs.append(text)
            if anchor:
                linked += len(text.strip())

    at, skipping, depth_skipped = 0, "", 0
    size, ended = len(page), _ended(page)
    while at < size:
        found = _MARKUP.search(page, at)
        if found is None:
            if not skipping:
                add(page[at:])
            break
        if not skipping and found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        if at == found.start():
            at += 1
        name = (found[2] or "").lower()
        if not name:
            continue
        ending = bool(found[1])
        if skipping:
            if name == skipping:
                depth_skipped += -1 if ending else 1
                if depth_skipped <= 0:
                    skipping = ""
            elif skipping == "head" and name in BLOCKS and not ending:
                # A head that was never ended.
                skipping = ""
            if skipping:
                continue
            if ending:
                continue
        if name in SKIPPED and not ending:
            if found[3].rstrip().endswith("/"):
                continue
            runs.append(" ")
            if name in _RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            elif name == "head":
                skipping, depth_skipped = name, 1
            else:
                # One that is never ended hides nothing: what follows it is text like any other.
                at = ended.get(found.start(), at)
            continue
        if name == "a":
            anchor = not ending
            continue
        if name == "br" or name == "hr" or name == "img":
            runs.append(" ")
            continue
        if name not in BLOCKS:
            continue
        if ending:
            for i in range(len(stack) - 1, 0, -1):
                if nodes[stack[i]].tag == name:
                    flush()
                    del stack[i:]
                    break
            anchor = False
            continue
        if name in ("html", "body"):
            flush()
            nodes[0].tokens += _tokens(name, found[3])
            continue
        if name in _ENDS_P:
            close({"p"}, {"td", "th", "table", "button", "li", "div", "article", "section", "main", "blockquote"})
        if name in _CLOSES:
            close(*_CLOSES[name])
        flush()
        top = stack[-1]
        nodes[top].children.append(len(nodes))
        stack.append(len(nodes))
        nodes.append(Node(name, top, nodes[top].depth + 1, _tokens(name, found[3])))
    flush()
    return nodes


def _tokens(tag: str, attributes: str) -> list[str]:
    """The tag and the words of class, id and role; ``sideBar-left`` has three."""
    out = [f"<{tag}>"]
    if attributes:
        for found in _ATTRIBUTE.finditer(attributes):
            out += [t.lower() for t in _TOKEN.findall(found[2] or found[3] or found[4] or "")]
    return out


FIELDS = (
    "depth chars links words stops nodes density share place siblings place_among sibling_chars sibling_links "
    "own_odds line_odds line_worst line_best child_odds mean_chars capitals"
).split()


def _capitals(text: str) -> int:
    """Upper-case letters: a call per character is made only for those outside ASCII."""
    raw = text.encode()
    found = len(raw) - len(raw.translate(None, _UPPER))
    return found if len(raw) == len(text) else found + sum(map(str.isupper, _ASCII.sub("", text)))


def features(nodes: list[Node], odds: dict[str, float]) -> np.ndarray:
    """One row per node, columns as in ``FIELDS``."""
    n = len(nodes)
    chars, links, words, stops, count, capitals, leaves = ([0] * n for _ in range(7))
    begin = [0] * n
    seen = 0
    for i, node in enumerate(nodes):
        begin[i] = seen
        if node.text:
            chars[i], links[i] = len(node.text), node.links
            words[i] = node.text.count(" ") + 1
            stops[i] = len(_SENTENCE.findall(node.text))
            capitals[i] = _capitals(node.text)
            leaves[i] = 1
            seen += chars[i]
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for totals in (chars, links, words, stops, capitals, leaves):
            totals[up] += totals[i]
        count[up] += count[i] + 1
    whole = max(1, chars[0])
    # The strongest token speaks for a node.
    own = [max((odds.get(t, 0.0) for t in node.tokens), key=abs, default=0.0) for node in nodes]
    total, worst, best = [0.0] * n, [0.0] * n, [0.0] * n
    for i, node in enumerate(nodes):
        up = node.parent
        total[i] = own[i] + (total[up] if up >= 0 else 0.0)
        worst[i] = min(own[i], worst[up] if up >= 0 else 0.0)
        best[i] = max(own[i], best[up] if up >= 0 else 0.0)
    out = np.zeros((n, len(FIELDS)))
    for i, node in enumerate(nodes):
        family = nodes[node.parent].children if node.parent >= 0 else [0]
        around = max(1, len(family))
        # Of a wide family the totals of the parent serve, so that no list is walked per child.
        up = node.parent if node.parent >= 0 else i
        others = max(1, around - 1)
        rest_chars, rest_links = chars[up] - chars[i], links[up] - links[i]
        out[i] = (
            node.depth, np.log1p(chars[i]), links[i] / max(1, chars[i]), np.log1p(words[i]), stops[i] / max(1, words[i]) * 10,
            np.log1p(count[i]), chars[i] / (count[i] + 1), chars[i] / whole, begin[i] / whole, np.log1p(around), 0.0,
            np.log1p(max(0, rest_chars) / others), rest_links / max(1, rest_chars),
            own[i], total[i], worst[i], best[i], 0.0, np.log1p(chars[i] / max(1, leaves[i])), capitals[i] / max(1, chars[i]),
        )
    for i, node in enumerate(nodes):
        if node.children:
            out[i, 17] = min(own[c] for c in node.children)
            out[node.children, 10] = np.arange(len(node.children)) / len(node.children)
    return out


class Trees:
    """Boosted regression trees as arrays; the sum of their leaves is half the log odds."""

    def __init__(self, model):
        self.trees = []
        for weight, tree in zip(model.treeWeights, model.trees):
            feature, threshold, left, right, value = [], [], [], [], []

            def walk(node) -> int:
                at = len(feature)
                for column in (feature, threshold, left, right, value):
                    column.append(0)
                value[at] = node.prediction() * weight
                if node.subtreeDepth() > 0:
                    feature[at], threshold[at] = node.split().featureIndex(), node.split().threshold()
                    left[at], right[at] = walk(node.leftChild()), walk(node.rightChild())
                return at

            walk(tree._java_obj.rootNode())
            self.trees.append((np.array(feature), np.array(threshold, float), np.array(left), np.array(right), np.array(value, float)))
        self.depth = max(tree.depth for tree in model.trees)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                # A leaf has no children and stays where it is.
                down = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
                at = np.where(left[at] > 0, down, at)
            total += value[at]
        return 1 / (1 + np.exp(-2 * total))


def decode(nodes: list[Node], probability: np.ndarray) -> list[int]:
    """The leaves to keep: the likeliest labelling without contradictions.

    Scores are log probabilities. Passing through costs a node as much as an even
    guess; a leaf cannot pass through. Ties go to what keeps more.
    """
    n = len(nodes)
    sure = np.clip(probability, 1e-4, 1 - 1e-4)
    keep, drop = np.log(sure).tolist(), np.log(1 - sure).tolist()
    even = float(np.log(0.5))
    content, dropped, through = [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        content[i] += keep[i]
        dropped[i] += drop[i]
        through[i] = -np.inf if nodes[i].text else through[i] + even
        up = nodes[i].parent
        if up >= 0:
            inside = max(content[i], dropped[i])
            content[up] += inside
            dropped[up] += dropped[i]
            through[up] += max(inside, through[i])
    state = [""] * n
    kept = []
    for i, node in enumerate(nodes):
        above = state[node.parent] if node.parent >= 0 else "through"
        if above == "dropped":
            state[i] = "dropped"
        elif content[i] >= dropped[i] and (above == "content" or content[i] >= through[i]):
            state[i] = "content"
        elif above == "content" or dropped[i] > through[i]:
            state[i] = "dropped"
        else:
            state[i] = "through"
        if node.text and state[i] == "content":
            kept.append(i)
    return kept


# What composed pages are made of: (names, classes) of wrappers by role.
_CONTENT = ("article", "main", "div post", "div content", "div entry-content", "section story", "div article-body", "div text", "section main", "div", "div page-content", "article post")
_MENUS = ("nav", "ul menu", "div navbar", "div breadcrumbs", "nav main-menu", "ul pagination", "div toc nav", "div skip-links")
_HEADS = ("header", "div header", "div masthead", "div topbar", "header site-header")
_FOOTS = ("footer", "div footer", "div copyright", "footer site-footer", "div legal bottom")
_SIDES = ("aside", "div sidebar", "div widget", "section related", "aside recommended", "div popular", "div tags", "div share social")
_ADS = ("div ad", "div advert", "div sponsored", "section promo", "div banner", "aside ad-slot", "div advertisement")
_NOTICES = ("div cookie-notice", "div notice", "div alert", "div consent gdpr", "div newsletter subscribe", "section popup modal")
_FORMS = ("form", "form search", "form login", "form newsletter", "div search-form")
_COMMENTS = ("div comments", "section comments", "div disqus thread", "ol comment-list", "div replies", "section user-comments responses")
_DROPPED = (_MENUS, _HEADS, _FOOTS, _SIDES, _ADS, _NOTICES, _FORMS, _COMMENTS)


def compose(draw: random.Random, texts: list[str]) -> str:
    """A page with a known main text: elements whose subtree belongs to it bear ``data-main``."""

    def some(low: int, high: int) -> str:
        words = " ".join(draw.choice(texts) for _ in range(3)).split()
        size = draw.randint(low, high)
        at = draw.randrange(max(1, len(words) - size))
        return html.escape(" ".join(words[at : at + size])) or "text"

    def sentence(low: int, high: int) -> str:
        return some(low, high).rstrip(",;:") + draw.choice((".", ".", ".", "!", "?"))

    # Some sites name their parts by numbers: there the structure alone has to tell.
    mute = draw.random() < 0.25

    def wrap(kind: str, inner: str, main: bool = False) -> str:
        tag, _, classes = kind.partition(" ")
        if mute and classes:
            classes = f"c{draw.randrange(100)}"
        attribute = f' {draw.choice(("class", "class", "id", "role"))}="{classes}"' if classes else ""
        return f"<{tag}{attribute}{' data-main' if main else ''}>{inner}</{tag}>"

    def links(count: int) -> str:
        items = [f'<a href="/{i}">{some(1, 4)}</a>' for i in range(count)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if draw.random() < 0.7 else " | ".join(items)

    def paragraph(low: int, high: int, main: bool) -> str:
        mark = " data-main" if main else ""
        text = " ".join(sentence(max(1, low // 3), high) for _ in range(draw.randint(1, 4)))
        if draw.random() < 0.2:
            text = f'{text} <a href="/x">{some(1, 3)}</a> {sentence(2, 6)}'
        if draw.random() < 0.1:
            text = f"<b>{text}"
        return f"<p{mark}>{text}" + ("</p>" if draw.random() < 0.8 else "")

    def dropped(group: tuple[str, ...]) -> str:
        kind = draw.choice(group)
        if group is _MENUS:
            return wrap(kind, links(draw.randint(2, 10)))
        if group is _COMMENTS:
            items = "".join(wrap(draw.choice(("div comment", "li reply", "div")), f"<b>{some(1, 2)}</b> {paragraph(3, 25, False)}") for _ in range(draw.randint(1, 4)))
            return wrap(kind, f"<h3>{some(1, 2)}</h3>" * (draw.random() < 0.5) + items)
        if group is _FORMS:
            return wrap(kind, f"<label>{some(1, 4)}</label><input name=q><button>{some(1, 2)}</button>" + f"<p>{sentence(3, 12)}</p>" * (draw.random() < 0.4))
        if group is _FOOTS:
            return wrap(kind, f"&copy; {some(1, 3)} &middot; {sentence(3, 14)}" + links(3) * (draw.random() < 0.5))
        if group is _HEADS:
            return wrap(kind, f"<h2>{some(1, 5)}</h2>" + (links(5) if draw.random() < 0.6 else f"<p>{sentence(2, 8)}</p>"))
        if group is _SIDES:
            return wrap(kind, f"<h3>{some(1, 3)}</h3>" + (links(5) if draw.random() < 0.6 else paragraph(3, 20, False)))
        return wrap(kind, sentence(3, 20) if draw.random() < 0.6 else f"<p>{sentence(3, 25)}</p>")

    def article() -> str:
        parts = [f"<h1 data-main>{some(2, 10)}</h1>"] if draw.random() < 0.85 else []
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.75:
                parts.append(paragraph(3, 60, True))
            elif kind < 0.82:
                parts.append(f"<h2 data-main>{some(1, 7)}</h2>")
            elif kind < 0.88:
                parts.append("<ul data-main>" + "".join(f"<li data-main>{sentence(3, 18)}" for _ in range(draw.randint(2, 6))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote data-main>{paragraph(4, 30, True)}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<table data-main><tr data-main><td data-main>{some(1, 6)}<td data-main>{some(1, 6)}</table>")
            else:
                parts.append(dropped(draw.choice((_ADS, _SIDES, _NOTICES))))
        return "".join(parts)

    before = [dropped(draw.choice((_MENUS, _HEADS, _ADS, _NOTICES, _FORMS))) for _ in range(draw.randint(0, 4))]
    after = [dropped(draw.choice(_DROPPED)) for _ in range(draw.randint(0, 4))]
    body = wrap(draw.choice(_CONTENT), article(), True)
    for _ in range(draw.randrange(3)):
        body = wrap(draw.choice(("div", "div wrapper", "div container", "section", "main", "div row")), body + dropped(draw.choice((_SIDES, _COMMENTS))) * (draw.random() < 0.4))
    return f"<html><head><title>{some(2, 5)}</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>"


_MAIN_TAG = re.compile(r"<([a-z0-9]+)([^>]*) data-main>")


def labelled(page: str) -> list[Node]:
    """The nodes of a composed page with their roles: 1 main text, 0 dropped, -1 passed through."""
    # The mark rides on as a token and is taken off again.
    nodes = parse(_MAIN_TAG.sub(r'<\1\2 role="Xmainmark">', page))
    for node in nodes:
        if "xmainmark" in node.tokens:
            node.tokens.remove("xmainmark")
            node.role = 1
        elif node.text:
            node.role = max(0, nodes[node.parent].role)
        else:
            node.role = 0
    # Around main text lie wrappers, which are neither.
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[nodes[i].parent]
        if nodes[i].role in (1, -1) and up.role == 0:
            up.role = -1
    return nodes


def token_odds(pages: list[list[Node]]) -> dict[str, float]:
    """Log odds of main text for the tokens of elements, shrunk towards zero."""
    seen: dict[str, list[int]] = {}
    for nodes in pages:
        for node in nodes:
            if node.role >= 0:
                for token in set(node.tokens):
                    seen.setdefault(token, [0, 0])[node.role] += 1
    return {t: float(np.log((good + 1) / (bad + 1))) for t, (bad, good) in seen.items()}


class PageModel:
    """Odds of tokens and the trees."""

    def __init__(self, odds: dict[str, float], trees: Trees):
        self.odds, self.trees = odds, trees

    def extract(self, pages: list[str]) -> list[str]:
        """The main text of each page: its kept blocks, one to a line."""
        parsed = [parse(p) for p in pages]
        if not parsed:
            return []
        rows = [features(nodes, self.odds) for nodes in parsed]
        probability = self.trees.probability(np.concatenate(rows))
        out, at = [], 0
        for nodes in parsed:
            kept = decode(nodes, probability[at : at + len(nodes)])
            at += len(nodes)
            out.append("\n".join(nodes[i].text for i in kept))
        return out


def training_pages(texts: list[str], count: int = TRAINING_PAGES) -> list[list[Node]]:
    """Composed pages, the same in every run."""
    draw = random.Random(11)
    return [labelled(compose(draw, texts)) for _ in range(count)]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> PageModel:
    """Fits on ``TRAINING_PAGES`` composed pages filled with texts of at most ``SAMPLE_PAGES`` given ones.

    The sampled pages are those with the smallest hashes of their ids. Without any, the
    pages are filled with a few fixed words.
    """
    spark = pages.sparkSession
    named = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").cast("string").alias("html")).where("html is not null")
    ids = named.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PAGES).withColumnRenamed("id", "one")
    few = named.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("one"))).groupBy("id").agg(F.min("html").alias("html"))

    def start():
        def work(texts: Texts, _rows):
            # Every text of a page, whatever its part: words to fill pages with.
            return [pa.array([" ".join(n.text for n in parse(t.decode()) if n.text) for t in texts.rows()])]

        return work

    filled = map_texts(few, "html", ["id"], "text string", start).select("row.id", "text").where("text <> ''")
    texts = [r.text for r in filled.orderBy(F.xxhash64("id"), "id").collect()]
    made = training_pages(texts or ["some words that fill a page where no other is known"])
    odds = token_odds(made)
    rows = []
    for nodes in made:
        x = features(nodes, odds)
        rows += [(float(n.role), [float(v) for v in x[i]]) for i, n in enumerate(nodes) if n.role >= 0]
    table = spark.createDataFrame(rows, "label double, x array<double>").repartition(2)
    table = materialize(table, "page-nodes").select("label", array_to_vector("x").alias("features"))
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3).fit(table)
    return PageModel(odds, Trees(fitted))


def extract(pages: DataFrame, model: PageModel, html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``text`` and ``n_chars`` (code points).

    A null or empty page has an empty text, as has one without main text. Whole pages are
    read. Repeated rows get equal texts; an empty table gives none.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value

        def work(texts: Texts, _rows):
            made = known.extract([t.decode() for t in texts.rows()])
            return [pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())]

        return work

    return map_texts(pages, html_col, carry or ["page_id", "url"], "text string, n_chars long", start)
