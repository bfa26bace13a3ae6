"""Main text of web pages: boosted trees over the nodes of a page, decoded along the tree.

A page is read into block elements and text runs. Every node has features of its subtree (text, density of links,
tags and sentence marks), its attribute words, depth, siblings and ancestors. The trees give each node the probability that
its subtree holds main text. Decoding takes the most probable labelling in which nothing below a dropped node is kept: a text
run stays only with all its ancestors.

The trees are fitted on a bounded sample of pages (``SAMPLE_PAGES``, the smallest hashes) with weak labels from semantic markup:
inside ``article`` or ``main`` is main text, inside navigation, headers, footers, asides, forms and the like is not. Sampled pages are also
used in altered form: articles under other tags, boilerplate blocks set into articles; so the trees have to weigh content and
attributes where the markup says nothing.

Defined cases: a null or empty page has the empty text and no characters; markup that never closes is closed at the end, but an
unclosed element that holds no text (a button, a drawing) before the next block; end tags that
close nothing are ignored, a stray ``<`` is text; repeated rows count each for themselves; an empty table gives an empty result; other columns of
the input are not looked at.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlake.llm.common import table

SAMPLE_PAGES = 240
TREES = 40
DEPTH = 4
RATE = 0.25
BINS = 16
PAGES_AT_ONCE = 256

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S
)
WORDS = re.compile(r"[a-z0-9]+")
ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TRUTH = re.compile(r'data-truth="([01])"')

# Element names of HTML by their role.
SKIPPED = frozenset("script style noscript template iframe title textarea svg canvas object select button math head video audio".split())
RAW = frozenset("script style noscript template iframe title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GROUPS = {
    name: n
    for n, names in enumerate(
        (
            "nav menu",
            "header footer",
            "aside dialog",
            "form fieldset label legend",
            "article main",
            "p blockquote pre figure figcaption address",
            "h1 h2 h3 h4 h5 h6",
            "ul ol li dl dt dd",
            "table tbody thead tfoot tr td th caption",
            "div section body html center details summary hgroup",
        )
    )
    for name in names.split()
}
TEXT_GROUP = 10
BOILER = frozenset(
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent footer form header hidden "
    "legal login menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo promotion reader readers "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget disqus copyright".split()
)
CONTENT = frozenset("article articlebody body content entry main post story text".split())
# An opening tag that ends an open element of the same kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CLOSED_BY_BLOCK = "p"
N_FEATURES = 27


class _Marks:
    """Where the tags of a name stand in a page. Names are compared without case in ASCII, in the page itself: some letters change
    their length in lower case."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.found: dict[tuple[str, str], list[int]] = {}

    def _places(self, before: str, name: str) -> list[int]:
        if (before, name) not in self.found:
            pattern = re.compile(rf"{before}{name}(?![a-z0-9:-])", re.I | re.A)
            self.found[before, name] = [m.start() for m in pattern.finditer(self.source)]
        return self.found[before, name]

    def _next(self, before: str, name: str, position: int) -> int | None:
        places = self._places(before, name)
        k = bisect_left(places, position)
        return places[k] if k < len(places) else None

    def next_end(self, name: str, position: int) -> int | None:
        """Place of the next end tag of ``name``."""
        return self._next("</", name, position)

    def closed(self, name: str, position: int) -> bool:
        """Whether an element that is open at ``position`` is closed before another of its name opens."""
        end, start = self.next_end(name, position), self._next("<", name, position)
        return end is not None and (start is None or end < start or name == "svg")


class Page:
    """Nodes in page order; parents come before their children."""

    def __init__(self, source: str) -> None:
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.attributes: list[str] = []
        self.text: list[str] = []
        self.links: list[int] = []
        self.place: list[int] = []
        self.truth: list[int] = []
        self.length = max(1, len(source))
        self._read(source)

    def _node(self, tag: str, parent: int, attributes: str, place: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attributes.append(attributes)
        self.text.append("")
        self.links.append(0)
        self.place.append(place)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack = [self._node("html", -1, "", 0)]
        parts: list[str] = []
        state = {"links": 0, "inside_link": 0, "begin": 0}

        def flush() -> None:
            joined = "".join(parts)
            parts.clear()
            if joined and not joined.isspace():
                text = " ".join(html.unescape(joined).split())
                if text:
                    leaf = self._node("#text", stack[-1], "", state["begin"])
                    self.text[leaf] = text
                    self.links[leaf] = min(state["links"], len(text))
            state["links"] = 0

        def add(piece: str, place: int) -> None:
            if piece:
                if not parts:
                    state["begin"] = place
                parts.append(piece)
                if state["inside_link"]:
                    state["links"] += len(piece)

        def close(k: int) -> None:
            """Close the open elements from the ``k``-th on."""
            for node in stack[k:]:
                opened[self.tag[node]] -= 1
            del stack[k:]

        at, skipping = 0, None
        depth = 0
        position = 0
        marks = _Marks(source)
        # How many elements of a name are open.
        opened = Counter()
        # Behind the last ``>`` no tag ends, and none is looked for.
        last = source.rfind(">") + 1
        while True:
            m = TOKEN.search(source, position, last)
            if m is None:
                break
            position = m.end()
            name = m[2].lower() if m[2] else None
            if skipping:
                if name in GROUPS and not m[1] and not marks.closed(skipping, m.start()):
                    # An element that is never closed ends before the next block.
                    skipping = None
                    at = m.start()
                else:
                    # Inside an element that never holds text: wait for its end.
                    if name == skipping:
                        depth += -1 if m[1] else 1
                        if depth <= 0:
                            skipping = None
                    at = position
                    continue
            add(source[at : m.start()], at)
            at = position
            if name is None:
                if m[0].startswith("<!--") and not m[0].endswith("-->"):
                    # A comment that is never closed holds the rest of the page.
                    at = position = len(source)
                continue
            if m[1]:
                if name == "a":
                    state["inside_link"] = 0
                elif opened[name]:
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] == name:
                            flush()
                            close(k)
                            break
                continue
            if name in SKIPPED:
                if not m[3].endswith("/"):
                    if name in RAW:
                        end = marks.next_end(name, position)
                        if end is not None:
                            close_at = source.find(">", end)
                            position = at = len(source) if close_at < 0 else close_at + 1
                        elif name in ("script", "style"):
                            # Their content is code to the end of the page; of the others an end was forgotten.
                            position = at = len(source)
                    elif name == "head":
                        # What belongs into a head is skipped by itself.
                        continue
                    else:
                        skipping, depth = name, 1
                if name in ("select", "button", "svg", "canvas", "object", "math", "video", "audio"):
                    add(" ", at)
                continue
            if name == "br" or name == "hr":
                add(" ", at)
            elif name == "a":
                state["inside_link"] = 1
            elif name in GROUPS and name not in VOID:
                flush()
                if self.tag[stack[-1]] == CLOSED_BY_BLOCK and name not in ("figure", "figcaption"):
                    close(len(stack) - 1)
                ends = ENDS.get(name)
                if ends and any(opened[tag] for tag in ends):
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] in ends:
                            close(k)
                            if name != "tr":
                                break
                        elif self.tag[stack[k]] in ("ul", "ol", "dl", "table", "tbody", "thead", "tr"):
                            break
                if name not in ("html", "body") or m[3].strip():
                    stack.append(self._node(name, stack[-1], m[3], m.start()))
                    opened[name] += 1
        if not skipping:
            rest = source[at:]
            add(rest[: rest.index("<!--")] if "<!--" in rest else rest, at)
        flush()


def _measure(page: Page) -> np.ndarray:
    """Features of every node."""
    n = len(page.tag)
    chars, links, tags, marks, runs, children = ([0] * n for _ in range(6))
    bad, good, above_bad, above_good, depth = ([0] * n for _ in range(5))
    index = [0] * n
    for i in range(n):
        parent = page.parent[i]
        if page.tag[i] == "#text":
            text = page.text[i]
            chars[i], links[i] = len(text), page.links[i]
            marks[i] = text.count(".") + text.count(",") + text.count("?") + text.count("!")
            bad[i], good[i] = bad[parent], good[parent]
        elif page.attributes[i]:
            found = [w for a in ATTRIBUTE.findall(page.attributes[i]) for w in WORDS.findall("".join(a).lower())]
            bad[i] = min(3, sum(w in BOILER for w in found))
            good[i] = min(3, sum(w in CONTENT for w in found))
        if parent >= 0:
            depth[i] = depth[parent] + 1
            index[i] = children[parent]
            children[parent] += 1
            group = GROUPS.get(page.tag[parent], TEXT_GROUP)
            above_bad[i] = above_bad[parent] + (bad[parent] > 0 or group <= 3)
            above_good[i] = above_good[parent] + (good[parent] > 0 or group == 4)
    for i in range(n - 1, 0, -1):
        parent = page.parent[i]
        chars[parent] += chars[i]
        links[parent] += links[i]
        marks[parent] += marks[i]
        tags[parent] += tags[i] + 1
        runs[parent] += runs[i] + (page.tag[i] == "p")
    whole = max(1, chars[0])
    out = np.zeros((n, N_FEATURES), np.float32)
    for i in range(n):
        parent = max(page.parent[i], 0)
        row = out[i]
        row[GROUPS.get(page.tag[i], TEXT_GROUP)] = 1
        size = chars[i]
        row[11:] = (
            bad[i],
            good[i],
            min(above_bad[i], 3),
            min(above_good[i], 3),
            min(depth[i], 12),
            math.log1p(size),
            links[i] / size if size else 0,
            size / whole,
            size / (tags[i] + 1),
            100 * marks[i] / size if size else 0,
            children[parent],
            index[i] / children[parent] if children[parent] else 0,
            min(runs[i], 20),
            page.place[i] / page.length,
            chars[parent] / whole,
            math.log1p((chars[parent] - size) / max(1, children[parent] - 1)),
        )
    return out


@dataclass
class Forest:
    start: float
    edges: list[np.ndarray]
    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1).astype(np.int16)
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.features, self.cuts, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Forest:
    """Trees of fixed depth by Newton steps on binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    # A yes-or-no feature that is rare keeps its own edge.
    edges = [np.unique(np.append(e, 0.5)) if set(np.unique(x[:, f])) <= {0.0, 1.0} else np.unique(np.append(e, (0.5,) if f in (11, 12, 13, 14) else ())) for f, e in enumerate(edges)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    width = BINS + 3
    start = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    score = np.full(len(y), start)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    features, cuts, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        slope, weight = y - p, p * (1 - p) + 1e-6
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width)
        at = np.zeros(len(y), np.int64)
        for node in range(inner):
            own = np.flatnonzero(at == node)
            if len(own) > 20:
                best = 1e-6
                g_all, h_all = slope[own].sum(), weight[own].sum()
                for f in range(x.shape[1]):
                    g = np.cumsum(np.bincount(bins[own, f], slope[own], width))
                    h = np.cumsum(np.bincount(bins[own, f], weight[own], width))
                    gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, k
            at[own] = 2 * node + 1 + (bins[own, feature[node]] > cut[node])
        leaf = at - inner
        value = RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, weight, leaves) + 1)
        score += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Forest(start, edges, np.array(features), np.array(cuts), np.array(values))


def decode(page: Page, log_odds: np.ndarray) -> str:
    """Text of the best labelling in which every node below a dropped one is dropped.

    ``log_odds`` is what keeping a node adds. The root is kept.
    """
    n = len(page.tag)
    below = [0.0] * n
    for i in range(n - 1, 0, -1):
        below[page.parent[i]] += max(0.0, float(log_odds[i]) + below[i])
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and float(log_odds[i]) + below[i] > 0
    return " ".join(page.text[i] for i in range(n) if kept[i] and page.tag[i] == "#text")


def weak_labels(page: Page) -> np.ndarray:
    """1 for text inside marked main content and nodes that hold such text, 0 for others."""
    n = len(page.tag)
    inside, label = [0] * n, np.zeros(n)
    for i in range(n):
        inside[i] = inside[page.parent[i]] if i else 0
        found = {w for a in ATTRIBUTE.findall(page.attributes[i]) for w in WORDS.findall("".join(a).lower())}
        group = GROUPS.get(page.tag[i], TEXT_GROUP)
        truth = TRUTH.search(page.attributes[i])
        if inside[i] >= 0:
            if truth:
                inside[i] = 1 if truth[1] == "1" else -1
            elif group <= 3 or found & BOILER:
                inside[i] = -1
            elif group == 4:
                inside[i] = 1
        label[i] = page.tag[i] == "#text" and inside[i] == 1
    for i in range(n - 1, 0, -1):
        label[page.parent[i]] = max(label[page.parent[i]], label[i])
    return label


def altered(source: str, rng: random.Random) -> str:
    """A page with its article under another tag and blocks of boilerplate set into it."""
    wrap = rng.choice(["div", 'div class="content"', 'div id="main"', "section", 'div class="post"', "main", "article"])
    out = re.sub(r"<(?:article|main)\b[^>]*>", f'<{wrap} data-truth="1">', source)
    out = re.sub(r"</(?:article|main)>", f"</{wrap.split()[0]}>", out)
    if rng.random() < 0.5:
        menu, foot = rng.choice(["menu", "navbar", "top"]), rng.choice(["footer", "legal", "bottom"])
        out = out.replace("<nav>", f'<div class="{menu}" data-truth="0">').replace("</nav>", "</div>")
        out = out.replace("<footer>", f'<div id="{foot}" data-truth="0">').replace("</footer>", "</div>")
    phrases = [p for p in re.findall(r">([^<>]{20,300})<", source)] or ["read more about this"]
    words = sorted(BOILER)
    pieces = out.split("</p>")
    for _ in range(rng.randint(1, 4)):
        text = " ".join(rng.choice(phrases) for _ in range(rng.randint(1, 4)))
        kind = rng.choice(["div", "section", "aside", "form", "ul", "header", "footer", "nav", "p"])
        mark = f' {rng.choice(["class", "id"])}="{rng.choice(words)}"' if kind in ("div", "section", "ul", "p") or rng.random() < 0.3 else ""
        inner = f"<p>{text}</p><p>{rng.choice(phrases)}</p>" if kind not in ("ul", "p") else f"<li>{text}</li>" if kind == "ul" else text
        pieces.insert(rng.randint(0, len(pieces) - 1), f'<{kind}{mark} data-truth="0">{inner}</{kind}>')
    return "</p>".join(pieces)


def fit(pages: DataFrame) -> Forest | None:
    """The trees from a bounded sample of ``pages`` (page_id, html); none where no sampled page has marked content."""
    sample = (
        pages.where(F.length("html") > 0)
        .select("page_id", F.xxhash64("page_id", F.lit("sample")).alias("h"))
        .distinct()
        .orderBy("h", "page_id")
        .limit(SAMPLE_PAGES)
    )
    rows = pages.join(F.broadcast(sample), "page_id").select("h", "html").orderBy("h", "html").limit(2 * SAMPLE_PAGES).collect()
    rng = random.Random(11)
    features, labels = [], []
    for row in rows:
        for source in (row.html, altered(row.html, rng), altered(row.html, rng)):
            page = Page(source)
            label = weak_labels(page)
            if label.any():
                features.append(_measure(page)[1:])
                labels.append(label[1:])
    return boost(np.concatenate(features), np.concatenate(labels)) if features else None


def texts(pages: list[str], forest: Forest | None) -> list[str]:
    """Main text of each page. Without trees the marked content stands, or all text where nothing is marked."""
    read = [Page(source) for source in pages]
    if not read:
        return []
    if forest is None:
        return [decode(p, np.where((m := weak_labels(p)) > 0, 1.0, -1.0) if m.any() else np.ones(len(m))) for p in read]
    odds = forest.log_odds(np.concatenate([_measure(p) for p in read]))
    ends = np.cumsum([len(p.tag) for p in read])[:-1]
    return [decode(p, o) for p, o in zip(read, np.split(odds, ends))]


def extract(pages: DataFrame, forest: Forest | None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html)."""
    fields = {f.name.lower(): f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(start, PAGES_AT_ONCE)
                found = texts([h or "" for h in batch.column("html").to_pylist()], forest)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"),
                        batch.column("url"),
                        pa.array(found, pa.string()),
                        pa.array([len(t) for t in found], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {fields['page_id']}, url string, text string, n_chars long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of ``op8_boosted_dom``."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
