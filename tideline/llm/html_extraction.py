"""The main text of web pages: a minimum cut between content and the rest over each page's blocks."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.page_blocks import HEADINGS, Page, parse

#: Pages that the classifier is fitted on, at most, and blocks of each.
MAX_PAGES = 2_000
MAX_BLOCKS = 200
#: Log-odds that an element gives its text by its name, role or class, and what a page with a marked
#: main text gives to all that stands outside it.
MARKED = 6.0
OUTSIDE = 3.0
#: Log-odds of the words alone stay within this.
MOST_BY_TEXT = 4.0
#: Costs of parting two blocks that follow each other, and a block or element from its parent.
ADJACENT = 0.7
PARENT = 0.5
#: Blocks at so many steps through the tree are hardly linked, so steps are counted no further.
FAR = 100
#: Capacities are whole numbers, so many to one unit of cost.
UNIT = 1_000

# What the classifier looks at, with the weights that the fit starts from and is drawn to.

PRIOR = {
    "bias": -1.0,
    "length": 2.0,
    "linked": -4.0,
    "heading": 1.0,
    "title": 2.0,
    "paragraph": 1.0,
    "item": -0.5,
    "sentence": 1.5,
    "stops": 1.0,
    "signs": -2.0,
    "digits": -1.0,
    "capitals": -0.5,
    "near_linked": -1.0,
    "near_length": 1.0,
}
FEATURES = list(PRIOR)
_SIGNS = re.compile("[©®™·•|»«›‹→]")
_DIGITS = re.compile("[0-9]")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-ÞΑ-ΩЀ-Я]")
_ENDS = re.compile("[.!?…。！？:;][\"'”’»)]*$")


def features(page: Page) -> list[list[float]]:
    """Numbers about each block's text and neighbours, none about what its elements are marked as."""
    lengths = [log1p(len(b.text)) / 5 for b in page.blocks]
    links = [min(1.0, b.linked / len(b.text)) for b in page.blocks]
    last = len(page.blocks) - 1
    rows = []
    for k, block in enumerate(page.blocks):
        text, tag = block.text, page.nodes[block.node].tag
        size = len(text)
        words = text.count(" ") + 1
        near = [i for i in (k - 1, k + 1) if 0 <= i <= last]
        rows.append(
            [
                1.0,
                lengths[k],
                links[k],
                float(tag in HEADINGS),
                float(tag == "h1"),
                float(tag in ("p", "blockquote", "pre")),
                float(tag in ("li", "dt", "dd")),
                float(_ENDS.search(text[-8:]) is not None),
                min(1.0, 5 * (text.count(". ") + text.count(", ")) / words),
                min(1.0, 4 * len(_SIGNS.findall(text)) / words),
                len(_DIGITS.findall(text)) / size,
                min(1.0, 2 * len(_CAPITALS.findall(text)) / size),
                sum(links[i] for i in near) / len(near) if near else 0.0,
                sum(lengths[i] for i in near) / len(near) if near else 0.0,
            ]
        )
    return rows


def fit_weights(x: np.ndarray, y: np.ndarray, strength: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Logistic regression by Newton's steps, both classes of equal weight, drawn to the prior weights."""
    prior = np.array(list(PRIOR.values()))
    if not len(y) or y.min() == y.max():
        return prior
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * min(len(y), 1000)
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + strength * (w - prior)
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + strength * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
    return w


def log_odds(page: Page, weights: list[float]) -> list[float]:
    """Of each block being content, from its text and from what its elements are marked as."""
    found = []
    marked = any(page.nodes[b.node].mark > 0 for b in page.blocks)
    for block, row in zip(page.blocks, features(page), strict=True):
        by_text = sum(map(float.__mul__, row, weights))
        mark = page.nodes[block.node].mark
        by_mark = MARKED * mark if mark else -OUTSIDE * marked
        found.append(max(-MOST_BY_TEXT, min(MOST_BY_TEXT, by_text)) + by_mark)
    return found


# The cut.


class Cut:
    """A graph between content and the rest, cut where that costs least.

    ``lean[v]`` is what it costs to call v the rest, less what it costs to call it content;
    ``links[v]`` what it costs to part v from each of its neighbours.
    """

    def __init__(self, size: int):
        self.lean = [0] * size
        self.links: list[dict[int, int]] = [{} for _ in range(size)]

    def link(self, a: int, b: int, cost: int) -> None:
        if a != b and cost > 0:
            self.links[a][b] = self.links[a].get(b, 0) + cost
            self.links[b][a] = self.links[b].get(a, 0) + cost

    def content(self) -> list[bool]:
        """The labels of a cheapest cut; of several, the one with the most content."""
        label = self._settled()
        left = [v for v, found in enumerate(label) if found is None]
        if left:
            self._flow(left, label)
        return [bool(x) for x in label]

    def _settled(self) -> list[bool | None]:
        """Labels of those that lean one way more than all their links can pull them the other way.

        Their neighbours' costs take the links up, which may settle those in turn. Any
        cheapest cut of what is left completes to a cheapest cut of the whole.
        """
        label: list[bool | None] = [None] * len(self.lean)
        pull = [sum(around.values()) for around in self.links]
        waiting = deque(range(len(label)))
        while waiting:
            v = waiting.popleft()
            if label[v] is not None or not (self.lean[v] >= pull[v] or -self.lean[v] > pull[v]):
                continue
            label[v] = self.lean[v] >= 0
            for u, cost in self.links[v].items():
                if label[u] is None:
                    self.lean[u] += cost if label[v] else -cost
                    pull[u] -= cost
                    waiting.append(u)
        return label

    def _flow(self, left: list[int], label: list[bool | None]) -> None:
        """Maximum flow from content to the rest through the vertices that are left, along shortest paths level by level."""
        place = {v: k for k, v in enumerate(left)}
        source, sink = len(left), len(left) + 1
        heads: list[int] = []
        room: list[int] = []
        edges: list[list[int]] = [[] for _ in range(len(left) + 2)]

        def join(a: int, b: int, forth: int, back: int) -> None:
            edges[a].append(len(heads))
            edges[b].append(len(heads) + 1)
            heads.extend((b, a))
            room.extend((forth, back))

        for v, k in place.items():
            if self.lean[v] > 0:
                join(source, k, self.lean[v], 0)
            elif self.lean[v] < 0:
                join(k, sink, -self.lean[v], 0)
            for u, cost in self.links[v].items():
                if u in place and place[u] > k:
                    join(k, place[u], cost, cost)

        while True:
            # How far each vertex is from the sink along edges with room; those out of reach stay content.
            far = [-1] * (len(left) + 2)
            far[sink] = 0
            waiting = deque([sink])
            while waiting:
                v = waiting.popleft()
                for e in edges[v]:
                    if far[heads[e]] < 0 and room[e ^ 1] > 0:
                        far[heads[e]] = far[v] + 1
                        waiting.append(heads[e])
            if far[source] < 0:
                break
            tried = [0] * (len(left) + 2)
            path: list[int] = []
            v = source
            while True:
                if v == sink:
                    through = min(room[e] for e in path)
                    for e in path:
                        room[e] -= through
                        room[e ^ 1] += through
                    short = next(k for k, e in enumerate(path) if not room[e])
                    v = heads[path[short] ^ 1]
                    del path[short:]
                    continue
                while tried[v] < len(edges[v]):
                    e = edges[v][tried[v]]
                    if room[e] > 0 and far[heads[e]] == far[v] - 1:
                        break
                    tried[v] += 1
                if tried[v] < len(edges[v]):
                    path.append(e)
                    v = heads[e]
                elif path:
                    v = heads[path.pop() ^ 1]
                    tried[v] += 1
                else:
                    break
        for v, k in place.items():
            label[v] = far[k] < 0


def costs(odds: float) -> int:
    """Cost of calling a block the rest, less that of calling it content: both are minus logarithms of the other's chance."""
    p = 1 / (1 + exp(-odds))
    return round(UNIT * (log(p) - log(1 - p)))


def label_blocks(page: Page, weights: list[float]) -> list[bool]:
    """Which blocks of a page are content.

    Blocks that follow each other are linked, the less the more elements stand between them; so are
    blocks and elements with the elements they stand in.
    """
    size = len(page.blocks)
    holders: dict[int, int] = {}

    def vertex(node: int) -> int:
        return holders.setdefault(node, size + len(holders))

    links = []
    for k, block in enumerate(page.blocks):
        links.append((k, vertex(block.node), PARENT))
        if k:
            links.append((k - 1, k, ADJACENT / (1 + _between(page, page.blocks[k - 1].node, block.node))))
    waiting = list(holders)
    while waiting:
        node = waiting.pop()
        outer = page.nodes[node].parent
        if outer > 0:
            if outer not in holders:
                waiting.append(outer)
            links.append((vertex(node), vertex(outer), PARENT))
    cut = Cut(size + len(holders))
    for k, odds in enumerate(log_odds(page, weights)):
        cut.lean[k] = costs(odds)
    for a, b, cost in links:
        cut.link(a, b, round(UNIT * cost))
    return cut.content()[:size]


def _between(page: Page, a: int, b: int) -> int:
    """Steps from one element to another through the tree; more than ``FAR`` count as that."""
    steps = 0
    while a != b and steps < FAR:
        if page.nodes[a].depth >= page.nodes[b].depth:
            a = page.nodes[a].parent
        else:
            b = page.nodes[b].parent
        steps += 1
    return steps


# Over tables.


def fit(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES, max_blocks: int = MAX_BLOCKS) -> list[float]:
    """The classifier's weights, from blocks whose elements say what they are.

    At most ``max_pages`` different pages are taken, those with the smallest hashes, and at
    most ``max_blocks`` blocks of each, evenly over the page. Where elements never say so, or
    only one kind of block is found, the prior weights are given back.
    """
    key = F.xxhash64(F.col(html_col))
    texts = pages.select(key.alias("key"), F.col(html_col).alias("html")).where(F.col("html").isNotNull())
    last = texts.groupBy("key").agg(F.lit(1)).orderBy("key").limit(max_pages).agg(F.max("key")).first()[0]
    if last is None:
        return list(PRIOR.values())
    sample = texts.where(F.col("key") <= last).groupBy("key").agg(F.min("html").alias("html"))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, rows = [], []
            for value in batch.column("html"):
                page = parse(value.as_py())
                marks = [page.nodes[b.node].mark for b in page.blocks]
                known = [k for k, mark in enumerate(marks) if mark]
                known = known[:: max(1, -(-len(known) // max_blocks))]
                found = features(page)
                labels += [int(marks[k] > 0) for k in known]
                rows += [found[k] for k in known]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(labels), pa.int32()), pa.array(labels, pa.int32()), pa.array(rows, pa.list_(pa.float64()))],
                ["one", "label", "row"],
            )

    def train(table: pa.Table) -> pa.Table:
        y = table.column("label").to_numpy().astype(np.float64)
        x = table.column("row").combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES))
        order = np.lexsort([y, *x.T])
        return pa.table({"weights": [fit_weights(x[order], y[order]).tolist()]})

    # Bounded by max_pages and max_blocks, so one task may hold it.
    fitted = sample.mapInArrow(examples, "one int, label int, row array<double>").groupBy("one").applyInArrow(train, "weights array<double>")
    row = fitted.first()
    return list(row["weights"]) if row else list(PRIOR.values())


def main_text(html: str, weights: list[float]) -> str:
    page = parse(html)
    kept = label_blocks(page, weights)
    return "\n".join(b.text for b, content in zip(page.blocks, kept, strict=True) if content)


#: Characters of pages whose texts are held before they are handed on.
BATCH_CHARS = 8 << 20


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: list[float] | None = None
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``: the main text of its whole HTML.

    Content blocks are joined in page order by one line feed; inside a block, any white
    space is one space. NULL, empty and broken pages, and those without content, have the empty
    text. Repeated rows and NULL ids give a row each, equal ones with equal texts; an empty table gives
    none. ``weights`` are those of ``fit``, by default fitted on ``pages`` itself.
    """
    learned = fit(pages, html_col) if weights is None else weights
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            start = held = 0

            def part(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                some = batch.slice(start, len(texts))
                sizes = pa.array(list(map(len, texts)), pa.int64())
                return pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), sizes],
                    ["page_id", "url", "text", "n_chars"],
                )

            for value in batch.column("html"):
                html = value.as_py() or ""
                texts.append(main_text(html, learned))
                held += len(html)
                if held >= BATCH_CHARS:
                    yield part()
                    start, held = start + len(texts), 0
                    texts.clear()
            yield part()

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return rows.mapInArrow(extract, ", ".join([*kinds, "text string", "n_chars long"]))
