"""Main text of web pages by a tree-structured graphical model of the DOM.

*Model.* Every element and every block of text of a page is a node with a hidden state: nothing below belongs to the article,
and it is made of short pieces (``BRIEF``: menus, footers) or holds longer ones (``PROSE``: comments, notices); parts of it do
(``SOME``); or ``ALL`` does.  A page's probability is that of its root's state, of each child's kind (its tag, whether it
has names, whether text is directly in it) and state given its parent's state (parent-child potentials), and of each node's features given its state: words of
class, id and role, how long a block is, how much of it is linked, how it ends, and what its element is.
*Training.* Labelled pages (markup and the article's blocks) give each block's state, and elements theirs: all potentials
are smoothed relative counts, summed by one grouping in Spark.
*Inference.* Sum-product on the tree: messages go up from the deepest nodes to the root, then down again, level by level
for all pages of a batch at once in numpy; a block whose marginal of ``ALL`` is at least a half is kept.

Pages are independent: extraction is one pass without a shuffle, with a model of a few thousand numbers.

Cases: null and empty pages, and pages without a kept block, have an empty text; pages cut off anywhere, unclosed and
stray tags, and nesting of any depth are read as they stand; repeated rows give repeated rows; an empty table gives none;
further columns are ignored.  Without labelled pages, fitting is an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm import dom
from merchant_signals.llm.common import arrow_map, give_back
from merchant_signals.llm.words import chunks, texts_of

BRIEF, PROSE, SOME, ALL = range(4)
STATES = 4
#: Characters of a block that is prose.
PROSE_CHARS = 40
#: Power of a block's own features in the model: blocks of one part of a page are alike, so each says less than if it stood alone.
BLOCK_POWER = 0.25
#: Counts added to each state's, so that no potential is zero.
SMOOTHING = 0.5
#: Features met in fewer labelled nodes say nothing.
MIN_COUNT = 5


def _kinds(page: dom.Page) -> list[str]:
    """The class of each node in the parent-child potentials: its tag, whether it has names, and whether text is directly in it."""
    direct = {p for p, t in zip(page.parent, page.text) if t is not None}
    return [t + ("*" if names else "") + ("+" if i in direct else "") for i, (t, names) in enumerate(zip(page.tag, page.names))]


def _bucket(n: int) -> int:
    return min(12, n.bit_length())


def features(page: dom.Page) -> list[list[str]]:
    """Of each node, what its state is judged by."""
    out = []
    for i, (tag, names, text) in enumerate(zip(page.tag, page.names, page.text)):
        if text is None:
            own = [f"name={w}" for w in dict.fromkeys(dom.words_of_names(names))]
        else:
            up = page.tag[page.parent[i]]
            share = min(4, 4 * page.linked[i] // max(1, len(text)))
            own = [f"size={_bucket(len(text))}", f"linked={share}", f"end={text[-1] if text[-1] in '.!?:;,' else 'w'}", f"in={up}"]
        out.append(own)
    return out


def label(page: dom.Page, blocks: list[str]) -> np.ndarray | None:
    """The nodes' states, given the article's blocks in order; None if the page doesn't hold them all.  Of equal blocks, those of
    the shortest stretch of the page that holds the article are taken."""
    at = [i for i, t in enumerate(page.text) if t is not None]
    said = list(blocks)
    if not said:
        return None
    best = None
    for start in [k for k, i in enumerate(at) if page.text[i] == said[0]]:
        found, k = [], start
        for s in said:
            while k < len(at) and page.text[at[k]] != s:
                k += 1
            if k == len(at):
                break
            found.append(at[k])
            k += 1
        if len(found) == len(said) and (best is None or found[-1] - found[0] < best[-1] - best[0]):
            best = found
    if best is None:
        return None
    inside, every, prose = np.zeros((3, len(page.tag)), np.int64)
    inside[best], every[at] = 1, 1
    prose[[i for i in at if len(page.text[i]) >= PROSE_CHARS]] = 1
    for i in range(len(page.tag) - 1, 0, -1):  # children come after their parents
        for x in (inside, every, prose):
            x[page.parent[i]] += x[i]
    return np.where(inside == 0, np.where(prose > 0, PROSE, BRIEF), np.where(inside == every, ALL, SOME))


@dataclass
class Model:
    """Log potentials: of the root's states, of children by kind, parent's state and child's, of features by state."""

    root: np.ndarray
    child: dict[str, np.ndarray]
    any_child: np.ndarray
    feature: dict[str, np.ndarray]

    def marginals(self, pages: list[dom.Page]) -> list[np.ndarray]:
        """Of each page, the probabilities of its nodes' states."""
        first = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages], dtype=np.int64)])
        n = int(first[-1])
        parent = np.concatenate([np.array(p.parent, np.int64) + f for p, f in zip(pages, first)]) if pages else np.zeros(0, np.int64)
        parent[first[:-1]] = -1
        depth = np.zeros(n, np.int64)
        flat = parent.tolist()
        deep = [0] * n
        for i, p in enumerate(flat):  # parents come first
            if p >= 0:
                deep[i] = deep[p] + 1
        depth[:] = deep
        own = np.zeros((n, STATES))  # log potential of each state from the node's own features
        kinds: dict[str, int] = {}
        kind, i, nothing = np.zeros(n, np.int64), 0, np.zeros(STATES)
        for page in pages:
            for tag, k, fs in zip(page.tag, _kinds(page), features(page)):
                own[i] = sum([self.feature.get(f, nothing) for f in fs], nothing) * (BLOCK_POWER if tag == "#text" else 1)
                kind[i] = kinds.setdefault(k, len(kinds))
                i += 1
        step = np.exp(np.array([self.child.get(k, self.any_child) for k in kinds]).reshape(-1, STATES, STATES))
        order = np.argsort(depth, kind="stable")
        edge = np.searchsorted(depth[order], np.arange(depth.max(initial=-1) + 2))
        # upward: belief of a node from all below it, kept at a largest value of 1
        below = own.copy()
        up = np.zeros((n, STATES))  # log message of a node to its parent
        for d in range(len(edge) - 2, -1, -1):
            level = order[edge[d]:edge[d + 1]]
            belief = below[level] - below[level].max(1, keepdims=True)
            below[level] = belief
            if d:
                up[level] = np.log(np.einsum("nps,ns->np", step[kind[level]], np.exp(belief)))
                np.add.at(below, parent[level], up[level])
        # downward: a parent's belief without the child's own message
        whole = below
        whole[first[:-1]] += self.root
        for d in range(1, len(edge) - 1):
            level = order[edge[d]:edge[d + 1]]
            rest = whole[parent[level]] - up[level]
            rest -= rest.max(1, keepdims=True)
            whole[level] += np.log(np.einsum("nps,np->ns", step[kind[level]], np.exp(rest)))
        p = np.exp(whole - whole.max(1, keepdims=True)) if n else whole
        p /= p.sum(1, keepdims=True)
        return [p[a:b] for a, b in zip(first, first[1:])]

    def extract(self, pages: list[dom.Page]) -> list[str]:
        """The pages' main texts: kept blocks in page order."""
        return ["\n\n".join([t for t, q in zip(page.text, p[:, ALL]) if t is not None and q >= 0.5])
                for page, p in zip(pages, self.marginals(pages))]


def count(labelled: DataFrame) -> DataFrame:
    """labelled (html, blocks) -> what, key, states, n: how often labelled nodes had a feature or a child of a kind, by state (of a child:
    STATES * the parent's and its own)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        met: Counter = Counter()
        for html, blocks in zip(batch.column("html").to_pylist(), batch.column("blocks").to_pylist()):
            page = dom.parse(html or "")
            states = label(page, [" ".join(b.split()) for b in blocks or [] if b and b.split()])
            if states is None:
                continue
            met["root", "", int(states[0])] += 1
            for k, p, s, own in zip(_kinds(page), page.parent, states.tolist(), features(page)):
                met["state", "", s] += 1
                for f in own:
                    met["feature", f, s] += 1
                if p >= 0:
                    met["child", k, STATES * int(states[p]) + s] += 1
        return pa.RecordBatch.from_arrays([pa.array([k[j] for k in met], t) for j, t in ((0, pa.string()), (1, pa.string()), (2, pa.int32()))]
                                          + [pa.array(list(met.values()), pa.int64())], names=["what", "key", "state", "n"])

    counted = arrow_map(labelled.select("html", "blocks"), run, "what string, key string, state int, n bigint")
    return counted.groupBy("what", "key", "state").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame) -> Model:
    """A model of labelled pages; what comes to the driver are counts of features, not pages."""
    tables: dict[str, dict[str, np.ndarray]] = {"root": {}, "state": {}, "feature": {}, "child": {}}
    for r in count(labelled).collect():  # a row for each feature and state
        tables[r["what"]].setdefault(r["key"], np.zeros(STATES * STATES if r["what"] == "child" else STATES))[r["state"]] += r["n"]
    if not tables["root"]:
        raise ValueError("no labelled page holds its article's blocks")
    total = tables["state"][""]
    rate = lambda c, n: np.log((c + SMOOTHING) / (n + 2 * SMOOTHING))
    feature = {k: rate(c, total) for k, c in tables["feature"].items() if c.sum() >= MIN_COUNT}
    every = sum(tables["child"].values()).reshape(STATES, STATES) + SMOOTHING
    each = every.sum(1, keepdims=True)  # children by their parents' state
    child = {k: np.log((c.reshape(STATES, STATES) + SMOOTHING) / (each + SMOOTHING * STATES)) for k, c in tables["child"].items()}
    return Model(rate(tables["root"][""], tables["root"][""].sum()), child, np.log(every / each), feature)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text of every page."""
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in own.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in chunks(texts_of(b.column(2))[1]):
                texts = shared.value.extract([dom.parse(h or "") for h in b.column(2).slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])
        give_back()

    return own.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
