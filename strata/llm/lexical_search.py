"""Ranked lexical search of many queries at once, sharing common work.

The items are compiled in blocks of at most ``ITEMS_PER_BLOCK``:

* *mining*: terms that occur in the same items form one node; then the pair of
  nodes that occurs together in most items becomes a node of its own, again
  and again, until no pair is shared.  What results is a sharing graph: leaves
  are terms, inner nodes are shared term sets, and an item is a short list of
  nodes;
* *statistics*: one scan counts N, L and the document frequency of every query
  term over all documents (partial sums per task);
* *scoring*: one scan fills, for each run of documents, an accumulator per
  term, then one per inner node from its children, each computed once, and adds
  up the items from their nodes.  Weights are integers, so sharing does not
  change a score.  A task keeps the best ``top`` documents of each item; these
  meet in two steps, first by group of tasks, then by item.

Documents are never shuffled; a task holds ``CELLS`` accumulators at most, so the
more nodes the graph of a block has, the shorter its runs of documents are.

Edge cases: a null text has no terms and is not counted; an item without terms
has no rows; rows of one item_id form one item; a null item_id is an item; null
doc_ids come last among equal scores; repeated documents are ranked each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import FOLD, materialize, slices, span_hashes, spans_of, text_buffer

ITEMS_PER_BLOCK = 1000
CELLS = 4_000_000  # accumulators held at once: documents of a run times nodes
PAIR_REACH = 64  # mining counts a node with so many that follow it in an item
TASK_GROUPS = 64

# bytes of a term: digits, letters, and everything beyond ASCII
IN_TERM = np.zeros(256, bool)
IN_TERM[0x30:0x3A] = IN_TERM[0x41:0x5B] = IN_TERM[0x61:0x7B] = IN_TERM[0x80:] = True


def terms_of(text: str | None) -> set[bytes]:
    buf = np.frombuffer((text or "").encode(), np.uint8)
    start, end = spans_of(IN_TERM[buf], np.array([0, len(buf)]))
    low = FOLD[buf].tobytes()
    return {low[a:b] for a, b in zip(start.tolist(), end.tolist())}


@dataclass
class SharingGraph:
    """Nodes 0..len(terms)-1 are the terms; ``inner`` lists the children of the
    further nodes, children first; ``items`` lists the nodes of each item."""

    terms: list[bytes]
    inner: list[list[int]]
    items: list[list[int]]

    @property
    def additions(self) -> int:
        return sum(map(len, self.inner)) + sum(map(len, self.items))


def share(item_terms: list[set[bytes]]) -> SharingGraph:
    """Mine the term sets that several items share."""
    terms = sorted(set().union(*item_terms)) if item_terms else []
    place = {t: k for k, t in enumerate(terms)}
    where = defaultdict(list)  # term -> items
    for i, wanted in enumerate(item_terms):
        for t in wanted:
            where[place[t]].append(i)
    alike = defaultdict(list)
    for t in range(len(terms)):
        alike[tuple(where[t])].append(t)
    inner, nodes = [], [set() for _ in item_terms]
    for at, members in sorted(alike.items(), key=lambda x: x[1]):
        node = members[0]
        if len(members) > 1:
            node = len(terms) + len(inner)
            inner.append(members)
        for i in at:
            nodes[i].add(node)

    together = Counter()
    at = defaultdict(set)  # node -> items
    for i, held in enumerate(nodes):
        order = sorted(held)
        for j, a in enumerate(order):
            at[a].add(i)
            together.update((a, b) for b in order[j + 1 : j + 1 + PAIR_REACH])
    heap = [(-n, pair) for pair, n in together.items() if n > 1]
    heapq.heapify(heap)

    while heap:
        n, (a, b) = heapq.heappop(heap)
        now = len(at[a] & at[b])
        if now < 2:
            continue
        if now < -n:  # an older count: try again with the present one
            heapq.heappush(heap, (-now, (a, b)))
            continue
        node = len(terms) + len(inner)
        inner.append([a, b])
        found = defaultdict(int)
        for i in sorted(at[a] & at[b]):
            nodes[i] -= {a, b}
            for other in nodes[i]:
                found[other] += 1
            nodes[i].add(node)
            at[a].discard(i)
            at[b].discard(i)
            at[node].add(i)
        for other, n in found.items():
            if n > 1:
                heapq.heappush(heap, (-n, (other, node)))
    return SharingGraph(terms, inner, [sorted(x) for x in nodes])


class _Finder:
    """Places of the query terms in a text buffer: by hash, then by their bytes."""

    def __init__(self, terms: list[bytes]):
        flat = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(size)
        h = span_hashes(flat, end - size, end)
        self.order = np.argsort(h, kind="stable")
        self.hash, self.size, self.flat, self.start = h[self.order], size, flat, end - size

    def find(self, low, start, end):
        """(index of the span, term) of every span that is a query term."""
        if not len(self.hash) or not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = span_hashes(low, start, end)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        span = np.flatnonzero(self.hash[at] == h)
        term = self.order[at[span]]
        good = (end - start)[span] == self.size[term]
        span, term = span[good], term[good]
        for n in np.unique(self.size[term]).tolist():  # the bytes decide
            rows = np.flatnonzero(self.size[term] == n)
            same = (low[start[span[rows]][:, None] + np.arange(n)] == self.flat[self.start[term[rows]][:, None] + np.arange(n)]).all(axis=1)
            if not same.all():
                keep = np.ones(len(span), bool)
                keep[rows[~same]] = False
                span, term = span[keep], term[keep]
        return span, term


def _occurrences(batches, finder: _Finder, nodes: int):
    """Per run of documents: rows, terms per document, (document, term, tf)."""
    n_terms = max(1, len(finder.size))
    run = max(1, CELLS // max(1, nodes))
    for batch in batches:
        for lo in range(0, batch.num_rows, run):
            for part in slices(batch.slice(lo, run)):
                buf, off = text_buffer(part.column("text"))
                start, end = spans_of(IN_TERM[buf], off)
                doc = np.searchsorted(off, start, side="right") - 1
                n = np.bincount(doc, minlength=part.num_rows)
                span, term = finder.find(FOLD[buf], start, end)
                key, tf = np.unique(doc[span] * n_terms + term, return_counts=True)
                yield part, n, key // n_terms, key % n_terms, tf


def statistics(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """(N, L, document frequency of each term) over all documents."""

    def run(batches):
        df, docs_, length = np.zeros(len(terms), np.int64), 0, 0
        for _, n, _, term, _ in _occurrences(batches, _Finder(terms), 1):
            df += np.bincount(term, minlength=len(terms))
            docs_ += int((n > 0).sum())
            length += int(n.sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], seen]), pa.int64()), pa.array(np.concatenate([[docs_, length], df[seen]]), pa.int64())], names=["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in found.collect()}  # one row a term of the block
    return counts.get(-2, 0), counts.get(-1, 0), np.array([counts.get(t, 0) for t in range(len(terms))], np.int64)


def _score(graph: SharingGraph, item_ids: list, n_docs: int, length: int, df: np.ndarray, top: int):
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)

    def run(batches):
        finder, n_terms = _Finder(graph.terms), len(graph.terms)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in graph.items]
        for part, n, doc, term, tf in _occurrences(batches, finder, n_terms + len(graph.inner)):
            m = 10 + (90 * n.astype(np.int64) * n_docs) // length if length else np.zeros(len(n), np.int64)
            acc = np.zeros((n_terms + len(graph.inner), part.num_rows), np.int64)
            acc[term, doc] = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            for k, children in enumerate(graph.inner, n_terms):
                acc[k] = acc[children].sum(axis=0)
            column = part.column("doc_id").cast(pa.int64())
            ids = column.fill_null(0).to_numpy(zero_copy_only=False)
            null = column.is_null().to_numpy(zero_copy_only=False)
            for i, nodes in enumerate(graph.items):
                score = acc[nodes].sum(axis=0)
                had = best[i]
                bar = had[0][-1] if len(had[0]) == top else 1
                rows = np.flatnonzero(score >= max(1, bar))
                if len(rows):
                    s, d, z = (np.concatenate([a, b[rows]]) for a, b in zip(had, (score, ids, null)))
                    order = np.lexsort((d, z, -s))[:top]
                    best[i] = s[order], d[order], z[order]
        task = TaskContext.get().partitionId()
        rows = [(item_ids[i], int(s), None if z else int(d), task) for i, found in enumerate(best) for s, d, z in zip(*found)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
                                             names=["item_id", "score", "doc_id", "task"])

    return run


def _best(found: DataFrame, by: list, top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def blocks_of(items: DataFrame, size: int = ITEMS_PER_BLOCK):
    """The items, block by block: (ids, term sets), at most ``size`` ids each.

    Ids are dealt by ranges of a sorted table of ids, so a block is bounded
    whatever the ids are; rows of one id join their terms."""
    rows = materialize(items.select("item_id", "text"))
    last, first = None, True
    while True:
        rest = rows if first else rows.where(F.col("item_id") > last if last is not None else F.col("item_id").isNotNull())
        ids = [r["item_id"] for r in rest.select("item_id").distinct().orderBy(F.asc_nulls_first("item_id")).limit(size).collect()]
        if not ids:
            return
        upper = F.col("item_id") <= ids[-1] if ids[-1] is not None else F.lit(False)
        if first:
            upper = upper | F.col("item_id").isNull()
        wanted = {i: set() for i in ids}
        for r in rest.where(upper).select("item_id", "text").distinct().toLocalIterator():
            wanted[r["item_id"]] |= terms_of(r["text"])
        yield list(wanted), list(wanted.values())
        last, first = ids[-1], False


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each item."""
    docs = docs.select("doc_id", "text")
    found = None
    for ids, wanted in blocks_of(items):
        graph = share(wanted)
        n_docs, length, df = statistics(docs, graph.terms)
        part = docs.mapInArrow(_score(graph, ids, n_docs, length, df, top), "item_id long, score long, doc_id long, task int")
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = _best(found.withColumn("lot", F.col("task") % TASK_GROUPS), ["item_id", "lot"], top).drop("rank")
    return _best(found, ["item_id"], top).select("item_id", "rank", "doc_id", "score")
