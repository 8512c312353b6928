"""Suffix-array dedup by a common-prefix-aware distributed merge sort.

Every string of ``span`` bytes that starts in two places is found, and the bytes
it covers are removed from each.

1. *Anchors.*  Of the k-grams inside each span-long window the one with the
   smallest (hash, position) is its anchor.  The choice depends on the window's
   bytes only, so equal windows have equal anchors at equal offsets, and one
   anchor in about ``(span - k) / 2`` bytes stands for all windows around it.
   Anchors whose k-gram occurs once are done: hashes are counted, and a second
   scan lets only those of a fixed-size filter out of the task.
2. *Runs.*  The others carry the suffix that starts at the anchor, cut where
   its last window ends, and the bytes before it back to its first window.  Each
   task sorts the suffixes it has for a target and writes them front-coded: the
   length of the prefix shared with the suffix before, and the rest.  Equal
   entries become one entry with several owners before anything is shuffled.
3. *Merge.*  A target merges its runs with a loser tree whose nodes hold the
   prefix length a loser shares with the winner that beat it.  Two candidates
   are told apart by these lengths; bytes are read only behind a known common
   prefix.  The merge gives the suffix order and its LCP array.
4. *Windows.*  The window ``d`` bytes before an anchor repeats if another suffix
   shares ``span - d`` bytes to the right (an interval of the LCP array) and
   ``d`` bytes to the left (likewise in the order of the reversed left parts).

A k-gram with more than ``HOT`` anchors would make one large target.  Its
windows are hashed one by one (128 bits) and counted with partial aggregation.
Such keys are listed, and their rows are marked where they lie.

Passages counted in words are found the same way: anchors among the grams of
words in each window, from the same two scans, then hashed windows.

Edge cases: null text counts as empty; texts shorter than the span lose
nothing; equal rows (same id and text) are documents of their own and lose what
they share; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (hash_filter, keep_columns, materialize, mix, partitions_for, passes, rows_of_repeated, slices, span_hashes,
                               text_buffer, windows, word_spans)

SPAN = 400
GRAM = 48
HOT = 50_000
TARGET_ROWS = 20_000
RUN_BYTES = 24_000_000
GRAM_WORDS = 8
BYTES, PASSAGE = 0, 1  # kinds of anchors and of ranges

ANCHOR_SCHEMA = "h long, doc_id long, th long, a int, lo int, hi int, kind int"
RUN_SCHEMA = ("target int, lcp array<int>, tail array<binary>, before array<binary>, owners array<int>, "
              "owner_id array<long>, owner_th array<long>, owner_at array<int>")
CUT_SCHEMA = "doc_id long, th long, lo int, hi int"


# ---- anchors -------------------------------------------------------------


def window_minima(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    m, have = key, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(buf: np.ndarray, off: np.ndarray, span: int, gram: int):
    """(document, k-gram hash, anchor, first window, last window) per anchor,
    positions counted from the document's start."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(buf) < span:
        return none
    at = np.arange(len(buf) - gram + 1)
    h = span_hashes(buf, at, at + gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    best = (window_minima(key, span - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(best)]
    start = np.flatnonzero(np.arange(len(best)) + span <= off[doc + 1])
    if len(start) == 0:
        return none
    a, d = best[start], doc[start]
    new = np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(a)] - 1
    d, a, base = d[first], a[first], off[d[first]]
    return d, h[a].view(np.int64), a - base, start[first] - base, start[last] - base


def _find_anchors(span: int, gram: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                d, h, a, lo, hi = anchors(*text_buffer(part.column("text")), span, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), part.column("doc_id").cast(pa.int64()).take(pa.array(d)), part.column("th").take(pa.array(d)),
                     pa.array(a, pa.int32()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["h", "doc_id", "th", "a", "lo", "hi"])

    return run


# ---- front-coded runs ------------------------------------------------------


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(entries: dict[tuple[bytes, bytes], list]) -> tuple[list, list, list, list]:
    """(lcp, tail, left part, owners) of the sorted entries (suffix, left part)."""
    order = sorted(entries)
    lcp, tail, before, last = [], [], [], b""
    for suffix, left in order:
        n = common(last, suffix)
        lcp.append(n)
        tail.append(suffix[n:])
        before.append(left)
        last = suffix
    return lcp, tail, before, [entries[k] for k in order]


def _write_runs(span: int, targets: int):
    def rows(groups):
        out = []
        for target, entries in groups.items():
            lcp, tail, before, owners = front_code(entries)
            flat = [o for own in owners for o in own]
            out.append({"target": target, "lcp": lcp, "tail": tail, "before": before, "owners": [len(o) for o in owners],
                        "owner_id": [o[0] for o in flat], "owner_th": [o[1] for o in flat], "owner_at": [o[2] for o in flat]})
        return pa.RecordBatch.from_pylist(out, schema=_RUN_ARROW)

    def run(batches):
        groups: dict[int, dict] = {}
        held = 0
        for batch in batches:
            ids, ths, found = (batch.column(c).to_pylist() for c in ("doc_id", "th", "found"))
            for text, doc_id, th, marks in zip(batch.column("text"), ids, ths, found):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                for m in marks:
                    entry = (data[m["a"] : m["hi"] + span], data[m["lo"] : m["a"]])
                    own = groups.setdefault(m["h"] % targets, {}).setdefault(entry, [])
                    held += 40 if own else len(entry[0]) + len(entry[1]) + 200
                    own.append((doc_id, th, m["a"]))
                if held > RUN_BYTES:
                    yield rows(groups)
                    groups, held = {}, 0
        yield rows(groups)

    return run


_RUN_ARROW = pa.schema([("target", pa.int32()), ("lcp", pa.list_(pa.int32())), ("tail", pa.list_(pa.binary())), ("before", pa.list_(pa.binary())),
                        ("owners", pa.list_(pa.int32())), ("owner_id", pa.list_(pa.int64())), ("owner_th", pa.list_(pa.int64())),
                        ("owner_at", pa.list_(pa.int32()))])


# ---- loser-tree merge --------------------------------------------------------


class Run:
    """A front-coded run, read entry by entry."""

    def __init__(self, lcp, tail):
        self.lcp, self.tail, self.at, self.now = lcp, tail, 0, tail[0] if tail else None

    def advance(self) -> int:
        """Step on; returns the prefix shared with the entry just left."""
        self.at += 1
        if self.at == len(self.tail):
            self.now = None
            return 0
        n = self.lcp[self.at]
        self.now = self.now[:n] + self.tail[self.at]
        return n


def merge(runs: list[Run]):
    """Yield (run number, entry number, lcp with the entry yielded before).

    ``shared[r]`` is the prefix that run r's head shares with the last winner
    that passed its node.  The head with the longer shared prefix is the smaller;
    on a tie the bytes behind that prefix decide, and the loser remembers how far
    they agreed."""
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[Run | None] = [*runs, *[None] * (size - len(runs))]
    shared = [0] * size
    loser = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of two heads whose shared prefixes refer to the same string."""
        rx, ry = heads[x], heads[y]
        if rx is None or rx.now is None:
            return y, x
        if ry is None or ry.now is None:
            return x, y
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        n = common(rx.now, ry.now, shared[x])
        if rx.now[n : n + 1] <= ry.now[n : n + 1]:
            shared[y] = n
            return x, y
        shared[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, loser[node] = play(build(2 * node), build(2 * node + 1))
        return win

    top = build(1) if size > 1 else 0
    while heads[top] is not None and heads[top].now is not None:
        yield top, heads[top].at, shared[top]
        shared[top] = heads[top].advance()
        node = (top + size) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2


# ---- repeated windows ----------------------------------------------------------


def repeated_windows(lcp: np.ndarray, rlen: np.ndarray, left: list[bytes], many: np.ndarray, span: int):
    """For merged suffixes (with LCP to the one before): (entry, first d, last d)
    of each run of offsets whose window occurs more than once."""
    n = len(lcp)
    llen = np.array([len(x) for x in left], np.int64)
    d_lo, d_hi = span - rlen, llen  # a window starts d bytes before the anchor
    back = [x[::-1] for x in left]
    lorder = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    llcp = np.zeros(n, np.int64)
    for k in range(1, n):
        llcp[k] = common(back[lorder[k - 1]], back[lorder[k]])
    lrank = np.empty(n, np.int64)
    lrank[lorder] = np.arange(n)
    near = np.maximum(lcp, np.r_[lcp[1:], 0])  # longest prefix shared with a neighbour
    lnear = np.maximum(llcp, np.r_[llcp[1:], 0])[lrank]
    # d can only repeat from span - near on and up to lnear
    alone_lo, alone_hi = np.maximum(d_lo, span - near), np.minimum(d_hi, lnear)
    open_rows = np.flatnonzero((alone_lo <= alone_hi) & (many < 2))
    single = many < 2
    entry = [np.flatnonzero(~single)]
    ds, de = [d_lo[~single]], [d_hi[~single]]
    if len(open_rows):
        # equal-content classes need every row; rows with several owners count twice
        lo_all, hi_all = np.maximum(d_lo, span - near), np.minimum(d_hi, lnear)
        e_out, d_out = [], []
        for d in range(int(alone_lo[open_rows].min()), int(alone_hi[open_rows].max()) + 1):
            rows = np.flatnonzero((lo_all <= d) & (d <= hi_all))
            if len(rows) < 2:
                continue
            right = np.cumsum(lcp < span - d)[rows]
            leftc = np.cumsum(llcp < d)[lrank[rows]]
            _, inv, count = np.unique(right * (n + 1) + leftc, return_inverse=True, return_counts=True)
            hit = rows[(count[inv] > 1) & single[rows]]
            e_out.append(hit)
            d_out.append(np.full(len(hit), d))
        if e_out:
            e, d = np.concatenate(e_out), np.concatenate(d_out)
            order = np.lexsort((d, e))
            e, d = e[order], d[order]
            if len(e):
                cut = np.flatnonzero(np.r_[True, (e[1:] != e[:-1]) | (d[1:] != d[:-1] + 1)])
                end = np.r_[cut[1:], len(e)] - 1
                entry.append(e[cut])
                ds.append(d[cut])
                de.append(d[end])
    return np.concatenate(entry), np.concatenate(ds), np.concatenate(de)


def _merge_target(span: int):
    def run(key, data):
        rows = data.to_pylist()
        runs = [Run(r["lcp"], r["tail"]) for r in rows]
        owners = []
        for r in rows:
            ends = np.concatenate([[0], np.cumsum(r["owners"])])
            owners.append([(ends[i], ends[i + 1]) for i in range(len(r["owners"]))])
        lcp, rlen, left, own = [], [], [], []
        for k, i, n in merge(runs):
            size = rows[k]["lcp"][i] + len(rows[k]["tail"][i])
            if lcp and n == size == rlen[-1] and rows[k]["before"][i] == left[-1]:
                own[-1].append((k, *owners[k][i]))  # the same entry from another run
                continue
            lcp.append(n)
            rlen.append(size)
            left.append(rows[k]["before"][i])
            own.append([(k, *owners[k][i])])
        many = np.array([sum(b - a for _, a, b in o) for o in own], np.int64)
        out: list[list] = [[], [], [], []]
        if own:
            found = repeated_windows(np.array(lcp, np.int64), np.array(rlen, np.int64), left, many, span)
            for e, d0, d1 in zip(*(x.tolist() for x in found)):
                for k, a, b in own[e]:
                    r = rows[k]
                    for j in range(a, b):
                        out[0].append(r["owner_id"][j])
                        out[1].append(r["owner_th"][j])
                        out[2].append(r["owner_at"][j] - d1)
                        out[3].append(r["owner_at"][j] - d0 + span)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                        names=["doc_id", "th", "lo", "hi"])

    return run


# ---- hot k-grams ------------------------------------------------------------------


def _hot_windows(span: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                buf, off = text_buffer(part.column("text"))
                d, p = [], []
                for i, marks in enumerate(part.column("found").to_pylist()):
                    for m in marks:
                        p.append(np.arange(m["lo"], m["hi"] + 1) + off[i])
                        d.append(np.full(m["hi"] + 1 - m["lo"], i))
                p = np.concatenate(p) if p else np.zeros(0, np.int64)
                d = np.concatenate(d) if d else np.zeros(0, np.int64)
                one = span_hashes(buf, p, p + span)
                two = span_hashes(buf[::-1], len(buf) - p - span, len(buf) - p)  # read backwards: an independent hash
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(mix(two).view(np.int64)), part.column("doc_id").cast(pa.int64()).take(pa.array(d)),
                     part.column("th").take(pa.array(d)), pa.array(p - off[d], pa.int32())], names=["w1", "w2", "doc_id", "th", "p"])

    return run


# ---- passages counted in words ---------------------------------------------------


def _word_anchors(words: int, gram: int):
    """As ``anchors``, but windows, grams and positions are counted in words."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                buf, off = text_buffer(part.column("text"))
                start, end, doc = word_spans(buf, off)
                d = h = a = lo = hi = np.zeros(0, np.int64)
                at = np.arange(max(len(start) - words + 1, 0))
                at = at[doc[at] == doc[at + words - 1]]
                if len(at):
                    pos, g = windows(span_hashes(buf, start, end), doc, gram)
                    key = np.full(len(start) - gram + 1, np.iinfo(np.uint64).max)
                    key[pos] = (g & np.uint64(0xFFFFFFFF00000000)) | pos.astype(np.uint64)
                    best = (window_minima(key, words - gram + 1)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    first = np.flatnonzero(np.r_[True, (best[1:] != best[:-1]) | (doc[at[1:]] != doc[at[:-1]])])
                    last = np.r_[first[1:], len(at)] - 1
                    full = np.zeros(len(key), np.uint64)
                    full[pos] = g
                    d, a, base = doc[at[first]], best[first], np.searchsorted(doc, doc[at[first]])
                    h, lo, hi, a = full[a].view(np.int64), at[first] - base, at[last] - base, a - base
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), part.column("doc_id").cast(pa.int64()).take(pa.array(d)), part.column("th").take(pa.array(d)),
                     pa.array(a, pa.int32()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["h", "doc_id", "th", "a", "lo", "hi"])

    return run


def _word_windows(words: int):
    """Two hashes and the byte range of every window around the given anchors."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                buf, off = text_buffer(part.column("text"))
                start, end, doc = word_spans(buf, off)
                p, d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, marks in enumerate(part.column("found").to_pylist()):
                    base = np.searchsorted(doc, i)
                    for m in marks:
                        p.append(np.arange(m["lo"], m["hi"] + 1) + base)
                        d.append(np.full(m["hi"] + 1 - m["lo"], i))
                p, d = np.concatenate(p), np.concatenate(d)
                lo, hi = start[p], end[p + words - 1]
                one = span_hashes(buf, lo, hi)
                two = span_hashes(buf[::-1], len(buf) - hi, len(buf) - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(mix(two).view(np.int64)), part.column("doc_id").cast(pa.int64()).take(pa.array(d)),
                     part.column("th").take(pa.array(d)), pa.array(lo - off[d], pa.int32()), pa.array(hi - off[d], pa.int32())],
                    names=["w1", "w2", "doc_id", "th", "lo", "hi"])

    return run


def _all_anchors(span: int, gram: int, words: int, bits: np.ndarray | None = None):
    """Anchors of both kinds; with ``bits`` only those that the filter lets pass."""

    def run(batches):
        for batch in batches:
            kinds = [(BYTES, _find_anchors(span, gram))] + ([(PASSAGE, _word_anchors(words, min(GRAM_WORDS, words)))] if words else [])
            for kind, find in kinds:
                for found in find([batch]):
                    h = found.column("h").to_numpy(zero_copy_only=False)
                    if kind == PASSAGE:
                        h = mix(h.view(np.uint64)).view(np.int64)  # names of their own
                    found = found.set_column(0, "h", pa.array(h, pa.int64())).append_column("kind", pa.array(np.full(len(h), kind), pa.int32()))
                    yield found if bits is None else found.filter(pa.array(passes(bits, h)))

    return run


# names that no input column has
ID, TH, FOUND = (f"{n}_{uuid.uuid4().hex}" for n in ("id", "th", "found"))

# ---- the operator -----------------------------------------------------------------------


def _with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    marks = _grouped(marks.select("doc_id", "th", F.struct("h", "a", "lo", "hi").alias("m")), "found")
    return docs.join(marks, (_known(docs.doc_id) == marks[ID]) & (docs.th == marks[TH])).select("doc_id", "th", "text", "found")


def _known(doc_id):
    return F.coalesce(doc_id, F.lit(0))


def _name(docs: DataFrame):
    """Hash of a row's text and of whether its id is null: with the id (null as 0)
    it names the row by plain equality, so a grouping serves the join after it."""
    return F.xxhash64(F.coalesce(docs.text, F.lit("")), docs.doc_id.isNull())


def _grouped(marks: DataFrame, name: str) -> DataFrame:
    return marks.groupBy(_known(F.col("doc_id")).alias(ID), F.col("th").alias(TH)).agg(F.collect_set("m").alias(name))


def _twice(windows: DataFrame, hot: int) -> DataFrame:
    """The hashed windows that occur more than once (``windows`` is written)."""
    keys = ["w1", "w2"]
    return rows_of_repeated(windows, keys, materialize(windows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), windows.count()), hot)


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT, words: int = 0) -> DataFrame:
    """(doc_id, th, lo, hi, kind): byte ranges covered by repeated strings; ranges
    of one document may overlap.  ``docs`` has doc_id, text and its hash th."""
    spark = docs.sparkSession
    counts = materialize(docs.mapInArrow(_all_anchors(span, gram, words), ANCHOR_SCHEMA).select("h")
                         .groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    bits = hash_filter(counts.select("h"), "h")
    found = materialize(docs.mapInArrow(_all_anchors(span, gram, words, bits), ANCHOR_SCHEMA))
    marked = materialize(rows_of_repeated(found, ["h"], counts, hot), found.count())
    total, n_hot = marked.agg(F.count_if(F.col("kind") == BYTES), F.count_if(F.col("hot") & (F.col("kind") == BYTES))).first()
    targets = max(partitions_for(spark), -(-total // TARGET_ROWS))
    of_bytes = marked.where(F.col("kind") == BYTES)
    runs = _with_marks(docs, of_bytes.where("not hot")).mapInArrow(_write_runs(span, targets), RUN_SCHEMA)
    cuts = runs.groupBy("target").applyInArrow(_merge_target(span), CUT_SCHEMA).withColumn("kind", F.lit(BYTES))
    if n_hot:
        windows = materialize(_with_marks(docs, of_bytes.where("hot")).mapInArrow(_hot_windows(span), "w1 long, w2 long, doc_id long, th long, p int"))
        cuts = cuts.union(_twice(windows, hot).select("doc_id", "th", F.col("p").alias("lo"), (F.col("p") + span).alias("hi"), F.lit(BYTES)))
    if words:
        windows = materialize(_with_marks(docs, marked.where(F.col("kind") == PASSAGE))
                              .mapInArrow(_word_windows(words), "w1 long, w2 long, doc_id long, th long, lo int, hi int"))
        cuts = cuts.union(_twice(windows, hot).select("doc_id", "th", "lo", "hi", F.lit(PASSAGE)))
    return cuts


def _cut(data: bytes, found) -> tuple[bytes, list[tuple[int, int]]]:
    """The rest of the bytes and the maximal removed ranges."""
    ranges: list[tuple[int, int]] = []
    for m in sorted(found or [], key=lambda m: (m["lo"], m["hi"])):
        if ranges and m["lo"] <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], m["hi"]))
        else:
            ranges.append((m["lo"], m["hi"]))
    out, at = [], 0
    for lo, hi in ranges:
        out.append(data[at:lo])
        at = hi
    return b"".join(out) + data[at:], ranges


def _joined(docs: DataFrame, span: int, gram: int, hot: int, words: int = 0) -> DataFrame:
    """The documents, all columns kept, with their repeated ranges (``FOUND``)."""
    hashed = keep_columns(docs, "doc_id", "text")
    hashed = hashed.withColumn("th", _name(hashed))
    cuts = repeated_spans(hashed, span, gram, hot, words)
    marks = _grouped(cuts.select("doc_id", "th", F.struct("lo", "hi", "kind").alias("m")), FOUND)
    return docs.join(marks, (_known(docs.doc_id) == marks[ID]) & (_name(docs) == marks[TH]), "left").drop(ID, TH)


def remaining(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT, words: int = 0) -> DataFrame:
    """Per document: id, kept bytes, byte count, the removed ranges, and with
    ``words`` how many passages of that many words or more it shares (n_passages,
    n_passage_bytes; these are counted, not removed)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, text, found in zip(part.column("doc_id").to_pylist(), part.column("text"), part.column(FOUND).to_pylist()):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    kept, ranges = _cut(data, [m for m in found or [] if m["kind"] == BYTES])
                    rest, passages = _cut(data, [m for m in found or [] if m["kind"] == PASSAGE])
                    out.append({"doc_id": doc_id, "n_bytes": len(data), "n_removed": len(data) - len(kept), "n_spans": len(ranges),
                                "kept_sha256": hashlib.sha256(kept).hexdigest(), "n_passages": len(passages),
                                "n_passage_bytes": len(data) - len(rest), "ranges": [{"lo": a, "hi": b} for a, b in ranges]})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("n_passages", pa.int64()), ("n_passage_bytes", pa.int64()),
                        ("ranges", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))])
    return (_joined(keep_columns(docs, "doc_id", "text"), span, gram, hot, words).select("doc_id", "text", FOUND)
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, "
                             "n_passage_bytes long, ranges array<struct<lo:long,hi:long>>"))


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT, words: int = 0) -> DataFrame:
    """The documents with repeated strings cut out of ``text`` (a character cut
    in two goes as a whole); with ``words``, strings of that many words go as
    well if they have fewer bytes; documents left without a word go.  All columns
    stay, and ``n_chars`` (where present) follows the new text."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                text, found = part.column("text"), part.column(FOUND).to_pylist()
                new = [_cut(t.as_buffer().to_pybytes(), f)[0].decode("utf-8", "ignore") if f else t.as_py() for t, f in zip(text, found)]
                keep = [i for i, (t, f) in enumerate(zip(new, found)) if not f or t.strip()]
                columns = []
                for field in schema.fields:
                    column = part.column(field.name)
                    if field.name == "text":
                        column = pa.array(new, column.type)
                    elif field.name == "n_chars":
                        column = pa.array([len(t) if f else n for t, f, n in zip(new, found, column.to_pylist())], column.type)
                    columns.append(column)
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields]).take(pa.array(keep, pa.int64()))

    return _joined(docs, span, gram, hot, words).select(*[F.col(c) for c in schema.names], FOUND).mapInArrow(run, schema)
