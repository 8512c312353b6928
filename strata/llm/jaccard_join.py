"""N-gram Jaccard join with several global token orders.

A document is the set of its distinct hashed word shingles.  Equal sets form a
class, which is joined once.  Two sets of similarity t or more must share a
token among the first ``n - ceil(t*n) + 1`` of each set under *any* global order
of the tokens.  Every order puts rare tokens first (levels of a fixed-size
document-frequency sketch over all documents) and breaks ties by its own hash.

1. Order 1 finds the tokens that sets of different classes share; all other
   sets are done.  One document of each class that is left is read again, chosen
   in the scan by a fixed-size filter over ids, and its set is stored as half
   hashes (4 bytes a token).
2. A few rounds of hooks: each set is verified against the few sets with which it
   shares most prefix tokens, and the links found join components.  Large groups
   of near copies fall together here without their pairs being made.
3. The exact step covers what can still join components: pairs of different
   components that share a prefix token under order 1.  A row holds 512 parity
   bits of its set and the tokens before its own, so a pair is made only where
   sizes, positions and signatures allow a link, and not again at a token that
   follows another shared one.  The pairs must then pass longer sketches and share
   a prefix token under each further order, which is looked up pair by pair.  Half
   hashes can only add to an overlap, so they drop no link; pairs that pass by a
   few tokens only are decided on whole hashes, read for their classes alone.

A token's rows are walked as a sorted stream with one row kept, and where pairs
are made the rows of a token with more than ``BLOCK`` classes are dealt to pairs
of blocks, so no task holds a frequent token's rows.

Each step keeps every pair that could be linked or is already connected, so
components lose no link.

Edge cases: null, empty and blank texts have the empty set and are linked with
nothing (each is its own component); equal rows are one class; a null id never
names a component unless all ids of it are null; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (FOLD, components, hash_filter, keep_columns, materialize, mix, partitions_for, passes, slices, span_hashes,
                               text_buffer, windows, word_spans)

WIDTH = 4
PERCENT = 85
SKETCH_BITS = 20
ORDERS = 3
SPREAD = 16
HOOKS = ((1, 3), (3, 12))  # of each round: pivots a token, partners that a set is verified against
BLOCK = 2048  # classes of one token that meet in one task
BEFORE = 8  # shared tokens before its own that a row holds
SIGNS = [f"s{k}" for k in range(8)]  # words of parity
WHOLE_UP_TO = 256  # sets of so many tokens are stored with whole hashes
SLICE = 500_000  # text bytes that are cut into shingles at a time


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; with fewer words than
    the width, the whole word sequence is the one shingle."""
    buf = FOLD[buf]
    start, end, doc = word_spans(buf, off)
    hashes = span_hashes(buf, start, end)
    pos, win = windows(hashes, doc, width)
    n_docs = len(off) - 1
    first, cut = np.searchsorted(doc, np.arange(n_docs + 1)), np.searchsorted(doc[pos], np.arange(n_docs + 1))
    out = []
    for i in range(n_docs):
        n = first[i + 1] - first[i]
        if n >= width or n == 0:
            out.append(np.unique(win[cut[i] : cut[i + 1]]))
        else:
            h = np.array([n], np.uint64)
            for k in range(first[i], first[i + 1]):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[k])
            out.append(h)
    return out


def class_of(tokens: np.ndarray) -> int:
    """64-bit name of a set."""
    if len(tokens) == 0:
        return 0
    k = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    return int(mix(np.array([mix(tokens ^ mix(k)).sum() + np.uint64(len(tokens))], np.uint64)).astype(np.int64)[0])


def least_overlap(n, percent: int):
    """Tokens that a set of size n must share with any linked set."""
    return -(-percent * n // 100)


def prefix(tokens: np.ndarray, order: int, levels: np.ndarray, percent: int) -> np.ndarray:
    """The set's first tokens under one global order, in that order."""
    n = len(tokens)
    p = n - least_overlap(n, percent) + 1
    rank = (levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)) \
        | (mix(tokens ^ mix(np.array([order], np.uint64))) >> np.uint64(6))
    if p < n:
        pick = np.argpartition(rank, p - 1)[:p]
    else:
        pick = np.arange(n)
    return tokens[pick[np.argsort(rank[pick], kind="stable")]]


def _each_set(batches, width):
    for batch in batches:
        for part in slices(batch, limit=SLICE):
            yield part, shingle_sets(*text_buffer(part.column("text")), width)


def _census(width: int):
    """Per document its set size and class; per task its share of the sketch."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for part, sets in _each_set(batches, width):
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            counts += np.bincount((tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64()),
                 pa.array([-1] * n, pa.int32()), pa.array([None] * n, pa.binary())], names=["doc_id", "n", "cls", "block", "counts"])
        rows = counts.reshape(64, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * 64, pa.int64()), pa.array([0] * 64, pa.int64()), pa.array([0] * 64, pa.int64()), pa.array(range(64), pa.int32()),
             pa.array([zstandard.compress(r.astype("<i8").tobytes(), 3) for r in rows], pa.binary())], names=["doc_id", "n", "cls", "block", "counts"])

    return run


def _add_counts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            total[block] = total.get(block, 0) + np.frombuffer(zstandard.decompress(data), "<i8")
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["block", "counts"])


def frequency_levels(census: DataFrame) -> np.ndarray:
    """log2 levels of the sketch: 64 blocks, 8 MB in all whatever the input."""
    added = (census.where("block >= 0").select("block", "counts").repartition(16, "block").sortWithinPartitions("block")
             .mapInArrow(_add_counts, "block int, counts binary").collect())
    counts = np.zeros((64, (1 << SKETCH_BITS) // 64), np.int64)
    for row in added:
        counts[row["block"]] += np.frombuffer(row["counts"], "<i8")
    return np.floor(np.log2(counts.ravel() + 1)).astype(np.uint8)


def _prefix_rows(width: int, percent: int, levels: np.ndarray):
    def run(batches):
        seen: set[int] = set()
        for _, sets in _each_set(batches, width):
            yield _rows_of([s for s in sets if len(s)], 0, levels, percent, seen)

    return run


def _rows_of(sets, order, levels, percent, seen=None):
    token, cls, at = [], [], []
    for s in sets:
        c = class_of(s)
        if seen is not None:
            if c in seen:
                continue
            seen.add(c)
        p = prefix(s, order, levels, percent)
        token.append(p)
        cls.append(np.full(len(p), c, np.int64))
        at.append((len(s) << 32) + np.arange(len(p), dtype=np.int64))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(join(token, np.uint64).view(np.int64)), pa.array(join(cls, np.int64)), pa.array(join(at, np.int64))], names=["token", "cls", "at"])


# at: size of the set and the token's place in its prefix, in one number that sorts by size first
PREFIX_SCHEMA = "token long, cls long, at long"
# with the set's component and the two words of its signature
ROW = ["token", "cls", "at", "root", "x", "y"]


def _columns(batches, names):
    for batch in batches:
        if batch.num_rows:
            yield [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _shared(percent: int):
    """The rows of tokens that another class of a fitting size has too, each
    (token, class) once.  Rows come sorted by token and size, so next to its
    neighbours a class sees at once whether any class of its token fits; of the
    rows before only the last one is kept."""

    def run(batches):
        held = None  # (token, class, at, whether it is wanted already)
        for token, cls, at in _columns(batches, ["token", "cls", "at"]):
            wanted = np.zeros(len(token), bool)
            if held is not None:
                token, cls, at = (np.r_[h, c] for h, c in zip(held, (token, cls, at)))
                wanted = np.r_[held[3], wanted]
            new = np.r_[True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])]
            token, cls, at, wanted = token[new], cls[new], at[new], wanted[new]
            n = at >> 32
            fits = (token[1:] == token[:-1]) & (least_overlap(n[1:], percent) <= n[:-1])
            wanted[1:] |= fits
            wanted[:-1] |= fits
            out = wanted[:-1]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out]) for c in (token, cls, at)], names=["token", "cls", "at"])
            held = token[-1:], cls[-1:], at[-1:], wanted[-1:]
        if held is not None and held[3][0]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[:3]], names=["token", "cls", "at"])

    return run


def _shared_rows(rows: DataFrame, percent: int) -> DataFrame:
    dealt = rows.repartition("token").sortWithinPartitions("token", "at", "cls")
    return materialize(dealt.mapInArrow(_shared(percent), PREFIX_SCHEMA))


def _fit(n1, p1, n2, p2, percent):
    """Whether sizes allow a link, and positions too if this is the first prefix
    token that the pair shares."""
    sizes = least_overlap(np.maximum(n1, n2), percent) <= np.minimum(n1, n2)
    return sizes & ((100 + percent) * np.minimum(n1 - p1, n2 - p2) >= percent * (n1 + n2))


def _near(n1, x1, y1, n2, x2, y2, percent):
    """The test of ``_signs_near`` for signatures of two words."""
    return _signs_near(n1, (x1, y1), n2, (x2, y2), percent)


def _signs_near(n1, words1, n2, words2, percent):
    """Whether signatures allow a link: bits of parity that differ are at most as
    many as the tokens that only one of the sets has."""
    apart = sum(np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64) for a, b in zip(words1, words2))
    return apart <= n1 + n2 - 2 * -(-percent * (n1 + n2) // (100 + percent))


def _hooks(percent: int, pivots: int):
    """Each set with the pivots of its token, the first of its rows."""

    def run(batches):
        held = None
        for now in _columns(batches, ROW):
            if held is not None:
                now = [np.r_[p, c] for p, c in zip(held, now)]
            token, cls, at, root, x, y = now
            first = np.r_[True, token[1:] != token[:-1]]
            start = np.flatnonzero(first)[np.cumsum(first) - 1]
            n, pos, row = at >> 32, at & 0xFFFFFFFF, np.arange(len(token))
            for k in range(pivots):
                lead = np.minimum(start + k, row)
                ok = (lead < row) & (root != root[lead]) & _fit(n, pos, n[lead], pos[lead], percent)
                ok &= _near(n, x, y, n[lead], x[lead], y[lead], percent)
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array(cls[ok]), pa.array(cls[lead][ok])], names=["a", "b"])
            held = [c[start[-1] : start[-1] + pivots] for c in now]

    return run


def hooked(rows: DataFrame, turn: int, pivots: int, percent: int) -> DataFrame:
    """Pairs of sets and pivots; the pivots of a token are the smallest by a hash
    that depends on the turn and a few bits of the token."""
    salt = F.xxhash64("cls", F.col("token").bitwiseAND(SPREAD - 1), F.lit(turn))
    dealt = rows.withColumn("salt", salt).repartition("token").sortWithinPartitions("token", "salt", "cls")
    return dealt.select(*ROW).mapInArrow(_hooks(percent, pivots), "a long, b long")


def _groups(batches, names):
    """Whole groups of equal (token, part), many at a time; rows come sorted so."""
    held: list = []
    for now in _columns(batches, names):
        change = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])) + 1
        joined = bool(held) and held[-1][0][-1] == now[0][0] and held[-1][1][-1] == now[1][0]
        if joined and not len(change):
            held.append(now)  # the group goes on: nothing is copied yet
            continue
        cut = int(change[-1]) if len(change) else 0
        whole = [*held, [c[:cut] for c in now]]
        yield [np.concatenate(c) for c in zip(*whole)]
        held = [[c[cut:] for c in now]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _crossings(percent: int, signs: list[str]):
    """All pairs of different components in a group that sizes, positions and
    signatures allow, smaller class first; between two blocks only pairs of both.

    A pair that also shares one of the tokens before is left to that token: there
    both positions are smaller, so it passes wherever it passes here."""
    names = ["token", "part", "cls", "at", "root", "block", *signs, *_before()]

    def met(before, i, j):
        """Whether the rows i and j hold an equal token before their own."""
        return np.logical_or.reduce([a[i] == b[j] for a in before for b in before])

    def pairs(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches):
        for token, part, cls, at, root, block, *more in _groups(batches, names):
            if not len(token):
                continue
            words, before = more[: len(signs)], more[len(signs) :]
            n, pos = at >> 32, at & 0xFFFFFFFF
            edges = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (part[1:] != part[:-1]), True])

            def linkable(i, j):
                """Which of the pairs (i, j) of rows are made."""
                ok = (root[i] != root[j]) & _fit(n[i], pos[i], n[j], pos[j], percent)
                ok &= (part[i] < 0) | (block[i] != block[j])
                for test in (lambda i, j: _signs_near(n[i], [w[i] for w in words], n[j], [w[j] for w in words], percent),
                             lambda i, j: ~met(before, i, j)):
                    ok[ok] = test(i[ok], j[ok])
                return ok

            two = edges[:-1][np.diff(edges) == 2]  # most groups hold two classes
            two = two[linkable(two, two + 1)]
            yield pairs(cls[two], cls[two + 1])
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo < 3:
                    continue
                r, c = root[lo:hi], cls[lo:hi]
                if (r == r[0]).all():
                    continue
                _, group, many = np.unique(r, return_inverse=True, return_counts=True)
                most = group == many.argmax()
                for i in np.flatnonzero(~most):  # members of the largest component meet only the others
                    j = np.flatnonzero(most | (c > c[i])) + lo
                    j = j[linkable(np.full(len(j), lo + i), j)]
                    if len(j):
                        yield pairs(cls[j], np.full(len(j), c[i]))

    return run


def _before() -> list[str]:
    return [f"before{k}" for k in range(1, BEFORE + 1)]


def crossings(rows: DataFrame, percent: int, signs: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """Distinct pairs of different components that share a token of ``rows``;
    ``signs`` holds longer signatures (cls, words) than the rows do; ``size`` is about how many rows there are.

    Tokens of one component make no pairs and are left out first.  A token of
    more than ``BLOCK`` classes is dealt to pairs of blocks: part -1 is a whole
    group or one block with itself, any other part is two blocks."""
    many = materialize(rows.groupBy("token").agg(F.count("*").alias("rows"), (F.min("root") != F.max("root")).alias("mixed"))
                       .where("mixed").select(F.col("token").alias("t"), F.ceil(F.col("rows") / BLOCK).cast("long").alias("blocks")), size)
    words = ["x", "y"] if signs is None else [c for c in signs.columns if c != "cls"]
    rows = rows.join(many, F.col("token") == F.col("t")).select("token", "cls", "at", "root", "blocks", *(words if signs is None else []))
    # where there is no such token, a value of the class stands, which no other class has
    order = Window.partitionBy("cls").orderBy("at", "token")
    rows = rows.select("*", *[F.coalesce(F.lag("token", k).over(order), F.xxhash64("cls", F.lit(k))).alias(c) for k, c in enumerate(_before(), 1)])
    if signs is not None:
        rows = rows.join(signs, "cls")
    block = F.pmod(F.xxhash64("cls"), F.col("blocks"))
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lower, upper = F.least("block", "other"), F.greatest("block", "other")
    # one block with itself is named by a token of its own, so that it goes to another task than its neighbours
    alone = F.col("block") == F.col("other")
    rows = rows.select(
        F.when(F.col("blocks") == 1, F.col("token")).otherwise(F.xxhash64("token", lower, upper)).alias("token"),
        F.when(alone, F.lit(-1)).otherwise(lower * F.col("blocks") + upper).alias("part"), "cls", "at", "root", "block", *words, *_before())
    return rows.repartition("token").sortWithinPartitions("token", "part", "cls").mapInArrow(_crossings(percent, words), "a long, b long").distinct()


def _overlap(x, y) -> int:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def _halves(tokens: np.ndarray) -> np.ndarray:
    """Half of each hash, sorted: equal tokens stay equal, so overlaps can only grow."""
    return np.sort((tokens >> np.uint64(32)).astype("<u4"))


def _stored(tokens: np.ndarray, whole: bool) -> tuple[bytes | None, bytes | None]:
    """(whole hashes, half hashes) of a set, one of them null."""
    if whole or len(tokens) <= WHOLE_UP_TO:
        return tokens.astype("<u8").tobytes(), None
    return None, _halves(tokens).tobytes()


def sketch(tokens: np.ndarray) -> bytes:
    """Parity bits of the half hashes, a power of two and at least as many as
    tokens.  Folding its halves onto each other gives the sketch of half the size."""
    size = max(64, 1 << int(len(tokens) - 1).bit_length())
    at = (tokens >> np.uint64(32)) & np.uint64(size - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def _alike(percent: int):
    """Pairs whose sketches allow a link: bits that differ are at most as many as
    the tokens that only one of the sets has."""

    def run(batches):
        for batch in batches:
            n1, n2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n1", "n2"))
            most = n1 + n2 - 2 * -(-percent * (n1 + n2) // (100 + percent))
            apart = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("s1"), batch.column("s2"))):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                while len(x) != len(y):
                    x, y = (x, y) if len(x) > len(y) else (y, x)
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                apart[i] = np.bitwise_count(x ^ y).sum()
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(apart <= most))

    return run


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are worth reading their sets for, by a bit a token."""
    x, y = (sets.select(F.col("cls").alias(k), F.col("n").alias(f"n{i}"), F.col("sketch").alias(f"s{i}")) for i, k in ((1, "a"), (2, "b")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "n1", "n2", "s1", "s2").mapInArrow(_alike(percent), "a long, b long")


def _judge(percent: int):
    """Pairs of stored sets that may be linked, and whether that is sure.

    Two sets of whole hashes decide.  Half hashes of two sets agree by chance
    about n1 * n2 / 2^32 times; ``slack`` further tokens leave less than 1e-15
    that chance made the link."""

    def read(whole, half):
        return np.frombuffer(whole.as_buffer(), "<u8") if whole.is_valid else np.frombuffer(half.as_buffer(), "<u4")

    def run(batches):
        for batch in batches:
            may, sure = [], []
            for x, xh, y, yh in zip(*(batch.column(c) for c in ("x", "xh", "y", "yh"))):
                x, y, slack = read(x, xh), read(y, yh), 0
                if x.itemsize + y.itemsize < 16:
                    x, y = (v if v.itemsize == 4 else _halves(v) for v in (x, y))
                    slack = 4 + int(10 * len(x) * len(y) / 2**32)
                common, need = _overlap(x, y), percent * (len(x) + len(y))
                may.append((100 + percent) * common >= need)
                sure.append((100 + percent) * (common - slack) >= need)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sure, pa.bool_())], names=["a", "b", "sure"]).filter(pa.array(may, pa.bool_()))

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x, y = (sets.select(F.col("cls").alias(k), F.col("tokens").alias(v), F.col("halves").alias(v + "h")) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "xh", "y", "yh")


def judged(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, sure) of the pairs that may be linked.  ``sets`` is bucketed by
    class, so only pairs are shuffled."""
    return _with_sets(pairs, sets).mapInArrow(_judge(percent), "a long, b long, sure boolean")


def _chosen(docs: DataFrame, wanted: DataFrame, width: int, make, schema: str) -> DataFrame:
    """``make`` of the sets of at least the classes of ``wanted`` (cls, least),
    built in one scan, in which only documents of the filter are cut into
    shingles."""
    bits = hash_filter(wanted.select(F.xxhash64("least").alias("id_hash")), "id_hash")

    def run(batches):
        for batch in batches:
            passed = passes(bits, batch.column("id_hash").to_numpy(zero_copy_only=False))
            for _, found in _each_set([batch.filter(pa.array(passed))], width):
                yield make([s for s in found if len(s)])

    return docs.select("text", F.xxhash64("doc_id").alias("id_hash")).mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, width: int, whole: bool) -> DataFrame:
    """(cls, n, sketch, tokens, halves) of at least the classes of ``wanted``;
    ``whole`` keeps whole hashes for every set."""

    def make(found):
        kept = [_stored(s, whole) for s in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([class_of(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
             pa.array([sketch(s) for s in found], pa.binary()), *(pa.array([k[i] for k in kept], pa.binary()) for i in (0, 1))],
            names=["cls", "n", "sketch", "tokens", "halves"])

    return _chosen(docs, wanted, width, make, "cls long, n long, sketch binary, tokens binary, halves binary")


def similar_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class (cls)."""
    docs = keep_columns(docs, "doc_id", "text")
    census = materialize(docs.mapInArrow(_census(width), "doc_id long, n long, cls long, block int, counts binary"))
    rows = census.where("block < 0").select("doc_id", "n", "cls")
    levels = frequency_levels(census)
    shared = _shared_rows(docs.mapInArrow(_prefix_rows(width, percent, levels), PREFIX_SCHEMA), percent)
    classes = rows.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("least"))
    names = components(_links(docs, classes, shared, levels, width, percent))
    least = classes.join(names, classes.cls == names.node, "left").select("cls", "n", "least", F.coalesce("root", "cls").alias("root"))
    top = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(top, "root").select(F.col("cls").alias("_c"), F.col("n").alias("_n"), "component_id")
    return (rows.join(named, (rows.cls == named["_c"]) & (rows.n == named["_n"]), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "cls"))


def _links(docs, classes, shared, levels, width, percent) -> DataFrame:
    """Verified links (a, b) of classes that connect all that is linked."""
    spark = docs.sparkSession
    n_rows = shared.count()
    left = materialize(shared.select("cls").distinct().join(classes, "cls").select("cls", "least"), n_rows)
    n_sets = left.count()
    buckets = partitions_for(spark)
    name = f"strata_sets_{uuid.uuid4().hex}"
    (sets_of(docs, left, width, False).repartition(buckets, "cls").dropDuplicates(["cls"])
     .write.bucketBy(buckets, "cls").sortBy("cls").saveAsTable(name))
    sets = spark.table(name)
    known = materialize(sets.mapInArrow(_signatures, ", ".join(f"{c} long" for c in ("cls", "x", "y", *SIGNS))), n_sets)
    links = roots = None
    for turn, (pivots, partners) in enumerate(HOOKS):
        votes = hooked(_with_roots(shared, known, roots), turn, pivots, percent).groupBy("a", "b").agg(F.count("*").alias("votes"))
        ranked = F.sort_array(F.collect_list(F.struct("votes", "b")), asc=False)  # at most a few per prefix token
        best = votes.groupBy("a").agg(F.slice(ranked, 1, partners).alias("few")).select("a", F.explode("few.b").alias("b"))
        # pairs that are not sure are left to the exact step
        found = materialize(judged(alike(best, sets, percent), sets, percent).where("sure").select("a", "b"), partners * n_sets)
        links = found if links is None else links.union(found)
        roots = components(links)
    found = materialize(crossings(materialize(_with_roots(shared, known, roots), n_rows), percent, known.select("cls", *SIGNS), n_rows), n_rows)
    found = materialize(alike(found, sets, percent), found.count())
    n_pairs = found.count()  # of a written table, as the other counts here
    alive = found.select("a").union(found.select("b")).distinct().withColumnRenamed("a", "cls")
    prefixes = materialize(docs_prefixes(docs, alive.join(classes, "cls"), levels, width, percent), min(n_sets, 2 * n_pairs))
    found = materialize(share_in_orders(found, prefixes, percent), n_pairs)
    checked = materialize(judged(found, sets, percent), n_pairs)
    close = checked.where("not sure").select("a", "b")
    classes_of_close = close.select("a").union(close.select("b")).distinct().withColumnRenamed("a", "cls")
    whole = sets_of(docs, classes_of_close.join(classes, "cls").select("cls", "least"), width, True).dropDuplicates(["cls"])
    exact = materialize(judged(close, whole, percent).select("a", "b"), n_pairs)
    spark.sql(f"DROP TABLE {name}")  # the links are written
    return links.union(checked.where("sure").select("a", "b")).union(exact)


def docs_prefixes(docs: DataFrame, wanted: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """(cls, n, prefixes) of at least the wanted classes from their documents: half
    hashes of the prefix under each further order, one after the other."""

    def make(found):
        prefixes = [np.concatenate([prefix(s, order, levels, percent) for order in range(1, ORDERS)]) if ORDERS > 1 else s[:0] for s in found]
        return pa.RecordBatch.from_arrays(
            [pa.array([class_of(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()),
             pa.array([(p >> np.uint64(32)).astype("<u4").tobytes() for p in prefixes], pa.binary())], names=["cls", "n", "prefixes"])

    return _chosen(docs, wanted, width, make, "cls long, n long, prefixes binary").dropDuplicates(["cls"])


def _share_in_orders(percent: int):
    """Pairs that share a prefix token of a fitting place under each further order."""

    def run(batches):
        for batch in batches:
            keep = []
            for n1, x, n2, y in zip(*(batch.column(c) for c in ("n1", "p1", "n2", "p2"))):
                n1, n2, shares = n1.as_py(), n2.as_py(), True
                for a, b in zip(*(np.split(np.frombuffer(v.as_buffer(), "<u4"), max(ORDERS - 1, 1)) for v in (x, y))):
                    _, at, bt = np.intersect1d(a, b, return_indices=True)
                    shares = shares and bool(_fit(n1, at, n2, bt, percent).any())
                keep.append(shares or ORDERS == 1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def share_in_orders(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the further orders leave, looked up pair by pair: no rows of a
    frequent token meet, and no more pairs are made than come in."""
    x, y = (prefixes.select(F.col("cls").alias(k), F.col("n").alias(f"n{i}"), F.col("prefixes").alias(f"p{i}")) for i, k in ((1, "a"), (2, "b")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "n1", "n2", "p1", "p2").mapInArrow(_share_in_orders(percent), "a long, b long")


def _signatures(batches):
    """512 bits of parity for each stored set, from half of each hash, and the same
    folded to 128 bits (x, y)."""
    for batch in batches:
        words = np.zeros((batch.num_rows, len(SIGNS)), np.uint64)
        for i, (whole, half) in enumerate(zip(batch.column("tokens"), batch.column("halves"))):
            h = _halves(np.frombuffer(whole.as_buffer(), "<u8")) if whole.is_valid else np.frombuffer(half.as_buffer(), "<u4")
            parity = np.bincount(h & np.uint32(64 * len(SIGNS) - 1), minlength=64 * len(SIGNS)) & 1
            words[i] = np.packbits(parity.astype(np.uint8), bitorder="little").view("<u8")
        words = words.view(np.int64)
        x, y = (np.bitwise_xor.reduce(words[:, k::2], axis=1) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([batch.column("cls"), *(pa.array(np.ascontiguousarray(w)) for w in (x, y, *words.T))], names=["cls", "x", "y", *SIGNS])


def _with_roots(rows: DataFrame, known: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows with the component (its own class where it has no link) and the signature of their class."""
    named = known.withColumn("root", F.col("cls"))
    if roots is not None:
        named = known.join(roots, known.cls == roots.node, "left").select("cls", "x", "y", F.coalesce("root", "cls").alias("root"))
    return rows.join(named, "cls").select(*ROW)


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one that names it; all columns stay.

    Of rows equal in id and text one stays.  Rows without an id stay unless their
    component is named by an id or they repeat such a row."""
    found = materialize(similar_components(docs, width, percent))
    own, rows = f"id_{uuid.uuid4().hex}", f"rows_{uuid.uuid4().hex}"  # names that no input column has
    stay = materialize(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias(rows)), found.count())
    kept = docs.join(stay.select(own), F.col("doc_id").eqNullSafe(F.col(own)), "left_semi")
    if stay.where(F.col(rows) > 1).limit(1).count() == 0:
        return kept
    return kept.dropDuplicates(["doc_id", "text"])
