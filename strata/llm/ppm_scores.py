"""LM scoring by prediction by partial matching, pretrained on the corpus.

The model is a byte-context trie of order 5 counted over the training documents
(A-Z lower-cased, five start marks before and one end symbol after each text).
A symbol unseen in a context escapes to the next shorter one; an escape is
charged by method C (distinct symbols / (count + distinct symbols)), and symbols
of the longer context are excluded below.  A text's score is the log10
probability of its bytes and its end.

Neither the trie nor the word counts are broadcast: they grow with the corpus.
Documents are dealt to blocks of about ``BLOCK_BYTES``.  A block sends its
distinct byte 6-grams and word hashes, with their training counts, to trie
buckets (6-grams by the last two context bytes, so a bucket owns the orders 5 to
2 of its contexts).  A bucket adds the counts and sends back the log probability
of each requested 6-gram and the count of each requested word; the block then
reads its documents' scores off.  Orders 1 and 0 are one dense table of 65,536
counts.

Edge cases: null text counts as empty (its end alone is scored); without training
documents every symbol is uniform and every word count 0; rows with equal ids or
texts are scored one by one; an empty table gives an empty result; other columns
are ignored; a null id belongs to the training documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (FOLD, fold_of, keep_columns, materialize, mix, slices, span_hashes, text_buffer, text_hash,
                               word_spans)

ORDER = 5
START, END = 0xFE, 0xFF  # bytes that no UTF-8 text holds
BLOCK_BYTES = 16_000_000
HELD_FOLD = 1
END_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)
SYMBOLS = 256

REQUEST = "bucket int, block int, kind int, keys binary, counts binary"
RESPONSE = "block int, bucket int, kind int, data binary"
WORDS, GRAMS, TOTALS = 0, 1, 2


# ---- one slice of documents -------------------------------------------------


def grams_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(6-gram, document) of every symbol, the end symbols included."""
    n = len(off) - 1
    stream = np.full(len(buf) + (ORDER + 1) * n, START, np.uint8)
    ends = off[1:] + (ORDER + 1) * np.arange(1, n + 1) - 1
    starts = off[:-1] + (ORDER + 1) * np.arange(n)
    symbol = np.ones(len(stream), bool)
    for k in range(ORDER):
        symbol[starts + k] = False
    text = symbol.copy()
    text[ends] = False
    stream[text] = FOLD[buf]
    stream[ends] = END
    g = np.zeros(max(len(stream) - ORDER, 0), np.int64)
    for k in range(ORDER + 1):
        g <<= 8
        g |= stream[k : k + len(g)]
    return g[symbol[ORDER:]], np.repeat(np.arange(n), np.diff(off) + 1)


def words_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hash, document) of every token, one end token per document."""
    folded = FOLD[buf]
    start, end, doc = word_spans(folded, off)
    n = len(off) - 1
    return np.concatenate([span_hashes(folded, start, end), np.full(n, END_WORD)]), np.concatenate([doc, np.arange(n)])


def pack_grams(g: np.ndarray) -> bytes:
    return np.ascontiguousarray(g.astype("<i8").view(np.uint8).reshape(-1, 8)[:, : ORDER + 1]).tobytes()


def unpack_grams(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, ORDER + 1)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, : ORDER + 1] = rows
    return out.view("<i8").ravel()


def gram_bucket(g: np.ndarray, buckets: int) -> np.ndarray:
    return (mix((g >> 8) & 0xFFFF) % np.uint64(buckets)).astype(np.int64)


def word_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and summed counts of several (distinct sorted keys, counts)."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0][0], parts[0][1].astype(np.int64)
    keys = np.unique(np.concatenate([k for k, _ in parts]))
    total = np.zeros(len(keys), np.int64)
    for k, c in parts:
        total[np.searchsorted(keys, k)] += c.astype(np.int64)
    return keys, total


def _parts(data: pa.Table):
    for batch in data.combine_chunks().to_batches():
        yield from slices(batch)


def distinct_of(data: pa.Table):
    """The block's distinct words and 6-grams with their training counts."""
    found = {WORDS: [], GRAMS: []}
    for part in _parts(data):
        buf, off = text_buffer(part.column("text"))
        train = part.column("train").to_numpy(zero_copy_only=False)
        keys, doc = words_of(buf, off)
        keys, inv = np.unique(keys, return_inverse=True)
        found[WORDS].append((keys, np.bincount(inv, train[doc], minlength=len(keys))))
        # a 6-gram has 48 bits, so one plain sort takes the training mark along
        g, doc = grams_of(buf, off)
        marked = np.sort((g << 1) | train[doc])
        first = np.flatnonzero(np.diff(marked >> 1, prepend=-1))
        found[GRAMS].append((marked[first] >> 1, np.add.reduceat(marked & 1, first)))
        if len(found[GRAMS]) >= 8:
            found = {k: [_tally(v)] for k, v in found.items()}
    return {k: _tally(v) for k, v in found.items()}


def _request(buckets: int):
    def run(key, data):
        out = []
        for kind, (keys, counts) in distinct_of(data).items():
            where = (word_bucket if kind == WORDS else gram_bucket)(keys, buckets)
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(buckets + 1))
            for b in range(buckets):
                pick = order[cut[b] : cut[b + 1]]
                if len(pick):
                    out.append((b, key[0].as_py(), kind, pack_grams(keys[pick]) if kind == GRAMS else keys[pick].tobytes(), counts[pick].astype("<u4").tobytes()))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bucket", "block", "kind", "keys", "counts"])

    return run


# ---- the trie ------------------------------------------------------------------


def log_probabilities(g: np.ndarray, c: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 p(last byte | five bytes before) of sorted distinct 6-grams, of which
    ``c`` were seen in training; ``pairs[x, y]`` counts y after x over the corpus.

    The symbols of a context are also symbols of every shorter one, so at order
    k the excluded ones are exactly those of its order k+1 context: their number
    and their order-k counts are sums over the seen k+1 rows."""
    out = np.full(len(g), np.nan)
    open_ = np.ones(len(g), bool)
    cost = np.zeros(len(g))
    gone_n, gone_t = np.zeros(len(g)), np.zeros(len(g))  # excluded count and symbols at this order
    for k in range(ORDER, -1, -1):
        if k > 1:
            rows, inv = np.unique(g & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            count = np.bincount(inv, c, minlength=len(rows))
            ctx, cinv = np.unique(rows >> 8, return_inverse=True)
            n, t = np.bincount(cinv, count, minlength=len(ctx)), np.bincount(cinv, count > 0, minlength=len(ctx))
            here, n, t = count[inv], n[cinv][inv], t[cinv][inv].astype(float)
        else:
            table = pairs if k == 1 else pairs.sum(axis=0)[None]
            x, y = ((g >> 8) & 0xFF if k == 1 else np.zeros(len(g), np.int64)), g & 0xFF
            here, n, t = table[x, y].astype(float), table.sum(axis=1)[x].astype(float), (table > 0).sum(axis=1)[x].astype(float)
        total, kinds = n - gone_n, t - gone_t
        hit = open_ & (here > 0)
        out[hit] = cost[hit] + np.log10(here[hit] / (total[hit] + kinds[hit]))
        open_ &= ~hit
        miss = open_ & (kinds > 0)
        cost[miss] += np.log10(kinds[miss] / (total[miss] + kinds[miss]))
        if k > 1:
            # what order k excludes at order k-1: that order's counts of the symbols seen here
            below = _counts_at(rows & ((1 << 8 * k) - 1), g, c, k - 1, pairs)
            gone = np.bincount(cinv, below * (count > 0), minlength=len(ctx))[cinv][inv]
            gone_n, gone_t = np.where(n > 0, gone, gone_n * 0), t
        elif k == 1:
            zero = pairs.sum(axis=0).astype(float)
            gone_n, gone_t = ((pairs > 0) @ zero)[x], t
    left = SYMBOLS - (pairs.sum(axis=0) > 0).sum()
    out[open_] = cost[open_] - np.log10(max(left, 1))
    return out


def _counts_at(keys: np.ndarray, g: np.ndarray, c: np.ndarray, k: int, pairs: np.ndarray) -> np.ndarray:
    """Training counts of (order-k context, symbol) keys."""
    if k == 1:
        return pairs[(keys >> 8) & 0xFF, keys & 0xFF].astype(float)
    rows, inv = np.unique(g & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
    return np.bincount(inv, c, minlength=len(rows))[np.searchsorted(rows, keys)]


def _answer(pairs: np.ndarray):
    def run(key, data):
        bucket, rows, out = key[0].as_py(), data.to_pylist(), []
        for kind in (WORDS, GRAMS):
            own = [r for r in rows if r["kind"] == kind]
            keys = [unpack_grams(r["keys"]) if kind == GRAMS else np.frombuffer(r["keys"], "<u8") for r in own]
            known, count = _tally([(k, np.frombuffer(r["counts"], "<u4")) for k, r in zip(keys, own)])
            if kind == WORDS:
                out.append((-1, bucket, TOTALS, np.array([count.sum(), (count > 0).sum()], "<i8").tobytes()))
                values = np.minimum(count, 2**32 - 1).astype("<u4")
            else:
                values = log_probabilities(known, count, pairs).astype("<f4") if len(known) else np.zeros(0, "<f4")
            out += [(r["block"], bucket, kind, values[np.searchsorted(known, k)].tobytes()) for k, r in zip(keys, own)]
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(x, t) for x, t in zip(columns, [pa.int32(), pa.int32(), pa.int32(), pa.binary()])], names=["block", "bucket", "kind", "data"])

    return run


# ---- scores ------------------------------------------------------------------------


def _score(buckets: int, n: int, v: int):
    floor = np.log10(n + 0.5 * (v + 1))

    def run(key, docs, answers):
        table, read = {}, []
        replies = {(r["kind"], r["bucket"]): r["data"] for r in answers.to_pylist()}
        for part in _parts(docs):  # one sort of each part tells its distinct keys and where they stand
            buf, off = text_buffer(part.column("text"))
            found = {}
            for kind, get in ((WORDS, words_of), (GRAMS, grams_of)):
                keys, doc = get(buf, off)
                keys, inv = np.unique(keys, return_inverse=True)
                found[kind] = keys, inv.astype(np.int32), doc.astype(np.int32)
            read.append((part, found))
        for kind in (WORDS, GRAMS) if read else ():
            keys = np.unique(np.concatenate([found[kind][0] for _, found in read]))
            where = (word_bucket if kind == WORDS else gram_bucket)(keys, buckets)
            values = np.zeros(len(keys))
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(buckets + 1))
            for b in range(buckets):
                pick = order[cut[b] : cut[b + 1]]
                if len(pick):
                    values[pick] = np.frombuffer(replies[kind, b], "<u4" if kind == WORDS else "<f4")
            table[kind] = (keys, values)
        out = []
        for part, found in read:
            rows = part.num_rows
            (count, doc), (value, gdoc) = ((table[kind][1][np.searchsorted(table[kind][0], found[kind][0])][found[kind][1]], found[kind][2]) for kind in (WORDS, GRAMS))
            tokens = np.bincount(doc, minlength=rows)
            base = np.bincount(doc, np.log10(count + 0.5), minlength=rows) - tokens * floor
            score = np.bincount(gdoc, value, minlength=rows)
            train = part.column("train").to_numpy(zero_copy_only=False)
            out.append(pa.table([part.column("doc_id"), pa.array(~train), pa.array(tokens, pa.int64()),
                                 pa.array(np.bincount(doc, count > 0, minlength=rows).astype(np.int64)), pa.array([n] * rows, pa.int64()),
                                 pa.array(base), pa.array(score)], names=NAMES))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in TYPES], names=NAMES)

    return run


NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]


def _pair_counts(batches):
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for part in slices(batch):
            g, _ = grams_of(*text_buffer(part.column("text")))
            total += np.bincount(g & 0xFFFF, minlength=1 << 16)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def _add_pairs(batches):
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for data in batch.column("counts").to_pylist():
            total += np.frombuffer(data, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, token counts, unigram base score and model score."""
    docs = keep_columns(docs, "doc_id", "text").withColumn("train", fold_of(F.col("doc_id")) != HELD_FOLD)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = max(16, blocks)
    parts = docs.where("train").select("text").mapInArrow(_pair_counts, "counts binary").repartition(16).mapInArrow(_add_pairs, "counts binary").collect()
    pairs = sum((np.frombuffer(r["counts"], np.int64) for r in parts), np.zeros(1 << 16, np.int64)).reshape(256, 256)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "train",
                        F.pmod(F.xxhash64("doc_id", text_hash(F.col("text"))), F.lit(blocks)).cast("int").alias("block"))
    requests = dealt.groupBy("block").applyInArrow(_request(buckets), REQUEST)
    answers = materialize(requests.groupBy("bucket").applyInArrow(_answer(pairs), RESPONSE))
    n = v = 0
    for row in answers.where(F.col("kind") == TOTALS).select("data").collect():  # two numbers per bucket
        a, b = np.frombuffer(row["data"], "<i8")
        n, v = n + int(a), v + int(b)
    replies = answers.where(F.col("kind") != TOTALS)
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _score(buckets, n, v),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
