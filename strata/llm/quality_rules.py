"""Quality rules: hashed word and character n-gram logistic regression.

``quality_scores`` returns per document the base counts (words, symbols,
duplicate lines, repeated five-word windows), the fixed base rule, and the
verdict of a calibrated logistic regression trained on ``labels.quality``.

Features are relative frequencies of hashed words and hashed character
4-grams, so a score is one gather and one prefix sum over the text of an Arrow
batch.  The fit uses at most ``max_rows`` labelled rows, chosen by the smallest
hash of their id (documented bound); everything else covers all rows.

Edge cases: null text counts as text without words (all counts 0, base failed,
not kept); an empty table gives an empty result; rows with equal ids or equal
texts are scored one by one; other columns of the input are ignored.  A label
table without rows of both classes gives no model: the base rule alone decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (IS_SPACE, keep_columns, per_document, repeated, slices, span_hashes, text_buffer,
                               windows, word_spans)
from strata.llm.hashed_model import HashedModel, fit

WORD_BUCKETS = 1 << 15
GRAM_BUCKETS = 1 << 15
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_PROBABILITY = 0.5
SCALE = 20.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")


def base_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    start, end, doc = word_spans(buf, off)
    n_docs = len(off) - 1
    inside = ~IS_SPACE[buf]
    hashes = span_hashes(buf, start, end)
    # five-word windows that occur again in their own document
    pos, win = windows(hashes, doc, 5)
    again = repeated(win ^ (doc[pos].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    edge = np.zeros(len(start) + 6, np.int64)
    np.add.at(edge, pos[again], 1)
    np.add.at(edge, pos[again] + 5, -1)
    covered = np.cumsum(edge)[: len(start)] > 0
    # lines with a word, equal to an earlier line
    brk = np.flatnonzero(buf == 10)
    ls = np.sort(np.concatenate([off[:-1], brk + 1]))
    le = np.sort(np.concatenate([off[1:], brk]))
    any_word = np.concatenate([[0], np.cumsum(inside)])
    full = any_word[le] > any_word[ls]
    ls, le = ls[full], le[full]
    ldoc = np.searchsorted(off, ls, side="right") - 1
    key = span_hashes(buf, ls, le) ^ (ldoc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first = np.unique(key, return_index=True)
    lines, distinct = np.bincount(ldoc, minlength=n_docs), np.bincount(ldoc[first], minlength=n_docs)
    return {
        "n_words": np.bincount(doc, minlength=n_docs),
        "word_chars": per_document(inside & ((buf & 0xC0) != 0x80), off),
        "n_symbols": per_document(_SYMBOL[buf], off),
        "n_dup_lines": lines - distinct,
        "n_repeat_words": np.bincount(doc[covered], minlength=n_docs),
        "_words": (hashes, doc),
    }


def gram_ids(buf: np.ndarray) -> np.ndarray:
    """Hashed character 4-gram that starts at each byte."""
    if len(buf) < 4:
        return np.zeros(0, np.int64)
    b = buf.astype(np.uint32)
    g = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16)) | (b[3:] << np.uint32(24))
    return ((g * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def word_ids(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(49)).astype(np.int64)


def _per_doc_mean(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    hi = np.maximum(hi, lo)
    return (total[hi] - total[lo]) / np.maximum(hi - lo, 1)


def raw_scores(buf, off, words, model: HashedModel) -> np.ndarray:
    hashes, doc = words
    first = np.searchsorted(doc, np.arange(len(off)))
    by_word = _per_doc_mean(model.weights[word_ids(hashes)], first[:-1], first[1:])
    n = max(len(buf) - 3, 0)
    by_gram = _per_doc_mean(model.weights[WORD_BUCKETS + gram_ids(buf)], np.minimum(off[:-1], n), np.minimum(np.maximum(off[1:] - 3, 0), n))
    return SCALE * (by_word + by_gram)


def _sparse_rows(batches):
    """Executor side: hashed relative frequencies of each sampled document."""
    for batch in batches:
        for part in slices(batch):
            buf, off = text_buffer(part.column("text"))
            start, end, doc = word_spans(buf, off)
            wid, gid = word_ids(span_hashes(buf, start, end)), gram_ids(buf)
            first = np.searchsorted(doc, np.arange(len(off)))
            ids, values = [], []
            for i in range(len(off) - 1):
                w, wc = np.unique(wid[first[i] : first[i + 1]], return_counts=True)
                g, gc = np.unique(gid[off[i] : max(off[i + 1] - 3, off[i])], return_counts=True)
                ids.append(np.concatenate([w, g + WORD_BUCKETS]).astype(np.int32).tobytes())
                values.append((SCALE * np.concatenate([wc / max(wc.sum(), 1), gc / max(gc.sum(), 1)])).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array(ids, pa.binary()), pa.array(values, pa.binary())], names=["label", "ids", "vals"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 3000) -> HashedModel | None:
    """Fit on at most ``max_rows`` labelled documents (smallest id hashes)."""
    sample = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    rows = joined.mapInArrow(_sparse_rows, "label int, ids binary, vals binary").orderBy("ids", "label").limit(2 * max_rows).toArrow()
    feats = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
             for i, v in zip(rows.column("ids").to_pylist(), rows.column("vals").to_pylist())]
    return fit(feats, np.array(rows.column("label").to_pylist(), float), WORD_BUCKETS + GRAM_BUCKETS)


def judge(buf: np.ndarray, off: np.ndarray, model: HashedModel | None) -> dict[str, np.ndarray]:
    out = base_counts(buf, off)
    words = out.pop("_words")
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    out["probability"] = np.ones(len(off) - 1) if model is None else model.probability(raw_scores(buf, off, words, model))
    out["kept"] = ~out["base_failed"] & (out["probability"] >= KEEP_PROBABILITY)
    return out


def quality_scores(docs: DataFrame, model: HashedModel | None) -> DataFrame:
    """One row per document: base counts, base rule, probability and verdict."""

    def score(batches):
        for batch in batches:
            for part in slices(batch):
                got = judge(*text_buffer(part.column("text")), model)
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64())] + [pa.array(got[n], pa.int64()) for n in names]
                    + [pa.array(got["base_failed"]), pa.array(got["probability"], pa.float64()), pa.array(got["kept"])],
                    names=["doc_id", *names, "base_failed", "probability", "kept"])

    return keep_columns(docs, "doc_id", "text").mapInArrow(score, SCHEMA)


def quality_filter(docs: DataFrame, model: HashedModel | None) -> DataFrame:
    """The kept documents, with every column they came with."""

    def keep(batches):
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(judge(*text_buffer(part.column("text")), model)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
