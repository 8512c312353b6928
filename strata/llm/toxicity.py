"""Toxicity: noisy-channel deobfuscation, then a hashed logistic score.

Spellings that hide a word are found by shape: digits and symbols inside a word,
single letters set apart by blanks or marks, letters repeated three times and
more.  Each becomes a lattice: an observed character may stand for itself or for
the letters it imitates, a separator for nothing, a run for one or two letters,
each at a channel cost.  Viterbi picks the letters that are likeliest under a
character trigram model (counted over all texts of the training fold).  The
restored text is scored by a calibrated logistic regression over the presence of
its words and word beginnings, trained on ``labels.toxic``.

Labels of fold 0 (crc32 of the id, modulo 5) are never read.  The fit uses at
most ``max_rows`` labelled rows of the other folds (smallest id hashes, both
classes; documented bound).

Edge cases: null and empty texts get the score of a text without words; rows with
equal ids or texts are scored one by one; without labels of both classes every
score is the training share of label 1 (0 without labels); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import FOLD, fold_of, keep_columns, mix, slices, span_hashes, text_buffer, word_spans
from strata.llm.hashed_model import HashedModel, fit

WORD_BITS, START_BITS = 18, 16
DIM = (1 << WORD_BITS) + 2 * (1 << START_BITS)
HELD_FOLD = 0
LETTERS = 28  # blank, a-z, any other character

# The letters that a character imitates
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SWAP_COST, DOUBLE_COST, DROP_COST = 0.7, 2.0, 0.4

_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .*_\-]{1,2}[^\W_]){3,}(?![^\W_])")
# a run of characters that hidden spellings use, and what marks one as such
_RUN = re.compile(r"[\w@$!|+(€£¡*.\-]+")
_MARK = re.compile(r"[0-9@$!|+€£¡*.\-(](?=[\w@$])")
_LETTER_RUN = re.compile(r"[^\W\d_]+")
# every match of _SPACED holds one of these: its three last characters and the separator before them
_APART = re.compile(r"[ .*_\-][^\W_](?:[ .*_\-]{1,2}[^\W_]){2}")
_THREE = re.compile(r"([^\W\d_])\1\1")
CACHE_WORDS = 400_000
PIECE = 256  # observed characters that are decoded at a time


def letter(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27


# ---- character model -------------------------------------------------------


_CODE = np.full(256, 27, np.uint8)
_CODE[[9, 10, 11, 12, 13, 32]] = 0
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)


def _count_trigrams(batches):
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        for part in slices(batch):
            buf, _ = text_buffer(part.column("text"))
            c = _CODE[buf].astype(np.int32)
            if len(c) > 2:
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def _add(batches):
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        for data in batch.column("counts").to_pylist():
            total += np.frombuffer(data, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def character_model(texts: DataFrame) -> np.ndarray:
    """log p(third | first two) over 28 symbols; 21,952 counts whatever the input."""
    parts = texts.select("text").mapInArrow(_count_trigrams, "counts binary").repartition(16).mapInArrow(_add, "counts binary").collect()
    counts = np.zeros(LETTERS**3, np.int64)
    for row in parts:
        counts += np.frombuffer(row["counts"], np.int64)
    counts = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
    two = counts.sum(axis=0)
    back = (two + 0.5) / (two + 0.5).sum(axis=1, keepdims=True)
    return np.log((counts + 2.0 * back[None]) / (counts.sum(axis=2, keepdims=True) + 2.0))


# ---- Viterbi over the lattice ----------------------------------------------------


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per observed character (runs joined) its readings and their costs."""
    out: list[list[tuple[str, float]]] = []
    i, token = 0, token.lower()
    while i < len(token):
        ch, j = token[i], i
        while j < len(token) and token[j] == ch:
            j += 1
        run = j - i
        if ch in " .*_-":
            out.append([("", DROP_COST)])
        elif ch.isalpha():
            out.append([(ch * run, 0.0)] if run == 1 else [(ch, 0.5 if run == 2 else 0.0), (ch * 2, 0.0 if run == 2 else DOUBLE_COST)])
        else:
            reads = [(x, SWAP_COST) for x in IMITATES.get(ch, "")]
            out.append(reads + [("", DROP_COST + 1.0)] if reads else [("", DROP_COST)])
            if run > 1 and reads:
                out[-1] += [(x * 2, SWAP_COST + DOUBLE_COST) for x in IMITATES[ch]]
        i = j
    return out


def decode(token: str, model: list) -> str:
    """The likeliest plain spelling of one hidden word.

    A word of more than ``PIECE`` observed characters is decoded piece by piece,
    each from the best state of the piece before, so time grows with its length."""
    parts, word, state = lattice(token), "", (0, 0)
    for lo in range(0, len(parts), PIECE):
        states: dict[tuple[int, int], tuple[float, str]] = {state: (0.0, "")}
        for reads in parts[lo : lo + PIECE]:
            nxt: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, text) in states.items():
                for read, cost in reads:
                    x, y, s = a, b, score - cost
                    for ch in read:
                        c = letter(ch)
                        s += model[x][y][c]
                        x, y = y, c
                    old = nxt.get((x, y))
                    if old is None or s > old[0] or (s == old[0] and text + read < old[1]):
                        nxt[x, y] = (s, text + read)
            states = nxt
        ends = lo + PIECE >= len(parts)
        best, spelt = -math.inf, ""
        for (a, b), (score, text) in sorted(states.items()):
            if ends:
                score += model[a][b][0]
            if score > best:
                best, spelt, state = score, text, (a, b)
        word += spelt
    return word


class Restorer(dict):
    """Restores whole texts: letters set apart in the text as a whole, the rest
    blank-separated string by string; what each string becomes is remembered
    (bounded)."""

    def __init__(self, model: np.ndarray):
        super().__init__()
        self.model = model.tolist()

    def _plain(self, m: re.Match) -> str:
        return decode(m.group(), self.model) or m.group()

    def _letters(self, m: re.Match) -> str:
        return self._plain(m) if _THREE.search(m.group()) else m.group()

    def _unmask(self, token: str) -> str:
        """Decode each run that looks like a hidden word: it begins behind nothing,
        a quote or a bracket, before the last letter, and holds a mark between
        characters.  One pass, since only a run's first such place can differ."""
        last = max((m.end() for m in _LETTER_RUN.finditer(token)), default=0) - 1
        out, at = [], 0
        for m in _RUN.finditer(token):
            lo, hi = m.span()
            if lo and token[lo - 1] not in "\"'":
                lo = token.find("(", lo, hi) + 1
            if 0 < hi - lo and (lo or not m.start()) and lo <= last and _MARK.search(token, lo, hi):
                out += token[at:lo], decode(token[lo:hi], self.model) or token[lo:hi]
                at = hi
        return "".join(out) + token[at:]

    def __missing__(self, token: str) -> str:
        plain = token
        if not token.isalpha():
            plain = self._unmask(token)
        if _THREE.search(plain):
            plain = _LETTER_RUN.sub(self._letters, plain)
        self[token] = plain
        return plain

    def __call__(self, text: str) -> str:
        if len(self) > CACHE_WORDS:
            self.clear()
        if _APART.search(text):
            text = _SPACED.sub(self._plain, text)
        return " ".join([self[token] for token in text.split()])


# ---- features and scores ----------------------------------------------------------------


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs: words without outer marks, and their
    first four and five bytes."""
    col = pa.array(texts, pa.string())
    buf, off = text_buffer(col)
    buf = FOLD[buf]
    start, end, doc = word_spans(buf, off)
    mark = np.zeros(256, bool)
    mark[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
    for _ in range(3):  # outer marks off both ends
        start = start + ((start < end) & mark[buf[np.minimum(start, max(len(buf) - 1, 0))]] if len(buf) else 0)
        end = end - ((start < end) & mark[buf[np.maximum(end - 1, 0)]] if len(buf) else 0)
    full = start < end
    start, end, doc = start[full], end[full], doc[full]
    ids = [(span_hashes(buf, start, end) >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
    docs, base = [doc], 1 << WORD_BITS
    for n in (4, 5):
        long = end - start > n
        h = span_hashes(buf, start[long], start[long] + n)
        ids.append((mix(h + np.uint64(n)) >> np.uint64(64 - START_BITS)).astype(np.int64) + base)
        docs.append(doc[long])
        base += 1 << START_BITS
    key = np.unique(np.concatenate(docs) * DIM + np.concatenate(ids))
    return key // DIM, key % DIM


def _sparse_rows(chars: np.ndarray):
    def run(batches):
        restore = Restorer(chars)
        for batch in batches:
            for part in slices(batch):
                doc, feat = features([restore(t or "") for t in part.column("text").to_pylist()])
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array([feat[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["label", "ids"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 9000) -> tuple[np.ndarray, HashedModel]:
    """(character model, classifier) from the training folds."""
    texts = docs.where(fold_of(F.col("doc_id")) != HELD_FOLD)
    chars = character_model(texts)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_FOLD))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    share = known.agg(F.avg("label")).first()[0] or 0.0

    def sample(label, rows):
        return known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    few = sample(1, max_rows // 3).union(sample(0, max_rows - max_rows // 3))
    rows = (texts.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("label", "text")
            .mapInArrow(_sparse_rows(chars), "label int, ids binary").orderBy("ids", "label").limit(2 * max_rows).toArrow())
    feats = [np.frombuffer(i, np.int32) for i in rows.column("ids").to_pylist()]
    model = fit([(f, np.ones(len(f), np.float32)) for f in feats], np.array(rows.column("label").to_pylist(), float), DIM,
                rounds=30, least_z=4.0)
    if model is None:
        model = HashedModel(np.zeros(DIM, np.float32), math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    return chars, model


def toxicity_scores(docs: DataFrame, chars: np.ndarray, model: HashedModel) -> DataFrame:
    """doc_id, held_out, score and predicted label of every document."""

    def run(batches):
        restore = Restorer(chars)
        for batch in batches:
            for part in slices(batch):
                doc, feat = features([restore(t or "") for t in part.column("text").to_pylist()])
                score = model.probability(np.bincount(doc, model.weights[feat], minlength=part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    rows = keep_columns(docs, "doc_id", "text").withColumn("held_out", fold_of(F.col("doc_id")) == HELD_FOLD)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
