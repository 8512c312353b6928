"""Lexical retrieval packing into token windows.

Documents become token ids (plus one end id) on the executors.  Every full
window of a long document is a sequence of its own; the rest of each document
goes, as compact ids, to a shard.  A shard holds a bounded number of documents,
chosen by a hash that spreads any key, and builds a BM25 inverted index over
them.  The first unused document seeds a window; its most telling terms query
the index, and unused neighbours fill the window best first.  Where they do not
fill it, the index is asked for all the seed's terms, so every document of the
shard that shares a term is tried (then, where nothing is left that shares a
term, the next unused ones).  The neighbour that
no longer fits is cut and seeds the next window, so inner windows carry no
padding; a shard's last tokens go into sequences of descending powers of two,
which need none either.

Edge cases: null text counts as empty, so the document is its end id alone;
repeated rows are packed one by one; very long texts are cut into windows while
they are tokenized; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep_columns, slices, text_hash

WINDOW = 4096
END_ID = 2
DOCS_PER_SHARD = 512
QUERY_TERMS = 12
CACHE_WORDS = 2_000_000
K1, B = 1.2, 0.75

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ROW_SCHEMA = "shard int, seq int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"

# the tokenizer's own blank characters; a text with another control blank is not split by Python
_ODD_BLANKS = tuple(chr(c) for c in (0x1C, 0x1D, 0x1E, 0x1F, 0x180E, 0x200B, 0xFEFF))
# a run of these is one piece of its own for the tokenizer; the apostrophe may start a suffix
_MARKS = "".join(c for c in string.punctuation if c != "'")


def _pieces_only(tokenizer):
    """The same model for strings that are one piece in normal form: cut at blanks
    alone.  A tokenizer made of other steps than these is used as it is."""
    config = json.loads(tokenizer.to_str())
    normal, cut = (config[k] or {} for k in ("normalizer", "pre_tokenizer"))
    last = (cut.get("pretokenizers") or [cut])[-1]
    if {n.get("type") for n in normal.get("normalizers", [normal])} != {"NFC", "Replace", "Lowercase"} or last.get("type") != "ByteLevel" or last.get("add_prefix_space"):
        return tokenizer
    config.update(normalizer=None, added_tokens=[], pre_tokenizer={"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, last]})
    return type(tokenizer).from_str(json.dumps(config))


class WordTokens(dict):
    """Token ids (little-endian uint32 bytes) of each blank-separated string.

    The tokenizer drops white space before it splits, so the ids of a text are
    those of its strings in turn.  At most ``CACHE_WORDS`` strings stay."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _pieces_only(self.tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def learn(self, words: list[str]) -> None:
        """Encode new strings.  A word of plain letters with a run of marks behind
        it has the ids of the lower-cased word, then those of the run, so such
        strings share their words' ids."""
        known, cores, runs, others = [], [], [], set()
        for w in words:
            core = w.rstrip(_MARKS)
            if core.isalpha() and (core.isascii() or (max(core) < "\u0250" and "\u0130" not in core)):
                known.append(w)
                cores.append(core.lower())
                runs.append(w[len(core):])
            else:
                others.add(w)
        self._encode(self.pieces, {p for p in (*cores, *runs) if p and p not in self})
        self._encode(self.tokenizer, others)
        for w, core, run in zip(known, cores, runs):
            self[w] = self[core] + self[run] if run else self[core]

    def _encode(self, tokenizer, words: set[str]) -> None:
        """Many strings in one call, told apart by a lone digit (always a token
        of its own); strings that hold that digit are left to ``__missing__``."""
        words = [w for w in words if "0" not in w]
        stop = self.tokenizer.encode("0", add_special_tokens=False).ids
        if len(words) < 2 or len(stop) != 1:
            return
        ids = np.array(tokenizer.encode_batch_fast([" 0 ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == stop[0])
        if len(cuts) == len(words) - 1:
            data = ids.tobytes()
            lo = np.concatenate([[0], cuts + 1]) * 4
            hi = np.concatenate([cuts, [len(ids)]]) * 4
            self.update(zip(words, [data[a:b] for a, b in zip(lo.tolist(), hi.tolist())]))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
        plain = [not (any(c in t for c in _ODD_BLANKS) or any(s in t for s in self.special)) for t in texts]
        split = [t.split() if ok else None for t, ok in zip(texts, plain)]
        # each string is looked up once; those that were not known are filled in behind
        known = [list(map(self.get, words)) if words is not None else None for words in split]
        unknown = [_places_of_none(ids) if ids is not None else [] for ids in known]
        self.learn({words[i] for words, places in zip(split, unknown) for i in places})
        out = []
        for text, words, ids, places in zip(texts, split, known, unknown):
            if words is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4"))
                continue
            for i in places:
                ids[i] = self[words[i]]
            out.append(np.frombuffer(b"".join(ids), "<u4"))
        return out


def _places_of_none(values: list) -> list[int]:
    places, i = [], -1
    for _ in range(values.count(None)):
        i = values.index(None, i + 1)
        places.append(i)
    return places


_TOKENS: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def to_bytes(ids: np.ndarray) -> bytes:
    """Ids as two bytes each where they fit, else four; the first byte says which."""
    small = len(ids) == 0 or int(ids.max()) < 65536
    return b"\x02" + ids.astype("<u2").tobytes() if small else b"\x04" + ids.astype("<u4").tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _cut(path: str | None, window: int):
    def run(batches):
        words = _tokens(path or _default_path())
        for batch in batches:
            for part in slices(batch, limit=500_000):
                rows: list[tuple] = []
                encoded = words.encode_all([t or "" for t in part.column("text").to_pylist()])
                for shard, doc_id, ids in zip(part.column("shard").to_pylist(), part.column("doc_id").to_pylist(), encoded):
                    ids = np.append(ids, np.uint32(END_ID))
                    n, full = len(ids), len(ids) // window * window
                    for lo in range(0, full, window):
                        rows.append((shard, lo // window, doc_id, lo, window, crc(ids[lo : lo + window]), n, None))
                    if full < n:
                        rows.append((shard, -1, doc_id, full, n - full, 0, n, to_bytes(ids[full:])))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("shard", "seq", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"), r)) for r in rows],
                    schema=_ARROW_ROW)

    return run


_ARROW_ROW = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Bm25:
    """Inverted index over one shard's documents: postings sorted by term, with
    the BM25 weight of each (term, document)."""

    def __init__(self, docs: list[np.ndarray]):
        n = self.n = len(docs)
        size = np.array([len(d) for d in docs], np.int64)
        key = np.concatenate([*docs, np.zeros(0, np.uint32)]).astype(np.int64) * max(n, 1) + np.repeat(np.arange(n), size)
        key, tf = np.unique(key, return_counts=True)
        term, self.doc = key // max(n, 1), key % max(n, 1)
        self.first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        hits = np.diff(np.r_[self.first, len(term)])
        idf = np.repeat(np.log(1 + (n - hits + 0.5) / (hits + 0.5)) * (hits > 1), hits)
        norm = K1 * (1 - B + B * size / max(size.mean() if n else 0.0, 1.0))
        self.weight = idf * tf * (K1 + 1) / (tf + norm[self.doc])
        self.last = self.first + hits
        self.slot = np.repeat(np.arange(len(hits)), hits)  # posting list of each entry
        # a document's own entries, the most telling first (then by term)
        self.order = np.lexsort((term, -idf * tf / (tf + K1), self.doc))
        self.start = np.searchsorted(self.doc[self.order], np.arange(n + 1))

    def neighbours(self, doc: int) -> Iterator[int]:
        """Every other document that shares a term: those found by the most telling
        terms first, then the rest by all terms, each by falling score (ties: smaller
        position)."""
        found = np.zeros(self.n)
        own = self.order[self.start[doc] : self.start[doc + 1]]
        for entry in own[:QUERY_TERMS]:
            lo, hi = self.first[self.slot[entry]], self.last[self.slot[entry]]
            found[self.doc[lo:hi]] += self.weight[lo:hi]
        found[doc] = 0
        order = np.argsort(-found, kind="stable")
        yield from order[found[order] > 0].tolist()
        if len(own) > QUERY_TERMS:
            asked = np.zeros(len(self.first))
            asked[self.slot[own]] = 1
            score = np.bincount(self.doc, self.weight * asked[self.slot], self.n)
            score[doc], score[found > 0] = 0, 0
            order = np.argsort(-score, kind="stable")
            yield from order[score[order] > 0].tolist()


def fill_windows(docs: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, first id, length) that hold every id once."""
    index, used = Bm25(docs), [0] * len(docs)
    sequences, row, room, unread = [], [], window, 0

    def take(i):
        nonlocal row, room
        n = min(room, len(docs[i]) - used[i])
        if n:
            row.append((i, used[i], n))
            used[i] += n
            room -= n
        if room == 0:
            sequences.append(row)
            row, room = [], window

    carried = None
    while True:
        if carried is None or used[carried] == len(docs[carried]):
            while unread < len(docs) and used[unread] == len(docs[unread]):
                unread += 1
            if unread == len(docs):
                break
            carried = unread
        seed, carried, before = carried, None, len(sequences)
        take(seed)
        if len(sequences) == before:
            for i in index.neighbours(seed):
                if used[i] == 0:
                    take(i)
                    if len(sequences) > before:
                        carried = i
                        break
        else:
            carried = seed
    # the last, open window: descending powers of two, each filled exactly
    left = sum(n for _, _, n in row)
    parts = [list(p) for p in row]
    for bit in range(left.bit_length() - 1, -1, -1):
        size = 1 << bit
        if left & size:
            out = []
            while size:
                i, lo, n = parts[0]
                k = min(n, size)
                out.append((i, lo, k))
                size -= k
                parts[0] = [i, lo + k, n - k]
                if n == k:
                    parts.pop(0)
            sequences.append(out)
    return sequences


def _pack(window: int):
    def run(key, data):
        shard = key[0].as_py()
        data = data.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("start", "ascending"), ("ids", "ascending"), ("ids_crc32", "ascending")])
        whole = data.filter(pa.compute.less(pa.compute.fill_null(pa.compute.binary_length(data["ids"]), -1), 0))
        rest = data.filter(pa.compute.is_valid(data["ids"]))
        docs = [from_bytes(b) for b in rest["ids"].to_pylist()]
        doc_ids, starts, totals = (rest[c].to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        base, n = shard << 40, whole.num_rows
        out = [(d, s, k, c, t, base + i, 0) for i, (d, s, k, c, t) in enumerate(zip(*(whole[c].to_pylist() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens"))))]
        for j, seq in enumerate(fill_windows(docs, window)):
            offset = 0
            for i, lo, k in seq:
                out.append((doc_ids[i], starts[i] + lo, k, crc(docs[i][lo : lo + k]), totals[i], base + n + j, offset))
                offset += k
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(names)})

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """One row per piece; the shard count follows the number of documents."""
    shards = max(1, -(-docs.count() // docs_per_shard))
    keyed = keep_columns(docs, "doc_id", "text").select(
        F.pmod(F.xxhash64("doc_id", text_hash(F.col("text"))), F.lit(shards)).cast("int").alias("shard"), "doc_id", "text")
    # copies with equal ids share the hash; their rows still fit one shard unless a key repeats without bound
    cut = keyed.mapInArrow(_cut(tokenizer_path, window), _ROW_SCHEMA)
    return cut.groupBy("shard").applyInArrow(_pack(window), PIECE_SCHEMA)
