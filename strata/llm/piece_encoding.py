"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text becomes marked words: a meta mark in front and in place of every blank,
cut before each mark.  The distinct words of a slice that are not known yet are
sorted, which is a depth-first walk of their trie: a word keeps the forward
scores of the prefix it shares with the one before it and only computes the
rest.  Characters without a piece fall back to byte pieces, so decoding gives
back the exact text.

Scores are log probabilities.  A model file of kind BPE stores merge ranks in
their place (whole numbers, none above 0); ranks become Zipf log
probabilities ``-ln(rank + 1)``.  The result is the best segmentation under
these scores (the unigram rule), not a replay of the merges.

Edge cases: null and empty texts have no ids and decode to the empty text; a
mark character inside a text is written in byte pieces, so it survives; very
long words need no recursion; repeated rows are encoded one by one; an empty
table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import keep_columns, slices

MARK = "▁"
_WORD = re.compile(f"{MARK}[^{MARK}]*")
#: stands for a mark character of the text itself while words are cut
_OWN_MARK = "\ud800"  # no text holds a lone surrogate
CACHE_WORDS = 500_000


class PieceModel:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], fixed: set[int] = frozenset()):
        apart = set(byte_ids.values()) | set(fixed)
        self.ids = {p: i for i, p in enumerate(pieces) if i not in apart and p}
        known = list(self.ids.values())
        if known and all(scores[i] <= 0 and scores[i] == int(scores[i]) for i in known) and min(scores[i] for i in known) < -100:
            scores = list(scores)
            for rank, i in enumerate(sorted(known, key=lambda i: (-scores[i], i))):
                scores[i] = -math.log(rank + 1.0)
        self.scores = scores
        self.best = {p: (scores[i], i) for p, i in self.ids.items()}
        self.trie: dict = {}  # character -> node; the entry "" of a node is its piece's (score, id)
        for p, hit in self.best.items():
            node = self.trie
            for ch in p:
                node = node.setdefault(ch, {})
            node[""] = hit
        self.byte_ids = byte_ids
        self.byte_score = min((scores[i] for i in self.ids.values()), default=0.0) - 1.0
        self.out = [p.replace(MARK, " ").encode() for p in pieces]
        for b, i in byte_ids.items():
            self.out[i] = bytes([b])
        for i in fixed:
            self.out[i] = b""
        self.cache: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        fixed = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        return cls([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], byte_ids, fixed)

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Best ids of each word; ``words`` must be sorted and distinct.

        Position j keeps the best sum over the first j characters, the start
        and id of the last piece, and the piece-trie nodes that are open there.
        All three are cut back to the common prefix with the next word, never
        computed again."""
        score, back, opened = [0.0], [(0, -1)], [[]]
        last, out = "", []
        root, byte_score, worst = self.trie, self.byte_score, -math.inf
        for word in words:
            keep = len(commonprefix([last, word]))
            del score[keep + 1 :], back[keep + 1 :], opened[keep + 1 :]
            nodes = opened[keep]
            for j in range(keep, len(word)):
                ch, top, at, reach = word[j], worst, None, []
                single = root.get(ch)
                for i, node in nodes:
                    node = node.get(ch)
                    if node is not None:
                        reach.append((i, node))
                        piece = node.get("")
                        if piece is not None and score[i] + piece[0] > top:
                            top, at = score[i] + piece[0], (i, piece[1])
                piece = None
                if single is not None:
                    reach.append((j, single))
                    piece = single.get("")
                    if piece is not None and score[j] + piece[0] > top:
                        top, at = score[j] + piece[0], (j, piece[1])
                if piece is None:
                    value = score[j] + byte_score * len(ch.encode("utf-8", "surrogatepass"))
                    if value > top:
                        top, at = value, (j, -1)
                score.append(top)
                back.append(at)
                opened.append(reach)
                nodes = reach
            last, ids, j = word, [], len(word)
            while j:
                i, piece = back[j]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += [self.byte_ids[b] for b in reversed(word[i:j].encode("utf-8", "surrogatepass"))]
                j = i
            ids.reverse()
            out.append(ids)
        return out

    def words(self, text: str) -> list[str]:
        if MARK in text:
            text = text.replace(MARK, _OWN_MARK)
        return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.words(t or "") for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = sorted({w for words in split for w in words if w not in self.cache})
        plain = [w for w in new if _OWN_MARK not in w]
        for word, ids in zip(plain, self.encode_sorted(plain)):
            self.cache[word] = np.array(ids, "<i4").tobytes()
        own = [self.byte_ids[b] for b in MARK.encode()]
        for word in (w for w in new if _OWN_MARK in w):  # a mark of the text: its bytes stand between the parts
            parts = word.split(_OWN_MARK)
            known = dict(zip(sorted(set(parts)), self.encode_sorted(sorted(set(parts)))))
            ids = known[parts[0]][:]
            for part in parts[1:]:
                ids += own + known[part]
            self.cache[word] = np.array(ids, "<i4").tobytes()
        return [np.frombuffer(b"".join([self.cache[w] for w in words]), "<i4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join([self.out[i] for i in ids.tolist()])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def model_at(path: str | None) -> PieceModel:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    if path not in _MODELS:
        _MODELS[path] = PieceModel.load(path)
    return _MODELS[path]


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the ids of each whole text."""

    def run(batches):
        model = model_at(model_path)
        for batch in batches:
            for part in slices(batch):
                ids = model.encode(part.column("text").to_pylist())
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))],
                    names=["doc_id", "ids"])

    return keep_columns(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, text, and the count and checksum of the ids it was read from."""

    def run(batches):
        model = model_at(model_path)
        for batch in batches:
            ids = batch.column("ids")
            for lo in range(0, batch.num_rows, 200):
                part = [np.array(x.as_py() if x.as_py() is not None else [], np.int64) if not x.is_valid else x.values.to_numpy(zero_copy_only=False)
                        for x in ids.slice(lo, 200)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, 200), pa.array([model.decode(x) for x in part], pa.string()),
                     pa.array([len(x) for x in part], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in part], pa.int64())],
                    names=["doc_id", "text", "n_ids", "ids_crc32"])

    return encoded.mapInArrow(run, "doc_id long, text string, n_ids long, ids_crc32 long")
