"""Token counts by dynamic programming over a trie of distinct pre-tokens.

The distinct pre-tokens of a slice that a worker hasn't seen are sorted, which is their
trie: a node is a run of rows with a common prefix. The unigram forward pass (the best
score of any segmentation of a prefix) is computed one depth at a time for all nodes of
that depth, once per shared prefix; at a pre-token's last character its node holds the
token count of the best segmentation. Tries of fewer than FEW words, as those of very long ones, are walked depth first
instead, which shares prefixes just so. Counts are kept in the worker and summed per
document. One scan, no shuffle.

The vocabulary is that of a sentencepiece model; pieces of a model that stores ranks get
the score -log(2 + rank) (a Zipf law), byte pieces BYTE_SCORE for each byte of a character
that no piece holds. Equal scores go to the shortest last piece.

Defined cases: null and blank texts have no pre-tokens and no tokens; a null doc_id is
kept; repeated rows give repeated results; a pre-token of any length is counted whole;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _text as T
from terrapair.llm.word_cache import WordCache

SPACE = "▁"
BYTE_SCORE = -14.0
#: Tries hold words of up to TIER, 2 TIER, 4 TIER, ... characters, and about CELLS characters each.
TIER = 48
CELLS = 1 << 20
#: Words from which on whole depths at once are faster than one node after the other.
FEW = 16
SCHEMA = "doc_id long, n_words long, n_tokens long"


class Unigram:
    """Pieces with scores, looked up by a hash of their code points."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece, score = model.id_to_piece(i), model.get_score(i)
            if score > -1e8:  # sentinels are no pieces
                pieces[piece] = score
        if min(pieces.values()) < -1000:  # ranks
            pieces = {p: -math.log(2 - s) for p, s in pieces.items()}
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        points = [np.array([ord(c) for c in p], T.U64) + T.U64(1) for p in pieces]
        flat, size = np.concatenate(points), np.array([len(p) for p in points])
        off = np.concatenate([[0], np.cumsum(size)])
        h = T.mix(T.ranges(T.prefix(flat), off[:-1], off[1:]))
        order = np.argsort(h)
        self.keys, self.scores = h[order], np.array(list(pieces.values()))[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys >> T.U64(44)).astype(np.int64)] = True

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Scores of hashed strings, -inf if no piece."""
        out = np.full(len(h), -np.inf)
        at = np.flatnonzero(self.bits[(h >> T.U64(44)).astype(np.int64)])
        pos = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        hit = self.keys[pos] == h[at]
        out[at[hit]] = self.scores[pos[hit]]
        return out

    def count_one(self, word: str) -> int:
        """Tokens of one pre-token, by the plain forward pass."""
        best, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for d in range(1, len(word) + 1):
            for n in range(1, min(self.longest, d) + 1):
                s, k = self.pieces.get(word[d - n : d]), 1
                if s is None and n == 1:
                    k = len(word[d - 1].encode("utf-8", "replace"))
                    s = BYTE_SCORE * k
                if s is not None and best[d - n] + s > best[d]:
                    best[d], count[d] = best[d - n] + s, count[d - n] + k
        return count[-1]

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token, through tries of bounded size: of words of like length, so that
        few cells are empty, and of consecutive words in their order, so that prefixes are shared."""
        out = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tier = np.ceil(np.log2(np.maximum(sizes, TIER) / TIER)).astype(np.int64)
        order = np.array(sorted(range(len(words)), key=lambda i: (tier[i], words[i])), np.int64)
        at = 0
        while at < len(order):
            upto = int(np.searchsorted(tier[order], tier[order[at]], "right"))
            many = max(1, CELLS // (TIER << int(tier[order[at]])))
            rows = order[at : min(upto, at + many)]
            out[rows] = (self._walk if len(rows) < FEW else self._trie)([words[i] for i in rows])
            at += len(rows)
        return out

    def _walk(self, words: list[str]) -> list[int]:
        """Counts of sorted words: each goes on from where it parts from the one before."""
        out, before = [], ""
        best, count = [0.0], [0]
        find, longest, worst = self.pieces.get, self.longest, -math.inf
        for word in words:
            at = len(commonprefix((before, word)))
            del best[at + 1 :], count[at + 1 :]
            for d in range(at + 1, len(word) + 1):
                most, tokens = worst, 0
                for n in range(1, min(longest, d) + 1):
                    s, k = find(word[d - n : d]), 1
                    if s is None:
                        if n > 1:
                            continue
                        k = len(word[d - 1].encode("utf-8", "replace"))
                        s = BYTE_SCORE * k
                    if best[d - n] + s > most:
                        most, tokens = best[d - n] + s, count[d - n] + k
                best.append(most), count.append(tokens)
            out.append(count[-1])
            before = word
        return out

    def _trie(self, words: list[str]) -> np.ndarray:
        """Counts of sorted words; a node is a run of rows with a common prefix."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        deep = int(size.max(initial=0))
        if not deep:
            return np.zeros(len(words), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.zeros((len(words), deep), np.uint32)
        there = np.arange(deep) < size[:, None]
        points[there] = flat
        same = np.zeros((len(words), deep), bool)  # a row's prefix is also that of the row above, and both have it
        same[1:] = np.logical_and.accumulate((points[1:] == points[:-1]) & there[1:] & there[:-1], axis=1)
        power, inverse = T.powers(deep + 1)
        sums = np.zeros((len(words), deep + 1), T.U64)
        np.cumsum((points.astype(T.U64) + T.U64(1)) * power[:deep], axis=1, out=sums[:, 1:])
        best = np.zeros((len(words), deep + 1))
        count = np.zeros((len(words), deep + 1), np.int64)
        for d in range(1, deep + 1):
            at = np.flatnonzero(~same[:, d - 1] & (size >= d))
            if not len(at):
                continue
            # every last piece at once, the shortest first
            back = d - np.arange(1, min(self.longest, d) + 1)
            scores = self.lookup(T.mix((sums[at, d][:, None] - sums[at[:, None], back]) * inverse[back]).reshape(-1)).reshape(len(at), -1)
            none = np.isinf(scores[:, 0])
            c = points[at, d - 1]
            width = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
            scores[none, 0] = BYTE_SCORE * width[none]
            scores += best[at[:, None], back]
            won = scores.argmax(1)
            rows = np.arange(len(at))
            tokens = count[at, d - 1 - won] + np.where(none & (won == 0), width, 1)
            owner = np.maximum(np.searchsorted(at, np.arange(len(words)), "right") - 1, 0)
            best[:, d], count[:, d] = scores[rows, won][owner], tokens[owner]
        return count[np.arange(len(words)), size]


_COUNTERS: dict[str, tuple[Unigram, WordCache]] = {}


def _map(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _COUNTERS:
            _COUNTERS[model_file] = Unigram(model_file), WordCache(np.int32)
        model, cache = _COUNTERS[model_file]

        def encode(words: list[bytes]) -> list[np.ndarray]:
            return list(model.counts([SPACE + w.decode("utf-8", "replace") for w in words]).reshape(-1, 1))

        for batch in T.slices(batches):
            data, off = T.buffers(T.column(batch, "text"))
            words = T.Words(data, off, T.NON_SPACE)
            total = np.zeros(len(words.start) + 1, np.int64)
            if len(words.start):
                rows = cache.rows(words, data.tobytes(), encode)
                np.cumsum(cache.flat[cache.first[rows]], out=total[1:])
            yield pa.record_batch([T.column(batch, "doc_id"), pa.array(words.count), pa.array(total[words.off[1:]] - total[words.off[:-1]])], names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: pre-tokens and tokens of their best unigram segmentations."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_map(model_file), SCHEMA)
