"""Byte-level BPE in numpy: encoding by batched merge rounds, decoding by gathering.

A batch of texts becomes one array of code points. Its pieces (the pattern of the public vocabularies: contractions,
words, numbers, punctuation, white space) are found from classes of characters, and equal pieces are found by a 64-bit
hash, so that only pieces not met before are merged. Their bytes lie as symbols in one flat array. Each round finds
the rank of every adjacent pair of symbols by binary search over the sorted keys of all pairs, takes the lowest rank
of each piece, and merges all its pairs of that rank, left to right.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.ragged import EDGE, LETTER, SPACE, U64, char_classes, code_points, cut_sentence, ragged_positions, slices_of, span_hashes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters encoded at a time; a longer text is encoded in parts that end where a piece ends.
SLICE_CHARS = 1 << 19
#: Pieces kept between batches; a full memory is emptied.
MEMORY_PIECES = 500_000
_NONE = np.int64(1 << 40)


def split_pieces(cps: np.ndarray) -> np.ndarray:
    """Where the pieces of marked texts start; the marks between the texts are pieces too."""
    kinds = char_classes()[cps]
    n = len(kinds)
    start = np.ones(n, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == EDGE)
    blank = cps == 0x20
    space = kinds == SPACE
    follows = np.zeros(n, bool)  # a character other than white space comes next, in the same text
    follows[:-1] = ~space[1:] & (kinds[1:] != EDGE)
    # The last white space of a run stands apart, and a blank there opens the next piece.
    tail = space & follows
    start |= tail
    joined = np.zeros(n, bool)
    joined[1:] = (tail & blank)[:-1]
    start &= ~joined
    # An apostrophe alone after anything but a blank may open a contraction.
    quote = (cps == 0x27) & start
    quote[:-1] &= kinds[1:] == LETTER
    quote[-1:] = False
    q = np.flatnonzero(quote)
    if len(q):
        ahead = np.concatenate([cps, np.zeros(3, cps.dtype)])
        one, two = ahead[q + 1], ahead[q + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(q), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        for chosen, width in ((short, 1), (long, 2)):
            at = q[chosen]
            start[at + 1] = False
            after = at + 1 + width
            inside = after[(after < n)]
            start[inside] |= kinds[inside] == LETTER
    return np.flatnonzero(start)


class Vocabulary:
    """Ranks of byte strings, and the sorted keys of all pairs of tokens that make a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array(rank, np.int64)[order]
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        known = sorted((r, t) for t, r in ranks.items())
        lengths = np.zeros(self.size, np.int64)
        lengths[[r for r, _ in known]] = [len(t) for _, t in known]
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(t for _, t in known), np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def merge(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, number of tokens per piece) of pieces of raw bytes."""
        counts = lengths.astype(np.int64).copy()
        symbols = self.of_byte[raw[ragged_positions(starts, lengths)]]
        piece = np.repeat(np.arange(len(starts)), lengths)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        pair = np.full(len(symbols), _NONE)
        if len(symbols) > 1:
            pair[:-1] = np.where(piece[1:] == piece[:-1], self.rank_of(symbols[:-1], symbols[1:]), _NONE)
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            width = np.diff(np.concatenate([first, [len(piece)]]))
            lowest = np.minimum.reduceat(pair, first)
            over = lowest == _NONE
            if over.any():
                gone = np.repeat(over, width)
                finished.append((piece[gone], symbols[gone]))
                stay = ~gone
                symbols, piece, pair = symbols[stay], piece[stay], pair[stay]
                if not len(symbols):
                    break
                lowest, width = lowest[~over], width[~over]
            target = np.repeat(lowest, width)
            hit = pair == target
            # In a run of overlapping pairs every second one is merged.
            where = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(where) != 1])
            first_of_run = np.maximum.accumulate(np.where(run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - first_of_run) % 2 == 0]
            symbols[where] = pair[where]
            stay = np.ones(len(symbols), bool)
            stay[where + 1] = False
            moved = np.cumsum(stay) - 1
            symbols, piece, pair = symbols[stay], piece[stay], pair[stay]
            changed = np.zeros(len(symbols), bool)
            changed[moved[where]] = True
            changed[np.maximum(moved[where] - 1, 0)] = True
            touched = np.flatnonzero(changed)
            nxt = np.minimum(touched + 1, len(symbols) - 1)
            good = (nxt > touched) & (piece[nxt] == piece[touched])
            pair[touched] = np.where(good, self.rank_of(symbols[touched], symbols[nxt]), _NONE)
        if not finished:
            return np.zeros(0, np.int64), counts
        piece = np.concatenate([p for p, _ in finished])
        order = np.argsort(piece, kind="stable")
        counts = np.bincount(piece, minlength=len(starts))
        return np.concatenate([s for _, s in finished])[order], counts

    def decode(self, tokens: np.ndarray) -> np.ndarray:
        return self.bytes[ragged_positions(self.starts[tokens], self.lengths[tokens])]


@lru_cache(maxsize=4)
def load(path: str = VOCABULARY) -> Vocabulary:
    """A vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})


def ship(spark: SparkSession, path: str) -> str:
    """Sends a vocabulary file of the driver to every executor, so that its path need exist on the driver only."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def load_shipped(name: str) -> Vocabulary:
    """Within a task: the vocabulary that ship() has sent."""
    return load(SparkFiles.get(name))


class Encoder:
    """Encodes batches of texts and remembers the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.starts, self.counts = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > MEMORY_PIECES:
            self._forget()
        tokens, counts = self.vocabulary.merge(raw, starts, lengths)
        begin = len(self.tokens) + np.cumsum(counts) - counts
        self.tokens = np.concatenate([self.tokens, tokens.astype(np.int32)])
        at = np.searchsorted(self.hashes, hashes)  # both are sorted
        self.hashes, self.starts, self.counts = (np.insert(old, at, new) for old, new in ((self.hashes, hashes), (self.starts, begin), (self.counts, counts)))

    def _found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each piece's tokens start among the known ones, how many they are, and each text's first piece."""
        cps, bounds = code_points(texts)
        starts = split_pieces(cps)
        wide = 1 + (cps > 0x7F).astype(np.int64) + (cps > 0x7FF) + (cps > 0xFFFF)
        wide[bounds[1:] - 1] = 0
        at_byte = np.concatenate([[0], np.cumsum(wide)])
        raw = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.concatenate([starts[1:], [len(cps)]])
        real = cps[starts] != 0x110000
        of_text = np.searchsorted(starts[real], bounds)
        starts, ends = starts[real], ends[real]
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        hashes = span_hashes(cps, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        if new.any():
            if len(self.hashes) + int(new.sum()) > MEMORY_PIECES:
                self._forget()
                new = np.ones(len(distinct), bool)
            k = first[new]
            self._learn(distinct[new], raw, at_byte[starts[k]], at_byte[ends[k]] - at_byte[starts[k]])
            at = np.searchsorted(self.hashes, distinct)
        return self.starts[at][inverse], self.counts[at][inverse], of_text

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts, where each text's tokens start, one entry more)."""
        begin, counts, of_text = self._found(texts)
        return self.tokens[ragged_positions(begin, counts)], np.concatenate([[0], np.cumsum(counts)])[of_text]

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        _, counts, of_text = self._found(texts)
        return np.diff(np.concatenate([[0], np.cumsum(counts)])[of_text])


def _token_lists(tokens: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(tokens.astype(np.int32, copy=False)))


def encoded_slices(encoder: Encoder, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    plain = [t or "" for t in texts]
    for a, b in slices_of([len(t) for t in plain], SLICE_CHARS):
        if len(plain[a]) <= SLICE_CHARS:
            yield a, b, *encoder.encode(plain[a:b])
        else:
            tokens = np.concatenate([encoder.encode([part])[0] for part in cut_sentence(plain[a], SLICE_CHARS)])
            yield a, b, tokens, np.array([0, len(tokens)])


def token_counts(encoder: Encoder, texts: list[str]) -> np.ndarray:
    out = [np.zeros(0, np.int64)]
    for a, b in slices_of([len(t) for t in texts], SLICE_CHARS):
        if len(texts[a]) <= SLICE_CHARS:
            out.append(encoder.count(texts[a:b]))
        else:
            out.append(np.array([sum(int(encoder.count([part])[0]) for part in cut_sentence(texts[a], SLICE_CHARS))]))
    return np.concatenate(out)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, token_ids) of every row of docs, repeated rows included.

    An empty text has no tokens; a null text gives null. Rows with a null doc_id stay. Whole texts are encoded, and
    strings that look like special tokens are ordinary text. Other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_shipped(name))
        for batch in batches:
            column = batch.column(1)
            for a, b, tokens, offsets in encoded_slices(encoder, column.to_pylist()):
                lists = _token_lists(tokens, offsets)
                missing = column.slice(a, b - a).is_null()
                if missing.true_count:
                    lists = pc.if_else(missing, pa.scalar(None, lists.type), lists)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "token_ids"])

    name = ship(docs.sparkSession, vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, token_ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of rows (doc_id, token_ids); null gives null. Bytes that aren't UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load_shipped(name)
        for batch in batches:
            lists = batch.column(1)
            texts = []
            offsets = lists.offsets.to_numpy()
            tokens = lists.values.to_numpy()
            step = 4096
            for k in range(0, len(lists), step):
                upto = min(k + step, len(lists))
                part = tokens[offsets[k] : offsets[upto]]
                ends = np.concatenate([[0], np.cumsum(known.lengths[part])])
                raw = known.decode(part).tobytes()
                cuts = ends[offsets[k : upto + 1] - offsets[k]].tolist()
                texts += [raw[i:j].decode("utf-8", "replace") for i, j in zip(cuts, cuts[1:])]
            texts = [t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    name = ship(encoded.sparkSession, vocabulary)
    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, token_ids, n_tokens, exact) of every row: exact says that decoding gives the text back.

    A null text gives nulls, an empty one no token and exact. Rows with a null doc_id, repeated rows and texts of any
    length are encoded like any other. An empty table gives an empty one. Other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load_shipped(name)
        encoder = Encoder(known)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b, tokens, offsets in encoded_slices(encoder, texts):
                ends = np.concatenate([[0], np.cumsum(known.lengths[tokens])])[offsets].tolist()
                raw = known.decode(tokens).tobytes()
                exact = [None if t is None else raw[i:j] == t.encode("utf-8", "surrogatepass") for t, i, j in zip(texts[a:b], ends, ends[1:])]
                lists = _token_lists(tokens, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, pa.array(np.diff(offsets).astype(np.int32)), pa.array(exact, pa.bool_())], names=["doc_id", "token_ids", "n_tokens", "exact"])

    name = ship(docs.sparkSession, vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = rows.mapInArrow(run, "doc_id long, token_ids array<int>, n_tokens int, exact boolean")
    known = F.col("exact").isNotNull()
    return got.select("doc_id", F.when(known, F.col("token_ids")).alias("token_ids"), F.when(known, F.col("n_tokens")).alias("n_tokens"), "exact")
