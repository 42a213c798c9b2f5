"""Numpy helpers for many short strings held in one flat array."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(0, U64), np.ones(0, U64)]

#: Classes of characters.
OTHER, LETTER, NUMBER, SPACE, EDGE = 0, 1, 2, 3, 4
_SPACES = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point, one entry more for the mark between documents."""
    global _classes
    if _classes is None:
        table = np.zeros(0x110001, np.uint8)
        major = {"L": LETTER, "N": NUMBER}
        for cp in range(0x110000):
            if kind := major.get(unicodedata.category(chr(cp))[0]):
                table[cp] = kind
        table[[ord(c) for c in _SPACES]] = SPACE
        table[0x110000] = EDGE
        _classes = table
    return _classes


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers modulo 2**64 of an odd base, and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, U64(base))
            steps[0] = U64(1)
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, each text followed by the mark 0x110000, and where each text starts (one entry more)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    cps = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    cps[starts[1:] - 1] = 0x110000
    return cps, starts


def word_spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for ascending spans that don't overlap."""
    if not len(starts):
        return np.zeros(0, U64)
    forward, backward = powers(len(values) + 1)
    terms = mix64(values.astype(U64) + U64(0x632BE59BD9B4E019)) * forward[: len(values)]
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(terms, dtype=U64)])
    return mix64((sums[ends] - sums[starts]) * backward[starts] + (ends - starts).astype(U64))


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every span, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def slices_of(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that together hold about so many characters; a longer row comes alone."""
    begin, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n + 1
    if begin < len(lengths):
        yield begin, len(lengths)


_AFTER_WORD = re.compile(r"\W")
_BLANK_IN_SENTENCE = re.compile(r"(?<=\w) (?=\w)")


def cut_text(text: str, size: int, where: re.Pattern = _AFTER_WORD) -> Iterator[str]:
    """The whole text in parts of about `size` characters, cut only where no word goes on.

    A part may be longer where no such place follows; together the parts are the text.
    """
    begin = 0
    while len(text) - begin > size and (found := where.search(text, begin + size)) and found.start() > begin:
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def cut_sentence(text: str, size: int) -> Iterator[str]:
    """The same, cut only before a single blank between two words."""
    return cut_text(text, size, _BLANK_IN_SENTENCE)
