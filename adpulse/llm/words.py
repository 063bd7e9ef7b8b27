"""Words of whole texts as 64-bit hashes, in numpy, for use inside Arrow tasks.

A word is a run of bytes other than space and the five ASCII controls 0x09-0x0D. The hash of a
word depends on its bytes alone, so it is the same in every task, run and machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes that are hashed at once; a longer text is hashed in pieces.
PIECE = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = (np.uint64(30), np.uint64(27), np.uint64(31))
_MULTIPLIERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (the splitmix64 finaliser)."""
    x = (x ^ (x >> _SHIFTS[0])) * _MULTIPLIERS[0]
    x = (x ^ (x >> _SHIFTS[1])) * _MULTIPLIERS[1]
    return x ^ (x >> _SHIFTS[2])


def sequence(n: int, seed: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    start = np.full(1, seed, np.uint64) * np.uint64(0x632BE59BD9B4E019)
    return mix((np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN) + start)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[0x0A] = True
_BYTE = sequence(256)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0xD6E8FEB86659FD93)


class Block(NamedTuple):
    """Some consecutive texts: ``first`` is the index of the first one, words of text ``k`` are
    ``hashes[bounds[k]:bounds[k + 1]]``, its bytes ``raw[cuts[k]:cuts[k + 1]]``; each word starts
    at its ``starts`` in ``raw``."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray
    raw: np.ndarray
    cuts: np.ndarray
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word, counted from the first of the block."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row and where each text starts (and the last one ends).
    Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def _hash_piece(
    raw: np.ndarray, cuts: np.ndarray, gap: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of bytes that are no gap, and where each run starts. No run crosses a
    cut."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    between = gap[raw]
    opens = np.empty(len(raw), bool)
    opens[0] = True
    opens[1:] = between[:-1]
    opens[cuts[cuts < len(raw)]] = True
    opens &= ~between
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    place = _places(len(raw), starts)
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = np.uint64(1)
    powers = np.cumprod(powers)
    sums = np.add.reduceat(np.where(between, np.uint64(0), _BYTE[raw] * powers[place]), starts)
    return mix(sums ^ _GOLDEN), starts


def _places(n: int, starts: np.ndarray) -> np.ndarray:
    """Distance of each byte from the start of the word before it; 0 before the first word."""
    place = np.arange(n)
    place[: starts[0]] = 0
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, n)))
    return place


def blocks(texts: pa.Array, lower: bool = False) -> Iterator[Block]:
    """The words of all texts, a block of about PIECE bytes at a time; a text is never split
    over two blocks."""
    raw, starts = utf8(texts)
    first = 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), len(starts) - 1)
        part = raw[starts[first] : starts[last]]
        cuts = starts[first : last + 1] - starts[first]
        hashes, at = [], []
        for low, high in _pieces(part, _IS_SPACE):
            inner = cuts[(cuts >= low) & (cuts < high)] - low
            piece = _LOWER[part[low:high]] if lower else part[low:high]
            h, s = _hash_piece(piece, inner)
            hashes.append(h)
            at.append(s + low)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        places = np.concatenate(at) if at else np.zeros(0, np.int64)
        yield Block(first, words, np.searchsorted(places, cuts), part, cuts, places)
        first = last


def _pieces(raw: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE bytes that together cover all bytes and cut no run."""
    low = 0
    while low < len(raw):
        high = min(low + PIECE, len(raw))
        while high < len(raw):
            gaps = np.flatnonzero(gap[raw[high : high + PIECE]])
            if len(gaps):
                high += int(gaps[0])
                break
            high = min(high + PIECE, len(raw))
        yield low, high
        low = high


def windows(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` words within one text, and the index of its first word."""
    total = len(block.hashes)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(total - n + 1)
    owner = block.owner
    at = at[owner[at] == owner[at + n - 1]]
    hashed = np.zeros(len(at), np.uint64)
    for k in range(n):
        hashed = mix(hashed * _BASE + block.hashes[at + k] + np.uint64(k))
    return hashed, at


def lines(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every line that has a word, and the text it is in."""
    hashes, owners = [], []
    for low, high in _pieces(block.raw, _IS_BREAK):
        raw = block.raw[low:high]
        cuts = block.cuts[(block.cuts >= low) & (block.cuts < high)] - low
        h, starts = _hash_piece(raw, cuts, _IS_BREAK)
        if len(h):
            worded = np.add.reduceat((~_IS_SPACE[raw]).astype(np.int64), starts) > 0
            hashes.append(h[worded])
            owners.append(np.searchsorted(block.cuts, starts[worded] + low, "right") - 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def count_bytes(block: Block, chosen: np.ndarray) -> np.ndarray:
    """How many bytes of each text are among the chosen ones (a table of 256 flags)."""
    sums = np.append(0, np.cumsum(chosen[block.raw], dtype=np.int64))
    return sums[block.cuts[1:]] - sums[block.cuts[:-1]]


def byte_set(members: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(members)] = True
    return flags


#: First bytes of characters that belong to words: neither spaces nor UTF-8 continuations.
WORD_CHARACTERS = ~_IS_SPACE & ~byte_set(bytes(range(0x80, 0xC0)))


def repeated(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: the value occurs twice or more in its text; it has occurred earlier in it."""
    order = np.lexsort((np.arange(len(hashed)), hashed, owner))
    h, o = hashed[order], owner[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    often, later = np.empty(len(h), bool), np.empty(len(h), bool)
    often[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return often, later


def word_counts(texts: pa.Array) -> pa.Array:
    """Number of words of each text, in one pass without hashing."""
    raw, starts = utf8(texts)
    counts = np.zeros(len(starts) - 1, np.int64)
    first = 0
    while first < len(counts):
        last = int(np.searchsorted(starts, starts[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), len(counts))
        part = raw[starts[first] : starts[last]]
        cuts = starts[first : last + 1] - starts[first]
        space = _IS_SPACE[part]
        opens = ~space
        opens[1:] &= space[:-1]
        heads = cuts[:-1][cuts[:-1] < cuts[1:]]
        opens[heads] = ~space[heads]
        sums = np.append(0, np.cumsum(opens, dtype=np.int64))
        counts[first:last] = sums[cuts[1:]] - sums[cuts[:-1]]
        first = last
    return pa.array(counts, pa.int64())
