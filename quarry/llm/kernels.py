"""Vectorised text kernels over Arrow string buffers, used inside Spark tasks.

A batch of texts is one byte buffer with offsets; words, their 64-bit hashes and 5-word
shingles come out as flat numpy arrays, so no Python object is made per word.  Work goes in
slices of about ``SLICE`` bytes, which bounds memory whatever a batch or a single text holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is cut at white space (see ``words``).
SLICE = 1 << 19

#: Numbers handled at once where many steps follow each other, so that they stay in cache.
PIECE = 1 << 14

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


class Alphabet(NamedTuple):
    """What separates words, and the number each byte counts as in a word's hash."""

    space: np.ndarray
    byte: np.ndarray


#: Words between white space (0x20, 0x09-0x0D); A-Z as a-z.
PLAIN = Alphabet(_SPACE, _BYTE)
_other = np.ones(256, bool)
_other[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: Words of letters and digits (and all of a multi-byte character); A-Z as a-z, and the second bytes
#: of U+00C0-U+00DE as those of their small letters.
_folded = _BYTE.copy()
_folded[0x80:0x9F] = _folded[0xA0:0xBF]
LETTERS = Alphabet(_other, _folded)
_masked = _folded.copy()
_masked[48:58] = _masked[48]
#: The same, all digits alike.
MASKED = Alphabet(_other, _masked)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * SLICE)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, U64(base))
            table[0] = 1
            _powers[key] = np.cumprod(table)
    return _powers["up"][:n], _powers["down"][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit`` bytes."""
    buf, offsets = text_buffer(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _piece_words(buf: np.ndarray, cuts: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in one piece; ``cuts``: where a new text begins."""
    n = len(buf)
    word = ~alphabet.space[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    if len(cuts):
        first[cuts] |= word[cuts]
        before = cuts[cuts > 0] - 1
        last[before] |= word[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, U64)
    up, down = _power_tables(n)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(alphabet.byte[buf] * up, out=total[1:])
    return starts, ends, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def words(buf: np.ndarray, offsets: np.ndarray, alphabet: Alphabet = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words; a slice longer than ``SLICE`` is cut between words."""
    parts, at, n = [], 0, len(buf)
    while at < n:
        end = min(n, at + SLICE)
        while end < n:
            space = np.flatnonzero(alphabet.space[buf[end : end + SLICE]])
            end = end + int(space[0]) if len(space) else min(n, end + SLICE)
            if len(space):
                break
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        s, e, h = _piece_words(buf[at:end], np.unique(inside), alphabet)
        parts.append((s + at, e + at, h))
        at = end
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def word_hashes(buf: np.ndarray, offsets: np.ndarray, alphabet: Alphabet = PLAIN) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the word offsets of each text."""
    starts, _, hashes = words(buf, offsets, alphabet)
    return hashes, np.searchsorted(starts, offsets)


def run_hashes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash for each run of hashes [offsets[i], offsets[i + 1]), order included; 0 if empty."""
    if not len(hashes):
        return np.zeros(len(offsets) - 1, U64)
    up, down = _power_tables(len(hashes) + 1)
    total = np.concatenate([[U64(0)], np.cumsum(hashes * up[:-1])])
    sizes = np.diff(offsets)
    return np.where(sizes > 0, mix((total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]] + sizes.astype(U64)), U64(0))


_RUN = [U64(int(x) | 1) for x in _rng.integers(1 << 62, 1 << 63, 64, dtype=np.uint64)]


def windows(hashes: np.ndarray, word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside a text, and the first word of each run."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = np.zeros(n, U64)
    for k in range(size):
        out += hashes[k : k + n] * _RUN[k]
        out ^= out >> U64(29)
    text_end = np.repeat(word_offsets[1:], np.diff(word_offsets))[:n]
    at = np.flatnonzero(np.arange(n) + size <= text_end)
    return mix(out[at]), at


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, flat, with offsets.  A text with fewer than
    ``size`` words is one shingle of all its words; without words the set is empty."""
    hashes, spans = word_hashes(buf, offsets)
    grams, at = windows(hashes, spans, size)
    cut = np.searchsorted(at, spans)
    sets = []
    for i in range(len(offsets) - 1):
        a, b = spans[i], spans[i + 1]
        if b - a >= size:
            sets.append(np.unique(grams[cut[i] : cut[i + 1]]))
        elif b > a:
            whole = U64(b - a)
            with np.errstate(over="ignore"):
                for k in range(a, b):
                    whole = mix(np.array([whole * _RUN[8] + hashes[k]], U64))[0]
            sets.append(np.array([whole], U64))
        else:
            sets.append(np.zeros(0, U64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.concatenate([[0], np.cumsum(sizes)])


class MinHash:
    """``k`` independent minima over a set of 64-bit hashes, 32 bits each."""

    def __init__(self, k: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 63, k, dtype=np.uint64) * U64(2)
        self.scale = rng.integers(0, 1 << 63, k, dtype=np.uint64) * U64(2) + U64(1)

    def __call__(self, members: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, k) uint32 minima; the row of an empty set is all ones."""
        out = np.full((len(offsets) - 1, len(self.scale)), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(np.diff(offsets))
        step = 1 << 16  # keeps the working arrays in cache
        group: list[int] = []
        for i, row in enumerate(full):
            group.append(row)
            a, b = offsets[group[0]], offsets[group[-1] + 1]
            if b - a >= step or i == len(full) - 1:
                part, where = members[a:b], offsets[group] - a
                for k, (x, m) in enumerate(zip(self.flip, self.scale, strict=True)):
                    out[group, k] = np.minimum.reduceat(((part ^ x) * m) >> U64(32), where).astype(np.uint32)
                group = []
        return out


class PartMinHash:
    """Minima of ``k`` functions in ``bins`` parts of their range each, 32 bits: a member counts in one part of
    each function, so all ``bins * k`` minima take ``k`` hashes of it and not ``bins * k``.

    An empty part takes the minimum of the next one that is not, altered by the distance."""

    def __init__(self, bins: int, k: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bins, self.flip = bins, rng.integers(0, 1 << 63, k, dtype=np.uint64) * U64(2)
        self.scale = rng.integers(0, 1 << 63, k, dtype=np.uint64) * U64(2) + U64(1)

    def __call__(self, members: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, bins * k) uint32 minima, those of a part side by side; the row of an empty set is all ones.
        The members are well mixed hashes."""
        n, none = len(offsets) - 1, np.uint32(0xFFFFFFFF)
        out = np.full((len(self.flip), n * self.bins), none)
        base = np.repeat(np.arange(n, dtype=np.int64) * self.bins, np.diff(offsets))
        for i in range(0, len(members), PIECE):
            part, at = members[i : i + PIECE], base[i : i + PIECE]
            for low, x, m in zip(out, self.flip, self.scale, strict=True):
                h = (part ^ x) * m
                bin_of = ((h >> U64(32)) * U64(self.bins) >> U64(32)).view(np.int64)
                np.minimum.at(low, at + bin_of, (h >> U64(16)).astype(np.uint32))
        whole = out.reshape(len(self.flip), n, self.bins).transpose(1, 2, 0).copy()
        given = whole.copy()
        for step in range(1, self.bins):
            row, part, f = np.nonzero(whole == none)
            if not len(row):
                break
            other = given[row, (part + step) % self.bins, f]
            moved = (mix(other.astype(np.uint64) + U64(step << 32)) >> U64(33)).astype(np.uint32)
            whole[row, part, f] = np.where(other == none, none, moved)
        return whole.reshape(n, -1)


def word_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words (runs of bytes other than 0x20, 0x09-0x0D) of each text."""
    word = ~_SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(buf)]
    first[cuts] = word[cuts]
    return np.diff(np.searchsorted(np.flatnonzero(first), offsets)).astype(np.int64)
