"""Words, shingles and hashes of whole batches of texts at once, in numpy.

Work is cut into slices of some hundred kilobytes, and a longer text into parts at white space, so
memory follows the slice: about 8 bytes a word of the longest text, and 50 a byte of its longest word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SLICE_BYTES = 1 << 18
SLICE_TEXTS = 1 << 12
TOKEN_BITS = 52  # bits of a set's token; the others number the texts of a slice
BLANK = re.compile(rb"[\x20\x09-\x0D]")
_IS_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.arange(1, 257, dtype=np.uint64)
_LETTER[65:91] += np.uint64(32)  # A-Z count as a-z


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(33))
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ... n-1; those of a few slices' length are kept."""
    if len(kept := _KEPT.get(int(base), ())) >= n:
        return kept[:n]
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    out = np.multiply.accumulate(out)
    if n <= 4 * SLICE_BYTES:
        _KEPT[int(base)] = out
    return out


def prefix_sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about a slice, cut at white space."""
    at = 0
    while len(text) - at > SLICE_BYTES and (cut := BLANK.search(text, at + SLICE_BYTES)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words begin (one more at the end).

    Words are runs of bytes other than ASCII white space; A-Z count as a-z.
    """
    if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES and BLANK.search(texts[0], SLICE_BYTES):
        h = np.concatenate([word_hashes([p])[0] for p in _parts(texts[0])])
        return h, np.array([0, len(h)], np.int64)
    joined = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
    blank = _IS_BLANK[joined]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1  # the first byte is blank, so words begin and end in turn
    starts, stops = edge[::2], edge[1::2]
    value = _LETTER[joined]
    value *= _powers(_ODD, len(joined))
    total = prefix_sums(value)
    h = mixed((total[stops] - total[starts]) * _powers(_INV, len(joined))[starts] + (stops - starts).astype(np.uint64))
    return h, np.concatenate(([0], np.searchsorted(starts, ends))).astype(np.int64)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within each text, in order, and where each text's begin.

    A text of fewer words, but one at least, has one shingle: all of them.
    """
    n = np.diff(first)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(counts)))
    factors = [mixed(np.full(1, k + 1, np.uint64))[0] | np.uint64(1) for k in range(size)]
    m = max(len(words) - size + 1, 0)
    total = np.zeros(m, np.uint64)
    for k in range(size):
        total += words[k : k + m] * factors[k]
    ends = np.repeat(first[1:], n)
    out = mixed(total[np.arange(m) + size <= ends[:m]])
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        short = n[few].astype(np.uint64) * _ODD
        for k in range(size - 1):
            has = n[few] > k
            short[has] += words[first[few[has]] + k] * factors[k]
        whole = np.empty(begin[-1], np.uint64)
        rest = np.ones(len(whole), bool)
        rest[begin[few]] = False
        whole[rest], whole[begin[few]] = out, mixed(short)
        out = whole
    return out, begin


def distinct(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct tokens (the hashes' upper TOKEN_BITS), sorted, and where they begin.

    Text and token share a word, so one plain sort does; at most SLICE_TEXTS texts.
    """
    n = len(begin) - 1
    bits = np.uint64(TOKEN_BITS)
    key = hashes >> np.uint64(64 - TOKEN_BITS)
    key |= np.repeat(np.arange(n, dtype=np.uint64) << bits, np.diff(begin))
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    at = np.searchsorted(key, np.arange(1, n, dtype=np.uint64) << bits) if n > 1 else np.zeros(0, np.int64)
    return key & np.uint64((1 << TOKEN_BITS) - 1), np.concatenate(([0], at, [len(key)] if n else [])).astype(np.int64)


def batches_of_bytes(lengths: Sequence[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes, SLICE_TEXTS at most; a longer text is alone in its range."""
    at = size = 0
    for i, n in enumerate(lengths):
        if i > at and (size + n > limit or i - at == SLICE_TEXTS):
            yield at, i
            at, size = i, 0
        size += n + 1
    if at < len(lengths):
        yield at, len(lengths)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bytes_in(some: bytes) -> np.ndarray:
    """For each byte whether it is one of these."""
    return np.isin(np.arange(256), list(some))


def _blocks(texts: list[bytes], gaps: np.ndarray) -> Iterator[tuple[bytes, list[int]]]:
    """The texts in blocks of about a slice, and where in the block texts begin. A longer text is cut at gaps.

    A line feed stands before each text, and a blank where one goes on.
    """
    held: list[bytes] = []
    size = 0

    def together() -> tuple[bytes, list[int]]:
        return b"\n" + b"\n".join(held) + b"\n", np.concatenate(([0], np.cumsum([len(t) + 1 for t in held[:-1]], dtype=np.int64))).tolist()

    for t in texts:
        if held and size + len(t) > SLICE_BYTES:
            yield together()
            held, size = [], 0
        if len(t) <= 2 * SLICE_BYTES:
            held.append(t)
            size += len(t) + 1
            continue
        ends = np.flatnonzero(gaps[np.frombuffer(t, np.uint8)])
        at = 0
        while at < len(t):
            k = np.searchsorted(ends, at + SLICE_BYTES)
            cut = int(ends[k]) if k < len(ends) else len(t)
            yield (b" " if at else b"\n") + t[at:cut] + b" ", [] if at else [0]
            at = cut
    if held:
        yield together()


class Words:
    """All words of some texts in order, A-Z as a-z: hashes, bytes, the pieces they are in, and each text's first.

    gaps: the bytes between words, line feed and blank among them; breaks: those of them that end a
    piece, line feed among them if there are any. Without breaks, a piece isn't told.
    """

    def __init__(self, texts: list[bytes], gaps: np.ndarray, breaks: np.ndarray | None = None, seed: int = 0):
        whole, hashes, starts, stops, pieces, begins = [], [], [], [], [], []
        at = piece = 0
        for block, texts_at in _blocks(texts, gaps):
            data = np.frombuffer(block, np.uint8)
            gap = gaps[data]
            edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1  # both ends are gaps, so words begin and end in turn
            start, stop = edge[::2], edge[1::2]
            value = _LETTER[data]
            value *= _powers(_ODD, len(data))
            total = prefix_sums(value)
            hashes.append(mixed((total[stop] - total[start]) * _powers(_INV, len(data))[start] + (stop - start).astype(np.uint64) + np.uint64(seed)))
            if breaks is not None:
                ended = np.cumsum(breaks[data])
                pieces.append(ended[start] + piece)
                piece += int(ended[-1])
            starts.append(start + at)
            stops.append(stop + at)
            begins.extend(x + at for x in texts_at)
            whole.append(_LOWER[data])
            at += len(data)
        joined = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.data, self.hashes, self.pieces = joined(whole, np.uint8), joined(hashes, np.uint64), joined(pieces, np.int64)
        self.starts, self.stops = joined(starts, np.int64), joined(stops, np.int64)
        self.first = np.append(np.searchsorted(self.starts, np.array(begins, np.int64)), len(self.starts))

    def strings(self, at: np.ndarray) -> pa.Array:
        """The words at these places of the order."""
        sizes = self.stops[at] - self.starts[at]
        offsets = prefix_sums(sizes)
        chars = self.data[np.repeat(self.starts[at] - offsets[:-1], sizes) + np.arange(offsets[-1])]
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(chars))

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of `size` words that begin at these places, joined by blanks."""
        parts = [self.strings(at + k) for k in range(size)]
        return parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")
