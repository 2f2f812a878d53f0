"""Word-shingle sets of whole texts as sorted arrays of 64-bit hashes, computed on raw UTF-8 bytes in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed by one pass over arrays; a longer text is a pass of its own.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A number for each byte; A-Z count as a-z, and white space as nothing.
BYTE = stream(1 << 20, 256)
BYTE[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]
BYTE[SPACE] = 0


def text_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The bytes of consecutive texts: the first text's number, the bytes, and where each text starts and the last ends."""
    column = column.cast(pa.large_string()) if isinstance(column, pa.StringArray) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_BYTES, side="right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of the text it is in."""
    if not len(raw):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    blank = SPACE[raw]
    begins = ~blank
    begins[1:] &= blank[:-1]
    edges = at[:-1][at[:-1] < len(raw)]
    begins[edges] = ~blank[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    spans = np.diff(np.append(starts, len(raw)))
    place = np.arange(len(raw) - starts[0]) - np.repeat(starts - starts[0], spans)
    weighted = BYTE[raw[starts[0] :]] * stream(2 << 20, int(spans.max()))[place]
    owner = np.searchsorted(at, starts, side="right") - 1
    return mix(np.add.reduceat(weighted, starts - starts[0])), owner


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per block of texts: the first text's number, the set size of each text, and all sets one after the other.

    A set is sorted and without repeats.  A text with fewer than ``size``
    words is one shingle of all its words; a text without words has none.
    """
    factors = stream(3 << 20, size)
    for first, raw, at in text_blocks(column):
        texts = len(at) - 1
        words, owner = word_hashes(raw, at)
        count = np.bincount(owner, minlength=texts)
        full = len(words) - size + 1
        tokens, whose = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        if full > 0:
            tokens = words[:full] * factors[0]
            for k in range(1, size):
                tokens = tokens + words[k : full + k] * factors[k]
            inside = owner[:full] == owner[size - 1 :]
            tokens, whose = mix(tokens[inside]), owner[:full][inside]
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):
            begin = np.cumsum(count) - count
            extra = [
                (words[begin[t] : begin[t] + count[t]] * factors[: count[t]]).sum(dtype=np.uint64) + np.uint64(count[t])
                for t in short
            ]
            tokens, whose = np.append(tokens, mix(np.array(extra, dtype=np.uint64))), np.append(whose, short)
            order = np.argsort(whose, kind="stable")
            tokens, whose = tokens[order], whose[order]
        ends = np.cumsum(np.bincount(whose, minlength=texts))
        for begin, end in zip(np.concatenate([[0], ends[:-1]]), ends):
            if end - begin > 1:
                tokens[begin:end].sort()
        kept = np.ones(len(tokens), dtype=bool)
        kept[1:] = (tokens[1:] != tokens[:-1]) | (whose[1:] != whose[:-1])
        yield first, np.bincount(whose[kept], minlength=texts), tokens[kept]


def set_hashes(sizes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """One 64-bit hash per set; 0 for an empty one."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = sizes > 0
    if full.any():
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full] = mix(np.add.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), starts) + sizes[full].astype(np.uint64))
    return out
