"""Vectorised work on UTF-8 bytes of Arrow string columns, for use inside tasks.

Texts are handled as one byte array with offsets. Words are maximal runs of word bytes; their
64-bit fingerprints come from prefix sums of a polynomial over the bytes, so no Python string
is made. Work goes in pieces of a quarter of a megabyte, cut between texts, or between words of a
longer text, so memory follows the piece and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64

#: Byte tables: A-Z lowered; bytes of words cut at ASCII white space; bytes of alphanumeric words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, base, U64))]) if n > 1 else np.ones(n, U64)


_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, modulo 2**64, for i < n at least."""
    if not _tables:
        _tables.update(up=_powers(BASE, PIECE * 4), down=_powers(_INVERSE, PIECE * 4))
    if n > len(_tables["up"]):
        if n > PIECE * 16:  # one very long word
            return _powers(BASE, n), _powers(_INVERSE, n)
        _tables.update(up=_powers(BASE, n), down=_powers(_INVERSE, n))
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); a bijection."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offs


def pieces(offs: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or one longer text."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _words(
    d: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, head: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, start and end of each word of lowered bytes; texts begin at ``bounds``.

    With ``head`` the fingerprint is that of the word's first bytes, and differs from a word's.
    """
    w = is_word[d]
    cut = bounds[(bounds > 0) & (bounds < len(d))]
    first = w.copy()
    first[1:] &= ~w[:-1]
    first[cut] = w[cut]
    last = w.copy()
    last[:-1] &= ~w[1:]
    last[cut - 1] = w[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if head:
        end = np.minimum(end, start + head)
    up, down = powers(len(d) + 1)
    sums = np.zeros(len(d) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum((d.astype(U64) + U64(1)) * up[: len(d)], out=sums[1:])
        h = (sums[end] - sums[start]) * down[start]
        return mix(h + (end - start + (head << 32)).astype(U64) * U64(0xD6E8FEB86659FD93)), start, end


def word_pieces(column: pa.Array, is_word: np.ndarray, head: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first text, past text, word fingerprints, word offsets by text).

    A text longer than a piece is cut between words inside and comes back as one range of its own.
    """
    data, offs = buffers(column)
    for i, j in pieces(offs):
        if offs[j] - offs[i] <= PIECE:
            d = LOWER[data[offs[i] : offs[j]]]
            if not len(d):
                yield i, j, np.zeros(0, U64), np.zeros(j - i + 1, np.int64)
                continue
            rel = offs[i : j + 1] - offs[i]
            h, start, _ = _words(d, rel[1:-1], is_word, head)
            yield i, j, h, np.searchsorted(start, rel)
            continue
        parts, a, stop = [], int(offs[i]), int(offs[j])
        while a < stop:
            b = min(a + PIECE, stop)
            while b < stop and is_word[LOWER[data[b]]] and is_word[LOWER[data[b - 1]]]:
                after = np.flatnonzero(~is_word[LOWER[data[b : b + PIECE]]])
                b = b + int(after[0]) if len(after) else min(b + PIECE, stop)
            parts.append(_words(LOWER[data[a:b]], np.zeros(0, np.int64), is_word, head)[0])
            a = b
        h = np.concatenate(parts)
        yield i, j, h, np.array([0, len(h)])


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of all runs of ``size`` words; shorter sequences give one for the whole."""
    k = min(size, len(h))
    if not k:
        return np.zeros(0, U64)
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for i in range(1, k):
            out *= BASE
            out += h[i : i + n]
        return mix(out + U64(k))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
