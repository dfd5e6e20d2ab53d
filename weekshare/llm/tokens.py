"""Words and shingles of many texts at once, on numpy arrays.

A batch of texts is one byte buffer with offsets (the Arrow layout). Words are
found by a table over bytes, hashed eight bytes at a time, and never become
Python objects. Hashes are 64 bits wide and depend only on the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from .common import plain_texts

# The word separators [\x20\x09-\x0D].
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Letters: A-Z, a-z and every byte of a multi-byte character.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_WORD = _LETTER.copy()
_WORD[0x30:0x3A] = True
_KINDS = {"space": _NOT_SPACE, "letters": _LETTER, "alnum": _WORD}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG_WORD = 256            # bytes; longer words are hashed one by one


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column; null is empty."""
    column = plain_texts(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) \
        if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2] if len(column) else None
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None and body.size \
        else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, kind: str = "space"):
    """``(start, length, text number)`` of every word: runs without white
    space, of letters, or of letters and digits. Words never cross texts."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = _KINDS[kind][data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1 - start, np.searchsorted(offsets, start, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


def hash_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at = 0
    left = np.flatnonzero(length <= _LONG_WORD)
    while len(left):
        rest = length[left] - at
        part = eight[start[left] + at] & _LOW_BYTES[np.minimum(rest, 8)]
        h[left] = mix(h[left] ^ part)
        at += 8
        left = left[rest > 8]
    for i in np.flatnonzero(length > _LONG_WORD):
        body = data[start[i]:start[i] + length[i]].tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(body, digest_size=8).digest(), np.uint64)[0]
    return h


def word_hashes(column: pa.Array, kind: str = "space", lower: bool = True):
    """``(hash, text number)`` of every word of the texts, in order."""
    data, offsets = flat(column)
    if lower:
        data = lowered(data)
    start, length, text = split(data, offsets, kind)
    return hash_words(data, start, length), text


def shingles(words: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, text number)`` of every run of ``k`` words; a text with fewer
    words (one at least) has its whole sequence as one."""
    if not len(words):
        return words, text
    n = len(words)
    counts = np.bincount(text)
    s = words.copy()
    for j in range(1, min(k, n)):
        s[:n - j] = mix(s[:n - j] + np.uint64(j)) + words[j:]
    whole = np.zeros(n, bool)
    whole[:max(0, n - k + 1)] = text[k - 1:] == text[:n - k + 1] if n >= k else False
    out, of = s[whole], text[whole]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        first = np.searchsorted(text, few)
        seq = words[first].copy()
        for j in range(1, k - 1):
            more = counts[few] > j
            seq[more] = mix(seq[more] + np.uint64(j)) + words[first[more] + j]
        out = np.concatenate([out, mix(seq ^ np.uint64(0xA5A5) ^ counts[few].astype(np.uint64))])
        of = np.concatenate([of, few])
    return mix(out), of


def distinct_per_text(hashes: np.ndarray, text: np.ndarray, n_texts: int):
    """Sorted distinct hashes per text: ``(hashes, offsets)``."""
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    h, t = h[keep], t[keep]
    return h, np.searchsorted(t, np.arange(n_texts + 1))
