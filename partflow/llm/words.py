"""Words of whole texts as arrays: split, hash and window them a batch at a time.

All functions run inside tasks on one Arrow column of texts. A word is a run of
bytes of a given class; separators are ASCII, so UTF-8 bytes can be classed one
by one. Hashes are 64 bits wide and the same in every task; callers that need
more than a filter take two of them with different seeds.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SHIFTS = U64(32), U64(29)
_ODD_A, _ODD_B = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)


def byte_class(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words(NamedTuple):
    """Words of a batch in order: ``data[start:start + length]``, of text ``doc``."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray
    docs: int

    def first(self) -> np.ndarray:
        """Index of each text's first word, and the word count at the end."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, and where each begins; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words of every text; ``lower`` lower-cases A-Z only."""
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = word_bytes[data]
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        after = cuts[cuts < n]
        begins[after] = inside[after]
        before = cuts[cuts > 0] - 1
        ends[before] = inside[before]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, length, doc, len(texts))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFTS[0])) * _ODD_A
    x = (x ^ (x >> _SHIFTS[1])) * _ODD_B
    return x ^ (x >> _SHIFTS[0])


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in this order."""
    return mix(a * _ODD_B + b)


def hash_words(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word, eight bytes at a step."""
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(words.data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    out = mix(words.length.astype(U64) + U64(0x9E3779B97F4A7C15 + seed * 0x1000003D))
    at = np.arange(len(words.start))
    step = 0
    while len(at):
        left = words.length[at] - step
        chunk = eight[words.start[at] + step] & _MASKS[np.minimum(left, 8)]
        out[at] = join(out[at], chunk)
        at, step = at[left > 8], step + 8
    return out


def hash_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive hashes, by doubling: ``len - size + 1`` values."""
    power, width, out, done = hashes, 1, None, 0
    while True:
        if size & width:
            tail = power[done:]
            out = tail if out is None else join(out[: len(tail)], tail)
            done += width
        if done == size:
            return out[: max(0, len(hashes) - size + 1)]
        power = join(power[: max(0, len(power) - width)], power[width:])
        width *= 2


def windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window that lies in one text."""
    out = hash_windows(hashes, size)
    at = np.flatnonzero(words.doc[: len(out)] == words.doc[size - 1 :][: len(out)])
    return out[at], at
