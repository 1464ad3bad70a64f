"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A round first names every maximal run of one symbol, then splits the symbols
into left and right ones and names every adjacent (left, right) pair. A name is
a fingerprint of what it stands for, and the side of a symbol is a bit of its
name and the round. So all tasks give the same name to the same content without
a table of names, and equal substrings get equal symbols inside, whatever stands
around them.

What stands around a substring can change symbols near its ends only. Every
symbol therefore carries its *context*: the words [lo, hi) that force it. A
substring that holds the context of a symbol has that symbol wherever it occurs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from partflow.llm.words import U64, join, mix

#: A context that reaches over the end of a text; no substring holds it.
FAR = np.int64(1) << 40


class Symbols(NamedTuple):
    """Symbols of a batch of texts in order; ``lo`` and ``hi`` count words."""

    name: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray


def words_as_symbols(hashes: np.ndarray, doc: np.ndarray) -> Symbols:
    at = np.arange(len(hashes), dtype=np.int64)
    return Symbols(hashes, at, at + 1, doc)


def _neighbours(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Where the context of the symbol before begins, and of the one after ends."""
    before, after = np.full(len(s.lo), -FAR), np.full(len(s.hi), FAR)
    same = s.doc[1:] == s.doc[:-1]
    before[1:][same] = s.lo[:-1][same]
    after[:-1][same] = s.hi[1:][same]
    return before, after


def name_runs(s: Symbols) -> Symbols:
    """One symbol for every maximal run of equal symbols.

    A symbol that stands alone needs its neighbours as context only as far as
    they show that it is alone; a run needs both, as they end it.
    """
    n = len(s.name)
    if not n:
        return s
    new = np.ones(n, bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])
    first = np.flatnonzero(new)
    size = np.diff(first, append=n)
    last = first + size - 1
    before, after = _neighbours(s)
    name = np.where(size > 1, join(s.name[first], size.astype(U64)), s.name[first])
    return Symbols(name, before[first], after[last], s.doc[first])


def name_pairs(s: Symbols, round_: int) -> Symbols:
    """One symbol for every adjacent (left, right) pair; they never overlap.

    A pair is forced by its two symbols alone, a left symbol that stays by the
    one after it, a right one by the one before.
    """
    n = len(s.name)
    if n < 2:
        return s
    left = (mix(s.name + U64(round_)) & U64(1)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = left[:-1] & ~left[1:] & (s.doc[1:] == s.doc[:-1])
    before, after = _neighbours(s)
    lo, hi = np.where(left, s.lo, before), np.where(left, after, s.hi)
    nxt = np.flatnonzero(pair) + 1
    name = s.name.copy()
    name[nxt - 1] = join(s.name[nxt - 1], s.name[nxt])
    lo[nxt - 1], hi[nxt - 1] = s.lo[nxt - 1], s.hi[nxt]
    keep = np.ones(n, bool)
    keep[nxt] = False
    return Symbols(name[keep], lo[keep], hi[keep], s.doc[keep])


def recompress(hashes: np.ndarray, doc: np.ndarray, rounds: int, run_rounds: int = 1) -> Symbols:
    """The symbols after ``rounds`` rounds; runs are named in the first ``run_rounds``."""
    s = words_as_symbols(hashes, doc)
    for k in range(rounds):
        if k < run_rounds:
            s = name_runs(s)
        s = name_pairs(s, k)
    return s
