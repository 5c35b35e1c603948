"""Coding of texts span by span: each distinct span (word, segment) is coded once and looked up after that.

Spans are told apart by 64-bit hashes of their bytes, so the texts of a batch are
coded without a Python object per span; only spans that are new to the task are
handed to ``learn`` as bytes.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np

from lakeops.llm.words import MULT, Hasher, mix

MAX_SPANS = 800_000  # distinct spans kept by a Python worker
RECENT = 50_000  # new spans kept apart before they are sorted into the others


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + sizes[i]] of all i, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place of each one, and which one each value is; ``np.unique`` pays for a stable sort to name the first place."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    where = np.empty(len(values), np.int64)
    where[order] = np.cumsum(new) - 1
    return ranked[new], order[new], where


class SpanCoder:
    """learn(bytes of the new spans, their sizes) -> (flat codes, number of codes of each span).

    ``lower``: spans that differ in the case of A-Z only have the same codes, but for those that hold ``exact``.
    """

    def __init__(self, learn: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], dtype=np.int32,
                 lower: bool = False, exact: bytes = b""):
        self.learn, self.dtype, self.exact = learn, dtype, exact
        self.hasher, self.plain = Hasher(lower), Hasher()
        self._clear()

    def _clear(self) -> None:
        # two sorted tables: the bulk, and the spans of late (small, so that adding to it is cheap)
        self.tables = [self._table(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.flat = np.zeros(0, self.dtype)
        self.n_codes = 0

    @staticmethod
    def _table(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        order = np.argsort(keys, kind="stable")
        return keys[order], starts[order], sizes[order]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, start, size) of each key."""
        known = np.zeros(len(keys), bool)
        start, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for have, starts, sizes in self.tables:
            if len(have):
                at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit = have[at] == keys
                known |= hit
                start[hit], size[hit] = starts[at[hit]], sizes[at[hit]]
        return known, start, size

    def _add(self, keys: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.n_codes + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
        self.n_codes += len(flat)
        bulk, late = self.tables
        late = tuple(np.concatenate(x) for x in zip(late, (keys, starts, sizes), strict=True))
        if len(late[0]) > RECENT:
            bulk, late = self._table(*(np.concatenate(x) for x in zip(bulk, late, strict=True))), tuple(x[:0] for x in late)
        self.tables = [bulk, self._table(*late)]

    def code(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, flat: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(flat codes of all spans in order, or none if not ``flat``; number of codes of each span)."""
        if not len(starts):
            return self.flat[:0], np.zeros(0, np.int64)
        h = self.hasher
        hashes = h.spans(h.prefix(h.table[data], MULT), starts, ends, MULT)
        if self.exact:
            found = data == self.exact[0]
            for i, c in enumerate(self.exact[1:], 1):
                found[:-i] &= data[i:] == c
                found[-i:] = False
            if found.any():
                own = np.unique(np.searchsorted(starts, np.flatnonzero(found), "right") - 1)
                plain = self.plain.prefix(self.plain.table[data], MULT)
                hashes[own] = self.plain.spans(plain, starts[own], ends[own], MULT) + np.uint64(0x632BE59BD9B4E019)
        keys, first, where = _distinct(mix(hashes))
        known, start, size = self._find(keys)
        if not known.all():
            if sum(len(t[0]) for t in self.tables) + np.count_nonzero(~known) > MAX_SPANS:
                self._clear()
                known[:] = False
            at = first[~known]
            s, n = starts[at], (ends - starts)[at]
            self._add(keys[~known], *self.learn(gather(data, s, n), n))
            _, start, size = self._find(keys)
        size = size[where]
        return gather(self.flat, start[where], size) if flat else self.flat[:0], size


def kept_in_worker(name: str, make: Callable[[], object]):
    """An object that a Python worker makes once and keeps for all of its tasks (vocabularies, caches)."""
    store = sys.modules.setdefault("_lakeops_llm_kept", types.ModuleType("_lakeops_llm_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]
