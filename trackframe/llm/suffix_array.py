"""Suffix arrays of number sequences by prefix doubling, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def pair_order(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The order by two numbers below ``2^bits``; one sort of packed integers where they fit."""
    index = max(len(first) - 1, 1).bit_length()
    if 2 * bits + index <= 63:
        packed = (first << (bits + index)) | (second << index) | np.arange(len(first))
        packed.sort()
        return packed & ((1 << index) - 1)
    return np.lexsort((second, first))


def doublings(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names by the first symbol, then by the first 2, 4, 8, ... symbols, until all suffixes differ.

    A name is where the suffixes that begin alike start in the suffix array. With the names come the
    places that shared a name in the round before, in their new order, and how many share it now. The
    last symbol, and any that should end a comparison, must occur once.
    """
    bits = max(len(symbols), 1).bit_length()
    counts = np.bincount(symbols)
    name = (np.cumsum(counts) - counts)[symbols]
    active, width = np.flatnonzero(counts[symbols] > 1), 1
    yield name, active, counts[symbols[active]]
    while len(active):
        order = pair_order(name[active], name[active + width], bits)
        places = active[order]
        first, second = name[places], name[places + width]
        new_first = np.concatenate([[True], first[1:] != first[:-1]])
        new = new_first | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        start_first = np.flatnonzero(new_first)[np.cumsum(new_first) - 1]
        size = np.diff(np.append(at, len(places)))[group]
        name = name.copy()
        name[places] = first + at[group] - start_first
        yield name, places, size
        active, width = places[size > 1], 2 * width


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The places of all suffixes in their order."""
    name = np.zeros(0, np.int64)
    for name, _, _ in doublings(symbols):
        pass
    array = np.empty(len(symbols), np.int64)
    array[name] = np.arange(len(symbols))
    return array
