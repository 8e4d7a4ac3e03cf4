"""Words, lines and characters of a batch of texts, counted in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` on UTF-8, which is what splitting bytes at ASCII white space gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from trackframe.llm.common import text_bytes

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BATCH = 512


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of every text's part of a byte-wise count."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside ``width``-word windows that occur at least twice in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    key = ids[:n]
    for k in range(1, width):
        key = key * len(number) + ids[k : n + k]
        if k < width - 1 and len(number) > 1_000_000:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def dup_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    worded = [x for x in lines if x.strip()]
    return len(worded) - len(set(worded))


class TextBatch:
    """Some texts of one Arrow batch with counts that need one pass over their bytes."""

    def __init__(self, column: pa.Array):
        self.data, self.starts = text_bytes(column)
        whole = self.data.tobytes()
        self.raw = [whole[a:b] for a, b in zip(self.starts[:-1].tolist(), self.starts[1:].tolist())]
        space = SPACES[self.data]
        self.points = sums((self.data & 0xC0) != 0x80, self.starts)
        self.word_chars = self.points - sums(space, self.starts)
        self.symbols = sums(SYMBOLS[self.data], self.starts)


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
