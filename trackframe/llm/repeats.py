"""Which windows of documents repeat an earlier one: shared by the line and the byte operator.

A window is a row ``k1, k2, doc, ver, pack``: 128 bits that stand for its content, the document, 64
bits of its text's hash, and :func:`packed` place and width. Earlier means a smaller document id, or
the same document and an earlier start; documents without an id come last. Rows that share an id (or
have none) are told apart by ``ver``, which decides between equal starts; rows of a table that repeat
both id and text are one document to this comparison.

Of one batch only the first window of each content competes under its own key. The others are
marked as repeated where they are found and are dealt out by their place, so a content that many
documents share reaches the shuffle once a batch and not once a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.llm.common import mixed, texts

#: Stands for a null id, after all others.
NO_ID = (1 << 63) - 1
ROWS = "k1 long, k2 long, doc long, ver long, pack long"
MARK = np.int64(1 << 23)
WIDEST = 127


def packed(start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Start (40 bits), a mark and width in windows (7 bits), in order of start."""
    return (start.astype(np.int64) << 24) | (width.astype(np.int64) << 16)


def unpacked(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pack >> 24, (pack >> 16) & WIDEST


def versioned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (id without nulls), ``ver`` (64 bits of the text's hash) and ``text`` of every row."""
    rows = texts(docs, id_col, text_col)
    return rows.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("ver"), "text"
    )


def rows_batch(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, ver: np.ndarray, pack: np.ndarray) -> pa.RecordBatch:
    """Windows of one batch: all but the first of each content are marked and dealt out by place."""
    order = np.lexsort((ver, pack, doc, k2, k1))
    k1, k2, doc, ver, pack = k1[order], k2[order], doc[order], ver[order], pack[order]
    same = np.concatenate([[False], (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])]) if len(k1) else np.zeros(0, bool)
    first = np.flatnonzero(~same)
    of = first[np.cumsum(~same) - 1] if len(k1) else first
    again = same & ((doc != doc[of]) | (ver != ver[of]) | (pack != pack[of]))
    k1, k2, pack = k1.copy(), k2.copy(), pack.copy()
    place = mixed((doc[again] ^ ver[again]) * np.int64(1_000_003) + (pack[again] >> 24)).view(np.int64)
    k1[again], k2[again] = place, pack[again]
    pack[again] |= MARK
    keep = ~same | again
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (k1, k2, doc, ver, pack)], ["k1", "k2", "doc", "ver", "pack"])


def repeated(windows: DataFrame, with_rivals: bool = False) -> DataFrame:
    """Windows that are not the first of their content: ``again`` (true), ``doc``, ``ver``, ``pack``.

    With ``with_rivals`` also, as ``again = false``, every first window whose ``k1`` (but not ``k2``)
    some other window shares. Rows are sorted within shuffle partitions and streamed: a group of any
    size needs memory for two rows.
    """
    rows = windows.repartition("k1").sortWithinPartitions("k1", "k2", "doc", "pack", "ver")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first window: k1, k2, doc, ver, pack, and whether it has a rival

        def out(again: np.ndarray, doc: np.ndarray, ver: np.ndarray, pack: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(again, pa.bool_()), *map(pa.array, (doc, ver, pack))], ["again", "doc", "ver", "pack"])

        for batch in batches:
            k1, k2, doc, ver, pack = (batch.column(i).to_numpy() for i in range(5))
            marked = (pack & MARK) != 0
            if marked.any():
                yield out(np.ones(marked.sum(), bool), doc[marked], ver[marked], pack[marked] & ~MARK)
                k1, k2, doc, ver, pack = k1[~marked], k2[~marked], doc[~marked], ver[~marked], pack[~marked]
            if not len(k1):
                continue
            if held is not None:
                k1, k2, doc, ver, pack = (np.concatenate([[np.int64(h)], x]) for h, x in zip(held[:5], (k1, k2, doc, ver, pack)))
            new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            first = np.flatnonzero(new)
            of = first[np.cumsum(new) - 1]
            again = ~new & ((doc != doc[of]) | (ver != ver[of]) | (pack != pack[of]))
            if again.any():
                yield out(np.ones(again.sum(), bool), doc[again], ver[again], pack[again])
            near = np.zeros(len(first), bool)
            near[1:] = k1[first[1:]] == k1[first[:-1]]
            rival = near.copy()
            rival[:-1] |= near[1:]
            if held is not None:
                rival[0] |= held[5]
            if with_rivals:
                done = first[:-1][rival[:-1]]
                yield out(np.zeros(len(done), bool), doc[done], ver[done], pack[done])
            last = first[-1]
            held = (int(k1[last]), int(k2[last]), int(doc[last]), int(ver[last]), int(pack[last]), bool(rival[-1]))
        if held is not None and with_rivals and held[5]:
            yield out(np.zeros(1, bool), *(np.array([h]) for h in held[2:5]))

    return rows.mapInArrow(run, "again boolean, doc long, ver long, pack long")


def by_document(spans: DataFrame) -> DataFrame:
    """The places of every document and version as one array; a document holds as many as fit in its text."""
    return spans.groupBy("doc", "ver").agg(F.collect_list("pack").alias("packs"))


def covered(packs: list[int] | np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` tokens lie in a window of ``width`` tokens that starts in one of the places."""
    start, windows = unpacked(np.asarray(packs, np.int64))
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + windows - 1 + width, -1)
    return np.cumsum(change[:-1]) > 0
