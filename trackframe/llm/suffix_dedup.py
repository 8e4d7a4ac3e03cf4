"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``DEPTH`` bytes, most significant digit first, and a
group of one leaves the sort as soon as it is alone; groups that are still equal at the end are
exactly the repeated windows. Three passes do this, each a shuffle on its digit:

1. *Anchor.* A window of ``DEPTH`` bytes is led by the smallest ``GRAM``-byte hash inside it (the
   leftmost of equal ones). Equal windows have equal anchors at equal places, so it is enough to
   send one row per anchor, on average one for every ``(DEPTH - GRAM) / 2`` bytes, instead of one
   per suffix. An anchor whose gram occurs once leaves here.
2. *Context.* All windows of an anchor together span at most ``2 * DEPTH - GRAM`` bytes. Of equal
   contexts all but the first repeat it as a whole; only first contexts go on, and only where another
   context has the same gram.
3. *Window.* The windows of these contexts, one by one: all but the first of each content repeat it.

Contents are compared by 128 bits of hash. Rows of one content are sorted and streamed, never
gathered, and a content that many documents share is thinned in its batch before it is shuffled
(:mod:`trackframe.llm.repeats`).

A byte goes if it lies in a window that also starts earlier: in a document with a smaller id, or
further up in the same one. Windows are judged on the input, never cross documents, and their
overlaps count. Null and empty texts count as empty. Rows without an id come after all others; rows
that repeat id and text are judged alike. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.llm.common import mixed, ranges, text_bytes
from trackframe.llm.repeats import NO_ID, ROWS, by_document, covered, packed, repeated, rows_batch, unpacked, versioned
from trackframe.session import stage

DEPTH, GRAM = 100, 32
# Bytes that are hashed together; a longer text is hashed alone.
BLOCK = 1 << 20
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Two random-looking values for every byte."""
    return mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)).reshape(2, 256)


@lru_cache(maxsize=4)
def _powers(which: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, modulo 2^64."""
    out = []
    for factor in (_FACTORS[which], pow(_FACTORS[which], -1, 1 << 64)):
        powers = np.ones(1, np.uint64)
        while len(powers) < 1 << bits:
            powers = np.concatenate([powers, powers * np.uint64(pow(factor, len(powers), 1 << 64))])
        out.append(powers)
    return out[0], out[1]


class Hashes:
    """Hashes of any substrings of some bytes: differences of prefix sums, moved to the same power."""

    def __init__(self, data: np.ndarray, which: int):
        up, self.down = _powers(which, max(int(len(data)).bit_length(), 1))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_letters()[which][data] * up[: len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray | slice, end: np.ndarray | slice, power: np.ndarray | slice) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[power]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values, from minima of doubling widths."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: text, first window (place in its text), windows, gram hash, context hash."""
    n = len(data) - depth + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none, none, none
    first, second = Hashes(data, 0), Hashes(data, 1)
    grams = mixed(first.at(slice(0, len(data) - gram + 1), slice(gram, len(data) + 1), slice(0, len(data) - gram + 1)))
    low = np.uint64(0xFFFFFFFF)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    lead = (sliding_min(keys, depth - gram + 1) & low).astype(np.int64)
    lengths = np.diff(starts)
    inside = np.zeros(n, bool)
    fits = lengths >= depth
    inside[ranges(starts[:-1][fits], lengths[fits] - depth + 1)] = True
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (lead[1:] != lead[:-1]) | ~inside[:-1]
    new &= inside
    begin = np.flatnonzero(new)
    if not len(begin):
        return none, none, none, none, none
    count = np.add.reduceat(inside.astype(np.int64), begin)
    # A run ends where the next begins or where its text does.
    text = np.searchsorted(starts, begin, "right") - 1
    count = np.minimum(count, starts[text + 1] - depth + 1 - begin)
    end = begin + count - 1 + depth
    context = mixed(first.at(begin, end, begin) + np.uint64(3) * mixed(second.at(begin, end, begin) + count.astype(np.uint64)))
    return text, begin - starts[text], count, grams[lead[begin]].view(np.int64), context.view(np.int64)


def blocks(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Neighbouring texts of about ``size`` bytes together: first and last row, bytes, starts."""
    data, starts = text_bytes(column)
    row = 0
    while row < len(starts) - 1:
        to = max(int(np.searchsorted(starts, starts[row] + size, "right")) - 1, row + 1)
        yield row, to, data[starts[row] : starts[to]], starts[row : to + 1] - starts[row]
        row = to


def anchor_rows(rows: DataFrame, depth: int, gram: int) -> DataFrame:
    """The anchors of all texts: ``k1`` the gram, ``k2`` the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, versions = batch.column("doc").to_numpy(), batch.column("ver").to_numpy()
            for a, b, data, starts in blocks(batch.column("text"), BLOCK):
                text, start, count, grams, context = anchors(data, starts, depth, gram)
                if len(text):
                    yield rows_batch(grams, context, docs[a:b][text], versions[a:b][text], packed(start, count))

    return rows.mapInArrow(run, ROWS)


def window_rows(rows: DataFrame, depth: int) -> DataFrame:
    """The windows of chosen contexts one by one: ``k1`` and ``k2`` are their two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, versions = batch.column("doc").to_numpy(), batch.column("ver").to_numpy()
            packs = batch.column("packs")
            for a, b, data, starts in blocks(batch.column("text"), BLOCK):
                chosen = packs.slice(a, b - a)
                per_text = np.diff(chosen.offsets.to_numpy())
                start, count = unpacked(chosen.flatten().to_numpy())
                text = np.repeat(np.repeat(np.arange(b - a), per_text), count)
                at = ranges(start, count) + starts[:-1][text]
                one, two = (mixed(Hashes(data, k).at(at, at + depth, at)).view(np.int64) for k in (0, 1))
                yield rows_batch(one, two, docs[a:b][text], versions[a:b][text], packed(at - starts[:-1][text], np.ones(len(at))))

    return rows.mapInArrow(run, ROWS)


def told_apart(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as ``doc``, ``ver``, ``text``; ``ver`` is 0 where every id is that of one row, as it then tells nothing."""
    rows = versioned(docs, id_col, text_col)
    if rows.groupBy("doc").count().where("count > 1").limit(1).isEmpty():
        rows = rows.withColumn("ver", F.lit(0).cast("long"))
    return rows


def repeated_spans(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places whose windows repeat earlier ones: ``doc``, ``ver``, ``packs``. ``doc`` is ``NO_ID`` for null."""
    return _spans(told_apart(docs, id_col, text_col), depth, gram)


def _spans(rows: DataFrame, depth: int, gram: int) -> DataFrame:
    if not 0 < gram <= depth or depth - gram + 1 > 127:
        raise ValueError("a gram is no longer than a window, and a run has at most 127 windows")
    rows = rows.where(F.octet_length("text") >= depth)
    found = stage(repeated(anchor_rows(rows, depth, gram), with_rivals=True), "contexts")
    whole = found.where("again").select("doc", "ver", "pack")
    chosen = rows.join(by_document(found.where("not again")), ["doc", "ver"])
    single = stage(repeated(window_rows(chosen.select("doc", "ver", "text", "packs"), depth)).select("doc", "ver", "pack"), "windows")
    return by_document(whole.unionByName(single))


def remove_repeats(
    docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True
) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of the rest and, if wanted, the rest."""
    rows = told_apart(docs, id_col, text_col)
    rows = rows.join(_spans(rows, depth, gram), ["doc", "ver"], "left")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            data, starts = text_bytes(batch.column("text"))
            packs = batch.column("packs")
            for i, doc in enumerate(batch.column("doc").to_pylist()):
                text = data[starts[i] : starts[i + 1]]
                removed = runs = 0
                if packs[i].is_valid:
                    gone = covered(packs[i].values.to_numpy(), depth, len(text))
                    removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    text = text[~gone]
                kept = text.tobytes()
                values = (None if doc == NO_ID else doc, int(starts[i + 1] - starts[i]), removed, runs, hashlib.sha256(kept).hexdigest(), kept)
                for column, value in zip(out, values):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    kinds = ["long"] * 4 + ["string", "binary"]
    return rows.select("doc", "text", "packs").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
