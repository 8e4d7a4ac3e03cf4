"""Periodic stretches of words: found by internal pattern matching, and collapsed to one period.

A run is a stretch of consecutive words whose smallest period is ``q`` (words ``q`` apart are
identical), of at least ``max(shortest, 2 * q)`` words, which no neighbouring word extends keeping the
period. All runs of a text are found, of any period up to half of its words:

1. *Suffix array.* The suffixes of some texts are sorted by prefix doubling. Words are numbered text
   by text and each text ends in a number of its own, so suffixes of different texts never meet. Every
   doubling names the blocks of ``2^k`` words: equal names, equal blocks.
2. *Wavelet tree* over the suffix array. The suffixes that begin with a block fill one interval of the
   array; the tree gives the smallest place at or after a bound in it (range successor).
3. *Dyadic blocks.* A run of period ``2b <= q < 4b`` holds an aligned block of ``b`` words in its first
   period, which occurs again ``q`` words later. So each aligned block asks for its occurrences ``2b``
   to ``4b - 1`` words on. (As a run has ``shortest`` words at least, blocks of four also answer for
   the periods up to five, and blocks of two for six and seven.)
4. *Progressions.* Occurrences at most ``b`` apart form an arithmetic progression inside one periodic
   stretch. Those in the block's own stretch give its difference as the only candidate and are
   jumped over; those in another stretch are candidates each, written down at once.
5. *Verification.* A candidate is extended both ways by comparing names of falling block lengths.
   Of candidates that reach the same stretch the smallest period stays.

Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words and no runs. Very long texts
are handled whole, alone in their slice; memory is some hundred bytes a word. Ties between runs can't
occur: a stretch has one smallest period. Every row is judged by itself, so repeated rows and rows
without an id each get a row of their own. An empty table gives an empty result. Only the id and the
text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.llm.common import byte_slices, ranges, texts
from trackframe.llm.suffix_array import doublings

SHORTEST = 12
# Bytes of text whose suffixes are sorted together; a longer text is sorted alone.
SLICE_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start: long, length: long, period: long>>"


class WaveletTree:
    """Numbers below ``2^bits`` in an order; answers for many intervals at once. Levels are split by one bit each."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros = bits, []
        for bit in reversed(range(bits)):
            one = ((values >> bit) & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of each interval are smaller than its ``x``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = ((x >> bit) & 1).astype(bool)
            z_low, z_high = zeros[low], zeros[high]
            count += np.where(one, z_high - z_low, 0)
            low = np.where(one, zeros[-1] + low - z_low, z_low)
            high = np.where(one, zeros[-1] + high - z_high, z_high)
        return count

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of each interval that has ``rank`` smaller ones in it."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            z_low, z_high = zeros[low], zeros[high]
            left = z_high - z_low
            one = rank >= left
            value |= one.astype(np.int64) << bit
            rank = np.where(one, rank - left, rank)
            low = np.where(one, zeros[-1] + low - z_low, z_low)
            high = np.where(one, zeros[-1] + high - z_high, z_high)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest number >= ``x`` of each interval, -1 if there is none."""
        rank = self.below(low, high, x)
        found = np.full(len(low), -1, np.int64)
        some = rank < high - low
        found[some] = self.ranked(low[some], high[some], rank[some])
        return found


class Suffixes:
    """Suffix array of numbered words and the names of all blocks of ``2^k`` words.

    ``names[k][i]`` is where the suffixes that begin like suffix ``i`` for ``2^k`` words start in the
    array. ``blocks[k]`` lists the aligned blocks that occur more than once: place, interval.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.names, self.blocks, self.twice = [], [], np.zeros(0, np.int64)
        name = np.zeros(0, np.int64)
        for name, places, size in doublings(symbols):
            k = len(self.names)
            aligned = (size > 1) & (places & ((1 << k) - 1) == 0)
            low = name[places[aligned]]
            self.blocks.append((places[aligned], low, low + size[aligned]))
            self.names.append(name)
            if k == 1:
                self.twice = places[size > 1]
        self.array = np.empty(n, np.int64)
        self.array[name] = np.arange(n)
        self.tree = None
        if len(self.twice):
            # Only suffixes that share two words with another one can be an answer.
            kept = np.zeros(n, bool)
            kept[self.twice] = True
            in_order = kept[self.array]
            self.before = np.concatenate([[0], np.cumsum(in_order)])
            self.places = np.flatnonzero(kept)
            values = np.cumsum(kept)[self.array[in_order]] - 1
            self.tree = WaveletTree(values, len(values).bit_length())

    def successor(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first suffix of each interval of the array at or after a place, -1 if there is none."""
        found = self.tree.successor(self.before[low], self.before[high], np.searchsorted(self.places, place))
        return np.where(found < 0, -1, self.places[found])

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the suffixes have in common."""
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names) - 1)):
            same = self.names[k][i + length] == self.names[k][j + length]
            length[same] += 1 << k
        return length

    def agree_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before two places are the same, ``i < j``."""
        length = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names) - 1)):
            a, b = i - length - (1 << k), j - length - (1 << k)
            same = (a >= 0) & (self.names[k][np.maximum(a, 0)] == self.names[k][np.maximum(b, 0)])
            length[same] += 1 << k
        return length


def candidates(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods at which an aligned block occurs again."""
    places, periods = [], []

    def add(at: np.ndarray, period: np.ndarray) -> None:
        places.append(at)
        periods.append(period)

    for k in range(1, len(suffixes.blocks)):
        block, (at, low, high) = 1 << k, suffixes.blocks[k]
        nearest = {1: 6, 2: 1}.get(k, 2 * block)
        limit = at + (7 if k == 1 else 4 * block - 1)
        found = suffixes.successor(low, high, at + nearest) if len(at) else at
        near = (found >= 0) & (found <= limit)
        at, low, high, limit, found = (x[near] for x in (at, low, high, limit, found))
        if not len(at):
            continue
        # The block's own periodic stretch: its difference is a candidate, the rest of it is passed over.
        step = suffixes.successor(low, high, at + 1) - at
        own = step <= block
        add(at[own], step[own])
        end = at[own] + step[own] + suffixes.agree(at[own], at[own] + step[own])
        cursor = at + nearest
        cursor[own] = np.maximum(cursor[own], end - block + 1)
        moved = cursor > found
        found[moved] = suffixes.successor(low[moved], high[moved], cursor[moved])
        while True:
            near = (found >= 0) & (found <= limit)
            at, low, high, limit, found = (x[near] for x in (at, low, high, limit, found))
            if not len(at):
                break
            after = suffixes.successor(low, high, found + 1)
            step = after - found
            chain = (after >= 0) & (step <= block)
            add(at[~chain], (found - at)[~chain])
            if chain.any():
                first, gap = found[chain], step[chain]
                last = after[chain] + suffixes.agree(first, after[chain]) - block
                count = (np.minimum(last, limit[chain]) - first) // gap + 1
                turn = ranges(np.zeros(len(count), np.int64), count)
                add(np.repeat(at[chain], count), np.repeat(first - at[chain], count) + turn * np.repeat(gap, count))
                after[chain] = suffixes.successor(low[chain], high[chain], last + 1)
            found = after
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(symbols: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start, then period.

    ``symbols`` are small numbers; a number that occurs once ends what no run may cross.
    """
    suffixes = Suffixes(symbols)
    at, period = candidates(suffixes)
    back = suffixes.agree_before(at, at + period)
    start, length = at - back, back + period + suffixes.agree(at, at + period)
    good = length >= np.maximum(shortest, 2 * period)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def numbered(texts_of_words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, text by text with one more number behind each, and where the texts start."""
    base, parts = 0, []
    for words in texts_of_words:
        number = dict.fromkeys(words)
        number = dict(zip(number, range(base, base + len(number))))
        base += len(number)
        parts += [np.fromiter(map(number.__getitem__, words), np.int64, len(words)), np.array([base])]
        base += 1
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in texts_of_words])]).astype(np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), starts


def find_runs(
    docs: DataFrame, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """One row per document: its words, its runs, and the text that is left when every run keeps one period.

    ``collapsed`` (with ``with_text``) holds the words outside of what repeats, joined by one space:
    a word goes if any run contains it after that run's first period.
    """
    if shortest < SHORTEST:
        raise ValueError(f"blocks of two and four words find all runs of {SHORTEST} words or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in byte_slices(batches, "text", SLICE_BYTES):
            words = [text.split() for text in raw]
            symbols, starts = numbered(words)
            start, length, period = runs_of(symbols, shortest)
            change = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            of = np.searchsorted(starts, start, "right") - 1
            counts = np.bincount(of, minlength=len(words)).astype(np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                [pa.array(start - starts[of]), pa.array(length), pa.array(period)], ["start", "length", "period"]
            ))
            for i in np.flatnonzero(counts):
                lost = gone[starts[i] : starts[i] + len(words[i])]
                words[i] = [w for w, x in zip(words[i], lost.tolist()) if not x]
            left = [b" ".join(w) for w in words]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(np.diff(starts) - 1),
                "runs": found,
                "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
            }
            if with_text:
                columns["collapsed"] = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    text = ", collapsed string" if with_text else ""
    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed_sha256 string{text}")


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``: every tenth text, by a checksum of its id, goes round in a circle from some word on.

    With ``h = crc32(id)``, ``g = h div 10`` and ``n`` words, a text with ``h % 10 = 0`` repeats the
    ``p = 1 + (n - a) div (3 + g % 8)`` words from ``a = g % n`` on up to its length. Rows without an id stay as they are.
    """
    rows = texts(docs, id_col, text_col).withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words)).withColumn("_n", F.size("_w"))
    rows = rows.withColumn("_a", F.expr("if(_n > 0, (_h div 10) % _n, 0)"))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + (_h div 10) % 8)"))
    cycle = "array_repeat(slice(_w, int(_a + 1), int(_p)), int((_n - _a) div _p + 1))"
    cycled = F.expr(f"array_join(slice(concat(slice(_w, 1, int(_a)), flatten({cycle})), 1, int(_n)), ' ')")
    return rows.select("doc_id", F.when(F.col("_n") > 0, cycled).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Per document of :func:`find_runs`: the number of runs, the longest one, and digests of all runs and of what is left."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    line: Column = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("_best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div (-_best.period)").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
