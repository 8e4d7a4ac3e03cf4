"""Line dedup by winnowing: runs of lines that repeat earlier ones are deleted.

Tokens are the worded lines of a text (cut at ``\\n``; blanks at either end don't count, lines without
a word are passed over). A run of lines is long enough if it has ``RUN`` lines or ``LEAST_WORDS`` words
(``[^\\x20\\x09-\\x0D]+``), be it one long line. A line is deleted if it lies in such a run that also
occurs earlier: in a document with a smaller id, or further up in the same one. Runs are judged on the
input, and overlaps count.

1. *Select.* Windows are the runs of ``RUN`` lines and the shorter ones of ``LEAST_WORDS`` words; every run
   that is long enough is a union of windows. Fingerprints are hashes of ``GRAM`` consecutive lines (of
   the whole window if it is shorter). Of every window the smallest is selected, the leftmost of equal
   ones, so equal windows select the same place. One row goes out for a selected fingerprint and place.
2. *Join.* Fingerprints shuffle by value; those found at one place only go no further.
3. *Extend.* A fingerprint that is found again extends both ways over the lines of the windows that
   selected it. Extended windows are compared as wholes, and those that follow one another make up the
   longest runs.

Null and empty texts, and texts without a run that is long enough, stay as they are; a text of any length
is handled by one task at a time and sends at most one row a line and fingerprint. Rows without an id come
after all others; rows that repeat id and text are judged alike. Other columns pass through, whatever
their names. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackframe.llm.common import free_name, mixed
from trackframe.llm.repeats import NO_ID, ROWS, WIDEST, by_document, covered, packed, repeated, rows_batch, versioned
from trackframe.llm.words import slices

GRAM, RUN, LEAST_WORDS = 2, 3, 50
# Sets the hashes of windows apart from those of fingerprints.
RUN_SEED = 1 << 32
_SPACE = b" \t\n\x0b\x0c\r"


def worded_lines(raw: bytes) -> tuple[list[bytes], np.ndarray]:
    """All lines, and the numbers of those with a word."""
    lines = raw.split(b"\n")
    return lines, np.array([i for i, x in enumerate(lines) if x.strip(_SPACE)], np.int64)


def line_hashes(lines: list[bytes]) -> np.ndarray:
    """64 bits for every line."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x.strip(_SPACE)) for x in lines], np.uint64)


def run_hashes(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """64 bits for every run of ``width`` hashes."""
    n = max(len(h) - width + 1, 0)
    out = np.full(n, seed, np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : n + k])
    return out


def winnow(h: np.ndarray, words: np.ndarray, gram: int, run: int, least_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each width the windows that are long enough: start, width, hash, selected fingerprint and its line."""
    total = np.concatenate([[0], np.cumsum(words)])
    for width in range(1, min(run, len(h)) + 1):
        n = len(h) - width + 1
        start = np.arange(n) if width == run else np.flatnonzero(total[width:] - total[:n] >= least_words)
        if not len(start):
            continue
        own = min(gram, width)
        prints = run_hashes(h, own, own)
        options = np.stack([prints[start + k] for k in range(width - own + 1)])
        place = options.argmin(axis=0)
        yield start, np.full(len(start), width), run_hashes(h, width, RUN_SEED + width)[start], options[place, np.arange(len(start))], start + place


FOUND = "k1 long, doc long, ver long, known boolean, packs array<long>, wholes array<long>"


def fingerprints(docs: DataFrame, gram: int, run: int, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """Selected fingerprints with their line and the windows they extend to.

    Fingerprints that occur again in a batch are ``known`` to have a partner: the first goes out under its
    own key, for other batches, and the rest are dealt out. So a line of all documents sends one row a batch.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: list[list[np.ndarray]] = [[] for _ in range(7)]
            for raw, doc, ver in zip(
                batch.column("text").cast(pa.binary()).to_pylist(), batch.column("doc").to_pylist(), batch.column("ver").to_pylist()
            ):
                lines, at = worded_lines(raw)
                own = [lines[i] for i in at.tolist()]
                words = np.array([len(x.split()) for x in own], np.int64)
                if len(own) < run and words.sum() < least_words:
                    continue
                for start, width, whole, key, line in winnow(line_hashes(own), words, gram, run, least_words):
                    n = len(start)
                    values = (key.view(np.int64), np.full(n, doc, np.int64), np.full(n, ver, np.int64), line, packed(start, width + 1), whole.view(np.int64))
                    for column, value in zip(found, values):
                        column.append(value)
            if not found[0]:
                continue
            k1, doc, ver, at, pack, whole = map(np.concatenate, found[:6])
            order = np.lexsort((pack, at, ver, doc, k1))
            k1, doc, ver, at, pack, whole = (x[order] for x in (k1, doc, ver, at, pack, whole))
            other = np.ones(len(k1), bool)  # another fingerprint or place than the row before
            other[1:] = (k1[1:] != k1[:-1]) | (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1]) | (at[1:] != at[:-1])
            first = np.flatnonzero(other)
            offsets = pa.array(np.append(first, len(k1)).astype(np.int32))
            k1, doc, ver, at = (x[first].copy() for x in (k1, doc, ver, at))
            again = np.concatenate([[False], k1[1:] == k1[:-1]])
            k1[again] = mixed((doc[again] ^ ver[again]) * np.int64(1_000_003) + at[again]).view(np.int64)
            known = again.copy()
            known[:-1] |= again[1:]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pack, whole)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, (k1, doc, ver, known)), *lists], ["k1", "doc", "ver", "known", "packs", "wholes"])

    return versioned(docs, id_col, text_col).mapInArrow(find, FOUND)


def extended(found: DataFrame) -> DataFrame:
    """Windows around fingerprints that are found at several places: ``k1`` and ``k2`` stand for all their lines."""
    rows = found.repartition("k1").sortWithinPartitions("k1")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows(rows: pa.RecordBatch, some: np.ndarray) -> pa.RecordBatch:
            rows = rows.filter(pa.array(some))
            packs, wholes = rows.column("packs"), rows.column("wholes")
            counts = np.diff(packs.offsets.to_numpy())
            doc, ver = (np.repeat(rows.column(c).to_numpy(), counts) for c in ("doc", "ver"))
            whole = wholes.flatten().to_numpy()
            pack = packs.flatten().to_numpy()
            width = (pack >> 16) & WIDEST
            second = mixed(whole.view(np.uint64) ^ width.astype(np.uint64)).view(np.int64)
            return rows_batch(whole, second, doc, ver, pack)

        held: pa.RecordBatch | None = None  # a row that waits for a partner
        last: int | None = None  # the key of the row before, which has gone out
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            k1 = batch.column("k1").to_numpy()
            same = k1[1:] == k1[:-1]
            partner = batch.column("known").to_numpy(zero_copy_only=False).copy()
            partner[1:] |= same
            partner[:-1] |= same
            if last is not None:
                partner[0] |= k1[0] == last
            held = None if partner[-1] else batch.slice(batch.num_rows - 1)
            last = int(k1[-1]) if partner[-1] else None
            if partner.any():
                yield windows(batch, partner)

    return rows.mapInArrow(join, ROWS)


def drop_repeated_lines(
    docs: DataFrame, run: int = RUN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", removed: str = "n_removed_lines",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The rows with all their columns, the text without deleted lines, and how many were deleted.

    Texts shuffle once, to the list of their repeated runs; nothing is collected but these lists,
    which are no longer than their texts.
    """
    if not 0 < gram <= run < WIDEST:
        raise ValueError(f"a fingerprint spans at least one line and at most a run, a run fewer than {WIDEST} lines")
    spans = by_document(repeated(extended(fingerprints(docs, gram, run, least_words, id_col, text_col))))
    names = [free_name(docs, x) for x in ("doc", "ver", "packs")]
    spans = spans.toDF(*names)
    doc, ver = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = docs.join(spans, (doc == F.col(names[0])) & (ver == F.col(names[1])), "left").drop(*names[:2])
    schema = T.StructType([*docs.schema.fields, T.StructField(removed, T.LongType())])
    place = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts = batch.column(place).to_pylist(), []
            for i, packs in enumerate(batch.column(len(docs_columns)).to_pylist()):
                if packs is None or texts[i] is None:
                    counts.append(0)
                    continue
                lines, at = worded_lines(texts[i].encode("utf-8"))
                gone = set(at[covered(packs, 0, len(at))].tolist())
                texts[i] = b"\n".join([x for k, x in enumerate(lines) if k not in gone]).decode("utf-8")
                counts.append(len(gone))
            columns = [*batch.columns[: len(docs_columns)], pa.array(counts, pa.int64())]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*docs_columns, removed])

    docs_columns = list(docs.columns)
    return rows.mapInArrow(cut, schema)


# The same in SQL: runs that are long enough, the first of each content, and the lines they cover.
SQL = r"""
with ln as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as no from documents),
t as (select doc_id, no, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as bare from ln),
w as (select doc_id, no, bare, row_number() over (partition by doc_id order by no) as i,
             len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) as n from t where bare <> ''),
r as (
    select doc_id, i, [bare] as one, [bare, lead(bare, 1) over o] as two, [bare, lead(bare, 1) over o, lead(bare, 2) over o] as three,
           n >= 50 as long_one, n + lead(n, 1) over o >= 50 as long_two, lead(i, 2) over o is not null as fits
    from w window o as (partition by doc_id order by i)),
a as (select doc_id, i, 1 as width, one as run from r where long_one
      union all select doc_id, i, 2, two from r where long_two
      union all select doc_id, i, 3, three from r where fits),
f as (select doc_id, i, width, row_number() over (partition by run order by doc_id, i) as nth from a),
c as (select distinct doc_id, i + unnest(range(width)) as i from f where nth > 1),
g as (select w.doc_id, w.no from w join c on c.doc_id = w.doc_id and c.i = w.i),
k as (select ln.doc_id, ln.no, ln.line, g.no is not null as gone from ln left join g on g.doc_id = ln.doc_id and g.no = ln.no)
select doc_id, sha256(coalesce(string_agg(line, chr(10) order by no) filter (not gone), '')) as kept_sha256,
       count(*) filter (gone) as n_removed_lines
from k group by doc_id"""
