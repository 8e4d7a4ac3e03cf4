"""Benchmark passages in training documents, by suffix arrays over the training text.

Documents are cut into shards of bounded size (whole documents; a longer one is a shard of its own).
The words of a shard are numbered, every document ends in a number of its own, and the suffix array of
the shard is sorted to the end. Every suffix of every benchmark item is then binary-searched in it, word
by word, for all suffixes at once: the interval that is left after some words holds all places where
they occur. What comes out:

* *windows*: ``window`` consecutive words of an item (an item of fewer words, but not none, is one
  window). All words of a document inside any occurrence of a window are hit (:func:`find_matches`);
  :func:`drop_contaminated` removes the documents with a hit.
* *longest matches*: of every item the longest verbatim match and where it lies (:func:`longest_matches`).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z, which is ASCII letters and digits and
all other scripts. Words are compared exactly, not by hash. Documents are neither shuffled nor joined: each
shard is searched where it is read. The benchmark is the stated query set: it travels to the tasks in blocks
of ``BLOCK_BYTES`` of text, whatever its size; each block is a pass that adds to what the earlier ones
found, and after ``CHAIN`` passes the rows are written and read again.

Null and empty texts have no words and no hits; an item without words matches nothing. Very long texts are
searched whole. Rows that repeat an id or a text are judged one by one and alike; rows without an id too.
Items that repeat id and text count once; items that share an id count as one item; an item without an id
makes its words hit but can't be listed. Empty tables of documents give no rows, of items no hits. Columns
of any other name pass through :func:`drop_contaminated`; the other functions read id and text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.llm.common import byte_slices, free_name, ranges
from trackframe.llm.suffix_array import suffix_array
from trackframe.session import stage

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
# Passes that run as one chain of Python workers before the rows are written.
CHAIN = 4
SPANS = "array<struct<start: long, length: long>>"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LOWER).split()


class Shard:
    """Some documents as one array of word numbers, and its suffix array."""

    def __init__(self, raw: list[bytes]):
        words = [words_of(x) for x in raw]
        lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.n_words = lengths
        number: dict[bytes, int] = {}
        for w in words:
            number.update(dict.fromkeys(w))
        self.number = dict(zip(number, range(len(number))))
        find = self.number.__getitem__
        self.symbols = np.empty(self.starts[-1], np.int64)
        for start, w in zip(self.starts.tolist(), words):
            self.symbols[start : start + len(w)] = np.fromiter(map(find, w), np.int64, len(w))
        self.symbols[self.starts[1:] - 1] = len(number) + np.arange(len(raw))
        self.array = suffix_array(self.symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.symbols, minlength=len(number)))])

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1

    def bound(self, depth: int, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
        """Where in each interval, equal for ``depth`` words, the next word reaches (or, ``right``, passes) a value."""
        low, high = low.copy(), high.copy()
        while (unsettled := np.flatnonzero(low < high)).size:
            middle = (low[unsettled] + high[unsettled]) >> 1
            word = self.symbols[self.array[middle] + depth]
            under = word <= value[unsettled] if right else word < value[unsettled]
            low[unsettled[under]] = middle[under] + 1
            high[unsettled[~under]] = middle[~under]
        return low


class Block:
    """Some benchmark items: their words as numbers, one item after the other with a gap behind each."""

    def __init__(self, ids: list[str | None], texts: list[str | None], window: int):
        words = [words_of((x or "").encode()) for x in texts]
        kept = [i for i, w in enumerate(words) if w]
        self.ids, words = [ids[i] for i in kept], [words[i] for i in kept]
        lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
        number: dict[bytes, int] = {}
        flat = [number.setdefault(w, len(number)) for own in words for w in own]
        self.vocabulary = list(number)
        self.words = np.full(self.starts[-1], -1, np.int64)
        self.words[ranges(self.starts[:-1], lengths)] = flat
        self.item = np.repeat(np.arange(len(words)), lengths + 1)
        self.width = np.minimum(lengths, window)[self.item]
        self.rest = self.starts[1:][self.item] - 1 - np.arange(len(self.item))

    def search(self, shard: Shard) -> Iterator[tuple[str, np.ndarray, int, np.ndarray, np.ndarray]]:
        """All suffixes of all items at once, one word deeper each round.

        Yields ``("window", suffixes, words, low, high)`` where a window is complete and ``("longest", ...)``
        where a suffix with at least a window ends: its interval in the shard's array after that many words.
        """
        find = shard.number.get
        here = np.fromiter((find(w, -1) for w in self.vocabulary), np.int64, len(self.vocabulary))
        words = np.where(self.words >= 0, here[self.words], -1) if len(here) else self.words
        at = np.flatnonzero(words >= 0)
        low, high, depth = shard.first[words[at]], shard.first[words[at] + 1], 1
        while len(at):
            full = (self.width[at] == depth) & (self.rest[at] >= depth)
            if full.any():
                yield "window", at[full], depth, low[full], high[full]
            value = words[at + depth]
            more = np.flatnonzero(value >= 0)
            new_low = shard.bound(depth, low[more], high[more], value[more], False)
            new_high = shard.bound(depth, new_low, high[more], value[more], True)
            on = new_low < new_high
            ended = np.ones(len(at), bool)
            ended[more[on]] = False
            ended &= self.width[at] <= depth
            if ended.any():
                yield "longest", at[ended], depth, low[ended], high[ended]
            at, low, high, depth = at[more[on]], new_low[on], new_high[on], depth + 1


def blocks(items: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark in parts of about ``BLOCK_BYTES`` of text, dealt by hash; an empty one if there is none."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where("text is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    if count > 1:
        rows = stage(rows.withColumn("block", F.expr(f"pmod(xxhash64(id, text), {2 * count})")), "items")
        parts = (rows.where(F.col("block") == i) for i in range(2 * count))
    else:
        parts = iter([rows])
    for part in parts:
        found = part.toArrow()
        yield Block(found.column("id").to_pylist(), found.column("text").to_pylist(), window)


def hits(block: Block, shard: Shard, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add the occurrences of all windows to ``change``; returns the distinct pairs of document and item.

    Equal windows have the same interval, so occurrences are looked at once, however many items share them.
    """
    documents, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for kind, suffix, depth, low, high in block.search(shard):
        if kind != "window":
            continue
        starts, one, group = np.unique(low, return_index=True, return_inverse=True)
        count = high[one] - starts
        places = shard.array[ranges(starts, count)]
        np.add.at(change, places, 1)
        np.add.at(change, places + depth, -1)
        found = np.unique(np.repeat(np.arange(len(starts)), count) * len(shard.n_words) + shard.document(places))
        of_group, document = np.divmod(found, len(shard.n_words))
        # Items of every distinct window, then of every document that holds it.
        pair = np.unique(group * len(block.ids) + block.item[suffix])
        owner, item = np.divmod(pair, len(block.ids))
        begin = np.searchsorted(owner, of_group)
        many = np.searchsorted(owner, of_group, "right") - begin
        pair = np.unique(np.repeat(document, many) * len(block.ids) + item[ranges(begin, many)])
        documents.append(pair // len(block.ids))
        items.append(pair % len(block.ids))
    return np.concatenate(documents), np.concatenate(items)


def _search_pass(rows: DataFrame, block: Block, text: str, n_words: str, spans: str, items: str) -> DataFrame:
    """The rows with what one block of items adds to the columns of counts, spans and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in byte_slices(batches, text, SHARD_BYTES):
            shard = Shard(raw)
            change = np.zeros(len(shard.symbols) + 1, np.int64)
            known = batch.column(spans)
            if len(flat := known.flatten()):
                start = flat.field("start").to_numpy() + np.repeat(shard.starts[:-1], known.value_lengths().to_numpy())
                np.add.at(change, start, 1)
                np.add.at(change, start + flat.field("length").to_numpy(), -1)
            document, item = hits(block, shard, change)
            listed = batch.column(items)
            own = {int(d): set() for d in np.unique(document)}
            for d, i in zip(document.tolist(), item.tolist()):
                if block.ids[i] is not None:
                    own[d].add(block.ids[i])
            if own:
                listed = listed.to_pylist()
                for d, new in own.items():
                    listed[d] = sorted(new.union(listed[d]))
                listed = pa.array(listed, pa.list_(pa.string()))
            hit = (np.cumsum(change) > 0).astype(np.int8)
            edge = np.diff(hit, prepend=0)
            start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            of = shard.document(start)
            offsets = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays([pa.array(start - shard.starts[of]), pa.array(end - start)], ["start", "length"])
            new = {n_words: pa.array(shard.n_words), spans: pa.ListArray.from_arrays(pa.array(offsets), found), items: listed}
            yield pa.RecordBatch.from_arrays([new.get(n, c) for n, c in zip(batch.schema.names, batch.columns)], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def add_matches(
    docs: DataFrame, items: DataFrame, window: int, names: tuple[str, str, str], text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with its number of words, the maximal spans of hit words, and the items that hit, sorted as strings."""
    n_words, spans, listed = names
    rows = docs.withColumns({
        n_words: F.lit(0).cast("long"), spans: F.array().cast(SPANS), listed: F.array().cast("array<string>"),
    })
    for k, block in enumerate(blocks(items, window, item_id, item_text)):
        if k and k % CHAIN == 0:
            rows = stage(rows, "searched")
        rows = _search_pass(rows, block, text, n_words, spans, listed)
    return rows


def find_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` of hit words and ``items`` of every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return add_matches(rows, items, window, ("n_words", "spans", "items"), "text", item_id, item_text).drop("text")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no window of any item occurs."""
    names = tuple(free_name(docs, n) for n in ("n_words", "spans", "items"))
    rows = add_matches(docs, items, window, names, text_col, item_id, item_text)
    return rows.where(F.size(names[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def longest_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Of every item with an occurring window the longest match: ``item_id``, ``length``, ``item_start``, ``doc_id``, ``doc_start``.

    Starts and lengths count words. Of equal lengths the smallest start in the item is given, then the
    smallest document id (null last) and place. Every shard sends one row an item.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = ("item_id", "length", "item_start", "no_id", "doc_id", "doc_start")

    def one(block: Block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, raw in byte_slices(batches, "text", SHARD_BYTES):
                shard = Shard(raw)
                ids = batch.column("doc_id").to_pylist()
                best: dict[int, tuple] = {}
                for kind, suffix, depth, low, high in block.search(shard):
                    if kind != "longest":
                        continue
                    # Suffixes come in rising order: the first of an item at the greatest depth is wanted.
                    which, one = np.unique(block.item[suffix], return_index=True)
                    for i, k in zip(which.tolist(), one.tolist()):
                        places = shard.array[low[k] : high[k]]
                        of = shard.document(places)
                        near = min((ids[d] is None, ids[d] or 0, int(p)) for d, p in zip(of.tolist(), (places - shard.starts[of]).tolist()))
                        best[i] = (depth, int(suffix[k] - block.starts[i]), *near)
                rows = [(block.ids[i], *x) for i, x in best.items()]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], list(fields))

        return rows.mapInArrow(run, "item_id string, length long, item_start long, no_id boolean, doc_id long, doc_start long")

    found = None
    for block in blocks(items, window, item_id, item_text):
        found = one(block) if found is None else found.unionByName(one(block))
    best = F.min(F.struct((-F.col("length")).alias("length"), *fields[2:])).alias("b")
    return found.groupBy("item_id").agg(best).select(
        "item_id", (-F.col("b.length")).alias("length"), "b.item_start", F.when(~F.col("b.no_id"), F.col("b.doc_id")).alias("doc_id"), "b.doc_start"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the items per document of :func:`find_matches`."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["length"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


# Lower-cased words, the windows of all items, the places where they begin in a document (one join per width), and
# the words they cover.
SQL = r"""
with d as (select row_number() over () as r, doc_id, w, len(w) as n from (select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents)),
b as (select item_id, w, len(w) as n, least(len(w), 10) as k from (select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark)),
windows as (select distinct item_id, k, w[i : i + k - 1] as x from (select item_id, k, w, unnest(range(1, n - k + 2)) as i from b where n > 0)),
places as (select r, i, k, w[i : i + k - 1] as x from (select r, w, n, k, unnest(range(1, n - k + 2)) as i from d, (select distinct k from windows) where n >= k)),
found as (select r, i, p.k, item_id from places p join windows q on p.k = q.k and p.x = q.x),
hit as (select r, count(distinct word) as n_hit from (select r, unnest(range(i, i + k)) as word from found) group by r),
listed as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from found group by r)
select doc_id, n as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join listed using (r)
"""
