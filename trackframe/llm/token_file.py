"""Token ids as grammar-compressed binary shards (Re-Pair), written and read back in id order.

A shard holds the documents of ``SHARD_IDS`` consecutive ids in ascending order; each document's ids
end with an end id. Frequent neighbouring pairs are repeatedly replaced by new symbols. Rounds are
batched: all frequent pairs of a round are counted together, and where occurrences overlap the more
frequent pair wins. Pairs never span documents, so every document can be expanded alone.

A shard is a row of a Parquet table, with its order, its number of ids, and one binary ``payload``:

    4 bytes ``RPG1``; uint32 base (symbols below are ids), rules, documents, symbols
    uint32 pairs of all rules; uint32 expansion length of each rule
    int64 document ids; uint8 whether the id is there; uint32 symbols of each document
    uint16 or uint32 symbols (uint16 if all fit)

all little-endian. Rows without an id come first, in an arbitrary order. Null and empty texts have
only the end id; repeated rows stay; other columns are not read. A shard with more than
``PART_IDS`` ids is cut into several parts, so that memory stays bounded.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trackframe.llm.common import byte_slices, ranges, text_bytes, texts
from trackframe.llm.words import slices
from trackframe.session import scratch_path

SHARD_IDS = 1024
PART_IDS = 2_000_000
# A round replaces pairs that occur this often; rounds end when one saves less than this share.
MIN_COUNT = 24
LEAST_GAIN = 0.01
MAX_SYMBOLS = 1 << 16
MAGIC = b"RPG1"
CACHE = 700_000
# Bytes of text that are encoded at once.
SLICE_BYTES = 8 << 20
# Words whose tokens are held as objects at once.
SOME_WORDS = 256

# White space beyond ASCII, which may join a run of blanks: such texts are not cut.
_OTHER_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
# Kinds of bytes: white space, punctuation, letters and digits of ASCII, and the second byte of Latin letters.
WHITE, PUNCTUATION, LETTER, DIGIT, LATIN = (
    np.isin(np.arange(256), list(x))
    for x in (
        b"\t\n\x0b\x0c\r ", [b for b in range(33, 127) if not chr(b).isalnum()], [b for b in range(128) if chr(b).isalpha()],
        b"0123456789", [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)],
    )
)
BLANK, FEED, LATIN_LEAD = 0x20, 0x0A, 0xC3
# The characters that stand for bytes in byte-level vocabularies, by byte.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))} | {b: chr(b) for b in _SHOWN}
_OTHER_SPACE_HINTS = (b"\xc2", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")


def other_space(raw: bytes) -> bool:
    """Whether a text holds white space beyond ASCII."""
    return not raw.isascii() and any(h in raw for h in _OTHER_SPACE_HINTS) and _OTHER_SPACE.search(raw) is not None


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Whether each byte is part of an ASCII letter or of one of the Latin letters behind byte C3."""
    good = LETTER[data]
    pair = (data[:-1] == LATIN_LEAD) & LATIN[data[1:]]
    good[:-1] |= pair
    good[1:] |= pair
    return good


def piece_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pieces of texts that lie one after the other begin; each text has a byte at least.

    Cuts lie where the search for token runs must stop: before every run of white space, behind a line
    feed that is such a run alone, and before punctuation that ends a piece behind a letter or digit.
    """
    white = WHITE[data]
    cut = white.copy()
    cut[1:] &= ~white[:-1]
    cut[begins] = True
    feeds = np.flatnonzero(cut[:-1] & (data[:-1] == FEED) & ~white[1:])
    cut[feeds + 1] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    marks = PUNCTUATION[data]
    tailed = marks[ends - 1]
    if tailed.any():
        ends, starts = ends[tailed], starts[tailed]
        first = np.flatnonzero(marks & np.append(True, ~marks[:-1]))
        tail = first[np.searchsorted(first, ends) - 1]
        tail = tail[tail > starts]
        before = data[tail - 1]
        word = LETTER[before] | DIGIT[before] | (LATIN[before] & (data[np.maximum(tail - 2, 0)] == LATIN_LEAD))
        cut[tail[word]] = True
    return np.flatnonzero(cut)


class CachedEncoder:
    """The ``tokenizers`` library's ids, with pieces of text encoded once per worker.

    A run of white space begins a new token in byte-level vocabularies, so a text may be cut before
    every run (see :func:`piece_starts`). Texts with added tokens or other white space are encoded whole.
    Arrow finds equal pieces and those known already, so that Python handles each new piece once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.feed = self.whole([b"\n"])[0][0]
        spec = json.loads(self.library.to_str())
        model = spec["model"]
        self.plain = model["type"] == "BPE" and spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        }
        if self.plain:
            options = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v is not None}
            # Without the model's own memory of words: no word is sent twice.
            self.model = models.BPE(model["vocab"], [tuple(x) for x in model["merges"]], cache_capacity=0, **options)
        # Piece ``k``, and whether it was asked for since pieces were last forgotten.
        self.known, self.asked = pa.array([], pa.large_binary()), np.zeros(0, bool)
        # Ids of piece ``k``: ``sizes[k]`` of them from ``flat[starts[k]]``. Behind ``used`` there is room for more.
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, texts_: list[bytes]) -> list[list[int]]:
        found = self.library.encode_batch_fast([x.decode("utf-8") for x in texts_], add_special_tokens=False)
        return [x.ids for x in found]

    def runs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many each has, of words of letters behind a blank: the library's model without its search for runs."""
        shown = b"\n".join(words).decode("latin-1").translate(BYTE_CHARS).split(BYTE_CHARS[10]) if words else []
        ids, sizes = [], []
        for k in range(0, len(shown), SOME_WORDS):
            own = [self.model.tokenize(BYTE_CHARS[32] + x) for x in shown[k : k + SOME_WORDS]]
            ids += [token.id for tokens in own for token in tokens]
            sizes += map(len, own)
        return np.array(ids, np.int32), np.array(sizes, np.int64)

    def age(self) -> None:
        """Forget the pieces that were not asked for since the last time."""
        at = np.flatnonzero(self.asked)
        self.known, self.asked = self.known.take(pa.array(at)), np.zeros(len(at), bool)
        self.flat = self.flat[ranges(self.starts[at], self.sizes[at])]
        self.sizes, self.used = self.sizes[at], len(self.flat)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def add(self, ids: np.ndarray) -> None:
        """Append ids; ``flat`` at least doubles when it has to grow."""
        end = self.used + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(self.used, len(ids)), np.int32)])
        self.flat[self.used : end] = ids
        self.used = end

    def learn(self, new: pa.LargeBinaryArray) -> None:
        """Encode new pieces; what is known already is not touched.

        Words of letters go to the model at once, other words are encoded in one text with line feeds
        between them, the rest alone.
        """
        data, starts = text_bytes(new)
        lengths = np.diff(starts)
        first, second = data[starts[:-1]], data[np.minimum(starts[:-1] + 1, len(data) - 1)]
        words = (first == BLANK) & (lengths > 1) & ~WHITE[second]
        # A word of letters has one other byte, its blank.
        letters = words & (np.add.reduceat(~latin_letters(data), starts[:-1], dtype=np.int64) == 1)
        letters &= self.plain
        raw, bounds = data.tobytes(), starts.tolist()
        single, mixed, others = (np.flatnonzero(x) for x in (letters, words & ~letters, ~words))
        single_ids, single_sizes = self.runs([raw[bounds[k] + 1 : bounds[k + 1]] for k in single.tolist()])
        text = b"\n".join([raw[bounds[k] : bounds[k + 1]] for k in mixed.tolist()])
        ids = np.array(self.whole([text])[0] if text else [], np.int32)
        ends = np.append(np.flatnonzero(ids == self.feed), len(ids))
        if len(ends) != max(len(mixed), 1):
            raise ValueError("a line feed is not a token of its own in this vocabulary")
        alone = self.whole([raw[bounds[k] : bounds[k + 1]] for k in others.tolist()])
        parts = [
            (single, single_sizes, single_ids),
            (mixed, (np.diff(ends, prepend=-1) - 1)[: len(mixed)], ids[ids != self.feed]),
            (others, np.array([len(x) for x in alone], np.int64), np.array([i for x in alone for i in x], np.int32)),
        ]
        sizes, begins = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        for at, own, found in parts:
            sizes[at], begins[at] = own, self.used + np.cumsum(own) - own
            self.add(found)
        self.known = pa.concat_arrays([self.known, new])
        self.asked = np.append(self.asked, np.ones(len(new), bool))
        self.starts, self.sizes = np.append(self.starts, begins), np.append(self.sizes, sizes)

    def numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of every piece; those not known are learnt."""
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        # The pieces of a slice are fewer than those known, so they are the side that Arrow hashes.
        found = pc.index_in(self.known, value_set=pieces.dictionary)
        old = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        at = np.full(len(pieces.dictionary), -1, np.int64)
        at[found.drop_null().to_numpy()] = old
        self.asked[old] = True
        fresh = at < 0
        if fresh.any():
            at[fresh] = np.arange(len(self.known), len(self.known) + np.count_nonzero(fresh))
            self.learn(pieces.dictionary.filter(pa.array(fresh)))
        return at[pieces.indices.to_numpy()]

    def encode(self, raw: list[bytes]) -> list[np.ndarray]:
        if np.count_nonzero(self.asked) > CACHE:
            self.age()
        whole, pieced = [], []
        for i, x in enumerate(raw):
            if other_space(x) or any(a in x for a in self.added):
                whole.append(i)
            elif x:
                pieced.append(i)
        out = [np.zeros(0, np.int32)] * len(raw)
        if pieced:
            data = np.frombuffer(b"".join([raw[i] for i in pieced]), np.uint8)
            ends = np.cumsum([len(raw[i]) for i in pieced])
            starts = piece_starts(data, np.append(0, ends[:-1]))
            at = self.numbers(data, starts)
            sizes = self.sizes[at]
            ids = self.flat[ranges(self.starts[at], sizes)]
            cuts = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, ends[:-1])]
            for i, found in zip(pieced, np.split(ids, cuts)):
                out[i] = found
        for i, found in zip(whole, self.whole([raw[i] for i in whole]) if whole else []):
            out[i] = np.array(found, np.int32)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> CachedEncoder:
    return CachedEncoder(path)


def rank_pairs(keys: np.ndarray, inside: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs, the most frequent first, and for every position the rank of its pair (or their number).

    Pairs are counted in a hash table with one pair a slot; a pair that loses its slot waits for a
    later round.
    """
    bits = keys.dtype.itemsize * 8
    shift = bits - min((len(keys) // 2).bit_length(), 31)
    factor = keys.dtype.type(0x9E3779B97F4A7C15 >> (64 - bits) | 1)
    slot = ((keys * factor) >> keys.dtype.type(shift)).astype(np.int64)
    table = np.zeros(1 << (bits - shift), keys.dtype)
    table[slot] = keys
    own = (table.take(slot) == keys) & inside
    counts = np.bincount(slot[own], minlength=len(table))
    often = np.flatnonzero(counts >= least)
    often = often[np.argsort(-counts[often], kind="stable")][:most]
    rank = np.full(len(table), len(often), np.int32)
    rank[often] = np.arange(len(often), dtype=np.int32)
    return table[often], np.where(own, rank.take(slot), np.int32(len(often)))


def compress(ids: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of documents that lie one after the other: symbols, symbols per document, rules."""
    symbols = ids.astype(np.uint32)
    # A pair is one number, of half the width where all symbols fit into 16 bits.
    kind, bits = (np.uint32, 16) if base < MAX_SYMBOLS else (np.uint64, 32)
    # The last symbol of every document; it moves along as symbols merge.
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    rules: list[np.ndarray] = []
    made = 0
    while True:
        room = (MAX_SYMBOLS if base < MAX_SYMBOLS else 2 * base) - base - made
        if len(symbols) < 2 or room <= 0:
            break
        keys = (symbols[:-1].astype(kind) << kind(bits)) | symbols[1:]
        pairs, rank = rank_pairs(keys, ~last[:-1], MIN_COUNT, room)
        if not len(pairs):
            break
        # Where occurrences overlap the lower rank wins; of equal ones in a row, every other.
        none = len(pairs)
        good = rank < none
        good[1:] &= rank[1:] <= rank[:-1]
        good[:-1] &= rank[:-1] <= rank[1:]
        hit = np.flatnonzero(good)
        near = np.diff(hit) == 1
        if near.any():
            run = hit[np.maximum.accumulate(np.where(np.concatenate([[True], ~near]), np.arange(len(hit)), 0))]
            hit = hit[(hit - run) % 2 == 0]
        used = np.bincount(rank[hit], minlength=none) >= 4
        hit = hit[used[rank[hit]]]
        if not len(hit):
            break
        name = (np.cumsum(used) - 1 + base + made).astype(np.uint32)
        symbols[hit] = name[rank[hit]]
        last[hit] = last[hit + 1]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols, last = symbols[keep], last[keep]
        gain = len(hit) / (len(symbols) + len(hit))
        chosen = pairs[used]
        rules.append(np.column_stack([chosen >> kind(bits), chosen & kind((1 << bits) - 1)]).astype(np.uint32))
        made += len(chosen)
        if gain < LEAST_GAIN:
            break
    per_doc = np.zeros(len(lengths), np.int64)
    per_doc[lengths > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    return symbols, per_doc, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(rules: np.ndarray, sizes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids that every rule stands for, one after the other, and where each begins."""
    starts = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    flat = np.zeros(int(starts[-1]), np.uint32)
    for k, (left, right) in enumerate(rules.tolist()):
        at = starts[k]
        for symbol in (left, right):
            if symbol < base:
                flat[at] = symbol
                at += 1
            else:
                part = flat[starts[symbol - base] : starts[symbol - base + 1]]
                flat[at : at + len(part)] = part
                at += len(part)
    return flat, starts


def pack(doc_ids: np.ndarray, with_id: np.ndarray, ids: np.ndarray, lengths: np.ndarray, base: int) -> bytes:
    symbols, per_doc, rules = compress(ids, lengths, base)
    sizes = np.zeros(len(rules), np.int64)
    for k, (left, right) in enumerate(rules.tolist()):
        sizes[k] = (1 if left < base else sizes[left - base]) + (1 if right < base else sizes[right - base])
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    head = np.array([base, len(rules), len(doc_ids), len(symbols)], "<u4").tobytes()
    return b"".join([
        MAGIC, head, rules.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(),
        with_id.astype(np.uint8).tobytes(), per_doc.astype("<u4").tobytes(), symbols.astype(kind).tobytes(),
    ])


class Shard:
    """Reader of one payload with random access to its documents."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.base, n_rules, n_docs, n_symbols = np.frombuffer(payload, "<u4", 4, 4).tolist()
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.sizes = take("<u4", n_rules)
        self.doc_ids, self.with_id = take("<i8", n_docs), take("u1", n_docs).astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(take("<u4", n_docs), dtype=np.int64)])
        self.symbols = take("<u2" if self.base + n_rules <= 1 << 16 else "<u4", n_symbols)
        flat, starts = expansions(self.rules, self.sizes, self.base)
        # Ids stand for themselves: they are looked up behind the expansions.
        self._flat, self._starts = flat, starts

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some symbols, and the number of ids of each."""
        made = np.flatnonzero(symbols >= self.base)
        rule = symbols[made].astype(np.int64) - self.base
        lengths = np.ones(len(symbols), np.int64)
        lengths[made] = self.sizes[rule]
        out = np.repeat(symbols.astype("<u4"), lengths)
        to = (np.cumsum(lengths) - lengths)[made]
        out[ranges(to, lengths[made])] = self._flat[ranges(self._starts[rule], lengths[made])]
        return out, lengths

    def ids(self, k: int) -> np.ndarray:
        """All ids of document ``k`` of the shard, the end id included; no other is expanded."""
        return self.expand(self.symbols[self.starts[k] : self.starts[k + 1]])[0]

    def all_ids(self) -> list[np.ndarray]:
        """The ids of every document."""
        ids, lengths = self.expand(self.symbols)
        ends = np.concatenate([[0], np.cumsum(lengths)])[self.starts[1:]]
        return np.split(ids, ends[:-1]) if len(ends) else []


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write the shards as a Parquet table below ``folder`` (an action).

    Texts shuffle once, to the shard of their id; a task then holds one part of a shard at a time.
    """
    rows = texts(docs, id_col, text_col)
    with_id = F.col("doc_id").isNotNull()
    rows = rows.withColumn("with_id", with_id).withColumn(
        "shard", F.when(with_id, F.floor(F.col("doc_id") / SHARD_IDS)).otherwise(F.pmod(F.xxhash64("text"), F.lit(4096))).cast("long")
    )
    rows = rows.repartition("with_id", "shard").sortWithinPartitions("with_id", "shard", "doc_id")
    names = ["with_id", "shard", "part", "n_ids", "payload"]
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        end = np.array([end_id], np.int32)
        key, part, held, held_ids = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) for _, x in held], np.int64)
            ids = np.concatenate([x for _, x in held])
            payload = pack(
                np.array([i or 0 for i, _ in held], np.int64), np.array([i is not None for i, _ in held]), ids, lengths, max(bpe.size, end_id + 1)
            )
            values = [key[0], key[1], part, len(ids), payload]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch, raw in byte_slices(batches, "text", SLICE_BYTES):
            for a, b, doc_id, ids in zip(
                batch.column("with_id").to_pylist(), batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), bpe.encode(raw)
            ):
                if held and ((a, b) != key or held_ids >= PART_IDS):
                    yield flush()
                    part = part + 1 if (a, b) == key else 0
                    held, held_ids = [], 0
                key = (a, b)
                held.append((doc_id, np.concatenate([ids, end])))
                held_ids += len(ids) + 1
        if held:
            yield flush()

    shards = rows.mapInArrow(run, "with_id boolean, shard long, part int, n_ids long, payload binary")
    shards.write.option("compression", "zstd").parquet(folder)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before every part, in two levels so that no window holds all parts of a large table."""
    parts = shards.select("with_id", "shard", "part", "n_ids").withColumn("block", F.floor(F.col("shard") / 4096))
    blocks = parts.groupBy("with_id", "block").agg(F.sum("n_ids").alias("sum"))
    blocks = blocks.withColumn("before", F.sum("sum").over(W.orderBy("with_id", "block")) - F.col("sum")).drop("sum")
    inner = W.partitionBy("with_id", "block").orderBy("shard", "part")
    placed = parts.withColumn("inside", F.sum("n_ids").over(inner) - F.col("n_ids")).join(blocks, ["with_id", "block"])
    return placed.select("with_id", "shard", "part", (F.col("before") + F.col("inside")).alias("base"))


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of the shards: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids``."""
    shards = spark.read.parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            shard = Shard(batch.column("payload")[0].as_py())
            n = len(shard.doc_ids)
            ids = shard.all_ids()
            sizes = np.array([len(x) for x in ids], np.int64)
            columns = [
                pa.array(shard.doc_ids, pa.int64(), mask=~shard.with_id), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes),
                pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                *[pa.array([batch.column(c)[0].as_py()] * n, batch.column(c).type) for c in ("with_id", "shard", "part")],
            ]
            if with_ids:
                columns.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    schema = "doc_id long, inside long, n_tokens long, ids_crc32 long, with_id boolean, shard long, part int"
    schema += ", ids array<long>" * with_ids
    rows = shards.select("with_id", "shard", "part", "payload").mapInArrow(run, schema)
    rows = rows.join(shard_starts(shards), ["with_id", "shard", "part"])
    return rows.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def write_and_read(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write the shards to the shared folder and return the figures of every document from them."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, vocabulary, folder, end_id)
    return read_tokens(docs.sparkSession, folder, with_ids=False)
