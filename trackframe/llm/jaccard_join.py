"""N-gram Jaccard join: documents linked by shared word shingles, by a grouped prefix join.

A document's set holds the 64-bit hashes of its distinct word shingles. Sets are put in one global
order, tokens that very many documents have at the end; two sets that reach the threshold then share
a token of their prefixes. Equal sets are one class, of which the smallest id goes on. Classes with
the same prefix and size form a group, and only its leader sends its prefix to the join.

Finding all pairs of a group of near copies would grow with its square, and only the linked
components are wanted. So candidates are made in three steps, which together miss no link:

1. *Stars.* In every bucket (documents with a prefix token) and group, the smallest document is the
   centre for those it could link with by size; what lies beyond gets the next star. A document goes
   on with the centre it meets most often; the pair of a bucket of two always goes on. Of each
   document's centres one is verified on whole sets, and linked documents become components.
2. *More stars.* Edited copies often miss the centre's threshold and still link with each other. In
   buckets that hold several components and more members than a few, with groups expanded, some members
   drawn by a hash are centres for all others of other components; drawn alike in all buckets, so pairs
   stay few. This leaves most of a large cluster in one component at linear cost.
3. *The rest.* The other pairs of the first step, and all pairs in buckets that still hold several
   components, with the members of groups expanded, as far as they lie in different components. Of a
   bucket of two, whose leaders were a pair before, only the groups go on, once for all their buckets,
   and only if one of them has more members. Documents of one component need no more pairs.

Before whole sets are compared, pairs are pruned by size and by an upper bound of the overlap from
histograms of the sets: first of 256 cells, then of as many that a cell holds a few tokens. All are
exact bounds: they drop only pairs that can't link.

Verification sends every member's set to the task of its star's centre, where the centre's set waits
and members stream by; a large star is dealt out over several tasks.

Null and empty texts have an empty set and link with nothing, as do rows without an id, whose
component is null. Rows that share an id count as one document with all their texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackframe.llm.common import components, mixed, texts
from trackframe.llm.words import slices
from trackframe.session import stage

WIDTH, PERCENT = 4, 85
# Tokens of at least this share of all documents (and this many) go to the end of the order. There are
# at most as many of them as a document has shingles on average, times a thousand: a bounded list.
OFTEN_SHARE, OFTEN_LEAST = 0.001, 64
CELL_BITS = 8
CELLS = 1 << CELL_BITS
# Members that a task gets of a star; rows that it holds of one bucket before it goes on with the centre alone.
STAR, HELD = 256, 50_000
# Centres drawn in a bucket before all pairs of what is left; buckets of up to twice as many members are left to that.
CENTRES = 8
# Words that a worker keeps the hashes of, and texts whose words it holds at a time.
WORD_CACHE, TOGETHER = 200_000, 256
PART_BYTES = 32 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Words(dict):
    """64 bits for every word, kept while the worker lives."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def shingle_sets(texts_: list[bytes], width: int) -> list[np.ndarray]:
    """Of every text the sorted distinct hashes of its shingles; the whole of a shorter text is one.

    The words of some texts lie one after the other, so each step over a shingle is one for them all.
    """
    if len(texts_) > TOGETHER:
        return [s for i in range(0, len(texts_), TOGETHER) for s in shingle_sets(texts_[i : i + TOGETHER], width)]
    words = [raw.translate(_LOWER).split() for raw in texts_]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter(map(_words.__getitem__, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    ends = np.cumsum(counts)

    def rolled(h: np.ndarray, span: int) -> np.ndarray:
        out = np.full(max(len(h) - span + 1, 0), span, np.uint64)
        for k in range(span):
            out = (out ^ h[k : len(h) - span + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return mixed(out)

    long = rolled(h, width)
    return [
        _distinct(long[end - n : end - width + 1]) if n >= width else rolled(h[end - n : end], n) if n else h[:0]
        for end, n in zip(ends.tolist(), counts.tolist())
    ]


def prefix(tokens: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of the global order, as many as a linked set must share one of."""
    n = len(tokens)
    size = n - (percent * n + 99) // 100 + 1
    if not len(often):
        return tokens[:size]
    at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
    late = often[at] == tokens
    return np.concatenate([tokens[~late], tokens[late]])[:size]


def cells(tokens: np.ndarray) -> np.ndarray:
    """Histogram of a set by its leading bits, saturated."""
    return np.minimum(np.bincount((tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8)


def fine_cells(tokens: np.ndarray) -> np.ndarray:
    """Histogram with a power of two of cells, four to eight tokens each; of small sets as :func:`cells`."""
    bits = min(max(int(len(tokens)).bit_length() - 3, CELL_BITS), 16)
    found = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(found, 255).astype(np.uint8)


def may_link_finely(n: int, m: int, left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """As :func:`may_link` for one pair; neighbouring cells of the finer histogram are added up."""
    left, right = left.astype(np.int64), right.astype(np.int64)
    if len(left) > len(right):
        left = left.reshape(len(right), -1).sum(axis=1)
    elif len(right) > len(left):
        right = right.reshape(len(left), -1).sum(axis=1)
    most = int(np.minimum(left, right).sum()) + min(n - int(left.sum()), m - int(right.sum()))
    return 100 * most >= percent * (n + m - most)


def may_link(n: np.ndarray, m: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sets with these sizes and histograms can reach the threshold."""
    a, b = left.sum(axis=1, dtype=np.int64), right.sum(axis=1, dtype=np.int64)
    most = np.minimum(left, right).sum(axis=1, dtype=np.int64) + np.minimum(n - a, m - b)
    return 100 * most >= percent * (n + m - most)


def parts(batches: Iterator[pa.RecordBatch], size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, those of more than ``size`` bytes in equal parts."""
    for batch in batches:
        if batch.num_rows:
            yield from slices([batch], max(1, batch.num_rows // (1 + batch.nbytes // size)))


def often_tokens(rows: DataFrame, width: int) -> np.ndarray:
    """Tokens of a large share of all documents (an action).

    Each batch reports tokens that half that share of its own documents have, so every token with
    twice the share overall is reported often enough; the order is the same for all documents,
    whichever tokens are in it.
    """
    least = max(OFTEN_LEAST, int(rows.count() * OFTEN_SHARE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), width)
            least_here = max(2, int(len(sets) * OFTEN_SHARE / 2))
            tokens = np.concatenate(sets)
            del sets
            tokens.sort()
            begins = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
            counts = np.diff(np.append(begins, len(tokens)))
            some = counts >= least_here
            tokens = tokens[begins]
            yield pa.RecordBatch.from_arrays([pa.array(tokens[some].view(np.int64)), pa.array(counts[some].astype(np.int64))], ["token", "n"])

    found = rows.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return np.sort(found.where(F.col("n") >= least).select("token").toArrow().column("token").to_numpy().view(np.uint64))


def document_sets(rows: DataFrame, often: np.ndarray, width: int, percent: int) -> DataFrame:
    """Size, digest, group and histogram of every document's set."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for tokens in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), width):
                whole = xxhash.xxh3_128_digest(tokens.tobytes())
                group = xxhash.xxh3_64_digest(prefix(tokens, often, percent).tobytes(), seed=len(tokens))
                for column, value in zip(out, (len(tokens), whole[:8], whole[8:], group, cells(tokens).tobytes(), fine_cells(tokens).tobytes())):
                    column.append(value)
            longs = [pa.array(np.frombuffer(b"".join(x), np.int64)) for x in out[1:4]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), *longs, *(pa.array(x, pa.binary()) for x in out[4:])],
                ["doc_id", "n", "h1", "h2", "g", "cells", "fine"],
            )

    return rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, g long, cells binary, fine binary")


def prefix_tokens(rows: DataFrame, often: np.ndarray, width: int, percent: int) -> DataFrame:
    """Prefix tokens of the leaders: ``token``, ``n``, ``g``, ``doc``; a batch sends a group's once."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            seen: dict[bytes, tuple[int, int, np.ndarray]] = {}
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), width)):
                if not len(tokens):
                    continue
                own = prefix(tokens, often, percent).copy()
                key = xxhash.xxh3_64_digest(own.tobytes(), seed=len(tokens))
                if key not in seen or doc < seen[key][0]:
                    seen[key] = (doc, len(tokens), own)
            lengths = [len(x[2]) for x in seen.values()]
            group = np.frombuffer(b"".join(seen), np.int64)
            columns = [np.concatenate([x[2] for x in seen.values()]).view(np.int64) if seen else group]
            columns += [np.repeat(np.array(x, np.int64), lengths) for x in ([v[1] for v in seen.values()], group, [v[0] for v in seen.values()])]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["token", "n", "g", "doc"])

    return rows.where(F.col("doc_id").isNotNull()).mapInArrow(run, "token long, n long, g long, doc long")


# Kinds of rows that buckets give: the pair of a bucket of two groups, and its groups; a star's pair in a
# larger bucket, and its rows.
PAIR, TWO, STAR_PAIR, MANY = 0, 1, 2, 3


def stars(tokens: DataFrame, percent: int) -> DataFrame:
    """``kind, x, y``: pairs (centre, member), and for the second round the rows of buckets (token, group) or two groups."""
    rows = tokens.repartition("token").sortWithinPartitions("token", "n", "g", "doc")

    def pairs(n: np.ndarray, doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows are sorted by bucket and size; each star takes the sizes its centre can link with."""
        left, right, at = [], [], np.arange(len(n))
        while len(at):
            begins = np.concatenate([[True], bucket[at][1:] != bucket[at][:-1]])
            centre = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
            near = 100 * n[centre] >= percent * n[at]
            some = near & (centre != at)
            left.append(doc[centre[some]])
            right.append(doc[at[some]])
            at = at[~near]
        return np.concatenate(left) if left else doc[:0], np.concatenate(right) if right else doc[:0]

    def emit(token: np.ndarray, n: np.ndarray, g: np.ndarray, doc: np.ndarray, sent: bool) -> pa.RecordBatch:
        """Whole buckets, or the next part of one whose centre, in front, was ``sent`` before."""
        begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.repeat(np.diff(np.append(begins, len(token))), np.diff(np.append(begins, len(token))))
        several = size > 1
        token, n, g, doc, size = token[several], n[several], g[several], doc[several], size[several]
        large = (size > 2) | sent
        many = np.flatnonzero(large)[1 if sent else 0 :]
        kinds, left, right = [np.full(len(many), MANY)], [token[many]], [g[many]]
        for kind, rows, value in ((PAIR, ~large, doc), (TWO, ~large, g), (STAR_PAIR, large, doc)):
            both = np.stack(pairs(n[rows], value[rows], token[rows]))
            both = np.unique(both, axis=1) if both.shape[1] else both
            kinds.append(np.full(both.shape[1], kind))
            left.append(both[0])
            right.append(both[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(kinds).astype(np.int32)), pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["kind", "x", "y"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sent = [np.zeros(0, np.int64)] * 4, False
        for batch in batches:
            now = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            token, n, g, _ = now
            if not len(token):
                continue
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (g[1:] != g[:-1])])
            now = [x[new] for x in now]
            token = now[0]
            cut = int(np.searchsorted(token == token[-1], True))  # the last bucket may go on
            if cut:
                first = int(np.searchsorted(token != token[0], True)) if sent else 0
                if sent and first > 1:
                    yield emit(*(x[:first] for x in now), True)
                yield emit(*(x[first:cut] for x in now), False)
                now, sent = [x[cut:] for x in now], False
            if len(now[0]) > HELD:
                yield emit(*now, sent)
                # The largest centre goes on; sizes it can't link with start a star of their own.
                now, sent = [x[-1:] for x in now], True
            held = now
        if len(held[0]) > 1:
            yield emit(*held, sent)

    return rows.mapInArrow(run, "kind int, x long, y long")


def prune(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs that sizes and histograms let link."""
    own = classes.select("rep", "n", "cells")
    a, b = own.toDF("a", "n_a", "cells_a"), own.toDF("b", "n_b", "cells_b")
    rows = pairs.where("a <> b").distinct().join(a, "a").join(b, "b")
    rows = rows.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CELLS) for c in ("cells_a", "cells_b"))
            good = may_link(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), left, right, percent)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[good]) for c in ("a", "b")], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def refine(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that fine histograms let link."""
    own = classes.select("rep", "n", "fine")
    rows = pairs.join(own.toDF("a", "n_a", "fine_a"), "a").join(own.toDF("b", "n_b", "fine_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells_of = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "fine_a", "fine_b")]
            good = np.fromiter(
                (may_link_finely(n, m, np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), percent) for n, m, x, y in zip(*cells_of)),
                bool, batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[good]) for c in ("a", "b")], ["a", "b"])

    return rows.select("a", "b", "n_a", "n_b", "fine_a", "fine_b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose whole sets reach the threshold.

    ``pairs`` is a staged table: if it is small by its size on disk, Spark broadcasts the ids to the
    texts; otherwise texts shuffle once to the ids.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    salt = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    members = pairs.join(sizes, "a").select(F.col("b").alias("doc_id"), F.col("a").alias("centre"), salt.alias("salt"))
    centres = members.select(F.col("centre").alias("doc_id"), "centre", "salt").distinct()
    wanted = stage(members.unionByName(centres).groupBy("doc_id").agg(F.collect_list(F.struct("centre", "salt")).alias("stars")), "stars")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            out: list[list] = [[], [], [], [], []]
            found = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), width)
            for doc, own, stars_ in zip(batch.column("doc_id").to_pylist(), found, batch.column("stars").to_pylist()):
                tokens = own.tobytes()
                for star in stars_:
                    for column, value in zip(out, (star["centre"], star["salt"], int(doc != star["centre"]), doc, tokens)):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["centre", "salt", "member", "doc", "tokens"])

    found = rows.join(wanted, "doc_id").select("doc_id", "text", "stars").mapInArrow(sets, "centre long, salt int, member int, doc long, tokens binary")
    found = found.repartition("centre", "salt").sortWithinPartitions("centre", "salt", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, []
        for batch in batches:
            left, right = [], []
            tokens = batch.column("tokens")
            for i, (a, member, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("centre", "member", "doc")))):
                text = np.frombuffer(tokens[i].as_buffer(), np.uint64)
                if not member:
                    own = [*own, text] if a == centre else [text]
                    centre = a
                    continue
                for mine in own if a == centre else []:
                    at = np.minimum(np.searchsorted(mine, text), len(mine) - 1)
                    common = int((mine[at] == text).sum())
                    if 100 * common >= percent * (len(mine) + len(text) - common):
                        left.append(a)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return found.mapInArrow(compare, "a long, b long")


def drawn_stars(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (centre, member) of different components, for ``CENTRES`` rows of each bucket: rows as for :func:`across`.

    Centres are the first by a hash of their id; they come first, and the other members stream by.
    """
    ordered = rows.repartition("bucket").withColumn("key", F.xxhash64("rep")).sortWithinPartitions("bucket", "key", "rep").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy() for i in range(4)]
            now.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, CELLS))
            old = 0 if held is None else len(held[0])
            bucket, n, rep, comp, hist = now if held is None else (np.concatenate(x) for x in zip(held, now))
            begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            first = np.repeat(begins, np.diff(np.append(begins, len(bucket))))
            at = np.arange(len(bucket))
            for k in range(CENTRES):
                j = np.flatnonzero((at - first > k) & (at >= old))
                i = first[j] + k
                near = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                i, j = i[near], j[near]
                good = may_link(n[i], n[j], hist[i], hist[j], percent)
                yield pa.RecordBatch.from_arrays([pa.array(rep[i[good]]), pa.array(rep[j[good]])], ["a", "b"])
            held = [x[begins[-1] : begins[-1] + CENTRES] for x in (bucket, n, rep, comp, hist)]

    return ordered.mapInArrow(run, "a long, b long")


def across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components within a bucket: rows ``bucket, n, rep, comp, cells``."""
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "n", "rep")

    def bucket_pairs(n: np.ndarray, rep: np.ndarray, comp: np.ndarray, hist: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, 1_000_000 // len(n))
        for start in range(0, len(n), step):
            mine = np.arange(start, min(start + step, len(n)))
            to = int(np.searchsorted(n, 100 * n[mine[-1]] // percent, "right"))
            other = np.arange(start, to)
            open_pairs = (comp[mine][:, None] != comp[other]) & (other > mine[:, None]) & (100 * n[mine][:, None] >= percent * n[other])
            i, j = np.nonzero(open_pairs)
            i, j = mine[i], other[j]
            for part in range(0, len(i), 50_000):
                a, b = i[part : part + 50_000], j[part : part + 50_000]
                good = may_link(n[a], n[b], hist[a], hist[b], percent)
                if good.any():
                    yield pa.RecordBatch.from_arrays([pa.array(rep[a[good]]), pa.array(rep[b[good]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(4)]
            now.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, CELLS))
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            begins = np.flatnonzero(np.concatenate([[True], now[0][1:] != now[0][:-1]]))
            for a, b in zip(begins[:-1], begins[1:]):
                if b - a > 1:
                    yield from bucket_pairs(*(x[a:b] for x in now[1:]))
            held = [x[begins[-1] :] for x in now]
        if held is not None and len(held[0]) > 1:
            yield from bucket_pairs(*held[1:])

    return ordered.mapInArrow(run, "a long, b long")


def with_components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Every class with its component under the links so far: ``rep``, ``n``, ``g``, ``cells``, ``comp``."""
    known = classes.select("rep", "n", "g", "cells").join(components(links), F.col("rep") == F.col("node"), "left")
    return stage(known.select("rep", "n", "g", "cells", F.coalesce("component", "rep").alias("comp")), "members")


def open_members(found: DataFrame, known: DataFrame, least: int = 0) -> DataFrame:
    """Rows ``bucket, n, rep, comp, cells``: members of buckets with several components and more than ``least`` members."""
    groups = stage(known.groupBy("g").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members")), "groups")
    loose = groups.where("low < high").select("g")
    many = found.where(F.col("kind") == MANY).select(F.col("x").alias("bucket"), F.col("y").alias("g"))
    two = found.where(F.col("kind") == TWO).select("x", "y").distinct()
    for side in ("x", "y"):
        two = two.join(groups.toDF(side, f"low_{side}", f"high_{side}", f"members_{side}"), side)
    two = two.where("least(low_x, low_y) < greatest(high_x, high_y) and greatest(members_x, members_y) > 1")
    two = two.select(F.xxhash64("x", "y").alias("bucket"), F.explode(F.array("x", "y")).alias("g"))
    buckets = many.unionByName(two).unionByName(loose.select(F.col("g").alias("bucket"), "g"))
    buckets = buckets.join(groups, "g")
    mixed_ones = buckets.groupBy("bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("members").alias("size"))
    mixed_ones = mixed_ones.where((F.col("low") < F.col("high")) & (F.col("size") > least)).select("bucket")
    return buckets.join(mixed_ones, "bucket", "left_semi").select("bucket", "g").join(known, "g").select("bucket", "n", "rep", "comp", "cells")


def near_documents(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest linked id) of every document."""
    rows = texts(docs, id_col, text_col)
    often = often_tokens(rows, width)
    sets = stage(document_sets(rows, often, width, percent), "sets")
    classes = sets.where("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("g").alias("g"), F.first("cells").alias("cells"), F.first("fine").alias("fine")
    )
    classes = stage(classes, "classes")
    found = stage(stars(prefix_tokens(rows, often, width, percent), percent), "buckets")
    leaders = classes.groupBy("g").agg(F.min("rep").alias("a"), F.count("*").alias("members")).where("members > 1")
    inside = classes.select("g", F.col("rep").alias("b")).join(leaders, "g").where("a <> b").select("a", "b")
    twos = found.where(F.col("kind") == PAIR).select(F.col("x").alias("a"), F.col("y").alias("b"))
    met = found.where(F.col("kind") == STAR_PAIR).groupBy("x", "y").agg(F.count("*").alias("n"))
    centres = met.groupBy(F.col("y").alias("b")).agg(F.max_by("x", F.struct("n", -F.col("x"))).alias("a"))
    first = twos.unionByName(centres).unionByName(inside)
    candidates = stage(refine(prune(first, classes, percent), classes, percent), "candidates")
    nearest = stage(candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest")
    links = stage(verify(nearest, rows, width, percent), "links")

    expanded = open_members(found, with_components(classes, links), 2 * CENTRES)
    drawn = stage(drawn_stars(expanded, percent).distinct(), "drawn")
    tries = stage(refine(drawn, classes, percent), "tries")
    links = stage(links.unionByName(verify(tries, rows, width, percent)), "links")

    # What still lies in different components, with the members of groups.
    known = with_components(classes, links)
    expanded = open_members(found, known)
    comp = known.select("rep", "comp")
    others = candidates.join(nearest, ["a", "b"], "left_anti").join(comp.toDF("a", "comp_a"), "a").join(comp.toDF("b", "comp_b"), "b")
    others = others.where("comp_a <> comp_b").select("a", "b")
    more = stage(across(expanded, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "across")
    rest = stage(refine(more, classes, percent).unionByName(others).distinct(), "rest")
    links = links.unionByName(verify(rest, rows, width, percent))

    linked = components(links)
    per_class = classes.join(linked, F.col("rep") == F.col("node"), "left").select("h1", "h2", "n", F.coalesce("component", "rep").alias("component"))
    out = sets.where("n > 0 and doc_id is not null").join(per_class, ["h1", "h2", "n"]).select("doc_id", "n", "component")
    alone = sets.where("not (n > 0 and doc_id is not null)").select("doc_id", "n", F.col("doc_id").alias("component"))
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
