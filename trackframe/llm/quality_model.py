"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Statistics and scores are computed in Arrow batches next to the data. The trees are fitted with
numpy on a bounded sample of labelled rows (``max_rows``, those with the smallest hashes of their
ids), of which only the statistics reach the driver. Fitted trees are flat arrays, and a batch of
rows walks down all of them level by level.

Nulls and empty texts count as texts without words and get a score like all others. Rows without a
label, and labels without a row, are not learnt from. Without any label every score is 0.5. A row
whose id is null is never held out. Repeated rows each get a score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackframe.llm.common import texts
from trackframe.llm.words import TextBatch, dup_lines, repeat_words, slices, sums

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
ACCEPT = 0.7

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "exclamations", "bars", "stops", "commas", "beyond_ascii",
    "distinct_words", "echoed_words", "top_word", "repeated_words", "repeated_lines", "log_lines", "words_per_line",
    "longest_word", "one_letter_words", "marked_words",
)


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_KINDS = {
    "upper": _flags(bytes(range(65, 91))), "digits": _flags(b"0123456789"), "exclamations": _flags(b"!?"),
    "bars": _flags(b"|"), "stops": _flags(b"."), "commas": _flags(b",;:"),
}


def statistics(column: pa.Array) -> np.ndarray:
    """One row of :data:`FEATURES` per text; shares are of the characters, words or lines they count."""
    batch = TextBatch(column)
    chars = np.maximum(batch.word_chars, 1)
    out = {name: sums(flags[batch.data], batch.starts) / chars for name, flags in _KINDS.items()}
    out["symbols"] = batch.symbols / chars
    out["beyond_ascii"] = sums(batch.data >= 0xC0, batch.starts) / chars
    per_text = {name: np.zeros(len(batch.raw)) for name in FEATURES if name not in out}
    for i, raw in enumerate(batch.raw):
        words, lines = raw.split(), raw.split(b"\n")
        n = max(len(words), 1)
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        per_text["log_words"][i] = np.log1p(len(words))
        per_text["word_length"][i] = batch.word_chars[i] / n
        per_text["distinct_words"][i] = len(number) / n
        per_text["echoed_words"][i] = (ids[1:] == ids[:-1]).sum() / n
        per_text["top_word"][i] = np.bincount(ids).max() / n if words else 0
        per_text["repeated_words"][i] = repeat_words(words) / n
        per_text["repeated_lines"][i] = dup_lines(lines) / len(lines)
        per_text["log_lines"][i] = np.log1p(len(lines))
        per_text["words_per_line"][i] = len(words) / len(lines)
        per_text["longest_word"][i] = np.log1p(lengths.max()) if words else 0
        per_text["one_letter_words"][i] = (lengths == 1).sum() / n
        per_text["marked_words"][i] = sum(w[-1] in b"#*$%&|<>!" for w in words) / n
    out |= per_text
    return np.column_stack([out[name] for name in FEATURES]) if len(batch.raw) else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """All trees in flat arrays; a leaf's feature is -1, its children are itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        if not len(x):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[at]
            below = x[rows, np.maximum(feature, 0)] <= self.limit[at]
            at = np.where(feature < 0, at, np.where(below, self.left[at], self.right[at]))
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 5, ridge: float = 1.0
) -> Trees:
    """Boost trees on log loss; splits are searched in histograms of gradients over quantile bins."""
    nodes: dict[str, list] = {k: [] for k in ("feature", "limit", "left", "right", "value")}

    def add(feature=-1, limit=0.0, value=0.0) -> int:
        at = len(nodes["feature"])
        for k, v in (("feature", feature), ("limit", limit), ("left", at), ("right", at), ("value", value)):
            nodes[k].append(v)
        return at

    share = np.clip(y.mean(), 0.001, 0.999) if len(y) else 0.5
    base, roots, width = float(np.log(share / (1 - share))), [], x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)] if len(x) else []
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]) if len(x) else None
    raw = np.full(len(y), base)
    for _ in range(trees if len(y) and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-raw))
        slope, bend = y - p, p * (1 - p)
        root = add()
        roots.append(root)
        open_nodes = [(root, np.arange(len(y)), 0)]
        while open_nodes:
            node, rows, level = open_nodes.pop()
            g, h = slope[rows].sum(), bend[rows].sum()
            best = (1e-6, -1, 0)
            if level < depth and len(rows) >= 2 * least:
                for j in range(width):
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, slope[rows], bins))[:-1]
                    hl = np.cumsum(np.bincount(b, bend[rows], bins))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=bins))[:-1]
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain[(nl < least) | (len(rows) - nl < least)] = -1
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
            if best[1] < 0:
                nodes["value"][node] = float(rate * g / (h + ridge))
                raw[rows] += nodes["value"][node]
                continue
            _, j, k = best
            nodes["feature"][node], nodes["limit"][node] = j, float(edges[j][k])
            under = binned[rows, j] <= k
            nodes["left"][node], nodes["right"][node] = add(), add()
            open_nodes += [(nodes["left"][node], rows[under], level + 1), (nodes["right"][node], rows[~under], level + 1)]
    arrays = {k: np.array(v, float if k in ("limit", "value") else np.int64) for k, v in nodes.items()}
    return Trees(**arrays, roots=np.array(roots, np.int64), depth=depth, base=base)


def held_out(id_col: str = "doc_id"):
    """Rows whose ids are kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = SAMPLE, **params) -> Trees:
    """Fit on at most ``max_rows`` labelled rows that are not held out (an action).

    The sample is drawn from labelled ids that have a document, one label (the smallest) an id. The ids are
    broadcast; their number is bounded by ``max_rows``. Of documents that share an id the one with the
    smallest hash of its text is learnt, so no more rows than that reach the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    known = known.where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("y").alias("y"))
    known = known.join(texts(docs).select("doc_id").distinct(), "doc_id", "left_semi")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = texts(docs).join(F.broadcast(sample), "doc_id").withColumn("h", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), batch.column("h"), pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.float64()))],
                ["doc_id", "y", "h", "x"],
            )

    found = rows.mapInArrow(run, "doc_id long, y double, h long, x array<double>")
    found = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.min_by("x", "h").alias("x")).orderBy("doc_id").toArrow()
    x = found.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit_trees(x, found.column("y").to_numpy(), **params)


def add_score(docs: DataFrame, model: Trees, name: str = "score", text_col: str = "text") -> DataFrame:
    """The rows with all their columns and a score between 0 and 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = pa.array(model.score(statistics(batch.column(text_col))))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, **params) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document."""
    scored = add_score(texts(docs), fit_quality(docs, labels, **params))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= accept).cast("int").alias("predicted"))
