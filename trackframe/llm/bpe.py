"""BPE encoding and decoding with word ends, by batched numpy merge rounds.

The vocabulary file is one of the ``tokenizers`` library's. Texts are cut at ASCII white space,
which no token spans; what is left is normalised and split into words by the rules of the file, and
every distinct word is merged once per worker. For merging, the symbols of many words lie in one
flat array. A round looks up all neighbouring pairs by binary search in the sorted pair keys, takes
the lowest rank of every word, and joins those pairs in all words at once.

Nulls and empty texts give no ids. Rows are handled one by one: repeated rows and ids stay, other
columns are not read. A worker keeps at most ``CACHE`` pieces of text in memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackframe.llm.common import ranges, texts

CACHE = 400_000
NONE = np.iinfo(np.int64).max

OUTPUTS = {
    "ids": "ids array<int>",
    "decoded": "decoded string",
    "n_tokens": "n_tokens long",
    "ids_sha256": "ids_sha256 string",
    "decoded_sha256": "decoded_sha256 string",
}


class MergeTable:
    """Pairs that merge: sorted keys with rank and result, for symbols named by vocabulary ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.width = max(vocab.values(), default=0) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        ranks = np.arange(len(merges), dtype=np.int64)
        # A result that could merge on at a lower rank forbids joining all equal pairs at once.
        first_use = np.full(self.width, NONE)
        np.minimum.at(first_use, left, ranks)
        np.minimum.at(first_use, right, ranks)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], ranks[order], made
        self.at_once = first_use[made] > ranks if len(merges) else np.zeros(0, bool)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and lengths of words, given as one flat array of their first symbols."""
        n = len(lengths)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        word = np.repeat(np.arange(n), lengths)
        symbols = symbols.astype(np.int64)
        while len(symbols):
            same = word[:-1] == word[1:]
            rank = np.full(len(symbols), NONE)
            rank[:-1][same] = self.rank(symbols[:-1][same], symbols[1:][same])
            begins = np.flatnonzero(np.concatenate([[True], ~same]))
            span = np.diff(np.append(begins, len(symbols)))
            low = np.minimum.reduceat(rank, begins)
            open_word = low < NONE
            if not open_word.all():
                shut = np.repeat(~open_word, span)
                out.append((word[shut], symbols[shut]))
                keep = ~shut
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                span, low = span[open_word], low[open_word]
                if not len(symbols):
                    break
            begins = np.cumsum(span) - span
            hit = rank == np.repeat(low, span)
            at = np.flatnonzero(hit)
            # Left to right without overlap: in a run of hits, every other one.
            fresh = np.concatenate([[True], np.diff(at) > 1])
            run = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            at = at[(at - run) % 2 == 0]
            alone = ~self.at_once[rank[at]]
            if alone.any():
                first = np.concatenate([[True], word[at][1:] != word[at][:-1]])
                at = at[~alone | first]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        words = np.concatenate([w for w, _ in out]) if out else np.zeros(0, np.int64)
        flat = np.concatenate([s for _, s in out]) if out else np.zeros(0, np.int64)
        order = np.argsort(words, kind="stable")
        return flat[order], np.bincount(words, minlength=n).astype(np.int64)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


# Normalised pieces of these characters are cut here; all others by the library's own splitter.
LETTERS = "a-z\u00e0-\u00f6\u00f8-\u024f"
PLAIN = re.compile(f"[!-~{LETTERS}]*")
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")


class WordBpe:
    """Encoder and decoder for a vocabulary with word ends, splitting rules and no decoder of its own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        rules = Tokenizer.from_file(path)
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.table = MergeTable(vocab, [tuple(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]])
        self.names: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        self.numbers = [str(i) for i in range(len(self.names))]
        symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.inner = np.array([vocab[c] for c in symbols], np.int64)
        self.last = np.array([vocab[c + suffix] for c in symbols], np.int64)
        self.forget()

    def forget(self) -> None:
        """Start the memory of pieces anew: piece to number, ids of all pieces, where each begins."""
        self.known: dict[bytes, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words, merged together."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols, ends = self.inner[data], np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        return self.table.merge(symbols, lengths)

    def cut_words(self, text: str) -> list[bytes]:
        """Words of a normalised piece of text, as bytes."""
        if PLAIN.fullmatch(text):
            return [w.encode("utf-8") for w in WORDS.findall(text)]
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.split(text)]

    def learn(self, pieces: list[bytes]) -> None:
        """Add the ids of pieces of text without ASCII white space."""
        plain = b" ".join(pieces).decode("utf-8")
        normal = self.normalize(plain).split(" ") if not self.cut.search(plain) else []
        if len(normal) != len(pieces):  # an added token, or other white space, in a piece
            normal = [None] * len(pieces)
        index: dict[bytes, int] = {}
        special: dict[int, int] = {}
        wanted, counts = [], []
        for piece, text in zip(pieces, normal):
            before = len(wanted)
            for part in [text] if text is not None else self.cut.split(piece.decode("utf-8")):
                if part in self.special:
                    # Negative numbers stand for added tokens, behind the words.
                    special[-1 - self.special[part]] = self.special[part]
                    wanted.append(-1 - self.special[part])
                else:
                    for word in self.cut_words(part if text is not None else self.normalize(part)):
                        wanted.append(index.setdefault(word, len(index)))
            counts.append(len(wanted) - before)
        flat, lengths = self.words(list(index)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        places = {k: len(index) + i for i, k in enumerate(special)}
        flat = np.concatenate([flat, np.array([*special.values()], np.int64)])
        lengths = np.concatenate([lengths, np.ones(len(special), np.int64)])
        at = np.array([places[w] if w < 0 else w for w in wanted] if special else wanted, np.int64)
        starts = np.cumsum(lengths) - lengths
        ids = flat[ranges(starts[at], lengths[at])] if len(at) else flat[:0]
        sums = np.concatenate([[0], np.cumsum(lengths[at])])
        ends = sums[np.cumsum(np.array(counts, np.int64))]
        for number, piece in enumerate(pieces, len(self.known)):
            self.known[piece] = number
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])

    def encode(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts, given as UTF-8."""
        split = [x.split() for x in raw]
        if len(self.known) > CACHE:
            self.forget()
        new = list({p for pieces in split for p in pieces if p not in self.known})
        if new:
            self.learn(new)
        known, out = self.known, []
        for pieces in split:
            at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            out.append(self.flat[ranges(self.starts[at], self.starts[at + 1] - self.starts[at])])
        return out

    def decode(self, ids: list[int]) -> str:
        """Names of the ids, joined as the library does where a file states no decoder."""
        return " ".join([self.names[i] for i in ids])


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    return WordBpe(path)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_decode(
    docs: DataFrame, path: str, outputs: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text and decode its ids again; one row per document, without a shuffle.

    ``outputs`` chooses among :data:`OUTPUTS`: ids, decoded text, number of ids, and digests of both.
    ``path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        numbers = bpe.numbers
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                encoded = bpe.encode(batch.column("text").cast(pa.binary()).to_pylist())
                columns: dict[str, list] = {name: [] for name in outputs}
                for row in encoded:
                    ids = row.tolist()
                    if "ids" in columns:
                        columns["ids"].append(ids)
                    if "n_tokens" in columns:
                        columns["n_tokens"].append(len(ids))
                    if "ids_sha256" in columns:
                        columns["ids_sha256"].append(_digest(" ".join([numbers[i] for i in ids])))
                    if "decoded" in columns or "decoded_sha256" in columns:
                        text = bpe.decode(ids)
                        if "decoded" in columns:
                            columns["decoded"].append(text)
                        if "decoded_sha256" in columns:
                            columns["decoded_sha256"].append(_digest(text))
                kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(columns[n], kinds.get(n, pa.string())) for n in outputs)],
                    ["doc_id", *outputs],
                )

    schema = ", ".join(["doc_id long", *(OUTPUTS[n] for n in outputs)])
    return texts(docs, id_col, text_col).mapInArrow(run, schema)
