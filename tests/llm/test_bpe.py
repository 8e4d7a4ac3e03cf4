import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import EDGES, frame
from trackframe.llm.bpe import MergeTable, WordBpe, encode_decode
from trackframe.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n):
    r = random.Random(1)
    return ["".join(r.choice(" \t\n\x0b\x1c aAbBéÉé'stß12½<|>|endoftext😀Σς你") for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_ids_and_decoded_equal_the_library(library):
    texts = [t or "" for _, t in EDGES] + odd_texts(800)
    bpe = WordBpe(PATH)
    for _ in range(2):  # the second time from memory
        ids = bpe.encode([t.encode() for t in texts])
        assert [x.tolist() for x in ids] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [bpe.decode(x.tolist()) for x in ids] == [library.decode(x.tolist(), skip_special_tokens=False) for x in ids]


def test_memory_is_bounded_and_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("trackframe.llm.bpe.CACHE", 5)
    bpe = WordBpe(PATH)
    for text in odd_texts(60):
        assert bpe.encode([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_merge_that_enables_an_earlier_one_is_not_done_everywhere_at_once():
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "ab", "aba"])}
    # "ab" + "a" has a lower rank than "a" + "b": of "abab", only the first "ab" is merged, then "aba".
    table = MergeTable(vocab, [("ab", "a"), ("a", "b")])
    symbols, lengths = table.merge(np.array([0, 1, 0, 1]), np.array([4]))
    assert symbols.tolist() == [4, 1] and lengths.tolist() == [2]


def test_query_shape_with_clashing_columns_and_repeated_rows(spark, library):
    rows = [*EDGES, EDGES[8], EDGES[8]]
    out = encode_decode(frame(spark, rows, clash=("ids", "decoded", "n_tokens")), PATH, ("n_tokens", "ids", "decoded")).collect()
    want = [(d, x.ids, library.decode(x.ids, skip_special_tokens=False)) for (d, _), x in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False))]
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in out), key=str) == sorted(want, key=str)
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert encode_decode(frame(spark, []), PATH).count() == 0
