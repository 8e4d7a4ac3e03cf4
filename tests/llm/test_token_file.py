import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import EDGES, frame
from trackframe.llm import token_file
from trackframe.llm.queries import vocabulary
from trackframe.session import scratch_path

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n):
    r = random.Random(2)
    alphabet = "  \t\n\x0b\x1c  aAbBéÉé'stß12½<|>|endoftext😀Σς你.,!×÷　"
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("cache", [1_000_000, 7])
def test_cached_ids_equal_the_library(library, monkeypatch, cache):
    monkeypatch.setattr(token_file, "CACHE", cache)
    texts = [t or "" for _, t in EDGES] + odd_texts(2000)
    encoder = token_file.CachedEncoder(PATH)
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        ids = [x.tolist() for x in encoder.encode([t.encode() for t in part])]
        assert ids == [x.ids for x in library.encode_batch(part, add_special_tokens=False)]


def test_words_of_letters_go_to_the_model_once(library, monkeypatch):
    """Only other pieces are searched for token runs; words asked for again, or by another text, are looked up."""
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCÀÉÖØßäéöøÿ"
    words = ["".join(r.choice(letters) for _ in range(r.randint(1, 12))) for _ in range(500)]
    texts = [" ".join(r.choice(words) + r.choice(["", "", ",", "..."]) for _ in range(300)) for _ in range(40)]
    encoder, searched, whole, runs = token_file.CachedEncoder(PATH), [], token_file.CachedEncoder.whole, getattr(token_file.CachedEncoder, "runs", None)
    sent = []
    monkeypatch.setattr(token_file.CachedEncoder, "whole", lambda self, x: searched.extend(x) or whole(self, x))
    monkeypatch.setattr(token_file.CachedEncoder, "runs", lambda self, x: sent.extend(x) or runs(self, x), raising=False)
    ids = [x.tolist() for x in encoder.encode([t.encode() for t in texts[:30]])]
    ids += [x.tolist() for x in encoder.encode([t.encode() for t in texts[30:]])]
    assert ids == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    # First words, which have no blank before them, and punctuation.
    assert sum(map(len, searched)) < 40 * 16 + 100
    assert len(sent) == len(set(sent)) <= 500


def test_pieces_are_kept_without_the_punctuation_and_line_feeds_beside_them(library):
    """A word is encoded once however it is written, so what is kept grows with the words, not with their surroundings."""
    r = random.Random(8)
    words = sorted({"".join(r.choice("abcdeéßü") for _ in range(r.randint(3, 9))) for _ in range(200)})
    marks = [",", ".", "...", "!?", ":)", '"', "'"]
    texts = ["".join(f"{r.choice(words)}{m}{r.choice([' ', chr(10)])}" for m in marks * 60).strip() for _ in range(30)]
    encoder = token_file.CachedEncoder(PATH)
    assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    # With a blank before them and without; the marks and the line feed.
    assert len(encoder.known) <= 2 * len(words) + len(marks) + 1


def test_cuts_keep_contractions_runs_of_white_space_and_text_borders(library):
    parts = ["a", "É", "ß×", "x's", "'s", "'", "''ll", "1", "½", ",", "?!", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x0b ", "你", "\x1c", "#a#", "é."]
    r = random.Random(11)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(5000)]
    encoder = token_file.CachedEncoder(PATH)
    ids = [x.tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert ids == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("base", [300, 65_530, 70_000])
def test_grammar_round_trip_with_random_access(base):
    r = np.random.default_rng(3)
    docs = [r.integers(0, 6, n) for n in (0, 1, 5000, 0, 3, 800)] + [np.zeros(700, np.int64), np.tile([1, 2, 3], 400)]
    ids, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    payload = token_file.pack(np.arange(len(docs)), np.ones(len(docs), bool), ids, lengths, base)
    shard = token_file.Shard(payload)
    for k in (7, 2, 0, 6, 5, 4, 3, 1):
        assert shard.ids(k).tolist() == docs[k].tolist()
    assert [x.tolist() for x in shard.all_ids()] == [d.tolist() for d in docs]
    # Where 16 bits leave room for six symbols only, there are no more rules.
    assert len(shard.rules) == 6 if base == 65_530 else len(shard.symbols) < len(ids) / 2


def expected(library, rows, end=0):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


@pytest.mark.parametrize("part_ids", [2_000_000, 500])
def test_files_hold_all_documents_in_order(spark, library, monkeypatch, part_ids):
    monkeypatch.setattr(token_file, "PART_IDS", part_ids)
    rows = [r for r in EDGES if r[0] is not None] + [(i * 700, t) for i, t in enumerate(odd_texts(40))] + [(-5, "before zero"), (906, None)]
    folder = scratch_path(spark, "tokens")
    token_file.write_tokens(frame(spark, rows, clash=("shard", "part", "with_id")), PATH, folder)
    got = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32, r.ids) for r in token_file.read_tokens(spark, folder).collect())
    want = expected(library, rows)
    assert [x[2] for x in got] == [x[0] for x in want]
    assert sorted((x[2], x[1], x[3]) for x in got) == sorted((x[0], x[2], x[3]) for x in want)
    # Without gaps or overlaps, in order of the ids.
    assert [x[0] for x in got] == list(np.cumsum([0, *(x[1] for x in got)])[:-1])


def test_rows_without_id_come_first_and_empty_tables_have_no_rows(spark, library):
    rows = [(7, "b"), (None, "a a"), (None, None)]
    out = token_file.write_and_read(frame(spark, rows), PATH).collect()
    assert sorted(r.start for r in out if r.doc_id is None)[0] == 0
    assert max(out, key=lambda r: r.start).doc_id == 7 and len(out) == 3
    assert token_file.write_and_read(frame(spark, []), PATH).count() == 0
