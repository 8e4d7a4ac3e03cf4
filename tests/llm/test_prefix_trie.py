import hashlib
import random
import zlib

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.llm.brute import WORD
from trackframe.llm import prefix_trie
from trackframe.llm.prefix_trie import member_digests, numbered_turns, rebuilt, trie_report

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows, clash=()):
    schema = ", ".join(["conv_id long, turn long, role string, text string", *(f"{c} string" for c in clash)])
    return spark.createDataFrame([(*r, *["clash"] * len(clash)) for r in rows], schema)


def sequences(rows):
    """Conversation -> list of (role, text), by turn, null first."""
    out = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(b"%d" % c) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, own in members.items():
        below = [v for v in members if v[: len(node)] == node]
        leaf = lambda v: not any(len(u) == len(v) + 1 and u[: len(v)] == v for u in members)
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            sum(len(u) == len(node) + 1 for u in below), sum(map(leaf, below)),
            sum((len(members[v]) - 1) * len(WORD.findall(v[-1][1])) for v in below if v), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversations(seed, n, deepest):
    """Conversations that share openings of any length; some turns without role, text or number."""
    r = random.Random(seed)
    pool = [[(r.choice(["user", "assistant", None]), " ".join(r.choice("abcde") for _ in range(r.randint(0, 3))) if r.random() > 0.1 else None)
             for _ in range(deepest)] for _ in range(4)]
    rows = []
    for c in r.sample(range(300), n):
        length = r.choice([1, 2, 3, r.randint(1, deepest)])
        turns = r.choice(pool)[:length]
        if r.random() < 0.5:
            at = r.randrange(length)
            turns = turns[:at] + [("user", f"own {r.randrange(3)}")] + turns[at + 1 :]
        if r.random() < 0.3:
            turns = turns + [("user", f"tail {r.randrange(2)}")] * r.randint(1, 3)
        numbers = [None, *range(len(turns) - 1)] if r.random() < 0.3 else [3 * i - 5 for i in range(len(turns))]
        rows += [(c, t, *turn) for t, turn in zip(numbers, turns)]
    r.shuffle(rows)
    return rows


def report(spark, rows):
    out = trie_report(*rebuilt(numbered_turns(frame(spark, rows, clash=("conv", "pos", "v1", "total")).repartition(5))))
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("n", "deepest"), [(60, 3), (90, 7), (120, 21)])
def test_trie_equals_brute_force(spark, n, deepest):
    rows = conversations(n, n, deepest) + [(None, 1, "user", "nobody's")]
    assert report(spark, rows) == plain_trie(plain_rebuilt(sequences(rows)))


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(7, 50, 9)
    turns = numbered_turns(frame(spark, rows))
    convs = turns.where("pos = 0").select("conv", "total")
    got = sorted(map(tuple, trie_report(turns, convs).collect()), key=str)
    assert got == plain_trie(sequences(rows))


def test_conversations_without_turns_end_at_the_root(spark):
    """A conversation of at most h turns whose group has no opening is left without any."""
    alone = [c for c in range(1, 400) if c % 20 and zlib.crc32(b"%d" % c) % 4 == 3][:3]
    rows = [(c, i, "user", f"{c} {i}") for c in alone for i in range(3)]
    empty = hashlib.sha256(",".join(map(str, alone)).encode()).hexdigest()
    assert report(spark, rows) == [(alone[0], 0, None, 3, 0, 1, 0, empty)]
    assert report(spark, rows + [(401, 1, "a", "b c")]) == plain_trie(plain_rebuilt(sequences(rows + [(401, 1, "a", "b c")])))


def test_repeated_rows_and_empty_tables(spark):
    rows = [(4, 1, "user", "same"), (4, 1, "user", "same"), (24, 1, "user", "same"), (24, 1, "user", "same")]
    assert report(spark, rows) == plain_trie(plain_rebuilt(sequences(rows)))
    assert report(spark, []) == [] and report(spark, [(None, 1, "a", "b")]) == []


def test_long_conversations_copies_and_long_texts(spark, monkeypatch):
    """600 copies of a conversation of 300 turns, one of 5,000 turns, one turn of 2 MB."""
    long = [(8, i, "user", f"turn {i}") for i in range(5000)]
    copies = [(c, i, "user", f"copy {i}") for c in range(1000, 1600) for i in range(300)]
    text = [(9, 0, "user", "word " * 400_000)]
    monkeypatch.setattr(prefix_trie, "TURN_BITS", 4)
    turns = numbered_turns(frame(spark, long + copies + text))
    out = trie_report(turns, turns.where("pos = 0").select("conv", "total")).withColumn("k", F.col("conv_id").cast("string"))
    got = {(x.conv_id, x.depth): x for x in out.where("depth in (0, 1, 150, 300, 5000)").collect()}
    assert out.count() == 1 + 5000 + 300 + 1
    root = got[8, 0]
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (602, 3, 3, 300 * 599 * 2)
    assert got[1000, 150].saved_tokens == 151 * 599 * 2 and got[1000, 300].n_children == 0
    assert got[1000, 300].ends_sha256 == hashlib.sha256(",".join(map(str, range(1000, 1600))).encode()).hexdigest()
    assert got[9, 1].n_leaves == 1 and got[8, 5000].saved_tokens == 0


def test_plans_do_not_grow_with_depth(spark, monkeypatch):
    """The driver holds every plan: however many levels there are, each reads a few tables only."""
    scans, write = [], DataFrameWriter.parquet

    def counted(self, *args, **options):
        scans.append(self._df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    most = {}
    for deepest in (9, 150):
        scans.clear()
        turns = numbered_turns(frame(spark, [(c, i, "user", f"{min(i, 140)} {c % 2}") for c in range(3) for i in range(deepest)]))
        out = trie_report(turns, turns.where("pos = 0").select("conv", "total"))
        assert out.where("depth > 0").count() == 2 * deepest
        most[deepest] = max(scans)
    assert most[150] == most[9]


def test_digests_of_ids_in_numeric_order(spark):
    ids = [5, 40_000, 100, 3, -7, 1 << 40, 4096, 9]
    ends = spark.createDataFrame([(i, 1, 2) for i in ids], "conv long, v1 long, v2 long")
    assert member_digests(ends).first().ends_sha256 == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
