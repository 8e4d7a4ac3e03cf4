"""The trie of all prefixes of conversations, built by halving sequences (van Emde Boas recursion).

Sequences of turns are cut at half of the block length, from the longest power of two down to single
turns. At a cut each distinct prefix gets a name, and the problem falls into two of half the depth: the
*upper trie* of the distinct cut prefixes, where one sequence stands for all that share its prefix and
carries how many they are, and the *lower forests*, where what follows the cut is grouped by the
prefix's name. All subproblems of a level are solved together, as rows of one table, so a trie of depth
``D`` takes ``log2 D`` rounds (:func:`cut`). Blocks of one turn are the nodes.

Totals of subtrees go back up in the same order: the forest below a cut prefix is summed up and grafted
onto the nodes of the upper trie that lie on the prefix's path (:func:`prefix_trie`). The path is read
from the sequence that stands for the prefix; turns that another sequence stood for take its names.

Rows carry 128 bits of hash instead of texts. A prefix is named by the exclusive or of hashes of its
turns with their places, which is summed before any shuffle; so no conversation and no group of copies
is ever gathered, and hot keys only meet joins against unique keys, which adaptive execution splits.

Nulls: a turn without a number comes first, null role or text is empty, rows without a conversation id
belong to no conversation and are left out. Ties: turns of one number are ordered by their hash. Repeated
rows are turns of their own. Very long texts are hashed where they are read. An empty table has no nodes.
Only the four named columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.operators.position import number_rows
from trackframe.session import stage, staged_path

WORD = r"[^\x20\x09-\x0D]+"
# Turn numbers that share a bucket when turns are counted: 2^8; ids whose digests are joined together: 2^12.
TURN_BITS, ID_BITS = 8, 12
NAME, PARENT = ["v1", "v2"], ["g1", "g2"]


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 0), ``total`` turns, 128 bits of hash and the words of every turn."""
    own = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.xxhash64(*own).alias("h1"),
        F.xxhash64(F.lit("second"), *own).alias("h2"),
        F.regexp_count(own[1], F.lit(WORD)).cast("long").alias("words"),
    )
    rows = rows.withColumn("bucket", F.coalesce(F.shiftright("turn", TURN_BITS), F.lit(-(1 << 62))))
    rows = number_rows(rows, ["conv"], ["turn", "h1", "h2"], ["bucket"])
    return rows.select("conv", (F.col("_rn") - 1).alias("pos"), F.col("_n").alias("total"), "h1", "h2", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (``conv``, ``total``) after conversations took over their group's opening.

    The first ``h = crc32(id) % most`` turns of conversation ``c`` become those of ``c - c % group`` (all
    if it has fewer, none if it is absent); turns after the first ``h`` stay.
    """
    turns = stage(turns, "turns")
    convs = turns.where("pos = 0").select(
        "conv", F.col("total").alias("own"), F.expr(f"conv - conv % {group}").alias("base"),
        F.expr(f"crc32(cast(conv as string)) % {most}").alias("h"),
    )
    openings = convs.select(F.col("conv").alias("base"), F.col("own").alias("of_base"))
    convs = convs.join(openings, "base", "left").withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = stage(convs.withColumn("new", F.expr("taken + greatest(own - h, 0)")).select("conv", "base", "h", "taken", "new"), "conversations")
    kept = turns.join(convs.where("h > 0"), "conv").where("pos >= h").withColumn("pos", F.expr("taken + pos - h"))
    whole = turns.where(F.expr(f"crc32(cast(conv as string)) % {most} = 0")).withColumn("new", F.col("total"))
    heads = turns.where(f"pos < {most - 1} and conv % {group} = 0").withColumnRenamed("conv", "base")
    taken = convs.where("taken > 0").join(heads, "base").where("pos < taken")
    names = ["conv", "pos", F.col("new").alias("total"), "h1", "h2", "words"]
    rows = kept.select(*names).unionByName(whole.select(*names)).unionByName(taken.select(*names))
    return rows, convs.select("conv", F.col("new").alias("total"))


def _xor(left: str, right: str) -> Column:
    return F.col(left).bitwiseXOR(F.col(right))


def cut(rows: DataFrame, half: int) -> tuple[DataFrame, DataFrame]:
    """Cut sequences at ``half`` of their blocks: the rows of both halves, and the rows of cut prefixes.

    Rows are ``s`` (the sequence), ``pos``, ``total``, ``n`` (how many it stands for), the name of its
    group and the hash of the turn. A sequence that does not reach the cut stays whole. The second table
    has each row of a sequence that does, with the prefix's name and the sequence that stands for it.
    Both are filters over one staged table, so that plans do not grow from level to level.
    """
    far = F.expr(f"total - (pos div {2 * half}) * {2 * half} > {half}")
    upper = F.expr(f"pos % {2 * half} < {half}")
    rows = rows.withColumn("block", F.when(far, F.expr(f"pos div {2 * half}")))
    named = rows.where(far & upper).groupBy("s", "block").agg(
        *[F.bit_xor(x).alias(u) for x, u in (("x1", "u1"), ("x2", "u2"))], F.first("g1").alias("b1"), F.first("g2").alias("b2"), F.first("n").alias("m")
    )
    named = named.select("s", "block", "m", _xor("b1", "u1").alias("c1"), _xor("b2", "u2").alias("c2"))
    prefixes = named.groupBy("c1", "c2", "block").agg(F.min("s").alias("rep"), F.sum("m").alias("weight"))
    named = named.drop("m").join(prefixes, ["c1", "c2", "block"])
    parts = stage(rows.join(named, ["s", "block"], "left"), "cut")
    first, second = F.col("block").isNotNull() & upper, F.col("block").isNotNull() & ~upper
    left = parts.where(~first | (F.col("s") == F.col("rep"))).select(
        "s", "pos", "total", F.when(first, F.col("weight")).otherwise(F.col("n")).alias("n"),
        *[F.when(second, F.col(c)).otherwise(F.col(g)).alias(g) for g, c in zip(PARENT, ("c1", "c2"))], "x1", "x2", "words",
    )
    return left, parts.where(first)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    ``turns`` are as :func:`numbered_turns` gives them, ``convs`` has ``conv`` and ``total`` of every
    conversation, also of those without turns; both are read several times and had better be staged. The
    result has the node's name and its parent's (128 bits each), ``conv_id`` (smallest member), ``depth``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (words of all but the first copy of each
    turn) of its subtree.
    """
    spark = turns.sparkSession
    turns = turns.select(
        F.col("conv").alias("s"), "pos", "total", F.lit(1).cast("long").alias("n"),
        F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"),
        F.xxhash64("pos", "h1", "h2").alias("x1"), F.xxhash64(F.lit("second"), "pos", "h2", "h1").alias("x2"), "words",
    )
    deepest = convs.agg(F.max("total")).first()[0] or 0
    halves = [1 << k for k in range(max(deepest - 1, 0).bit_length())]
    # A sequence enters at the first cut that it reaches.
    rows, cuts = None, {}
    for half in [*reversed(halves), 0]:
        entering = turns.where(f"total > {half} and total <= {max(2 * half, 1)}")
        rows = entering if rows is None else rows.unionByName(entering)
        if half:
            rows, cuts[half] = cut(rows, half)

    # Blocks of one turn: a node is a turn in a group.
    singles = staged_path(rows.withColumns({"v1": _xor("g1", "x1"), "v2": _xor("g2", "x2")}), "single_turns")
    nodes = stage(spark.read.parquet(singles).groupBy(*NAME).agg(
        F.first("g1").alias("g1"), F.first("g2").alias("g2"), F.min("s").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.first("pos").alias("pos"), F.first("words").alias("words"),
    ), "nodes")
    children = nodes.groupBy(*PARENT).agg(F.count("*").alias("n_children")).toDF(*NAME, "n_children")
    nodes = nodes.join(children, NAME, "left").fillna(0, ["n_children"])
    nodes = nodes.withColumns({"n_leaves": F.expr("cast(n_children = 0 as long)"), "saved_tokens": F.expr("(n_convs - 1) * words")})
    totals_at = [staged_path(nodes, "totals")]
    nodes = spark.read.schema(nodes.schema).parquet(*totals_at)
    keys = "v1 long, v2 long, g1 long, g2 long, pos long"

    def totals() -> DataFrame:
        return spark.read.schema(f"{keys}, n_leaves long, saved_tokens long").parquet(*totals_at)

    # Graft totals upward, level by level. A level's rows need the names of their nodes: rows that another
    # sequence stood for take its names once the level is done. What is named stays; later levels add to it.
    named_at = [singles]
    sums = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    for half in halves:
        own, last = F.col("s") == F.col("rep"), half == halves[-1]
        named = spark.read.schema(f"s long, total long, rep long, {keys}").parquet(*named_at)
        named = named.where(F.col("rep").isNull() | ~own).where(f"total >= (pos div {half} + 1) * {half}")
        names = named.select(F.col("s").alias("rep"), "pos", *NAME, *PARENT)
        full = F.expr(f"total >= (pos div {2 * half} + 1) * {2 * half}")
        prefix = cuts[half].where(own if last else own | full).select("s", "pos", "total", "rep", "c1", "c2").join(names, ["rep", "pos"])
        named_at.append(staged_path(prefix, "named"))
        prefix = spark.read.schema(prefix.schema).parquet(named_at[-1])
        forests = totals().where(f"pos % {2 * half} = {half}").groupBy(*PARENT).agg(*sums).toDF("c1", "c2", "n_leaves", "saved_tokens")
        gained = prefix.where(own).join(forests, ["c1", "c2"]).groupBy(*NAME, *PARENT, "pos").agg(*sums)
        totals_at.append(staged_path(gained, "grafted"))

    sums_of_root = [F.min("conv").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]]
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    root = (
        convs.select("conv", one.alias("n_convs"), none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens"))
        .unionAll(totals().where("pos = 0").select(F.lit(None), none, none, "n_leaves", "saved_tokens"))
        .unionAll(nodes.where("pos = 0").select(F.lit(None), none, one, none, none))
        .agg(*sums_of_root).where("n_convs > 0")
    )
    root = root.select(
        *[none.alias(x) for x in NAME], *[F.lit(None).cast("long").alias(x) for x in PARENT], "conv_id", none.alias("depth"),
        "n_convs", "n_children", F.greatest("n_leaves", one).alias("n_leaves"), "saved_tokens",
    )
    below = nodes.drop("n_leaves", "saved_tokens").join(totals().groupBy(*NAME).agg(*sums), NAME).select(
        *NAME, *PARENT, "conv_id", (F.col("pos") + 1).alias("depth"), "n_convs", "n_children", "n_leaves", "saved_tokens"
    )
    return below.unionByName(root)


def conversation_ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv`` and the name of the node at which it ends."""
    hashes = [F.xxhash64("pos", "h1", "h2"), F.xxhash64(F.lit("second"), "pos", "h2", "h1")]
    names = turns.groupBy("conv").agg(*[F.bit_xor(x).alias(v) for x, v in zip(hashes, NAME)])
    return convs.select("conv").join(names, "conv", "left").fillna(0, NAME)


def member_digests(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its ids in ascending order, joined by commas.

    Ids of a range of ``2^ID_BITS`` are joined first; these pieces of a node are then read in order by
    one running digest, which holds one piece at a time however many ids the node has.
    """
    pieces = ends.groupBy(*NAME, F.shiftright("conv", ID_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids")
    )
    pieces = pieces.repartition(*NAME).sortWithinPartitions(*NAME, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None

        def out(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
            columns = list(zip(*done)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*NAME, "ends_sha256"])

        for batch in batches:
            done = []
            for v1, v2, ids in zip(*(batch.column(c).to_pylist() for c in (*NAME, "ids"))):
                if held != (v1, v2):
                    if held is not None:
                        done.append((*held, state.hexdigest()))
                    held, state = (v1, v2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield out(done)
        if held is not None:
            yield out([(*held, state.hexdigest())])

    return pieces.mapInArrow(run, "v1 long, v2 long, ends_sha256 string")


def trie_report(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node with its parent's smallest member and the digest of the conversations that end at it."""
    turns, convs = stage(turns, "rebuilt"), stage(convs, "conversations")
    nodes = stage(prefix_trie(turns, convs), "trie")
    parents = nodes.select(F.col("v1").alias("g1"), F.col("v2").alias("g2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(parents, PARENT, "left").join(member_digests(conversation_ends(turns, convs)), NAME, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )


# Prefixes as digests of their turns; a node's ancestors are the shorter prefixes of its smallest member.
SQL = r"""
with turns as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as i, coalesce(role, '') as r, coalesce(text, '') as x
    from conversations where conv_id is not null),
bytes as (select distinct c, list_transform(str_split(c::varchar, ''), lambda b: ascii(b)::ubigint) as b from turns),
sums as (select c, xor(list_reduce(list_prepend(4294967295::ubigint, b), lambda s, y: list_reduce(list_prepend(xor(s, y), list_transform(range(8), lambda z: 0::ubigint)),
    lambda v, z: xor(v >> 1, (v & 1::ubigint) * 3988292384::ubigint))), 4294967295::ubigint) as crc from bytes),
own as (select c, list({'k': md5(r) || md5(x), 'n': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))} order by i) as l from turns group by c),
rebuilt as (select o.c, list_concat(coalesce(b.l, [])[1 : (crc % 4)::bigint], o.l[(crc % 4)::bigint + 1 :]) as l
    from own o join sums using (c) left join own b on b.c = o.c - o.c % 20),
prefixes as (select c, d, len(l) as n, md5(array_to_string(list_transform(l[1 : d], lambda e: e.k), '')) as k,
    md5(array_to_string(list_transform(l[1 : greatest(d - 1, 0)], lambda e: e.k), '')) as parent, coalesce(l[d].n, 0) as words
    from (select c, l, unnest(range(0, len(l) + 1)) as d from rebuilt)),
nodes as (select d, k, any_value(case when d > 0 then parent end) as parent, min(c) as conv_id, count(*) as n_convs, any_value(words) as words,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where d = n), '')) as ends_sha256 from prefixes group by d, k),
kids as (select d - 1 as d, parent as k, count(*) as n_children from nodes where d > 0 group by all),
subtrees as (select a.d, a.k, sum(case when n_children is null then 1 else 0 end)::bigint as n_leaves,
    sum(case when v.d = 0 then 0 else (v.n_convs - 1) * v.words end)::bigint as saved_tokens
    from nodes v left join kids on kids.d = v.d and kids.k = v.k join prefixes a on a.c = v.conv_id and a.d <= v.d group by a.d, a.k)
select v.conv_id, v.d as depth, p.conv_id as parent_conv_id, v.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, v.ends_sha256
from nodes v join subtrees s on s.d = v.d and s.k = v.k left join kids on kids.d = v.d and kids.k = v.k left join nodes p on p.d = v.d - 1 and p.k = v.parent
"""
