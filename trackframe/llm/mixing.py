"""Mixing sources to target weights by temperature, with DataFrame functions only.

The share p of every source in all words is raised to one exponent: weights are ``p^a / sum(p^a)``.
``a = 1`` keeps the natural shares, ``a = 0`` makes all sources equal. The exponent is bisected
between the two until the entropy of the weights reaches a target, or until no source is repeated
more than a limit allows. Weights times the budget give every source a number of words.

A source's budget is filled with permutations of its documents: each epoch orders all of them anew
by a seeded md5, and the last epoch stops where the budget ends. A copy's place in that sequence,
as a share of the budget, names the block of the mixture it falls into, so every block holds the
sources in nearly the target weights. Within a block copies are ordered by their md5.

Running sums over a source that holds a third of all rows are made level by level: sums of md5
prefixes, two digits at a time, give every small bucket its offset, and only rows of one bucket meet
in a window. The only numbers that reach the driver are totals and the candidates of a bisection pass.

A null source is a source like others. Null and empty texts have no words and take no budget: they
are not in the mixture, and a source without words has weight 0. Rows that share an id, or have none, are
separate documents: their md5 also takes in a hash of the text, and of equal texts a running number of
the row, so no key holds many rows. Texts are only counted, whatever their length; other columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from trackframe.llm.common import free_name
from trackframe.session import attach, stage

# Bisection steps that one pass over the source table decides together, and passes.
STEPS, PASSES = 8, 5
# Digits of a level of running sums, and rows that may meet in one window.
DIGITS, BUCKET_ROWS = 2, 4096
WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """Documents and words of every source that has words."""
    return rows.groupBy("_source").agg(F.count("*").alias("docs"), F.sum("_tokens").alias("tokens")).where("tokens > 0")


def find_exponent(totals: DataFrame, budget: int, target_entropy: float | None, max_repeats: float | None) -> float:
    """Bisect the exponent between 0 and 1 (an action).

    With ``max_repeats``: the smallest exponent at which no source is used more often than that.
    With ``target_entropy`` (share of the highest possible): the largest exponent that reaches it;
    1 if the natural shares do. ``STEPS`` halvings are decided by one pass over the source table.
    """
    whole = totals.agg(F.sum("tokens"), F.count("*")).first()
    if not whole[0]:
        return 1.0
    shares = totals.select("tokens", (F.col("tokens") / F.lit(whole[0])).alias("p"))

    def good(exponents: list[float]) -> dict[float, bool]:
        each = shares.select("tokens", "p", F.explode(F.lit(exponents)).alias("a"))
        power = F.pow("p", F.col("a"))
        # With q = p^a and s = sum(q), the entropy of q / s is log(s) - sum(q log q) / s.
        found = each.groupBy("a").agg(
            F.sum(power).alias("s"), F.sum(power * F.log(power)).alias("l"), F.max(power / F.col("tokens")).alias("m")
        )
        if max_repeats is not None:
            met = F.col("m") / F.col("s") * budget <= max_repeats
        else:
            met = F.log("s") - F.col("l") / F.col("s") >= target_entropy * math.log(whole[1])
        return {r[0]: r[1] for r in found.select("a", met).collect()}

    ends = good([0.0, 1.0])
    if max_repeats is not None:
        if not ends[1.0]:
            raise ValueError("the budget repeats the whole corpus more often than max_repeats allows")
        if ends[0.0]:
            return 0.0
    elif ends[1.0]:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        parts = 2**STEPS
        met = good([low + (high - low) * k / parts for k in range(1, parts)])
        for _ in range(STEPS):
            mid = (low + high) / 2
            if met[mid] == (max_repeats is not None):
                high = mid
            else:
                low = mid
    return high if max_repeats is not None else low


def source_budgets(totals: DataFrame, budget: int, exponent: float) -> DataFrame:
    """Weight, words to take and epochs of every source."""
    whole = totals.agg(F.sum("tokens"), F.sum(F.pow(F.col("tokens"), F.lit(exponent)))).first()
    weight = F.round(F.pow(F.col("tokens"), F.lit(exponent)) / F.lit(whole[1] or 1.0), 12)
    share = totals.withColumn("weight", weight).withColumn("take", F.floor(F.col("weight") * F.lit(budget)).cast("long"))
    return share.withColumn("epochs", F.ceil(F.col("take") / F.col("tokens")).cast("long")).where("take > 0")


def running_start(copies: DataFrame, group: list[str], largest: int) -> DataFrame:
    """Add ``_start``: words before a row among the rows of its group, in the order of ``_key``."""
    levels = 1
    while largest > BUCKET_ROWS * 16 ** (DIGITS * levels):
        levels += 1
    cut = [F.substring("_key", 1, DIGITS * k) for k in range(levels + 1)]
    rows = copies.withColumn("_at", cut[levels])
    leaves = rows.groupBy(*group, "_at").agg(F.sum("_tokens").alias("_sum"))
    # Offsets from the top level down: siblings share all digits but the last ones.
    offsets = None
    for k in range(1, levels + 1):
        level = leaves.withColumn("_at", F.substring("_at", 1, DIGITS * k))
        level = level.groupBy(*group, "_at").agg(F.sum("_sum").alias("_sum")) if k < levels else level
        level = level.withColumn("_up", F.substring("_at", 1, DIGITS * (k - 1)))
        order = W.partitionBy(*group, "_up").orderBy("_at")
        level = level.withColumn("_before", F.sum("_sum").over(order) - F.col("_sum"))
        if offsets is not None:
            upper = offsets.withColumnsRenamed({"_at": "_up", "_before": "_base"})
            level = level.join(upper, [*group, "_up"]).withColumn("_before", F.col("_before") + F.col("_base"))
        offsets = level.select(*group, "_at", "_before")
    order = W.partitionBy(*group, "_at").orderBy("_key").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(offsets, [*group, "_at"])
    return rows.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_tokens").over(order), F.lit(0))).drop("_at", "_before")


def keyed(rows: DataFrame) -> DataFrame:
    """Add ``_tie``: null, or what tells apart rows that share ``_id``: hash of the text, and number if that is repeated."""
    shared = rows.groupBy("_id").agg(F.count("*").alias("_n")).where("_n > 1").select("_id", F.lit(True).alias("_shared"))
    rows = attach(rows, shared, ["_id"], "left")
    again = rows.where("_shared").groupBy("_id", "_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    rows = attach(rows, again.select("_id", "_hash", F.lit(True).alias("_again")), ["_id", "_hash"], "left")
    return rows.withColumn("_tie", F.when(F.col("_shared"), F.concat_ws("|", "_hash", F.when(F.col("_again"), F.col("_row")))))


def place(
    docs: DataFrame, row: Column, budget: int | None, target_entropy: float | None, max_repeats: float | None, block_words: int, seed: int,
    id_col: str, text_col: str, source_col: str,
) -> DataFrame:
    """The columns of :func:`mix`, and ``_row``: the number of the row a copy comes from."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either target_entropy or max_repeats")
    doc, source = F.col(f"`{id_col}`").cast("long"), F.col(f"`{source_col}`").cast("string")
    rows = docs.select(
        doc.alias("doc_id"), source.alias("source"), n_words(text_col).alias("_tokens"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_hash"),
        F.coalesce(doc.cast("string"), F.lit("")).alias("_id"), row.alias("_row"),
    ).where("_tokens > 0")
    # Sources as non-null keys for grouping and joining.
    rows = stage(rows.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "words")
    totals = stage(source_totals(rows), "sources")
    whole = totals.agg(F.sum("tokens"), F.max("docs")).first()
    budget = int(whole[0] or 0) if budget is None else int(budget)
    exponent = find_exponent(totals, budget, target_entropy, max_repeats)
    budgets = stage(source_budgets(totals, budget, exponent), "budgets")
    copies = keyed(rows).join(budgets.select("_source", "tokens", "take", "epochs"), "_source")
    copies = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1))).withColumn(
        "_key", F.md5(F.concat_ws("|", F.lit(seed), "epoch", "_id", "_tie"))
    )
    copies = copies.select("doc_id", "source", "_source", "_tokens", "_row", "tokens", "take", "epoch", "_key")
    placed = running_start(copies, ["_source", "epoch"], int(whole[1] or 0))
    placed = placed.withColumn("start", F.col("epoch") * F.col("tokens") + F.col("_start")).where("start + _tokens <= take")
    blocks = max(1, -(-budget // block_words))
    block = F.floor(F.col("start") * blocks / F.col("take")).cast("long")
    return placed.select(
        "doc_id", "source", F.col("_tokens").alias("n_tokens"), "epoch", "start", block.alias("block"), F.col("_key").alias("order_key"), "_row"
    )


def mix(
    docs: DataFrame,
    budget: int | None = None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    block_words: int = 1 << 20,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixture: one row per copy of a document (``budget``: words, by default those of the corpus).

    ``doc_id, source, n_tokens, epoch, start`` (words before it in its source's sequence), ``block``
    and ``order_key`` (order within the block).
    """
    number = F.monotonically_increasing_id()
    return place(docs, number, budget, target_entropy, max_repeats, block_words, seed, id_col, text_col, source_col).drop("_row")


def mixed_rows(
    docs: DataFrame,
    budget: int | None = None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents of the mixture with all their columns, each row once for every epoch that holds it."""
    own, epochs, again = (free_name(docs, x) for x in ("mixed_row", "epochs", "again"))
    rows = stage(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    placed = place(rows, F.col(own), budget, target_entropy, max_repeats, 1 << 20, seed, id_col, text_col, source_col)
    times = placed.groupBy("_row").agg(F.count("*").cast("int").alias(epochs)).withColumnRenamed("_row", own)
    found = rows.join(times, own)
    return found.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(epochs)))).select(*docs.columns)


def sql(max_repeats: float, block_words: int = 1 << 20, seed: int = 42) -> str:
    """The mixture under a repetition limit, in SQL; the bisection is a recursive query."""
    return rf"""
with recursive d as (
    select doc_id, source, len(regexp_extract_all(text, '{WORDS}')) as n_tokens from documents where text is not null),
r as (select * from d where n_tokens > 0),
s as (select source, sum(n_tokens)::bigint as tokens from r group by source),
l as (select list(tokens order by source) as ts, sum(tokens)::bigint as budget from s),
b(step, low, high) as (
    select 0, 0.0::double, 1.0::double
    union all
    select step + 1,
        case when {{met}} then low else (low + high) / 2 end,
        case when {{met}} then (low + high) / 2 else high end
    from b, l where step < {STEPS * PASSES}),
e as (
    select case when (select {{met0}} from l) then 0.0 else (select high from b where step = {STEPS * PASSES}) end as a),
w as (
    select source, tokens, round(pow(tokens, a) / sum(pow(tokens, a)) over (), 12) as weight, (select budget from l) as budget from s, e),
t as (select *, floor(weight * budget)::bigint as take from w),
c as (
    select r.*, t.tokens, t.take, t.budget, unnest(range(ceil(take / tokens)::bigint)) as epoch from r join t on r.source is not distinct from t.source where take > 0),
k as (select *, md5('{seed}|' || epoch || '|' || doc_id) as order_key from c),
p as (
    select *, epoch * tokens + coalesce(sum(n_tokens) over (
        partition by source, epoch order by order_key rows between unbounded preceding and 1 preceding), 0)::bigint as start from k)
select doc_id, source, n_tokens, epoch, start,
       floor(start * greatest(1, ceil(budget / {block_words})) / take)::bigint as block, order_key
from p where start + n_tokens <= take""".replace(
        "{met0}", f"list_max(list_transform(ts, lambda t: pow(t / budget, 0.0) / t)) / len(ts) * budget <= {max_repeats}"
    ).replace(
        "{met}",
        "list_max(list_transform(ts, lambda t: pow(t / budget, (low + high) / 2) / t)) "
        f"/ list_sum(list_transform(ts, lambda t: pow(t / budget, (low + high) / 2))) * budget <= {max_repeats}",
    )
