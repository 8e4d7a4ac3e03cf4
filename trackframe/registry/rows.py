"""Queries over single rows: labels, filters, cleaning, sampling, splitting, the builder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from trackframe.functions.columns import columns_between, composite_label, nan_to_null, row_key
from trackframe.operators import clean, sample
from trackframe.plans.dataset import build_rows
from trackframe.plans.training import class_folds
from trackframe.registry.tables import (
    EVENTS_SQL, ITEM_FEATURES, ITEM_ID, ITEM_KEY_SQL, ITEM_SPEC, ITEM_VOCABULARY, ITEMS_SQL, Registry, events, items,
)
from trackframe.session import scratch_path
from trackframe.sources.sinks import column_families, write_families
from trackframe.spec import DatasetSpec, Vocabulary

registry = Registry()
IDS = ", ".join(ITEM_ID)
CUTOFF = "1998-01-01"  # rows shipped before it play the earlier dataset
FIVE_CLASSES = Vocabulary({k: v for k, v in ITEM_VOCABULARY.classes.items() if k != "32"})
DEDUPE = ["l_partkey", "l_suppkey", "l_quantity"]
SIGMA = ITEM_FEATURES
# Below the class size, above it, none given, zero; one class is left out and one has no rows.
QUOTA = {"11": 500, "12": 100_000_000, "21": None, "22": 0, "31": 2000, "99": 10}
EVENT_QUOTA = {"click": 50, "view": 1001, "error": None, "signup": 100_000_000}
BUILD_QUOTA = {"11": 500, "12": 800, "21": 1000, "22": 100_000_000, "31": 700, "32": 900}


def quota_sql(quota, label):
    cases = " ".join(f"when '{k}' then {'n_all' if v is None else v}" for k, v in quota.items())
    return f"case {label} {cases} end"


def listed(values):
    return ", ".join(f"'{v}'" for v in values)


@registry.add("build_dataset", f"""with {ITEMS_SQL},
 new as (select *, {ITEM_KEY_SQL} as key, count(*) over (partition by label) as n_all
         from items where l_shipdate >= '{CUTOFF}'),
 picked as (select *, row_number() over (partition by label order by key, {IDS}) as rn from new),
 merged as (select 0 as src, {IDS}, l_quantity, l_extendedprice, l_discount, l_tax, flag, status, label
            from picked where rn <= {quota_sql(BUILD_QUOTA, 'label')}
            union all
            select 1, {IDS}, l_quantity, l_extendedprice, l_discount, l_tax, flag, status, label
            from items where l_shipdate < '{CUTOFF}')
 select src, {IDS}, l_quantity, l_extendedprice, l_discount, l_tax, label
 from (select *, row_number() over (partition by l_quantity, l_extendedprice, l_discount, flag, status
                                    order by src, {IDS}) as first from merged)
 where first = 1 and l_discount <> 0""")
def build_dataset(spark, folder):
    rows = items(spark, folder).drop("label")
    spec = DatasetSpec(
        data_dir="lineitem", dataset="lineitem", add=True, types=tuple(BUILD_QUOTA), amounts=tuple(BUILD_QUOTA.values()),
        features=ITEM_SPEC, vocabulary=ITEM_VOCABULARY,
    )
    new, old = rows.where(F.col("l_shipdate") >= CUTOFF), rows.where(F.col("l_shipdate") < CUTOFF)
    built = build_rows(new, old, spec, ITEM_ID)
    return built.select(F.col("_src").alias("src"), *ITEM_ID, *ITEM_FEATURES, "label")


DEDUPE_SQL = f"""select {IDS}, l_quantity, l_discount, l_tax, l_shipdate::date::varchar as shipped from items
 qualify row_number() over (partition by {', '.join(DEDUPE)} order by {IDS}) = 1"""


def dedupe_input(spark, folder):
    shipped = F.to_date("l_shipdate").cast("string").alias("shipped")
    return items(spark, folder).select(*ITEM_ID, "l_quantity", "l_discount", "l_tax", shipped)


@registry.add("dedupe_first", f"with {ITEMS_SQL} {DEDUPE_SQL}")
def dedupe_first(spark, folder):
    return clean.dedupe_first(dedupe_input(spark, folder), DEDUPE, ITEM_ID)


@registry.add("clean_rows", f"with {ITEMS_SQL} select * from ({DEDUPE_SQL}) where l_discount <> 0 and l_tax <> 0")
def clean_rows(spark, folder):
    return clean.clean_rows(dedupe_input(spark, folder), DEDUPE, ITEM_ID, ["l_discount", "l_tax"])


@registry.add("sep_classes", f"""with {ITEMS_SQL}
 select {IDS}, label, cast(label as int) // 10 * 2 + cast(label as int) % 10 - 3 as idx from items where label <> '32'""")
def sep_classes(spark, folder):
    rows = items(spark, folder).drop("label")
    return clean.sep_classes(rows, FIVE_CLASSES, ["flag", "status"]).select(*ITEM_ID, "label", "idx")


@registry.add("composite_label", f"with {ITEMS_SQL} select {IDS}, flag::varchar || status::varchar as label from items")
def composite(spark, folder):
    return items(spark, folder).select(*ITEM_ID, composite_label("flag", "status").alias("label"))


@registry.add("column_range", "select l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def column_range(spark, folder):
    rows = items(spark, folder)
    return rows.select(*columns_between(rows, "l_quantity", "l_tax"))


@registry.add("column_families", f"""with {ITEMS_SQL}
 select 'num' as family, 'l_quantity' as name, count(*) as n, round(sum(l_quantity), 2) as total from items
 union all select 'num', 'l_extendedprice', count(*), round(sum(l_extendedprice), 2) from items
 union all select 'matrix', 'l_discount', count(*), round(sum(l_discount), 2) from items
 union all select 'extra', 'l_tax', count(*), round(sum(l_tax), 2) from items
 union all select 'y', 'flag', count(*), sum(flag)::double from items
 union all select 'y', 'status', count(*), sum(status)::double from items""")
def families(spark, folder):
    """Written as one folder a family, and read back."""
    path, parts = scratch_path(spark, "families"), []
    rows = items(spark, folder)
    write_families(rows, path, ITEM_SPEC)
    for family, df in column_families(rows, ITEM_SPEC).items():
        back = spark.read.schema(", ".join(f"{c} double" for c in df.columns)).option("header", True).csv(f"{path}/{family}")
        sums = back.agg(F.count("*").alias("n"), *[F.round(F.sum(c), 2).alias(c) for c in df.columns])
        parts.append(sums.unpivot("n", df.columns, "name", "total").withColumn("family", F.lit(family)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@registry.add("positional_rename", "select l_quantity as speed, l_extendedprice as altitude, l_discount as range, l_tax as bearing from lineitem")
def positional_rename(spark, folder):
    return items(spark, folder).select(*ITEM_FEATURES).toDF("speed", "altitude", "range", "bearing")


# A discount of 0.05 plays a missing cell, a tax of 0.03 a NaN.
def holes(spark, folder):
    rows = items(spark, folder).select(
        *ITEM_ID, "l_extendedprice", F.expr("nullif(l_discount, 0.05D)").alias("a"),
        F.expr("if(l_tax = 0.03D, double('NaN'), l_tax)").alias("b"),
    )
    return nan_to_null(rows)


HOLES_SQL = f"""with {ITEMS_SQL}, holes as (
 select {IDS}, l_extendedprice, nullif(l_discount, 0.05::double) as a, nullif(l_tax, 0.03::double) as b from items)"""


@registry.add("nonzero_filter", f"{HOLES_SQL} select * from holes where a is distinct from 0 and b is distinct from 0")
def nonzero_filter(spark, folder):
    return clean.nonzero(holes(spark, folder), ["a", "b"])


@registry.add("min_threshold", f"{HOLES_SQL} select * from holes where a >= 0.04 and l_extendedprice >= 30000")
def min_threshold(spark, folder):
    return clean.at_least(holes(spark, folder), {"a": 0.04, "l_extendedprice": 30000.0})


@registry.add("exclude_when", f"{HOLES_SQL} select * from holes where not coalesce(a >= 0.03 and b <= 0.05, false)")
def exclude_when(spark, folder):
    return clean.exclude_when(holes(spark, folder), (F.col("a") >= 0.03) & (F.col("b") <= 0.05))


def sigma_sql(sequential):
    steps, source = [], "items"
    for i, c in enumerate(SIGMA):
        stats = source if sequential else "items"
        steps.append(f"b{i} as (select label, avg({c}) as m, 1.5 * stddev_samp({c}) as s from {stats} group by label)")
        steps.append(f"f{i} as (select f.* from {source} f join b{i} using (label) where {c} <= m + s and {c} >= m - s)")
        source = f"f{i}"
    return f"with {ITEMS_SQL}, {', '.join(steps)} select {IDS}, label, {', '.join(SIGMA)} from {source}"


@registry.add("sigma_filter", sigma_sql(True))
def sigma_filter(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "label", *SIGMA)
    return clean.sigma_filter(rows, SIGMA, ["label"], 1.5)


@registry.add("sigma_filter_1p", sigma_sql(False))
def sigma_filter_single_pass(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "label", *SIGMA)
    return clean.sigma_filter_single_pass(rows, SIGMA, ["label"], 1.5)


@registry.add("shuffle_rows", f"with {ITEMS_SQL} select {IDS}, label, {ITEM_KEY_SQL} as shuffle_key from items")
def shuffle_rows(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "label", row_key(*ITEM_ID, seed=42).alias("shuffle_key"))
    return sample.shuffle_rows(rows, ITEM_ID)


PICK_SQL = f"""with {ITEMS_SQL}, keyed as (
 select *, count(*) over (partition by label) as n_all,
        row_number() over (partition by label order by {ITEM_KEY_SQL}, {IDS}) as rn from items)"""


@registry.add("sample_n_per_class", f"""{PICK_SQL}
 select {IDS}, label from keyed where label in ({listed(QUOTA)}) and rn <= {quota_sql(QUOTA, 'label')}""")
def sample_n_per_class(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "label")
    return sample.sample_n_per_class(rows, "label", QUOTA, ITEM_ID)


@registry.add("erase_n", f"""{PICK_SQL}
 select {IDS}, label from keyed where label not in ({listed(QUOTA)}) or rn > {quota_sql(QUOTA, 'label')}""")
def erase_n(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "label")
    return sample.erase_n(rows, "label", QUOTA, ITEM_ID)


@registry.add("head_n_per_class", f"""with keyed as (
 select event_id, event_type, count(*) over (partition by event_type) as n_all,
        row_number() over (partition by event_type order by event_id) as rn from events)
 select event_id, event_type from keyed where event_type in ({listed(EVENT_QUOTA)})
 and rn <= case when event_type = 'error' then n_all else ({quota_sql(EVENT_QUOTA, 'event_type')}) // 4 * 4 end""")
def head_n_per_class(spark, folder):
    rows = events(spark, folder).select("event_id", "event_type", "bucket")
    return sample.head_n_per_class(rows, "event_type", EVENT_QUOTA, ["event_id"], ["bucket"], steps=4).drop("bucket")


@registry.add("append_dataset", f"""with {ITEMS_SQL}, merged as (
 select *, case when l_shipdate >= '{CUTOFF}' then 0 else 1 end as src from items)
 select src, {IDS}, l_quantity, l_tax from merged
 qualify row_number() over (partition by {', '.join(DEDUPE)} order by src, {IDS}) = 1""")
def append_dataset(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "l_quantity", "l_tax", "l_shipdate")
    new, old = rows.where(F.col("l_shipdate") >= CUTOFF), rows.where(F.col("l_shipdate") < CUTOFF)
    merged = sample.append_dataset(new.drop("l_shipdate"), old.drop("l_shipdate"), "src")
    return clean.dedupe_first(merged, DEDUPE, ["src", *ITEM_ID])


BUCKET_SQL = "('0x' || substr(md5('42|' || event_id), 1, 8))::bigint % 1000"


@registry.add("random_split", f"""select event_id, event_type,
 case when {BUCKET_SQL} < 900 then 'train' when {BUCKET_SQL} < 950 then 'dev' else 'test' end as split from events""")
def random_split(spark, folder):
    return sample.random_split(events(spark, folder).select("event_id", "event_type"), ["event_id"])


@registry.add("random_split_exact", """with keyed as (
 select event_id, event_type, row_number() over (order by md5('42|' || event_id), event_id) as rn,
        floor(count(*) over () * 0.9::double)::bigint as train, count(*) over () as n from events)
 select event_id, event_type, case when rn <= train then 'train'
   when rn <= train + floor((n - train) * 0.5::double)::bigint then 'dev' else 'test' end as split from keyed""")
def random_split_exact(spark, folder):
    return sample.random_split_exact(events(spark, folder).select("event_id", "event_type"), ["event_id"])


@registry.add("class_folds", """with keyed as (
 select event_id, event_type, row_number() over (partition by event_type order by event_id) as rn,
        count(*) over (partition by event_type) as n from events)
 select event_id, event_type, (case when rn > n // 3 then 1 else 0 end) + (case when rn > n * 2 // 3 then 1 else 0 end) as fold
 from keyed""")
def folds(spark, folder):
    rows = events(spark, folder).select("event_id", "event_type", "bucket")
    return class_folds(rows, "event_type", ["event_id"], ["bucket"], 3).drop("bucket")
