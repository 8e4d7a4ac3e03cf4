"""The given tables in the shapes the registered queries use, with the same shapes in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.spec import FeatureSpec, Vocabulary

ITEM_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]
ITEM_LABELS = ["11", "12", "21", "22", "31", "32"]
ITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ITEM_SPEC = FeatureSpec(
    numbers=("l_quantity", "l_extendedprice"),
    matrix=("l_discount",),
    extra=("l_tax",),
    classes=("flag", "status"),
    dedupe_ignore=("l_tax",),
    nonzero=("l_discount",),
)
ITEM_VOCABULARY = Vocabulary({x: (int(x[0]), int(x[1])) for x in ITEM_LABELS})

# lineitem with class codes, a text label and the price in cents as part of the row identity.
ITEMS_SQL = """items as (
    select *, case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as flag,
           case l_linestatus when 'F' then 1 else 2 end as status,
           flag::varchar || status::varchar as label,
           round(l_extendedprice * 100)::bigint as cents
    from lineitem)"""
ITEM_KEY_SQL = (
    "md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || cents)"
)

# Width of an event bucket. Event ids are unique, so a bucket can never hold more rows than this.
EVENT_BUCKET = 10_000
EVENTS_SQL = """ev as (
    select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def items(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    status = F.when(F.col("l_linestatus") == "F", 1).otherwise(2)
    return table(spark, folder, "lineitem").withColumns({
        "flag": flag,
        "status": status,
        "label": F.concat(flag.cast("string"), status.cast("string")),
        "cents": F.round(F.col("l_extendedprice") * 100).cast("long"),
    })


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumns({
        "k": F.get_json_object("props", "$.k").cast("long"),
        "bucket": F.expr(f"event_id div {EVENT_BUCKET}"),
    })


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").withColumn("x", F.col("embedding").cast("array<double>"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


class Registry:
    """Named queries with, where SQL can say it, the same query as SQL."""

    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, name: str, sql: str | None = None):
        def register(function):
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return register
