"""Queries that count, profile, scale, encode and evaluate."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trackframe.functions.columns import argmax, divide_by_row_max, label_at, one_hot, reshape
from trackframe.operators import clean, stats
from trackframe.operators.knn import knn1 as nearest_exact
from trackframe.operators.knn import knn_lsh as nearest_by_hash
from trackframe.operators.sample import random_split
from trackframe.operators.scale import minmax_scale as scale_columns
from trackframe.plans.training import subset_encoder
from trackframe.registry.rows import DEDUPE, DEDUPE_SQL, dedupe_input
from trackframe.registry.tables import (
    ITEM_FEATURES, ITEM_ID, ITEM_KEY_SQL, ITEM_LABELS, ITEMS_SQL, Registry, embeddings, items, rounded, table,
)
from trackframe.session import stage

registry = Registry()
IDS = ", ".join(ITEM_ID)
ITEM_SPLIT_SQL = f"""({{}} < 900)""".format(f"('0x' || substr({ITEM_KEY_SQL}, 1, 8))::bigint % 1000")


@registry.add("class_counts", f"with {ITEMS_SQL} select label, count(*) as n from items group by label")
def class_counts(spark, folder):
    return stats.class_counts(items(spark, folder), "label")


@registry.add("clean_report", f"""with {ITEMS_SQL}, kept as (select *, {ITEM_KEY_SQL} from ({DEDUPE_SQL}) where l_discount <> 0),
 before as (select l_linenumber, count(*) as rows_before from items group by all),
 after as (select l_linenumber, count(*) as rows_after from kept group by all)
 select l_linenumber, rows_before, coalesce(rows_after, 0) as rows_after, rows_before - coalesce(rows_after, 0) as removed
 from before left join after using (l_linenumber)""")
def clean_report(spark, folder):
    rows = dedupe_input(spark, folder)
    return stats.clean_report(rows, clean.clean_rows(rows, DEDUPE, ITEM_ID, ["l_discount"]), "l_linenumber")


PROFILED = ITEM_FEATURES
POINTS = ", ".join(map(str, stats.PROFILE_PERCENTILES))


def profile_sql():
    parts = [
        f"""select label, '{c}' as feature, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as sd,
        min({c}) as lowest, max({c}) as highest, unnest([{POINTS}]::double[]) as percentile,
        round(unnest(quantile_cont({c}, [{POINTS}])), 6) as value from items group by label"""
        for c in PROFILED
    ]
    return f"with {ITEMS_SQL} " + " union all ".join(parts)


@registry.add("profile", profile_sql())
def profile(spark, folder):
    return rounded(stats.profile(items(spark, folder), "label", PROFILED), "mean", "sd", "value")


# How exact stored sketches are, and by what share of the rows their ranks may be off.
SKETCH_K, SKETCH_SLACK = 4096, 0.0025


@registry.add("profile_merged", f"""with p as ({profile_sql()})
 select label, feature, n, mean, lowest, highest, percentile, true as near from p""")
def profile_merged(spark, folder):
    """Sketches of two deliveries, stored and merged, against the ranks of all their rows."""
    rows = items(spark, folder)
    halves = [stats.sketches(rows.where(F.col("l_orderkey") % 2 == i), "label", PROFILED, SKETCH_K) for i in (0, 1)]
    stored = stage(halves[0].unionByName(halves[1]), "sketches")
    found = stage(stats.sketched_percentiles(stats.merged_sketches(stored, "label"), "label"), "profile")
    values = rows.select("label", *PROFILED).unpivot("label", PROFILED, "feature", "x")
    ranked = values.join(F.broadcast(found.select("label", "feature", "percentile", "value")), ["label", "feature"]).groupBy(
        "label", "feature", "percentile"
    ).agg(F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("up_to"))
    wanted, slack = F.col("n") * F.col("percentile"), F.col("n") * SKETCH_SLACK + 2
    near = (F.col("below") <= wanted + slack) & (F.col("up_to") >= wanted - slack)
    out = found.join(ranked, ["label", "feature", "percentile"]).withColumn("near", near).drop("value", "below", "up_to")
    return rounded(out, "mean")


SKETCH = 10_000


@registry.add("profile_approx", f"""with p as ({profile_sql()})
 select label, feature, n, mean, sd, lowest, highest, percentile, true as near from p""")
def profile_approx(spark, folder):
    """The sketched values come with a check of their promise: ranks within ``n / SKETCH`` of the wanted one."""
    rows = items(spark, folder)
    found = stage(stats.profile_approx(rows, "label", PROFILED, accuracy=SKETCH), "profile")
    values = rows.select("label", *PROFILED).unpivot("label", PROFILED, "feature", "x")
    ranked = values.join(F.broadcast(found.select("label", "feature", "percentile", "value")), ["label", "feature"]).groupBy(
        "label", "feature", "percentile"
    ).agg(F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("up_to"))
    wanted, slack = F.ceil(F.col("n") * F.col("percentile")), F.col("n") / SKETCH + 1
    near = (F.col("below") <= wanted + slack) & (F.col("up_to") >= wanted - slack)
    out = found.join(ranked, ["label", "feature", "percentile"]).withColumn("near", near).drop("value", "below", "up_to")
    return rounded(out, "mean", "sd")


def scaled_sql(c):
    return f"round(({c} - (select min({c}) from train)) / (select case when max({c}) = min({c}) then 1 else max({c}) - min({c}) end from train), 6) as {c}"


@registry.add("minmax_scale", f"""with {ITEMS_SQL}, whole as (select *, 7.0::double as same, {ITEM_SPLIT_SQL} as training from items),
 train as (select * from whole where training)
 select {IDS}, training, {', '.join(scaled_sql(c) for c in [*ITEM_FEATURES[:-1], 'same'])} from whole""")
def minmax_scale(spark, folder):
    """Scaled by the training rows; the last feature is dropped before, one column is constant."""
    columns = [*ITEM_FEATURES[:-1], "same"]
    rows = items(spark, folder).select(*ITEM_ID, *ITEM_FEATURES, F.lit(7.0).alias("same")).drop(ITEM_FEATURES[-1])
    split = random_split(rows, ITEM_ID, train=0.9).withColumn("training", F.col("split") == "train").drop("split")
    _, scaled = scale_columns(split.where("training"), split, columns=columns)
    return rounded(scaled, *columns)


@registry.add("one_hot", f"with {ITEMS_SQL} select {IDS}, "
              + ", ".join(f"(label = '{x}')::int::double as h_{x}" for x in ITEM_LABELS) + " from items")
def one_hot_labels(spark, folder):
    rows = items(spark, folder).withColumn("hot", one_hot(F.col("label"), ITEM_LABELS))
    return rows.select(*ITEM_ID, *[F.col("hot")[i].alias(f"h_{x}") for i, x in enumerate(ITEM_LABELS)])


@registry.add("row_max_norm", """with e as (select vec_id, embedding::double[] as x from embeddings),
 flat as (select vec_id, unnest(range(len(x))) as pos, unnest(x) as v, list_max(x) as top from e)
 select vec_id, pos, round(v / top, 6) as v from flat""")
def row_max_norm(spark, folder):
    rows = embeddings(spark, folder).select("vec_id", F.posexplode(divide_by_row_max(F.col("x"))).alias("pos", "v"))
    return rounded(rows, "v")


@registry.add("reshape_matrix", """with e as (select vec_id, embedding::double[] as x from embeddings),
 flat as (select vec_id, unnest(range(len(x))) as pos, unnest(x) as v from e)
 select vec_id, pos // 8 as i, pos % 8 as j, round(v, 6) as v from flat""")
def reshape_matrix(spark, folder):
    rows = embeddings(spark, folder).select("vec_id", F.posexplode(reshape(F.col("x"), 8, 8)).alias("i", "row"))
    return rounded(rows.select("vec_id", "i", F.posexplode("row").alias("j", "v")), "v")


@registry.add("subset_encode", f"""with {ITEMS_SQL} select {IDS}, (flag = 1)::int::double as e0, (flag = 2)::int::double as e1,
 (flag = 3)::int::double as e2, (status = 1)::int::double as e3, (status = 2)::int::double as e4, l_quantity as e5, l_discount as e6 from items""")
def subset_encode(spark, folder):
    rows = items(spark, folder).select(*ITEM_ID, "flag", "status", "l_quantity", "l_discount")
    encoded = subset_encoder(["flag", "status"], ["l_quantity", "l_discount"]).fit(rows).transform(rows)
    values = vector_to_array("encoded")
    return encoded.select(*ITEM_ID, *[values[i].alias(f"e{i}") for i in range(7)])


def outcomes(spark, folder):
    rows = table(spark, folder, "labels").select(
        F.col("quality").cast("string").alias("truth"), (1 - F.col("toxic")).cast("string").alias("pred")
    )
    return stats.outcome_counts(rows)


OUTCOMES_SQL = "o as (select quality::varchar as truth, (1 - toxic)::varchar as pred from labels)"


@registry.add("confusion", f"""with {OUTCOMES_SQL}, l as (select unnest(['0', '1', '2']) as truth)
 select truth, count(*) filter (where pred = '0') as p_0, count(*) filter (where pred = '1') as p_1, 0 as p_2
 from l left join o using (truth) group by truth""")
def confusion(spark, folder):
    return stats.confusion(outcomes(spark, folder), ["0", "1", "2"])


@registry.add("accuracy", f"""with {OUTCOMES_SQL}, a as (select count(*) as rows, avg((truth = pred)::int) as accuracy from o)
 select rows, round(accuracy, 6) as accuracy, round(accuracy, 4) * 100 as accuracy_pct from a""")
def accuracy(spark, folder):
    return rounded(stats.accuracy(outcomes(spark, folder)), "accuracy")


@registry.add("class_report", f"""with {OUTCOMES_SQL}, l as (select truth as label from o union select pred from o),
 c as (select label, (select count(*) from o where truth = label) as support, (select count(*) from o where pred = label) as predicted,
   (select count(*) from o where truth = label and pred = label) as tp from l),
 s as (select label, coalesce(tp / nullif(predicted, 0), 0) as precision, coalesce(tp / nullif(support, 0), 0) as recall,
   coalesce(2 * tp / nullif(support + predicted, 0), 0) as f1, support, tp from c),
 u as (select label, precision, recall, f1, support from s
  union all select 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)::bigint from s
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from s
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::bigint from s)
 select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from u""")
def class_report(spark, folder):
    return rounded(stats.class_report(outcomes(spark, folder)), "precision", "recall", "f1")


SCORES = [f"c{i:02}" for i in range(64)]


@registry.add("argmax_label", """with e as (select vec_id, embedding as s from embeddings)
 select vec_id, list_position(s, list_max(s)) - 1 as best, 'c' || lpad((list_position(s, list_max(s)) - 1)::varchar, 2, '0') as label from e""")
def argmax_label(spark, folder):
    rows = embeddings(spark, folder).withColumn("best", argmax(F.col("embedding")))
    return rows.select("vec_id", "best", label_at(F.col("best"), SCORES).alias("label"))


VECTOR_SPLIT_SQL = "('0x' || substr(md5('42|' || vec_id), 1, 8))::bigint % 1000 < 900"


def vectors(spark, folder):
    rows = random_split(embeddings(spark, folder).select("vec_id", "label", "x"), ["vec_id"])
    return rows.where("split = 'train'"), rows.where("split <> 'train'")


@registry.add("knn1", f"""with e as (select vec_id, label, embedding::double[] as x, {VECTOR_SPLIT_SQL} as training from embeddings),
 d as (select q.vec_id as qid, t.vec_id as neighbour, t.label, list_distance(q.x, t.x) as distance
       from e q, e t where not q.training and t.training)
 select qid, neighbour, label, round(distance, 6) as distance from d
 qualify row_number() over (partition by qid order by distance, neighbour) = 1""")
def knn1(spark, folder):
    return rounded(nearest_exact(*vectors(spark, folder), "vec_id", "label", "vec_id", "x"), "distance")


# Some vectors with a component missing, and training rows too.
MISSING_SQL = f"""e as (select vec_id, label, case when vec_id % 7 = 3 then null else embedding end::double[] as x,
   {VECTOR_SPLIT_SQL} as training from embeddings)"""


@registry.add("knn_missing", f"""with {MISSING_SQL},
 d as (select q.vec_id as qid, t.vec_id as neighbour, t.label, list_distance(q.x, t.x) as distance
       from e q, e t where not q.training and t.training and q.x is not null and t.x is not null),
 best as (select * from d qualify row_number() over (partition by qid order by distance, neighbour) = 1)
 select e.vec_id as qid, neighbour, best.label, round(distance, 6) as distance
 from e left join best on best.qid = e.vec_id where not training""")
def knn_missing(spark, folder):
    """Rows that can't be compared keep their place, without a neighbour."""
    hole = F.transform("x", lambda v, i: F.when(i != F.col("vec_id") % 64, v))
    train, test = (
        df.withColumn("x", F.when(F.col("vec_id") % 7 != 3, F.col("x")).when(F.col("vec_id") % 2 == 0, hole)) for df in vectors(spark, folder)
    )
    return rounded(nearest_exact(train, test, "vec_id", "label", "vec_id", "x"), "distance")


CLUSTERS = 20
# Training vectors a query may be compared with whatever their number.
FEW_VECTORS = 256


@registry.add("knn_pruned", f"""with e as (select vec_id, {VECTOR_SPLIT_SQL} as training,
   list_transform(embedding::double[], lambda v, i: v + case when i - 1 = vec_id % {CLUSTERS} then 10 else 0 end) as x from embeddings),
 d as (select q.vec_id as qid, t.vec_id as neighbour, list_distance(q.x, t.x) as distance
       from e q join e t on q.vec_id % {CLUSTERS} = t.vec_id % {CLUSTERS} where not q.training and t.training)
 select qid, neighbour, round(distance, 6) as distance, true as pruned from d
 qualify row_number() over (partition by qid order by distance, neighbour) = 1""")
def knn_pruned(spark, folder):
    """Vectors pushed apart into clusters: the exact neighbour, compared with at most a tenth of the training vectors and a few more."""
    moved = F.transform("x", lambda v, i: v + F.when(i == F.col("vec_id") % CLUSTERS, 10.0).otherwise(0.0))
    train, test = (df.withColumn("x", moved) for df in vectors(spark, folder))
    found = nearest_exact(train, test, "vec_id", "label", "vec_id", "x", compared=True)
    mean, n = found.agg(F.avg("compared")).first()[0], train.select(F.countDistinct("x")).first()[0]
    pruned = F.lit(mean is None or mean <= 0.1 * n + FEW_VECTORS)
    return rounded(found, "distance").select("qid", "neighbour", "distance", pruned.alias("pruned"))


# Share of exact neighbours that hashing must find with these parameters.
LSH_RECALL = 0.95


@registry.add("knn_lsh", f"""with e as (select vec_id, {VECTOR_SPLIT_SQL} as training from embeddings)
 select count(*) as rows, true as no_closer, true as recalled from e where not training""")
def knn_lsh(spark, folder):
    """Against the exact answer: no row lost, no distance below the exact one, enough of them equal."""
    sides = vectors(spark, folder)
    near = nearest_by_hash(*sides, "vec_id", "label", "vec_id", "x", bucket_length=0.1, tables=4)
    exact = nearest_exact(*sides, "vec_id", "label", "vec_id", "x").select("qid", F.col("distance").alias("least"))
    both = near.join(exact, "qid")
    same = F.col("distance") <= F.col("least") * (1 + 1e-9)
    return both.agg(
        F.count("*").alias("rows"), F.coalesce(F.every(F.col("distance") >= F.col("least") * (1 - 1e-9)), F.lit(True)).alias("no_closer"),
        (F.coalesce(F.avg(same.cast("int")), F.lit(1.0)) >= LSH_RECALL).alias("recalled"),
    )
