"""Queries that read and write files, train models, answer requests and run streams."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trackframe.functions.columns import row_key
from trackframe.operators.sample import random_split
from trackframe.operators.scoring import answer_requests, extract_features, parse_requests, predict_foreign
from trackframe.operators.scoring import reply_json as add_reply
from trackframe.operators.stats import accuracy
from trackframe.plans import training
from trackframe.plans.dataset import run as run_builder
from trackframe.plans.trees import tree_depths
from trackframe.registry.rows import DEDUPE, CUTOFF
from trackframe.registry.tables import (
    EVENTS_SQL, ITEM_FEATURES, ITEM_ID, ITEM_SPEC, ITEM_VOCABULARY, ITEMS_SQL, Registry, embeddings, events, items, table,
)
from trackframe.session import scratch_path
from trackframe.sources import files, sinks
from trackframe.spec import DatasetSpec
from trackframe.streaming import service

registry = Registry()
IDS = ", ".join(ITEM_ID)

# --- files -----------------------------------------------------------------------------------

COLUMNS_SQL = ", ".join(ITEM_SPEC.columns)


@registry.add("scan_dir", f"with {ITEMS_SQL} select {COLUMNS_SQL} from items")
def scan_dir(spark, folder):
    path = scratch_path(spark, "scan")
    sinks.write_csv(items(spark, folder), path, ITEM_SPEC.columns)
    return files.scan_csv(spark, path, ITEM_SPEC).select(*ITEM_SPEC.columns)


@registry.add("write_roundtrip", f"with {ITEMS_SQL} select {COLUMNS_SQL}, label from items")
def write_roundtrip(spark, folder):
    """Parquet by class and back; the class column comes from the folder names."""
    path = f"{scratch_path(spark, 'roundtrip')}/dataset.parquet"
    sinks.write_by_label(items(spark, folder).select(*ITEM_SPEC.columns, "label"), path)
    return spark.read.parquet(path).select(*ITEM_SPEC.columns, F.col("label").cast("string").alias("label"))


@registry.add("quarantine_files", f"with {ITEMS_SQL} select {COLUMNS_SQL} from items where flag <> 2")
def quarantine_files(spark, folder):
    """The files of one class lack a column, so none of their rows may appear."""
    path = scratch_path(spark, "quarantine")
    rows = items(spark, folder)
    sinks.write_csv(rows.where("flag <> 2"), f"{path}/sound", ITEM_SPEC.columns)
    sinks.write_csv(rows.where("flag = 2"), f"{path}/narrow", ITEM_SPEC.columns[:-1])
    kept, _ = files.quarantine_files(spark, f"{path}/*", ITEM_SPEC)
    return kept.select(*ITEM_SPEC.columns)


@registry.add("exclude_suffix", f"with {ITEMS_SQL} select {COLUMNS_SQL} from items")
def exclude_suffix(spark, folder):
    """Data files end in .csv, the copies written as .txt are passed over."""
    path = scratch_path(spark, "suffix")
    rows = items(spark, folder)
    sinks.write_csv(rows, f"{path}/data", ITEM_SPEC.columns)
    rows.select(F.concat_ws(",", *ITEM_SPEC.columns).alias("value")).write.text(f"{path}/copy")
    return files.scan_csv(spark, f"{path}/*", ITEM_SPEC, exclude_suffixes=[".txt"]).select(*ITEM_SPEC.columns)


@registry.add("write_count", f"""with {ITEMS_SQL}, read as (select label, count(*) as rows_read from items group by label),
 kept as (select distinct {", ".join(c for c in ITEM_SPEC.columns if c not in ITEM_SPEC.dedupe_ignore)}, label from items where l_discount <> 0),
 written as (select label, count(*) as rows_written from kept group by label),
 back as (select sum(rows_written)::bigint as in_files from written)
 select label, rows_read, coalesce(rows_written, 0) as rows_written, in_files from read left join written using (label), back""")
def write_count(spark, folder):
    """A run of the builder from CSV files to a dataset: rows per class read and written, and found in its files."""
    path = scratch_path(spark, "count")
    sinks.write_csv(items(spark, folder), f"{path}/in", ITEM_SPEC.columns)
    report = run_builder(spark, DatasetSpec(data_dir=f"{path}/in", features=ITEM_SPEC, vocabulary=ITEM_VOCABULARY), f"{path}/out")
    back = files.scan_csv(spark, f"{path}/out", ITEM_SPEC).agg(F.count("*").alias("in_files"))
    return report.withColumn("in_files", back.scalar())


# --- models ----------------------------------------------------------------------------------

# The class to learn is a rule over two features, so that a right prediction can be told in SQL.
# Grades of an event's two numbers: 0 to 4 and 0 to 3. The same text is valid in both engines.
V = "least(floor(value / 20), 4)"
Q = "floor(k / 25)"
RULE = "case when v >= 3 then 'hot' when q >= 2 then 'warm' else 'cold' end"
RULE_SQL = f"""{EVENTS_SQL},
 graded as (select *, {V} as v, {Q} as q from ev),
 rule as (select event_id, {RULE} as label from graded)"""
RULE_LABELS = ["hot", "warm", "cold"]


def graded(spark, folder):
    rows = events(spark, folder)
    rows = rows.withColumns({"v": F.expr(V).cast("double"), "q": F.expr(Q).cast("double")})
    return rows.select("event_id", "bucket", "v", "q", F.expr(RULE).alias("label"))


def rule_model(rows, kind, params):
    train = random_split(rows, ["event_id"]).where("split = 'train'")
    return training.label_pipeline(kind, ["v", "q"], RULE_LABELS, params=params).fit(train)


FOREST = {"trees": 15, "depth": 6, "share": 1.0}


def with_lost(spark, folder):
    """Graded events, every eleventh without its first number (NULL or NaN), which makes it a class of its own."""
    lost = F.col("event_id") % 11 == 5
    return graded(spark, folder).withColumns({
        "v": F.when(~lost, F.col("v")).when(F.col("event_id") % 2 == 0, F.lit(float("nan"))),
        "label": F.when(lost, "lost").otherwise(F.col("label")),
    })


@registry.add("rf_classify", f"with {RULE_SQL} select event_id, label, label as predicted_label from rule")
def rf_classify(spark, folder):
    rows = graded(spark, folder)
    return rule_model(rows, "rf", FOREST).transform(rows).select("event_id", "label", "predicted_label")


@registry.add("gb_classify", f"with {RULE_SQL} select event_id, label, label as predicted_label from rule")
def gb_classify(spark, folder):
    rows = graded(spark, folder)
    model = rule_model(rows, "gb", {"trees": 4, "depth": 4, "rate": 0.3})
    return model.transform(rows).select("event_id", "label", "predicted_label")


@registry.add("gb_missing", f"""with {RULE_SQL}, m as (select event_id, case when event_id % 11 = 5 then 'lost' else label end as label from rule)
 select event_id, label, label as predicted_label from m""")
def gb_missing(spark, folder):
    """A missing number is a value of its own to trees: here it is a class."""
    rows = with_lost(spark, folder)
    train = random_split(rows, ["event_id"]).where("split = 'train'")
    model = training.label_pipeline("gb", ["v", "q"], [*RULE_LABELS, "lost"], params={"trees": 4, "depth": 4, "rate": 0.3}).fit(train)
    return model.transform(rows).select("event_id", "label", "predicted_label")


@registry.add("gb_softmax", f"""with {RULE_SQL}, m as (select event_id, case when event_id % 11 = 5 then 'lost' else label end as label from rule)
 select event_id, label, label as predicted_label, true as stopped_early from m""")
def gb_softmax(spark, folder):
    """One ensemble for four classes, two of them told by what is missing, that ends when dev rows no longer profit."""
    rows = with_lost(spark, folder)
    split = random_split(rows, ["event_id"])
    train, dev = split.where("split = 'train'"), split.where("split = 'dev'")
    pipeline = training.label_pipeline("gb", ["v", "q"], [*RULE_LABELS, "lost"], params={"trees": 200, "depth": 3})
    model, seen = pipeline.fit_with_dev(train, dev, patience=10)
    stopped = F.lit(len(seen) < 20 and max(seen) == seen[0] == 1.0)
    return model.transform(rows).select("event_id", "label", "predicted_label", stopped.alias("stopped_early"))


# Numbers of 70 groups, told by 70 flags. Odd and even ones take turns, so a split peels off one number at a time, and
# 35 of them must go before the rest is of one class.
FLAGS = 70


@registry.add("rf_deep", f"""select event_id, case when event_id % {FLAGS} % 2 = 0 then 'even' else 'odd' end as label,
 case when event_id % {FLAGS} % 2 = 0 then 'even' else 'odd' end as predicted_label, true as deeper_than_30 from events""")
def rf_deep(spark, folder):
    """A rule that no tree of 30 levels can hold."""
    k = F.col("event_id") % FLAGS
    rows = events(spark, folder).select("event_id", F.when(k % 2 == 0, "even").otherwise("odd").alias("label"), *[(k == i).cast("double").alias(f"f{i}") for i in range(FLAGS)])
    train = random_split(rows, ["event_id"]).where("split = 'train'")
    model = training.label_pipeline("rf", [f"f{i}" for i in range(FLAGS)], ["even", "odd"], params={"trees": 3, "depth": 60, "share": 1.0}).fit(train)
    forest = model.stages[-2].ensemble
    deep = min(tree_depths(g).max() for g in forest.groups) > 30
    return model.transform(rows).select("event_id", "label", "predicted_label", F.lit(bool(deep)).alias("deeper_than_30"))


@registry.add("mlp_classify", f"with {RULE_SQL} select event_id, label, label as predicted_label from rule")
def mlp_classify(spark, folder):
    rows = graded(spark, folder)
    model = rule_model(rows, "dense", {"hidden": [16], "epochs": 300})
    return model.transform(rows).select("event_id", "label", "predicted_label")


@registry.add("mlp_deep", f"with {RULE_SQL} select event_id, label, label as predicted_label from rule")
def mlp_deep(spark, folder):
    """Twelve layers of weights, stopped on dev rows."""
    rows = graded(spark, folder)
    split = random_split(rows, ["event_id"])
    pipeline = training.label_pipeline("dense", ["v", "q"], RULE_LABELS, params={"hidden": [24] * 11, "epochs": 400, "rate": 0.002})
    model, _ = pipeline.fit_with_dev(split.where("split = 'train'"), split.where("split <> 'train'"), patience=60, step=10)
    return model.transform(rows).select("event_id", "label", "predicted_label")


@registry.add("grid_search", """select * from (values
  ('depth=1, impurity=entropy', false), ('depth=1, impurity=gini', false), ('depth=4, impurity=entropy', true),
  ('depth=4, impurity=gini', true), ('depth=35, impurity=entropy', true), ('depth=35, impurity=gini', true)) t(params, perfect)""")
def grid_search(spark, folder):
    """One split can't tell the rule, four levels can; no level is too deep."""
    table, _ = training.grid_search(
        graded(spark, folder), ["v", "q"], "label", RULE_LABELS, "rf", {"depth": [1, 4, 35], "impurity": ["entropy", "gini"]},
        ["event_id"], ["bucket"], params={"trees": 3, "share": 1.0},
    )
    return table.select("params", (F.col("mean_score") == 1).alias("perfect"))


@registry.add("grid_boost", """select 'depth=' || d || ', rate=' || r || ', trees=' || t as params, true as perfect
 from (values (3), (5)) a(d), (values ('0.3'), ('0.9')) b(r), (values (2), (4)) c(t)""")
def grid_boost(spark, folder):
    """Every combination of boosting, with missing numbers; both numbers of rounds come from one fit a fold."""
    table, _ = training.grid_search(
        with_lost(spark, folder), ["v", "q"], "label", [*RULE_LABELS, "lost"], "gb",
        {"trees": [2, 4], "depth": [3, 5], "rate": [0.3, 0.9]}, ["event_id"], ["bucket"],
    )
    return table.select("params", (F.col("mean_score") == 1).alias("perfect"))


@registry.add("pca_stage", """select count(*) as rows, 4 as components, true as orthonormal, true as falling, true as variance_agrees
 from embeddings""")
def pca_stage(spark, folder):
    """The reduction inside a label pipeline: its axes and the variance of what it returns."""
    names = [f"x{i}" for i in range(64)]
    rows = embeddings(spark, folder).select("vec_id", F.col("label").cast("string").alias("label"), *[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    labels = [str(i) for i in range(10)]
    model = training.label_pipeline("rf", names, labels, components=4, params={"trees": 2, "depth": 3}).fit(rows)
    axes = next(s for s in model.stages if isinstance(s, PCAModel))
    out, whole = model.transform(rows), vector_to_array(axes.getInputCol())
    reduced = vector_to_array(axes.getOutputCol())
    measures = [F.var_samp(reduced[i]).alias(f"r{i}") for i in range(4)] + [F.var_samp(whole[i]).alias(f"w{i}") for i in range(64)]
    found = out.agg(F.count("*").alias("rows"), F.max(F.size(reduced)).alias("components"), *measures).first()
    share = [found[f"r{i}"] / sum(found[f"w{i}"] for i in range(64)) for i in range(4)]
    pc, explained = axes.pc.toArray(), axes.explainedVariance.toArray()
    flags = (
        bool(abs(pc.T @ pc - np.eye(4)).max() < 1e-6), bool((np.diff(explained) <= 1e-12).all()), bool(abs(explained - share).max() < 1e-6),
    )
    return spark.createDataFrame(
        [(found["rows"], found["components"], *flags)], "rows long, components int, orthonormal boolean, falling boolean, variance_agrees boolean"
    )


@registry.add("model_roundtrip", f"""with {RULE_SQL}, s as (
   select event_id, label, ('0x' || substr(md5('42|' || event_id), 1, 8))::bigint % 1000 < 900 as training from rule)
 select 'rf' as kind, count(*) as rows, count(*) as same, 1.0::double as accuracy,
  (select count(*) from s where training) as train_rows, (select count(*) from s where not training) as test_rows from s""")
def model_roundtrip(spark, folder):
    """Save, load by the stored kind, and compare both models' answers."""
    rows = graded(spark, folder)
    model = rule_model(rows, "rf", FOREST)
    split = random_split(rows, ["event_id"])
    counts = training.evaluate(model.transform(split.where("split <> 'train'")))
    path = training.save(model, "rf", scratch_path(spark, "models"), counts, split.where("split = 'train'").count())
    kind, loaded = training.load(spark, path)
    both = model.transform(rows).select("event_id", F.col("predicted_label").alias("first")).join(
        loaded.transform(rows).select("event_id", "predicted_label"), "event_id"
    )
    same = both.agg(F.count("*").alias("rows"), F.count_if(F.col("first") == F.col("predicted_label")).alias("same"))
    meta = spark.read.json(f"{path}/metrics").first()
    return same.select(
        F.lit(kind).alias("kind"), "rows", "same", F.lit(meta.accuracy).alias("accuracy"),
        F.lit(meta.train_rows).cast("long").alias("train_rows"), F.lit(meta.test_rows).cast("long").alias("test_rows"),
    )


@registry.add("foreign_score", "select event_id, round(0.5 * value + 2, 6) as predicted from events")
def foreign_score(spark, folder):
    """A linear function of two inputs plays a model of another library."""

    def load():
        weights = [0.5, 2.0]
        return lambda batch: batch @ weights

    rows = events(spark, folder).select("event_id", "value", F.lit(1.0).alias("one"))
    return predict_foreign(rows, load, ["value", "one"]).select("event_id", F.round("predicted", 6).alias("predicted"))


# --- requests --------------------------------------------------------------------------------

# Event types play the ways a request can be wrong: errors lack a feature, some sign-ups send
# text for one, purchases have no reply id, some clicks are cut off in the middle.
FAULT_SQL = """case when event_type = 'click' and value < 20 then 'malformed'
  when event_type = 'view' and value < 20 then 'no version'
  when event_type = 'error' then 'no number for q'
  when event_type = 'signup' and value > 90 then 'no number for q' end"""
BROKEN_SQL = "(event_type = 'click' and value < 20)"
ENVELOPE_FAULT_SQL = """case when event_type = 'click' and value < 20 then 'malformed'
  when event_type = 'view' and value < 20 then 'no version' end"""


def requests(spark, folder):
    rows = events(spark, folder)
    v, q = F.expr(V), F.expr(Q).cast("string")
    kind = F.col("event_type")
    q_text = F.when(kind == "error", "").when((kind == "signup") & (F.col("value") > 90), ',"q":"many"').otherwise(F.concat(F.lit(',"q":'), q))
    version = F.when((kind == "view") & (F.col("value") < 20), "").otherwise(',"version":"v2"')
    reply_id = F.when(kind == "purchase", "").otherwise(F.concat(F.lit(',"ReplyId":'), F.col("event_id").cast("string")))
    text = F.concat(
        F.lit('{"AppName":"app-'), F.col("user_id").cast("string"), F.lit('","Command":"'), kind, F.lit('"'), reply_id,
        F.lit(',"ReplyInfo":"udp:host-'), F.col("user_id").cast("string"), F.lit(':12002","Parameters":{"v":'),
        v.cast("string"), q_text, version, F.lit("}}"),
    )
    broken = (kind == "click") & (F.col("value") < 20)
    return rows.select("event_id", F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def text_of(column):
    return F.col(column).cast("string").alias(column)


@registry.add("parse_request", f"""select event_id,
  case when not {BROKEN_SQL} then 'app-' || user_id end as app_name, case when not {BROKEN_SQL} then event_type end as command,
  case when not {BROKEN_SQL} and event_type <> 'purchase' then event_id::varchar end as reply_id,
  case when not {BROKEN_SQL} then 'host-' || user_id end as reply_host, case when not {BROKEN_SQL} then 12002 end as reply_port,
  {ENVELOPE_FAULT_SQL} as fault from events""")
def parse_request(spark, folder):
    parsed = parse_requests(requests(spark, folder))
    return parsed.select("event_id", *[text_of(c) for c in ("app_name", "command", "reply_id")], "reply_host", "reply_port", "fault")


@registry.add("extract_features", f"""with {EVENTS_SQL} select event_id,
  case when not {BROKEN_SQL} then {V} end as v,
  case when not {BROKEN_SQL} and event_type <> 'error' and not (event_type = 'signup' and value > 90) then {Q} end as q,
  case when {BROKEN_SQL} then 'v,q' when event_type = 'error' or (event_type = 'signup' and value > 90) then 'q' else '' end as missing,
  {FAULT_SQL} as fault from ev""")
def features_of_requests(spark, folder):
    rows = extract_features(parse_requests(requests(spark, folder)), ["v", "q"])
    return rows.select("event_id", "v", "q", F.array_join("missing_features", ",").alias("missing"), "fault")


REPLY_FIELDS = {
    "app_name": "$.AppName", "command": "$.ReplyForCommand", "reply_id": "$.ReplyId", "status": "$.ReplyStatus",
    "target": "$.Parameters.grade", "version": "$.Parameters.version",
}


def reply_fields(df):
    return df.select("event_id", *[F.get_json_object("reply", p).alias(n) for n, p in REPLY_FIELDS.items()])


# A whole number, a fraction or text plays the prediction.
@registry.add("reply_json", f"""with {EVENTS_SQL}, ok as (select *, {FAULT_SQL} is null as good from ev)
 select event_id, case when good then 'app-' || user_id end as app_name, case when good then event_type end as command,
  case when good and event_type <> 'purchase' then event_id::varchar end as reply_id, case when good then 'Normal' end as status,
  case when good then case event_type when 'view' then ({V})::int::varchar
     when 'click' then (({V})::int)::varchar || '.5' else 'grade-' || ({V})::int end end as target,
  case when good then 'v2' end as version from ok""")
def reply_json(spark, folder):
    rows = extract_features(parse_requests(requests(spark, folder)), ["v", "q"])
    kind = F.col("command").cast("string")
    whole = F.col("v").cast("int").cast("string")
    answer = F.when(kind == "view", F.col("v").cast("string")).when(kind == "click", F.concat(whole, F.lit(".5"))).otherwise(
        F.concat(F.lit("grade-"), whole)
    )
    return reply_fields(add_reply(rows.withColumn("predicted", answer), "grade"))


ANSWER_SQL = f"""with {RULE_SQL}, said as (select ev.event_id, event_type, user_id, {FAULT_SQL} as fault, label
   from ev join rule on ev.event_id = rule.event_id)"""


@registry.add("batch_score", f"""{ANSWER_SQL} select event_id, case when fault is null then 'reply' else 'dead' end as outcome,
  case when fault is null then label end as target, fault from said""")
def batch_score(spark, folder):
    model = rule_model(graded(spark, folder), "rf", FOREST)
    out = answer_requests(requests(spark, folder), model, ["v", "q"], "grade")
    return out.select("event_id", "outcome", F.get_json_object("reply", "$.Parameters.grade").alias("target"), "fault")


@registry.add("stream_score", f"""{ANSWER_SQL} select case when fault is null then 'reply' else 'dead' end as outcome,
  case when fault is null and event_type <> 'purchase' then event_id::varchar end as reply_id,
  case when fault is null then 'app-' || user_id end as app_name,
  case when fault is null then label end as target, fault from said""")
def stream_score(spark, folder):
    """Requests arrive as text files; replies and dead letters come back from the sink."""
    base = scratch_path(spark, "requests")
    requests(spark, folder).select("value").repartition(8, row_key("value")).write.text(f"{base}/in")
    model = rule_model(graded(spark, folder), "rf", FOREST)
    stream = service.read_requests(spark, f"{base}/in", files_per_batch=4)
    service.score_stream(stream, model, ["v", "q"], "grade", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    field = lambda path: F.get_json_object("reply", path)
    return out.select(
        "outcome", field("$.ReplyId").alias("reply_id"), field("$.AppName").alias("app_name"),
        field("$.Parameters.grade").alias("target"), "fault",
    )


@registry.add("topic_score", f"""{ANSWER_SQL} select case when fault is null then 'replies' else 'dead' end as topic,
  case when fault = 'malformed' then '' else 'host-' || user_id || ':12002' end as key,
  case when fault is null then label end as target, fault from said""")
def topic_score(spark, folder):
    """The topic path through a stream; files play the topics."""
    base = scratch_path(spark, "topics")
    requests(spark, folder).select("value").repartition(4, row_key("value")).write.text(f"{base}/in")
    model = rule_model(graded(spark, folder), "rf", FOREST)
    stream = service.read_requests(spark, f"{base}/in", files_per_batch=2)
    writer = service.score_to_topic(
        stream, model, ["v", "q"], "grade", "replies", "dead", f"{base}/checkpoint", {"path": f"{base}/out"}, sink="parquet"
    )
    writer.start().awaitTermination()
    field = lambda path, topic: F.when(F.col("topic") == topic, F.get_json_object("value", path))
    return spark.read.parquet(f"{base}/out").select(
        "topic", "key", field("$.Parameters.grade", "replies").alias("target"), field("$.fault", "dead").alias("fault")
    )


@registry.add("stream_running_mean", """select user_id, sum(round(value * 100)::bigint)::bigint as total, count(*) as n,
  sum(round(value * 100)::bigint)::double / count(*) as mean from events group by user_id""")
def stream_running_mean(spark, folder):
    base = scratch_path(spark, "means")
    source = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    cents = source.select("user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    service.running_mean_stream(cents, ["user_id"], "cents", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return service.latest_means(spark, f"{base}/out", ["user_id"])


@registry.add("stream_ingest", f"""with {ITEMS_SQL}, merged as (
 select *, case when l_shipdate >= '{CUTOFF}' then 0 else 1 end as src from items)
 select {IDS}, l_quantity, l_tax from (select * from merged
  qualify row_number() over (partition by {', '.join(DEDUPE)} order by src, {IDS}) = 1) where l_tax <> 0""")
def stream_ingest(spark, folder):
    """Two deliveries; the second run starts from the checkpoint of the first."""
    base = scratch_path(spark, "ingest")
    rows = items(spark, folder).select(*ITEM_ID, "l_quantity", "l_tax", "l_shipdate")
    for delivery in (rows.where(F.col("l_shipdate") < CUTOFF), rows.where(F.col("l_shipdate") >= CUTOFF)):
        delivery.drop("l_shipdate").write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(delivery.drop("l_shipdate").schema).parquet(f"{base}/in")
        service.ingest_stream(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return service.current_dataset(spark, f"{base}/out", DEDUPE, ITEM_ID, ["l_tax"]).drop("batch")
