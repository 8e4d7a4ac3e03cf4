import json

import pytest
from pyspark.sql import functions as F

from trackframe.operators.scoring import answer_requests, extract_features, parse_requests, reply_json
from trackframe.operators.timeline import extend_one, timeline_long, trace_series, truth_vs_pred
from trackframe.plans import training
from trackframe.sources.files import scan_timeline
from trackframe.sources.sinks import write_traces
from trackframe.streaming import service

FEATURES = ["p", "odd name"]


def request(p=1.0, q=2.0, **more):
    body = {"AppName": "app", "Command": "classify", "ReplyId": 7, "ReplyInfo": "udp:host:12002",
            "Parameters": {"p": p, "odd name": q, "version": 1.5, "other": 3}}
    body.update(more)
    return json.dumps({k: v for k, v in body.items() if v != "drop"})


@pytest.fixture(scope="module")
def model(spark):
    rows = [(float(i % 2), float(i % 5), "2200" if i % 2 else "1111") for i in range(60)]
    train = spark.createDataFrame(rows, ["p", "odd name", "label"])
    return training.label_pipeline("rf", FEATURES, ["1111", "2200"], params={"trees": 3, "depth": 3, "share": 1.0}).fit(train)


CASES = {
    "whole": request(), "no id": request(ReplyId="drop"), "null id": request(ReplyId=None), "text id": request(ReplyId="x"),
    "cut": request()[:30], "text": request(p="high"), "number as text": request(p="1.0"), "no command": request(Command="drop"),
    "lacking": request(Parameters={"p": 1.0, "version": 2}), "no version": request(Parameters={"p": 1.0, "odd name": 2.0}),
    "no parameters": request(Parameters="drop"), "empty": "", "no address": request(ReplyInfo=""),
}


def test_answers(spark, model):
    df = spark.createDataFrame(list(CASES.items()), "name string, value string")
    got = {r.name: r for r in answer_requests(df, model, FEATURES, "kind").collect()}
    assert json.loads(got["whole"].reply) == {
        "AppName": "app", "ReplyForCommand": "classify", "ReplyId": 7, "ReplyStatus": "Normal",
        "Parameters": {"kind": 2200, "version": 1.5},
    }
    assert (got["whole"].reply_host, got["whole"].reply_port) == ("host", 12002)
    assert "ReplyId" not in json.loads(got["no id"].reply)
    assert json.loads(got["null id"].reply)["ReplyId"] is None and json.loads(got["text id"].reply)["ReplyId"] == "x"
    assert got["number as text"].outcome == "reply" and got["no address"].reply_host is None
    faults = {n: r.fault for n, r in got.items() if r.outcome == "dead"}
    assert faults == {
        "cut": "malformed", "text": "no number for p", "no command": "no Command", "lacking": "no number for odd name",
        "no version": "no version", "no parameters": "no version", "empty": "malformed",
    }
    assert all(got[n].reply is None for n in faults)


def test_prediction_types_in_replies(spark):
    df = spark.createDataFrame([(request(), p) for p in ("2200", "0.25", "-3.0", "name", None)], "value string, predicted string")
    rows = extract_features(parse_requests(df), FEATURES)
    replies = [r.reply for r in reply_json(rows, "t").collect()]
    shown = [json.loads(r)["Parameters"]["t"] for r in replies[:4]]
    assert shown == [2200, 0.25, -3, "name"] and isinstance(shown[0], int) and replies[4] is None


def test_stream_equals_batch_and_restart_adds_nothing(spark, model, tmp_path):
    lines = [request(p=float(i % 2), ReplyId=i) for i in range(40)] + list(CASES.values())
    inbox = tmp_path / "in"
    inbox.mkdir()
    for i in range(4):
        (inbox / f"{i}.txt").write_text("\n".join(l for l in lines[i::4] if l) + "\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def deliver():
        stream = service.read_requests(spark, str(inbox), files_per_batch=1)
        service.score_stream(stream, model, FEATURES, "kind", out, checkpoint).awaitTermination()
        return sorted((r.outcome, r.value, r.reply or "") for r in spark.read.parquet(out).collect())

    batch = answer_requests(spark.createDataFrame([(l,) for l in lines if l], "value string"), model, FEATURES, "kind")
    want = sorted((r.outcome, r.value, r.reply or "") for r in batch.collect())
    assert deliver() == want
    assert deliver() == want
    (inbox / "late.txt").write_text(request(ReplyId="late") + "\n")
    assert len(deliver()) == len(want) + 1


def test_running_means_keep_their_state(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for values in ([("a", 1.0), ("b", 5.0)], [("a", 4.0)]):
        spark.createDataFrame(values, "k string, v double").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, v double").parquet(source)
        service.running_mean_stream(stream, ["k"], "v", out, checkpoint).awaitTermination()
    got = {r.k: (r.total, r.n, r["mean"]) for r in service.latest_means(spark, out, ["k"]).collect()}
    assert got == {"a": (5.0, 2, 2.5), "b": (5.0, 1, 5.0)}


def test_ingest_prefers_the_newest_delivery(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "id long, key int, climb double"
    for rows in ([(1, 1, 3.0), (2, 2, 0.0), (3, 2, 6.0), (4, 3, 1.0)], [(9, 1, 8.0), (10, 3, 0.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        service.ingest_stream(spark.readStream.schema(schema).parquet(source), out, checkpoint).awaitTermination()
    got = service.current_dataset(spark, out, ["key"], ["id"], ["climb"]).collect()
    # Key 2 was lost with its first row, key 3 with the newest delivery.
    assert [(r.key, r.climb) for r in got] == [(1, 8.0)]


def test_requests_need_one_source(spark):
    with pytest.raises(ValueError):
        service.read_requests(spark)


WIDE = """Time,SystemTrack10,SystemTrack10-Truth,SystemTrack2,SystemTrack2-Truth
1.0,_,_,X,X
2.0,A,B,_,X
4.5,_,B,Y,X
5.0,_,_,_,X
7.0,C,_,_,X
8.0,_,_,_,X
"""


def test_timeline(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(WIDE)
    long = timeline_long(scan_timeline(spark, str(tmp_path / "wide.csv")))
    extended = extend_one(long, ["track", "role"])
    series = {}
    for r in extended.orderBy("time").collect():
        series.setdefault((r.track, r.role), []).append(r.value)
    assert series == {
        (10, "pred"): [None, "A", "A", None, "C", None], (10, "truth"): [None, "B", "B", "B", None, None],
        (2, "pred"): ["X", "X", "Y", None, None, None], (2, "truth"): ["X"] * 6,
    }
    binned = extended.withColumn("b", F.floor(F.col("time") / 3))
    marks = {r.track: r for r in truth_vs_pred(binned, ["track"], ["b"]).collect()}
    assert (marks[2].points, marks[2].compared, marks[2].agreed, marks[2].first_time, marks[2].last_time) == (6, 3, 2, 1.0, 8.0)
    assert marks[2].truth_time == 7.0 and marks[2].compared_time == 4.0 and marks[2].agreed_time == 3.5
    assert marks[10].agreed == 0 and marks[10].covered_share == pytest.approx(3.0 / 5.0)
    traces = trace_series(binned, ["track", "role"], ["b"], chunk_rows=4)
    write_traces(traces, str(tmp_path / "traces"))
    back = {(r.track, r.role, r.chunk): r for r in spark.read.json(str(tmp_path / "traces")).collect()}
    assert back[2, "pred", 0]["values"] == ["X", "X", "Y", None] and back[2, "pred", 1]["times"] == [7.0, 8.0]
    assert len(back) == 8


def test_uneven_timelines_are_refused(spark):
    with pytest.raises(ValueError):
        timeline_long(spark.createDataFrame([(1.0, "a")], "Time double, SystemTrack1 string"))


def test_answers_for_topics(spark):
    rows = [("q1", "reply", '{"a":1}', "host", 12, None), ("bad", "dead", None, None, None, "malformed")]
    answered = spark.createDataFrame(rows, "value string, outcome string, reply string, reply_host string, reply_port int, fault string")
    got = {r.topic: (r.key, r.value) for r in service.topic_rows(answered, "replies", "dead-letters").collect()}
    assert got == {"replies": ("host:12", '{"a":1}'), "dead-letters": ("", '{"request":"bad","fault":"malformed"}')}


def test_merged_runs_bound_what_a_reader_looks_at(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    seen = {}
    for i in range(7):
        spark.createDataFrame([("a", float(i)), (f"k{i}", 1.0)], "k string, v double").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k string, v double").parquet(source)
        service.running_mean_stream(stream, ["k"], "v", out, checkpoint, fan=3).awaitTermination()
        got = {r.k: (r.total, r.n) for r in service.latest_means(spark, out, ["k"]).collect()}
        seen = {**seen, "a": (sum(range(i + 1)), i + 1), f"k{i}": (1.0, 1)}
        assert got == seen
    assert service.live_runs(spark, out) == [service.run_name(1, 0, 2), service.run_name(1, 3, 5), service.run_name(0, 6, 6)]
    # Only what the last two manifests list is left: both lists, and the runs that were live before the last batch.
    assert service.manifests(spark, out) == [5, 6] and len(list((tmp_path / "out" / "runs").iterdir())) == 3
    assert spark.read.parquet(f"{out}/runs/{service.run_name(1, 0, 2)}").count() == 4  # one row a key


def test_a_thousand_batches_rewrite_each_row_once_a_level():
    runs, rewritten, most, sizes = [], 0, 0, {}
    for number in range(1000):
        own = service.run_name(0, number, number)
        sizes[own] = 1
        runs, merges = service.merge_plan([*runs, own], 10)
        for parts, merged in merges:
            sizes[merged] = sum(sizes[p] for p in parts)
            rewritten += sizes[merged]
        most = max(most, len(runs))
    assert rewritten == 3 * 1000 and most <= 27 and runs == [service.run_name(3, 0, 999)]


def test_a_batch_that_comes_again_is_stored_once(spark, tmp_path):
    save = service._save(str(tmp_path), lambda rows: rows, 2)
    rows = spark.createDataFrame([(1,)], "x int")
    for number in (0, 0, 1, 2, 2):
        save(rows, number)
    assert sorted(r.batch for r in service.stored(spark, str(tmp_path)).collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="older"):
        save(rows, 1)
    with pytest.raises(ValueError, match="nothing"):
        service.stored(spark, str(tmp_path / "empty"))


def test_merged_runs_keep_the_answer(spark, tmp_path):
    for fan in (2, 100):
        source, out, checkpoint = (str(tmp_path / f"{n}{fan}") for n in ("in", "out", "checkpoint"))
        for i in range(5):
            spark.createDataFrame([(i, i % 2, float(i)), (10 + i, 7, float(i == 4))], "id long, key int, climb double").coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema("id long, key int, climb double").parquet(source)
            service.ingest_stream(stream, out, checkpoint, subset=["key"], order=["id"], fan=fan).awaitTermination()
        got = sorted((r.key, r.id) for r in service.current_dataset(spark, out, ["key"], ["id"], ["climb"]).collect())
        assert got == [(0, 4), (1, 3), (7, 14)]


def test_topics_get_every_answer_once_over_a_restart(spark, tmp_path):
    """The topic path through a stream, into files that play the topics."""
    train = spark.createDataFrame([(float(i % 4), "low" if i % 4 < 2 else "high") for i in range(40)], "v double, label string")
    model = training.label_pipeline("rf", ["v"], ["low", "high"], params={"trees": 3, "depth": 3, "share": 1.0}).fit(train)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def request(i):
        v = '"none"' if i % 5 == 4 else str(i % 4)
        return '{"AppName":"a","Command":"c","ReplyId":%d,"ReplyInfo":"udp:h:%d","Parameters":{"v":%s,"version":"1"}}' % (i, 100 + i, v)

    for first in (0, 10):
        spark.createDataFrame([(request(i),) for i in range(first, first + 10)], "value string").coalesce(2).write.mode("append").text(source)
        writer = service.score_to_topic(service.read_requests(spark, source, files_per_batch=1), model, ["v"], "grade", "replies", "dead", checkpoint, {"path": out}, sink="parquet")
        writer.start().awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.key for r in rows) == sorted(f"h:{100 + i}" for i in range(20))
    assert {r.topic for r in rows} == {"replies", "dead"} and sum(r.topic == "dead" for r in rows) == 4
    assert all(json.loads(r.value)["Parameters"]["grade"] == ("low" if (int(r.key[2:]) - 100) % 4 < 2 else "high") for r in rows if r.topic == "replies")
