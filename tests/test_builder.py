"""The builder on CSV folders, one test per rule that is easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from trackframe.build import parse
from trackframe.operators.clean import clean_rows, dedupe_first, nonzero
from trackframe.operators.sequence import clean_windows, fixed_windows
from trackframe.plans import dataset
from trackframe.plans.dataset import build_dataset, run, write_dataset
from trackframe.session import owned_scratch, stage
from trackframe.sources import files
from trackframe.sources.files import quarantine_files, scan_csv, unclassed_rows
from trackframe.sources.sinks import write_families
from trackframe.spec import TRACK, DatasetSpec, FeatureSpec, Vocabulary

SMALL = FeatureSpec(
    numbers=("speed", "climb", "distance", "signal"), matrix=("m1",), extra=(), classes=("c1", "c2"),
    dedupe_ignore=("climb",), nonzero=("climb", "signal"), minimum={"distance": 300.0},
)
CLASSES = Vocabulary({"11": (1, 1), "20": (2, 0)})
HEADER = "anything,at,all,may,stand,here,now"


def row(speed, climb=1, distance=500, signal=9, m1=0, c1=1, c2=1):
    return f"{speed},{climb},{distance},{signal},{m1},{c1},{c2}"


def folder(tmp_path, files):
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path)


def spec(path, **more):
    return DatasetSpec(data_dir=path, features=SMALL, vocabulary=CLASSES, **more)


def speeds(df):
    return sorted(r.speed for r in df.collect())


def test_scan_keeps_line_order_and_reads_missing_cells(spark, tmp_path):
    path = folder(tmp_path, {"a.csv": [row(i) for i in range(500)], "b.csv": ["1,,NaN,NA,null,2.0,0"]})
    rows = scan_csv(spark, path, SMALL).orderBy("_file", "_blk", "_pos").collect()
    assert [r.speed for r in rows[:500]] == list(range(500))
    last = rows[-1]
    assert (last.climb, last.distance, last.signal, last.m1, last.c1, last.c2) == (None, None, None, None, 2, 0)


def test_files_of_wrong_width_and_excluded_names_give_no_rows(spark, tmp_path):
    path = folder(tmp_path, {"good.csv": [row(1), "2,5"], "long.csv": [row(3), row(4) + ",9"], "x1.csv": [row(5)]})
    (tmp_path / "narrow.csv").write_text("a,b,c\n6,1,2\n")
    kept, bad = quarantine_files(spark, path, SMALL, ["1.csv", "3.csv"])
    assert speeds(kept) == [1, 2]  # a short row is filled up with missing cells
    assert sorted(r._file.rsplit("/", 1)[1] for r in bad.collect()) == ["long.csv", "narrow.csv"]


def test_plain_cleaning_dedupes_before_it_filters(spark, tmp_path):
    lines = [row(1, climb=0), row(1, climb=7), row(2, climb=3), row(2, climb=4), row(3, signal=0), row(4, climb="")]
    path = folder(tmp_path, {"a.csv": lines})
    out = build_dataset(spark, spec(path))
    # 1: its first copy has a zero climb. 3: no signal. 4: a missing climb is not zero.
    assert sorted((r.speed, r.climb) for r in out.collect()) == [(2, 3), (4, None)]


def test_a_default_run_keeps_classes_outside_the_vocabulary(spark, tmp_path):
    path = folder(tmp_path, {"a.csv": [row(1), row(2, c1=7)]})
    assert {r.label for r in build_dataset(spark, spec(path)).collect()} == {"11", "71"}
    added = build_dataset(spark, spec(path, add=True, types=("11",)))
    assert speeds(added) == [1]


def test_add_takes_the_amount_or_the_whole_class(spark, tmp_path):
    lines = [row(i) for i in range(50)] + [row(100 + i, c1=2, c2=0) for i in range(10)] + [row(900, c1=9)]
    path = folder(tmp_path, {"a.csv": lines})
    wanted = spec(path, add=True, types=("11", "20"), amounts=("5", "99"))
    first, again = (speeds(build_dataset(spark, wanted)) for _ in range(2))
    assert first == again
    assert len([s for s in first if s < 100]) == 5 and [s for s in first if s >= 100] == [100 + i for i in range(10)]
    assert len(build_dataset(spark, spec(path, add=True, types=("20", "11"), amounts=(3,))).collect()) == 53


def test_append_prefers_new_rows_and_erase_removes_an_amount(spark, tmp_path):
    (tmp_path / "new").mkdir()
    (tmp_path / "old").mkdir()
    new = folder(tmp_path / "new", {"a.csv": [row(1, climb=5)]})
    old = folder(tmp_path / "old", {"a.csv": [row(1, climb=8), *[row(10 + i) for i in range(20)], row(50, c1=2, c2=0)]})
    both = build_dataset(spark, spec(new, dataset=old))
    assert {r.speed: r.climb for r in both.collect()}[1] == 5
    erase = dict(dataset=old, features=SMALL, vocabulary=CLASSES, erase=True)
    left = build_dataset(spark, DatasetSpec(types=("11",), amounts=(6,), **erase)).collect()
    assert len([r for r in left if r.label == "11"]) == 15 and len([r for r in left if r.label == "20"]) == 1
    gone = build_dataset(spark, DatasetSpec(types=("11", "20"), amounts=(999,), **erase)).collect()
    assert gone == []


def test_windows_are_cut_by_position_and_kept_or_dropped_whole(spark, tmp_path):
    lines = [row(i) for i in range(4)] + [row(10, climb=0), row(11), row(12), row(13)] + [row(20), row(20, climb=2), row(21), row(22)]
    lines += [row(30 + i, distance=299.9 if i == 3 else 300) for i in range(4)] + [row(40 + i, distance=300) for i in range(4)] + [row(99)]
    other = [row(100 + i, c1=2, c2=0) for i in range(3)]
    path = folder(tmp_path, {"a.csv": lines, "b.csv": other})
    out = build_dataset(spark, spec(path, time_series=4))
    # Windows with a zero climb, a copy or a short distance are lost; tails and short groups too.
    assert speeds(out) == [0, 1, 2, 3, 40, 41, 42, 43]


def test_window_amounts_round_down_and_windows_survive_writing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = folder(tmp_path / "in", {"a.csv": [row(i) for i in range(20)], "b.csv": [row(100 + i) for i in range(8)]})
    wanted = spec(path, time_series=4, add=True, types=("11",), amounts=(23,))
    assert speeds(build_dataset(spark, wanted)) == [*range(20)]
    out = str(tmp_path / "out")
    assert ("11", 20) in [(r.label, r.rows_written) for r in run(spark, wanted, out).collect()]
    again = build_dataset(spark, DatasetSpec(dataset=out, features=SMALL, vocabulary=CLASSES, time_series=4))
    assert speeds(again) == [*range(20)]
    erased = DatasetSpec(dataset=out, features=SMALL, vocabulary=CLASSES, time_series=4, erase=True, types=("11",), amounts=(9,))
    left = speeds(build_dataset(spark, erased))
    assert len(left) == 12 and all(left[i] + 3 == left[i + 3] for i in range(0, 12, 4))


def test_results_do_not_depend_on_partitions(spark, tmp_path):
    path = folder(tmp_path, {f"f{i}.csv": [row(j % 40, climb=j % 3, c1=1 + j % 2, c2=1 - j % 2) for j in range(i, 300)] for i in (2, 4, 5)})
    seen = []
    for n in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        plain = build_dataset(spark, spec(path, add=True, types=("11", "20"), amounts=(30, 20)))
        windows = build_dataset(spark, spec(path, time_series=3))
        seen.append([sorted(tuple(r) for r in d.select(*SMALL.columns).collect()) for d in (plain, windows)])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] == seen[2]


def test_column_families_are_written_apart(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0, 1, 1)], list(SMALL.columns))
    write_families(df, str(tmp_path / "sets"), SMALL)
    header = lambda name: spark.read.option("header", True).csv(str(tmp_path / "sets" / name)).columns
    assert header("num") == list(SMALL.numbers) and header("matrix") == ["m1"] and header("y") == ["c1", "c2"]


def test_dedupe_treats_missing_as_equal_and_signed_zero_as_one(spark):
    df = spark.createDataFrame([(1, None, 0.0, 5), (2, None, -0.0, 6), (3, 1.0, 0.0, 7)], "k int, a double, b double, v int")
    assert sorted(r.v for r in dedupe_first(df, ["a", "b"], ["k"]).collect()) == [5, 7]


def test_window_set_treats_signed_zero_as_one(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, None), (4, 2.0)], "k long, a double")
    windows = fixed_windows(df.withColumn("g", F.lit(1)).withColumn("b", F.lit(0)), ["g"], ["k"], ["b"], 2)
    kept = clean_windows(windows, ["g"], F.lit(True), ["a"], 2)
    assert sorted(r.k for r in kept.collect()) == [3, 4]


def test_filter_order_matters(spark):
    df = spark.createDataFrame([(1, 0.0, 1), (2, 5.0, 1)], "k int, v double, key int")
    assert clean_rows(df, ["key"], ["k"], ["v"]).count() == 0
    assert dedupe_first(nonzero(df, ["v"]), ["key"], ["k"]).count() == 1


@pytest.mark.parametrize("bad", [
    {}, {"data_dir": "x", "add": True, "erase": True, "types": ("2200",)}, {"data_dir": "x", "add": True},
    {"dataset": "x", "add": True, "types": ("2200",)}, {"data_dir": "x", "types": ("unknown",)},
    {"data_dir": "x", "add": True, "types": ("2200",), "amounts": ("-1",)}, {"data_dir": "x", "time_series": -1},
])
def test_bad_runs_are_refused(bad):
    with pytest.raises(ValueError):
        DatasetSpec(**bad)


def test_command_line():
    made, out = parse("-dir d -a -t 2200 1111 -amt 10 -ts 4 -o o".split())
    assert (made.quota, made.time_series, out) == ({"2200": 10, "1111": None}, 4, "o")
    assert len(TRACK.columns) == 56 and "verticalSpeed" not in TRACK.dedupe_subset
    with pytest.raises(SystemExit):
        parse(["-e"])


def test_written_rows_are_counted_once(spark, tmp_path):
    """A sort by range samples its input first; what it samples must not be counted."""
    (tmp_path / "in").mkdir()
    path = folder(tmp_path / "in", {"a.csv": [row(i) for i in range(101)], "b.csv": [row(1000 + i, c1=2, c2=0) for i in range(40)]})
    for name, wanted, rows in (("rows", spec(path), 141), ("windows", spec(path, time_series=4), 140)):
        assert write_dataset(build_dataset(spark, wanted), wanted, str(tmp_path / name)) == rows
        report = {r.label: (r.rows_read, r.rows_written) for r in run(spark, wanted, str(tmp_path / f"{name}2")).collect()}
        assert report == {"11": (101, 101 if name == "rows" else 100), "20": (40, 40)}


def test_class_codes_are_whole_numbers(spark, tmp_path):
    codes = ["2.7", "3e10", "inf", "-inf", "x", "", "NaN", "1.0", "1", "-3"]
    lines = [",".join([*row(i).split(",")[:-2], code, "1"]) for i, code in enumerate(codes)]
    path = folder(tmp_path, {"a.csv": lines})
    rows = scan_csv(spark, path, SMALL).orderBy("_pos")
    assert [r.c1 for r in rows.collect()] == [None] * 7 + [1, 1, -3]
    whole, rest = unclassed_rows(rows, SMALL.classes)
    assert (whole.count(), rest.count()) == (3, 7)
    built = build_dataset(spark, spec(path))
    assert {r.label for r in built.collect()} <= {"11", "-31"}


def test_owned_scratch_is_removed(spark, tmp_path):
    import os

    df = spark.createDataFrame([(1,)], "a int")
    with owned_scratch(spark):
        kept = stage(df)
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_a_run_reads_the_text_once(spark, tmp_path, monkeypatch):
    """Counting, cleaning and writing go on when the recordings are out of reach after they were parsed."""
    (tmp_path / "in").mkdir()
    path = folder(tmp_path / "in", {"a.csv": [row(i) for i in range(40)], "b.csv": [row(i, c1=2, c2=0) for i in range(30)], "long.csv": [row(1) + ",9"]})
    real = dataset.read_sources

    def read_then_hide(*args):
        sources = real(*args)
        (tmp_path / "in").rename(tmp_path / "out-of-reach")
        return sources

    monkeypatch.setattr(dataset, "read_sources", read_then_hide)
    report = run(spark, spec(path, add=True, types=("11", "20"), amounts=(10, 20)), str(tmp_path / "out"))
    assert {(r.label, r.rows_read, r.rows_written) for r in report.collect()} == {("11", 40, 10), ("20", 30, 20)}


@pytest.mark.parametrize("cells", ["1,,NaN,NA,null,2.0,0", '"1",2,inf,-inf,1e3,2,0', "1,2,Infinity,+3, 4 ,2.5,99999999999", "1,2", "x,y,z,,,1,1", "1,\"a,b\",3,4,5,1,1"])
def test_the_single_parse_gives_the_rows_of_the_scan(spark, tmp_path, cells):
    path = folder(tmp_path, {"a.csv": [row(7), "", cells, "   ", row(8)]})
    columns = [*SMALL.features, *SMALL.classes]
    want = [tuple(r) for r in scan_csv(spark, path, SMALL).orderBy("_file", "_blk", "_pos").select(*columns).collect()]
    got = [tuple(r) for r in quarantine_files(spark, path, SMALL)[0].orderBy("_file", "_blk", "_pos").select(*columns).collect()]
    assert got == want and len(got) == 3


def test_files_that_cannot_be_split_have_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(files, "PART_BITS", 4)
    for name in ("a.csv.gz", "b.csv.gz"):
        (tmp_path / name).write_bytes(gzip.compress("\n".join([HEADER, *[row(i) for i in range(200)]]).encode()))
    rows = scan_csv(spark, str(tmp_path), SMALL)
    assert [r.speed for r in rows.where(F.col("_file").contains("b.csv")).orderBy("_blk", "_pos").collect()] == list(range(200))
    assert rows.groupBy("_file", "_blk").count().agg(F.max("count")).first()[0] <= 16
    windows = fixed_windows(rows.withColumn("label", F.lit("x")), ["_file", "label"], ["_blk", "_pos"], ["_blk"], 7)
    got = {(r._file[-8:], r.win_id): r.lowest for r in windows.groupBy("_file", "win_id").agg(F.min("speed").alias("lowest")).collect()}
    assert len(got) == 2 * 28 and sorted(got.values())[:4] == [0, 0, 7, 7]
