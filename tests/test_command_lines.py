"""From recordings to a saved model, through the command lines."""

import random

import pytest

from trackframe import build, train
from trackframe.spec import TRACK, TRACK_VOCABULARY


@pytest.fixture(scope="module")
def recordings(tmp_path_factory):
    folder = tmp_path_factory.mktemp("recordings")
    rng = random.Random(9)
    for number in (2, 4, 5, 13):  # the last name ends in 3.csv and is passed over
        lines = ["x" + ",y" * 55]
        for label, values in TRACK_VOCABULARY.classes.items():
            middle = 1000 * (1 + TRACK_VOCABULARY.labels.index(label))
            for _ in range(25):
                features = [f"{rng.gauss(middle, 20):.3f}" for _ in TRACK.features]
                lines.append(",".join([*features, *map(str, values)]))
        (folder / f"recording{number}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_build_then_train_then_load(spark, recordings, tmp_path, capsys):
    dataset, models = str(tmp_path / "current"), str(tmp_path / "models")
    build.main(["-dir", recordings, "-a", "-t", "2200", "1111", "5200", "-amt", "40", "50", "999", "-o", dataset])
    shown = capsys.readouterr().out
    cells = [[x.strip() for x in line.strip("|").split("|")] for line in shown.splitlines() if line.startswith("|")]
    counts = {c[0]: (int(c[1]), int(c[2])) for c in cells if c[1].isdigit()}
    assert counts == {"1111": (75, 50), "1112": (75, 0), "1113": (75, 0), "1122": (75, 0), "2200": (75, 40), "5200": (75, 75)}
    train.main(["-d", dataset, "-m", "knn", "-p", "-o", models])
    shown = capsys.readouterr().out
    path = next(line.split("saved: ")[1] for line in shown.splitlines() if line.startswith("saved: "))
    assert "/knn-2" in path and "rows per second" in shown
    train.main(["-d", dataset, "-lm", path])
    assert "weighted avg" in capsys.readouterr().out


def test_windows_from_recordings(spark, recordings, tmp_path, capsys):
    dataset = str(tmp_path / "windows")
    build.main(["-dir", recordings, "-a", "-t", "1111", "1112", "-amt", "30", "8", "-ts", "4", "-o", dataset])
    assert {tuple(p.strip() for p in line.strip("|").split("|")) for line in capsys.readouterr().out.splitlines() if "11" in line} == {
        ("1111", "75", "28"), ("1112", "75", "8"), ("1113", "75", "0"), ("1122", "75", "0")
    }
    windows = train.split_windows(spark, dataset, 4)
    assert sum(p.count() for p in windows.values()) == 9


@pytest.mark.parametrize("kind,grid,fixed", [
    ("gb", {"trees": [2, 4], "depth": [2], "rate": [0.3, 0.9]}, {}), ("rf", {"depth": [2, 35]}, {"trees": 4}), ("dense", {"epochs": [2, 30]}, {"hidden": [16]}),
])
def test_grid_search_of_every_kind(spark, recordings, tmp_path, capsys, monkeypatch, kind, grid, fixed):
    dataset = str(tmp_path / "current")
    build.main(["-dir", recordings, "-a", "-t", "1111", "2200", "-amt", "40", "40", "-o", dataset])
    capsys.readouterr()
    monkeypatch.setitem(train.GRIDS, kind, grid)
    monkeypatch.setitem(train.SEARCH_PARAMS, kind, fixed)
    train.main(["-d", dataset, "-m", kind, "-gs"])
    shown = capsys.readouterr().out
    lines = [x for x in shown.splitlines() if x.startswith("|") and "=" in x]
    assert len(lines) == {"gb": 4, "rf": 2, "dense": 2}[kind] and "best: {" in shown
