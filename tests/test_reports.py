import pytest

from trackframe import report
from trackframe.plans.reports import measurement_tables, timeline_reports

PARAMS = (("Irradiance", "Spot Size", "Range"), ("intensity", "spread", "range"), "range", 1994.5)
LOG = """starting
T = 0
1: Peak Irradiance (W/cm^2): 500.5
1: Spot Size (cm): 3.5
1: Range (m): 4000.25
Range to go is 12
1.5: Peak Irradiance (W/cm^2): 400
1.5: Spot Size (cm): 4
1.5: Range (m): 4500
lost the target
2: Peak Irradiance (W/cm^2): 500.5
2: Spot Size (cm): 3.5
2: Range (m): 4000.25
9: Peak Irradiance (W/cm^2): 900
9: Spot Size (cm): 1
9: Range (m): 1994.5
10: Peak Irradiance (W/cm^2): 880
10: Spot Size (cm): 1.25
10: Range (m): 2100
11: Peak Irradiance (W/cm^2): 7
"""


def test_log_to_two_tables(spark, tmp_path):
    (tmp_path / "log.txt").write_text(LOG)
    tables = measurement_tables(spark, str(tmp_path / "log.txt"), *PARAMS)
    assert [tuple(r) for r in tables[1].collect()] == [(4000.25, 500.5, 3.5), (4500.0, 400.0, 4.0)]
    assert [tuple(r) for r in tables[2].collect()] == [(1994.5, 900.0, 1.0), (2100.0, 880.0, 1.25)]
    options = ["--patterns", *PARAMS[0], "--names", *PARAMS[1], "--by", "range", "--marker", "1994.5"]
    report.main(["log", str(tmp_path / "log.txt"), "-o", str(tmp_path / "out"), *options])
    with pytest.raises(SystemExit):
        report.main(["log", str(tmp_path / "log.txt"), "-o", str(tmp_path / "out2")])
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "phase_2")).count() == 2


def test_logs_are_read_apart(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text(LOG.replace("1994.5", "1994.5" if name == "a" else "1990"))
    tables = measurement_tables(spark, str(tmp_path), *PARAMS)
    assert tables[1].where("range < 2000").count() == 1 and tables[2].count() == 2


def test_timeline_reports(spark, tmp_path):
    lines = ["Time,SystemTrack1,SystemTrack1-Truth"] + [f"{i * 1800}.0,{'A' if i < 5 else '_'},{'A' if i < 4 else 'B'}" for i in range(9)]
    (tmp_path / "wide.csv").write_text("\n".join(lines) + "\n")
    traces, agreement = timeline_reports(spark, str(tmp_path / "wide.csv"))
    pred = traces.where("role = 'pred'").first()
    assert pred["values"] == ["A"] * 6 + [None] * 3 and pred.last_time == 14400.0
    row = agreement.first()
    assert (row.points, row.compared, row.agreed, row.agreed_time) == (9, 6, 4, 7200.0)
