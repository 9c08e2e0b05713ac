"""End-to-end load lifecycle (L1) on workbooks in a landing folder."""

import os

import pytest

from meterlake.operators.load import read_store
from meterlake.plans.workflows import run_load
from meterlake.sources import workbook_export as wx


def _landing(root, files):
    for meter, name, dates, values in files:
        os.makedirs(os.path.join(root, meter), exist_ok=True)
        rows = wx.readings_sheet(dates, ["00:15"] * len(dates), values)
        with open(os.path.join(root, meter, name), "wb") as f:
            f.write(wx.workbook_bytes(rows))


def test_full_then_delta_load(spark, tmp_dir):
    store = os.path.join(tmp_dir, "points")
    land1 = os.path.join(tmp_dir, "landing1")
    _landing(land1, [("PT01", "2024_1_aaaaaaaa_readings.xlsx", ["2024-01-01", "2024-01-02", "2023-12-31"],
                      [1.0, 2.0, 9.0]),
                     ("PT02", "2024_1_bbbbbbbb_readings.xlsx", ["2024-01-01"], ["bad"])])
    session, report, bad = run_load(spark, land1, "select", ["parquet", "", "influxdb"], {"parquet": store},
                                    year=2024, month=1, as_of="2024-02-10", keep=True,
                                    output=os.path.join(tmp_dir, "kept"), load_seq=1, session_id="s1")
    s = session.first()
    assert s["status"] == "completed" and s["source_data"].endswith("kept/s1")
    assert not os.path.exists(land1) and os.path.isdir(os.path.join(tmp_dir, "kept", "s1", "PT01"))
    assert [(r["target"], r["status"]) for r in report.collect()] == [
        ("parquet", "loaded"), ("", "ignored"), ("influxdb", "unsupported")]
    assert bad.count() == 1
    got = sorted((r["cpe"], r["time"].day) for r in read_store(spark, store).collect())
    assert got == [("PT01", 1), ("PT01", 2)]          # December reading is outside the month

    land2 = os.path.join(tmp_dir, "landing2")
    _landing(land2, [("PT01", "2024_1_cccccccc_readings.xlsx", ["2024-01-02", "2024-01-03"], [7.0, 3.0])])
    run_load(spark, land2, "current", ["parquet"], {"parquet": store}, as_of="2024-01-20", delta=True, load_seq=2)
    assert not os.path.exists(land2)
    got = sorted((r["time"].day, r["value"]) for r in read_store(spark, store).collect())
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0)]      # equal-to-mark day 2 not reloaded


def test_bad_requests_rejected(spark, tmp_dir):
    with pytest.raises(ValueError):
        run_load(spark, tmp_dir, "select", ["parquet"], {}, year=2024, as_of="2024-01-01")
    with pytest.raises(ValueError):
        run_load(spark, tmp_dir, "monthly", ["parquet"], {}, as_of="2024-01-01")
    with pytest.raises(ValueError):
        run_load(spark, tmp_dir, "select", ["parquet"], {}, year=2030, month=1, as_of="2024-01-01")


def test_command_line_run_and_info(spark, tmp_dir, capsys):
    import json

    from meterlake.cli import main

    land = os.path.join(tmp_dir, "landing")
    store = os.path.join(tmp_dir, "points")
    _landing(land, [("PT07", "2023_5_dddddddd_readings.xlsx", ["2023-05-01", "2023-05-02"], [1.5, "2,000.5"])])
    assert main(["info"]) == 0
    assert json.loads(capsys.readouterr().out)["workflows"] == ["current", "previous", "select"]
    assert main(["run", "--landing", land, "-w", "select", "-m", "5", "-y", "2023", "-d", "parquet, ",
                 "--store", f"parquet={store}", "--as-of", "2023-06-01"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["status"] == "completed" and out["quarantined_rows"] == 0 and out["source_data"] is None
    assert [(s["target"], s["status"]) for s in out["stores"]] == [
        ("parquet", "loaded"), ("", "ignored")]
    assert not os.path.exists(land)                        # not kept: removed after loading
    got = sorted((r["cpe"], r["time"].day, r["value"]) for r in read_store(spark, store).collect())
    assert got == [("PT07", 1, 1.5), ("PT07", 2, 2000.5)]


def test_full_load_repeated_time_later_row_wins(spark, tmp_dir):
    """Two readings of one meter at one time (e.g. the repeated autumn hour) in a full
    load: the later sheet row is kept, on every run."""
    store = os.path.join(tmp_dir, "points")
    for attempt in range(2):
        land = os.path.join(tmp_dir, f"landing{attempt}")
        _landing(land, [("PT05", "2023_10_eeeeeeee_readings.xlsx", ["2023-10-29", "2023-10-29", "2023-10-30"],
                         [1.0, 2.0, 3.0])])
        run_load(spark, land, "select", ["parquet"], {"parquet": store}, year=2023, month=10, as_of="2023-11-05",
                 load_seq=1)
        got = sorted((r["time"].day, r["value"]) for r in read_store(spark, store).collect())
        assert got == [(29, 2.0), (30, 3.0)]


def test_only_files_that_were_loaded_whole_are_deleted(spark, tmp_dir):
    """Unreadable files, bad rows, rows outside the month and stores that did not load keep the source."""
    def landing(name):
        land = os.path.join(tmp_dir, name)
        _landing(land, [("PT01", "good.xlsx", ["2024-01-01"], [1.0]), ("PT02", "bad_row.xlsx", ["2024-01-01"], ["x"]),
                        ("PT03", "other_month.xlsx", ["2024-01-01", "2023-12-31"], [1.0, 2.0])])
        os.makedirs(os.path.join(land, "PT04"))
        open(os.path.join(land, "PT04", "corrupt.xlsx"), "w").write("no workbook")
        return land

    def left(land):
        return sorted(f for _, _, files in os.walk(land) for f in files)

    args = dict(year=2024, month=1, as_of="2024-02-10", load_seq=1)
    store = {"parquet": os.path.join(tmp_dir, "points")}
    everything = ["bad_row.xlsx", "corrupt.xlsx", "good.xlsx", "other_month.xlsx"]
    for i, db in enumerate(([""], ["parquet", "influxdb"])):
        land = landing(f"kept{i}")
        run_load(spark, land, "select", db, store, **args)
        assert left(land) == everything
    land = landing("loaded")
    _, _, bad = run_load(spark, land, "select", ["parquet"], store, **args)
    assert left(land) == ["bad_row.xlsx", "corrupt.xlsx", "other_month.xlsx"]
    assert sorted(r["file"].rsplit("/", 1)[1] for r in bad.collect()) == ["bad_row.xlsx", "corrupt.xlsx"]


def test_overlapping_files_in_one_delta_load(spark, tmp_dir):
    store, land = os.path.join(tmp_dir, "points"), os.path.join(tmp_dir, "landing")
    _landing(land, [("PT01", "a.xlsx", ["2024-01-01", "2024-01-02"], [1.0, 2.0]),
                    ("PT01", "b.xlsx", ["2024-01-02", "2024-01-03"], [2.5, 3.0])])
    _, report, _ = run_load(spark, land, "select", ["parquet"], {"parquet": store}, year=2024, month=1,
                            as_of="2024-02-10", delta=True, load_seq=1)
    assert report.first()["rows"] == 3
    got = sorted((r["time"].day, r["value"]) for r in read_store(spark, store).collect())
    assert got == [(1, 1.0), (2, 2.5), (3, 3.0)]


def test_requests_share_the_rendered_workbooks(spark, tmp_dir, monkeypatch):
    from meterlake.plans import catalog

    made = []
    plain = catalog._event_workbooks
    monkeypatch.setattr(catalog, "_event_workbooks", lambda *a, **k: made.append(1) or plain(*a, **k))
    events = spark.range(40).selectExpr("id AS event_id", "id % 4 AS user_id", "'view' AS event_type", "1.5D AS value",
                                        "timestamp_ntz '2024-01-05 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS ts")
    events.write.parquet(f"{tmp_dir}/events.parquet")
    found = {r["task_id"]: (r["state"], r["points"]) for r in catalog.QUERIES["l2_run_requests"](spark, tmp_dir).collect()}
    assert found == {"r1": ("completed", 40), "r2": ("failed", 0), "r3": ("rejected", 0)}
    assert len(made) == 1
