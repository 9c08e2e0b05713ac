"""Calendar periods and month mappings."""

import datetime as dt

import pytest

from meterlake.functions import calendar as cal
from meterlake.operators import periods as pr


def test_period_bounds():
    assert cal.period_bounds("select", year=2023, month=5) == (dt.datetime(2023, 5, 1), dt.datetime(2023, 6, 1))
    assert cal.period_bounds("current", as_of="2023-12-31") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))
    # January: previous is December of the year before (no month 0)
    assert cal.period_bounds("previous", as_of="2024-01-10") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        cal.period_bounds("select", year=2023)
    with pytest.raises(ValueError):
        cal.period_bounds("monthly", as_of="2024-01-01")
    with pytest.raises(ValueError):
        cal.period_bounds("select", year=2023, month=13)


def _r(spark):
    rows = [("A", dt.datetime(2023, 11, 30, 23, 59), 1.0), ("A", dt.datetime(2023, 12, 1), 2.0),
            ("A", dt.datetime(2023, 12, 31, 23, 59), 3.0), ("A", dt.datetime(2024, 1, 1), 4.0)]
    return spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double")


def test_select_period_filters_and_pushes_down(spark, tmp_dir):
    got = sorted(r["consumption"] for r in pr.select_period(_r(spark), "previous", as_of="2024-01-05").collect())
    assert got == [2.0, 3.0]
    path = tmp_dir + "/r"
    _r(spark).write.parquet(path)
    df = pr.select_period(spark.read.parquet(path), "select", year=2023, month=12)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date_time" in plan


def test_reject_future_and_missing(spark):
    req = spark.createDataFrame([("A", 2024, 1), ("A", 2024, 2), ("B", 2023, 12)], "cpe string, year int, month int")
    ok, future = pr.reject_future(req, "2024-01-15")
    assert sorted((r["year"], r["month"]) for r in future.collect()) == [(2024, 2)]
    assert ok.count() == 2
    avail = spark.createDataFrame([("A", 2024, 1), ("A", 2024, 1)], "cpe string, year int, month int")
    missing = sorted((r["cpe"], r["month"]) for r in pr.missing_periods(req, avail).collect())
    assert missing == [("A", 2), ("B", 12)]


def test_month_grid_and_names(spark):
    # the reference's grid cases: Jan, Apr, Jul, Oct -> (1,1) (2,1) (3,1) (4,1)
    dates = [dt.datetime(2022, m, 1) for m in (1, 4, 7, 10, 3, 12)]
    df = spark.createDataFrame([(d,) for d in dates], "d timestamp_ntz")
    row, col = cal.month_grid("d")
    got = [(r[0], r[1], r[2]) for r in df.select(row, col, cal.month_name_pt("d")).collect()]
    assert got == [(1, 1, "jan."), (2, 1, "abr."), (3, 1, "jul."), (4, 1, "out."), (1, 3, "mar."), (4, 3, "dez.")]


def test_years_back(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1),), (dt.datetime(2023, 1, 1),), (dt.datetime(2025, 1, 1),)],
                               "d timestamp_ntz")
    assert [r[0] for r in df.select(cal.years_back("d", "2024-06-01")).collect()] == [0, 1, -1]


def test_select_period_on_a_store_prunes_month_folders(spark, tmp_dir):
    import datetime as dt
    import os

    from meterlake.operators import load as ld

    rows = [("M1", dt.datetime(2024, m, 15, 12), float(m)) for m in range(1, 7)]
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double"), path, 1)
    may = pr.select_period(ld.read_store(spark, path), "select", year=2024, month=5, ts="time", store=True)
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "2024-05" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert [r["value"] for r in may.collect()] == [5.0]


def test_a_request_without_a_valid_month_is_rejected(spark):
    req = spark.createDataFrame([("A", 2024, 1), ("B", 2024, 13), ("C", None, 2)], "cpe string, year int, month int")
    good, bad = pr.reject_future(req, "2024-05-01")
    assert [r["cpe"] for r in good.collect()] == ["A"]
    assert sorted(r["cpe"] for r in bad.collect()) == ["B", "C"]
