"""Delta rule, marks and last point."""

import datetime as dt

from pyspark.sql import functions as F

from meterlake.operators import marks as mk
from meterlake.operators.reshape import to_points

T0 = dt.datetime(2024, 1, 1, 0, 0)


def _readings(spark, rows):
    return spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double, seq long")


def test_delta_strictly_newer_and_sentinel(spark):
    stored = to_points(_readings(spark, [("A", T0, 1.0, 1), ("A", T0 + dt.timedelta(hours=1), 2.0, 2)]))
    incoming = _readings(spark, [
        ("A", T0, 9.0, 3),                               # older: dropped
        ("A", T0 + dt.timedelta(hours=1), 9.0, 4),       # equal to the mark: dropped
        ("A", T0 + dt.timedelta(hours=2), 3.0, 5),       # newer: kept
        ("B", dt.datetime(1990, 1, 1), 4.0, 6),          # no mark: sentinel 1989-05-11, kept
        ("B", dt.datetime(1989, 5, 11), 4.0, 7),         # equal to the sentinel: dropped
    ])
    got = sorted(r["seq"] for r in mk.delta(incoming, stored).collect())
    assert got == [5, 6]


def test_delta_same_result_broadcast_or_shuffle(spark):
    stored = to_points(_readings(spark, [("A", T0, 1.0, 1), ("C", T0, 1.0, 2)]))
    incoming = _readings(spark, [("A", T0 + dt.timedelta(minutes=m), 1.0, m) for m in range(-3, 4)]
                         + [("D", T0, 1.0, 99)])
    rep_b, rep_s = {}, {}
    spark.conf.set("meterlake.broadcast.maxBytes", str(1 << 30))
    a = sorted(r["seq"] for r in mk.delta(incoming, stored, report=rep_b).collect())
    spark.conf.set("meterlake.broadcast.maxBytes", "0")
    try:
        b = sorted(r["seq"] for r in mk.delta(incoming, stored, report=rep_s).collect())
    finally:
        spark.conf.unset("meterlake.broadcast.maxBytes")
    assert a == b == [1, 2, 3, 99]
    assert rep_b["broadcast"] is True and rep_s["broadcast"] is False
    assert rep_b["rows"] == 2


def test_marks_use_range_and_series_filters(spark):
    pts = spark.createDataFrame([
        ("kW", "A", "consumption", 1.0, dt.datetime(2024, 1, 2)),
        ("kW", "A", "other", 1.0, dt.datetime(2024, 3, 1)),        # other field: ignored
        ("W", "A", "consumption", 1.0, dt.datetime(2024, 4, 1)),   # other measurement: ignored
        ("kW", "A", "consumption", 1.0, dt.datetime(1989, 5, 11, 1, 0)),  # before range start
        ("kW", "B", "consumption", 1.0, dt.datetime(1989, 5, 11, 1, 0)),
    ], "measurement string, cpe string, field string, value double, time timestamp_ntz")
    got = {r["cpe"]: r["last_insert"] for r in mk.marks(pts).collect()}
    assert got == {"A": dt.datetime(2024, 1, 2)}


def test_last_insert_sentinel_for_unknown_meter(spark):
    pts = to_points(_readings(spark, [("A", T0, 1.0, 1)]))
    meters = spark.createDataFrame([("A",), ("Z",)], "cpe string")
    got = {r["cpe"]: r["last_insert"] for r in mk.last_insert(pts, meters).collect()}
    assert got == {"A": T0, "Z": dt.datetime(1989, 5, 11)}


def test_last_point_ties_broken_by_seq(spark):
    r = _readings(spark, [("A", T0, 1.0, 1), ("A", T0, 2.0, 7), ("A", T0 - dt.timedelta(1), 5.0, 9),
                          ("B", T0, 3.0, 1)])
    got = {x["cpe"]: (x["consumption"], x["seq"]) for x in mk.last_point(r, ts="date_time", tiebreak="seq").collect()}
    assert got == {"A": (2.0, 7), "B": (3.0, 1)}


def test_range_scan_half_open(spark):
    pts = to_points(_readings(spark, [("A", T0, 1.0, 1), ("A", T0 + dt.timedelta(days=1), 1.0, 2)]))
    got = mk.range_scan(pts, "2024-01-01 00:00:00", "2024-01-02 00:00:00").count()
    assert got == 1


def test_series_filter_forms(spark):
    pts = to_points(_readings(spark, [("A", T0, 1.0, 1), ("B", T0, 1.0, 2), ("C", T0, 1.0, 3)]))
    assert mk.series_filter(pts, meters="A").count() == 1
    assert mk.series_filter(pts, meters=["A", "B"]).count() == 2
    asked = spark.createDataFrame([("B",), ("C",), ("C",)], "cpe string")
    assert mk.series_filter(pts, meters=asked).count() == 2
    assert mk.series_filter(pts, field="other").count() == 0


def test_delta_plan_broadcasts_marks_without_shuffling_readings(spark):
    stored = to_points(_readings(spark, [("A", T0, 1.0, 1)]))
    incoming = _readings(spark, [("A", T0 + dt.timedelta(hours=1), 1.0, 2)])
    plan = mk.delta(incoming, stored)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert F is not None


def test_last_point_fast_path_is_hash_aggregate(spark):
    pts = spark.createDataFrame([("A", T0, 1.0), ("A", T0 + dt.timedelta(1), 2.0), ("B", T0, 3.0)],
                                "cpe string, time timestamp_ntz, value double")
    out = mk.last_point(pts)
    assert sorted(tuple(r) for r in out.collect()) == [("A", T0 + dt.timedelta(1), 2.0), ("B", T0, 3.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_series_filter_on_a_store_prunes_bucket_folders(spark, tmp_dir):
    import os

    from meterlake.operators import load as ld

    rows = [(f"M{i}", T0 + dt.timedelta(hours=h), float(h)) for i in range(30) for h in range(3)]
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double"), path, 1)
    stored = ld.read_store(spark, path)
    one = mk.series_filter(stored, meters="M7", store=True)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert sorted(r["value"] for r in one.collect()) == [0.0, 1.0, 2.0]
    two = mk.series_filter(stored, meters=["M7", "M21"], store=True)
    assert sorted((r["cpe"], r["value"]) for r in two.collect()) == \
        sorted((m, float(h)) for m in ("M7", "M21") for h in range(3))
    assert mk.series_filter(stored, meters=[]).count() == 0


def test_range_scan_on_a_store_bounds_month_folders(spark, tmp_dir):
    import os

    from meterlake.operators import load as ld

    rows = [("M1", dt.datetime(2024, m, 1, 0, 0), float(m)) for m in range(1, 7)] + \
        [("M1", dt.datetime(2024, 3, 31, 23, 59), 3.5)]
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double"), path, 1)
    out = mk.range_scan(ld.read_store(spark, path), "2024-02-01 00:00:00", "2024-04-01 00:00:00", store=True)
    parts = out._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2024-02" in parts and "2024-04" in parts
    assert sorted(r["value"] for r in out.collect()) == [2.0, 3.0, 3.5]     # April 1st 00:00 excluded


def test_a_column_called_month_is_only_a_column(spark):
    """Pruning by the store's folders is asked for, not guessed from a name."""
    from meterlake.operators import periods as pr

    df = spark.createDataFrame([("A", "01", 3)], "cpe string, month string, bucket int").selectExpr(
        "*", "timestamp_ntz'2024-01-05' AS time", "'kW' AS measurement", "'consumption' AS field")
    assert mk.range_scan(df, "2024-01-01 00:00:00", "2024-02-01 00:00:00").count() == 1
    assert mk.series_filter(df, meters=["A"]).count() == 1
    assert pr.select_period(df, "select", year=2024, month=1, ts="time").count() == 1
