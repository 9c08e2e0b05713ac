"""Typed parsing of text cells (B1, B2, B5) and the raw-row chain."""

import datetime as dt

from pyspark.sql import functions as F

from meterlake.functions import parsing as ps
from meterlake.operators import readings as rd


def test_merge_date_time_formats(spark):
    df = spark.createDataFrame([("2024-01-02", "03:15"), ("2024/01/02", "03:15:30"), ("02/01/2024", "03:15"),
                                ("2024-13-45", "03:15"), (None, "03:15"), ("2024-01-02", "25:99")],
                               "d string, t string")
    got = [r[0] for r in df.select(ps.merge_date_time("d", "t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 15), dt.datetime(2024, 1, 2, 3, 15, 30),
                   dt.datetime(2024, 1, 2, 3, 15), None, None, None]


def test_parse_number_thousands_and_malformed(spark):
    df = spark.createDataFrame([("1,234.5",), (" 12.25 ",), ("0",), ("abc",), ("1.2.3",), (None,)], "x string")
    got = [r[0] for r in df.select(ps.parse_number("x")).collect()]
    assert got == [1234.5, 12.25, 0.0, None, None, None]
    df2 = spark.createDataFrame([("1.234,5",)], "x string")
    assert df2.select(ps.parse_number("x", thousands=".", decimal=",")).first()[0] == 1234.5


def test_localize_utc_labels_without_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "t timestamp_ntz")
    us = df.select(ps.epoch_micros(ps.localize_utc("t"))).first()[0]
    assert us == 1704067200 * 1_000_000
    lisbon_summer = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0),)], "t timestamp_ntz")
    us2 = lisbon_summer.select(ps.epoch_micros(ps.localize_utc("t", "Europe/Lisbon"))).first()[0]
    assert us2 == (1719835200 - 3600) * 1_000_000


def _raw(spark, rows):
    return spark.createDataFrame(rows, "file string, row int, cells array<string>")


def test_parse_readings_skips_preamble_header_and_quarantines(spark):
    pre = [("f.xlsx", i, ["preamble"]) for i in range(8)]
    rows = pre + [
        ("f.xlsx", 8, ["Date", "Time", "Value", "Extra"]),
        ("f.xlsx", 9, ["2024-01-01", "00:15", "1,000.5", "x"]),   # extra column ignored
        ("f.xlsx", 10, ["2024-01-01", "00:30", "bad", None]),    # quarantined
        ("f.xlsx", 11, [None, "", None]),                         # blank: dropped
        ("f.xlsx", 12, ["2024-01-01", "00:45", "2"]),
    ]
    good, bad = rd.parse_readings(_raw(spark, rows), "PT0001")
    g = sorted((r["row"], r["cpe"], r["date_time"], r["consumption"]) for r in good.collect())
    assert g == [(9, "PT0001", dt.datetime(2024, 1, 1, 0, 15), 1000.5),
                 (12, "PT0001", dt.datetime(2024, 1, 1, 0, 45), 2.0)]
    b = [(r["row"], r["consumption"]) for r in bad.collect()]
    assert b == [(10, "bad")]


def test_attach_series_by_map_and_column(spark):
    rows = spark.createDataFrame([("a.xlsx", 1), ("b.xlsx", 2), ("c.xlsx", 3)], "file string, n int")
    m = spark.createDataFrame([("a.xlsx", "PT_A"), ("b.xlsx", "PT_B")], "file string, cpe string")
    got = {r["file"]: r["cpe"] for r in rd.attach_series(rows, m).collect()}
    assert got == {"a.xlsx": "PT_A", "b.xlsx": "PT_B", "c.xlsx": None}
    got2 = {r["file"]: r["cpe"] for r in rd.attach_series(rows, F.upper("file")).collect()}
    assert got2["a.xlsx"] == "A.XLSX"


def test_key_by_time_orders_within_partition(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 2), 1.0), ("A", dt.datetime(2024, 1, 1), 2.0)],
                               "consumption_dummy string, date_time timestamp_ntz, consumption double")
    df = df.withColumnRenamed("consumption_dummy", "cpe").coalesce(1)
    out = rd.key_by_time(df)
    assert out.columns[:2] == ["cpe", "date_time"]
    assert [r["date_time"].day for r in out.collect()] == [1, 2]


def test_autumn_clock_change_repeats_become_one_point_per_key(spark):
    """Local wall times repeated when clocks fall back (Lisbon, 2023-10-29 02:00 -> 01:00)
    are labelled UTC as written, so they collide on (meter, time); the full-load key
    rule keeps one point per key, the later sheet row winning."""
    from meterlake.operators import load as ld
    from meterlake.operators.reshape import to_points

    pre = [("f.xlsx", i, ["preamble"]) for i in range(8)] + [("f.xlsx", 8, ["Date", "Time", "Value"])]
    body = [("f.xlsx", 9 + i, ["2023-10-29", t, str(v)])
            for i, (t, v) in enumerate([("00:45", 1), ("01:00", 2), ("01:15", 3),     # summer time
                                        ("01:00", 4), ("01:15", 5), ("01:30", 6)])]  # repeated hour
    good, bad = rd.parse_readings(_raw(spark, pre + body), "PT0001")
    assert bad.count() == 0 and good.count() == 6
    dup = good.groupBy("cpe", "date_time").count().filter("count > 1").count()
    assert dup == 2
    pts = to_points(good.select("cpe", "date_time", "consumption", F.col("row").cast("long").alias("row")),
                    tags=("cpe", "row")).withColumn("load_seq", F.lit(1))
    kept = ld.keep_latest(pts, tiebreak="row").drop("row")
    got = sorted((r["time"].strftime("%H:%M"), r["value"]) for r in kept.collect())
    assert got == [("00:45", 1.0), ("01:00", 4.0), ("01:15", 5.0), ("01:30", 6.0)]
    # with the zone given, both copies of a repeated wall time map to one UTC instant too
    zoned = good.select(ps.localize_utc("date_time", "Europe/Lisbon").alias("t"))
    assert zoned.select("t").distinct().count() == 4


def test_wall_times_do_not_depend_on_the_session_zone(spark):
    from pyspark.sql import functions as F

    from meterlake.functions.parsing import merge_date_time
    from meterlake.operators.reshape import second_precision

    rows = [("2024-03-31", "01:30"), ("31/03/2024", "02:30:00"), ("2024-10-27", "00:30"), ("2024-10-27", "01:30"),
            ("2024-02-30", "00:00")]
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("Europe/Lisbon", "UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame(rows, "d string, t string").select(merge_date_time("d", "t").alias("x"))
            got = [r[0] for r in second_precision(df, "x").select(F.col("x").cast("string")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert got == ["2024-03-31 01:30:00", "2024-03-31 02:30:00", "2024-10-27 00:30:00", "2024-10-27 01:30:00", None]


def test_formats_passed_over_change_no_result(spark):
    formats = ps.DATE_TIME_FORMATS
    dates = ["2024-01-02", "2024/01/02", "02/01/2024", "02-01-2024", "+12024/01/02", "-2024/01/02", "2024/1/2", "02/01/24", "", "x", None]
    times = ["00:15", "00:15:30", "24:00", "1:05", "+00:15", "", None]
    rows = spark.createDataFrame([(d, t) for d in dates for t in times], "d string, t string")
    zoned = F.concat(F.concat_ws(" ", "d", "t"), F.lit(" Z"))
    every = F.coalesce(*[F.try_to_timestamp(zoned, F.lit(f"{f} X")) for f in formats])
    got = rows.select("d", "t", F.unix_micros(ps.merge_date_time("d", "t").cast("timestamp")).alias("got"), F.unix_micros(every).alias("plain")).collect()
    assert [r for r in got if r["got"] != r["plain"]] == []
    assert sum(r["got"] is not None for r in got) >= 8
    # Each text is tried against the only format of its shape.
    fits = rows.select(sum((F.coalesce(ps._may_fit(F.concat_ws(" ", "d", "t"), f), F.lit(False)).cast("int") for f in formats), F.lit(0)).alias("n"))
    assert fits.agg(F.max("n")).first()[0] == 1
