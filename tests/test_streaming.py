"""Streaming loads (I1, I2) against batch replays of the delta rule."""

import datetime as dt
import os

from pyspark.sql import functions as F

from meterlake.operators import load as ld
from meterlake.operators.marks import delta
from meterlake.operators.reshape import to_points
from meterlake.streaming import delta_state as ds
from meterlake.streaming import stream_load as sl

SCHEMA = "cpe string, date_time timestamp_ntz, consumption double"
T0 = dt.datetime(2024, 1, 1)


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def _parse(batch):
    return (batch.withColumn("file", F.col("_metadata.file_path"))
            .withColumn("file_seq", F.unix_micros(F.col("_metadata.file_modification_time"))))


def _points(spark, path):
    return sorted((r["cpe"], r["time"], r["value"]) for r in ld.read_store(spark, path).collect())


def _start(spark, src, base, **more):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src).select("*", "_metadata")
    sl.stream_load(spark, stream, base + "/store", base + "/ckpt", parse=_parse, **more).awaitTermination()


def test_stream_load_batches_and_replay(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    base = os.path.join(tmp_dir, "out")
    h = dt.timedelta(hours=1)
    _write(spark, os.path.join(src, "b1"), [("A", T0, 1.0), ("A", T0 + h, 2.0), ("B", T0, 5.0)])
    _start(spark, src, base)
    # second arrival: overlaps the first (equal time dropped, older dropped), adds newer
    _write(spark, os.path.join(src, "b2"), [("A", T0 + h, 9.0), ("A", T0 + 2 * h, 3.0), ("B", T0 - h, 9.0),
                                           ("C", T0, 7.0)])
    _start(spark, src, base)
    got = _points(spark, base + "/store")
    assert got == [("A", T0, 1.0), ("A", T0 + h, 2.0), ("A", T0 + 2 * h, 3.0), ("B", T0, 5.0), ("C", T0, 7.0)]
    # a batch that is run again after its load ended writes nothing
    (_, second) = ld.committed_loads(spark, base + "/store")
    readings = _parse(spark.read.parquet(os.path.join(src, "b2")).select("*", "_metadata"))
    assert sl.load_batch(readings, 1, base + "/store", second.tag.removesuffix("b1")).count() == 2
    assert _points(spark, base + "/store") == got and len(ld.committed_loads(spark, base + "/store")) == 2
    # one whose load did not end is loaded again
    os.remove(os.path.join(base, "store", second.name, "_SUCCESS"))
    assert len(_points(spark, base + "/store")) == 3
    sl.load_batch(readings, 1, base + "/store", second.tag.removesuffix("b1"))
    assert _points(spark, base + "/store") == got


def test_twenty_batches_leave_few_files_and_equal_one_delta_load(spark, tmp_dir):
    store, plain, h = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "p"), dt.timedelta(hours=1)
    every = []
    for b in range(20):
        rows = [(f"M{m}", T0 + (b + m % 3) * h, float(100 * b + m)) for m in range(4)]
        every += [(b, *r) for r in rows]
        batch = spark.createDataFrame([(*r, "f", b) for r in rows], SCHEMA + ", file string, file_seq long")
        sl.load_batch(batch, b, store, "s", compact_every=5)
        for x in [batch.select("cpe", "date_time", "consumption")]:
            ld.write_delta(x, plain, b)
    files = [f for d, _, fs in os.walk(store) for f in fs if f.endswith(".parquet") and "_marks" not in d]
    assert len(ld.committed_loads(spark, store)) <= 6 and len(files) <= 4 * 6
    assert _points(spark, store) == _points(spark, plain) and len(_points(spark, store)) == len(
        {(m, t) for _, m, t, _ in every})
    # a full load follows the stream in the same store
    ld.write_full(to_points(spark.createDataFrame([("M0", T0, -1.0), ("N", T0, 5.0)], SCHEMA)), store, 99)
    got = _points(spark, store)
    assert ("M0", T0, -1.0) in got and ("N", T0, 5.0) in got and len(got) == len(_points(spark, plain)) + 1


def _delta_stream(spark, src, base, **more):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    ds.stream_delta(stream, base + "/out", base + "/marks", base + "/ckpt", **more).awaitTermination()


def test_stream_delta_state_matches_batch_replay(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    h = dt.timedelta(hours=1)
    stored = to_points(spark.createDataFrame([("A", T0, 1.0)], SCHEMA))
    seed = stored.groupBy("cpe").agg(F.max("time").alias("last_insert"))
    batches = [[("A", T0, 9.0), ("A", T0 + h, 2.0), ("B", T0, 5.0)],
               [("A", T0 + h, 9.0), ("A", T0 + 3 * h, 3.0), ("B", T0 - h, 1.0), ("B", T0 + h, 6.0)]]
    expected = set()
    replay_store = stored
    for i, rows in enumerate(batches):
        _write(spark, os.path.join(src, f"b{i}"), rows)
        _delta_stream(spark, src, tmp_dir, seed_marks=seed)
        new = delta(spark.createDataFrame(rows, SCHEMA), replay_store)
        expected |= {(r["cpe"], r["date_time"], r["consumption"]) for r in new.collect()}
        replay_store = replay_store.unionByName(to_points(new))
    out = spark.read.parquet(tmp_dir + "/out")
    got = {(r["cpe"], r["date_time"], r["consumption"]) for r in out.collect()}
    assert got == expected and out.count() == len(expected)
    assert got == {("A", T0 + h, 2.0), ("B", T0, 5.0), ("A", T0 + 3 * h, 3.0), ("B", T0 + h, 6.0)}


def test_stream_delta_gives_one_reading_of_a_time_and_replays(spark, tmp_dir):
    h = dt.timedelta(hours=1)
    rows = spark.createDataFrame([("A", T0, 1.0), ("A", T0, 3.0), ("A", T0, 2.0), ("B", T0 + h, 4.0)], SCHEMA)
    out, marks = tmp_dir + "/out", tmp_dir + "/marks"
    for _ in range(2):                      # the second time as a replay
        ds.delta_batch(rows, 0, out, marks)
        assert sorted((r.cpe, r.consumption) for r in spark.read.parquet(out).collect()) == [("A", 3.0), ("B", 4.0)]
    ds.delta_batch(rows, 1, out, marks)
    assert spark.read.parquet(out).count() == 2


def test_stream_delta_spreads_a_hot_meter(spark, tmp_dir):
    """A meter with half of all readings: no Python on the readings, no task that holds them all."""
    rows = spark.range(40_000).selectExpr(
        "if(id % 2 = 0, 'hot', concat('M', id % 50)) cpe", "timestampadd(second, cast(id as int), timestamp_ntz'2024-01-01') date_time",
        "cast(id as double) consumption").repartition(8)
    seen = []
    kept = ds.keep_latest

    def watched(new, *args, **kw):
        out = kept(new, *args, **kw)
        seen.append(new._jdf.queryExecution().executedPlan().toString())
        per = out.repartition(8, "cpe", "date_time").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        seen.append(max(r["count"] for r in per))
        return out

    ds.keep_latest = watched
    try:
        ds.delta_batch(rows, 0, tmp_dir + "/out", tmp_dir + "/marks")
    finally:
        ds.keep_latest = kept
    plan, most = seen
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and "SortMergeJoin" not in plan
    assert most < 10_000 and spark.read.parquet(tmp_dir + "/out").count() == 40_000


def test_stream_delta_full_snapshots_rotate_and_match_brute_force(spark, tmp_dir):
    """With a full snapshot every 2 batches: marks = latest full + later increments,
    older parts pruned, and the output equals the delta rule applied batch by batch."""
    src, h = os.path.join(tmp_dir, "src"), dt.timedelta(hours=1)
    batches = [[("A", T0, 1.0), ("B", T0, 1.0)], [("A", T0 + h, 2.0), ("C", T0, 3.0)],
               [("B", T0 - h, 9.0), ("B", T0 + 2 * h, 4.0)], [("A", T0 + h, 9.0), ("C", T0 + h, 5.0)],
               [("A", T0 + 3 * h, 6.0)]]
    marks, expected = {}, []
    for i, rows in enumerate(batches):
        _write(spark, os.path.join(src, f"b{i}"), rows)
        _delta_stream(spark, src, tmp_dir, full_every=2)
        new = [(m, t, v) for m, t, v in rows if t > marks.get(m, dt.datetime(1989, 5, 11))]
        expected += new
        for m, t, _ in new:
            marks[m] = max(t, marks.get(m, t))
    got = sorted((r["cpe"], r["date_time"], r["consumption"]) for r in spark.read.parquet(tmp_dir + "/out").collect())
    assert got == sorted(expected)
    fulls = sorted(d for d in os.listdir(tmp_dir + "/marks/kind=full") if d.startswith("batch_id="))
    incs = sorted(d for d in os.listdir(tmp_dir + "/marks/kind=inc") if d.startswith("batch_id="))
    # a replay of batch 4 reads full 2 + increment 3: both kept; full 0 and increment 1 pruned
    assert fulls == ["batch_id=2", "batch_id=4"] and incs == ["batch_id=3"]


def test_stream_load_from_workbooks(spark, tmp_dir):
    from meterlake.sources import workbook_export as wx

    landing = os.path.join(tmp_dir, "landing")
    base = os.path.join(tmp_dir, "out")
    for meter, vals, days in (("PT01", [1.0, 2.0], [1, 2]), ("PT02", [3.0], [1]),
                              ("PT03", [5.0, 6.0], [1, 1])):       # one time twice: the later row wins
        os.makedirs(os.path.join(landing, meter))
        rows = wx.readings_sheet([f"2024-01-0{d}" for d in days], ["00:15"] * len(vals), vals)
        with open(os.path.join(landing, meter, "2024_1_0000abcd_readings.xlsx"), "wb") as f:
            f.write(wx.workbook_bytes(rows))
    from meterlake.sources.workbooks import workbook_stream
    stream = workbook_stream(spark, landing + "/*").select("path", "content", "modificationTime")
    q = sl.stream_load(spark, stream, base + "/store", base + "/ckpt", sl.workbook_parser())
    q.awaitTermination()
    got = sorted((r["cpe"], r["time"].day, r["value"]) for r in ld.read_store(spark, base + "/store").collect())
    assert got == [("PT01", 1, 1.0), ("PT01", 2, 2.0), ("PT02", 1, 3.0), ("PT03", 1, 6.0)]


def test_quarantine_of_a_replayed_batch_stays_the_same(spark, tmp_dir):
    from meterlake.sources import workbook_export as wx

    good = wx.workbook_bytes(wx.readings_sheet(["2024-01-01"], ["00:15"], [1.0]))
    bad = wx.workbook_bytes(wx.readings_sheet(["2024-01-01"], ["00:15"], ["x"]))
    blobs = spark.createDataFrame([("/l/A/a.xlsx", good, T0), ("/l/B/b.xlsx", bad, T0), ("/l/C/c.xlsx", b"none", T0)],
                                  "path string, content binary, modificationTime timestamp")
    parse = sl.workbook_parser(quarantine=tmp_dir + "/q")
    for batch_id, want in ((0, 2), (0, 2), (1, 4)):
        assert parse(blobs, batch_id).count() == 1
        assert spark.read.parquet(tmp_dir + "/q").count() == want


def test_load_batch_overlapping_files_newest_wins_and_order_dependence(spark, tmp_dir):
    base = os.path.join(tmp_dir, "out")
    h = dt.timedelta(hours=1)
    rows = [("A", T0, 1.0, "f1", 1), ("A", T0 + h, 1.0, "f1", 1),       # first snapshot of the month
            ("A", T0, 2.0, "f2", 2), ("A", T0 + h, 2.0, "f2", 2),       # re-export: same times, newer file
            ("A", T0 + 2 * h, 2.0, "f2", 2)]
    batch = spark.createDataFrame(rows, SCHEMA + ", file string, file_seq long")
    sl.load_batch(batch, 0, base + "/store")
    assert [(t, v) for _, t, v in _points(spark, base + "/store")] == [(T0, 2.0), (T0 + h, 2.0), (T0 + 2 * h, 2.0)]
    # documented order dependence: an older file arriving after a newer one adds nothing
    late = spark.createDataFrame([("A", T0 - h, 7.0, "f0", 0)], SCHEMA + ", file string, file_seq long")
    sl.load_batch(late, 1, base + "/store")
    assert ld.read_store(spark, base + "/store").count() == 3
