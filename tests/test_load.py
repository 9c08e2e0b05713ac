"""Full and delta loads, fan-out and source retention."""

import datetime as dt
import os

from pyspark.sql import functions as F

from meterlake.operators import load as ld
from meterlake.operators.marks import meter_bucket
from meterlake.operators.reshape import pivot_fields, second_precision, to_points

T0 = dt.datetime(2024, 1, 1)


def _readings(spark, rows):
    return spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double")


def test_to_points_and_pivot_round_trip(spark):
    wide = spark.createDataFrame([("A", T0, 1.5, 7.0)], "cpe string, date_time timestamp_ntz, consumption double, k double")
    pts = to_points(wide, fields=("consumption", "k"), tag_map=True)
    got = sorted((r["field"], r["value"]) for r in pts.collect())
    assert got == [("consumption", 1.5), ("k", 7.0)]
    assert pts.first()["tags"] == {"cpe": "A"}
    back = pivot_fields(pts.drop("tags"), ["consumption", "k"]).first()
    assert (back["consumption"], back["k"]) == (1.5, 7.0)


def test_second_precision(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 999999),)], "time timestamp_ntz")
    assert second_precision(df).first()[0] == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_write_full_is_idempotent_and_keeps_newest(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    first = to_points(_readings(spark, [("A", T0, 1.0), ("A", T0 + dt.timedelta(hours=1), 2.0)]))
    ld.write_full(first, path, load_seq=1)
    ld.write_full(first, path, load_seq=2)             # reload: no duplicates
    assert ld.read_store(spark, path).count() == 2
    corrected = to_points(_readings(spark, [("A", T0, 10.0), ("B", T0, 5.0)]))
    ld.write_full(corrected, path, load_seq=3)
    got = sorted((r["cpe"], r["time"], r["value"]) for r in ld.read_store(spark, path).collect())
    assert got == [("A", T0, 10.0), ("A", T0 + dt.timedelta(hours=1), 2.0), ("B", T0, 5.0)]


def test_write_full_keeps_other_meters_in_touched_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    codes = spark.range(200).select(F.concat(F.lit("M"), "id").alias("cpe")).withColumn("b", meter_bucket("cpe"))
    a, b = codes.groupBy("b").agg(F.sort_array(F.collect_list("cpe")).alias("c")).where("size(c) > 1").first()["c"][:2]
    both = to_points(_readings(spark, [(a, T0, 1.0), (b, T0, 2.0)]))       # two meters of one bucket
    ld.write_full(both, path, load_seq=1)
    ld.write_full(to_points(_readings(spark, [(a, T0, 5.0)])), path, load_seq=2)
    got = sorted((r["cpe"], r["value"]) for r in ld.read_store(spark, path).collect())
    assert got == [(a, 5.0), (b, 2.0)]


def test_loads_leave_stored_files_alone(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    rows = [(m, T0 + dt.timedelta(days=31 * i), float(i)) for i, m in enumerate("ABCDEFGH")]
    ld.write_full(to_points(_readings(spark, rows)), path, load_seq=1)
    (first,) = ld.committed_loads(spark, path)
    assert len(os.listdir(os.path.join(path, first.name, "measurement=kW"))) == 8

    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(path, first.name)) for f in fs}

    before = files()
    ld.write_full(to_points(_readings(spark, [("A", T0, 9.0)])), path, load_seq=2)
    assert files() == before
    got = sorted((r["cpe"], r["value"]) for r in ld.read_store(spark, path).collect())
    assert got[0] == ("A", 9.0) and len(got) == 8


def test_write_delta_appends_only_newer(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(_readings(spark, [("A", T0, 1.0), ("A", T0 + dt.timedelta(hours=2), 2.0)]), path, 1)
    # a gap before the mark is not refilled; equal time is not reloaded
    ld.write_delta(_readings(spark, [("A", T0 + dt.timedelta(hours=1), 9.0),
                                     ("A", T0 + dt.timedelta(hours=2), 9.0),
                                     ("A", T0 + dt.timedelta(hours=3), 3.0)]), path, 2)
    got = sorted((r["time"].hour, r["value"]) for r in ld.read_store(spark, path).collect())
    assert got == [(0, 1.0), (2, 2.0), (3, 3.0)]


def test_keep_latest_ties(spark):
    pts = spark.createDataFrame([("kW", "A", "consumption", T0, 1.0, 1, 5), ("kW", "A", "consumption", T0, 2.0, 1, 6),
                                 ("kW", "A", "consumption", T0, 3.0, 0, 9)],
                                "measurement string, cpe string, field string, time timestamp_ntz, value double, "
                                "load_seq int, seq int")
    assert ld.keep_latest(pts, tiebreak="seq").first()["value"] == 2.0


def test_fan_out_report(spark, tmp_dir):
    df = _readings(spark, [("A", T0, 1.0), ("B", T0, 2.0)])
    written = []
    report = ld.fan_out(df, ["parquet", "", None, "influxdb"],
                        {"parquet": lambda d: (d.write.parquet(tmp_dir + "/p"), written.append(1))})
    got = [(r["target"], r["status"], r["rows"]) for r in report.collect()]
    assert got == [("parquet", "loaded", 2), ("", "ignored", None), (None, "ignored", None),
                   ("influxdb", "unsupported", None)]
    assert written == [1] and spark.read.parquet(tmp_dir + "/p").count() == 2


def test_retain_source(spark, tmp_dir):
    files = []
    for name in ("a.xlsx", "b.xlsx"):
        p = os.path.join(tmp_dir, name)
        open(p, "wb").write(b"x")
        files.append(p)
    moved = ld.retain_source(spark, [files[0]], keep=True, archive_dir=os.path.join(tmp_dir, "session1"))
    assert os.path.exists(os.path.join(tmp_dir, "session1", "a.xlsx")) and not os.path.exists(files[0])
    assert moved[0].endswith("session1/a.xlsx")
    ld.retain_source(spark, [files[1]], keep=False)
    assert not os.path.exists(files[1])
    assert ld.retain_options(False) == {"cleanSource": "delete"}
    assert ld.retain_options(True, "/x")["cleanSource"] == "archive"
    assert F is not None


def test_delta_write_one_file_per_partition_folder(spark, tmp_dir):
    """Rows are clustered by partition folder before writing, so 8 input partitions
    spread over every bucket do not write 8 files into each folder."""
    rows = [(f"M{i % 97}", T0 + dt.timedelta(minutes=i * 40), float(i)) for i in range(2000)]   # two months
    readings = _readings(spark, rows).repartition(8)
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(readings, path, 1)
    per_folder = {}
    for d, _, files in os.walk(path):
        n = sum(f.endswith(".parquet") for f in files)
        if n:
            per_folder[d] = n
    assert len(per_folder) > 64 and max(per_folder.values()) == 1
    assert ld.read_store(spark, path).count() == 2000


def _kept_vs_store(spark, path):
    from meterlake.operators.marks import marks

    got = sorted((r["cpe"], r["last_insert"]) for r in ld.kept_marks(spark, path).collect())
    return got, sorted((r["cpe"], r["last_insert"]) for r in marks(ld.read_store(spark, path)).collect())


def _half_written(spark, path, readings, seq, kind=ld.DELTA):
    """A load whose writer died before the folder was committed."""
    pts = ld.with_month(to_points(_readings(spark, readings))).withColumn("load_seq", F.lit(seq).cast("long"))
    folder = os.path.join(path, f"load={seq:019d}-{seq:09d}-{kind}-dead")
    ld.write_points(pts, folder, "errorifexists")
    os.remove(os.path.join(folder, "_SUCCESS"))
    return folder


def test_kept_marks_follow_delta_and_full_loads(spark, tmp_dir):
    h = dt.timedelta(hours=1)
    path = os.path.join(tmp_dir, "store")
    assert ld.kept_marks(spark, path) is None
    ld.write_delta(_readings(spark, [("A", T0, 1.0), ("B", T0 + h, 2.0)]), path, 1)
    got, want = _kept_vs_store(spark, path)
    assert got == want == [("A", T0), ("B", T0 + h)]
    ld.write_delta(_readings(spark, [("A", T0 + 2 * h, 3.0), ("C", T0, 4.0)]), path, 2)
    got, want = _kept_vs_store(spark, path)
    assert got == want
    ld.write_full(to_points(_readings(spark, [("B", T0 + 5 * h, 5.0)])), path, 3)
    got, want = _kept_vs_store(spark, path)
    assert got == want and dict(got)["B"] == T0 + 5 * h
    assert len(os.listdir(os.path.join(path, "_marks"))) == 3             # one table a load
    assert ld.read_store(spark, path).count() == 5


def test_unfinished_load_is_not_seen_and_loaded_again(spark, tmp_dir):
    h = dt.timedelta(hours=1)
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(_readings(spark, [("A", T0, 1.0)]), path, 1)
    _half_written(spark, path, [("A", T0 + h, 2.0)], 2)
    assert ld.read_store(spark, path).count() == 1
    ld.write_delta(_readings(spark, [("A", T0 + h, 2.0), ("A", T0 + 2 * h, 3.0)]), path, 3)
    assert _stored(spark, path) == [("A", T0, 1.0), ("A", T0 + h, 2.0), ("A", T0 + 2 * h, 3.0)]
    got_kept, want = _kept_vs_store(spark, path)
    assert got_kept == want == [("A", T0 + 2 * h)]


def test_load_that_died_before_its_marks_still_counts(spark, tmp_dir):
    import shutil

    h = dt.timedelta(hours=1)
    path = os.path.join(tmp_dir, "store")
    ld.write_delta(_readings(spark, [("A", T0, 1.0)]), path, 1)
    ld.write_delta(_readings(spark, [("A", T0 + h, 2.0), ("B", T0, 5.0)]), path, 2)
    shutil.rmtree(os.path.join(path, "_marks", ld.committed_loads(spark, path)[-1].name))
    got, want = _kept_vs_store(spark, path)
    assert got == want == [("A", T0 + h), ("B", T0)]
    assert ld.write_delta(_readings(spark, [("A", T0 + h, 9.0), ("B", T0 + h, 6.0)]), path, 3).count() == 1


def test_store_with_only_an_unfinished_load_reads_as_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    _half_written(spark, path, [("A", T0, 7.0)], 1, ld.FULL)
    assert ld.read_store(spark, path) is None
    ld.write_delta(_readings(spark, [("A", T0, 1.0)]), path, 2)
    assert _stored(spark, path) == [("A", T0, 1.0)]


def test_full_load_that_dies_loses_no_stored_point(spark, tmp_dir):
    """A replacement that stops anywhere leaves the old points; only a whole one replaces them."""
    path = os.path.join(tmp_dir, "store")
    old = [("A", T0, 1.0), ("B", T0, 2.0), ("C", dt.datetime(2024, 2, 3), 3.0)]
    ld.write_full(to_points(_readings(spark, old)), path, 1)
    _half_written(spark, path, [("A", T0, 9.0), ("C", dt.datetime(2024, 2, 3), 9.0)], 2, ld.FULL)
    assert _stored(spark, path) == old
    ld.write_full(to_points(_readings(spark, [("A", T0, 9.0), ("D", T0, 4.0)])), path, 3)
    assert _stored(spark, path) == [("A", T0, 9.0), *old[1:], ("D", T0, 4.0)]


def test_first_load_is_written_once(spark, tmp_dir):
    path, seen = os.path.join(tmp_dir, "store"), []
    kept = ld.write_points
    ld.write_points = lambda df, where, mode: (seen.append(where), kept(df, where, mode))
    try:
        ld.write_full(to_points(_readings(spark, [("A", T0, 1.0)])), path, 1)
    finally:
        ld.write_points = kept
    assert len(seen) == 1 and seen[0].startswith(path)


def test_compaction_keeps_points_and_marks(spark, tmp_dir):
    path, h = os.path.join(tmp_dir, "store"), dt.timedelta(hours=1)
    ld.write_full(to_points(_readings(spark, [("A", T0, 1.0), ("B", T0, 2.0)])), path, 1)
    for n in range(2, 8):
        ld.write_delta(_readings(spark, [("A", T0 + n * h, float(n))]), path, n)
    ld.write_full(to_points(_readings(spark, [("A", T0 + 2 * h, 20.0), ("C", T0, 3.0)])), path, 8)
    _half_written(spark, path, [("Z", T0, 7.0)], 9)
    before, marks_before = _stored(spark, path), _kept_vs_store(spark, path)
    assert ld.compact(spark, path) == 7
    assert _stored(spark, path) == before and _kept_vs_store(spark, path) == marks_before
    names = [x for x in os.listdir(path) if x.startswith("load=")]
    assert len(names) == 2 == len(os.listdir(os.path.join(path, "_marks")))
    assert ("A", T0 + 2 * h, 20.0) in before
    assert ld.compact(spark, path, keep=0) == 2 and _stored(spark, path) == before
    seqs = {(r["cpe"], r["time"]): r["load_seq"] for r in ld.read_store(spark, path).collect()}
    assert seqs["A", T0 + 2 * h] == 8 and seqs["A", T0 + 3 * h] == 3 and seqs["B", T0] == 1
    ld.write_delta(_readings(spark, [("A", T0 + 7 * h, 0.0), ("A", T0 + 8 * h, 8.0)]), path, 10)
    assert _stored(spark, path) == sorted([*before, ("A", T0 + 8 * h, 8.0)])


def test_compaction_that_dies_before_it_deletes(spark, tmp_dir):
    """Old and merged folders side by side read as one."""
    path, h = os.path.join(tmp_dir, "store"), dt.timedelta(hours=1)
    for n in range(4):
        ld.write_delta(_readings(spark, [("A", T0 + n * h, float(n))]), path, n + 1)
    before = _stored(spark, path)
    old = ld.committed_loads(spark, path)[:3]
    points = ld._read_loads(spark, path, old)
    ld.write_points(points, f"{path}/load={old[-1].seq:019d}-{old[-1].k:09d}-{ld.MERGED}-abc", "errorifexists")
    assert _stored(spark, path) == before
    assert ld.write_delta(_readings(spark, [("A", T0 + h, 9.0)]), path, 9).count() == 0


def test_repeated_load_of_one_tag_is_written_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    rows = _readings(spark, [("A", T0, 1.0)])
    for _ in range(2):
        assert ld.write_delta(rows, path, 1, tag="s1b0").count() == 1
    assert len(ld.committed_loads(spark, path)) == 1


def test_store_last_insert_uses_kept_marks_and_sentinel(spark, tmp_dir):
    from meterlake.operators.marks import last_insert

    h = dt.timedelta(hours=1)
    path = os.path.join(tmp_dir, "store")
    meters = spark.createDataFrame([("A",), ("B",), ("Z",)], "cpe string")
    none = {r["cpe"]: r["last_insert"] for r in ld.store_last_insert(spark, path, meters).collect()}
    assert set(none.values()) == {dt.datetime(1989, 5, 11)}                  # empty store: sentinel
    ld.write_delta(_readings(spark, [("A", T0, 1.0), ("B", T0 + h, 2.0), ("A", T0 + 2 * h, 3.0)]), path, 1)
    got = {r["cpe"]: r["last_insert"] for r in ld.store_last_insert(spark, path, meters).collect()}
    want = {r["cpe"]: r["last_insert"] for r in last_insert(ld.read_store(spark, path), meters).collect()}
    assert got == want == {"A": T0 + 2 * h, "B": T0 + h, "Z": dt.datetime(1989, 5, 11)}


def test_store_last_point_reads_latest_months_only(spark, tmp_dir):
    from meterlake.operators.marks import last_point

    path = os.path.join(tmp_dir, "store")
    rows = [(f"M{i}", dt.datetime(2024, m, 10, i), float(10 * m + i)) for i in range(5) for m in (1, 2, 3)]
    rows += [("OLD", dt.datetime(2024, 1, 3), 7.0)]                         # a meter silent since January
    ld.write_delta(_readings(spark, rows), path, 1)
    ld.write_full(to_points(_readings(spark, [("M1", dt.datetime(2024, 3, 10, 1), 99.0)])), path, 2)  # reload
    out = ld.store_last_point(spark, path)
    plan = out._jdf.queryExecution().executedPlan().toString()
    parts = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "2024-03" in parts and "2024-01" in parts and "2024-02" not in parts
    got = sorted((r["cpe"], r["time"], r["value"]) for r in out.collect())
    stored = ld.read_store(spark, path).select("cpe", "time", "value", "load_seq")
    want = sorted((r["cpe"], r["time"], r["value"])
                  for r in last_point(stored, "cpe", "time", tiebreak="load_seq").collect())
    assert got == want and ("M1", dt.datetime(2024, 3, 10, 1), 99.0) in got and len(got) == 6


def _stored(spark, path):
    return sorted((r["cpe"], r["time"], r["value"]) for r in ld.read_store(spark, path).collect())


def test_delta_load_keeps_one_point_per_key_and_whole_seconds(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    us = dt.timedelta(microseconds=100)
    rows = [("A", T0, 1.0, 1), ("A", T0, 2.0, 2), ("A", T0 + us, 3.0, 3), ("B", T0, 4.0, 1)]
    df = spark.createDataFrame(rows, "cpe string, date_time timestamp_ntz, consumption double, n int")
    ld.write_delta(df, path, 1, order="n")
    assert _stored(spark, path) == [("A", T0, 3.0), ("B", T0, 4.0)]
    assert ld.write_delta(df, path, 2, order="n").count() == 0          # the same second is not newer
    assert len(_stored(spark, path)) == 2


def test_future_point_does_not_block_its_meter(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    far, h = dt.datetime(2099, 1, 1), dt.timedelta(hours=1)
    ld.write_delta(_readings(spark, [("A", T0, 1.0), ("A", far, 9.0)]), path, 1, as_of="2024-01-02 00:00:00")
    ld.write_delta(_readings(spark, [("A", T0 + h, 2.0), ("A", far, 9.0)]), path, 2, as_of="2024-01-02 00:00:00")
    assert _stored(spark, path) == [("A", T0, 1.0), ("A", T0 + h, 2.0), ("A", far, 9.0)]
    meters = spark.createDataFrame([("A",)], "cpe string")
    assert ld.store_last_insert(spark, path, meters, "2024-01-02 00:00:00").first()["last_insert"] == T0 + h


def test_empty_loads(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    none = _readings(spark, [])
    ld.write_full(to_points(none), path, 1)
    ld.write_delta(none, path, 2)
    assert ld.read_store(spark, path) is None
    ld.write_delta(_readings(spark, [("A", T0, 1.0)]), path, 3)
    ld.write_full(to_points(none), path, 4)
    assert _stored(spark, path) == [("A", T0, 1.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_fan_out_counts_what_was_written(spark, tmp_dir):
    path = os.path.join(tmp_dir, "store")
    df = _readings(spark, [("A", T0, 1.0), ("B", T0, 2.0)])
    for want in (2, 0):
        report = ld.fan_out(df, ["s"], {"s": lambda d: ld.write_delta(d, path, 1)})
        assert report.first()["rows"] == want


def test_claimed_folder_is_archived_whole(spark, tmp_dir):
    """Ten thousand files move by one rename; what arrives meanwhile stays for the next load."""
    landing = os.path.join(tmp_dir, "landing")
    for m in range(100):
        os.makedirs(os.path.join(landing, f"M{m}"))
        for i in range(100):
            with open(os.path.join(landing, f"M{m}", f"{i}.xlsx"), "w") as f:
                f.write(f"{m}-{i}")
    claimed = ld.claim_source(spark, landing)
    assert ld.claim_source(spark, landing) is None
    os.makedirs(os.path.join(landing, "M0"))
    open(os.path.join(landing, "M0", "late.xlsx"), "w").close()
    archive = os.path.join(tmp_dir, "out", "session")
    assert ld.retain_folder(spark, claimed, True, archive).endswith("out/session")
    got = {(d.rsplit("/", 1)[1], f): open(os.path.join(d, f)).read() for d, _, fs in os.walk(archive) for f in fs if not f.endswith(".crc")}
    assert len(got) == 10_000 and got["M7", "42.xlsx"] == "7-42"
    assert os.listdir(os.path.join(landing, "M0")) == ["late.xlsx"]
    again = ld.claim_source(spark, landing)
    os.makedirs(os.path.join(landing, "M0"))
    open(os.path.join(landing, "M0", "later.xlsx"), "w").close()
    ld.release_source(spark, again, landing)
    assert sorted(os.listdir(os.path.join(landing, "M0"))) == ["late.xlsx", "later.xlsx"]
    third = ld.claim_source(spark, landing)
    ld.retain_folder(spark, third, False, spare=[os.path.join(third, "M0", "late.xlsx")], landing=landing)
    assert os.listdir(os.path.join(landing, "M0")) == ["late.xlsx"]
    assert [x for x in os.listdir(tmp_dir) if "claimed" in x] == []


def test_retain_source_keeps_paths_apart(spark, tmp_dir):
    root = os.path.join(tmp_dir, "landing")
    files = []
    for meter in ("A", "B"):
        os.makedirs(os.path.join(root, meter))
        files.append(os.path.join(root, meter, "x.xlsx"))
        open(files[-1], "w").write(meter)
    try:
        ld.retain_source(spark, files, True, os.path.join(tmp_dir, "flat"))
        raise AssertionError("equal names met")
    except OSError:
        assert all(os.path.exists(f) for f in files)
    ld.retain_source(spark, files, True, os.path.join(tmp_dir, "kept"), root=root)
    assert open(os.path.join(tmp_dir, "kept", "B", "x.xlsx")).read() == "B" and not os.path.exists(os.path.join(root, "A"))
