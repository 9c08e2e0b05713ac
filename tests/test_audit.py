"""Audit tables."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from meterlake.functions import status as st
from meterlake.operators import audit as au

T0 = dt.datetime(2024, 1, 1)


def test_fold_updates_null_leaves_old_value(spark):
    log = spark.createDataFrame([
        ("t1", "queued", None, T0, 1), ("t1", "running", None, T0 + dt.timedelta(1), 2),
        ("t1", None, b"blob", T0 + dt.timedelta(2), 3), ("t1", "completed", None, T0 + dt.timedelta(3), 4),
        ("t2", "queued", None, T0, 5)], "task_id string, status string, file binary, updated timestamp_ntz, seq long")
    got = {r["task_id"]: (r["status"], r["file"], r["n_updates"])
           for r in au.fold_updates(log, "task_id", "updated", ["status", "file"], tiebreak="seq").collect()}
    assert got == {"t1": ("completed", bytearray(b"blob"), 4), "t2": ("queued", None, 1)}


def test_status_lookup_null_safe_miss(spark):
    status = spark.createDataFrame([("t1", "completed")], "task_id string, status string")
    ids = spark.createDataFrame([("t1",), ("zz",)], "task_id string")
    got = {r["task_id"]: r["status"] for r in au.status_lookup(status, ids).collect()}
    assert got == {"t1": "completed", "zz": None}


def test_surrogate_id_dense_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("k"))
    out = au.surrogate_id(df, ["k"])
    rows = sorted((r["k"], r["id"]) for r in out.collect())
    assert [i for _, i in rows] == list(range(1, 1001))


def test_unique_violations_and_orphans(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "task_id string")
    assert [(r["task_id"], r["n"]) for r in au.unique_violations(df, ["task_id"]).collect()] == [("a", 2)]
    parents = spark.createDataFrame([("a",)], "task_id string")
    assert [r[0] for r in au.orphans(df, parents, "task_id").collect()] == ["b"]


def test_check_requests(spark):
    req = spark.createDataFrame([("select", 5, 2023), ("select", None, 2023), ("monthly", 1, 2023),
                                 ("select", 13, 2023), ("select", 3, 2030), ("current", None, None)],
                                "workflow string, month int, year int")
    got = [r["reject_reason"] for r in au.check_requests(req, as_of="2024-01-01").collect()]
    assert got == [None, "select needs month and year", "unsupported workflow", "invalid month", "future", None]


def test_audit_insert_default_created(spark):
    rec = spark.createDataFrame([("t1", None), ("t2", T0)], "task_id string, created timestamp_ntz")
    got = {r["task_id"]: r["created"] for r in au.audit_insert(rec, "2024-02-02 10:00:00").collect()}
    assert got == {"t1": dt.datetime(2024, 2, 2, 10), "t2": T0}


def test_status_strings_and_names(spark):
    df = spark.createDataFrame([("failed: boom: x",), ("completed",), ("queued",)], "s string")
    got = [(r[0], r[1]) for r in df.select(st.status_state("s"), st.status_message("s")).collect()]
    assert got == [("failed", "boom: x"), ("completed", None), ("queued", None)]
    ids = spark.createDataFrame([(255, T0)], "k long, created timestamp_ntz")
    row = ids.select(st.uuid_from_key("k").alias("u"), st.download_name("created", st.uuid_from_key("k"))).first()
    assert row[0] == "00000000-0000-0000-0000-0000000000ff"
    assert row[1] == "2024-01-01_000000000000000000000000000000ff_readings.xlsx"
    tl = spark.createDataFrame([(" influxdb , parquet,,",)], "t string").select(st.target_list("t")).first()[0]
    assert tl == ["influxdb", "parquet", "", ""]
    assert spark.createDataFrame([(None,), (b"x",)], "f binary").select(st.file_flag("f")).collect()[1][0] == st.FILE_NOTE


def test_order_sessions_and_param_query(spark):
    s = spark.createDataFrame([("s1", T0 + dt.timedelta(1)), ("s1", T0 + dt.timedelta(1)), ("s2", T0)],
                              "session_id string, timestamp timestamp_ntz")
    assert [r[0] for r in au.order_sessions(s).collect()] == ["s2", "s1"]
    out = au.param_query(spark, "SELECT * FROM {t} WHERE session_id = :sid", {"sid": "s2"}, t=s)
    assert out.count() == 1


def test_create_tables(spark, tmp_dir):
    assert au.create_tables(spark, tmp_dir, requests="wr_test", status="ts_test")
    assert au.create_tables(spark, tmp_dir, requests="wr_test", status="ts_test")   # idempotent
    assert spark.table("wr_test").columns[:3] == ["id", "task_id", "workflow"]


def test_insert_requests_continues_sequence(spark, tmp_dir):
    au.create_tables(spark, tmp_dir, requests="wr_seq", status="ts_seq")
    schema = "task_id string, workflow string, db array<string>, month int, year int, delta boolean, " \
             "download boolean, created timestamp"
    first = spark.createDataFrame([("t1", "select", ["influxdb"], 5, 2023, False, True, None),
                                   ("t2", "current", [], None, None, True, False, None)], schema)
    au.insert_requests(first, "wr_seq", "2024-01-01 00:00:00", order_by=["created", "task_id"])
    second = spark.createDataFrame([("t3", "previous", None, None, None, None, None, None)], schema)
    au.insert_requests(second, "wr_seq", "2024-01-02 00:00:00")
    got = sorted((r["id"], r["task_id"]) for r in spark.table("wr_seq").collect())
    assert got == [(1, "t1"), (2, "t2"), (3, "t3")]
    assert {r["task_id"]: r["created"].day for r in spark.table("wr_seq").collect()}["t3"] == 2


def test_status_log_lifecycle(spark, tmp_dir):
    au.create_tables(spark, tmp_dir, requests="wr_life", status="ts_life")
    wanted = "task_id string, workflow string, db array<string>, month int, year int, delta boolean, " \
             "download boolean, created timestamp"
    au.insert_requests(spark.createDataFrame([(t, None, None, None, None, None, None, None) for t in ("t1", "t2")],
                                             wanted), "wr_life", "2024-01-01 00:00:00")
    schema = "task_id string, status string, file binary, created timestamp, updated timestamp"
    # as a request is queued: ``created`` set, ``updated`` not
    au.log_status(spark.createDataFrame([("t1", "queued", None, T0, None), ("t2", "queued", None, T0, None)], schema),
                  "ts_life", "wr_life")
    queued = {r["task_id"]: (r["status"], r["created"], r["updated"]) for r in au.task_status(spark, "ts_life").collect()}
    assert queued == {"t1": ("queued", T0, None), "t2": ("queued", T0, None)}
    au.log_status(spark.createDataFrame([("t1", "running", None, None, T0 + dt.timedelta(minutes=1))], schema),
                  "ts_life", "wr_life")
    _, rejected = au.log_status(spark.createDataFrame(
        [("t1", "completed", b"xlsx", None, T0 + dt.timedelta(minutes=2)), ("t2", "failed: boom", None, None, T0),
         ("t9", "running", None, None, T0), (None, "running", None, None, T0)], schema), "ts_life", "wr_life")
    assert sorted(r["task_id"] or "" for r in rejected.collect()) == ["", "t9"]
    cur = {r["task_id"]: (r["status"], r["file"], r["created"]) for r in au.task_status(spark, "ts_life").collect()}
    assert cur["t1"] == ("completed", st.FILE_NOTE, T0)
    assert cur["t2"] == ("failed: boom", None, T0)
    ids = spark.createDataFrame([("t1",), ("nope",)], "task_id string")
    got = {r["task_id"]: r["status"] for r in au.task_status(spark, "ts_life", ids).collect()}
    assert got == {"t1": "completed", "nope": None}
    full = {r["task_id"]: r["file"] for r in au.task_status(spark, "ts_life", with_file=True).collect()}
    assert bytes(full["t1"]) == b"xlsx"
    # a later partial update without a file leaves the stored file in place
    au.log_status(spark.createDataFrame([("t1", None, None, None, T0 + dt.timedelta(minutes=3))], schema),
                  "ts_life", "wr_life")
    cur = {r["task_id"]: (r["status"], r["file"]) for r in au.task_status(spark, "ts_life").collect()}
    assert cur["t1"] == ("completed", st.FILE_NOTE)
    full = {r["task_id"]: r["file"] for r in au.task_status(spark, "ts_life", with_file=True).collect()}
    assert bytes(full["t1"]) == b"xlsx"


def test_requests_without_or_with_a_known_id_are_rejected(spark, tmp_dir):
    au.create_tables(spark, tmp_dir, requests="wr_unique", status="ts_unique")
    schema = "task_id string, workflow string, db array<string>, month int, year int, delta boolean, " \
             "download boolean, created timestamp"
    rows = [("a", "select"), ("a", "current"), (None, "select"), ("b", "select")]
    for want in ([("a", "duplicate task_id"), (None, "task_id is null")],
                 [("a", "duplicate task_id"), ("a", "duplicate task_id"), (None, "task_id is null"),
                  ("b", "duplicate task_id")]):
        df = spark.createDataFrame([(t, w, None, None, None, None, None, None) for t, w in rows], schema)
        _, bad = au.insert_requests(df, "wr_unique", "2024-01-01 00:00:00")
        assert sorted(((r["task_id"], r["reason"]) for r in bad.collect()), key=repr) == sorted(want, key=repr)
    assert sorted((r["id"], r["task_id"]) for r in spark.table("wr_unique").collect()) == [(1, "a"), (2, "b")]


def test_a_task_runs_to_completed_or_failed(spark, tmp_dir):
    au.create_tables(spark, tmp_dir, requests="wr_run", status="ts_run")
    schema = "task_id string, workflow string, db array<string>, month int, year int, delta boolean, " \
             "download boolean, created timestamp"
    au.insert_requests(spark.createDataFrame([(t, None, None, None, None, None, None, None) for t in ("ok", "bad")],
                                             schema), "wr_run", "2024-01-01 00:00:00")
    assert au.run_task(spark, "ok", "wr_run", "ts_run", lambda: b"data") == b"data"
    with pytest.raises(ZeroDivisionError):
        au.run_task(spark, "bad", "wr_run", "ts_run", lambda: 1 // 0)
    with pytest.raises(ValueError):
        au.run_task(spark, "unknown", "wr_run", "ts_run", lambda: None)
    got = {r["task_id"]: (r["status"], r["file"]) for r in au.task_status(spark, "ts_run").collect()}
    assert got == {"ok": ("completed", st.FILE_NOTE), "bad": ("failed: integer division or modulo by zero", None)}


def test_order_sessions_breaks_equal_times_deterministically(spark):
    rows = [(f"s{i % 7}", "delta" if i % 2 else "full", T0) for i in range(40)] + [("s0", "full", T0 - dt.timedelta(1))]
    s = spark.createDataFrame(rows, "session_id string, workflow string, timestamp timestamp_ntz").repartition(5)
    out = [tuple(r) for r in au.order_sessions(s).collect()]
    assert out[0] == ("s0", "full", T0 - dt.timedelta(1))
    assert out[1:] == sorted(set(out[1:]), key=lambda r: (r[2], r[0], r[1]))
