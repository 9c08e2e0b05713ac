"""Registered queries: one per operator of the blueprint, each with its DuckDB oracle.

Every query reads the stored tables (or frames Spark derives from them) in
full. Fixed parameters (cut-offs, ``as_of`` dates, request months) are listed
once below so the Spark side and the SQL side use the same values.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import calendar as cal
from meterlake.functions import literals as lit
from meterlake.functions import parsing as ps
from meterlake.functions import status as st
from meterlake.operators import audit as au
from meterlake.operators import load as ld
from meterlake.operators import marks as mk
from meterlake.operators import periods as pr
from meterlake.operators import readings as rd
from meterlake.operators import reshape as rs
from meterlake.operators import settings as stg
from meterlake.plans.joins import lookup_join, materialize
from meterlake.sources import workbook_export as wx
from meterlake.sources import workbooks as wb
from meterlake.session import ensure_utc, scratch_path
from meterlake.sources.tables import event_readings, meter_registry, order_readings, table
from meterlake.streaming import delta_state as ds
from meterlake.streaming import stream_load as sl

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; running it puts the session's zone and broadcast policy in place
    (queries are applications of the library, whose functions leave the session as it is)."""
    def add(fn):
        @wraps(fn)
        def run(spark, sf):
            ensure_utc(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


# Fixed parameters shared by the Spark queries and their SQL oracles.
STORE_CUTOFF = "2024-01-16 00:00:00"      # points before this are "already stored"
UNREGISTERED_SEGMENT = "BUILDING"         # meters of this segment have nothing stored
RANGE_STOP = "2024-01-20 00:00:00"        # C1 upper bound ("now")
LOOKUP_SEGMENT = "AUTOMOBILE"             # C2 / G3: the meters asked for

_NTZ = "TIMESTAMP"  # DuckDB spelling of a naive timestamp literal


def stored_points(spark: SparkSession, sf: str) -> DataFrame:
    """The store the delta queries compare against: readings before the cut-off,
    for the registered meters only (so some meters have no mark)."""
    readings = event_readings(spark, sf).filter(F.col("date_time") < mk.ts_literal(STORE_CUTOFF, _ntz()))
    registered = meter_registry(spark, sf).filter(F.col("c_mktsegment") != UNREGISTERED_SEGMENT).select("cpe")
    return rs.to_points(lookup_join(readings, registered, "cpe", "left_semi"))


def _ntz():
    from pyspark.sql.types import TimestampNTZType
    return TimestampNTZType()


_STORED_SQL = f"""
stored AS (
  SELECT CAST(user_id AS VARCHAR) AS cpe, ts AS time FROM events
  WHERE ts < {_NTZ} '{STORE_CUTOFF}'
    AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> '{UNREGISTERED_SEGMENT}')),
marks AS (
  SELECT cpe, max(time) AS mark FROM stored
  WHERE time >= {_NTZ} '1989-05-11 01:10:00' GROUP BY cpe)"""

_POINTS_SQL = """
SELECT 'kW' AS measurement, CAST(user_id AS VARCHAR) AS cpe, 'consumption' AS field,
       value, ts AS time FROM events"""


# --------------------------------------------------------------------------- A
@register("a3_scan_points", _POINTS_SQL)
def a3_scan_points(spark, sf):
    return rs.to_points(event_readings(spark, sf))


# --------------------------------------------------------------------------- C
@register("c1_range_scan", f"""
SELECT * FROM ({_POINTS_SQL}) p
WHERE time >= {_NTZ} '1989-05-11 01:10:00' AND time < {_NTZ} '{RANGE_STOP}'""")
def c1_range_scan(spark, sf):
    return mk.range_scan(rs.to_points(event_readings(spark, sf)), stop=RANGE_STOP)


@register("c2_series_filter", f"""
SELECT 'kW' AS measurement, CAST(user_id AS VARCHAR) AS cpe, event_type AS field, value, ts AS time
FROM events
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = '{LOOKUP_SEGMENT}')
  AND event_type = 'purchase'""")
def c2_series_filter(spark, sf):
    ev = table(spark, sf, "events")
    pts = ev.select(F.lit("kW").alias("measurement"), F.col("user_id").cast("string").alias("cpe"),
                    F.col("event_type").alias("field"), "value", F.col("ts").alias("time"))
    asked = meter_registry(spark, sf).filter(F.col("c_mktsegment") == LOOKUP_SEGMENT)
    return mk.series_filter(pts, "kW", "purchase", asked)


@register("c8_delta", f"""
WITH {_STORED_SQL}
SELECT CAST(e.user_id AS VARCHAR) AS cpe, e.ts AS date_time, e.value AS consumption, e.event_id AS seq
FROM events e LEFT JOIN marks m ON CAST(e.user_id AS VARCHAR) = m.cpe
WHERE e.ts > COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00')""")
def c8_delta(spark, sf):
    return mk.delta(event_readings(spark, sf), stored_points(spark, sf))


# --------------------------------------------------------------------------- D
@register("d1_last_point", """
SELECT cpe, time, value, seq FROM (
  SELECT CAST(user_id AS VARCHAR) AS cpe, ts AS time, value, event_id AS seq,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def d1_last_point(spark, sf):
    r = event_readings(spark, sf).select("cpe", F.col("date_time").alias("time"),
                                          F.col("consumption").alias("value"), "seq")
    return mk.last_point(r, "cpe", "time", tiebreak="seq")


@register("d2_last_insert", f"""
WITH {_STORED_SQL}
SELECT CAST(c.c_custkey AS VARCHAR) AS cpe, COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00') AS last_insert
FROM customer c LEFT JOIN marks m ON CAST(c.c_custkey AS VARCHAR) = m.cpe""")
def d2_last_insert(spark, sf):
    return mk.last_insert(stored_points(spark, sf), meter_registry(spark, sf))


EVENT_FIELDS = ("click", "error", "purchase", "signup", "view")


@register("d3_pivot_fields", """
SELECT CAST(user_id AS VARCHAR) AS cpe, ts AS time,
  max(CASE WHEN event_type = 'click' THEN value END) AS click,
  max(CASE WHEN event_type = 'error' THEN value END) AS error,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
  max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
  max(CASE WHEN event_type = 'view' THEN value END) AS view
FROM events GROUP BY user_id, ts""")
def d3_pivot_fields(spark, sf):
    ev = table(spark, sf, "events")
    tall = ev.select(F.col("user_id").cast("string").alias("cpe"), F.col("ts").alias("time"),
                     F.col("event_type").alias("field"), "value")
    return rs.pivot_fields(tall, EVENT_FIELDS)


@register("d4_load_profile", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n_readings,
       count(DISTINCT o_custkey) AS n_meters, round(sum(o_totalprice), 2) AS total_consumption
FROM orders GROUP BY 1, 2""")
def d4_load_profile(spark, sf):
    r = order_readings(spark, sf).withColumns({"year": F.year("date_time"), "month": F.month("date_time")})
    return rs.load_profile(r, ["year", "month"])


# --------------------------------------------------------------------------- F
@register("f1_to_points", """
SELECT 'kW' AS measurement, CAST(user_id AS VARCHAR) AS cpe, f.field, f.value, ts AS time
FROM events, LATERAL (VALUES ('consumption', value),
                             ('k', CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE))) AS f(field, value)""")
def f1_to_points(spark, sf):
    ev = table(spark, sf, "events")
    wide = ev.select(F.col("user_id").cast("string").alias("cpe"), F.col("ts").alias("date_time"),
                     F.col("value").alias("consumption"),
                     F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"))
    return rs.to_points(wide, fields=("consumption", "k"))


@register("f2_second_precision", """
SELECT event_id, date_trunc('second', ts) AS time FROM events""")
def f2_second_precision(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("ts").alias("time"))
    return rs.second_precision(ev)


# --------------------------------------------------------------------------- A4, B

_SESSION_HEX_SQL = "lpad(lower(hex(o_orderkey)), 8, '0')"
_PROV = wb.PROVENANCE_PATTERN


@register("a4_file_provenance", f"""
SELECT o_orderkey, file,
       CAST(regexp_extract(file, '{_PROV}', 1) AS INTEGER) AS year,
       CAST(regexp_extract(file, '{_PROV}', 2) AS INTEGER) AS month,
       lower(regexp_extract(file, '{_PROV}', 3)) AS session
FROM (SELECT o_orderkey, '/landing/' || year(o_orderdate) || '_' || month(o_orderdate) || '_'
             || {_SESSION_HEX_SQL} || '_readings.xlsx' AS file FROM orders)""")
def a4_file_provenance(spark, sf):
    o = table(spark, sf, "orders")
    named = o.select("o_orderkey", F.concat(F.lit("/landing/"), wb.provenance_name(
        F.year("o_orderdate"), F.month("o_orderdate"),
        F.lpad(F.lower(F.hex("o_orderkey")), 8, "0"))).alias("file"))
    return named.select("o_orderkey", "file", wb.file_provenance("file").alias("p")).select(
        "o_orderkey", "file", "p.year", "p.month", "p.session")


def _event_cells(spark, sf) -> DataFrame:
    """Raw workbook-like rows from events: date text, time text, number text, extra column."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", F.array(
        F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm"),
        F.format_number("value", 2), F.col("event_type")).alias("cells"))


_CELLS_SQL = """strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M') AS time,
       format('{:,.2f}', value) AS consumption"""


@register("b1_merge_date_time", """
SELECT event_id, date_trunc('minute', ts) AS date_time FROM events""")
def b1_merge_date_time(spark, sf):
    rows = rd.first_three(_event_cells(spark, sf), keep=("event_id",))
    return rows.select("event_id", ps.merge_date_time("date", "time").alias("date_time"))


@register("b2_parse_number", """
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS text,
       CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE) AS consumption
FROM orders""")
def b2_parse_number(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("text"))
    return o.withColumn("consumption", ps.parse_number("text"))


@register("b3_first_three", f"""
SELECT event_id, {_CELLS_SQL} FROM events""")
def b3_first_three(spark, sf):
    return rd.first_three(_event_cells(spark, sf), keep=("event_id",))


@register("b4_attach_series", """
SELECT e.event_id, 'meter_' || e.user_id || '.xlsx' AS file,
       'PT00' || lpad(CAST(c.c_custkey AS VARCHAR), 12, '0') || '04TW' AS cpe
FROM events e LEFT JOIN customer c ON 'meter_' || e.user_id || '.xlsx' = 'meter_' || c.c_custkey || '.xlsx'""")
def b4_attach_series(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("meter_"), F.col("user_id").cast("string"), F.lit(".xlsx")).alias("file"))
    files = table(spark, sf, "customer").select(
        F.concat(F.lit("meter_"), F.col("c_custkey").cast("string"), F.lit(".xlsx")).alias("file"),
        st.cpe_code("c_custkey").alias("cpe"))
    return rd.attach_series(rows, files)


@register("b5_localize_utc", """
SELECT event_id, ts AS date_time, epoch_us(ts) AS epoch_us FROM events""")
def b5_localize_utc(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.col("ts").alias("date_time"),
                     ps.epoch_micros(ps.localize_utc("ts")).alias("epoch_us"))


@register("b6_key_by_time", """
SELECT CAST(user_id AS VARCHAR) AS cpe, ts AS date_time, value AS consumption, event_id AS seq FROM events""")
def b6_key_by_time(spark, sf):
    return rd.key_by_time(event_readings(spark, sf))


# --------------------------------------------------------------------------- C3-C7
SELECT_YEAR, SELECT_MONTH = 1995, 5
CURRENT_AS_OF = "2001-07-15"
PREVIOUS_AS_OF = "1996-01-10"      # January: the previous month is December 1995
REQUEST_AS_OF = "1999-06-15"

_ORDER_READINGS_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS cpe, o_orderdate AS date_time, o_totalprice AS consumption,
       o_orderkey AS seq FROM orders"""


@register("c3_month_select", f"""
{_ORDER_READINGS_SQL}
WHERE o_orderdate >= {_NTZ} '1995-05-01' AND o_orderdate < {_NTZ} '1995-06-01'""")
def c3_month_select(spark, sf):
    return pr.select_period(order_readings(spark, sf), "select", year=SELECT_YEAR, month=SELECT_MONTH)


@register("c4_month_current", f"""
{_ORDER_READINGS_SQL}
WHERE o_orderdate >= {_NTZ} '2001-07-01' AND o_orderdate < {_NTZ} '2001-08-01'""")
def c4_month_current(spark, sf):
    return pr.select_period(order_readings(spark, sf), "current", as_of=CURRENT_AS_OF)


@register("c5_month_previous", f"""
{_ORDER_READINGS_SQL}
WHERE o_orderdate >= {_NTZ} '1995-12-01' AND o_orderdate < {_NTZ} '1996-01-01'""")
def c5_month_previous(spark, sf):
    return pr.select_period(order_readings(spark, sf), "previous", as_of=PREVIOUS_AS_OF)


def _order_requests(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("cpe"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@register("c6_reject_future", f"""
SELECT o_orderkey, year, month, NOT coalesce(CASE WHEN month BETWEEN 1 AND 12 THEN
       make_timestamp(year, month, 1, 0, 0, 0) <= {_NTZ} '{REQUEST_AS_OF}' END, false) AS rejected
FROM (SELECT o_orderkey, year(o_orderdate) AS year,
             CASE WHEN o_orderkey % 11 = 0 THEN 13 WHEN o_orderkey % 13 = 0 THEN NULL ELSE month(o_orderdate) END AS month FROM orders)""")
def c6_reject_future(spark, sf):
    """Requests with their verdict; some ask for a thirteenth month, some for none."""
    key = F.col("o_orderkey")
    asked = (_order_requests(spark, sf).drop("cpe").withColumn("month", F.when(key % 11 == 0, F.lit(13))
             .when(key % 13 == 0, F.lit(None).cast("int")).otherwise(F.col("month"))))
    good, bad = pr.reject_future(asked, REQUEST_AS_OF)
    columns = ["o_orderkey", "year", "month"]
    return (good.select(*columns, F.lit(False).alias("rejected"))
            .unionByName(bad.select(*columns, F.lit(True).alias("rejected"))))


@register("c7_missing_periods", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cpe, year(o_orderdate) AS year, month(o_orderdate) AS month
FROM orders r
WHERE NOT EXISTS (SELECT 1 FROM orders a WHERE a.o_orderstatus = 'F' AND a.o_custkey = r.o_custkey
                  AND year(a.o_orderdate) = year(r.o_orderdate) AND month(a.o_orderdate) = month(r.o_orderdate))""")
def c7_missing_periods(spark, sf):
    req = _order_requests(spark, sf)
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    available = o.select(F.col("o_custkey").cast("string").alias("cpe"),
                         F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return pr.missing_periods(req, available)


# --------------------------------------------------------------------------- E2
ORPHAN_CUTOFF = "1998-01-01"


@register("e2_orphan_status", f"""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < {_NTZ} '{ORPHAN_CUTOFF}')""")
def e2_orphan_status(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    parents = table(spark, sf, "orders").filter(
        F.col("o_orderdate") < mk.ts_literal(ORPHAN_CUTOFF, _ntz()))
    return au.orphans(li, parents, "l_orderkey", "o_orderkey")


# --------------------------------------------------------------------------- F3-F5
FIRST_LOAD_END = "2024-01-20 00:00:00"
SECOND_LOAD_START = "2024-01-10 00:00:00"


def _hourly_points(spark, sf, cond, load_seq: int) -> DataFrame:
    """One load of hourly points (``seq`` kept to break ties inside a load)."""
    r = event_readings(spark, sf).filter(cond)
    return r.select(F.lit("kW").alias("measurement"), "cpe", F.lit("consumption").alias("field"),
                    F.date_trunc("hour", "date_time").cast("timestamp_ntz").alias("time"),
                    F.col("consumption").alias("value"),
                    F.lit(load_seq).cast("long").alias("load_seq"), "seq")


@register("f3_load_full", f"""
WITH loads AS (
  SELECT CAST(user_id AS VARCHAR) AS cpe, date_trunc('hour', ts) AS time, value,
         CAST(1 AS BIGINT) AS load_seq, event_id AS seq FROM events WHERE ts < {_NTZ} '{FIRST_LOAD_END}'
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), date_trunc('hour', ts), value, CAST(2 AS BIGINT), event_id
  FROM events WHERE ts >= {_NTZ} '{SECOND_LOAD_START}')
SELECT 'kW' AS measurement, cpe, 'consumption' AS field, time, value, load_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY cpe, time ORDER BY load_seq DESC, seq DESC) AS rn FROM loads)
WHERE rn = 1""")
def f3_load_full(spark, sf):
    first = _hourly_points(spark, sf, F.col("date_time") < mk.ts_literal(FIRST_LOAD_END, _ntz()), 1)
    second = _hourly_points(spark, sf, F.col("date_time") >= mk.ts_literal(SECOND_LOAD_START, _ntz()), 2)
    store = scratch_path(spark, "f3-store")
    for n, points in enumerate((first, second), 1):
        ld.write_full(points.drop("load_seq"), store, n, order="seq")
    return ld.read_store(spark, store).select("measurement", "cpe", "field", "time", "value", "load_seq")


@register("f4_load_delta", f"""
WITH r AS (
  SELECT CAST(user_id AS VARCHAR) AS cpe, date_trunc('second', ts) AS time, value, event_id,
         ts < {_NTZ} '{STORE_CUTOFF}' AND user_id IN (
           SELECT c_custkey FROM customer WHERE c_mktsegment <> '{UNREGISTERED_SEGMENT}') AS early FROM events),
first AS (
  SELECT cpe, time, value FROM r WHERE early
  QUALIFY row_number() OVER (PARTITION BY cpe, time ORDER BY event_id DESC) = 1),
marks AS (SELECT cpe, max(time) AS mark FROM first WHERE time >= {_NTZ} '1989-05-11 01:10:00' GROUP BY cpe)
SELECT 'kW' AS measurement, cpe, 'consumption' AS field, value, time, CAST(1 AS BIGINT) AS load_seq FROM first
UNION ALL
SELECT 'kW', r.cpe, 'consumption', r.value, r.time, 2 FROM r LEFT JOIN marks m ON r.cpe = m.cpe
WHERE r.time > COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00')
QUALIFY row_number() OVER (PARTITION BY r.cpe, r.time ORDER BY r.event_id DESC) = 1""")
def f4_load_delta(spark, sf):
    """Two delta loads into a store, read back: the early readings of registered meters, then all."""
    readings = event_readings(spark, sf)
    registered = meter_registry(spark, sf).filter(F.col("c_mktsegment") != UNREGISTERED_SEGMENT).select("cpe")
    early = lookup_join(readings.filter(F.col("date_time") < mk.ts_literal(STORE_CUTOFF, _ntz())), registered,
                        "cpe", "left_semi")
    store = scratch_path(spark, "f4-store")
    for n, part in enumerate((early, readings), 1):
        ld.write_delta(part, store, n, order="seq")
    return ld.read_store(spark, store).select("measurement", "cpe", "field", "value", "time", "load_seq")


FAN_OUT_TARGETS = "parquet, ,influxdb,orc"   # as typed on a command line


@register("f5_fan_out", """
SELECT target, status, CAST(n AS BIGINT) AS rows FROM (VALUES
  ('parquet', 'loaded', (SELECT count(*) FROM events)), ('', 'ignored', NULL),
  ('influxdb', 'unsupported', NULL), ('orc', 'loaded', (SELECT count(*) FROM events))) AS t(target, status, n)""")
def f5_fan_out(spark, sf):
    pts = rs.to_points(event_readings(spark, sf))
    out = scratch_path(spark, "fan-out")
    writers = {
        "parquet": lambda df: df.write.mode("overwrite").partitionBy("measurement").parquet(out + "/parquet"),
        "orc": lambda df: df.write.mode("overwrite").orc(out + "/orc"),
    }
    names = [t.strip() for t in FAN_OUT_TARGETS.split(",")]
    return ld.fan_out(pts, names, writers)


@register("f6_retain_source", _POINTS_SQL)
def f6_retain_source(spark, sf):
    """Landed files kept: the events' points written as files to a landing folder,
    each file moved into the archive (retain_source, keep=True), the archive read back."""
    base = scratch_path(spark, "retain")
    rs.to_points(event_readings(spark, sf)).write.parquet(f"{base}/landing")
    jvm = spark.sparkContext._jvm
    landing = jvm.org.apache.hadoop.fs.Path(f"{base}/landing")
    fs = landing.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [st_.getPath().toString() for st_ in fs.listStatus(landing) if st_.getPath().getName().endswith(".parquet")]
    ld.retain_source(spark, files, keep=True, archive_dir=f"{base}/archive")
    return spark.read.parquet(f"{base}/archive")


# --------------------------------------------------------------------------- G
AUDIT_AS_OF = "2001-08-02 00:00:00"

_UUID_SQL = """(lpad(lower(hex({k})), 32, '0')[1:8] || '-' || lpad(lower(hex({k})), 32, '0')[9:12] || '-'
 || lpad(lower(hex({k})), 32, '0')[13:16] || '-' || lpad(lower(hex({k})), 32, '0')[17:20] || '-'
 || lpad(lower(hex({k})), 32, '0')[21:32])"""


def _requests(spark, sf) -> DataFrame:
    """Workflow requests standing in for the audit table: one per order."""
    o = table(spark, sf, "orders")
    return o.select(
        st.uuid_from_key("o_orderkey").alias("task_id"),
        F.when(F.col("o_orderstatus") == "F", "select").when(F.col("o_orderstatus") == "O", "current")
         .otherwise("previous").alias("workflow"),
        F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"),
        (F.col("o_totalprice") > 200000).alias("delta"),
        (F.col("o_orderpriority") == "1-URGENT").alias("download"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("created"))


@register("g1_audit_insert", f"""
SELECT {_UUID_SQL.format(k='o_orderkey')} AS task_id,
  CASE o_orderstatus WHEN 'F' THEN 'select' WHEN 'O' THEN 'current' ELSE 'previous' END AS workflow,
  month(o_orderdate) AS month, year(o_orderdate) AS year, o_totalprice > 200000 AS delta,
  o_orderpriority = '1-URGENT' AS download,
  COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END, {_NTZ} '{AUDIT_AS_OF}') AS created
FROM orders""")
def g1_audit_insert(spark, sf):
    return au.audit_insert(_requests(spark, sf), AUDIT_AS_OF)


def _status_log(spark, sf) -> DataFrame:
    """Task status updates standing in for the status log: one per event."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").cast("string").alias("task_id"),
                     F.when(F.col("event_type") != "view", F.col("event_type")).alias("status"),
                     F.when(F.col("event_type") == "purchase", F.col("props")).alias("file"),
                     F.col("ts").alias("updated"), F.col("event_id").alias("seq"))


_FOLD_SQL = """
SELECT CAST(user_id AS VARCHAR) AS task_id,
  max_by(CASE WHEN event_type <> 'view' THEN event_type END, CASE WHEN event_type <> 'view' THEN ts END) AS status,
  max_by(CASE WHEN event_type = 'purchase' THEN props END, CASE WHEN event_type = 'purchase' THEN ts END) AS file,
  max(ts) AS updated, count(*) AS n_updates
FROM events GROUP BY user_id"""


@register("g2_status_update", _FOLD_SQL)
def g2_status_update(spark, sf):
    return au.fold_updates(_status_log(spark, sf), "task_id", "updated",
                           ["status", "file", "updated"], tiebreak="seq")


@register("g3_status_lookup", f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS task_id, s.status, s.updated
FROM customer c LEFT JOIN ({_FOLD_SQL}) s ON CAST(c.c_custkey AS VARCHAR) = s.task_id
WHERE c.c_mktsegment = '{LOOKUP_SEGMENT}'""")
def g3_status_lookup(spark, sf):
    status = au.fold_updates(_status_log(spark, sf), "task_id", "updated",
                             ["status", "updated"], tiebreak="seq").drop("n_updates")
    ids = (table(spark, sf, "customer").filter(F.col("c_mktsegment") == LOOKUP_SEGMENT)
           .select(F.col("c_custkey").cast("string").alias("task_id")))
    return au.status_lookup(status, ids)


@register("g4_unique_violations", """
SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def g4_unique_violations(spark, sf):
    return au.unique_violations(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@register("g5_surrogate_id", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders""")
def g5_surrogate_id(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return au.surrogate_id(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@register("g6_param_query", f"""
SELECT event_id, user_id, value FROM events
WHERE event_type = 'purchase' AND ts >= {_NTZ} '2024-01-10 00:00:00'""")
def g6_param_query(spark, sf):
    return au.param_query(
        spark, "SELECT event_id, user_id, value FROM {ev} "
               "WHERE event_type = :etype AND ts >= CAST(:start AS TIMESTAMP_NTZ)",
        {"etype": "purchase", "start": "2024-01-10 00:00:00"}, ev=table(spark, sf, "events"))


@register("g7_explode_targets", """
SELECT event_id, CAST(unnest(generate_series(0, len(l) - 1)) AS INTEGER) AS pos, unnest(l) AS target
FROM (SELECT event_id, list_transform(string_split(event_type || ', influxdb ,', ','), lambda x: trim(x)) AS l
      FROM events)""")
def g7_explode_targets(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.concat("event_type", F.lit(", influxdb ,")).alias("db"))
    return ev.select("event_id", F.posexplode(st.target_list("db")).alias("pos", "target"))


_STATUS_TEXT_SQL = """CASE event_type WHEN 'error' THEN 'failed: ' || props WHEN 'purchase' THEN 'completed'
  WHEN 'view' THEN 'queued' WHEN 'click' THEN 'running' ELSE 'failed: timeout' END"""


@register("g8_status_parts", f"""
SELECT event_id, CASE WHEN starts_with(s, 'failed') THEN 'failed' ELSE s END AS state,
       CASE WHEN starts_with(s, 'failed: ') THEN substr(s, 9) END AS message
FROM (SELECT event_id, {_STATUS_TEXT_SQL} AS s FROM events)""")
def g8_status_parts(spark, sf):
    ev = table(spark, sf, "events")
    s = (F.when(F.col("event_type") == "error", F.concat(F.lit("failed: "), F.col("props")))
         .when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "view", "queued")
         .when(F.col("event_type") == "click", "running").otherwise("failed: timeout"))
    return ev.select("event_id", s.alias("s")).select(
        "event_id", st.status_state("s").alias("state"), st.status_message("s").alias("message"))


@register("g9_file_flag", f"""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN '{st.FILE_NOTE}' END AS file FROM events""")
def g9_file_flag(spark, sf):
    ev = table(spark, sf, "events")
    file = F.when(F.col("event_type") == "purchase", F.col("props").cast("binary"))
    return ev.select("event_id", st.file_flag(file).alias("file"))


@register("g10_check_requests", f"""
SELECT o_orderkey, workflow, month, year,
  CASE WHEN workflow IS NULL OR workflow NOT IN ('current', 'previous', 'select') THEN 'unsupported workflow'
       WHEN workflow = 'select' AND (month IS NULL OR year IS NULL) THEN 'select needs month and year'
       WHEN workflow = 'select' AND (month < 1 OR month > 12) THEN 'invalid month'
       WHEN workflow = 'select' AND make_timestamp(year, month, 1, 0, 0, 0) > {_NTZ} '{REQUEST_AS_OF}' THEN 'future'
  END AS reject_reason
FROM (SELECT o_orderkey,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'select' WHEN '2-HIGH' THEN 'current'
             WHEN '3-MEDIUM' THEN 'previous' WHEN '4-NOT SPECIFIED' THEN 'monthly' ELSE 'select' END AS workflow,
        CASE WHEN o_orderstatus <> 'P' THEN month(o_orderdate) END AS month, year(o_orderdate) AS year
      FROM orders)""")
def g10_check_requests(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_orderpriority")
    req = o.select(
        "o_orderkey",
        F.when(p == "1-URGENT", "select").when(p == "2-HIGH", "current").when(p == "3-MEDIUM", "previous")
         .when(p == "4-NOT SPECIFIED", "monthly").otherwise("select").alias("workflow"),
        F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate")).alias("month"),
        F.year("o_orderdate").alias("year"))
    return au.check_requests(req, REQUEST_AS_OF)


@register("g11_download_name", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '_' || lpad(lower(hex(o_orderkey)), 32, '0')
       || '_readings.xlsx' AS file_name FROM orders""")
def g11_download_name(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", st.download_name("o_orderdate", st.uuid_from_key("o_orderkey")).alias("file_name"))


@register("g12_order_sessions", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS session_id, event_type AS workflow, 'influxdb' AS databases,
  '/data/' || user_id || '/' || strftime(ts, '%Y_%m') || '_readings.xlsx' AS source_data,
  '/data/' || user_id AS staging_area, 'completed' AS status, date_trunc('hour', ts) AS timestamp
FROM events""")
def g12_order_sessions(spark, sf):
    ev = table(spark, sf, "events")
    uid = F.col("user_id").cast("string")
    sessions = ev.select(
        uid.alias("session_id"), F.col("event_type").alias("workflow"), F.lit("influxdb").alias("databases"),
        F.concat(F.lit("/data/"), uid, F.lit("/"), F.date_format("ts", "yyyy_MM"), F.lit("_readings.xlsx"))
         .alias("source_data"),
        F.concat(F.lit("/data/"), uid).alias("staging_area"), F.lit("completed").alias("status"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"))
    return au.order_sessions(sessions)


SECOND_BATCH_FROM = "1998-01-01"   # requests from this date on arrive in a second insert


@register("g13_create_tables", f"""
WITH req AS (
  SELECT {_UUID_SQL.format(k='o_orderkey')} AS task_id,
    CASE o_orderstatus WHEN 'F' THEN 'select' WHEN 'O' THEN 'current' ELSE 'previous' END AS workflow,
    CASE WHEN o_orderstatus = 'F' THEN 'influxdb' ELSE 'influxdb,parquet' END AS db,
    month(o_orderdate) AS month, year(o_orderdate) AS year, o_totalprice > 200000 AS delta,
    o_orderpriority = '1-URGENT' AS download,
    COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END, {_NTZ} '{AUDIT_AS_OF}') AS created,
    CASE WHEN o_orderdate < {_NTZ} '{SECOND_BATCH_FROM}' THEN 1 ELSE 2 END AS batch
  FROM orders)
SELECT row_number() OVER (ORDER BY batch, created, task_id) AS id,
       task_id, workflow, db, month, year, delta, download, created
FROM req""")
def g13_create_tables(spark, sf):
    """Create both audit tables, insert the requests in two batches (defaults, continuing
    sequence ids), and read the request table back."""
    suffix = uuid.uuid4().hex[:12]
    requests, status = f"workflowrequests_{suffix}", f"taskstatus_{suffix}"
    au.create_tables(spark, scratch_path(spark, "audit"), requests=requests, status=status)
    o = table(spark, sf, "orders")
    rows = o.select(
        st.uuid_from_key("o_orderkey").alias("task_id"),
        F.when(F.col("o_orderstatus") == "F", "select").when(F.col("o_orderstatus") == "O", "current")
         .otherwise("previous").alias("workflow"),
        st.target_list(F.when(F.col("o_orderstatus") == "F", "influxdb").otherwise("influxdb, parquet"))
         .alias("db"),
        F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"),
        (F.col("o_totalprice") > 200000).alias("delta"),
        (F.col("o_orderpriority") == "1-URGENT").alias("download"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("created"),
        (F.col("o_orderdate") < mk.ts_literal(SECOND_BATCH_FROM, _ntz())).alias("_first"))
    for first in (True, False):
        au.insert_requests(rows.filter(F.col("_first") == first).drop("_first"), requests, AUDIT_AS_OF)
    return spark.table(requests).select(
        "id", "task_id", "workflow", F.concat_ws(",", "db").alias("db"), "month", "year", "delta", "download",
        F.col("created").cast("timestamp_ntz").alias("created"))


@register("g13_rejected_requests", f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS k,
         row_number() OVER (PARTITION BY CASE WHEN l_linenumber <> 7 THEN l_orderkey END ORDER BY l_linenumber) AS n
  FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN k IS NULL THEN 'task_id is null' ELSE 'duplicate task_id' END AS reason
FROM r WHERE k IS NULL OR n > 1 OR k IN (SELECT o_orderkey FROM orders WHERE o_orderdate < {_NTZ} '{SECOND_BATCH_FROM}')""")
def g13_rejected_requests(spark, sf):
    """Requests of the early orders inserted, then one per line item: known, repeated and missing ids come back."""
    suffix = uuid.uuid4().hex[:12]
    requests, status = f"workflowrequests_{suffix}", f"taskstatus_{suffix}"
    au.create_tables(spark, scratch_path(spark, "rejects"), requests=requests, status=status)
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (
        ("workflow", "string"), ("db", "array<string>"), ("month", "int"), ("year", "int"), ("delta", "boolean"),
        ("download", "boolean"), ("created", "timestamp"))}
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    early = orders.filter(F.col("o_orderdate") < mk.ts_literal(SECOND_BATCH_FROM, _ntz()))
    au.insert_requests(early.select(F.col("o_orderkey").cast("string").alias("task_id"), *none.values()),
                       requests, AUDIT_AS_OF)
    again = items.select(F.when(F.col("l_linenumber") != 7, F.col("l_orderkey").cast("string")).alias("task_id"),
                         *none.values(), "l_orderkey", "l_linenumber")
    _, rejected = au.insert_requests(again, requests, AUDIT_AS_OF, ["l_linenumber"])
    return rejected.select("l_orderkey", "l_linenumber", "reason")


_LOG_STATUS_SQL = """CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN 'failed: ' || props
  WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'running' ELSE 'queued' END"""


@register("l3_task_status", f"""
WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS task_id, {_LOG_STATUS_SQL} AS status,
         CASE WHEN event_type = 'purchase' THEN props END AS file, NULL AS created, ts AS updated, event_id AS n
  FROM events WHERE user_id IN (SELECT c_custkey FROM customer)
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'queued', NULL, {_NTZ} '{AUDIT_AS_OF}', NULL, NULL FROM customer)
SELECT task_id,
  COALESCE(max_by(status, struct_pack(u := updated, n := n)) FILTER (status IS NOT NULL AND updated IS NOT NULL),
           'queued') AS status,
  CASE WHEN bool_or(file IS NOT NULL) THEN '{st.FILE_NOTE}' END AS file, max(created) AS created,
  max(updated) AS updated, count(*) AS n_updates
FROM log GROUP BY task_id""")
def l3_task_status(spark, sf):
    """L2/L3 through the tables: every customer a request, queued without ``updated``; every event logged
    as a partial status update (null = unchanged; those of unknown tasks rejected); then the current
    status per task, the blob replaced by a note."""
    suffix = uuid.uuid4().hex[:12]
    requests, status = f"workflowrequests_{suffix}", f"taskstatus_{suffix}"
    au.create_tables(spark, scratch_path(spark, "status"), requests=requests, status=status)
    asked = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("task_id"), F.lit("current").alias("workflow"),
        F.array(F.lit("influxdb")).alias("db"), *[F.lit(None).cast("int").alias(c) for c in ("month", "year")],
        *[F.lit(None).cast("boolean").alias(c) for c in ("delta", "download")],
        F.lit(None).cast("timestamp").alias("created"))
    written, _ = au.insert_requests(asked, requests, AUDIT_AS_OF)
    au.log_status(written.select("task_id", F.lit("queued").alias("status"),
                                 F.lit(str(AUDIT_AS_OF)).cast("timestamp").alias("created")), status, requests)
    ev = table(spark, sf, "events")
    et = F.col("event_type")
    text = (F.when(et == "view", F.lit(None).cast("string"))
            .when(et == "error", F.concat(F.lit("failed: "), F.col("props")))
            .when(et == "purchase", "completed").when(et == "click", "running").otherwise("queued"))
    au.log_status(ev.select(
        F.col("user_id").cast("string").alias("task_id"), text.alias("status"),
        F.when(et == "purchase", F.col("props").cast("binary")).alias("file"),
        F.col("ts").alias("updated"), "event_id"), status, requests, ["updated", "event_id"])
    cur = au.task_status(spark, status).select(
        "task_id", "status", "file", F.col("created").cast("timestamp_ntz").alias("created"),
        F.col("updated").cast("timestamp_ntz").alias("updated"), "n_updates")
    return _kept_without_tables(spark, cur, scratch_path(spark, "l3-result"), requests, status)


# --------------------------------------------------------------------------- H
@register("h1_infer_type", """
WITH lits AS (
  SELECT event_id, 'k' AS src, regexp_extract(props, '([0-9]+)', 1) AS literal FROM events
  UNION ALL SELECT event_id, 'v', format('{:,.2f}', value) FROM events
  UNION ALL SELECT event_id, 't', event_type FROM events),
typed AS (
  SELECT *, CASE WHEN literal IS NULL THEN NULL
    WHEN lower(literal) IN ('true', 'yes', 'y', '1', 'false', 'no', 'n', '0') THEN 'bool'
    WHEN regexp_full_match(literal, '[0-9]+') THEN 'int'
    WHEN regexp_full_match(literal, '([0-9]+[.][0-9]*|[.][0-9]+)') THEN 'float' ELSE 'str' END AS type
  FROM lits)
SELECT event_id, src, literal, type,
  CASE WHEN type = 'bool' THEN lower(literal) IN ('true', 'yes', 'y', '1') END AS as_bool,
  CASE WHEN type = 'int' THEN TRY_CAST(literal AS BIGINT) END AS as_int,
  CASE WHEN type = 'float' THEN TRY_CAST(literal AS DOUBLE) END AS as_float,
  CASE WHEN type = 'str' THEN literal END AS as_str
FROM typed""")
def h1_infer_type(spark, sf):
    ev = table(spark, sf, "events")
    lits = ev.select("event_id", F.regexp_extract("props", "([0-9]+)", 1).alias("k"),
                     F.format_number("value", 2).alias("v"), F.col("event_type").alias("t"))
    tall = lits.unpivot(["event_id"], ["k", "v", "t"], "src", "literal")
    return tall.select("event_id", "src", "literal", lit.infer_type("literal").alias("i")).select(
        "event_id", "src", "literal", "i.*")


@register("h2_month_grid", """
SELECT o_orderkey, quarter(o_orderdate) AS grid_row, ((month(o_orderdate) - 1) % 3) + 1 AS grid_col FROM orders""")
def h2_month_grid(spark, sf):
    row, col = cal.month_grid("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", row.alias("grid_row"), col.alias("grid_col"))


@register("h3_month_name_pt", """
SELECT o_orderkey,
  ['jan', 'fev', 'mar', 'abr', 'mai', 'jun', 'jul', 'ago', 'set', 'out', 'nov', 'dez'][month(o_orderdate)] || '.'
  AS month_name FROM orders""")
def h3_month_name_pt(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", cal.month_name_pt("o_orderdate").alias("month_name"))


YEARS_AS_OF = "2001-08-01"


@register("h4_years_back", """
SELECT o_orderkey, 2001 - year(o_orderdate) AS years_back FROM orders""")
def h4_years_back(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey",
                                             cal.years_back("o_orderdate", YEARS_AS_OF).alias("years_back"))


def _nested_config(spark, sf) -> DataFrame:
    """One nested settings document per event, with mixed-case keys."""
    ev = table(spark, sf, "events")
    return ev.select(
        "event_id",
        F.struct(F.col("user_id").alias("NIF"), F.col("event_type").alias("Pwd"),
                 st.cpe_code("user_id").alias("cpe")).alias("Portal"),
        F.struct(F.lit("http://localhost").alias("host"), F.col("event_id").alias("Port"),
                 F.concat(F.lit("bucket_"), F.col("user_id").cast("string")).alias("bucket")).alias("influxdb"))


_FLAT_SQL = """SELECT event_id, user_id AS "{a}nif", event_type AS "{a}pwd",
  'PT00' || lpad(CAST(user_id AS VARCHAR), 12, '0') || '04TW' AS "{a}cpe",
  'http://localhost' AS "{b}host", event_id AS "{b}port", 'bucket_' || user_id AS "{b}bucket" FROM events"""


@register("h5_flatten_columns", _FLAT_SQL.format(a="portal.", b="influxdb."))
def h5_flatten_columns(spark, sf):
    return stg.flatten_columns(_nested_config(spark, sf))


@register("h6_leaf_names", _FLAT_SQL.format(a="", b=""))
def h6_leaf_names(spark, sf):
    return stg.leaf_names(stg.flatten_columns(_nested_config(spark, sf)))


@register("h7_nest_columns", """
SELECT event_id,
  to_json(struct_pack(nif := user_id, pwd := event_type,
                      cpe := 'PT00' || lpad(CAST(user_id AS VARCHAR), 12, '0') || '04TW')) AS portal,
  to_json(struct_pack(host := 'http://localhost', port := event_id, bucket := 'bucket_' || user_id)) AS influxdb
FROM events""")
def h7_nest_columns(spark, sf):
    nested = stg.nest_columns(stg.flatten_columns(_nested_config(spark, sf)))
    return nested.select("event_id", F.to_json("portal").alias("portal"), F.to_json("influxdb").alias("influxdb"))


# Fixed mapping of update events to setting keys (two of them unknown keys).
_UPDATE_KEY_SQL = """CASE event_type WHEN 'click' THEN 'influxdb.port' WHEN 'view' THEN 'portal.cpe'
  WHEN 'error' THEN 'influxdb.tokn' WHEN 'purchase' THEN 'portal.nif' ELSE 'portal.pwd' END"""

_SETTINGS_SQL = f"""
settings AS (
  SELECT u.user_id, s.key, s.value FROM (SELECT DISTINCT user_id FROM events) u,
  LATERAL (VALUES ('portal.nif', CAST(u.user_id AS VARCHAR)),
                  ('portal.cpe', 'PT00' || lpad(CAST(u.user_id AS VARCHAR), 12, '0') || '04TW'),
                  ('influxdb.port', '8086')) AS s(key, value)),
last AS (
  SELECT user_id, {_UPDATE_KEY_SQL} AS key, max_by(regexp_extract(props, '([0-9]+)', 1), event_id) AS new
  FROM events GROUP BY 1, 2)"""

_TYPE_SQL = """CASE WHEN {v} IS NULL THEN NULL
    WHEN lower({v}) IN ('true', 'yes', 'y', '1', 'false', 'no', 'n', '0') THEN 'bool'
    WHEN regexp_full_match({v}, '[0-9]+') THEN 'int'
    WHEN regexp_full_match({v}, '([0-9]+[.][0-9]*|[.][0-9]+)') THEN 'float' ELSE 'str' END"""


def _settings_frames(spark, sf):
    ev = table(spark, sf, "events")
    uid = F.col("user_id").cast("string")
    settings = ev.select("user_id").distinct().select(
        "user_id", F.explode(F.array(
            F.struct(F.lit("portal.nif").alias("key"), uid.alias("value")),
            F.struct(F.lit("portal.cpe").alias("key"), st.cpe_code("user_id").alias("value")),
            F.struct(F.lit("influxdb.port").alias("key"), F.lit("8086").alias("value")))).alias("kv")
    ).select("user_id", "kv.key", "kv.value")
    et = F.col("event_type")
    key = (F.when(et == "click", "influxdb.port").when(et == "view", "portal.cpe")
           .when(et == "error", "influxdb.tokn").when(et == "purchase", "portal.nif").otherwise("portal.pwd"))
    updates = ev.select("user_id", key.alias("key"), F.regexp_extract("props", "([0-9]+)", 1).alias("value"),
                        F.col("event_id").alias("seq"))
    return stg.set_values(settings, updates, scope=["user_id"])


@register("h8_set_value", f"""
WITH {_SETTINGS_SQL}
SELECT s.user_id, s.key, COALESCE(l.new, s.value) AS value, l.new IS NOT NULL AS changed,
       {_TYPE_SQL.format(v="COALESCE(l.new, s.value)")} AS value_type
FROM settings s LEFT JOIN last l ON s.user_id = l.user_id AND s.key = l.key""")
def h8_set_value(spark, sf):
    return _settings_frames(spark, sf)[0]


@register("h8_unknown_keys", f"""
WITH {_SETTINGS_SQL}
SELECT l.user_id, l.key, l.new AS value FROM last l
WHERE NOT EXISTS (SELECT 1 FROM settings s WHERE s.user_id = l.user_id AND s.key = l.key)""")
def h8_unknown_keys(spark, sf):
    return _settings_frames(spark, sf)[1]


@register("h9_env_pairs", f"""
WITH {_SETTINGS_SQL}
SELECT s.user_id, upper(s.key) AS key, COALESCE(l.new, s.value) AS value
FROM settings s LEFT JOIN last l ON s.user_id = l.user_id AND s.key = l.key""")
def h9_env_pairs(spark, sf):
    merged = _settings_frames(spark, sf)[0].select("user_id", "key", "value")
    return stg.env_pairs(merged)


_DOC_SQL = """CASE event_type WHEN 'error' THEN '{"k": "' || regexp_extract(props, '([0-9]+)', 1) || '"}'
  WHEN 'signup' THEN '{"j": 1}' WHEN 'view' THEN 'not json' ELSE props END"""


def _documents(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    et = F.col("event_type")
    doc = (F.when(et == "error", F.concat(F.lit('{"k": "'), F.regexp_extract("props", "([0-9]+)", 1), F.lit('"}')))
           .when(et == "signup", F.lit('{"j": 1}')).when(et == "view", F.lit("not json"))
           .otherwise(F.col("props")))
    return ev.select("event_id", doc.alias("doc"))


_K_SCHEMA = "k INT"


@register("h10_schema_check", f"""
SELECT event_id,
  CASE WHEN NOT json_valid(doc) OR json_type(doc) <> 'OBJECT' THEN 'malformed'
       WHEN len(list_filter(json_keys(doc), lambda x: x <> 'k')) > 0
         THEN 'undeclared: ' || list_sort(list_filter(json_keys(doc), lambda x: x <> 'k'))[1]
       WHEN json_extract(doc, '$.k') IS NULL THEN 'missing: k'
       WHEN json_type(doc, '$.k') NOT IN ('UBIGINT', 'BIGINT') THEN 'type: k' END AS violation
FROM (SELECT event_id, {_DOC_SQL} AS doc FROM events)""")
def h10_schema_check(spark, sf):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(_K_SCHEMA)
    return stg.schema_violations(_documents(spark, sf), "doc", schema, require_all=True).drop("doc")


@register("h11_parse_document", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def h11_parse_document(spark, sf):
    from pyspark.sql.types import StructType
    good, _ = stg.parse_document(table(spark, sf, "events").select("event_id", "props"), "props",
                                 StructType.fromDDL(_K_SCHEMA), require_all=True)
    return good


# --------------------------------------------------------------------------- I


# Events land in parts, in the order of time; each start of the stream takes what has landed since.
LANDINGS = ("2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-23 00:00:00", None)


def _landed(spark, sf, base: str):
    """Lands the events part by part: for each, a stream over all that has landed."""
    ev = table(spark, sf, "events")
    low = None
    for n, high in enumerate(LANDINGS):
        part = ev.filter(F.col("ts") >= mk.ts_literal(low, _ntz())) if low else ev
        (part.filter(F.col("ts") < mk.ts_literal(high, _ntz())) if high else part).write.parquet(f"{base}/landing/part{n}")
        low = high
        files = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{base}/landing"))
        yield files.select(F.col("user_id").cast("string").alias("cpe"), F.col("ts").alias("date_time"),
                           F.col("value").alias("consumption"), F.col("event_id").alias("seq"),
                           F.col("_metadata.file_path").alias("file"),
                           F.unix_micros(F.col("_metadata.file_modification_time")).alias("file_seq"))


def _stored_marks(spark, sf) -> DataFrame:
    return mk.marks(stored_points(spark, sf))


_DELTA_POINTS_SQL = f"""
WITH {_STORED_SQL}
SELECT 'kW' AS measurement, CAST(e.user_id AS VARCHAR) AS cpe, 'consumption' AS field, e.value AS value,
       date_trunc('second', e.ts) AS time
FROM events e LEFT JOIN marks m ON CAST(e.user_id AS VARCHAR) = m.cpe
WHERE date_trunc('second', e.ts) > COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00')
QUALIFY row_number() OVER (PARTITION BY e.user_id, date_trunc('second', e.ts) ORDER BY e.event_id DESC) = 1"""


@register("i1_stream_load", _DELTA_POINTS_SQL)
def i1_stream_load(spark, sf):
    """Four batches into one point store, the stream started anew from its checkpoint for each; the store read back."""
    base = scratch_path(spark, "stream-load")
    for stream in _landed(spark, sf, base):
        # "row" tells points of one key apart inside a file
        rows = stream.withColumnRenamed("seq", "row")
        sl.stream_load(spark, rows, f"{base}/store", f"{base}/checkpoint", parse=lambda b: b,
                       seed_marks=_stored_marks(spark, sf), compact_every=2).awaitTermination()
    return ld.read_store(spark, f"{base}/store").select("measurement", "cpe", "field", "value", "time")


@register("i2_stream_delta_state", f"""
WITH {_STORED_SQL}
SELECT CAST(e.user_id AS VARCHAR) AS cpe, e.ts AS date_time, e.value AS consumption, e.event_id AS seq
FROM events e LEFT JOIN marks m ON CAST(e.user_id AS VARCHAR) = m.cpe
WHERE e.ts > COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00')
QUALIFY row_number() OVER (PARTITION BY e.user_id, e.ts ORDER BY e.event_id DESC) = 1""")
def i2_stream_delta_state(spark, sf):
    """Four batches, the stream started anew from its checkpoint for each; one reading of a meter and time."""
    base = scratch_path(spark, "stream-delta")
    for stream in _landed(spark, sf, base):
        ds.stream_delta(stream.select("cpe", "date_time", "consumption", "seq"), f"{base}/out", f"{base}/marks",
                        f"{base}/checkpoint", seed_marks=_stored_marks(spark, sf), order="seq").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("cpe", "date_time", "consumption", "seq")


# --------------------------------------------------------------------------- A1, A2

_LANDING_CPE = r"/landing/([^/]+)/"


def a1_sql(part_rows: int = wx.PART_ROWS) -> str:
    """The A1 oracle for a given part size (tests force splitting with a small one)."""
    return f"""
WITH sized AS (
  SELECT *, count(*) OVER (PARTITION BY user_id, year(ts), month(ts)) AS n FROM events),
parted AS (
  SELECT *, ((event_id % 2147483647) * 48271 % 2147483647) % CAST(ceil(n / {part_rows}) AS BIGINT) AS part
  FROM sized)
SELECT 'PT00' || lpad(CAST(user_id AS VARCHAR), 12, '0') || '04TW' AS cpe,
       date_trunc('minute', ts) AS date_time, value AS consumption,
       '/landing/PT00' || lpad(CAST(user_id AS VARCHAR), 12, '0') || '04TW/'
         || 'part-' || part || '/'
         || year(ts) || '_' || month(ts) || '_' || lpad(lower(hex(user_id)), 8, '0') || '_readings.xlsx' AS file,
       CAST(8 + row_number() OVER (PARTITION BY user_id, year(ts), month(ts), part ORDER BY ts, event_id)
            AS INTEGER) AS row
FROM parted"""


def a1_workbooks(spark, sf, part_rows: int = wx.PART_ROWS):
    """One workbook per meter-month rendered from events (in Spark), decoded and parsed back.

    A meter-month is written as part workbooks (``<meter>/part-<k>/``) of about
    ``part_rows`` readings, each within one worksheet."""
    blobs = _event_workbooks(spark, sf, part_rows=part_rows)
    readings, _bad = rd.parse_readings(wb.decode_workbooks(blobs), F.regexp_extract("file", _LANDING_CPE, 1))
    return readings


def _event_workbooks(spark, sf, cond=None, part_rows: int = wx.PART_ROWS) -> DataFrame:
    """Events rendered (in Spark) as one readings workbook per meter-month: ``path, content``."""
    ev = table(spark, sf, "events")
    if cond is not None:
        ev = ev.filter(cond)
    cpe = st.cpe_code("user_id")
    file = F.concat(F.lit("/landing/"), cpe, F.lit("/"), wb.provenance_name(
        F.year("ts"), F.month("ts"), F.lpad(F.lower(F.hex("user_id")), 8, "0")))
    rows = ev.select(file.alias("file"), "ts", "event_id", F.date_format("ts", "yyyy/MM/dd").alias("date"),
                     F.date_format("ts", "HH:mm").alias("time"), F.col("value").alias("consumption"),
                     F.col("event_type").alias("state"))
    return wx.export_workbooks(rows, "file", order=["ts", "event_id"], extra_col="state",
                               split_key="event_id", part_rows=part_rows)


def _damaged_workbooks(spark) -> DataFrame:
    """Files that can't be read: no archive, one cut short, a number format without an id, a cell beyond the last column."""
    whole = wx.workbook_bytes([["a", 1.0]])

    def changed(name: str, old: bytes, new: bytes) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(io.BytesIO(whole)) as a, zipfile.ZipFile(out, "w") as z:
            for part in a.namelist():
                z.writestr(part, a.read(part).replace(old, new) if part == name else a.read(part))
        return out.getvalue()

    files = {"cut": whole[:len(whole) // 2], "format": changed("xl/styles.xml", b"<cellXfs", b'<numFmts><numFmt formatCode="x"/></numFmts><cellXfs'),
             "text": b"date,time,value", "wide": changed("xl/worksheets/sheet1.xml", b'r="B1"', b'r="ZZZZZ1"')}
    return spark.createDataFrame([(f"/landing/damaged/{k}.xlsx", v) for k, v in files.items()], "path string, content binary")


@register("a1_read_workbooks", f"""
SELECT * FROM ({a1_sql()})
UNION ALL
SELECT NULL, NULL, NULL, '/landing/damaged/' || name || '.xlsx', -1
FROM (VALUES ('cut'), ('format'), ('text'), ('wide')) AS t(name)""")
def a1_read_workbooks(spark, sf):
    """The readings of all workbooks and, without a meter, a row for each file that can't be read."""
    blobs = _event_workbooks(spark, sf).unionByName(_damaged_workbooks(spark))
    good, bad = rd.parse_readings(wb.decode_workbooks(blobs), F.regexp_extract("file", _LANDING_CPE, 1))
    unread = bad.select(F.lit(None).cast("string").alias("cpe"), F.lit(None).cast(good.schema["date_time"].dataType).alias("date_time"),
                        F.lit(None).cast("double").alias("consumption"), "file", "row")
    return good.unionByName(unread)


@register("a2_file_blobs", """
SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS name, octet_length(encode(text || chr(10))) AS length,
       sha256(encode(text || chr(10))) AS sha256 FROM documents""")
def a2_file_blobs(spark, sf):
    """Every document written as a file of its own, the files read back as bytes."""
    base = scratch_path(spark, "a2-files")
    docs = table(spark, sf, "documents")
    wb.write_files(docs.select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("name"), "text"), base)

    def digests(blobs):
        return blobs.select(F.regexp_extract("path", r"[/=]([0-9]+)\.txt(/[^/]*)?$", 1).alias("name"), "length",
                            F.sha2("content", 256).alias("sha256"))

    return wb.grouped_blobs(spark, base, digests, wb.WRITTEN_FILES)


# --------------------------------------------------------------------------- L1
LOAD_YEAR, LOAD_MONTH, LOAD_AS_OF = 2024, 1, "2024-02-01 00:00:00"

_CPE_SQL = "'PT00' || lpad(CAST(user_id AS VARCHAR), 12, '0') || '04TW'"


@register("l1_run_load", f"""
WITH r AS (
  SELECT {_CPE_SQL} AS cpe, date_trunc('minute', ts) AS time, value, ts, event_id FROM events
  WHERE ts >= {_NTZ} '2024-01-01' AND ts < {_NTZ} '2024-02-01'),
first AS (SELECT cpe, time, value FROM r WHERE ts < {_NTZ} '{STORE_CUTOFF}'
  QUALIFY row_number() OVER (PARTITION BY cpe, time ORDER BY ts DESC, event_id DESC) = 1),
marks AS (SELECT cpe, max(time) AS mark FROM first WHERE time >= {_NTZ} '1989-05-11 01:10:00' GROUP BY cpe)
SELECT 'kW' AS measurement, cpe, 'consumption' AS field, value, time FROM first
UNION ALL
SELECT 'kW', r.cpe, 'consumption', r.value, r.time
FROM r LEFT JOIN marks m ON r.cpe = m.cpe
WHERE r.time > COALESCE(m.mark, {_NTZ} '1989-05-11 00:00:00')
QUALIFY row_number() OVER (PARTITION BY r.cpe, r.time ORDER BY r.ts DESC, r.event_id DESC) = 1""")
def l1_run_load(spark, sf):
    """The load lifecycle twice on workbooks rendered from events: the workbooks of the
    first half of the month, then all of them, both as delta loads of January 2024 into
    one point store (the second load adds only readings newer than each meter's mark)."""
    from meterlake.plans.workflows import run_load
    store = scratch_path(spark, "l1-store")
    early = F.col("ts") < mk.ts_literal(STORE_CUTOFF, _ntz())
    for i, blobs in enumerate((_event_workbooks(spark, sf, early), _event_workbooks(spark, sf))):
        run_load(spark, blobs, "select", ["parquet", "", "influxdb"], {"parquet": store}, as_of=LOAD_AS_OF,
                 year=LOAD_YEAR, month=LOAD_MONTH, delta=True, load_seq=i + 1,
                 cpe=F.regexp_extract("file", _LANDING_CPE, 1))
    return ld.read_store(spark, store).select("measurement", "cpe", "field", "value", "time")


# --------------------------------------------------------------------------- L2
@register("l2_run_requests", f"""
SELECT 'r1' AS task_id, 'completed' AS state, NULL AS message,
       (SELECT count(DISTINCT (user_id, date_trunc('minute', ts))) FROM events
        WHERE ts >= {_NTZ} '2024-01-01' AND ts < {_NTZ} '2024-02-01') AS points
UNION ALL SELECT 'r2', 'failed', 'influxdb unsupported', 0
UNION ALL SELECT 'r3', 'rejected', 'unsupported workflow', 0""")
def l2_run_requests(spark, sf):
    """Three requests from the table to their end: one loads the workbooks, one names only an unknown
    store, one is turned away before it is queued; the status table read back."""
    from meterlake.plans.workflows import run_requests

    base, suffix = scratch_path(spark, "l2"), uuid.uuid4().hex[:12]
    requests, status = f"workflowrequests_{suffix}", f"taskstatus_{suffix}"
    au.create_tables(spark, base, requests=requests, status=status)
    asked = spark.createDataFrame(
        [("r1", "select", ["parquet"], 1, 2024), ("r2", "select", ["influxdb"], 1, 2024), ("r3", "weekly", ["parquet"], 1, 2024)],
        "task_id string, workflow string, db array<string>, month int, year int").selectExpr(
        "*", "false AS delta", "false AS download", "cast(null AS timestamp) AS created")
    checked = au.check_requests(asked, as_of=LOAD_AS_OF)
    turned_away = checked.filter(F.col("reject_reason").isNotNull()).select(
        "task_id", F.lit("rejected").alias("state"), F.col("reject_reason").alias("message"), F.lit(0).cast("long").alias("points"))
    good = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    written, _ = au.insert_requests(good, requests, LOAD_AS_OF)
    au.log_status(written.select("task_id", F.lit("queued").alias("status"),
                                 F.lit(LOAD_AS_OF).cast("timestamp").alias("created")), status, requests)
    landed = materialize(_event_workbooks(spark, sf))       # every request reads the same workbooks
    run_requests(spark, requests, status, lambda request: landed, {"parquet": f"{base}/store"},
                 as_of=LOAD_AS_OF, cpe=F.regexp_extract("file", _LANDING_CPE, 1))
    points = ld.read_store(spark, f"{base}/store").groupBy(F.lit("r1").alias("task_id")).agg(F.count(F.lit(1)).alias("points"))
    done = au.task_status(spark, status).select("task_id", st.status_state("status").alias("state"), st.status_message("status").alias("message"))
    out = done.join(points, "task_id", "left").withColumn("points", F.coalesce("points", F.lit(0))).unionByName(turned_away)
    return _kept_without_tables(spark, out, f"{base}/result", requests, status)


def _kept_without_tables(spark, out: DataFrame, path: str, *tables: str) -> DataFrame:
    """Write a result and drop the catalog tables that it came from."""
    out.write.parquet(path)
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(out.schema).parquet(path)
