"""The load lifecycle as one call: request -> period -> parse -> load -> retain -> session.

``run_load`` is what a user of the reference runs as a workflow, for many
meters and many files at once. Every step is a Spark job from the operators;
the driver handles only the request arguments, the handful of store names and
one directory move.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.calendar import period_bounds
from meterlake.operators.audit import run_task, task_status
from meterlake.operators.load import claim_source, fan_out, folder_exists, release_source, retain_folder, write_delta, write_full
from meterlake.operators.readings import parse_readings
from meterlake.operators.reshape import to_points
from meterlake.plans.joins import lookup_join, materialize
from meterlake.session import ship_package
from meterlake.sources.workbooks import decode_workbooks, read_workbooks

SESSION_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("workflow", T.StringType()),
    T.StructField("databases", T.ArrayType(T.StringType())),
    T.StructField("source_data", T.StringType()),
    T.StructField("staging_area", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# The meter code is the name of the folder a workbook sits in: landing/<cpe>/<file>.xlsx
CPE_FROM_PATH = r"/([^/]+)/[^/]+$"


def run_load(spark: SparkSession, landing: str | DataFrame, workflow: str, db: Sequence[str | None],
             stores: dict[str, str], as_of=None, year: int | None = None, month: int | None = None,
             delta: bool = False, keep: bool = False, output: str | None = None,
             cpe: str | Column | None = None, load_seq: int | None = None,
             session_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load the workbooks under ``landing`` into each requested store.

    ``workflow`` is ``current`` / ``previous`` (relative to ``as_of``) or
    ``select`` (``year`` and ``month``); readings outside that month are not
    loaded. ``db`` names the stores (keys of ``stores`` -> point-store paths);
    empty names are ignored, unknown ones reported. ``delta`` loads only
    readings newer than each meter's mark, else a full idempotent reload.
    The landing folder is claimed first, by one rename, so files that arrive during
    the run are left to the next one. ``keep`` moves the claimed folder to
    ``output/<session_id>``. Otherwise files are deleted only if every named store
    loaded, and only those of which all rows were loaded: a file that could not be
    read, or has quarantined rows or rows outside the month, goes back to its place,
    as does everything if the run fails. ``landing`` may also be a DataFrame of
    workbook blobs (``path, content``, e.g. from a ``binaryFile`` read); there is no
    folder to retain then.

    The session's status is ``completed`` if a named store loaded (unknown names are
    reported and skipped), else ``failed:`` with what became of each.

    Returns (session record, per-store report, quarantined rows).
    """
    ship_package(spark)
    start, end = period_bounds(workflow, as_of, year, month)   # rejects bad requests up front
    if start > dt.datetime.fromisoformat(str(as_of or dt.datetime.now().isoformat())[:19]):
        raise ValueError("the requested month is in the future")
    sid = session_id or uuid.uuid4().hex
    seq = load_seq if load_seq is not None else int(dt.datetime.now().timestamp() * 1_000_000)
    if keep and not output:
        raise ValueError("keep=True needs an output folder")
    from_folder = isinstance(landing, str)
    claimed = claim_source(spark, landing) if from_folder else None
    if from_folder and claimed is None:
        raise FileNotFoundError(f"no files in {landing}")
    try:
        # decoded once and checkpointed: the load and the quarantine both read it, and it
        # outlives the claimed folder (moved or deleted below)
        raw = materialize(read_workbooks(spark, claimed) if from_folder else decode_workbooks(landing))
        parsed, bad = parse_readings(raw, cpe if cpe is not None else F.regexp_extract("file", CPE_FROM_PATH, 1))
        inside = ((F.col("date_time") >= F.lit(str(start)).cast("timestamp_ntz"))
                  & (F.col("date_time") < F.lit(str(end)).cast("timestamp_ntz")))
        readings = parsed.filter(inside)

        def writer(path: str):
            # points of one key within the load: the later sheet row wins
            rows = [F.col("cpe"), F.col("date_time"), F.col("consumption"), F.struct("file", "row").alias("_order")]
            if delta:
                return lambda df: write_delta(df.select(*rows), path, seq, order="_order", as_of=as_of)
            return lambda df: write_full(to_points(df.select(*rows), tags=("cpe", "_order")), path, seq,
                                         order="_order", as_of=as_of)

        report = fan_out(readings, list(db), {name: writer(path) for name, path in stores.items()})
        named = [r for r in report.collect() if r["status"] != "ignored"]   # one row per named store
        missed = [f"{r['target']} {r['status']}" for r in named if r["status"] != "loaded"]
        kept = None
        if from_folder and keep:
            kept = f"{output.rstrip('/')}/{sid}"
            retain_folder(spark, claimed, True, kept)
        elif from_folder and named and not missed:
            flawed = bad.select("file").union(parsed.filter(~inside).select("file")).distinct()
            retain_folder(spark, claimed, False, spare=(r["file"] for r in flawed.toLocalIterator()), landing=landing)
        elif from_folder:
            release_source(spark, claimed, landing)
    except Exception:
        if claimed is not None and folder_exists(spark, claimed):
            release_source(spark, claimed, landing)
        raise
    session = spark.createDataFrame([(sid, workflow, [d for d in db if d], kept,
                                      kept.rsplit("/", 1)[0] if kept else None,
                                      "completed" if len(missed) < len(named) else f"failed: {', '.join(missed) or 'no store named'}",
                                      dt.datetime.now(dt.timezone.utc))], SESSION_SCHEMA)
    return session, report, bad


def run_requests(spark: SparkSession, requests: str, status: str, landing, stores: dict[str, str], as_of=None,
                 **options) -> int:
    """L2: run the queued requests of the table ``requests`` one after another, by their id; returns how many ran.

    Each becomes ``running``, is loaded by ``run_load`` (``landing`` gives the folder or the blobs for a
    request's row; ``options`` are passed on), then ``completed`` or ``failed: <message>`` in the log
    ``status``. A request that fails does not stop the next.
    """
    queued = task_status(spark, status).filter(F.col("status") == "queued").select("task_id")
    todo = materialize(lookup_join(spark.table(requests), queued, "task_id", "left_semi")).orderBy("id")
    n = 0
    for r in todo.toLocalIterator():
        def work(r=r):
            session, _, _ = run_load(spark, landing(r), r["workflow"], r["db"], stores, as_of=as_of, year=r["year"],
                                     month=r["month"], delta=bool(r["delta"]), **options)
            text = session.first()["status"]
            if text.startswith("failed"):
                raise RuntimeError(text.removeprefix("failed: "))

        n += 1
        try:
            run_task(spark, r["task_id"], requests, status, work)
        except Exception as e:       # it is the request's status now
            logging.getLogger(__name__).warning("request %s failed: %s", r["task_id"], e)
    return n
