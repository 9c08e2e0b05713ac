"""Request and status audit tables.

``workflowrequests`` and ``taskstatus`` are ordinary catalog tables; updates
are kept as an append-only log and folded by the log's sequence ``seq``, which
is how a partial ``UPDATE`` is expressed without rewriting rows in place. The
reference's constraints (a request's ``task_id`` unique and given, a status'
``task_id`` that of a request) are checked on write: rows that break one are
returned with the reason, not written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.functions.calendar import WORKFLOWS, month_start_col
from meterlake.plans.joins import lookup_join, materialize

REQUESTS_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  id BIGINT, task_id STRING, workflow STRING, db ARRAY<STRING>, month INT, year INT,
  delta BOOLEAN, download BOOLEAN, created TIMESTAMP
) USING parquet"""

STATUS_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  task_id STRING, status STRING, file BINARY, created TIMESTAMP, updated TIMESTAMP, seq BIGINT
) USING parquet"""


def create_tables(spark: SparkSession, location: str | None = None,
                  requests: str = "workflowrequests", status: str = "taskstatus") -> bool:
    """Create both tables if absent, then confirm they exist."""
    for name, ddl in ((requests, REQUESTS_DDL), (status, STATUS_DDL)):
        sql = ddl.format(name=name)
        if location:
            sql += f" LOCATION '{location.rstrip('/')}/{name}'"
        spark.sql(sql)
    ok = spark.catalog.tableExists(requests) and spark.catalog.tableExists(status)
    if not ok:
        raise RuntimeError("audit table initialisation failed")
    return ok


def apply_defaults(records: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """G1: a null field means "not given", so the column default applies."""
    return records.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def audit_insert(records: DataFrame, as_of, created: str = "created") -> DataFrame:
    """G1: rows as inserted, ``created`` defaulting to ``as_of`` (the insert time)."""
    kind = records.schema[created].dataType.simpleString()
    return apply_defaults(records, {created: F.lit(str(as_of)).cast(kind)})


def insert_requests(records: DataFrame, table: str, as_of, order_by: Sequence[str] = ("created", "task_id"),
                    created: str = "created") -> tuple[DataFrame, DataFrame]:
    """G1 + G5 into a G13 table: default ``created``, number new rows after the
    table's current largest ``id`` (the sequence), append. Returns (written, rejected).

    A row without a ``task_id``, or with one that the table has or that an
    earlier row (by ``order_by``) brings, is rejected with a ``reason``. The
    current largest id is one hash aggregate over the ``id`` column only.
    """
    spark = records.sparkSession
    rows = audit_insert(records, as_of, created)
    given = rows.filter(F.col("task_id").isNotNull())
    known = spark.table(table).select("task_id", F.lit(True).alias("_known")).distinct()
    first = Window.partitionBy("task_id").orderBy(*[F.col(c) for c in order_by])
    ranked = materialize(lookup_join(given.withColumn("_n", F.row_number().over(first)), known, "task_id", "left"))
    reason = F.when(F.col("_known") | (F.col("_n") > 1), F.lit("duplicate task_id"))
    checked = ranked.withColumn("reason", reason).drop("_n", "_known")
    rejected = checked.filter(F.col("reason").isNotNull()).unionByName(
        rows.filter(F.col("task_id").isNull()).withColumn("reason", F.lit("task_id is null")))
    last = spark.table(table).agg(F.max("id")).first()[0] or 0
    numbered = surrogate_id(checked.filter(F.col("reason").isNull()).drop("reason"), list(order_by),
                            name="id", start=int(last) + 1)
    out = numbered.select(*[F.col(c) for c in spark.table(table).columns])
    out.write.insertInto(table)
    return out, rejected


def log_status(updates: DataFrame, table: str, requests: str,
               order_by: Sequence[str] = ("updated", "created", "task_id")) -> tuple[DataFrame, DataFrame]:
    """L2: append status changes (``task_id, status, file, created, updated``; nulls
    mean "unchanged") to the G13 status table, used as an append-only log. Returns
    (written, rejected): changes of tasks that the table ``requests`` does not have
    are rejected with a ``reason``.

    The log's ``seq`` continues after its largest; inside one call changes are
    numbered by ``order_by`` (nulls first, so a queued row without ``updated``
    comes before its task's updates).
    """
    spark = updates.sparkSession
    fields = [f for f in spark.table(table).schema.fields if f.name != "seq"]
    extra = [c for c in order_by if c not in [f.name for f in fields]]
    typed = updates.select(*[(F.col(f.name) if f.name in updates.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in fields], *extra)
    known = spark.table(requests).select("task_id", F.lit(True).alias("_known")).distinct()
    checked = materialize(lookup_join(typed, known, "task_id", "left"))
    rejected = checked.filter(F.col("_known").isNull()).drop("_known").withColumn("reason", F.lit("unknown task_id"))
    last = spark.table(table).agg(F.max("seq")).first()[0] or 0
    out = surrogate_id(checked.filter(F.col("_known")).drop("_known"), list(order_by), name="seq", start=int(last) + 1)
    out = out.select(*[F.col(c) for c in spark.table(table).columns])
    out.write.insertInto(table)
    return out, rejected


def task_status(spark: SparkSession, table: str, ids: DataFrame | None = None,
                with_file: bool = False) -> DataFrame:
    """L3: current status per task folded from the log (G2), optionally for given
    ids (G3; only their log rows are folded). Without ``with_file`` the blob column
    is replaced by a note (G9), and only its null-ness is read."""
    log = spark.table(table)
    if ids is not None:
        log = lookup_join(log, ids.select("task_id").distinct(), "task_id", "left_semi")
    # null when the update carries no file ("unchanged"), so the fold keeps an earlier file
    has_file = F.when(F.col("file").isNotNull(), F.lit(True))
    folded = fold_updates(log.select("task_id", "status", has_file.alias("_has_file"),
                                     *(["file"] if with_file else []), "created", "updated", "seq"),
                          "task_id", "seq",
                          ["status", "_has_file", *(["file"] if with_file else []), "created", "updated"])
    if not with_file:
        from meterlake.functions.status import FILE_NOTE
        folded = folded.withColumn("file", F.when(F.col("_has_file"), F.lit(FILE_NOTE)))
    folded = folded.drop("_has_file")
    # one row per known id at most: an unknown id gives a row of nulls
    return ids.select("task_id").join(folded, "task_id", "left") if ids is not None else folded


def run_task(spark: SparkSession, task_id: str, requests: str, status: str, work, now=None):
    """One request's lifecycle: running, then completed with the file or ``failed: <message>``.

    ``work()`` does the load and returns the file's bytes (or None). The request
    must be in ``requests``. Returns what ``work`` returned; its exception is
    logged as the task's status and raised again. ``now()`` gives the times.
    """
    import datetime as dt

    clock = now or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    schema = "task_id string, status string, file binary, updated timestamp"

    def log(text: str, file: bytes | None = None) -> None:
        row = spark.createDataFrame([(task_id, text, file, clock())], schema)
        _, rejected = log_status(row, status, requests)
        if not rejected.isEmpty():
            raise ValueError(f"no request {task_id}")

    log("running")
    try:
        file = work()
    except Exception as e:
        log(f"failed: {e}")
        raise
    log("completed", file)
    return file


def fold_updates(log: DataFrame, key: str = "task_id", seq: str = "updated",
                 columns: Sequence[str] | None = None, tiebreak: str | None = None) -> DataFrame:
    """Partial updates folded per key: each column keeps its last non-null value.
    A null ``seq`` comes before any other.

    ``max_by(col, when(col is not null, order))`` ignores null updates; one hash
    aggregate with partial aggregation, so a hot task is pre-reduced map-side.
    """
    order = F.struct(F.col(seq), F.col(tiebreak)) if tiebreak else F.struct(F.col(seq))
    cols = [c for c in (columns or log.columns) if c not in (key, tiebreak)]
    return log.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols],
        F.count(F.lit(1)).alias("n_updates"))


def status_lookup(status: DataFrame, ids: DataFrame, key: str = "task_id") -> DataFrame:
    """Status for many ids; an unknown id gives a row of nulls, not an error."""
    return lookup_join(ids.select(key), status, key, "left")


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose reference has no parent (a foreign-key check)."""
    pk = parent_key or key
    p = parents.select(F.col(pk).alias(key)).distinct()
    return children.join(p, key, "left_anti")


def surrogate_id(df: DataFrame, order_by: Sequence[str], name: str = "id", start: int = 1) -> DataFrame:
    """Dense increasing ids in ``order_by`` order, without a single-partition window.

    The frame is range-sorted and checkpointed (both passes see identical
    partitions; lineage cut), per-partition counts (one row per partition) give
    offsets, and each row adds its position inside its partition.
    """
    # a unique last sort key lets the range partitioner split a hot order key
    ordered = materialize(df.withColumn("_uniq", F.monotonically_increasing_id())
                          .orderBy(*order_by, "_uniq").drop("_uniq"))
    tagged = ordered.withColumns({"_pid": F.spark_partition_id(),
                                  "_pos": F.monotonically_increasing_id()})
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    out = lookup_join(tagged, offsets, "_pid", "inner")
    pos = F.col("_pos") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (out.withColumn(name, F.lit(start) + F.coalesce(F.col("_off"), F.lit(0)) + pos)
            .drop("_pid", "_pos", "_off"))


def param_query(spark: SparkSession, sql: str, args: dict | list | None = None, **frames) -> DataFrame:
    """SQL with bound parameters (``:name`` or ``?``); frames are referenced as ``{name}``."""
    return spark.sql(sql, args=args, **frames)


def reject_reason(workflow="workflow", month="month", year="year", as_of=None) -> Column:
    """Why a request cannot run (null when it can)."""
    w, m, y = F.col(workflow), F.col(month), F.col(year)
    reason = (F.when(~w.isin(*WORKFLOWS) | w.isNull(), F.lit("unsupported workflow"))
              .when((w == "select") & (m.isNull() | y.isNull()), F.lit("select needs month and year"))
              .when((w == "select") & ((m < 1) | (m > 12)), F.lit("invalid month")))
    if as_of is not None:
        first = month_start_col(y, m)
        reason = reason.when((w == "select") & (first > F.lit(str(as_of)).cast("timestamp_ntz")),
                             F.lit("future"))
    return reason


def check_requests(requests: DataFrame, as_of=None) -> DataFrame:
    """Requests with a ``reject_reason`` column."""
    return requests.withColumn("reject_reason", reject_reason(as_of=as_of))


def order_sessions(sessions: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Sessions equal on every field collapse to one; ordered by time.

    The other fields follow as tie-breakers: equal times get a deterministic
    order, and the range partitioner can split a time shared by many sessions
    (rows left after ``dropDuplicates`` differ in some field).
    """
    rest = [f.name for f in sessions.schema.fields
            if f.name != ts and "map<" not in f.dataType.simpleString()]   # maps are not orderable
    return sessions.dropDuplicates().orderBy(ts, *rest)
