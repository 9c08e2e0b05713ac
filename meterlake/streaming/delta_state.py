"""The delta rule on a stream, with each meter's mark as the only state.

Every micro-batch (``foreachBatch``):

1. takes the per-meter marks as they stood before the batch: the latest full
   snapshot and the increments written since;
2. keeps the readings strictly later than their meter's mark, through a lookup
   whose size is measured -- under the limit it is broadcast and no reading is
   shuffled for it, above it the join's skewed partitions are split;
3. keeps one reading per meter and time and writes them into the batch's own folder;
4. writes its marks: the largest time of each meter it emitted, a maximum that every
   task forms for itself before the shuffle.

No step gathers a meter's readings in one task, so a meter that sends half of
all readings is spread like any other. A replayed batch reads the same marks and
overwrites the same folders. Marks already in a store come in as ``seed_marks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.load import keep_latest
from meterlake.operators.marks import ts_literal
from meterlake.plans.joins import lookup_join, materialize
from meterlake.session import SENTINEL_MARK

MARKS_SCHEMA = T.StructType([T.StructField("cpe", T.StringType()),
                             T.StructField("last_insert", T.TimestampNTZType())])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _batch_ids(spark: SparkSession, folder: str) -> list[int]:
    """``batch_id=<b>`` sub-folders of ``folder`` (names only, no data read)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith("batch_id="))


def _mark_parts(spark: SparkSession, marks_path: str, batch_id: int) -> tuple[int | None, list[int]]:
    """The latest full snapshot below ``batch_id`` and the increments after it."""
    full = max((b for b in _batch_ids(spark, f"{marks_path}/kind=full") if b < batch_id), default=None)
    incs = [b for b in _batch_ids(spark, f"{marks_path}/kind=inc") if b < batch_id and (full is None or b > full)]
    return full, incs


def _prune_marks(spark: SparkSession, marks_path: str, full: int) -> None:
    """Drop what no replay of the current batch reads: full snapshots before ``full``
    and increments it already covers."""
    for kind, keep in (("full", lambda b: b >= full), ("inc", lambda b: b > full)):
        fs, _ = _fs(spark, marks_path)
        for b in _batch_ids(spark, f"{marks_path}/kind={kind}"):
            if not keep(b):
                fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                    f"{marks_path}/kind={kind}/batch_id={b}"), True)


def marks_before(spark: SparkSession, marks_path: str, batch_id: int,
                 seed_marks: DataFrame | None = None) -> tuple[DataFrame, int | None]:
    """(the mark of each meter before a batch, the full snapshot that it starts from)."""
    full, incs = _mark_parts(spark, marks_path, batch_id)
    folders = ([f"{marks_path}/kind=full/batch_id={full}"] if full is not None else []) + [
        f"{marks_path}/kind=inc/batch_id={b}" for b in incs]
    parts = [spark.read.schema(MARKS_SCHEMA).parquet(*folders)] if folders else []
    if full is None and seed_marks is not None:
        parts.append(seed_marks.select("cpe", "last_insert"))
    every = parts[0] if parts else spark.createDataFrame([], MARKS_SCHEMA)
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("cpe").agg(F.max("last_insert").alias("last_insert")), full


def delta_batch(readings: DataFrame, batch_id: int, out_path: str, marks_path: str,
                seed_marks: DataFrame | None = None, order: str | None = None, full_every: int = 16) -> None:
    """One micro-batch of I2: the new readings into ``out_path/batch_id=<b>``, the marks after it into ``marks_path``.

    Of readings of one meter and time the one with the largest ``order`` (default:
    ``consumption``) stays. A full snapshot of the marks is written every
    ``full_every`` batches, else only those of the meters that the batch touched.
    """
    spark = readings.sparkSession
    before, full = marks_before(spark, marks_path, batch_id, seed_marks)
    before = materialize(before)
    dtype = readings.schema["date_time"].dataType
    joined = lookup_join(readings, before.select("cpe", F.col("last_insert").alias("_mark")), "cpe", "left", materialized=True)
    new = joined.filter(F.col("date_time") > F.coalesce(F.col("_mark"), ts_literal(SENTINEL_MARK, dtype))).drop("_mark")
    folder = f"{out_path}/batch_id={batch_id}"
    kept = keep_latest(new, ("cpe", "date_time"), seq=order or "consumption").select(*readings.columns)
    kept.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(kept.schema).parquet(folder)
    after = written.groupBy("cpe").agg(F.max("date_time").cast("timestamp_ntz").alias("last_insert"))
    kind = "full" if full is None or batch_id - full >= full_every else "inc"
    if kind == "full":
        after = before.unionByName(after).groupBy("cpe").agg(F.max("last_insert").alias("last_insert"))
    after.write.mode("overwrite").parquet(f"{marks_path}/kind={kind}/batch_id={batch_id}")
    if full is not None:
        _prune_marks(spark, marks_path, full)


def stream_delta(readings: DataFrame, out_path: str, marks_path: str, checkpoint: str,
                 seed_marks: DataFrame | None = None, order: str | None = None, available_now: bool = True,
                 full_every: int = 16):
    """Start I2 on streaming readings (``cpe, date_time, consumption, ...``); returns the StreamingQuery.

    The strictly newer readings come out in ``out_path`` (partitioned by ``batch_id``).
    """
    seed = materialize(seed_marks.select("cpe", F.col("last_insert").cast("timestamp_ntz").alias("last_insert"))) \
        if seed_marks is not None else None

    def run(batch: DataFrame, batch_id: int) -> None:
        delta_batch(batch, batch_id, out_path, marks_path, seed, order, full_every)

    w = readings.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
