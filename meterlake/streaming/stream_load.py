"""Continuous delta load of arriving files with Structured Streaming.

Each micro-batch (``foreachBatch``) decodes its files into readings (``parse``:
workbook decoding, or a plain projection for files that already hold
readings) and is a delta load (F4) into the point store that full and delta loads
use: marks from what the loads kept, readings strictly newer than them, one
point per key (the newest file wins: two snapshots of a month in one batch),
written once into a load folder of the batch's own. The folder is named by stream
and batch, so a replayed batch finds its load ended and writes nothing, or not
ended and writes it anew. Every ``compact_every`` batches the loads are merged,
which bounds the number of files.

Files of one meter must arrive in time order: a newer file first makes older
readings of that meter fall under the mark (the reference's delta rule).
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.load import compact, write_delta
from meterlake.plans.joins import lookup_join, materialize


def load_batch(readings: DataFrame, batch_id: int, store_path: str, stream: str = "stream",
               seed_marks: DataFrame | None = None, fields=("consumption",), compact_every: int = 16,
               as_of=None) -> DataFrame:
    """One micro-batch of I1 (also usable on its own for a batch of files); returns the points of its load.

    ``readings`` has ``cpe, date_time, consumption, file, file_seq`` and maybe ``row``.
    ``stream`` (letters and digits) names the stream whose batches are counted.
    ``as_of`` as in ``write_delta``.
    """
    order = F.struct(*[F.col(c) for c in ("file_seq", "file", "row") if c in readings.columns]).alias("_order")
    rows = readings.select("cpe", "date_time", *fields, order)
    out = write_delta(rows, store_path, batch_id, fields, order="_order", as_of=as_of, tag=f"{stream}b{batch_id}",
                      seed_marks=seed_marks)
    if batch_id and batch_id % compact_every == 0:
        compact(readings.sparkSession, store_path, as_of=as_of)
    return out


def workbook_parser(cpe_from_path: str = r"/([^/]+)/[^/]+$",
                    quarantine: str | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """``parse`` for a ``binaryFile`` stream of workbooks: A1 decode + B chain.

    The meter code is taken from the file path (``cpe_from_path``: regex, group
    1); the file's modification time orders files inside a batch. Rows and files
    that can't be read go to ``<quarantine>/batch_id=<b>``, which a replayed batch
    overwrites. Without ``quarantine``, don't let the source delete its files.
    """
    from meterlake.operators.readings import parse_readings
    from meterlake.sources.workbooks import decode_workbooks

    def parse(batch: DataFrame, batch_id: int = 0) -> DataFrame:
        good, bad = parse_readings(decode_workbooks(batch), F.regexp_extract("file", cpe_from_path, 1))
        if quarantine is not None:
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        # one row per file of the micro-batch: a measured lookup, not a shuffle of readings
        files = batch.select(F.col("path").alias("file"),
                             F.unix_micros(F.col("modificationTime")).alias("file_seq"))
        return lookup_join(good, files, "file", "inner")

    return parse


def readings_from_parquet(batch: DataFrame) -> DataFrame:
    """``parse`` for files that already hold readings (cpe, date_time, consumption)."""
    return batch.withColumn("file", F.col("_metadata.file_path")).withColumn(
        "file_seq", F.unix_micros(F.col("_metadata.file_modification_time")))


def stream_load(spark: SparkSession, stream: DataFrame, store_path: str, checkpoint: str,
                parse: Callable[..., DataFrame], seed_marks: DataFrame | None = None, available_now: bool = True,
                compact_every: int = 16, as_of=None):
    """Start I1 on a streaming DataFrame of files; returns the StreamingQuery.

    ``parse(batch)`` or ``parse(batch, batch_id)`` must return ``cpe, date_time,
    consumption, file, file_seq``. ``seed_marks`` (``cpe, last_insert``) are marks from
    elsewhere; they are materialised once, before the stream starts. The stream's name in
    the store follows from its ``checkpoint`` folder.
    """
    seed = materialize(seed_marks.select("cpe", "last_insert")) if seed_marks is not None else None
    name = "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    takes_id = len(inspect.signature(parse).parameters) > 1

    def run(batch: DataFrame, batch_id: int) -> None:
        load_batch(parse(batch, batch_id) if takes_id else parse(batch), batch_id, store_path, name, seed,
                   compact_every=compact_every, as_of=as_of)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
