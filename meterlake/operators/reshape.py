"""Reshaping between readings and tagged time-series points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import MEASUREMENT


def to_points(readings: DataFrame, fields: Sequence[str] = ("consumption",),
              tags: Sequence[str] = ("cpe",), ts: str = "date_time",
              measurement: str = MEASUREMENT, tag_map: bool = False) -> DataFrame:
    """wide readings -> tall points ``measurement, <tags>, field, value, time``.

    ``unpivot`` is a projection-only ``Expand``: no shuffle. Tags stay plain
    columns (prunable, partitionable); ``tag_map=True`` adds a ``tags`` map too.
    """
    ids = [F.col(t) for t in tags] + [F.col(ts).alias("time")]
    tall = readings.select(*ids, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(
        [F.col(t) for t in tags] + [F.col("time")], list(fields), "field", "value")
    cols = [F.lit(measurement).alias("measurement"), *[F.col(t) for t in tags]]
    if tag_map:
        cols.append(F.create_map(*[x for t in tags for x in (F.lit(t), F.col(t))]).alias("tags"))
    return tall.select(*cols, "field", "value", "time")


def second_precision(df: DataFrame, ts: str = "time") -> DataFrame:
    """timestamps written at whole seconds; a naive time keeps its wall time in any session zone."""
    part = F.date_part(F.lit("seconds"), F.col(ts))
    none = F.lit(0)
    return df.withColumn(ts, F.col(ts) - F.make_dt_interval(none, none, none, (part - F.floor(part)).cast("decimal(18,6)")))


def pivot_fields(points: DataFrame, fields: Sequence[str], row_key: Sequence[str] = ("cpe", "time"),
                 agg=F.max) -> DataFrame:
    """D3: tall fields -> one row per key with one column per field.

    One conditional aggregate per listed field, ``agg(value if field = f)``:
    a single hash aggregate with map-side partial aggregation and one shuffle
    on the row key (``groupBy().pivot()`` plans two: by key and field, then a
    pivot by key). ``agg`` must ignore nulls (max, min, sum, avg, count).
    """
    return points.groupBy(*row_key).agg(
        *[agg(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])


def load_profile(readings: DataFrame, by: Sequence[str], key: str = "cpe",
                 value: str = "consumption", digits: int | None = 2) -> DataFrame:
    """Per file (or period): reading count, distinct meters, total consumption."""
    total = F.sum(value)
    if digits is not None:
        total = F.round(total, digits)
    return readings.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count_distinct(key).alias("n_meters"),
        total.alias("total_consumption"),
    )
