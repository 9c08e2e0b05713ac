"""Calendar period selection and request checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import month_start_col, period_bounds


def select_period(readings: DataFrame, workflow: str, as_of=None, year: int | None = None,
                  month: int | None = None, ts: str = "date_time", store: bool = False) -> DataFrame:
    """C3 (``select``), C4 (``current``), C5 (``previous``): one calendar month.

    Bounds are computed once on the driver, so the predicate is two literals
    that reach the Parquet scan (and prune ``month`` partitions when the table
    is partitioned by it and the caller also filters that column).
    """
    start, end = period_bounds(workflow, as_of, year, month)
    kind = readings.schema[ts].dataType.simpleString()
    lo = F.lit(start.isoformat(sep=" ")).cast(kind)
    hi = F.lit(end.isoformat(sep=" ")).cast(kind)
    out = readings.filter((F.col(ts) >= lo) & (F.col(ts) < hi))
    if store:   # a predicate on the time alone does not prune the month folders
        out = out.filter(F.col("month") == start.strftime("%Y-%m"))
    return out


def flag_future(requests: DataFrame, as_of, year: str = "year", month: str = "month") -> DataFrame:
    """``future`` is true when the first day of the requested month is after ``as_of``.

    A request that names no month (null, month 13) has ``future`` null.
    """
    as_of_ts = F.lit(str(as_of)).cast("timestamp_ntz")
    first = month_start_col(F.col(year), F.col(month))
    return requests.withColumn("future", first > as_of_ts)


def reject_future(requests: DataFrame, as_of, year: str = "year",
                  month: str = "month") -> tuple[DataFrame, DataFrame]:
    """C6 split: (accepted, rejected: in the future or no valid month)."""
    flagged = flag_future(requests, as_of, year, month)
    rejected = F.coalesce(F.col("future"), F.lit(True))
    return flagged.filter(~rejected).drop("future"), flagged.filter(rejected).drop("future")


def missing_periods(requests: DataFrame, available: DataFrame,
                    keys: Sequence[str] = ("cpe", "year", "month")) -> DataFrame:
    """Every request whose (meter, year, month) has no data on offer.

    ``available`` is reduced to distinct keys (partial aggregation) before a
    shuffled anti join; AQE splits a hot meter's partition.
    """
    offer = available.select(*keys).distinct()
    return requests.join(offer, list(keys), "left_anti")
