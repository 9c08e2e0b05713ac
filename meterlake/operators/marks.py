"""High-water marks per meter and the delta rule.

The delta rule: a reading is new when its time is strictly greater than the
latest stored time of its meter; a meter with nothing stored gets the sentinel
mark. Older gaps are never refilled (that is what the full load is for).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.plans.joins import lookup_join
from meterlake.session import FIELD, MEASUREMENT, RANGE_START, SENTINEL_MARK


# Point stores hash each meter code into this many ``bucket`` partitions.
METER_BUCKETS = 64


def meter_bucket(cpe) -> Column:
    """The store's ``bucket`` partition value of a meter code (one bucket count for every store).

    On a literal code Catalyst folds it to a constant, so a filter on it prunes
    partitions."""
    c = F.col(cpe) if isinstance(cpe, str) else cpe
    return F.pmod(F.xxhash64(c), F.lit(METER_BUCKETS)).cast("int")


def ts_literal(value: str, like: T.DataType) -> Column:
    """A timestamp literal of the same flavour (NTZ or LTZ) as ``like``."""
    kind = "timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp"
    return F.lit(value).cast(kind)


def range_scan(points: DataFrame, start: str | None = RANGE_START, stop: str | None = None,
               ts: str = "time", store: bool = False) -> DataFrame:
    """``start <= ts < stop`` (half-open); both bounds reach the Parquet scan.

    ``store``: ``points`` is a point store, whose ``month`` folders (``yyyy-MM``
    of the time) are bounded too.
    """
    dtype = points.schema[ts].dataType
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= ts_literal(start, dtype))
    if stop is not None:
        cond = cond & (F.col(ts) < ts_literal(stop, dtype))
    if store:
        if start is not None:
            cond = cond & (F.col("month") >= str(start)[:7])
        if stop is not None:
            cond = cond & (F.col("month") <= str(stop)[:7])
    return points.filter(cond)


def series_filter(points: DataFrame, measurement: str | None = MEASUREMENT,
                  field: str | None = FIELD, meters: DataFrame | Iterable[str] | None = None,
                  key: str = "cpe", store: bool = False) -> DataFrame:
    """Equality on measurement and field, and the meter tag.

    ``meters`` is one code, a list of codes (``isin``) or a DataFrame of codes
    (semi join; broadcast only when its measured size allows). ``store``:
    ``points`` is a point store; named codes also select their bucket folders,
    so one meter's series reads 1/64 of the store.
    """
    out = points
    if measurement is not None:
        out = out.filter(F.col("measurement") == measurement)
    if field is not None:
        out = out.filter(F.col("field") == field)
    if meters is None:
        return out
    if isinstance(meters, DataFrame):
        return lookup_join(out, meters.select(key).distinct(), key, "left_semi")
    codes = [meters] if isinstance(meters, str) else list(meters)
    out = out.filter(F.col(key).isin(codes))
    if store and codes:
        out = out.filter(F.col("bucket").isin(*[meter_bucket(F.lit(c)) for c in codes]))
    return out


def last_point(points: DataFrame, key: str = "cpe", ts: str = "time",
               tiebreak: str | None = None) -> DataFrame:
    """The latest point of every series, all columns kept.

    One aggregate with map-side partial aggregation (no window, no join):
    with a single fixed-width payload it is a hash aggregate; a struct payload
    or a ``tiebreak`` (largest wins on equal times, for determinism) plans as a
    sort-based partial aggregate.
    """
    rest = [c for c in points.columns if c != key]
    payload = [c for c in rest if c != ts]
    if tiebreak is None and len(payload) == 1 and isinstance(
            points.schema[payload[0]].dataType, (T.NumericType, T.BooleanType, T.TimestampType,
                                                 T.TimestampNTZType, T.DateType)) \
            and not isinstance(points.schema[payload[0]].dataType, T.DecimalType):
        # fixed-width buffers: a hash aggregate (a series has one point per time)
        return points.groupBy(key).agg(F.max(ts).alias(ts), F.max_by(payload[0], ts).alias(payload[0])) \
            .select(key, *rest)
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return (points.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_p"))
            .select(key, *[F.col(f"_p.{c}").alias(c) for c in rest]))


def marks(stored: DataFrame, key: str = "cpe", ts: str = "time", as_of: str | None = None,
          measurement: str | None = MEASUREMENT, field: str | None = FIELD) -> DataFrame:
    """Latest stored time per meter, over the reference's range and series filters."""
    pts = stored
    if measurement is not None and "measurement" in pts.columns:
        pts = pts.filter(F.col("measurement") == measurement)
    if field is not None and "field" in pts.columns:
        pts = pts.filter(F.col("field") == field)
    pts = range_scan(pts, RANGE_START, as_of, ts)
    return pts.groupBy(key).agg(F.max(ts).alias("last_insert"))


def last_insert(stored: DataFrame, meters: DataFrame, key: str = "cpe", ts: str = "time",
                as_of: str | None = None, **filters) -> DataFrame:
    """Every meter's mark; meters with nothing stored get the sentinel."""
    m = marks(stored, key, ts, as_of, **filters)
    dtype = stored.schema[ts].dataType
    joined = lookup_join(meters.select(key), m, key, "left")
    return joined.select(key, F.coalesce(F.col("last_insert"), ts_literal(SENTINEL_MARK, dtype))
                         .alias("last_insert"))


def delta(incoming: DataFrame, stored: DataFrame, key: str = "cpe", ts: str = "date_time",
          stored_ts: str = "time", as_of: str | None = None, report: dict | None = None,
          **filters) -> DataFrame:
    """Incoming readings strictly newer than their meter's stored mark.

    Marks are aggregated from the store (partial + final hash aggregate), then
    joined as a size-checked lookup; the readings are never shuffled when the
    mark table fits the broadcast limit.
    """
    return delta_against(incoming, marks(stored, key, stored_ts, as_of, **filters), key, ts, report)


def delta_against(incoming: DataFrame, mark_table: DataFrame, key: str = "cpe", ts: str = "date_time",
                  report: dict | None = None, materialized: bool = False) -> DataFrame:
    """C8 with the marks given (``key, last_insert``; a missing meter gets the sentinel)."""
    m = mark_table.select(key, F.col("last_insert").alias("_mark"))
    dtype = incoming.schema[ts].dataType
    joined = lookup_join(incoming, m, key, "left", report=report, materialized=materialized)
    return (joined.filter(F.col(ts) > F.coalesce(F.col("_mark"), ts_literal(SENTINEL_MARK, dtype)))
            .drop("_mark"))
