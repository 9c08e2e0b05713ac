"""Loading points: full (idempotent reload) and delta (strictly newer).

The point store is a folder of loads (see "loads of a store" below), each a Parquet
directory partitioned by ``measurement``, ``month`` (``yyyy-MM`` of the point time) and
``bucket`` (a hash of the meter code into ``marks.METER_BUCKETS`` buckets). A full and a
delta load alike write their points once, into a new folder; a reader takes the
newest point of each key, and ``compact`` merges folders. Each load keeps
its per-meter marks, so a delta load reads marks, not the store.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.marks import delta_against, last_point, marks, meter_bucket, ts_literal
from meterlake.operators.reshape import second_precision, to_points
from meterlake.plans.joins import lookup_join, materialize
from meterlake.session import FIELD, MEASUREMENT, SENTINEL_MARK

POINT_KEY = ("measurement", "cpe", "field", "time")
PARTITIONS = ("measurement", "month", "bucket")


_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_latest(points: DataFrame, keys: Sequence[str] = POINT_KEY, seq: str = "load_seq",
                tiebreak: str | None = None) -> DataFrame:
    """F3 rule: one point per key, taken from the newest load (``tiebreak`` breaks
    equal ``seq`` deterministically).

    With one fixed-width payload column and no tiebreak the rule is
    ``max_by(value, seq)`` + ``max(seq)``: a hash aggregate with map-side partial
    aggregation. Otherwise the payload travels as one struct (``max_by`` over a
    struct plans as a sort-based partial aggregate -- still reduced map-side,
    spill-safe). A hot meter spreads over its times either way.
    """
    rest = [c for c in points.columns if c not in keys]
    payload = [c for c in rest if c != seq]
    types = {f.name: f.dataType for f in points.schema.fields}
    if tiebreak is None and len(payload) == 1 and isinstance(types[payload[0]], _FIXED_WIDTH) \
            and isinstance(types[seq], _FIXED_WIDTH):
        return points.groupBy(*keys).agg(F.max_by(payload[0], seq).alias(payload[0]), F.max(seq).alias(seq))
    order = F.struct(F.col(seq), F.col(tiebreak)) if tiebreak else F.col(seq)
    return (points.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_p"))
            .select(*keys, *[F.col(f"_p.{c}").alias(c) for c in rest]))


def merge_full(stored: DataFrame, incoming: DataFrame, keys: Sequence[str] = POINT_KEY,
               seq: str = "load_seq", tiebreak: str | None = None) -> DataFrame:
    """stored ∪ incoming with one point per key from the newest load."""
    return keep_latest(stored.unionByName(incoming, allowMissingColumns=True), keys, seq, tiebreak)


def with_month(points: DataFrame, ts: str = "time") -> DataFrame:
    """Add the store's partition columns: ``month`` and the meter ``bucket``."""
    return points.withColumns({
        "month": F.date_format(F.col(ts), "yyyy-MM"),
        "bucket": meter_bucket("cpe"),
    })


def write_points(points: DataFrame, path: str, mode: str) -> None:
    """Write points into the store's partition folders.

    ``rebalance`` on the partition columns clusters the rows of one folder into
    few tasks (one file per folder per advisory-size chunk, instead of every
    task writing into every folder); AQE splits a skewed folder -- a hot
    meter's bucket -- over several tasks and merges small ones. Files are
    sorted by (meter, time), so Parquet min/max statistics skip row groups.
    """
    points.hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "cpe", "time") \
        .write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


# ---------------------------------------------------------------- loads of a store
# A load writes one folder of its own, ``<store>/load=<load_seq>-<k>-<kind>-<tag>``,
# which Spark commits with ``_SUCCESS`` and which nothing changes afterwards. A folder
# without it is a load that did not end: readers leave it out, and the next delta
# load loads its readings again. Two points of one key count by the later
# load: larger ``load_seq``, then larger ``k`` (loads of a store are counted from 1).
# ``kind`` says whether keys may repeat those of earlier loads: those of a
# ``delta`` don't. ``_marks/<folder>`` (hidden from readers of the points) keeps the
# largest time of each meter in the load, so that a delta load need not read the points.
MARKS_DIR = "_marks"
FULL, DELTA, MERGED = "full", "delta", "merged"
_LOAD = re.compile(r"load=(\d+)-(\d+)-(full|delta|merged)-(\w+)$")


@dataclass(frozen=True, order=True)
class Load:
    """One committed load folder, in the order in which loads count."""

    seq: int
    k: int
    kind: str
    tag: str
    path: str

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[1]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str) -> tuple[list[Load], list[Load]]:
    """(committed loads that hold points, all other load folders) of a store: one listing of each load folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return [], []
    done, rest = [], []
    for st in fs.listStatus(p):
        m = _LOAD.match(st.getPath().getName())
        if m:
            load = Load(int(m[1]), int(m[2]), m[3], m[4], st.getPath().toString())
            names = {c.getPath().getName() for c in fs.listStatus(st.getPath())}
            held = "_SUCCESS" in names and any(not n.startswith(("_", ".")) for n in names)
            (done if held else rest).append(load)
    return sorted(done), sorted(rest)


def committed_loads(spark: SparkSession, path: str) -> list[Load]:
    """The loads that readers of the store see, oldest first."""
    return _folders(spark, path)[0]


def _read_loads(spark: SparkSession, path: str, loads: Sequence[Load]) -> DataFrame:
    """The points of some loads, one per key."""
    points = spark.read.option("basePath", path).parquet(*[x.path for x in loads])
    if all(x.kind == DELTA for x in loads[1:]):
        return points.drop("load")
    place = F.create_map(*[c for i, x in enumerate(loads) for c in (F.lit(x.name.split("=", 1)[1]), F.lit(i))])
    keys = [*POINT_KEY, "month", "bucket"]       # month and bucket follow from the key: filters on them reach the scan
    points = points.withColumn("_place", place[F.col("load")])
    rest = [c for c in points.columns if c not in (*keys, "load", "_place")]
    return points.groupBy(*keys).agg(*[F.max_by(c, "_place").alias(c) for c in rest])


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The points of a store, one per key, or None when no load has ended yet."""
    loads = committed_loads(spark, path)
    return _read_loads(spark, path, loads) if loads else None


def _now(as_of) -> str:
    return str(as_of) if as_of is not None else dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _marks_of(points: DataFrame, now: str) -> DataFrame:
    """One mark per meter of a load, and a row without a meter if some point is later than ``now``."""
    found = marks(points, as_of=now).select("cpe", "last_insert", F.lit(False).alias("ahead"))
    late = points.filter(F.col("time") >= ts_literal(now, points.schema["time"].dataType)).limit(1)
    return found.unionByName(late.select(F.lit(None).cast("string").alias("cpe"), F.lit(None).cast(points.schema["time"].dataType)
                                         .alias("last_insert"), F.lit(True).alias("ahead")))


def _kept(spark: SparkSession, path: str, loads: Sequence[Load], now: str) -> tuple[DataFrame, bool] | None:
    """(largest time of each meter in the loads, whether a point later than the loads' "now" was stored).

    A load whose writer died before it kept its marks gives them from its points.
    """
    if not loads:
        return None
    fs, _ = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tables, bare = [], []
    for x in loads:
        folder = f"{path}/{MARKS_DIR}/{x.name}"
        (tables if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")) else bare).append((x, folder))
    parts = [spark.read.parquet(*[f for _, f in tables])] if tables else []
    if bare:
        parts.append(_marks_of(_read_loads(spark, path, [x for x, _ in bare]), now))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    folded = materialize(every.groupBy("cpe").agg(F.max("last_insert").alias("last_insert"), F.max("ahead").alias("ahead")))
    ahead = not folded.filter("ahead").isEmpty()
    return folded.filter("NOT ahead").select("cpe", "last_insert"), ahead


def kept_marks(spark: SparkSession, path: str, as_of=None) -> DataFrame | None:
    """The store's marks (one row per meter), or None when nothing is stored.

    They come from what the loads kept; while a point later than a load's "now" is
    stored (it raises no mark until its time has come) they come from the points.
    """
    loads = committed_loads(spark, path)
    kept = _kept(spark, path, loads, _now(as_of))
    if kept is None:
        return None
    return marks(_read_loads(spark, path, loads), as_of=_now(as_of)) if kept[1] else kept[0]


def store_last_insert(spark: SparkSession, path: str, meters: DataFrame, as_of=None) -> DataFrame:
    """D2 on a point store: every meter's latest point before ``as_of`` (default now;
    sentinel when nothing is stored). Without ``as_of`` the kept marks serve; else
    the marks come from the points."""
    if as_of is None:
        kept = kept_marks(spark, path)
    else:
        stored = read_store(spark, path)
        kept = marks(stored, as_of=_now(as_of)) if stored is not None else None
    if kept is None:
        kept = spark.createDataFrame([], "cpe string, last_insert timestamp_ntz")
    dtype = kept.schema["last_insert"].dataType
    joined = lookup_join(meters.select("cpe"), kept, "cpe", "left")
    return joined.select("cpe", F.coalesce(F.col("last_insert"), ts_literal(SENTINEL_MARK, dtype))
                         .alias("last_insert"))


def store_last_point(spark: SparkSession, path: str) -> DataFrame | None:
    """D1 on a point store: each meter's latest point (``cpe, time, value, load_seq``).

    The kept marks name each meter's latest time, so only the month folders holding
    some meter's latest point are read (a literal partition filter; the months
    are at most the store's month count); those points are matched to the marks on
    (meter, time) as a measured lookup, and equal times keep the newest load.
    """
    stored = read_store(spark, path)
    if stored is None:
        return None
    m = materialize(kept_marks(spark, path))
    months = sorted(r[0] for r in m.select(F.date_format("last_insert", "yyyy-MM")).distinct().collect())
    latest = (stored.filter((F.col("measurement") == MEASUREMENT) & (F.col("field") == FIELD)
                            & F.col("month").isin(months))
              .select("cpe", "time", "value", "load_seq"))
    hits = lookup_join(latest, m.select("cpe", F.col("last_insert").alias("time")), ["cpe", "time"],
                       "left_semi", materialized=True)
    return last_point(hits, "cpe", "time", tiebreak="load_seq")


def _load_points(points: DataFrame, load_seq: int, order: str | None) -> DataFrame:
    """The points of one load, one per key at second precision."""
    points = second_precision(points, "time")
    points = keep_latest(points, POINT_KEY, seq=order or "value")
    if order is not None:
        points = points.drop(order)
    return with_month(points).withColumn("load_seq", F.lit(load_seq).cast("long"))


def _add_load(points: DataFrame, path: str, load_seq: int, kind: str, now: str, tag: str | None = None,
              k: int | None = None) -> DataFrame:
    """Write a load's points into a folder of its own, then its marks; the points as written."""
    spark = points.sparkSession
    done, rest = _folders(spark, path)
    if k is None:
        k = 1 + max((x.k for x in [*done, *rest]), default=0)
    name = f"load={load_seq:019d}-{k:09d}-{kind}-{tag or uuid.uuid4().hex[:12]}"
    write_points(points, f"{path}/{name}", "errorifexists")
    new = [x for x in committed_loads(spark, path) if x.name == name]
    if not new:            # no points: nothing to see
        return points.limit(0)
    written = _read_loads(spark, path, new)
    _marks_of(written, now).write.mode("overwrite").parquet(f"{path}/{MARKS_DIR}/{name}")
    return written


def write_full(incoming: DataFrame, path: str, load_seq: int, order: str | None = None, as_of=None) -> DataFrame:
    """F3 writer: add the incoming points, which replace stored ones of their keys; returns the points of this load.

    They are written once, into a new folder: stored points are never
    touched, so a writer that dies loses nothing, and ``compact`` merges the folders
    later. Times are cut to seconds. ``order`` (a column of ``incoming``, not written)
    decides between points of one key inside this load -- the largest wins, as
    the later of two writes of one timestamp would (e.g. the repeated hour of
    the autumn clock change); without it the largest value wins. A load without
    points changes nothing. A rerun gives the same points. ``as_of`` (default
    now) bounds the kept marks. One writer per store at a time.
    """
    return _add_load(_load_points(incoming, load_seq, order), path, load_seq, FULL, _now(as_of))


def write_delta(incoming_readings: DataFrame, path: str, load_seq: int, fields: Sequence[str] = ("consumption",),
                order: str | None = None, as_of=None, tag: str | None = None,
                seed_marks: DataFrame | None = None) -> DataFrame:
    """F4 writer: add only the readings strictly newer than each meter's mark; returns them as points.

    One point per key is written, at second precision; ``order`` as in
    ``write_full``. A mark is the meter's latest stored point before ``as_of``
    (default now), or its row in ``seed_marks`` (``cpe, last_insert``) if that is
    later. Marks come from what the loads kept (one row per meter and load).
    A load that died half way is not seen, so its readings are loaded again. ``tag``
    (letters and digits) names a load that a caller may repeat: if one of this name
    has ended, nothing is written.
    """
    spark, now = incoming_readings.sparkSession, _now(as_of)
    loads = committed_loads(spark, path)
    again = [x for x in loads if tag is not None and x.tag == tag]
    if again:
        return _read_loads(spark, path, again)
    new = second_precision(incoming_readings, "date_time")
    kept = _kept(spark, path, loads, now)
    base, kind = None, DELTA
    if kept is not None:
        base = kept[0]
        if kept[1]:
            # A point that raises no mark may come a second time.
            base, kind = materialize(marks(_read_loads(spark, path, loads), as_of=now)), FULL
    if seed_marks is not None:
        seeds = seed_marks.select("cpe", "last_insert")
        both = seeds if base is None else base.unionByName(seeds)
        base = materialize(both.groupBy("cpe").agg(F.max("last_insert").alias("last_insert")))
    if base is not None:
        new = delta_against(new, base, materialized=True)
    tags = ("cpe",) if order is None else ("cpe", order)
    return _add_load(_load_points(to_points(new, fields, tags=tags), load_seq, order), path, load_seq, kind, now, tag)


def compact(spark: SparkSession, path: str, keep: int = 1, as_of=None) -> int:
    """Merge all loads but the latest ``keep`` into one folder, one point per key; returns how many were merged.

    The merged folder takes its place in the order of loads before the old ones
    go, and holds the same points: a reader who finds both, because the writer
    died in between, sees each key once. Folders of loads that did not end go
    too. A reader that began before may have to begin again. One writer per store.
    """
    done, rest = _folders(spark, path)
    old = done[:len(done) - keep]
    if len(old) > 1:
        points = _read_loads(spark, path, old)
        kept, ahead = _kept(spark, path, old, _now(as_of))
        last = old[-1]
        name = f"load={last.seq:019d}-{last.k:09d}-{MERGED}-{uuid.uuid4().hex[:12]}"
        table = kept.withColumn("ahead", F.lit(False))
        if ahead:
            table = table.unionByName(spark.range(1).select(
                F.lit(None).cast("string").alias("cpe"), F.lit(None).cast(kept.schema["last_insert"].dataType).alias("last_insert"),
                F.lit(True).alias("ahead")))
        table.write.mode("overwrite").parquet(f"{path}/{MARKS_DIR}/{name}")
        write_points(points, f"{path}/{name}", "errorifexists")
    else:
        old = []
    fs, _ = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    for x in [*old, *rest]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(x.path), True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKS_DIR}/{x.name}"), True)
    return len(old)


REPORT_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def fan_out(df: DataFrame, targets: Iterable[str | None],
            writers: dict[str, Callable[[DataFrame], object]]) -> DataFrame:
    """write one parsed set to each named store.

    The set is persisted once (memory and disk, recomputable on executor loss)
    and counted once. Empty names are ignored, unknown names reported and
    skipped; the report is one row per target. A writer returns the rows it wrote
    (a number or a frame of them); the report counts the whole set if it returns neither.
    """
    targets = list(targets)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = cached.count()
        rows = []
        for t in targets:
            if t is None or t.strip() == "":
                rows.append((t, "ignored", None))
            elif t not in writers:
                rows.append((t, "unsupported", None))
            else:
                wrote = writers[t](cached)
                count = wrote.count() if isinstance(wrote, DataFrame) else wrote
                rows.append((t, "loaded", count if isinstance(count, int) else n))
    finally:
        cached.unpersist()
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def retain_options(keep: bool, archive_dir: str | None = None) -> dict[str, str]:
    """F6 for the file stream source: archive processed files (keep) or delete them."""
    if keep:
        if not archive_dir:
            raise ValueError("keep=True needs an archive directory")
        return {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    return {"cleanSource": "delete"}


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def claim_source(spark: SparkSession, landing: str) -> str | None:
    """Take over all that lies in a landing folder, by one rename of the folder; returns its new path.

    What arrives afterwards comes into a new landing folder and is left to the
    next load. None when the landing folder is missing or holds nothing.
    """
    fs, p = _fs(spark, landing.rstrip("/"))
    if not fs.exists(p) or not fs.listStatus(p):
        return None
    claimed = p.suffix(f".claimed-{uuid.uuid4().hex[:12]}")
    if not fs.rename(p, claimed):
        raise OSError(f"could not move {landing} to {claimed.toString()}")
    return claimed.toString()


def release_source(spark: SparkSession, claimed: str, landing: str) -> None:
    """Put a claimed folder back, beside what has arrived since: one rename for each entry at its top."""
    fs, p = _fs(spark, claimed)
    home = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing.rstrip("/"))
    if not fs.exists(home) and fs.rename(p, home):
        return
    fs.mkdirs(home)
    for st in fs.listStatus(p):
        _put_back(spark, fs, st.getPath(), home)
    fs.delete(p, True)


def _put_back(spark: SparkSession, fs, entry, home) -> None:
    """Move a file or folder into the folder ``home``, into the folder of its name if that exists."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home, entry.getName())
    if fs.exists(target) and fs.getFileStatus(target).isDirectory():
        for st in fs.listStatus(entry):
            _put_back(spark, fs, st.getPath(), target)
    elif fs.exists(target) or not fs.rename(entry, target):
        raise OSError(f"could not move {entry.toString()} back to {target.toString()}")


def retain_folder(spark: SparkSession, claimed: str, keep: bool, archive_dir: str | None = None,
                  spare: Iterable[str] = (), landing: str | None = None) -> str | None:
    """F6 for a claimed folder: move it to ``archive_dir`` as a whole, or delete it.

    One rename or one delete, whatever the number of files; their names never
    come to the driver. Without ``keep`` the files of ``spare`` (those not loaded in
    full, taken one by one from any iterator) go back to their places in ``landing``
    first. Returns the archive's path, None when deleted. An ``archive_dir`` that
    exists is refused.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs, p = _fs(spark, claimed)
    if keep:
        target = path(archive_dir)
        if fs.exists(target):
            raise OSError(f"{archive_dir} exists")
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"could not move {claimed} to {archive_dir}")
        return target.toString()
    under = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    for f in spare:
        full = path(f).toUri().getPath()
        if not full.startswith(under):
            raise OSError(f"{f} does not lie in {claimed}")
        back = path(landing, full[len(under):])
        fs.mkdirs(back.getParent())
        if fs.exists(back) or not fs.rename(path(f), back):
            raise OSError(f"could not move {f} back to {back.toString()}")
    fs.delete(p, True)
    return None


def retain_source(spark: SparkSession, files: Iterable[str], keep: bool, archive_dir: str | None = None,
                  root: str | None = None) -> list[str]:
    """F6 for one batch of named files: move them into ``archive_dir`` or delete them.

    Files keep their path below ``root``, so equal names in different meter
    folders don't meet; without ``root`` only their name. A file that would meet
    another is refused before any is moved. Folders left empty below ``root``
    go. Works on any Hadoop file system; returns the new paths (empty when
    deleted).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = list(files)
    if not files:
        return []
    top = path(root) if root else None
    fs = path(files[0]).getFileSystem(conf)
    under = fs.makeQualified(top).toUri().getPath().rstrip("/") + "/" if top else None

    def target(f: str):
        full = path(f).toUri().getPath()
        return path(archive_dir, full[len(under):] if under and full.startswith(under) else path(f).getName())

    if not keep:
        for f in files:
            fs.delete(path(f), False)
    moves = [(f, target(f)) for f in files] if keep else []
    names = [t.toString() for _, t in moves]
    if len(set(names)) < len(names) or any(fs.exists(t) for _, t in moves):
        raise OSError(f"files of one name would meet in {archive_dir}")
    for f, t in moves:
        fs.mkdirs(t.getParent())
        if not fs.rename(path(f), t):
            raise OSError(f"could not move {f} to {t.toString()}")
    if top:
        folders = {path(f).getParent() for f in files}
        for folder in sorted(folders, key=lambda p: -p.depth()):
            while folder is not None and (folder.toUri().getPath() + "/").startswith(under) \
                    and fs.exists(folder) and not fs.listStatus(folder):
                fs.delete(folder, False)
                folder = folder.getParent()
    return names
