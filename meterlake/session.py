"""Session defaults and shared settings.

Library functions never create a session; they take the caller's.
``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Fixed values of the reference data model.
MEASUREMENT = "kW"
FIELD = "consumption"
TAG = "cpe"
# Mark used when a meter has no stored point (1989-05-11T00:00:00Z).
SENTINEL_MARK = "1989-05-11 00:00:00"
# Lower bound of the stored-points range scan (1989-05-11T01:10:00Z).
RANGE_START = "1989-05-11 01:10:00"

# Largest lookup table (bytes, measured) that joins may broadcast.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_CONF = "meterlake.broadcast.maxBytes"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "meterlake", extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces small partitions and splits skewed ones at run time).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Broadcast only on measured sizes: never from planning-time estimates,
        # only from AQE's runtime shuffle statistics or lookup_join's count.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``meterlake`` importable in Python workers (``addPyFile``, once per context).

    Functions run inside tasks (workbook decode/render, the streaming state
    function) are pickled by reference, so executors must import the package.
    """
    sc = spark.sparkContext
    if getattr(sc, "_meterlake_shipped", False):
        return
    if spark.conf.get("meterlake.shipPackage", "true").lower() == "false":   # installed on executors
        sc._meterlake_shipped = True
        return
    import zipfile

    import meterlake

    root = os.path.dirname(os.path.abspath(meterlake.__file__))
    fd, path = tempfile.mkstemp(prefix="meterlake-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._meterlake_shipped = True


def ensure_utc(spark: SparkSession) -> None:
    """Put the session settings of the registered queries in place: the UTC zone, in which
    naive readings are labelled (no shift), and the broadcast policy.

    Library functions don't call this; they leave the caller's session as it is.
    It applies the broadcast policy: no broadcast from planning-time size
    estimates (``autoBroadcastJoinThreshold=-1``); AQE may still broadcast a
    side whose *measured* shuffle output is under its adaptive threshold, and
    ``plans.joins.lookup_join`` broadcasts measured lookups.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None) != "-1":
        adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
        if not adaptive or adaptive.strip() == "-1":
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ship_package(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory already set on
    the context). Only when neither is set on a ``local`` master -- tests -- a
    private scratch folder is created; on a cluster an unset folder is an
    error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints and intermediate tables are written there)")
        configured = tempfile.mkdtemp(prefix="meterlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    import uuid

    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def broadcast_limit(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES
