"""Audit-table column expressions (G7, G8, G9, G11) and identifier formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the audit model.
STATES = ("queued", "running", "completed", "failed")
FILE_NOTE = "File found. Download file with the `download` API method"
DOWNLOAD_SUFFIX = "_readings.xlsx"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def target_list(text) -> Column:
    """Comma list of stores -> array of trimmed names (empty names kept)."""
    return F.transform(F.split(F.coalesce(_c(text), F.lit("")), ","), lambda x: F.trim(x))


def status_state(status) -> Column:
    """The state word of ``queued|running|completed|failed[: message]``."""
    s = _c(status)
    return F.when(s.startswith("failed"), F.lit("failed")).otherwise(s)


def status_message(status) -> Column:
    """The message after ``failed: `` (null for other states)."""
    s = _c(status)
    return F.when(s.startswith("failed: "), F.substring(s, 9, 1 << 30))


def file_flag(file) -> Column:
    """A note in place of the stored file, null when there is none."""
    return F.when(_c(file).isNotNull(), F.lit(FILE_NOTE))


def uuid_from_key(key) -> Column:
    """Deterministic UUID-formatted id (8-4-4-4-12 hex) from an integer key."""
    h = F.lpad(F.lower(F.hex(_c(key))), 32, "0")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def download_name(created, task_id) -> Column:
    """``{created:yyyy-MM-dd}_{task id hex}_readings.xlsx``."""
    return F.concat(F.date_format(_c(created), "yyyy-MM-dd"), F.lit("_"),
                    F.lower(F.replace(_c(task_id), F.lit("-"), F.lit(""))), F.lit(DOWNLOAD_SUFFIX))


def cpe_code(meter_id) -> Column:
    """A meter code in the ``PT00############04TW`` layout from an integer id."""
    return F.concat(F.lit("PT00"), F.lpad(_c(meter_id).cast("string"), 12, "0"), F.lit("04TW"))
