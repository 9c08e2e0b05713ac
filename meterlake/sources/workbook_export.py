"""Readings exported as workbooks in the layout the source publishes.

The layout: 8 preamble rows, one header row, then date, time and
consumption per reading (plus any later columns). Used to hand readings back
as a download and to build workbook inputs from stored tables.
"""

from __future__ import annotations

import io
import math
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from itertools import groupby
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.plans.joins import lookup_join

# Cell kinds: str -> shared string; ("inline", s) -> inline string; int/float -> number;
# ("date", serial) -> number in the built-in date style; None -> empty.
Cell = object

# Fixed value: rows per worksheet in the .xlsx format -- a workbook (one file,
# one group in ``export_workbooks``) can never hold more.
MAX_SHEET_ROWS = 1_048_576
# Target rows per part when a file is too large for one worksheet: half a
# sheet, so a hash split never comes near MAX_SHEET_ROWS.
PART_ROWS = 500_000
# The MINSTD multiplicative hash (a = 48271, m = 2^31 - 1);
# integer-only, so any SQL engine computes the same part.
_HASH_A, _HASH_M = 48_271, 2_147_483_647

PREAMBLE = ("Readings export", "", "Meter", "", "Period", "", "Unit: kW", "")
HEADER = ("Date", "Time", "Consumption (kW)", "State")

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.'
       'spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-'
       'officedocument.spreadsheetml.worksheet+xml"/>'
       '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-'
       'officedocument.spreadsheetml.sharedStrings+xml"/>'
       '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.'
       'spreadsheetml.styles+xml"/></Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WB = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
       'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
       '<sheets><sheet name="Readings" sheetId="1" r:id="rId1"/></sheets></workbook>')
_WB_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'worksheet" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'sharedStrings" Target="sharedStrings.xml"/>'
            '<Relationship Id="rId3" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'styles" Target="styles.xml"/></Relationships>')
# style 0: general; style 1: built-in date format 14
_STYLES = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
           '<cellStyleXfs count="1"><xf/></cellStyleXfs>'
           '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs>'
           '</styleSheet>')


@cache
def _letters(col: int) -> str:
    name = ""
    col += 1
    while col:
        col, rem = divmod(col - 1, 26)
        name = chr(65 + rem) + name
    return name


def _row_xml(r: int, cells: Sequence[Cell], shared: dict[str, int]) -> str:
    xs = []
    for c, v in enumerate(cells):
        if v is None:
            continue
        ref = f"{_letters(c)}{r + 1}"
        kind = type(v)
        if kind is str:
            idx = shared.setdefault(v, len(shared))
            xs.append(f'<c r="{ref}" t="s"><v>{idx}</v></c>')
        elif kind is float:
            xs.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        elif isinstance(v, tuple) and v[0] == "inline":
            xs.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v[1]))}</t></is></c>')
        elif isinstance(v, tuple) and v[0] == "date":
            xs.append(f'<c r="{ref}" s="1"><v>{v[1]!r}</v></c>')
        elif isinstance(v, bool):
            xs.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)):
            xs.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        else:
            idx = shared.setdefault(str(v), len(shared))
            xs.append(f'<c r="{ref}" t="s"><v>{idx}</v></c>')
    return f'<row r="{r + 1}">{"".join(xs)}</row>'


# Sheet XML is compressed in pieces of about this many characters, so a large
# sheet is never held as one string.
_WRITE_CHUNK = 1 << 16


def workbook_bytes(rows: Iterable[Sequence[Cell]]) -> bytes:
    """A one-sheet .xlsx holding ``rows`` (row 0 is the sheet's first row).

    The sheet is written into the archive row by row (compressed in pieces),
    so memory holds the compressed file and the shared-string table, not the
    sheet's XML text.
    """
    shared: dict[str, int] = {}
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        with z.open("xl/worksheets/sheet1.xml", "w") as f:   # < 2 GiB: a full sheet is ~100 MB
            piece = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                     '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
            size = 0
            for r, cells in enumerate(rows):
                x = _row_xml(r, cells, shared)
                piece.append(x)
                size += len(x)
                if size >= _WRITE_CHUNK:
                    f.write("".join(piece).encode())
                    piece, size = [], 0
            piece.append("</sheetData></worksheet>")
            f.write("".join(piece).encode())
        sst = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
               f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" count="{len(shared)}" '
               f'uniqueCount="{len(shared)}">'
               + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/styles.xml", _STYLES)
    return buf.getvalue()


def iter_readings_sheet(dates: Sequence[str], times: Sequence[str], values: Sequence[float],
                        extra: Sequence[str] | None = None) -> Iterator[list[Cell]]:
    """Rows of a readings workbook, one at a time: preamble, header, then one row per reading."""
    if len(PREAMBLE) + 1 + len(values) > MAX_SHEET_ROWS:
        raise ValueError(f"{len(values)} readings do not fit one worksheet ({MAX_SHEET_ROWS} rows)")
    for p in PREAMBLE:
        yield [p] if p else []
    yield list(HEADER)
    for i, (d, t, v) in enumerate(zip(dates, times, values)):
        row: list[Cell] = [d, ("inline", t), v if isinstance(v, str) else float(v)]
        if extra is not None:
            row.append(extra[i])
        yield row


def readings_sheet(dates: Sequence[str], times: Sequence[str], values: Sequence[float],
                   extra: Sequence[str] | None = None) -> list[list[Cell]]:
    """Rows of a readings workbook: preamble, header, then one row per reading."""
    return list(iter_readings_sheet(dates, times, values, extra))


BLOB_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())])


def part_hash(key: Column | str) -> Column:
    """Integer hash of a non-negative BIGINT key in ``[0, 2^31 - 1)``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.pmod(k.cast("long"), F.lit(_HASH_M)) * F.lit(_HASH_A), F.lit(_HASH_M))


def split_files(readings: DataFrame, file_col: str, key_col: str,
                   part_rows: int = PART_ROWS) -> DataFrame:
    """Spread each file over ``ceil(rows / part_rows)`` parts, ``<dir>/part-<k>/<name>``,
    by a hash of ``key_col``; a file of one part is its ``part-0``.

    Row counts per file are one hash aggregate (reduced map-side, so a hot
    meter-month costs one partial count per task), joined as a size-checked
    lookup of one row per file.
    """
    parts = (readings.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n"))
             .select(file_col, F.ceil(F.col("_n") / F.lit(part_rows)).cast("long").alias("_parts")))
    joined = lookup_join(readings, parts, file_col, "inner")
    f = F.col(file_col)
    part = F.pmod(part_hash(key_col), F.col("_parts"))
    base = F.substring_index(f, "/", -1)
    folder = F.left(f, F.length(f) - F.length(base))
    name = F.concat(folder, F.lit("part-"), part.cast("string"), F.lit("/"), base)
    return joined.withColumn(file_col, name).drop("_parts")


def export_workbooks(readings: DataFrame, file_col: str, order: Sequence[str],
                     date_col: str = "date", time_col: str = "time", value_col: str = "consumption",
                     extra_col: str | None = None, partitions: int | None = None,
                     split_key: str | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """One workbook per distinct ``file_col``: ``path, content`` (in-memory blobs).

    Rows are hash-partitioned by file (an explicit partition count, so AQE
    does not fold the Python work into a few tasks) and sorted within each
    partition; ``mapInArrow`` then renders the files one after another,
    holding at most one file's rows across Arrow batches. Rows without a file are
    left out; a missing value is written as ``nan``. A workbook is
    bounded by the format (``MAX_SHEET_ROWS``; a meter-month of 15-minute
    readings is ~3,000). With ``split_key`` (a BIGINT column) every
    file is first split into parts of about ``part_rows`` rows (``split_files``),
    so a hot meter-month becomes several bounded workbooks in several tasks.
    """
    cols = list(dict.fromkeys([file_col, *order, date_col, time_col, value_col]
                              + ([extra_col] if extra_col else [])))
    spark = readings.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if split_key is not None:
        readings = split_files(readings.select(*dict.fromkeys([*cols, split_key])), file_col, split_key,
                                  part_rows)
    prepared = readings.select(*cols).filter(F.col(file_col).isNotNull()).repartition(n, file_col).sortWithinPartitions(file_col, *order)

    names = [date_col, time_col, value_col] + ([extra_col] if extra_col else [])

    def build(batches):
        import pyarrow as pa

        # rows arrive sorted by file: one file's rows are held, and the files that end in a batch
        name, held = None, [[] for _ in names]
        for b in batches:
            paths, blobs = [], []
            files, values = b.column(file_col).to_pylist(), [b.column(c).to_pylist() for c in names]
            values[2] = [math.nan if v is None else v for v in values[2]]
            for file, run in groupby(range(len(files)), files.__getitem__):
                if name is not None and file != name:
                    paths.append(name)
                    blobs.append(workbook_bytes(iter_readings_sheet(*held)))
                    held = [[] for _ in names]
                name, first = file, next(run)
                last = first + 1 + sum(1 for _ in run)
                for have, new in zip(held, values):
                    have += new[first:last]
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(blobs, pa.binary())], ["path", "content"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()),
                                              pa.array([workbook_bytes(iter_readings_sheet(*held))], pa.binary())], ["path", "content"])

    return prepared.mapInArrow(build, BLOB_SCHEMA)
