"""Monthly readings workbooks (.xlsx) as a Spark source (A1, A2, A4).

``binaryFile`` lists and reads the files (one file per row, partitions sized
by ``spark.sql.files.maxPartitionBytes``); ``mapInArrow`` decodes each
workbook's first sheet into raw rows ``file, row, cells`` -- cells as text by
position. Typing and keying happen afterwards as column expressions
(``operators.readings``).
"""

from __future__ import annotations

import datetime as dt
import gc
import io
import os
import re
import xml.parsers.expat
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.session import scratch_path

RAW_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

# Built-in number formats that are dates or times (ECMA-376 18.8.30).
_BUILTIN_DATE_FORMATS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = dt.datetime(1899, 12, 30)
_EPOCH_1904 = dt.datetime(1904, 1, 1)      # of workbooks marked date1904

# Fixed value: the file name the fetcher gives a downloaded month.
PROVENANCE_PATTERN = r"(?:^|/)([0-9]{4})_([0-9]{1,2})_([0-9A-Fa-f]{8})_readings\.xlsx$"


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
    return bool(re.search(r"[dmyhs]", code, re.IGNORECASE))


def _serial_text(value: float, epoch: dt.datetime = _EPOCH) -> str:
    t = epoch + dt.timedelta(days=value)
    t = t.replace(microsecond=0) if t.microsecond < 500000 else (t + dt.timedelta(seconds=1)).replace(microsecond=0)
    if value < 1:
        return t.strftime("%H:%M:%S")
    if float(value).is_integer():
        return t.strftime("%Y-%m-%d")
    return t.strftime("%Y-%m-%d %H:%M:%S")


def _local(e: ET.Element) -> str:
    """Element name without its namespace (transitional or strict)."""
    return e.tag.rpartition("}")[2]


def _all(root: ET.Element, name: str) -> list[ET.Element]:
    return [e for e in root.iter() if _local(e) == name]


def _part(z: zipfile.ZipFile, name: str) -> ET.Element | None:
    return ET.fromstring(z.read(name)) if name in z.NameToInfo else None


def _first_sheet(z: zipfile.ZipFile, book: ET.Element | None) -> str:
    rels = _part(z, "xl/_rels/workbook.xml.rels")
    sheets = _all(book, "sheet") if book is not None else []
    if sheets and rels is not None:
        rid = next((v for k, v in sheets[0].attrib.items() if k.endswith("}id")), None)
        for rel in _all(rels, "Relationship"):
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    return "xl/worksheets/sheet1.xml"


def _epoch(book: ET.Element | None) -> dt.datetime:
    marks = _all(book, "workbookPr") if book is not None else []
    return _EPOCH_1904 if marks and marks[0].get("date1904") in ("1", "true") else _EPOCH


def _plain_text(item: ET.Element) -> str:
    """Text of a string item: its own and its runs', without phonetic hints."""
    out = []
    for part in item:
        if _local(part) == "t":
            out.append(part.text or "")
        elif _local(part) == "r":
            out += [t.text or "" for t in part if _local(t) == "t"]
    return "".join(out)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    root = _part(z, "xl/sharedStrings.xml")
    return [_plain_text(si) for si in root if _local(si) == "si"] if root is not None else []


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    root = _part(z, "xl/styles.xml")
    if root is None:
        return set()
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in _all(root, "numFmt")}
    used = [xf for group in _all(root, "cellXfs") for xf in group if _local(xf) == "xf"]
    ids = [int(xf.get("numFmtId", "0")) for xf in used]
    return {i for i, fid in enumerate(ids)
            if fid in _BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid]))}


def _cell_value(t: str, style: int, v: str | None, inline: str | None,
                strings: list[str], dates: set[int], epoch: dt.datetime = _EPOCH) -> str | None:
    """A cell as text from its type, style, ``<v>`` text and inline-string text.

    An empty ``<v>`` is no value. A serial or a string number that can't be
    resolved stays as its raw text.
    """
    v = v or None
    if t == "n":
        if v is not None and style in dates:
            try:
                return _serial_text(float(v), epoch)
            except (ValueError, OverflowError):
                return v
        return v
    if t == "s":
        known = v is not None and v.isdecimal() and int(v) < len(strings)
        return strings[int(v)] if known else v
    if t == "inlineStr":
        return inline or ""
    if t == "b":
        return None if v is None else ("TRUE" if v == "1" else "FALSE")
    return v            # str (formula text), e (error)


_ROW, _CELL, _VALUE, _TEXT, _HINT = 1, 2, 3, 4, 5
_TAGS = {"row": _ROW, "c": _CELL, "v": _VALUE, "t": _TEXT, "rPh": _HINT}


MAX_COLUMNS = 16_384    # of a sheet, by the format


class _SheetRows:
    """Streaming reader of a worksheet's XML (``expat`` callbacks, no element tree).

    Completed rows collect in ``done``; the caller feeds the XML in chunks and
    drains ``done`` after each, so memory holds a chunk's rows, not the sheet.
    """

    def __init__(self, strings: list[str], dates: set[int], epoch: dt.datetime = _EPOCH):
        self.strings, self.dates, self.epoch = strings, dates, epoch
        self.phonetic = 0
        self.done: list[tuple[int, list[str | None]]] = []
        self.row: dict[int, str | None] | None = None
        self.r = -1
        self.n_cells = 0
        self.cell: list | None = None       # [col, type, style, v text, inline text]
        self.buf: list[str] | None = None
        self.tags: dict[str, int] = {}       # element name (any prefix) -> kind
        self.cols: dict[str, int] = {}       # column letters -> index
        self.parser = xml.parsers.expat.ParserCreate()
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self._start
        self.parser.EndElementHandler = self._end
        self.parser.CharacterDataHandler = self._data

    def _kind(self, name: str) -> int:
        kind = self.tags.get(name)
        if kind is None:
            kind = self.tags[name] = _TAGS.get(name.rpartition(":")[2], 0)
        return kind

    def _start(self, name: str, attrs: dict) -> None:
        kind = self._kind(name)
        if kind == _CELL and self.row is not None:
            ref = attrs.get("r")
            if ref:
                letters = ref.rstrip("0123456789")
                col = self.cols.get(letters)
                if col is None:
                    col = _col_index(letters)
                    if col >= MAX_COLUMNS:
                        raise ValueError(f"cell {ref} lies beyond the {MAX_COLUMNS} columns of a sheet")
                    self.cols[letters] = col
            else:
                col = self.n_cells
            self.n_cells += 1
            style = attrs.get("s", "0")
            self.cell = [col, attrs.get("t", "n"), int(style) if style.isdecimal() else 0, None, None]
        elif kind == _HINT:
            self.phonetic += 1
        elif kind == _ROW:
            self.r = int(attrs["r"]) - 1 if "r" in attrs else self.r + 1
            self.row, self.n_cells = {}, 0
        elif (kind == _VALUE or kind == _TEXT) and self.cell is not None and not self.phonetic:
            self.buf = []

    def _data(self, text: str) -> None:
        if self.buf is not None:
            self.buf.append(text)

    def _end(self, name: str) -> None:
        kind = self._kind(name)
        if kind == _CELL:
            if self.cell is not None:
                self.row[self.cell[0]] = _cell_value(*self.cell[1:], self.strings, self.dates, self.epoch)
                self.cell = None
        elif kind == _HINT:
            self.phonetic -= 1
        elif kind == _VALUE or kind == _TEXT:
            if self.buf is not None:
                text = "".join(self.buf)
                self.buf = None
                if kind == _VALUE:
                    self.cell[3] = text
                else:
                    self.cell[4] = (self.cell[4] or "") + text
        elif kind == _ROW and self.row is not None:
            row = self.row
            self.done.append((self.r, [row.get(i) for i in range(max(row) + 1)] if row else []))
            self.row = None


def iter_workbook_rows(content: bytes, chunk: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """First sheet of an .xlsx as ``(row_index_0_based, cells_as_text)``, row by row.

    The sheet is read in ``chunk``-byte pieces through a streaming parser, so
    memory holds the rows of one piece, never the tree of a sheet that may have
    1,048,576 rows. Shared, inline and formula strings are returned as text;
    numbers in a date or time style as ``yyyy-MM-dd``, ``HH:mm:ss`` or both;
    other numbers as written in the file; booleans as ``TRUE``/``FALSE``. A cell
    that can't be resolved keeps its raw text, which typing then quarantines.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = _part(z, "xl/workbook.xml")
        reader = _SheetRows(_shared_strings(z), _date_styles(z), _epoch(book))
        with z.open(_first_sheet(z, book)) as f:
            while True:
                data = f.read(chunk)
                reader.parser.Parse(data, not data)
                if reader.done:
                    yield from reader.done
                    reader.done = []
                if not data:
                    break


def decode_workbook(content: bytes) -> list[tuple[int, list[str | None]]]:
    """All rows of the first sheet (see ``iter_workbook_rows``); for one small file."""
    return list(iter_workbook_rows(content))


# Rows per output frame of the decoder: bounds the Python memory of one task
# whatever the number of workbooks in an input Arrow batch.
DECODE_CHUNK_ROWS = 65_536


def _file_rows(content: bytes) -> Iterator[tuple[int, list[str | None] | None]]:
    """Rows of one file; an error ends it with a marker row ``(-1, [reason])``.

    Whatever a damaged or foreign file raises is that file's error, not the job's.
    """
    try:
        yield from iter_workbook_rows(content)
    except Exception as e:
        yield -1, [f"{type(e).__name__}: {e}"]


def _decode_batches(batches):
    import pyarrow as pa

    def frame(files, rows, cells):
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(rows, pa.int32()),
                                           pa.array(cells, pa.list_(pa.string()))], ["file", "row", "cells"])

    files, rows, cells = [], [], []
    for b in batches:
        for path, content in zip(b.column(0), b.column(1)):
            path = path.as_py()
            for r, cs in _file_rows(content.as_py()):
                files.append(path)
                rows.append(r)
                cells.append(cs)
                if len(rows) >= DECODE_CHUNK_ROWS:
                    yield frame(files, rows, cells)
                    files, rows, cells = [], [], []
    if rows:
        yield frame(files, rows, cells)


FILES_A_FOLDER = 2000    # about as many files share a folder
FOLDERS_A_GROUP = 50     # folders whose files the driver lists and plans at once
WRITTEN_FILES = "{*.txt,part-*}"    # files of ``write_files``, whoever writes them


def write_files(lines: DataFrame, path: str) -> int:
    """Every ``name`` of ``lines`` (``name, text``) as a file ``<path>/<folder>/<name>.txt``.

    The rows of a name are its lines, in the order of ``lines``; a null text is an empty
    line, a null name counts as ``none``. A folder holds the files of one task, so that
    listing them takes a step per folder. Where the path is a shared disk the tasks write
    the files themselves, each under a hidden name first, so a repeated task leaves whole
    files: Hadoop's local file system starts several processes for every file that it
    makes. On any other file system Spark's writer makes a folder for each file.
    Returns the number of folders.
    """
    spark = lines.sparkSession
    rows = lines.select(F.coalesce("name", F.lit("none")).alias("name"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("_at"))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri()
    folders = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // FILES_A_FOLDER))
    sorted_rows = rows.repartition(folders, "name").sortWithinPartitions("name", "_at")
    if uri.getScheme() != "file":
        (sorted_rows.select("text", F.concat("name", F.lit(".txt")).alias("name"), F.spark_partition_id().alias("folder"))
         .write.partitionBy("folder", "name").text(path))
        return folders
    root = uri.getPath()

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        folder = os.path.join(root, str(task.partitionId()))
        hidden = os.path.join(folder, f".{task.taskAttemptId()}")
        name, out = None, None
        for b in batches:
            for new, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if new != name:
                    if out is None:
                        os.makedirs(folder, exist_ok=True)
                    else:
                        out.close()
                        os.replace(hidden, os.path.join(folder, f"{name}.txt"))
                    name, out = new, open(hidden, "wb")
                out.write(text)
                out.write(b"\n")
        if out is not None:
            out.close()
            os.replace(hidden, os.path.join(folder, f"{name}.txt"))
        yield from ()

    sorted_rows.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()
    return folders


def file_blobs(spark: SparkSession, path: str | list[str], glob: str = "*.xlsx", recursive: bool = True) -> DataFrame:
    """A2: whole files as bytes: ``path, modificationTime, length, content``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(path))


def grouped_blobs(spark: SparkSession, path: str, made: Callable[[DataFrame], DataFrame], glob: str = "*.xlsx",
                  folders: int | None = None) -> DataFrame:
    """``made`` of the blobs of every file in the folders of ``path``, written to the shared folder and read back.

    The driver of a ``binaryFile`` read holds every file's status and place in the plan (0.7 kB a
    file, and more while it plans), so the folders are taken some at a time: it never holds
    more than the files of one group, whatever their number. Each group is read in as many
    tasks as it has folders, where Spark would plan one for every few files. ``made`` works
    row by row. Files beside the folders are not read.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = fs.listStatus(root) if fs.exists(root) else []
    found = sorted(f.getPath().toString() for f in listed if f.isDirectory() and f.getPath().getName()[0] not in "._")
    schema = made(spark.createDataFrame([], BINARY_FILE_SCHEMA)).schema
    out, folders = scratch_path(spark, "blobs"), folders or FOLDERS_A_GROUP
    # Else statuses of files read before stay in a cache of the driver.
    cached = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(cached)
    spark.conf.set(cached, "false")
    try:
        for i in range(0, len(found), folders):
            group = found[i:i + folders]
            made(file_blobs(spark, group, glob).coalesce(len(group))).write.mode("append").parquet(out)
            gc.collect()    # py4j's objects refer to themselves: until they go, the driver holds the plan of the group
    finally:
        spark.conf.set(cached, before)
    return spark.read.schema(schema).parquet(out) if found else spark.createDataFrame([], schema)


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def workbook_stream(spark: SparkSession, path: str, glob: str = "*.xlsx", **options) -> DataFrame:
    """Arriving workbooks as a file stream (``binaryFile`` needs its schema given)."""
    return (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", glob).options(**options).load(path))


def decode_workbooks(blobs: DataFrame) -> DataFrame:
    """Workbook blobs ``path, content`` -> raw rows ``file, row, cells`` (Arrow batches, per partition)."""
    return blobs.select("path", "content").mapInArrow(_decode_batches, RAW_SCHEMA)


def read_workbooks(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """A1: every workbook under ``path`` -> raw rows ``file, row, cells``.

    A row with ``row = -1`` marks a file that could not be read (to its end); its cell is the reason.
    """
    return decode_workbooks(file_blobs(spark, path, glob))


def file_provenance(path: Column | str) -> Column:
    """A4: struct(year, month, session) recovered from ``{year}_{month}_{session8}_readings.xlsx``."""
    p = F.col(path) if isinstance(path, str) else path
    ok = p.rlike(PROVENANCE_PATTERN)
    return F.struct(
        F.when(ok, F.regexp_extract(p, PROVENANCE_PATTERN, 1).cast("int")).alias("year"),
        F.when(ok, F.regexp_extract(p, PROVENANCE_PATTERN, 2).cast("int")).alias("month"),
        F.when(ok, F.lower(F.regexp_extract(p, PROVENANCE_PATTERN, 3))).alias("session"),
    )


def provenance_name(year, month, session) -> Column:
    """The fetcher's file name for a month (inverse of ``file_provenance``)."""
    c = [F.col(x) if isinstance(x, str) else x for x in (year, month, session)]
    return F.concat(c[0].cast("string"), F.lit("_"), c[1].cast("string"), F.lit("_"), c[2],
                    F.lit("_readings.xlsx"))
