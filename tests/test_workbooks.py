"""Workbook source (A1, A2, A4): decoding cells, the reference layout, quarantine."""

import datetime as dt
import os

from pyspark.sql import functions as F

from meterlake.operators.readings import parse_readings
from meterlake.sources import workbook_export as wx
from meterlake.sources import workbooks as wb


def _serial(d: dt.datetime) -> float:
    return (d - dt.datetime(1899, 12, 30)).total_seconds() / 86400


def _sheet(values, dated=False):
    rows = [[p] if p else [] for p in wx.PREAMBLE]
    rows.append(list(wx.HEADER))
    start = dt.datetime(2023, 5, 1)
    for i, v in enumerate(values):
        t = start + dt.timedelta(minutes=15 * i)
        if dated:
            rows.append([("date", _serial(t.replace(hour=0, minute=0))), ("date", round(_serial(t) % 1, 10)), v, "extra"])
        else:
            rows.append([t.strftime("%Y/%m/%d"), ("inline", t.strftime("%H:%M")), v, "extra"])
    return rows


def test_decode_cell_kinds():
    rows = wb.decode_workbook(wx.workbook_bytes([["a", ("inline", "b"), 1.5, None, True],
                                                 [("date", 45047.0), ("date", 0.25), ("date", 45047.5)]]))
    assert rows[0] == (0, ["a", "b", "1.5", None, "TRUE"])
    assert rows[1] == (1, ["2023-05-01", "06:00:00", "2023-05-01 12:00:00"])


def test_read_workbooks_reference_layout(spark, tmp_dir):
    d = os.path.join(tmp_dir, "landing")
    os.makedirs(d)
    values = [0.125, 1.5, "1,000.25", 2.0]
    with open(os.path.join(d, "2023_5_abcdef12_readings.xlsx"), "wb") as f:
        f.write(wx.workbook_bytes(_sheet(values)))
    with open(os.path.join(d, "2023_5_00000001_readings.xlsx"), "wb") as f:
        f.write(wx.workbook_bytes(_sheet([1.0, "n/a"], dated=True)))
    with open(os.path.join(d, "broken_readings.xlsx"), "wb") as f:
        f.write(b"not a zip")
    raw = wb.read_workbooks(spark, d)
    good, bad = parse_readings(raw, F.lit("PT00000000000104TW"))
    rows = good.filter(F.col("file").contains("abcdef12")).orderBy("row").collect()
    assert [r["consumption"] for r in rows] == [0.125, 1.5, 1000.25, 2.0]
    assert rows[0]["date_time"] == dt.datetime(2023, 5, 1, 0, 0) and rows[0]["row"] == 9
    assert rows[3]["date_time"] == dt.datetime(2023, 5, 1, 0, 45)
    assert abs(sum(r["consumption"] for r in rows) - 1003.875) < 1e-9
    dated = good.filter(F.col("file").contains("00000001")).collect()
    assert [(r["date_time"], r["consumption"]) for r in dated] == [(dt.datetime(2023, 5, 1), 1.0)]
    assert sorted((r["row"] < 0, r["consumption"]) for r in bad.collect()) == [(False, "n/a"), (True, None)]
    assert raw.filter(F.col("row") == -1).count() == 1          # unreadable file is marked, not lost
    prov = raw.select(wb.file_provenance("file").alias("p")).filter(F.col("p.session") == "abcdef12").first()
    assert (prov["p"]["year"], prov["p"]["month"]) == (2023, 5)


def test_file_blobs_prunes_content(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.xlsx")
    open(p, "wb").write(b"12345")
    df = wb.file_blobs(spark, tmp_dir).select("path", "length")
    assert [r["length"] for r in df.collect()] == [5]


def test_export_workbooks_round_trip(spark):
    rows = spark.createDataFrame([("f1", 2, "2024-01-01", "00:30", 2.5), ("f1", 1, "2024-01-01", "00:15", 1.5),
                                  ("f2", 1, "2024-01-02", "00:15", 3.0)],
                                 "file string, n int, date string, time string, consumption double")
    blobs = wx.export_workbooks(rows, "file", ["n"], partitions=2)
    good, bad = parse_readings(wb.decode_workbooks(blobs), "PT")
    got = sorted((r["file"], r["row"], r["consumption"]) for r in good.collect())
    assert got == [("f1", 9, 1.5), ("f1", 10, 2.5), ("f2", 9, 3.0)]
    assert bad.count() == 0


def test_oversize_files_split_into_parts_match_sql(spark):
    """A meter-month over the part bound becomes several workbooks; same rows as the SQL form."""
    import duckdb

    from conftest import SF_SMALL
    from meterlake.plans import catalog
    from meterlake.sources.tables import TABLES

    part_rows = 4
    df = catalog.a1_workbooks(spark, SF_SMALL, part_rows=part_rows)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) if c == "date_time" else r[c] for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    res = con.execute(catalog.a1_sql(part_rows))
    ocols = [d[0] for d in res.description]
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(str(r[i]) if cols[k] == "date_time" else r[i] for k, i in enumerate(idx))
                  for r in res.fetchall())
    assert got == want
    files = {r[cols.index("file")] for r in got}
    assert any("/part-" in f for f in files)
    n_events = con.execute("SELECT count(*) FROM events").fetchone()[0]
    assert len(got) == n_events                       # nothing dropped by the split


def test_every_file_splits_by_one_naming_rule(spark):
    rows = spark.createDataFrame([("d/f1", i, "2024-01-01", "00:15", 1.0) for i in range(10)]
                                 + [("d/f2", 1, "2024-01-02", "00:15", 3.0)],
                                 "file string, n long, date string, time string, consumption double")
    out = wx.split_files(rows, "file", "n", part_rows=3)
    names = sorted({r["file"] for r in out.collect()})
    assert "d/part-0/f2" in names and sum(n.endswith("/f1") for n in names) > 1
    assert all(n.startswith("d/part-") for n in names)
    assert out.count() == 11


def test_rows_split_across_reads():
    sheet = [["a", ("inline", "b"), 1.5, None, True, False],
             [("date", 45047.0), ("date", 0.25), ("date", 45047.5), "x & <y>"]] + \
        [["2024/01/01", ("inline", f"{i % 24:02d}:15"), i * 0.5, "state"] for i in range(500)]
    blob = wx.workbook_bytes(sheet)
    rows = wb.decode_workbook(blob)
    assert list(wb.iter_workbook_rows(blob, chunk=997)) == rows
    assert rows[0] == (0, ["a", "b", "1.5", None, "TRUE", "FALSE"])
    assert rows[1] == (1, ["2023-05-01", "06:00:00", "2023-05-01 12:00:00", "x & <y>"])


def _package(sheet: str, strings: str = "", book: str = "", ns: str = "http://purl.oclc.org/ooxml/spreadsheetml/main"):
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}">{book}</workbook>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{ns}">{strings}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{ns}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{ns}"><sheetData>{sheet}</sheetData></worksheet>')
    return out.getvalue()


def test_foreign_sheets():
    """Strict namespace, 1904 dates, phonetic hints, empty values, bad references and serials."""
    blob = _package(
        '<row r="9"><c t="s"><v>0</v></c><c s="1"><v>1.0</v></c><c t="s"><v>7</v></c></row>'
        '<row><c s="1"><v>1e12</v></c><c><v></v></c><c t="s"></c></row>',
        "<si><r><t>ab</t></r><rPh><t>HINT</t></rPh><r><t>c</t></r></si>", '<workbookPr date1904="1"/>')
    assert wb.decode_workbook(blob) == [(8, ["abc", "1904-01-02", "7"]), (9, ["1e12", None, None])]


def test_bad_files_reach_the_quarantine(spark):
    good = _package('<row r="10"><c t="str"><v>2024-01-01</v></c><c t="str"><v>00:15</v></c><c><v>1.5</v></c></row>'
                    '<row r="11"><c t="str"><v>no date</v></c><c t="str"><v>00:15</v></c><c><v>1.5</v></c></row>')
    cut = bytearray(wx.workbook_bytes([["x"] * 5] * 300))
    cut[len(cut) // 3] ^= 0xFF
    broken = _package("<row><c></row>")
    blobs = spark.createDataFrame([("/l/A/a", bytearray(good)), ("/l/B/b", bytearray(b"not a zip")), ("/l/C/c", cut),
                                   ("/l/D/d", bytearray(broken))], "path string, content binary")
    readings, bad = parse_readings(wb.decode_workbooks(blobs), "PT")
    assert [(r["file"], r["consumption"]) for r in readings.collect()] == [("/l/A/a", 1.5)]
    got = sorted((r["file"], r["row"]) for r in bad.collect())
    assert got == [("/l/A/a", 10), ("/l/B/b", -1), ("/l/C/c", -1), ("/l/D/d", -1)]
    assert all(r["reason"] for r in bad.collect())


def test_export_file_spanning_many_arrow_batches(spark):
    rows = spark.createDataFrame(
        [("f1", i, "2024-01-01", f"{i // 4:02d}:{i % 4 * 15:02d}", float(i)) for i in range(11)]
        + [("f2", i, "2024-01-02", "00:15", 100.0 + i) for i in range(2)]
        + [("f3", 0, "2024-01-03", "00:15", 7.0)],
        "file string, n int, date string, time string, consumption double")
    prev = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        blobs = wx.export_workbooks(rows, "file", ["n"], partitions=1)
        got = sorted((r["file"], r["row"], r["consumption"])
                     for r in parse_readings(wb.decode_workbooks(blobs), "PT")[0].collect())
        n_files = blobs.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", prev)
    assert n_files == 3
    assert got == sorted([("f1", 9 + i, float(i)) for i in range(11)] + [("f2", 9 + i, 100.0 + i) for i in range(2)]
                         + [("f3", 9, 7.0)])


def test_any_damage_is_the_files_own(spark):
    """Every kind of damage gives one marker row with its reason; the other files are read."""
    from meterlake.plans.catalog import _damaged_workbooks

    good = spark.createDataFrame([("/landing/A/ok.xlsx", wx.workbook_bytes(_sheet([1.0])))], "path string, content binary")
    raw = wb.decode_workbooks(_damaged_workbooks(spark).unionByName(good))
    bad = {r["file"].rsplit("/", 1)[1]: r["cells"][0] for r in raw.filter("row < 0").collect()}
    assert sorted(bad) == ["cut.xlsx", "format.xlsx", "text.xlsx", "wide.xlsx"]
    assert bad["format.xlsx"].startswith("TypeError") and "16384" in bad["wide.xlsx"]
    assert parse_readings(raw, F.lit("A"))[0].count() == 1
    assert wb.decode_workbook(wx.workbook_bytes([[None] * 20 + ["last"]]))[0][1][20] == "last"


def test_files_written_share_folders(spark, tmp_dir):
    rows = [(f"{i:04d}", f"text {i}") for i in range(300)] + [("0007", "more"), (None, "x"), ("0300", None), ("0301", "é\nb")]
    path = os.path.join(tmp_dir, "files")
    folders = wb.write_files(spark.createDataFrame(rows, "name string, text string").coalesce(1), path)
    listed = os.listdir(path)
    assert 0 < len(listed) <= folders < 20
    assert not [f for d in listed for f in os.listdir(os.path.join(path, d)) if f.startswith(".")]
    blobs = wb.file_blobs(spark, path, glob=wb.WRITTEN_FILES).coalesce(folders)
    found = {r["path"].rsplit("/", 1)[1]: (r["length"], bytes(r["content"])) for r in blobs.collect()}
    assert len(found) == 303
    assert found["0007.txt"] == (12, b"text 7\nmore\n")      # rows of one name are lines of one file
    assert found["none.txt"] == (2, b"x\n") and found["0300.txt"] == (1, b"\n")
    assert found["0301.txt"][1] == "é\nb\n".encode()


def test_file_query_reads_documents_with_few_folders(spark, tmp_dir):
    import hashlib

    from meterlake.plans import catalog

    spark.range(500).selectExpr("id AS doc_id", "concat('document ', id) AS text").write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    found = catalog.QUERIES["a2_file_blobs"](spark, tmp_dir)
    assert {tuple(r) for r in found.collect()} == {
        (f"{i:012d}", len(f"document {i}\n"), hashlib.sha256(f"document {i}\n".encode()).hexdigest()) for i in range(500)}
    assert found.rdd.getNumPartitions() <= 4      # not a task for every few files


def test_files_are_read_some_folders_at_a_time(spark, tmp_dir, monkeypatch):
    from meterlake.plans import catalog

    read, listed = [], wb.file_blobs

    def seen(spark, path, *more):
        read.append(path)
        return listed(spark, path, *more)

    monkeypatch.setattr(wb, "file_blobs", seen)
    path = os.path.join(tmp_dir, "files")
    rows = [(f"{i:04d}", f"text {i}") for i in range(200)]
    wb.write_files(spark.createDataFrame(rows, "name string, text string"), path)
    assert len(os.listdir(path)) == 4
    found = wb.grouped_blobs(spark, path, lambda b: b.select(F.col("content").cast("string").alias("text")), wb.WRITTEN_FILES, folders=3)
    assert [len(paths) for paths in read] == [3, 1]     # the driver never lists more than a group's files
    assert sorted(r.text for r in found.collect()) == sorted(f"{text}\n" for _, text in rows)
    assert wb.grouped_blobs(spark, os.path.join(tmp_dir, "none"), lambda b: b.select("length")).collect() == []

    read.clear()
    monkeypatch.setattr(wb, "FOLDERS_A_GROUP", 1)
    spark.range(100).selectExpr("id AS doc_id", "concat('document ', id) AS text").write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    assert catalog.QUERIES["a2_file_blobs"](spark, tmp_dir).count() == 100
    assert [len(paths) for paths in read] == [1] * 4
