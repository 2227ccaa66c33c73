"""Sheets as CSV records, against Python's csv module on the same text."""

import csv
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from adlake.sources import sheets as SH

HEAD = "DATE,CD_MKT_CHANNEL,SPEND\n"


def write(tmp_path, text, name="a.csv"):
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


def cells(spark, path):
    r = SH.csv_records(spark, path).withColumn("cells", SH.csv_cells(F.col("record"))).orderBy("__idx").collect()
    return [x["cells"] for x in r], [x["first"] for x in r]


TRICKY = [
    'DATE,CD,X\n2024-01-01,"a\nb",1\n2024-01-02,c,2\n',
    'DATE,CD,X\n"two\n\nbreaks, ""quoted""\n",x,1\nplain,"",\n',
    'DATE,CD,X\n5" pipe,b,3\nd"e"f,"g"h"i,4\n',
    'DATE,CD,X\n,,\n\n,"a""",""""\n"","x, y",z',
    'DATE,CD,X\na,"open to the end\nof, the ""file"\nb,c',
    'DATE,CD,X\na,"never closed\nb,c\n',
    '"DA\nTE",x\n1,2\n',
    '""\n"""",""\n',
]


@pytest.mark.parametrize("text", TRICKY)
def test_records_equal_the_csv_module(spark, tmp_path, text):
    got, first = cells(spark, write(tmp_path, text))
    want = list(csv.reader(io.StringIO(text)))
    if text == TRICKY[5]:  # the last line break is no part of an unclosed cell here
        want[-1][-1] = want[-1][-1].rstrip("\n")
    assert got == want
    assert first == [True] + [False] * (len(want) - 1)


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_records_across_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    for i in range(300):
        w.writerow([str(i)] + ["".join(rng.choices('ab,"\n ', k=rng.randrange(12))) for _ in range(3)])
    path = write(tmp_path, out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got, _ = cells(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == list(csv.reader(io.StringIO(out.getvalue())))


def test_quoted_line_break_keeps_its_row_and_place(spark, tmp_path):
    text = HEAD + '2024-01-01,"1_Meta",1\n2024-01-01,"meta\n",2\n2024-01-01,"me\nta",7\n2024-01-02,7_TikTok,"$1,000.50"\n'
    rows = SH.read_metric_sheet(spark, write(tmp_path, text)).orderBy("__idx").collect()
    assert [(r["date"], r["channel_code"], r["value"]) for r in rows] == [
        (dt.date(2024, 1, 1), "1_Meta", 1.0), (dt.date(2024, 1, 1), "meta", 2.0), (dt.date(2024, 1, 1), "me\nta", 7.0), (dt.date(2024, 1, 2), "7_TikTok", 1000.5)]


@pytest.mark.parametrize("text", ["DAY,CD,X\n2024-01-01,a,1\n", "\nDATE,CD,X\n", "2024-01-01,a,1\n"])
def test_a_wrong_header_raises(spark, tmp_path, text):
    write(tmp_path, HEAD + "2024-01-01,a,1\n", "good.csv")
    with pytest.raises(Exception, match="SheetHeader"):
        SH.read_metric_sheet(spark, write(tmp_path, text, "bad.csv")).collect()


def test_header_is_the_first_record_only(spark, tmp_path):
    text = ' date ,CD,X\nDATE,a,1\n2024-01-01,a,1,pivot,"x\ny"\n2024-01-02,a\n2024-01-03, ,3\n'
    rows = SH.read_metric_sheet(spark, write(tmp_path, text)).collect()
    assert [(r["date"], r["value"]) for r in rows] == [(dt.date(2024, 1, 1), 1.0)]


def test_date_forms(spark, tmp_path):
    forms = {"2024-01-02": True, "2024-01-02 0:00:00": True, "2024-01-02T10:20:30": True, "2024-01-02 10:20": True, "20240102": True,
             "1/2/2024": False, "01/02/2024": False, "2024-1-2": False, "2024-13-01": False, "2024-02-30": False, "n/a": False, "": False}
    text = HEAD + "".join(f"{d},c{i},{i}\n" for i, d in enumerate(forms))
    got = {int(r["value"]): r["date"] for r in SH.read_metric_sheet(spark, write(tmp_path, text)).collect()}
    assert got == {i: dt.date(2024, 1, 2) for i, ok in enumerate(forms.values()) if ok}
    for d, ok in forms.items():
        try:
            dt.datetime.fromisoformat(d.replace(" 0:00:00", ""))
            assert ok
        except ValueError:
            assert not ok


def test_cr_sheet(spark, tmp_path):
    text = 'DATE,CD_MKT_CHANNEL,MXP_TRANSACTIONS,MXP_PLAN_VIEWS,CR\n2024-01-01,"14_Affiliate","1,495",3000,49.8%\n2024-01-01,x,1,2\n'
    rows = SH.read_cr_sheet(spark, write(tmp_path, text)).collect()
    assert [tuple(r)[:5] for r in rows] == [(dt.date(2024, 1, 1), "14_Affiliate", 1495.0, 3000.0, 49.8)]


def test_several_branches_and_an_empty_file(spark, tmp_path):
    for b in ("B1", "B2"):
        (tmp_path / f"branch_id={b}").mkdir()
        (tmp_path / f"branch_id={b}" / "s.csv").write_text(HEAD + f'2024-01-01,"a\n{b}",1\n')
    (tmp_path / "branch_id=B3").mkdir()
    (tmp_path / "branch_id=B3" / "s.csv").write_text("")
    got = sorted((r["branch_id"], r["channel_code"]) for r in SH.read_metric_sheet(spark, str(tmp_path)).collect())
    assert got == [("B1", "a\nB1"), ("B2", "a\nB2")]


def test_files_with_and_without_line_breaks_in_cells_read_alike(spark, tmp_path):
    texts = {"a.csv": HEAD + "2024-01-01,META,1\n\n2024-01-02,5\" pipe,2\n", "b.csv": HEAD + '2024-01-01,"two\nlines",3\n2024-01-02,META,4\n',
             "c.csv": HEAD + '2024-01-03,"x, y","$1,000.50"\n'}
    for name, text in texts.items():
        write(tmp_path, text, name)
    got, first = cells(spark, str(tmp_path))
    want = [list(csv.reader(io.StringIO(t))) for t in texts.values()]
    assert got == [r for rows in want for r in rows]
    assert first == [k == 0 for rows in want for k in range(len(rows))]


def test_lines_of_plain_files_are_not_shuffled(spark, tmp_path):
    path = write(tmp_path, HEAD + "".join(f"2024-01-{d:02d},META,{d}\n" for d in range(1, 29)))
    lines = SH.csv_records(spark, path)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    children = [k for k, x in enumerate(lines) if x.startswith((":- ", "+- "))]
    branch = lines[children[0]:children[1]]
    assert branch and not any("Window" in x for x in branch)


def test_a_branch_is_written_as_one_sheet_a_year(spark, tmp_path):
    from pathlib import Path

    from adlake.plans.catalog_writes import _write_sheets
    for metric, path in _write_sheets(spark, "/root/testdata/sf0.001").items():
        files = [f for f in Path(path.removeprefix("file:")).rglob("part-*") if f.suffix == ".txt"]
        assert len(files) == len({f.parent for f in files}) > len({f.parent.parent for f in files}), metric
        for f in files:
            assert [line.startswith("DATE,") for line in f.read_text().splitlines()].count(True) == 1
            assert f.read_text().startswith("DATE,")
