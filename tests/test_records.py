"""Records split over tasks are the records a reader of whole files finds."""

from __future__ import annotations

import csv
import random
import shutil

import pytest

from ledgerloom.plans import warehouse as plan
from ledgerloom.sources.csv import read_export, read_optional
from ledgerloom.sources.records import csv_records, header_of, read_records
from ledgerloom.sources.registry import ExportFolders

VALUES = ["", "plain", 'a "quoted" word', "two\nlines", "x,y", "three\n\nlines\n", "crlf\r\nin", " sp ", '"', "é日", "'07"]


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, rows, end="\n", mark=""):
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(mark)
        csv.writer(file, lineterminator=end).writerows(rows)


def whole(path, mark="") -> list[tuple]:
    with open(path, newline="", encoding="utf-8") as file:
        file.read(len(mark))
        return [tuple(r) for r in csv.reader(file) if r]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_over_many_splits(spark, small_splits, tmp_path, seed):
    rng = random.Random(seed)
    header = ["Id", "Name", "Note", "Name"]
    files = {"a.csv": ("\n", ""), "b.csv": ("\r\n", ""), "c.csv": ("\n", "﻿")}
    want = []
    for name, (end, mark) in files.items():
        rows = [[f"{name}{i}", *(rng.choice(VALUES) for _ in range(3))] for i in range(rng.randrange(1, 120))]
        write(tmp_path / name, [header, *rows], end, mark)
        want += whole(tmp_path / name, mark)[1:]
    assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 3
    got = read_records(spark, str(tmp_path))
    assert got.columns == ["c0", "c1", "c2", "c3", "surplus_field"]
    rows = [tuple(x or "" for x in r) for r in got.collect()]
    assert sorted(rows) == sorted((*r, "") for r in want)
    assert read_export(spark, str(tmp_path)).columns == ["id", "name", "note", "name_1"]
    named = read_export(spark, str(tmp_path), surplus=True)
    assert named.columns == ["id", "name", "note", "name_1", "surplus_field"]
    assert named.where("id = 'a.csv0'").count() == 1


def test_one_record_over_several_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {i} of a long note" for i in range(400))
    write(tmp_path / "long.csv", [["Id", "Note"], ["1", long], ["2", "x"], ["3", long + '"'], ["4", ""]])
    got = {r["c0"]: r["c1"] for r in read_records(spark, str(tmp_path)).collect()}
    assert got == {"1": long, "2": "x", "3": long + '"', "4": None}
    records = csv_records(spark, str(tmp_path))
    assert sorted(r["record"] for r in records.collect()) == [0, 1, 2, 3, 4]


def test_short_long_and_blank_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('A,B\n1\n\n2,b\n3,c,d\n4,e,,\n"5","f","g ""h""",i\n')
    rows = sorted(tuple(r) for r in read_records(spark, str(tmp_path)).collect())
    assert rows == [("1", None, None), ("2", "b", None), ("3", "c", "d"), ("4", "e", None), ("5", "f", 'g "h"')]


def test_empty_file_other_headers_and_open_quotes(spark, tmp_path):
    for name in ("empty", "header", "two", "open"):
        (tmp_path / name).mkdir()
    (tmp_path / "empty/x.csv").write_text("")
    assert header_of(spark, str(tmp_path / "empty")) == []
    assert read_optional(spark, str(tmp_path / "empty")) is None
    (tmp_path / "header/x.csv").write_text("A,B\n")
    assert read_optional(spark, str(tmp_path / "header")) is None
    assert read_optional(spark, str(tmp_path / "none")) is None
    (tmp_path / "two/x.csv").write_text("A,B\n1,2\n")
    (tmp_path / "two/y.csv").write_text("B,A\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_records(spark, str(tmp_path / "two")).collect()
    (tmp_path / "open/x.csv").write_text('A,B\n1,"2\n3,4\n')
    with pytest.raises(Exception, match="quotes don't add up"):
        read_records(spark, str(tmp_path / "open")).collect()


def test_malformed_rows_are_set_aside(spark, export_folders, tmp_path):
    sample = tmp_path / "sample"
    shutil.copytree(export_folders.sample, sample)
    path = sample / "sample_orders.csv"
    rows = whole(path)
    at = rows[0].index
    bad = [list(r) for r in rows]
    bad[2][at("Lineitem price")] = "ten"
    bad[4][at("Created at")] = "soon"
    bad[4][at("Total")] = "1,0"
    bad[5].append("one more")
    write(path, bad)
    folders = ExportFolders(export_folders.raw, export_folders.reference, str(sample), export_folders.fallback)
    config = plan.WarehouseConfig(folders, str(tmp_path / "out"), quarantine=True)
    tables = plan.build_warehouse(spark, config, use_sample=True)
    assert tables["fact_order"].count() == 2 and tables["raw.orders"].count() == 5
    for found in (tables, plan.read_warehouse(spark, config)):
        reasons = {r["name"]: r["reject_reasons"] for r in found["rejected.orders"].collect()}
        assert reasons == {
            rows[2][at("Name")]: ["lineitem_price is not decimal(18,2): ten"],
            rows[4][at("Name")]: ["total is not decimal(18,2): 1,0", "created_at is not timestamp: soon"],
            rows[5][at("Name")]: ["more fields than headers: one more"],
        }
    assert tables["rejected.recipes"].count() == 0
    strict = plan.WarehouseConfig(folders, str(tmp_path / "other"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        plan.build_warehouse(spark, strict, use_sample=True)
