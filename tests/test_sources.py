import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from floortally.operators.asof import DAILY
from floortally.plans import lost_sales
from floortally.sources import csv_days, sinks, tables, tenants

HEADER = "UserID,InDateTime,OutDateTime,Date\n"


@pytest.fixture
def drops(tmp_path):
    for day, text in {
        "2024-01-02": "﻿" + HEADER + "E1,2024-01-01 10:00:00,2024-01-01 20:00:00,2024-01-01\n",
        "2024-01-04": HEADER + 'E2,,"2024-01-03 20:00:00",2024-01-03\n',
        "2024-01-09": HEADER + "E3,x,y,z\n",
    }.items():
        folder = tmp_path / "drops" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "attendance.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "drops")


def test_dated_csv_reads_only_the_days_asked_for(spark, drops):
    df = csv_days.read_days(spark, drops, dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    assert {(r.UserID, r.InDateTime, r.day) for r in df.collect()} == {
        ("E1", "2024-01-01 10:00:00", dt.date(2024, 1, 2)),
        ("E2", None, dt.date(2024, 1, 4)),
    }
    assert "day=2024-01-09" not in str(df.inputFiles()) and len(df.inputFiles()) == 2


def test_dated_csv_errors(spark, drops):
    with pytest.raises(ValueError):
        csv_days.read_days(spark, drops, dt.date(2024, 1, 5), dt.date(2024, 1, 1))
    with pytest.raises(FileNotFoundError):
        csv_days.read_days(spark, drops, dt.date(2023, 1, 1), dt.date(2023, 1, 5))


def test_dated_csv_finds_columns_by_each_files_header(spark, tmp_path):
    for day, text in {
        "2024-02-01": "Name,UserID,Date,InDateTime,OutDateTime\nAnn,E1,2024-02-01,in,out\n",
        "2024-02-02": "OutDateTime,InDateTime,Date,UserID\nout2,in2,2024-02-02,E2\n",
        "2024-02-03": "UserID,Date\nE3,2024-02-03\n",
    }.items():
        folder = tmp_path / f"day={day}"
        folder.mkdir()
        (folder / "a.csv").write_text(text, encoding="utf-8")
    df = csv_days.read_days(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 2, 2))
    assert {tuple(r)[:4] for r in df.collect()} == {("E1", "in", "out", "2024-02-01"), ("E2", "in2", "out2", "2024-02-02")}
    with pytest.raises(ValueError, match="no header"):
        csv_days.read_days(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 2, 3))


def test_every_file_is_read_in_its_own_dialect(spark, tmp_path):
    wide = ",".join([f"x{i}" for i in range(298)] + ["UserID", "InDateTime"] + [f"y{i}" for i in range(20)] + ["Date", "OutDateTime"])
    files = {
        "01/comma.csv": (HEADER + 'E1,in,out,"1 Feb, 2024"\r\n').encode(),
        "02/semicolon.csv": "OutDateTime;Name;UserID;Date;InDateTime\nout;Ann;E1;1 Feb, 2024;in\n".encode(),
        "03/mark.CSV": ("\ufeff" + HEADER + 'E1,in,out,"1 Feb, 2024"\n').encode(),
        "04/latin.csv": "Stra\xdfe\tUserID\tInDateTime\tOutDateTime\tDate\nM\xfcller\tE1\tin\tout\t1 Feb, 2024\n".encode("latin-1"),
        "05/wide.csv": (wide + "\n" + "," * 298 + "E1,in" + "," * 20 + ',"1 Feb, 2024",out\n').encode(),
        "06/utf16.csv": (HEADER + 'E1,in,out,"1 Feb, 2024"\n').encode("utf-16"),
        "07/pipe.csv": "UserID|InDateTime|OutDateTime|Date|Date\nE1|in|out|1 Feb, 2024|no\n".encode(),
        "08/zipped.csv.gz": gzip.compress(("\n" + HEADER + 'E1,in,out,"1 Feb, 2024"\n').encode()),
        "09/empty.csv": HEADER.encode(),
        "09/_notes.txt": b"no data",
    }
    for name, data in files.items():
        path = tmp_path / f"day=2024-02-{name}"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(data)
    drops = csv_days.read_drops(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 2, 9))
    assert drops.rows.columns == ["UserID", "InDateTime", "OutDateTime", "Date", "day"]
    got = sorted(tuple(r) for r in drops.rows.collect())
    assert got == [("E1", "in", "out", "1 Feb, 2024", dt.date(2024, 2, d)) for d in range(1, 9)]
    assert drops.malformed.count() == 0


def test_malformed_rows_have_a_table_of_their_own(spark, tmp_path):
    late = HEADER + "E0,a,b,c\n" * 9000
    for day, data in {"01": (HEADER + "E1,a,b,c\nE2,a\nE3,a,b,c,d\n,,,\n").encode(), "02": late.encode() + "M\xfc,a,b,c\n".encode("latin-1")}.items():
        (tmp_path / f"day=2024-02-{day}").mkdir()
        (tmp_path / f"day=2024-02-{day}" / "a.csv").write_bytes(data)
    drops = csv_days.read_drops(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 2, 2))
    assert drops.rows.count() == 9002 and drops.rows.where("UserID = 'E1'").count() == 1
    bad = sorted((r.day.day, r.file[-5:], r.line) for r in drops.malformed.collect())
    assert [b[:2] for b in bad] == [(1, "a.csv"), (1, "a.csv"), (2, "a.csv")]
    assert [b[2] for b in bad[:2]] == ["E2,a", "E3,a,b,c,d"]


def test_files_of_one_header_share_a_reader(spark, tmp_path):
    for day in range(1, 6):
        (tmp_path / f"day=2024-02-0{day}").mkdir()
        (tmp_path / f"day=2024-02-0{day}" / "a.csv").write_text((HEADER if day % 2 else HEADER.replace(",", ";")) + "E,a,b,c\n")
    plan = csv_days.read_days(spark, str(tmp_path), dt.date(2024, 2, 1), dt.date(2024, 2, 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_tenant_patterns(spark):
    named = [tenants.Tenant("Two Words"), tenants.Tenant("two")]
    rows = [("/a/two_words/1",), ("/a/twoxwords/1",), ("/a/TWO/1",), ("/b/1",), (None,)]
    df = spark.createDataFrame(rows, "path string")
    got = sorted((r.path, r.tenant) for r in tenants.tag(df, named).collect())
    assert got == [
        ("/a/two_words/1", "Two Words"),
        ("/a/two_words/1", "two"),
        ("/a/twoxwords/1", "Two Words"),
        ("/a/twoxwords/1", "two"),
    ]
    assert ("/a/TWO/1", "two") in {(r.path, r.tenant) for r in tenants.tag(df, named, ignore_case=True).collect()}


def test_tenant_frame_is_literal(spark):
    named = [tenants.Tenant("a", 10), tenants.Tenant("b", 20)]
    assert {tuple(r) for r in tenants.tenant_frame(spark, named).collect()} == {("a", 10.0), ("b", 20.0)}
    df = spark.createDataFrame([("b",), ("z",)], "t string")
    assert [r[0] for r in df.select(tenants.shift_of(F.col("t"), named)).collect()] == [20.0, None]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t1", dt.date(2024, 1, 1), 5, "é"), ("t2", dt.date(2024, 1, 1), 6, None)], "tenant string, as_of date, n int, s string")
    for kind in ("parquet", "json"):
        path = str(tmp_path / kind)
        sinks.write_report(df, path, ["tenant", "as_of"], kind)
        back = spark.read.format(kind).load(path)
        assert {(r.tenant, r.as_of, r.n, r.s) for r in back.collect()} == {tuple(r) for r in df.collect()}
        assert (tmp_path / kind / "tenant=t1" / "as_of=2024-01-01").is_dir()
    sinks.write_csv(df, str(tmp_path / "csv"))
    text = "".join(f.read_text(encoding="utf-8") for f in sorted((tmp_path / "csv").glob("part-*.csv")))
    assert text.startswith("tenant,as_of,n,s\n") and "é" in text
    with pytest.raises(ValueError):
        sinks.write_report(df, str(tmp_path / "x"), file_format="xlsx")


def test_single_date_filters_reach_the_scan(spark, tmp_path):
    """With facts partitioned by date one day's report reads one partition, columns pruned."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    day = dt.date(2024, 1, 1)
    calls = spark.createDataFrame([], tables.SCHEMAS["interactions"])
    calls = calls.unionByName(spark.createDataFrame([(1, day)], "id bigint, date date"), allowMissingColumns=True)
    calls.write.partitionBy("date").parquet(f"{tmp_path}/interactions")
    spark.createDataFrame([], tables.SCHEMAS["interaction_flags"]).write.parquet(f"{tmp_path}/interaction_flags")
    plan = lost_sales.unsuccessful_total(tables.parquet_tables(spark, str(tmp_path)), day)
    text = plan._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "(date" in text
    assert "EqualTo(sales_outcome,sale_unsuccessful)" in text and "EqualTo(type_of_interaction,sales)" in text
    scans = [line for line in text.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("phone_number_discussion" not in line for line in scans)


def test_unbound_role_is_named(spark):
    with pytest.raises(AttributeError, match="no table bound"):
        tables.Tables({}).interactions


def test_empty_inputs_keep_the_schema(spark):
    empty = {role: spark.createDataFrame([], schema) for role, schema in tables.SCHEMAS.items()}
    t = tables.Tables({}).bind(**empty)
    assert lost_sales.reason_summary(t, DAILY).collect() == []
    day = dt.date(2024, 1, 1)
    assert lost_sales.unsuccessful_total(t, day).collect()[0].interaction_count == 0
    zeros = lost_sales.reason_summary(t, day).collect()
    assert len(zeros) == 3 and {(r.interactions, r.pct) for r in zeros} == {(0, 0.0)}
