"""Daily CSV drops laid out as `root/day=YYYY-MM-DD/*`, each file in its own dialect.

Only directories of the wanted days are listed. The head of each file, one small read like a listing, tells
its encoding, separator and the places of the columns; files of one dialect and header share a reader, and
the readers are unioned. The rows themselves are read once, when the result is used.
"""

from __future__ import annotations

import codecs
import csv
import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

ATTENDANCE_COLUMNS = ("UserID", "InDateTime", "OutDateTime", "Date")
SEPARATORS = (",", ";", "\t", "|")
BYTE_ORDER_MARKS = {codecs.BOM_UTF8: "UTF-8", codecs.BOM_UTF16_LE: "UTF-16LE", codecs.BOM_UTF16_BE: "UTF-16BE"}
FALLBACK_ENCODING = "ISO-8859-1"
HEAD_BYTES = 1 << 16
REPLACEMENT = "�"


@dataclass(frozen=True)
class Dialect:
    encoding: str
    separator: str
    names: tuple[str, ...]


def dialect_of(head: bytes, columns: Sequence[str], whole: bool) -> Dialect | None:
    """Encoding, separator and header of a file from its first bytes; None without a header of the columns.

    A byte-order mark decides the encoding; else the head is UTF-8 unless it is no valid UTF-8. The
    separator is the one under which the first non-empty line names all columns."""
    for mark, encoding in BYTE_ORDER_MARKS.items():
        if head.startswith(mark):
            text = head[len(mark) :].decode(encoding, "replace")
            break
    else:
        try:
            encoding = "UTF-8"
            text = codecs.getincrementaldecoder(encoding)().decode(head, final=whole)
        except UnicodeDecodeError:
            encoding = FALLBACK_ENCODING
            text = head.decode(encoding, "replace")
    line = next((line for line in re.split(r"\r\n|\n|\r", text) if line.strip()), "")
    for separator in SEPARATORS:
        names = tuple(name.strip() for name in next(csv.reader([line], delimiter=separator), ()))
        if set(columns) <= set(names):
            return Dialect(encoding, separator, names)
    return None


def _files(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> list[str]:
    """Files of the days in `[start, end]`, in order; names beginning with `_` or `.` are no data."""
    context = spark.sparkContext
    base = context._jvm.org.apache.hadoop.fs.Path(root)
    system = base.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(base):
        return []
    found = []
    for folder in system.listStatus(base):
        day = re.fullmatch(r"day=(\d{4}-\d{2}-\d{2})", folder.getPath().getName())
        if day and start <= dt.date.fromisoformat(day[1]) <= end:
            paths = [status.getPath() for status in system.listStatus(folder.getPath()) if status.isFile()]
            found += [path.toString() for path in paths if path.getName()[0] not in "_."]
    return sorted(found)


def _head(spark: SparkSession, file: str) -> tuple[bytes, bool]:
    """The first bytes of a file, and whether they are all of it; compressed files by their codec."""
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        head = (codec.createInputStream(stream) if codec else stream).readNBytes(HEAD_BYTES)
    finally:
        stream.close()
    return bytes(head), len(head) < HEAD_BYTES


@dataclass(frozen=True)
class Drops:
    """`rows`: the named columns and `day`. `malformed`: `day`, `file`, `line` of rows with too few or too many
    cells, or with bytes outside the file's encoding."""

    rows: DataFrame
    malformed: DataFrame


def read_drops(spark: SparkSession, root: str, start: dt.date, end: dt.date, columns: Sequence[str] = ATTENDANCE_COLUMNS) -> Drops:
    """The named columns of every day present in `[start, end]`, found by each file's own header.

    Days without a drop are skipped. No file at all, a reversed range or a file without one of the
    columns is an error; a file of a header only adds no rows. Where a header has a name twice, its first
    column counts. Line breaks inside quotes are read in UTF-16 files only, whose lines cannot be split.
    """
    if start > end:
        raise ValueError("start must not be after end")
    dialects: dict[Dialect, list[str]] = {}
    for file in _files(spark, root, start, end):
        dialects.setdefault(_dialect(spark, file, columns), []).append(file)
    if not dialects:
        raise FileNotFoundError(f"no CSV files under {root} between {start} and {end}")
    parts = [_read(spark, root, dialect, files, columns) for dialect, files in dialects.items()]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    bad = F.col("_line").isNotNull() | F.concat_ws("", *columns).contains(REPLACEMENT)
    text = F.coalesce("_line", F.concat_ws(",", *columns)).alias("line")
    return Drops(lines.where(~bad).select(*columns, "day"), lines.where(bad).select("day", F.col("_file").alias("file"), text))


def _dialect(spark: SparkSession, file: str, columns: Sequence[str]) -> Dialect:
    head, whole = _head(spark, file)
    found = dialect_of(head, columns, whole)
    if found is None:
        raise ValueError(f"{file} has no header with the columns {', '.join(columns)}")
    return found


def _read(spark: SparkSession, root: str, dialect: Dialect, files: list[str], columns: Sequence[str]) -> DataFrame:
    cells = ", ".join(f"_c{i} string" for i in range(len(dialect.names)))
    wide = dialect.encoding.startswith("UTF-16")
    lines = (
        spark.read.schema(f"{cells}, _line string, day date")
        .option("basePath", root)
        .option("header", True)
        .option("sep", dialect.separator)
        .option("encoding", "UTF-16" if wide else dialect.encoding)
        .option("multiLine", wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        .option("columnPruning", False)  # else a row with too few cells passes
        .csv(files)
    )
    picked = [F.col(f"_c{dialect.names.index(name)}").alias(name) for name in columns]
    return lines.select(*picked, "day", "_line", F.col("_metadata.file_path").alias("_file"))


def read_days(spark: SparkSession, root: str, start: dt.date, end: dt.date, columns: Sequence[str] = ATTENDANCE_COLUMNS) -> DataFrame:
    """The rows of `read_drops`."""
    return read_drops(spark, root, start, end, columns).rows
