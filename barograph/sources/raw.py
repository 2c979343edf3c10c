"""Raw observation files: delimited text with a header, all columns strings.

Files of one folder may have different headers (optional field groups come and
go), and a CSV scan applies one header to all of them by position. The reader
therefore takes the lines as text, learns each file's header, and parses every
line by its own file's width; names become positions per header. Two scans serve
any number of headers: one for the headers and one for the rows. Only Spark
opens the files, so any file system and credentials of the session will do.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.session import materialize

#: With more files, the table of their headers is joined by shuffle, not by broadcast (some 200 bytes a file).
BROADCAST_FILES = 200_000


def read_raw(
    spark: SparkSession, path: str | list[str], malformed: str = "keep", glob: str = "*.csv",
    columns: list[str] | None = None, header: str | None = None, source: str | None = None,
) -> DataFrame:
    """All files below ``path`` as one all-string table; absent columns are NULL.

    The first line that is not blank is a file's header; a line equal to it is
    no row. ``malformed="drop"`` drops rows with more or fewer values than their
    file's header. ``columns`` keeps only these columns. ``header``, where all
    files share one, saves the scan for the headers. ``source`` names a further
    column for the URI of a row's file.
    """
    if malformed not in ("keep", "drop"):
        raise ValueError(f"malformed must be 'keep' or 'drop', not {malformed!r}")
    lines = _lines(spark, path, glob)
    if header is not None:
        found, rows = [header], lines.select("value", F.lit(0).alias("layout"), "file")
    else:
        headers = materialize(file_headers(spark, path, glob).where("header IS NOT NULL"))
        found = sorted(row["header"] for row in headers.select("header").distinct().collect())
        if not found:
            raise ValueError(f"no {glob} file with a header below {path}")
        if len(found) == 1:
            rows = lines.select("value", F.lit(0).alias("layout"), "file")
        else:
            rows = _with_layout(lines, headers, found)
    layouts = [_names(text) for text in found]
    parsed = _parsed(rows, found, layouts, malformed == "drop")
    names = list(dict.fromkeys(name for layout in layouts for name in layout))
    if columns is not None:
        names = [name for name in columns if name in names]
    origin = [F.col("file").alias(source)] if source else []
    return parsed.select(*[_value(name, layouts).alias(name) for name in names], *origin)


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Path, URI, length and modification time of every file, from a listing that opens none of them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(
        "path", F.col("_metadata.file_path").alias("file"), "length", "modificationTime")


def _lines(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    text = spark.read.option("pathGlobFilter", glob).text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
    ).where(F.trim("value") != "")


def file_headers(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Path, first non-blank line and URI of every file (path, header, file); the line is NULL where there is none.

    The files come from a listing that opens none of them and leaves out those
    of no bytes. Of each only the first block is read for the line; its lines
    reach one task in file order, so the smallest running number marks the first.
    """
    listed = list_files(spark, path, glob).select("path", "file")
    first = _lines(spark, path, glob).where("start = 0").withColumn("at", F.monotonically_increasing_id())
    lines = first.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return listed.join(lines, "file", "left").select("path", "header", "file")


def _with_layout(lines: DataFrame, headers: DataFrame, found: list[str]) -> DataFrame:
    """Add the number of the file's header to every line."""
    known = F.array(*[F.lit(text) for text in found])
    numbered = headers.select("file", (F.array_position(known, F.col("header")) - 1).cast("int").alias("layout"))
    if headers.count() <= BROADCAST_FILES:
        numbered = F.broadcast(numbered)
    return lines.join(numbered, "file").select("value", "layout", "file")


def _names(header: str) -> list[str]:
    """Column name per position; empty and repeated names get their position."""
    names = next(csv.reader([header.removeprefix("﻿")]))
    seen: dict[str, int] = {}
    for name in names:
        seen[name] = seen.get(name, 0) + 1
    return [f"_c{i}" if not name else f"{name}{i}" if seen[name] > 1 else name for i, name in enumerate(names)]


def _parsed(rows: DataFrame, found: list[str], layouts: list[list[str]], drop: bool) -> DataFrame:
    """Values of every row by position, with the number of its header."""
    headers = F.array(*[F.lit(text) for text in found])
    widths = F.array(*[F.lit(len(layout)) for layout in layouts])
    data = rows.where(F.col("value") != F.get(headers, F.col("layout"))).withColumn(
        "width", F.get(widths, F.col("layout")))
    values = None
    for width in sorted({len(layout) for layout in layouts}):
        fields = [f"_{i}" for i in range(width)]
        schema = ", ".join(f"{name} string" for name in [*fields, *(["bad"] if drop else [])])
        options = {"mode": "PERMISSIVE", **({"columnNameOfCorruptRecord": "bad"} if drop else {})}
        row = F.from_csv("value", schema, options)
        text = F.transform(F.array(row), lambda r: F.struct(
            F.array(*[r[name] for name in fields]).alias("values"),
            (r["bad"] if drop else F.lit(None).cast("string")).alias("bad")))[0]
        mine = F.col("width") == width
        values = F.when(mine, text) if values is None else values.when(mine, text)
    parsed = data.select("layout", "file", values.alias("row"))
    if drop:
        parsed = parsed.where("row.bad IS NULL")
    return parsed.select("layout", "file", F.col("row.values").alias("values"))


def _value(name: str, layouts: list[list[str]]):
    """Value of a column: each header has it at its own position, or not at all."""
    places = [layout.index(name) if name in layout else -1 for layout in layouts]
    place = F.get(F.array(*[F.lit(p) for p in places]), F.col("layout")) if len(set(places)) > 1 else F.lit(places[0])
    return F.get("values", place)
