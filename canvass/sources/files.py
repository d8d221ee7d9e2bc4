"""Scans: CSV with BOM and all strings, GeoJSON features, HTML tables, sheets with a header to be found."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import pairs_of
from ..functions.normalize import present, spaces
from ..operators.contracts import ContractError
from ..storage import saved


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as strings, blank for missing, header names trimmed; quoted line breaks and quotes kept.

    A row that the header does not fit fails the job.  ``columns`` gives the schema and saves reading the header; a file
    that is not there then has no rows.
    """
    if columns and not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", encoding="UTF-8", inferSchema=False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns]).na.fill("")


def csv_checked(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV files: all columns as strings, blank lines skipped, a first line skipped with ``header``.

    Lines with too many or too few cells, or quotes that do not close, are rejected: file, offset (which grows along a file,
    in no unit), line.  :func:`require_clean` fails a job on them.  Files are read once, now, into the shared folder.
    """
    kind = T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField("_line", T.StringType())])
    read = spark.read.schema(kind).options(header=header, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_line", encoding="UTF-8", enforceSchema=True).csv(path)
    read = read.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start"), "_n": F.monotonically_increasing_id()})
    read = saved(read, "lines")
    rows = read.where("_line is null").select(*columns).na.fill("")
    bad = read.where("_line is not null")
    return rows, bad.select(F.col("_file").alias("file"), F.struct(F.col("_at").alias("block"), F.col("_n").alias("row")).alias("offset"), F.col("_line").alias("line"))


def require_clean(rejected: DataFrame, most: int = 5) -> None:
    """Fail with the first rejected lines, by file and offset, if there are any."""
    first = rejected.orderBy("file", "offset").limit(most).collect()
    if first:
        raise ContractError("lines do not fit the header: " + "; ".join(f"{r['file'].rsplit('/', 1)[-1]}: {r['line']!r}" for r in first))


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """properties (map), kind and coordinates (JSON text) of each feature of GeoJSON documents."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select(F.explode("features").alias("f")).select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def positions(coordinates: Column) -> Column:
    """The (x, y) points of a GeoJSON coordinates text, whatever its nesting: numbers two by two."""
    numbers = F.transform(F.regexp_extract_all(coordinates, F.lit(r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"), F.lit(1)), lambda x: x.cast("double"))
    return pairs_of(numbers)


def cell_places(cells: DataFrame, label: str) -> DataFrame:
    """place ('Sheet!R3C2', counted from 1) and value of the cells that begin with ``label``."""
    found = cells.withColumn("value", spaces(F.col("value"))).where(F.col("value").startswith(label))
    return found.select(F.format_string("%s!R%dC%d", F.col("sheet"), F.col("row") + 1, F.col("col") + 1).alias("place"), "value")


def sheet_rows(cells: DataFrame, header: list[str]) -> DataFrame:
    """Rows below the first row that holds all header labels, from cells (sheet, row, col, value).

    Labels are matched by their beginning; columns come out by label, blank rows are dropped.
    """
    clean = cells.withColumn("value", spaces(F.col("value")))
    labelled = None
    for h in header:
        hit = clean.where(F.col("value").startswith(h)).groupBy("sheet", "row").agg(F.min("col").alias(f"_c_{h}"))
        labelled = hit if labelled is None else labelled.join(hit, ["sheet", "row"])
    first = labelled.withColumn("_k", F.row_number().over(Window.partitionBy("sheet").orderBy("row"))).where("_k = 1").withColumnRenamed("row", "_head").drop("_k")
    below = clean.join(first, "sheet").where(F.col("row") > F.col("_head"))
    values = [F.max(F.when(F.col("col") == F.col(f"_c_{h}"), F.col("value"))).alias(h) for h in header]
    rows = below.groupBy("sheet", "row").agg(*values).na.fill("")
    return rows.where(F.coalesce(*[present(F.col(h)) for h in header]).isNotNull())


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str]]] = []
        self.table = self.row = -1
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.table, self.row = self.table + 1, -1
        elif tag == "tr":
            self.row += 1
            self.rows.append((self.table, self.row, []))
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1][2].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, table, row, cells of every table row of each page."""
    kind = pages.schema[key].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame[key], frame[html], strict=True):
                parser = _Tables()
                parser.feed(text or "")
                parser.close()
                out.extend((k, t, r, c) for t, r, c in parser.rows if c)
            yield pd.DataFrame(out, columns=[key, "table", "row", "cells"])

    return pages.select(key, html).mapInPandas(read, f"`{key}` {kind}, table int, row int, cells array<string>")


class _Titled(_Tables):
    """Cells as the longer of their title and their text."""

    def __init__(self) -> None:
        super().__init__()
        self.title = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        super().handle_starttag(tag, attrs)
        if tag in ("td", "th"):
            self.title = " ".join((dict(attrs).get("title") or "").split())

    def handle_endtag(self, tag: str) -> None:
        closes = tag in ("td", "th") and self.cell is not None
        super().handle_endtag(tag)
        if closes and len(self.title) > len(self.rows[-1][2][-1]):
            self.rows[-1][2][-1] = self.title


def html_records(pages: DataFrame, key: str, html: str, labels: dict[str, str]) -> DataFrame:
    """key, the columns of ``labels`` (column by header label) and last: rows of every table whose first row has all labels.

    A cell is the longer of its title and its text; last is the row's last cell.  Rows too short for the labels, and rows
    where one of them is blank, are left out; tables without the labels are other tables.
    """
    kind = pages.schema[key].dataType.simpleString()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame[key], frame[html], strict=True):
                parser = _Titled()
                parser.feed(text or "")
                parser.close()
                heads = {t: cells for t, r, cells in parser.rows if r == 0}
                for t, r, cells in parser.rows:
                    if r and set(labels) <= set(heads.get(t, ())):
                        places = [heads[t].index(label) for label in labels]
                        if len(cells) > max(places) and all(cells[i] for i in places):
                            out.append((k, *(cells[i] for i in places), cells[-1]))
            yield pd.DataFrame(out, columns=[key, *labels.values(), "last"])

    return pages.select(key, html).mapInPandas(read, f"`{key}` {kind}, " + ", ".join(f"{c} string" for c in labels.values()) + ", last string")


def joined_lines(lines: DataFrame, doc: str, place: str, text: str, starts: Column, reverse: bool = False) -> DataFrame:
    """doc, record, text: lines joined to records, each from a line where ``starts`` holds to the next.

    Lines before the first start are dropped.  ``reverse`` turns the characters of each line, for text that was
    extracted from right to left.  The order is that of ``place`` in a document.
    """
    own = Window.partitionBy(doc).orderBy(place)
    numbered = lines.withColumn("record", F.sum(F.when(starts, 1).otherwise(0)).over(own)).where("record > 0")
    shown = F.reverse(text) if reverse else F.col(text)
    parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), spaces(shown).alias("t"))))
    joined = F.array_join(F.transform(parts, lambda x: x["t"]), " ")
    return numbered.groupBy(doc, "record").agg(joined.alias(text))
