"""Readers of the engine's file formats: TSV in three dialects, published JSON, spreadsheets, cp932 CSV, HTML lists."""

from __future__ import annotations

import csv
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType

from tidemark.functions.pages import text_of


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Columns of the tables ---------------------------------------------------------------------------
MUNICIPALITIES = strings(*"code prefecture municipality type pref_kana muni_kana pref_romaji muni_romaji".split())
SITES = strings(*"code prefecture municipality official_url tourism_url resolved".split())
PAGES = strings(*"prefecture municipality url fetch_url kind depth title".split())
CANDIDATES = strings(*"prefecture municipality name name_raw origin reason date_text venue source_url page_title context".split())
DESIGNATIONS = strings(*"prefecture municipality designation kind name source_url".split())
LEDGER = strings(*"ts kind url status bytes final_url note".split())
GOLD = strings(*"name municipality source_url tier in_snapshot why".split())
RECORDS = StructType([
    StructField("id", StringType()), StructField("name", StringType()), StructField("aliases", ArrayType(StringType())), StructField("status", StringType()), StructField("confidence", StringType()),
    StructField("prefecture", StringType()), StructField("municipality", StringType()), StructField("district", StringType()), StructField("venue", StringType()),
    StructField("location", StructType([StructField("latitude", DoubleType()), StructField("longitude", DoubleType()), StructField("precision", StringType())])), StructField("usual_schedule", StringType()),
    StructField("event_dates", ArrayType(StructType([StructField("year", LongType()), StructField("start", DateType()), StructField("end", DateType()), StructField("status", StringType()), StructField("source_url", StringType())]))),
    StructField("categories", ArrayType(StringType())), StructField("features", ArrayType(StringType())), StructField("history", StringType()),
    StructField("cultural_property", StructType([StructField("designated", BooleanType()), *strings("level", "designation_name", "designation_type").fields])),
    StructField("scale", StructType([*[StructField(n, LongType()) for n in ("attendance", "floats", "mikoshi", "days", "participating_districts")], StructField("other", ArrayType(StringType()))])),
    StructField("summary", StringType()),
    StructField("sources", ArrayType(StructType([*strings("url", "title", "publisher", "accessed").fields, StructField("supports", ArrayType(StringType()))]))),
    StructField("notes", StringType()), StructField("last_verified", StringType()),
])


def quoted_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """TSV in the CSV dialect: double quotes quote, and a quoted cell may hold tabs and line ends."""
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, schema=schema, mode="PERMISSIVE", enforceSchema=True)


def raw_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """TSV by splitting: quotes are characters, blank lines are skipped, missing cells are null, further ones dropped."""
    lines = spark.read.text(path).filter(F.trim("value") != "").withColumn("c", F.split("value", "\t", -1))
    names = [f.name for f in schema.fields]
    rows = lines.select(*[F.try_element_at("c", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
    header = F.concat_ws("\t", *names) == F.lit("\t".join(names))
    return rows.filter(~header)


def ragged_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(file, cells) of headerless, hand-made TSV: byte-order marks, blank lines and # comments go."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "^﻿", "").alias("v"))
    return lines.filter((F.trim("v") != "") & ~F.startswith(F.ltrim("v"), F.lit("#"))).select("file", F.split("v", "\t", -1).alias("cells"))


def ledger_cells(lines: DataFrame, *keep: str) -> DataFrame:
    """The ledger's columns of lines (value, keep...): short rows are padded with empty cells, header lines go."""
    names = [f.name for f in LEDGER.fields]
    cells = lines.select(*keep, F.split("value", "\t", -1).alias("c"))
    return cells.select(*keep, *[F.coalesce(F.try_element_at("c", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)]).filter(F.col("ts") != "ts")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The access ledger: short rows are padded with empty cells, malformed ones stay visible."""
    return ledger_cells(spark.read.text(path).filter(F.col("value") != ""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The published JSON document, one row per record; the root may also be the bare list."""
    rooted = StructType([StructField("schema_version", StringType()), StructField("updated_at", StringType()), StructField("festivals", ArrayType(RECORDS))])
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.when(F.startswith("v", F.lit("[")), F.from_json("v", ArrayType(RECORDS))).otherwise(F.from_json("v", rooted)["festivals"])
    return text.select(F.explode(listed).alias("r")).select("r.*")


def rows_of_bytes(files: DataFrame, parse) -> DataFrame:
    """(file, ordinal, cells) of files (path, content), each parsed by one task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(p, i, cells) for p, content in zip(frame["path"], frame["content"], strict=True) for i, cells in enumerate(parse(content))]
            yield pd.DataFrame(rows, columns=["file", "ordinal", "cells"])

    return files.select("path", "content").mapInPandas(run, CELLS)


def _binary_rows(spark: SparkSession, path: str, parse) -> DataFrame:
    """(file, ordinal, cells) of every matching file."""
    return rows_of_bytes(spark.read.format("binaryFile").load(path), parse)


CELLS = "file string, ordinal int, cells array<string>"
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_cells(content: bytes, sheet: int = 1) -> list[list[str]]:
    """Rows of a workbook's sheet; cells that a row leaves out are not padded."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in item.iter(f"{_SHEET}t")) for item in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
        rows = []
        for row in ET.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{_SHEET}row"):
            cells = []
            for cell in row.iter(f"{_SHEET}c"):
                value = cell.find(f"{_SHEET}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_SHEET}t")) if value is None else value.text or ""
                cells.append(shared[int(text)] if cell.get("t") == "s" and text else text)
            rows.append(cells)
        return rows


def workbook(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    return _binary_rows(spark, path, lambda b: sheet_cells(b, sheet))


def cp932_cells(content: bytes) -> list[list[str]]:
    return list(csv.reader(io.StringIO(content.decode("cp932", "replace"))))


def cp932_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV in code page 932 (not among Spark's charsets): undecodable bytes are replaced, cells may hold line ends."""
    return _binary_rows(spark, path, cp932_cells)


def list_cells(page: str, width: int = 5) -> list[list[str]]:
    """Cells of a result list's rows (those with a numbered data-id), padded to `width`."""
    rows = re.findall(r'<tr[^>]*data-id="m\d+"[^>]*>(.*?)</tr>', page, re.S)
    cells = [[text_of(c) for c in re.findall(r"<td\b[^>]*>(.*?)</td>", r, re.S)] for r in rows]
    return [(c + [""] * width)[:width] for c in cells]


def html_list(spark: SparkSession, path: str, width: int = 5) -> DataFrame:
    return _binary_rows(spark, path, lambda b: list_cells(b.decode("utf-8", "replace"), width))


def search_results(page: str, base: str) -> tuple[dict[str, str], int]:
    """(detail URL to text, later rows overwrite earlier ones; the stated number of hits) of a search page."""
    found = {}
    for href, label in re.findall(r'<a[^>]*href="([^"]*detail[^"]*)"[^>]*>(.*?)</a>', page, re.S | re.I):
        if name := text_of(label):
            found[base + href if href.startswith("/") else href] = name
    total = re.search(r"([0-9,]+)\s*件中", page)
    return found, int(total[1].replace(",", "")) if total else 0


def search_hits(df: DataFrame, id_col: str, html_col: str, base: str) -> DataFrame:
    """(url, name, total) of search-result pages taken in id order: of one address the text of the last row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for number, page in zip(frame[id_col], frame[html_col], strict=True):
                found, total = search_results(page or "", base)
                rows += [(number, i, url, name, total) for i, (url, name) in enumerate(found.items())]
            yield pd.DataFrame(rows, columns=["page", "ord", "url", "name", "total"])

    rows = df.select(id_col, html_col).mapInPandas(run, f"page {dict(df.dtypes)[id_col]}, ord int, url string, name string, total long")
    return rows.groupBy("url").agg(F.max_by("name", F.struct("page", "ord")).alias("name"), F.max("total").alias("total"))


# Charset labels that pages use for code page 932.
CHARSET_ALIASES = {"shift_jis": "cp932", "shift-jis": "cp932", "x-sjis": "cp932", "sjis": "cp932", "windows-31j": "cp932", "ms932": "cp932"}
_META = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)


def decode_page(body: bytes, content_type: str = "") -> tuple[str, str]:
    """(text, encoding): the header's charset, the page's own in its first 4,096 bytes, UTF-8, cp932, EUC-JP; else UTF-8 with replacements."""
    header = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", content_type or "", re.I)
    meta = _META.search(body[:4096])
    for label in (header and header[1], meta and meta[1].decode("ascii"), "utf-8", "cp932", "euc_jp"):
        name = CHARSET_ALIASES.get(label.lower(), label.lower()) if label else ""
        try:
            return body.decode(name), name
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("utf-8", "replace"), "utf-8"


def decode_pages(df: DataFrame, body: str, content_type: str) -> DataFrame:
    """df with decoded_text and encoding for a binary body column."""
    target = df.select("*", F.lit("").alias("decoded_text"), F.lit("").alias("encoding")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [decode_page(bytes(b or b""), c or "") for b, c in zip(frame[body], frame[content_type], strict=True)]
            yield frame.assign(decoded_text=[t for t, _ in got], encoding=[e for _, e in got])

    return df.mapInPandas(run, target)


def multi(c: Column) -> Column:
    """A cell of values joined by | as an array; empty cells as empty arrays."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "")
