"""Readers for the shapes that Spark has none for: preambles, two header rows, zips, workbooks, paged interfaces."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import ContractError, RequestError
from ..workers import ship


def load(spark: SparkSession, path: str, kind: str | None = None, schema: str | None = None, **options) -> DataFrame:
    """A CSV, JSON, Parquet or workbook file by its suffix, unless ``kind`` says which."""
    kind = kind or path.rpartition(".")[2].lower()
    if kind in ("xlsx", "xls"):
        return workbook(spark, path, **options)
    if kind not in ("csv", "json", "parquet"):
        raise RequestError(f"no reader for {path}")
    reader = spark.read.options(**({"header": True} if kind == "csv" else {"multiLine": True} if kind == "json" else {}) | options)
    return (reader.schema(schema) if schema else reader).format(kind).load(path)


def csv_after_preamble(spark: SparkSession, path: str, schema: str, skip: int, sep: str = ",") -> DataFrame:
    """CSV files whose header comes after ``skip`` lines of text. Files are read whole, each in one task: a month's."""
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.slice(F.split("value", r"\r?\n"), skip + 2, 1_000_000_000)).alias("line"))
    return lines.filter("trim(line) <> ''").select(F.from_csv("line", schema, {"sep": sep}).alias("r")).select("r.*")


def csv_two_headers(spark: SparkSession, path: str, time: str = "time", sep: str = ";") -> DataFrame:
    """CSV with a row of groups over a row of names to long form: ``time, group, name, value`` (all strings).

    Empty group cells repeat the one before. Only the two header lines come to the driver.
    """
    head = [r["value"] for r in spark.read.text(path).limit(2).collect()]
    raw = [next(csv.reader([line], delimiter=sep)) for line in head]
    groups, names = [*raw[0]], raw[1]
    for i, g in enumerate(groups):
        groups[i] = g.strip() or (groups[i - 1] if i else "")
    columns = [f"c{i}" for i in range(len(names))]
    rows = spark.read.csv(path, sep=sep, schema=", ".join(f"{c} string" for c in columns))
    for line in raw:  # the header lines stand among the rows, with nulls for their empty cells
        same = F.lit(True)
        for c, cell in zip(columns, line, strict=True):
            same &= F.col(c).eqNullSafe(F.lit(cell or None))
        rows = rows.filter(~same)
    pairs = F.array(*[F.struct(F.lit(g).alias("group"), F.lit(n).alias("name"), F.col(c).alias("value")) for g, n, c in list(zip(groups, names, columns, strict=True))[1:]])
    return rows.select(F.col("c0").alias(time), F.inline(pairs))


def zip_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Zip files that hold one CSV each, with a header; anything else in one is an error."""

    def lines(batches):
        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if len(z.namelist()) != 1 or not z.namelist()[0].lower().endswith(".csv"):
                        raise ContractError(f"{name} holds {z.namelist()}")
                    with z.open(z.namelist()[0]) as f:
                        text = io.TextIOWrapper(f, "utf-8", newline="")
                        next(csv.reader(text), None)
                        while part := text.readlines(1 << 20):
                            yield pd.DataFrame({"line": [x.rstrip("\r\n") for x in part]})

    ship(spark)
    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(lines, "line string")
    return raw.filter("trim(line) <> ''").select(F.from_csv("line", schema).alias("r")).select("r.*")


_CELL, _NS = re.compile(r"([A-Z]+)(\d+)"), {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _sheets(content: bytes) -> dict[str, list[list[str | None]]]:
    """All cells of a workbook as text, by sheet, straight from its XML."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile as e:
        raise RequestError("not a workbook") from e
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    out = {}
    for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS):
        target = links[sheet.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id")].lstrip("/")
        rows: list[list[str | None]] = []
        for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{{{_NS['m']}}}row"):
            cells: list[str | None] = []
            for c in row.findall("m:c", _NS):
                at = 0
                for ch in _CELL.match(c.get("r"))[1]:
                    at = at * 26 + ord(ch) - 64
                cells += [None] * (at - len(cells))
                v, inline = c.find("m:v", _NS), c.find("m:is", _NS)
                text = "".join(t.text or "" for t in inline.iter(f"{{{_NS['m']}}}t")) if inline is not None else None if v is None else v.text
                cells[at - 1] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            number = int(row.get("r", len(rows) + 1))
            rows += [[] for _ in range(number - len(rows))]
            rows[number - 1] = cells
        out[sheet.get("name")] = rows
    return out


def sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """``path, sheet, row, cells`` of workbooks, rows from 0, cells as text; a task a file."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                for name, rows in _sheets(content).items():
                    yield pd.DataFrame({"path": p, "sheet": name, "row": range(len(rows)), "cells": rows})

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, sheet string, row int, cells array<string>")


def workbook(spark: SparkSession, path: str, sheets: list[str] | None = None, header: int = 0, until: str | None = None) -> DataFrame:
    """One sheet, the first of ``sheets`` that exists (else the first of all), with named text columns.

    ``until`` cuts columns from the first with that name on. Only the header row comes to the driver.
    """
    cells = sheet_cells(spark, path)
    heads = {r["sheet"]: r["cells"] for r in cells.filter(F.col("row") == header).collect()}
    name = next((s for s in sheets or list(heads) if s in heads), None)
    if name is None:
        raise ContractError(f"{path} has no sheet of {sheets}")
    names = [str(c) if c is not None else f"Unnamed: {i}" for i, c in enumerate(heads[name])]
    names = names[: names.index(until)] if until in names else names
    return cells.filter((F.col("sheet") == name) & (F.col("row") > header)).select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def months_in_name(name: Column) -> Column:
    """Months of a file name: the one it holds, or every one from the first to the second it holds; null without any."""
    found = F.regexp_extract_all(name, F.lit(r"(\d{4}-\d{2})"), F.lit(1))
    at = lambda i: F.to_date(F.concat(F.get(found, F.lit(i)), F.lit("-01")))
    months = F.when(F.size(found) > 0, F.sequence(at(0), F.coalesce(at(1), at(0)), F.expr("INTERVAL 1 MONTH")))
    return F.transform(months, lambda d: F.date_format(d, "yyyy-MM"))


def links_in_page(html: Column, pattern: str = r'href="([A-Z0-9_]+)/"') -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))


def variables_in_page(html: Column, fallback: list[str], pattern: str = r'href="([A-Z0-9_]+)/"') -> Column:
    """What a directory page links to, sorted; the fallback where it is null or links to nothing."""
    found = F.array_sort(links_in_page(html, pattern))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*[F.lit(v) for v in sorted(fallback)]))


def fetch_batches(ids: DataFrame, column: str, size: int, fetch: Callable, schema: str) -> DataFrame:
    """Rows of a bulk lookup: ``fetch(ids)`` is called once for each of the near-equal batches, a task each, and gives
    tuples of the schema. Null ids are not asked for."""
    from ..operators.relational import batches

    def run(pdf):
        import pandas as pd

        names = [f.split()[0] for f in schema.split(",")]
        return pd.DataFrame(list(fetch(sorted(pdf[column].tolist()))), columns=names)

    ship(ids.sparkSession)
    dealt = batches(ids.filter(F.col(column).isNotNull()).select(column).distinct(), column, size)
    return dealt.groupBy("batch").applyInPandas(run, schema)


class _Slice(InputPartition):
    def __init__(self, key, start: int | None):
        self.key, self.start = key, start


class PagedSource(DataSource):
    """Rows of a paged interface: a partition for each key (a task, a batch of ids). See ``paged``."""

    fetch: Callable
    keys: list
    size: int
    halvings: int
    fields: str

    @classmethod
    def name(cls) -> str:
        return "gridloom_paged"

    def schema(self) -> str:
        return self.fields

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.fetch, self.keys, self.size, self.halvings)


class _PagedReader(DataSourceReader):
    def __init__(self, fetch, keys, size, halvings):
        self.fetch, self.keys, self.size, self.halvings = fetch, keys, size, halvings

    def partitions(self) -> list[InputPartition]:
        return [_Slice(k, None) for k in self.keys]

    def read(self, part) -> Iterator[tuple]:
        yield from read_pages(self.fetch, part.key, self.size, self.halvings)


def read_pages(fetch: Callable, key, size: int, halvings: int = 0) -> Iterator[tuple]:
    """All rows of a key from ``fetch(key, offset, size) -> (rows, total or None)``.

    Stops at the total or a short page. A server error halves the page size and starts over, ``halvings`` times.
    A total that is not met is an error.
    """
    from ..errors import IncompleteError

    for attempt in range(halvings + 1):
        rows, offset, total = [], 0, None
        try:
            while True:
                page, total = fetch(key, offset, size)
                rows += page
                offset += size
                if len(page) < size or (total is not None and len(rows) >= total):
                    break
        except ConnectionError:
            if attempt == halvings:
                raise
            size = max(1, size // 2)
            continue
        if total is not None and len(rows) != total:
            raise IncompleteError(f"{key}: {len(rows)} rows of {total}")
        yield from map(tuple, rows)
        return


def paged(spark: SparkSession, fetch: Callable, keys: list, fields: str, size: int = 5000, halvings: int = 0) -> DataFrame:
    """A DataFrame over ``fetch``, which must be picklable; keys are read in parallel."""
    source = type("Paged", (PagedSource,), {"fetch": staticmethod(fetch), "keys": keys, "size": size, "halvings": halvings, "fields": fields})
    ship(spark)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()
