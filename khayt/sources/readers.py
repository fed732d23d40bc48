"""Readers of raw formats as DataFrames: the executors open the files."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODINGS = ("utf-8-sig", "utf-8", "latin-1")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, content) of the files below a folder."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return got.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("name"), "content")


def texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, text): UTF-8 with or without a mark, else Latin-1."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(text=[_decoded(b) for b in f["content"]])[["path", "name", "text"]]

    return files(spark, path, pattern).mapInPandas(decode, "path string, name string, text string")


def _decoded(data: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


def _csv_by_encoding(spark: SparkSession, path: str, pattern: str, header: bool, columns: Sequence[str] | None) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    odd = [r[0] for r in found.where(~F.is_valid_utf8(F.col("content").cast("string"))).select("_metadata.file_path").collect()]  # names of files
    rows = csv(spark, path, pattern, header, columns, "utf-8")
    if not odd:
        return rows
    out = rows.where(~F.col("_path").isin(*odd))
    latin = csv(spark, path, pattern, header, columns, "iso-8859-1").where(F.col("_path").isin(*odd))
    return out.unionByName(latin, allowMissingColumns=True)


def csv(spark: SparkSession, path: str, pattern: str = "*.csv", header: bool = True, columns: Sequence[str] | None = None, encoding: str | None = None) -> DataFrame:
    """Rows of CSV files as text with ``_path``; malformed rows are dropped, quoted line breaks kept. ``columns`` name the fields by place.

    Files are UTF-8, or else Latin-1 where their bytes are no UTF-8, file by file, unless an ``encoding`` is named for all.
    """
    if encoding is None:
        return _csv_by_encoding(spark, path, pattern, header, columns)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("header", header and not columns).option("multiLine", "true").option("quote", '"').option("escape", '"').option("encoding", encoding)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns)).option("header", header).option("enforceSchema", "true").option("mode", "DROPMALFORMED")
    return reader.csv(path).withColumn("_path", F.col("_metadata.file_path"))


def json(spark: SparkSession, path: str, schema: str, pattern: str = "*.json", many: bool = True) -> DataFrame:
    """Records of JSON files (an array of objects, or one object each) with ``_name``, the file's stem; parsed by a given schema, never guessed."""
    parsed = texts(spark, path, pattern).select(F.col("name").alias("_name"), F.from_json("text", f"array<struct<{schema}>>" if many else f"struct<{schema}>").alias("r"))
    rows = parsed.select("_name", F.explode("r").alias("r")) if many else parsed.where("r is not null")
    return rows.select("_name", "r.*")


def json_map(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> DataFrame:
    """Records of JSON files that are one object of keyed records: ``_key`` and the record's fields."""
    return texts(spark, path, pattern).select(F.explode(F.from_json("text", f"map<string,struct<{schema}>>")).alias("_key", "r")).select("_key", "r.*")


def sheet(data: bytes) -> list[list[str | None]]:
    """Cells of the first sheet of a workbook, read from its zipped XML."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        first = min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
        rows = []
        for row in ElementTree.fromstring(z.read(first)).iter(f"{{{ns['m']}}}row"):
            cells: dict[int, str | None] = {}
            for i, c in enumerate(row.findall("m:c", ns)):
                letters = re.match(r"[A-Z]+", c.get("r", ""))
                at = i
                if letters:
                    at = 0
                    for ch in letters.group():
                        at = at * 26 + ord(ch) - 64
                    at -= 1
                v = c.find("m:v", ns)
                if c.get("t") == "s" and v is not None:
                    cells[at] = shared[int(v.text)]
                elif c.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
                else:
                    cells[at] = v.text if v is not None else None
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
        return rows


def xlsx(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """(name, row, cells): cells is a map from the first row's headings, in lower case with _ for blanks, to text."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for name, data in zip(f["name"], f["content"], strict=True):
                rows = sheet(data)
                heads = [re.sub(r"[\s-]+", "_", (h or "").strip().lower()) for h in rows[0]] if rows else []
                out += [(name, i, {h: v for h, v in zip(heads, r, strict=False) if h and v is not None}) for i, r in enumerate(rows[1:])]
            yield pd.DataFrame(out, columns=["name", "row", "cells"])

    return files(spark, path, pattern).mapInPandas(work, "name string, row int, cells map<string,string>")


class _Page(HTMLParser):
    """Texts of the elements that match one of several selectors (tag, .class or tag.class), each element's own text without superscripts."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, selectors: Sequence[str], drop: Sequence[str] = ("sup", "script", "style")) -> None:
        super().__init__(convert_charrefs=True)
        self.want = [tuple(s.split(".", 1)) if "." in s else (s, "") for s in selectors]
        self.drop, self.open, self.found, self.hidden = set(drop), [], [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.VOID:
            return
        classes = (dict(attrs).get("class") or "").split()
        hit = next((i for i, (t, c) in enumerate(self.want) if (not t or t == tag) and (not c or c in classes)), -1)
        self.open.append((tag, hit, []))
        self.hidden += tag in self.drop

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _, _ in self.open):
            return
        while self.open:
            t, hit, parts = self.open.pop()
            self.hidden -= t in self.drop
            text = " ".join(" ".join(parts).split())
            if hit >= 0 and text:
                self.found.append((hit, text))
            if self.open and t not in self.drop:
                self.open[-1][2].append(text)
            if t == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.open and not self.hidden:
            self.open[-1][2].append(data)


def select_texts(html: str, selectors: Sequence[str]) -> list[str]:
    """Texts of the first selector that finds any, in order."""
    page = _Page(selectors)
    page.feed(html or "")
    page.close()
    for i in range(len(selectors)):
        if got := [t for k, t in page.found if k == i]:
            return got
    return []


def html(spark: SparkSession, path: str, selectors: Sequence[str], pattern: str = "*.html") -> DataFrame:
    """(name, position, text) of the elements that the first fruitful selector finds in each page."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(n, i, t) for n, h in zip(f["name"], f["text"], strict=True) for i, t in enumerate(select_texts(h, selectors))]
            yield pd.DataFrame(rows, columns=["name", "position", "text"])

    return texts(spark, path, pattern).mapInPandas(work, "name string, position int, text string")


def yaml(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small list of records kept by hand, read on the driver."""
    import yaml as y

    with open(path, encoding="utf-8") as f:
        rows = y.safe_load(f) or []
    rows = next(iter(rows.values())) if isinstance(rows, dict) else rows
    names = [p.split()[0] for p in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n.strip()) for n in names) for r in rows], schema)
