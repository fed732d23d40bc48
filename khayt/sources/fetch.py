"""Getting raw files: downloads with a check sum, and paged JSON as a data source whose pages are partitions."""

from __future__ import annotations

import hashlib
import http.client
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def download(url: str, path: str, sha256: str | None = None, tries: int = 3, wait: float = 1.0) -> str:
    """The file at a URL, kept if it is there already; a wrong check sum is an error and leaves nothing."""
    if os.path.exists(path):
        return path
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    for n in range(tries):
        try:
            digest = hashlib.sha256()
            with urllib.request.urlopen(url, timeout=60) as r, open(f"{path}.part", "wb") as f:  # noqa: S310
                while chunk := r.read(1 << 20):
                    digest.update(chunk)
                    f.write(chunk)
            break
        except OSError:
            if n + 1 == tries:
                raise
            time.sleep(wait * 2**n)
    if sha256 and digest.hexdigest() != sha256:
        os.remove(f"{path}.part")
        raise ValueError(f"{url}: check sum is {digest.hexdigest()}")
    os.replace(f"{path}.part", path)
    return path


def _missing(error: OSError) -> bool:
    """Whether an error says that a page isn't there, and not that it couldn't be had."""
    return isinstance(error, FileNotFoundError) or getattr(error, "code", None) in (404, 410) or isinstance(getattr(error, "reason", None), FileNotFoundError)


def _json(url: str, tries: int, wait: float) -> object:
    """The JSON at a URL, None where there is none; any other error is tried again with longer and longer waits, then raised."""
    for n in range(tries):
        try:
            with urllib.request.urlopen(url, timeout=60) as r:  # noqa: S310
                return json.load(r)
        except (OSError, http.client.HTTPException, json.JSONDecodeError) as e:
            if isinstance(e, OSError) and _missing(e):
                return None
            if n + 1 == tries:
                raise
            time.sleep(wait * 2**n)
    return None


class _Pages(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.url, self.last, self.field = options["url"], int(options.get("pages", 1)), options.get("field", "data")
        self.tries, self.wait = int(options.get("tries", 3)), float(options.get("wait", 1.0))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(n) for n in range(1, self.last + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        got = _json(self.url.format(page=partition.value), self.tries, self.wait)
        if got is None:
            return  # past the last page
        for i, row in enumerate(got.get(self.field, []) if isinstance(got, dict) else got):
            yield partition.value, i, json.dumps(row, ensure_ascii=False)


class PagedJson(DataSource):
    """``url`` with {page}, ``pages`` at most, ``field`` of the records: rows (page, place, record)."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, place int, record string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Pages(self.options)


def paged_json(spark: SparkSession, url: str, pages: int, field: str = "data", tries: int = 3, wait: float = 1.0) -> DataFrame:
    """(page, place, record) of all pages that are there. A missing page (404) has no rows; a page that cannot be had after ``tries`` fails the read."""
    spark.dataSource.register(PagedJson)
    return spark.read.format("paged_json").option("url", url).option("pages", str(pages)).option("field", field).option("tries", str(tries)).option("wait", str(wait)).load()
