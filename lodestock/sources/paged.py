"""Landed pages as a data source: ``spark.read.format("landed_pages")`` and a stream of the same.

A service's pages land in one folder, a file or a folder of files for each
(``page=12``, ``page-12.json``).  A task reads a range of pages.  The stream's
offset is the last page of those that follow each other without a gap, so a
page that lands late is not passed over, and a stream that starts again reads
new pages only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "landed_pages"
PAGE = re.compile(r"page[-=_]?0*([0-9]+)(?:\.[A-Za-z0-9.]+)?")
SCHEMA = "page long, body string"


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def landed_pages(path: str) -> dict[int, str]:
    """Path of every page in the folder."""
    files, root = _folder(path)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {int(m[1]): f.path for f in found if (m := PAGE.fullmatch(f.base_name))}


def page_body(path: str, place: str) -> Iterator[str]:
    """The texts of a page's files."""
    files, _ = _folder(path)
    info = files.get_file_info(place)
    parts = [info]
    if info.type == fs.FileType.Directory:
        parts = sorted(files.get_file_info(fs.FileSelector(place)), key=lambda f: f.path)
        parts = [p for p in parts if p.type == fs.FileType.File and not p.base_name.startswith(("_", "."))]
    for part in parts:
        with files.open_input_stream(part.path) as stream:
            yield stream.read().decode("utf-8")


@dataclass
class Pages(InputPartition):
    """Pages of one task."""

    pages: list[tuple[int, str]]


class _Reader:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.per_task = int(options.get("pagesPerTask", "16"))

    def dealt(self, pages: list[tuple[int, str]]) -> list[Pages]:
        return [Pages(pages[i : i + self.per_task]) for i in range(0, len(pages), self.per_task)]

    def read(self, partition: Pages) -> Iterator[tuple[int, str]]:
        for number, place in partition.pages:
            for body in page_body(self.path, place):
                yield number, body


class PageReader(_Reader, DataSourceReader):
    """All pages there are."""

    def partitions(self) -> list[Pages]:
        return self.dealt(sorted(landed_pages(self.path).items()))


class PageStream(_Reader, DataSourceStreamReader):
    """Pages after the last one read."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.first = int(options.get("firstPage", "1"))

    def initialOffset(self) -> dict:
        return {"page": self.first - 1}

    def latestOffset(self) -> dict:
        pages, last = landed_pages(self.path), self.first - 1
        while last + 1 in pages:
            last += 1
        return {"page": last}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        pages = landed_pages(self.path)
        return self.dealt([(n, pages[n]) for n in range(start["page"] + 1, end["page"] + 1)])


class LandedPages(DataSource):
    """Rows (``page``, ``body``); options ``path``, ``pagesPerTask``, and ``firstPage`` for streams."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)


def read_pages(spark: SparkSession, path: str, pages_per_task: int = 16) -> DataFrame:
    """All landed pages, a row each."""
    spark.dataSource.register(LandedPages)
    return spark.read.format(FORMAT).option("pagesPerTask", pages_per_task).option("path", path).load()


def load_new_pages(spark: SparkSession, path: str, target: str, checkpoint: str, first_page: int = 1) -> None:
    """Append the pages that no earlier call with this checkpoint has read, and stop."""
    spark.dataSource.register(LandedPages)
    pages = spark.readStream.format(FORMAT).option("path", path).option("firstPage", first_page).load()
    query = pages.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
