"""Paged sources: a table that comes in pages or by batches of ids, each of them verified.

What opens a page is a parameter: ``module:function``, called on executors.  It gets the address, an offset and a
limit and returns a list of records; a folder of pages stands in where there is no network.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.contracts import require_empty, set_difference

PAGE_ROWS = 5000
ID_BATCH = 500
BATCHES_IN_TASK = 200


class PageError(ValueError):
    """A page or batch that is not what was asked for."""


def opener_of(name: str) -> Callable[[str, int, int], list[dict]]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Page(InputPartition):
    def __init__(self, page: int, offset: int, rows: int) -> None:
        super().__init__(page)
        self.page, self.offset, self.rows = page, offset, rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.address, self.opener = options["address"], options["opener"]
        self.total, self.page_rows = int(options["total"]), int(options.get("page_rows", PAGE_ROWS))

    def partitions(self) -> list[_Page]:
        return [_Page(k, at, min(self.page_rows, self.total - at)) for k, at in enumerate(range(0, self.total, self.page_rows))] or [_Page(0, 0, 0)]

    def read(self, page: _Page) -> Iterator[tuple]:
        records = opener_of(self.opener)(self.address, page.offset, self.page_rows) if page.rows else []
        if len(records) != page.rows:
            raise PageError(f"page at offset {page.offset} of {self.address} has {len(records)} records instead of {page.rows}")
        for place, record in enumerate(records):
            yield page.page, page.offset + place, json.dumps(record, ensure_ascii=False)


class PagedSource(DataSource):
    """``spark.read.format("paged")`` with options address, opener, total and page_rows: a partition a page."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, place long, record string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options)


def scan(spark: SparkSession, address: str, opener: str, total: int, page_rows: int = PAGE_ROWS) -> DataFrame:
    """page, place, record (JSON) of all pages; a page of another length than announced fails the job."""
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(address=address, opener=opener, total=str(total), page_rows=str(page_rows)).load()


def fetched(ids: DataFrame, id_: str, address: str, opener: str, batch: int = ID_BATCH) -> DataFrame:
    """id, record (JSON) of every id, asked for in batches of at most ``batch``; ``opener`` is called with (address, ids).

    Ids are asked for in order, so a batch asks for neighbours, which a source keeps on few pages.  A batch must return
    exactly its ids, each once; anything else fails the job.
    """
    kind = ids.schema[id_].dataType.simpleString()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = opener_of(opener)
        for rows in batches:
            asked = rows.column(0).to_pylist()
            for at in range(0, len(asked), batch):
                own = asked[at : at + batch]
                records = open_(address, own)
                got = [r[id_] for r in records]
                if len(got) != len(own) or set(got) != set(own):
                    raise PageError(f"asked for {len(own)} ids from {own[0]} on, got {len(got)} records, {len(set(own) - set(got))} ids missing, {len(got) - len(set(got))} repeated")
                yield pa.RecordBatch.from_arrays([pa.array(got, rows.schema.field(0).type), pa.array([json.dumps(r, ensure_ascii=False) for r in records], pa.string())], names=["id", "record"])

    # A number of tasks that is given is kept: ids are small, so they would be merged into few tasks, which then wait for the source.
    asked = ids.select(id_).distinct()
    tasks = max(ids.sparkSession.sparkContext.defaultParallelism, 1 + asked.count() // (batch * BATCHES_IN_TASK))
    return asked.repartitionByRange(tasks, id_).sortWithinPartitions(id_).mapInArrow(fetch, f"id {kind}, record string")


def require_complete(rows: DataFrame, id_: str, expected: DataFrame) -> DataFrame:
    """``rows`` if they hold every id of ``expected`` exactly once and no other."""
    require_empty(rows.groupBy(id_).agg(F.count("*").alias("n")).where("n > 1"), "ids come more than once")
    require_empty(set_difference(expected.select(id_), rows.select(id_), id_), "ids are missing or not asked for")
    return rows


# A folder of pages, written by Spark as <address>/page=<number>/*.json, stands in for a network.


def _records(folder: str) -> list[dict]:
    from pyarrow import fs as stores  # starts threads, so only where a page is read

    fs, path = stores.FileSystem.from_uri(folder)
    found: list[dict] = []
    for file in sorted(f.path for f in fs.get_file_info(stores.FileSelector(path, allow_not_found=True)) if f.path.endswith(".json")):
        with fs.open_input_stream(file) as lines:
            found += [json.loads(line) for line in lines.read().decode().splitlines()]
    return found


def folder_page(address: str, offset: int, limit: int) -> list[dict]:
    return _records(f"{address}/page={offset // limit}")


def folder_ids(address: str, ids: list[int]) -> list[dict]:
    """Records of the ids from a folder <address>/page=<id // 100>."""
    wanted, found = set(ids), []
    for page in sorted({i // 100 for i in ids}):
        found += [r for r in _records(f"{address}/page={page}") if r["id"] in wanted]
    return found
