"""Boards whose lists come in pages, as a data source that plans a partition for each board and country.

The answers are Parquet files under folders of board and facet (the country that the list was asked for; none for a list
of all), with the columns offset and body: what a crawler stores, one row for each page it got, in their order in each file. Conditions on board and
facet decide which partitions are planned; the pages of a partition are followed one by one, and none is read beyond the
list's end or the cap.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from wagewright.functions.places import CODES, COUNTRY_WORDS

FORMAT = "board_lists"
SCHEMA = "board string, facet string, ordinal long, posting string"
#: Postings in a page, by system.
PAGE = {"workday": 20, "oracle": 25}
#: Pages of a file that are held at a time, and postings whose pages are where files aren't in order.
BATCH, WINDOW = 64, 50_000
#: How a list says that a posting is in several places.
MANY_PLACES = re.compile(r"\d+ (?:locations|sedi|località|standorte|lieux|locaties)", re.IGNORECASE)
NONE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class BoardPart(InputPartition):
    board: str
    facet: str | None
    folder: str


def page_of(system: str, body: str) -> tuple[int, list[dict]]:
    """(postings of the whole list, those of the page)."""
    said = json.loads(body or "{}")
    if system == "oracle":
        item = (said.get("items") or [{}])[0]
        return item.get("TotalJobsCount") or 0, item.get("requisitionList") or []
    return said.get("total") or 0, said.get("jobPostings") or []


def observed(place: str | None) -> bool:
    """The place names an observed country, or says that it is one of several."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", (place or "").replace("ß", "ss")) if not unicodedata.combining(c))
    words = re.sub(r"[^a-z0-9]+", " ", re.sub("['’`]", "", plain.lower())).strip()
    named = any(re.search(rf"\b(?:{w})\b", words) for w in COUNTRY_WORDS.values())
    return named or bool(re.search(rf"(?i)\b(?:{COUNTRY_WORDS['IT']})\b", plain)) or MANY_PLACES.fullmatch(place or "") is not None


class ListReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.system = options["path"], options.get("system", "workday")
        self.cap = int(options["cap"]) if options.get("cap") else None
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Conditions on board and facet are taken; all others go back to Spark."""
        for f in filters:
            match f:
                case EqualTo(("board" | "facet" as column,), value):
                    values = {value}
                case In(("board" | "facet" as column,), several):
                    values = set(several)
                case _:
                    yield f
                    continue
            self.wanted[column] = self.wanted.get(column, values) & values

    def wants(self, column: str, value: str | None) -> bool:
        return column not in self.wanted or value in self.wanted[column]

    def partitions(self) -> list[BoardPart]:
        store, root = fs.FileSystem.from_uri(self.path)
        of = lambda folder, name: [(f.path, None if (v := unquote(f.base_name.removeprefix(f"{name}="))) == NONE else v) for f in store.get_file_info(fs.FileSelector(folder)) if f.base_name.startswith(f"{name}=")]
        boards = [(folder, board) for folder, board in of(root, "board") if self.wants("board", board)]
        return [BoardPart(board, facet, folder) for above, board in boards for folder, facet in of(above, "facet") if self.wants("facet", facet)]

    def pages(self, folder: str) -> Iterator[tuple[int, str]]:
        """The pages (offset, body) of a list by offset, the first of each. Files in order are merged, and a few pages of each
        are held; where one isn't, the files are gone through once for every WINDOW of offsets."""
        store, _ = fs.FileSystem.from_uri(self.path)
        found = ds.dataset(folder, format="parquet", filesystem=store, partitioning=None, exclude_invalid_files=True)

        def rows(file: str) -> Iterator[tuple[int, str]]:
            with pq.ParquetFile(store.open_input_file(file)) as one:
                for batch in one.iter_batches(BATCH, columns=["offset", "body"]):
                    yield from zip(batch.column("offset").to_pylist(), batch.column("body").to_pylist(), strict=True)

        def in_order(file: str) -> bool:
            offsets = pq.read_table(file, columns=["offset"], filesystem=store, partitioning=None).column("offset")
            return offsets.null_count == 0 and pc.all(pc.greater_equal(offsets[1:], offsets[:-1])).as_py() is not False

        files = sorted(found.files)
        if all(map(in_order, files)):
            merged = heapq.merge(*map(rows, files), key=lambda row: row[0])
        else:
            most = pc.max(found.to_table(columns=["offset"]).column("offset")).as_py()
            windows = (found.to_table(columns=["offset", "body"], filter=(ds.field("offset") >= k) & (ds.field("offset") < k + WINDOW)) for k in range(0, (most or 0) + 1, WINDOW))
            merged = (row for w in windows for row in sorted(zip(w.column("offset").to_pylist(), w.column("body").to_pylist(), strict=True), key=lambda row: row[0]))
        last = None
        for offset, body in merged:
            if offset != last:
                yield offset, body
            last = offset

    def read(self, partition: BoardPart) -> Iterator[tuple]:
        offset, kept, total = 0, 0, None
        for at, body in self.pages(partition.folder):
            if at < offset:
                continue
            if at > offset or self.cap is not None and kept >= self.cap:
                break
            of_all, postings = page_of(self.system, body)
            total = of_all if total is None else total
            for i, posting in enumerate(postings):
                # A list of all countries is narrowed here, and what is left out doesn't count towards the cap.
                if self.system == "workday" and partition.facet is None and not observed(posting.get("locationsText")):
                    continue
                if self.cap is None or kept < self.cap:
                    kept += 1
                    yield partition.board, partition.facet, offset + i, json.dumps(posting, ensure_ascii=False)
            offset += PAGE[self.system]
            if not postings or offset >= total:
                break


class BoardLists(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListReader(dict(self.options))


def board_lists(spark: SparkSession, path: str, system: str, cap: int | None = None) -> DataFrame:
    """board, facet, ordinal, posting (JSON) of the lists under path; at most ``cap`` of each board and facet.

    Conditions on board and facet that are put on the result reach the plan of the partitions.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BoardLists)
    reader = spark.read.format(FORMAT).option("system", system)
    return (reader.option("cap", str(cap)) if cap is not None else reader).load(path)


def store_lists(pages: DataFrame, path: str) -> None:
    """Pages (board, facet, offset, body) to where ``board_lists`` reads them, in the order in which it follows them."""
    dealt = pages.select("board", "facet", "offset", "body").repartition("board", "facet")
    dealt.sortWithinPartitions("board", "facet", "offset").write.partitionBy("board", "facet").parquet(path)
