"""A paged catalog as a Spark data source. The transport is injected, so nothing here opens a connection.

spark.dataSource.register(CatalogSource)
spark.read.format("ledgerloom_catalog").option("transport", "package.module:function").option("congresses", "117,118").load()
"""

from __future__ import annotations

import importlib
import json
import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "package_id string, title string, doc_class string, congress string, date_issued string"
ATTEMPTS = 3


class CatalogSource(DataSource):
    """transport(congress, offset, page_size) gives (list of dicts, whether there is a next page); with an option `source` it gets that as well. A partition reads one congress."""

    @classmethod
    def name(cls) -> str:
        return "ledgerloom_catalog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CatalogReader:
        return CatalogReader(self.options)


class CatalogReader(DataSourceReader):
    def __init__(self, options):
        self.transport, self.page_size = options["transport"], int(options.get("page_size", "100"))
        self.congresses, self.wait, self.source = options["congresses"].split(","), float(options.get("wait", "1")), options.get("source")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(c) for c in self.congresses]

    def read(self, partition: InputPartition):
        module, function = self.transport.split(":")
        fetch, offset = getattr(importlib.import_module(module), function), 0
        while True:
            rows, more = self._page(fetch, partition.value, offset)
            for r in rows:
                yield tuple(r.get(f.split()[0]) for f in SCHEMA.split(", "))
            if not more or len(rows) < self.page_size:  # a short page is the last one
                return
            offset += len(rows)

    def _page(self, fetch, congress: str, offset: int):
        for attempt in range(ATTEMPTS):
            try:
                return fetch(congress, offset, self.page_size, *([self.source] if self.source else []))
            except OSError:
                if attempt + 1 == ATTEMPTS:
                    raise
                time.sleep(self.wait * 2**attempt)


def stored_listing(congress: str, offset: int, page_size: int, folder: str) -> tuple[list[dict], bool]:
    """A transport over a listing that was fetched before: JSON lines in folder/congress=C, a package a line, in order."""
    from pyarrow.fs import FileSelector, FileSystem

    files, at = FileSystem.from_uri(folder)
    lines = []
    for f in sorted(files.get_file_info(FileSelector(f"{at}/congress={congress}", allow_not_found=True)), key=lambda f: f.path):
        if f.base_name.endswith(".json"):
            with files.open_input_stream(f.path) as opened:
                lines += opened.read().decode().splitlines()
    return [json.loads(line) | {"congress": congress} for line in lines[offset : offset + page_size]], offset + page_size < len(lines)
