"""A paged HTTP interface as a batch data source: format("paginas")."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, TRIES = 5000, 3


def fetch(url: str, timeout: float = 30.0, tries: int = TRIES, opener: Callable = urllib.request.urlopen) -> dict:
    """One JSON answer; server errors are tried again, each time after a longer wait."""
    for k in range(tries):
        try:
            with opener(url, timeout=timeout) as r:
                return json.loads(r.read())
        except OSError as e:
            if k + 1 == tries or getattr(e, "code", 599) < 500:
                raise
            time.sleep(2**k)
    raise AssertionError


def pages(base: str, resource: str, fields: str, size: int = PAGE, get: Callable[[str], dict] = fetch) -> Iterator[dict]:
    """All rows of a resource, page by page, until its total or an empty page."""
    start = 0
    while True:
        query = urllib.parse.urlencode({"campos": fields, "inicio": start, "max": size})
        answer = get(f"{base.rstrip('/')}/{resource}?{query}")
        rows = answer.get(resource) or []
        yield from rows
        start += len(rows)
        if not rows or start >= int(answer.get("total") or 0):
            return


class PagedSource(DataSource):
    """Options: base, recurso, campos, tamano. One partition a page after the first, so that pages are read side by side."""

    @classmethod
    def name(cls) -> str:
        return "paginas"

    def schema(self) -> str:
        return "recurso string, fila string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.o = dict(options)
        self.size = int(self.o.get("tamano", PAGE))

    def _url(self, start: int, size: int) -> str:
        query = urllib.parse.urlencode({"campos": self.o.get("campos", "completo"), "inicio": start, "max": size})
        return f"{self.o['base'].rstrip('/')}/{self.o['recurso']}?{query}"

    def partitions(self) -> list[InputPartition]:
        total = int(fetch(self._url(0, 1)).get("total") or 0)
        return [InputPartition(k) for k in range(0, max(total, 1), self.size)]

    def read(self, partition: InputPartition):
        for row in fetch(self._url(partition.value, self.size)).get(self.o["recurso"]) or []:
            yield (self.o["recurso"], json.dumps(row, ensure_ascii=False))
