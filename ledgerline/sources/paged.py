"""A paged source (an API, or anything that gives records by page) as a Spark data source with pushed-down filters.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").schema("county string, amount double").options(
        fetcher="my.module:fetch", pages=40, per_task=5).load().filter("county = '72001'")

``fetch(page, payload)`` gives the records of a page (dicts), or None where there are no more; it runs on
the executors, a range of pages in each task.  Equality and IN filters on columns, and lower
and upper bounds, arrive in ``payload`` and needn't be applied again by Spark.
"""

from __future__ import annotations

import importlib
import random
import time
from collections.abc import Iterator

from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThanOrEqual,
)


def payload_of(filters: list[Filter]) -> tuple[dict, list[Filter]]:
    """What a request can say of the filters, and the filters that Spark must apply itself.

    All filters hold together: of several lists for a column what they share is
    asked for, of several bounds the strictest; bounds that don't compare are left to Spark.
    """
    payload: dict = {}
    rest = []
    for f in filters:
        if not isinstance(f, (EqualTo, In, GreaterThanOrEqual, LessThanOrEqual)) or len(f.attribute) != 1:
            rest.append(f)
            continue
        name = f.attribute[0]
        if isinstance(f, (EqualTo, In)):
            asked = [f.value] if isinstance(f, EqualTo) else list(f.value)
            equal = payload.setdefault("equal", {})
            equal[name] = [v for v in equal[name] if v in asked] if name in equal else asked
            continue
        side, strictest = ("from", max) if isinstance(f, GreaterThanOrEqual) else ("to", min)
        bounds = payload.setdefault(side, {})
        try:
            bounds[name] = strictest(bounds[name], f.value) if name in bounds else f.value
        except TypeError:
            rest.append(f)
    return payload, rest


def with_retries(call, tries: int = 4, wait: float = 0.5, sleep=time.sleep):
    """The call's result; failures are tried again after growing, jittered waits, the last one raises."""
    for n in range(tries):
        try:
            return call()
        except Exception:
            if n == tries - 1:
                raise
            sleep(wait * 2**n * (1 + random.random() / 4))


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options, self.payload = schema, dict(options), {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        self.payload, rest = payload_of(filters)
        yield from rest

    def partitions(self) -> list[InputPartition]:
        pages, step = int(self.options["pages"]), int(self.options.get("per_task", 10))
        return [_Range(p, min(p + step, pages + 1)) for p in range(1, pages + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        module, name = self.options["fetcher"].split(":")
        fetch = getattr(importlib.import_module(module), name)
        for page in range(partition.first, partition.last):
            records = with_retries(lambda p=page: fetch(p, self.payload))
            if records is None:
                return
            for r in records:
                yield tuple(r.get(f.name) for f in self.schema.fields)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)
