"""Landed payload files as a data source: a file is a partition, and filters decide which files are opened.

Collectors write each page's JSON to ``root/platform=.../date=.../[company=...,][region=...,]page=N.json``. The reader lists names
alone; filters on ``platform``, ``snapshot_date`` and ``page`` are answered from them before any file is opened, and files
are packed into partitions of bounded bytes. The root is a folder that all executors see.

    read_landed(spark, root).where("platform = 'baidu' AND snapshot_date = DATE'2024-01-01'")
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "platform string, snapshot_date date, company string, region string, page int, scraped_at string, payload string"
#: Bytes of files that one task reads, but for a single larger one.
TASK_BYTES = 32 << 20
_NAME = re.compile(r"(?:company=(?P<company>[^,/]*),)?(?:region=(?P<region>[^,/]*),)?page=(?P<page>\d+)\.json")
_COMPARE = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


@dataclass(frozen=True)
class Landed:
    """A file by its name."""

    path: str
    platform: str
    snapshot_date: dt.date
    company: str | None
    region: str | None
    page: int
    size: int


@dataclass
class Files(InputPartition):
    files: list[Landed]


def listed(root: str, platform=lambda p: True, day=lambda d: True) -> Iterator[Landed]:
    """Files below the folders whose names pass; the others are not even listed."""
    if not os.path.isdir(root):
        raise FileNotFoundError(root)
    for one in sorted(os.listdir(root)):
        name = one.removeprefix("platform=")
        if name == one or not platform(name):
            continue
        for other in sorted(os.listdir(f"{root}/{one}")):
            if not (m := re.fullmatch(r"date=(\d{4}-\d{2}-\d{2})", other)) or not day(dt.date.fromisoformat(m[1])):
                continue
            with os.scandir(f"{root}/{one}/{other}") as found:
                for x in sorted(found, key=lambda x: x.name):
                    if m2 := _NAME.fullmatch(x.name):
                        yield Landed(x.path, name, dt.date.fromisoformat(m[1]), m2["company"], m2["region"], int(m2["page"]), x.stat().st_size)


class LandedPayloads(DataSource):
    """``load(root)``: a row a page, its payload as it was landed. A file that is gone by then is an error, one that is no UTF-8 is read with marks."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"].removeprefix("file://"), int(self.options.get("taskBytes", TASK_BYTES)))


class _Reader(DataSourceReader):
    COLUMNS = ("platform", "snapshot_date", "company", "region", "page")

    def __init__(self, root: str, task_bytes: int):
        self.root, self.task_bytes = root, task_bytes
        self.wanted: dict[str, list] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column in self.COLUMNS and type(f) in _COMPARE:
                self.wanted.setdefault(column, []).append((type(f), f.value))
            elif column in self.COLUMNS and isinstance(f, In):
                self.wanted.setdefault(column, []).append((In, tuple(f.value)))
            else:
                yield f

    def _passes(self, column: str, value) -> bool:
        return all(value is not None and (value in v if kind is In else _COMPARE[kind](value, v)) for kind, v in self.wanted.get(column, ()))

    def partitions(self) -> list[Files]:
        out, size = [Files([])], 0
        for f in listed(self.root, lambda p: self._passes("platform", p), lambda d: self._passes("snapshot_date", d)):
            if not all(self._passes(c, getattr(f, c)) for c in ("company", "region", "page")):
                continue
            if out[-1].files and size + f.size > self.task_bytes:
                out.append(Files([]))
                size = 0
            out[-1].files.append(f)
            size += f.size
        return out

    def read(self, partition: Files) -> Iterator[tuple]:
        for f in partition.files:
            with open(f.path, encoding="utf-8", errors="replace") as file:
                at = dt.datetime.fromtimestamp(os.path.getmtime(f.path), dt.UTC).isoformat(timespec="seconds")
                yield f.platform, f.snapshot_date, f.company, f.region, f.page, at, file.read()


def read_landed(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """The pages below ``root``. Lets the session push filters into Python sources, which is off by default."""
    spark.dataSource.register(LandedPayloads)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("landed").options(**options).load(root)


def land(root: str, platform: str, day: str, page: int, payload: str, company: str | None = None, region: str | None = None) -> str:
    """Write one page where the reader finds it: beside its place first, then moved there."""
    folder = f"{root}/platform={platform}/date={day}"
    os.makedirs(folder, exist_ok=True)
    name = "".join(f"{k}={v}," for k, v in (("company", company), ("region", region)) if v) + f"page={page}.json"
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a name: {name}")
    with open(f"{folder}/.{name}", "w", encoding="utf-8") as file:
        file.write(payload)
    os.replace(f"{folder}/.{name}", f"{folder}/{name}")
    return f"{folder}/{name}"
