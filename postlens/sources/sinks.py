"""Report files as data sources: one CSV (with a mark of its encoding, where asked) or one Markdown document, written by tasks.

Tasks write their rows as parts beside the target; when all have ended well the driver strings the parts together
in order of their keys, and moves the file to its place in one step. If a task fails, the parts go and the file
that was there before stays as it was. The driver copies bytes from file to file and never holds the rows.

    df.write.format("report_csv").option("path", "/reports/exceptions.csv").option("bom", True).mode("overwrite").save()
    df.write.format("report_markdown").option("path", ...).option("title", ...).option("section", "platform").mode("overwrite").save()

Sort the rows by range first (``df.orderBy``) where their order matters: parts follow the order of partitions.
"""

from __future__ import annotations

import csv
import io
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType


@dataclass
class Part(WriterCommitMessage):
    partition: int
    path: str
    rows: int


class _FileWriter(DataSourceWriter):
    """One file from the parts of all tasks. Columns: the rows' own, in order."""

    def __init__(self, options, schema: StructType, overwrite: bool):
        self.path = options["path"].removeprefix("file://")
        self.options, self.columns, self.overwrite = dict(options), schema.names, overwrite
        self.parts = f"{self.path}._parts-{uuid.uuid4().hex[:12]}"
        if os.path.exists(self.path) and not overwrite:
            raise FileExistsError(self.path)
        os.makedirs(self.parts)

    def lines(self, rows: Iterator[Row]) -> Iterator[str]:
        raise NotImplementedError

    def head(self) -> str:
        return ""

    def write(self, iterator: Iterator[Row]) -> Part:
        number, rows = TaskContext.get().partitionId(), 0
        path = f"{self.parts}/{number:06}-{TaskContext.get().taskAttemptId()}"

        def counted() -> Iterator[Row]:
            nonlocal rows
            for row in iterator:
                rows += 1
                yield row

        with open(path, "w", encoding="utf-8", newline="") as file:
            file.writelines(self.lines(counted()))
        return Part(number, path, rows)

    def commit(self, messages: list[Part | None]) -> None:
        whole = f"{self.parts}/whole"
        with open(whole, "wb") as out:
            out.write(self.head().encode("utf-8-sig" if str(self.options.get("bom", "")).lower() == "true" else "utf-8"))
            for part in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
                with open(part.path, "rb") as file:
                    shutil.copyfileobj(file, out)
            out.flush()
            os.fsync(out.fileno())
        os.replace(whole, self.path)
        shutil.rmtree(self.parts)

    def abort(self, messages: list[Part | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


class _CsvWriter(_FileWriter):
    @staticmethod
    def text(value) -> str:
        """Lists by semicolons, in order and without repeats; nothing for null."""
        if value is None:
            return ""
        if isinstance(value, (list, tuple)) and not isinstance(value, Row):
            return ";".join(dict.fromkeys(str(v) for v in value if v is not None))
        return str(value).lower() if isinstance(value, bool) else str(value)

    def _row(self, values) -> str:
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerow(values)
        return out.getvalue()

    def head(self) -> str:
        return self._row(self.columns)

    def lines(self, rows: Iterator[Row]) -> Iterator[str]:
        for row in rows:
            yield self._row([self.text(v) for v in row])


class _MarkdownWriter(_FileWriter):
    """A title and a table; with ``section``, a heading and a table for each run of rows of equal value in that column.

    A run goes on over the border of two tasks if both know it: rows are to be sorted by range of the section.
    """

    @staticmethod
    def text(value) -> str:
        return _CsvWriter.text(value).replace("\\", "\\\\").replace("|", "\\|").replace("\r", "").replace("\n", "<br>")

    def head(self) -> str:
        title, note = self.options.get("title"), self.options.get("note")
        text = f"# {title}\n" if title else ""
        text += f"\n{note}\n" if note else ""
        return text + ("" if "section" in self.options else self._table_head())

    def _shown(self) -> list[str]:
        return [k for k in self.columns if k != self.options.get("section")]

    def _table_head(self) -> str:
        return "\n" + "".join("| " + " | ".join(r) + " |\n" for r in (self._shown(), ["---"] * len(self._shown())))

    def lines(self, rows: Iterator[Row]) -> Iterator[str]:
        section, last = self.options.get("section"), object()
        for row in rows:
            if section and row[section] != last:
                last = row[section]
                yield f"\n## {self.text(last)}\n" + self._table_head()
            yield "| " + " | ".join(self.text(row[k]) for k in self._shown()) + " |\n"


class ReportCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_csv"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _CsvWriter(self.options, schema, overwrite)


class ReportMarkdown(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_markdown"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _MarkdownWriter(self.options, schema, overwrite)


def write_report(df: DataFrame, path: str, order: list[str] | None = None, **options: str | bool) -> None:
    """One report file: CSV or Markdown by the name's end. Rows are sorted by ``section`` and ``order``, sections whole in a task."""
    spark = df.sparkSession
    spark.dataSource.register(ReportCsv)
    spark.dataSource.register(ReportMarkdown)
    section = options.get("section")
    keys = [*([section] if section else []), *(order or [])]
    if section:
        df = df.repartitionByRange(F.col(section)).sortWithinPartitions(*keys)
    elif keys:
        df = df.orderBy(*keys)
    kind = "report_markdown" if path.endswith(".md") else "report_csv"
    df.write.format(kind).options(path=path, **{k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}).mode("overwrite").save()
