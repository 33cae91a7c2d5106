"""A topic of several partitions as a folder, with a streaming reader per partition.

    <folder>/<partition>/<first offset>-<last offset>.jsonl     lines of {"arrived_ms": ..., "value": ...}

It stands in for a broker where there is none: offsets count per partition, a segment is complete
once it is there under its name, and the folder must be one that every executor can open.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "partition int, offset bigint, arrived_ms bigint, value string"
_SEGMENT = re.compile(r"([0-9]+)-([0-9]+)\.jsonl")


def segments(folder: str, partition: int) -> list[tuple[int, int, str]]:
    """First offset, last offset and path of a partition's segments, in order."""
    place = os.path.join(folder, str(partition))
    named = [(_SEGMENT.fullmatch(name), name) for name in os.listdir(place)]
    return sorted((int(m[1]), int(m[2]), os.path.join(place, name)) for m, name in named if m)


def append(folder: str, partition: int, rows: list[tuple[int, str]]) -> None:
    """Appends (arrived_ms, value) rows to a partition as one segment; it shows up whole or not at all."""
    place = os.path.join(folder, str(partition))
    os.makedirs(place, exist_ok=True)
    held = segments(folder, partition)
    first = held[-1][1] + 1 if held else 0
    name = f"{first:020d}-{first + len(rows) - 1:020d}.jsonl"
    with open(os.path.join(place, f".{name}"), "w") as out:
        out.writelines(json.dumps({"arrived_ms": at, "value": value}) + "\n" for at, value in rows)
    os.rename(os.path.join(place, f".{name}"), os.path.join(place, name))


@dataclass
class Span(InputPartition):
    """Offsets from `first` up to but not including `end` of one partition."""

    partition: int
    first: int
    end: int


def ends(folder: str) -> dict[str, int]:
    """The offset behind the last one of every partition."""
    held = {name: segments(folder, int(name)) for name in os.listdir(folder) if name.isdigit()}
    return {name: found[-1][1] + 1 for name, found in sorted(held.items()) if found}


def read_span(folder: str, span: Span) -> Iterator[tuple[int, int, int, str]]:
    for first, last, path in segments(folder, span.partition):
        if last < span.first or first >= span.end:
            continue
        with open(path) as lines:
            for offset, line in enumerate(lines, first):
                if span.first <= offset < span.end:
                    row = json.loads(line)
                    yield span.partition, offset, row["arrived_ms"], row["value"]


class TopicReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Span]:
        return [Span(int(name), 0, end) for name, end in ends(self.folder).items()]

    def read(self, span: Span) -> Iterator[tuple[int, int, int, str]]:
        return read_span(self.folder, span)


class TopicStreamReader(DataSourceStreamReader):
    """A batch is one span per partition that has grown; partitions may join while the query runs."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict[str, int]:
        return {}

    def latestOffset(self) -> dict[str, int]:
        return ends(self.folder)

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        return [Span(int(name), start.get(name, 0), to) for name, to in end.items() if to > start.get(name, 0)]

    def read(self, span: Span) -> Iterator[tuple[int, int, int, str]]:
        return read_span(self.folder, span)


class TopicFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_folder"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema) -> TopicStreamReader:
        return TopicStreamReader(self.options["path"])


def topic(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """partition, offset, arrived_ms and value of all lines of a topic folder."""
    spark.dataSource.register(TopicFolder)
    return (spark.readStream if streaming else spark.read).format("topic_folder").load(folder)
