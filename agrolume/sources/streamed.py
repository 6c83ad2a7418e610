"""Files that have to be read from their start, streamed inside tasks.

Spark picks a codec by file name only, and takes a JSON list as one row.  Here a data
source opens a file through pyarrow's file systems (local, S3, HDFS and others), unpacks
it as it goes and hands over Arrow batches of lines, of records, or of the elements of a
JSON list.  A task holds a batch of about ``BATCH_CHARS`` characters and never a file;
parsing stays in the JVM.  A file is never cut: a gzip stream can't be entered midway;
many small files share a task.

A file system that only Spark knows goes through ``binaryFile`` instead, where the bytes
of a file (2 GB at most) stand in a row.
"""

from __future__ import annotations

import gzip
import io
import json
import re
from collections.abc import Iterator
from urllib.parse import quote
from weakref import WeakSet

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH_ROWS, BATCH_CHARS = 20_000, 4 << 20
#: A quoted field or a JSON element that runs on for so long is taken for a broken one, and told.
OPEN_CHARS = 16 << 20
#: What a task reads of many small files, and what opening one counts.
PART_BYTES, OPEN_BYTES = 32 << 20, 128 << 10
#: Characters of a JSON text read at once.
READ_CHARS = 1 << 20
SCHEMA = "file string, row bigint, value string"


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file as Spark names it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), re.sub("^/+", "/", rest) if colon else path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def reachable(path: str) -> bool:
    """Whether pyarrow has the file system of a path."""
    try:
        _located(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _opened(path: str):
    """The bytes of a file, unpacked if they are gzip."""
    system, inner = _located(path)
    with system.open_input_stream(inner) as start:
        packed = start.read(2) == b"\x1f\x8b"
    return _unpacked(system.open_input_stream(inner), packed)


def head(path: str, encoding: str) -> tuple[str | None, bool]:
    """The first line of a file, None if it is empty, and whether the file is gzip."""
    system, inner = _located(path)
    with io.BufferedReader(system.open_input_stream(inner)) as start:
        packed = start.peek(2)[:2] == b"\x1f\x8b"
        with io.TextIOWrapper(_unpacked(start, packed), encoding, errors="replace") as text:
            line = text.readline()
    return line.removeprefix("\ufeff").removesuffix("\n") if line else None, packed


def _unpacked(stream, packed: bool):
    return gzip.GzipFile(fileobj=stream) if packed else stream


def lines(text: io.TextIOBase) -> Iterator[str]:
    for line in text:
        yield line.rstrip("\r\n")


def records(text: io.TextIOBase, sep: str) -> Iterator[str]:
    """Lines, joined while a quoted field is open.  Only a quote that starts a field opens one."""
    field = rf"(?:^|{re.escape(sep)})[ \t]*\""
    closed = re.compile(rf'{field}(?:[^"]|"")*"(?!")')
    opens = re.compile(field)
    waiting, starts = "", ("", sep)
    for line in lines(text):
        # Most lines hold no quote, or one field in quotes.
        if not waiting and (
            '"' not in line or (line.count('"') == 2 and line[max(line.index('"') - 1, 0) : line.index('"')] in starts)
        ):
            yield line
            continue
        record = f"{waiting}\n{line}" if waiting else line
        if '"' in line or not waiting:
            if '"' not in record or not opens.search(closed.sub("", record)):
                yield record
                waiting = ""
                continue
        waiting = record
        if len(waiting) > OPEN_CHARS:
            raise ValueError(f"a quote stays open over {OPEN_CHARS} characters: {waiting[:200]}")
    if waiting:
        yield waiting


def elements(text: io.TextIOBase) -> Iterator[str]:
    """The elements of a JSON list as their texts; anything but a list has none."""
    find, blank, follows = json.JSONDecoder().raw_decode, re.compile(r"[\s,]*"), re.compile(r"\s*[,\]]")
    buffer = ""
    while not buffer:
        if not (buffer := text.read(READ_CHARS)):
            return
        buffer = buffer.lstrip("\ufeff \t\r\n")
    if buffer[0] != "[":
        return
    at = 1
    while True:
        at = blank.match(buffer, at).end()
        end = None
        if at < len(buffer):
            if buffer[at] == "]":
                return
            try:
                _, end = find(buffer, at)
            except json.JSONDecodeError as error:
                broken = error
            if end is not None and follows.match(buffer, end):  # else a number might go on
                yield buffer[at:end]
                at = end
                continue
        more = text.read(max(READ_CHARS, len(buffer) - at)) if len(buffer) - at <= OPEN_CHARS else ""
        if not more:
            raise ValueError("the JSON list is cut off") if at >= len(buffer) or end is not None else broken
        buffer, at = buffer[at:] + more, 0


def batches(name: str, stream, kind: str, sep: str, encoding: str) -> Iterator[pa.RecordBatch]:
    """The rows of one file."""
    encoding = "utf-8-sig" if encoding.upper() in ("UTF-8", "UTF8") else encoding
    text = io.TextIOWrapper(io.BufferedReader(stream, 1 << 20), encoding, newline="\n")
    found = {"lines": lines, "records": lambda t: records(t, sep), "elements": elements}[kind](text)
    row, values, chars = 0, [], 0
    names = ["file", "row", "value"]
    for value in found:
        values.append(value)
        chars += len(value)
        if len(values) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(range(row, row + len(values)), pa.int64()), pa.array(values, pa.string())], names=names)
            row, values, chars = row + len(values), [], 0
    if values:
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(range(row, row + len(values)), pa.int64()), pa.array(values, pa.string())], names=names)


def packed(paths: list[str], parts: int) -> list[list[str]]:
    """Files dealt to tasks, in turn: of up to ``parts`` files one each, of more about
    ``PART_BYTES`` or the ``parts``-th of all, whichever is less; a file counts ``OPEN_BYTES`` more."""
    if len(paths) <= parts:
        return [[path] for path in paths]
    stores: dict[str, tuple[fs.FileSystem, list[int], list[str]]] = {}
    for i, path in enumerate(paths):
        system, name = _located(path)
        _, places, names = stores.setdefault(re.match("(?:[^/:]*:)?(?://[^/]*)?", path)[0], (system, [], []))
        places.append(i)
        names.append(name)
    sizes = [0] * len(paths)
    for system, places, names in stores.values():
        for i, info in zip(places, system.get_file_info(names)):
            sizes[i] = (info.size or 0) + OPEN_BYTES
    share = min(PART_BYTES, sum(sizes) // parts)
    out, room = [], 0
    for path, size in zip(paths, sizes):
        if not out or size > room:
            out.append([])
            room = share
        out[-1].append(path)
        room -= size
    return out


class _Reader(DataSourceReader):
    """The paths go with the partitions; what is sent with every task is without them."""

    def __init__(self, options: dict):
        self.paths, self.parts = json.loads(options["paths"]), int(options["parts"])
        self.how = options["kind"], options["sep"], options["encoding"]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"paths": []}

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(paths) for paths in packed(self.paths, self.parts)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for path in partition.value:
            yield from batches(path, _opened(path), *self.how)


class StreamedFiles(DataSource):
    """(file, row from 0, value) of the files in ``paths``; many small ones share a partition."""

    @classmethod
    def name(cls) -> str:
        return "agrolume_streamed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        made = _Reader(dict(self.options))
        self.options = {}  # pickled with every task
        return made


_registered: WeakSet[SparkSession] = WeakSet()


def streamed(spark: SparkSession, files: list[str], kind: str = "lines", sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """(file, row, value) of ``files``, plain or gzip: ``lines``, ``records`` (lines joined
    inside quotes) or the ``elements`` of JSON lists."""
    if spark not in _registered:
        spark.dataSource.register(StreamedFiles)
        _registered.add(spark)
    near = [f for f in files if reachable(f)]
    far = [f for f in files if f not in set(near)]
    out = None
    if near:
        out = spark.read.format(StreamedFiles.name()).options(
            paths=json.dumps(near), parts=4 * spark.sparkContext.defaultParallelism, kind=kind, sep=sep, encoding=encoding
        ).load()
    if far:

        def taken(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in found:
                for name, content in zip(batch.column(0), batch.column(1)):
                    data = content.as_buffer()
                    packed = data.size > 1 and data[0:2].to_pybytes() == b"\x1f\x8b"
                    yield from batches(name.as_py(), _unpacked(pa.BufferReader(data), packed), kind, sep, encoding)

        rest = spark.read.format("binaryFile").load(far).select("path", "content").repartition(len(far), F.col("path")).mapInArrow(taken, SCHEMA)
        out = rest if out is None else out.union(rest)
    return spark.createDataFrame([], SCHEMA) if out is None else out
