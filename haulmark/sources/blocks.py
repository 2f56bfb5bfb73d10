"""A Spark data source for text files: one partition a block, lines with their byte position.

A position does not depend on how a job happens to split its input, so it can be compared between
jobs and stored. A file may be in several parts, as Spark writes them: below a folder ``file=<name>``
the parts are read in order of their names and positions run on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "haulmark_lines"
SCHEMA = "file string, pos bigint, text string"
BLOCK_BYTES = 32 << 20
TAIL_BYTES = 1 << 16
BATCH_LINES = 20_000
FOLDER = "file="
MARK = b"\xef\xbb\xbf"


def open_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path; Hadoop also writes file:/path for a local one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


@dataclass
class Block(InputPartition):
    """Bytes ``start`` up to ``stop`` of one part; ``base`` bytes of the file lie in earlier parts."""

    file: str
    path: str
    start: int
    stop: int
    base: int


@dataclass
class Head(InputPartition):
    """The parts of one file, for its first lines."""

    file: str
    parts: list[tuple[str, int]]


def _name(path: str) -> str:
    folder, _, base = path.rpartition("/")
    folder = folder.rsplit("/", 1)[-1]
    return unquote(folder.removeprefix(FOLDER)) if folder.startswith(FOLDER) else base


def listed(paths: list[str]) -> dict[str, list[tuple[str, int]]]:
    """Parts (path, bytes) of every file at or below ``paths``, in order."""
    found: dict[str, int] = {}
    for path in paths:
        path = path.rstrip("/")
        files, root = open_path(path)
        # What a file system names without its scheme gets it back, so that a task can open it.
        scheme = path.removesuffix(root) if "://" in path else ""
        info = files.get_file_info(root)
        inside = [info] if info.type == pyarrow.fs.FileType.File else files.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        found |= {scheme + f.path: f.size for f in inside if f.type == pyarrow.fs.FileType.File and f.base_name[0] not in "._"}
    out: dict[str, list[tuple[str, int]]] = {}
    for path, size in sorted(found.items()):
        out.setdefault(_name(path), []).append((path, size))
    return out


def _own_lines(f: pa.NativeFile, block: Block) -> tuple[int, bytes]:
    """Where the first line that starts in the block begins, and the bytes of all such lines."""
    begin = block.start
    if begin:
        f.seek(begin - 1)
        data = f.read(block.stop - begin + 1)
        cut = data.find(b"\n") + 1
        if not cut:
            return block.stop, b""
        begin, data = begin - 1 + cut, data[cut:]
    else:
        data = f.read(block.stop)
    if begin >= block.stop:
        return begin, b""
    tail = [data]
    while not tail[-1].endswith(b"\n"):
        more = f.read(TAIL_BYTES)
        if not more:
            break
        end = more.find(b"\n") + 1
        tail.append(more[:end] if end else more)
    return begin, b"".join(tail)


def _rows(file: str, at: int, data: bytes) -> Iterator[pa.RecordBatch]:
    lines = data.split(b"\n")
    if not lines[-1]:
        lines.pop()
    for first in range(0, len(lines), BATCH_LINES):
        some = lines[first : first + BATCH_LINES]
        places, texts = [], []
        for line in some:
            places.append(at)
            texts.append((line.removeprefix(MARK) if at == 0 else line).decode("utf-8", "replace").removesuffix("\r"))
            at += len(line) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([file] * len(some), pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string())], names=["file", "pos", "text"]
        )


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"])
        self.head = int(options.get("head", 0))
        self.block_bytes = int(options.get("block_bytes", BLOCK_BYTES))

    def partitions(self) -> list[InputPartition]:
        files = listed(self.paths)
        if self.head:
            return [Head(n, parts) for n, parts in files.items()]
        out: list[InputPartition] = []
        for name, parts in files.items():
            base = 0
            for path, size in parts:
                out += [Block(name, path, a, min(a + self.block_bytes, size), base) for a in range(0, size, self.block_bytes)]
                base += size
        return out

    def read(self, partition: Block | Head) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Head):
            yield from self._first(partition)
        elif isinstance(partition, Block):
            files, path = open_path(partition.path)
            with files.open_input_file(path) as f:
                begin, data = _own_lines(f, partition)
            yield from _rows(partition.file, partition.base + begin, data)

    def _first(self, partition: Head) -> Iterator[pa.RecordBatch]:
        left, base = self.head, 0
        for name, size in partition.parts:
            if not left:
                return
            files, path = open_path(name)
            data = b""
            with files.open_input_stream(path) as f:
                while data.count(b"\n") < left and (more := f.read(TAIL_BYTES)):
                    data += more
            for batch in _rows(partition.file, base, b"\n".join(data.split(b"\n", left)[:left])):
                left -= batch.num_rows
                yield batch
            base += size


class LineFiles(DataSource):
    """``spark.read.format("haulmark_lines")`` with the options paths (a JSON list), head and block_bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)
