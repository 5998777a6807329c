"""Very many small files kept as members of tar archives.

A file system takes milliseconds to make a file, whatever its size, and its listing goes through the driver; archives of
some MB bound both by the bytes, not by the number of files.
"""

from __future__ import annotations

import io
import sys
import tarfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An archive ends with the member that takes it to this size; only a member has to fit into a task.
ARCHIVE_BYTES = 4 << 20


def _archives(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, nth = [], 0, 0
        made = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join([*blocks, bytes(1024)])], pa.binary())], ["archive"])
        for batch in batches:
            for content in batch.column(0):
                body = content.as_py()
                info = tarfile.TarInfo(f"{nth:012d}")
                info.size, nth = len(body), nth + 1
                blocks += [info.tobuf(tarfile.GNU_FORMAT), body, bytes(-len(body) % 512)]
                held += 512 + len(body)
                if held >= size:
                    yield made()
                    blocks, held = [], 0
        if blocks:
            yield made()

    return run


def to_archives(files: DataFrame, size: int = ARCHIVE_BYTES) -> DataFrame:
    """One row ``value`` per tar archive of ``files`` (column ``content``, not null); a member is named by its number."""
    return files.select("content").mapInArrow(_archives(size), "archive binary").selectExpr("cast(archive as string) as value")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            with tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r:") as archive:
                found = [(f"{path.as_py()}/{m.name}", m.size, archive.extractfile(m).read()) for m in archive if m.isfile()]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["path", "size_bytes", "content"])


def archived_files(archives: DataFrame) -> DataFrame:
    """``path, size_bytes, content`` of every file in tar ``archives`` (``path``, ``content``); a broken archive is an error."""
    return archives.select("path", "content").mapInArrow(_members, "path string, size_bytes long, content binary")


def _line_archives(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, of, part, lines, length = [], 0, None, 0, [], 0

        def close() -> None:
            nonlocal held
            body = b"".join(lines)
            info = tarfile.TarInfo(f"{of}.{part:06d}")
            info.size = len(body)
            blocks.extend([info.tobuf(tarfile.GNU_FORMAT), body, bytes(-len(body) % 512)])
            held += 512 + len(body)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join([*blocks, bytes(1024)])], pa.binary())], ["archive"])

        for batch in batches:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if lines and (file != of or length >= size):
                    close()
                    if held >= size:
                        yield made()
                        blocks, held = [], 0
                    part, lines, length = part + 1 if file == of else 0, [], 0
                of = file
                lines.append(line + b"\n")
                length += len(line) + 1
        if lines:
            close()
        if blocks:
            yield made()

    return run


def lines_to_archives(lines: DataFrame, size: int = ARCHIVE_BYTES) -> DataFrame:
    """One row ``value`` per tar archive of the text files that ``lines`` (``file``, ``line``) make, a null line being blank.

    The lines of a file have to lie together, in order and in one partition.  A member is named by its file and a
    number: a file of more than ``size`` bytes goes on in further members, so that none has to fit into a task.
    """
    rows = lines.select("file", F.coalesce("line", F.lit("")).cast("binary").alias("line"))
    return rows.mapInArrow(_line_archives(size), "archive binary").selectExpr("cast(archive as string) as value")


def _member_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            with tarfile.open(fileobj=io.BytesIO(content.as_py()), mode="r:") as archive:
                for member in archive:
                    file, part = member.name.rsplit(".", 1)
                    lines = archive.extractfile(member).read().splitlines()
                    columns = [pa.array([file] * len(lines), pa.string()), pa.array([int(part)] * len(lines), pa.int64())]
                    columns += [pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "block", "id", "line"])


def archived_lines(archives: DataFrame) -> DataFrame:
    """``file, block, id, line`` of every line in ``archives`` (``content``) as ``lines_to_archives`` makes them: the number
    of the member within its file, and the line's place in it."""
    rows = archives.select("content").mapInArrow(_member_lines, "file string, block long, id long, line binary")
    return rows.withColumn("line", F.col("line").cast("string"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
