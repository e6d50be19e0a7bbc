"""Growing log files as a stream source: every complete line once, with a position per file.

The offset of a batch holds, for each file, how many bytes of it are read.  A file is known by its inode and its
first line, so one that is renamed by a rotation goes on where it was, and a new or rewritten one under an old name
starts at its beginning.  A last line without its end is left for a later batch.  The folder must be readable under the
same path by the driver and the executors.
"""

from __future__ import annotations

import fnmatch
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Send the classes themselves to the workers, which then need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 64 << 20   # of a file that one task reads
BLOCK_BYTES = 1 << 16


@dataclass
class Stretch(InputPartition):
    """Lines of a file that begin in [start, end), of which ``first`` says whether a line begins at start for sure."""

    name: str
    path: str
    start: int
    end: int
    first: bool


def _file_name(path: str) -> str | None:
    """Inode and checksum of the first line; None before a first line is complete, or where the file is gone."""
    try:
        with open(path, "rb") as file:
            inode, line = os.fstat(file.fileno()).st_ino, file.readline()
    except FileNotFoundError:
        return None
    return f"{inode}-{zlib.crc32(line):08x}" if line.endswith(b"\n") else None


def _complete(path: str) -> int:
    """Bytes up to the end of the last complete line."""
    with open(path, "rb") as file:
        at = file.seek(0, os.SEEK_END)
        while at > 0:
            start = max(0, at - BLOCK_BYTES)
            file.seek(start)
            found = file.read(at - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            at = start
    return 0


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.pattern = options["path"], options.get("pattern", "*")
        self.most = int(options.get("partbytes", PART_BYTES))

    def _files(self) -> dict[str, str]:
        names = sorted(n for n in os.listdir(self.folder) if fnmatch.fnmatch(n, self.pattern))
        paths = [os.path.join(self.folder, n) for n in names]
        return {name: p for p in paths if os.path.isfile(p) and (name := _file_name(p))}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        return {"files": {name: _complete(path) for name, path in self._files().items()}}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        paths, parts = self._files(), []
        for name, upto in sorted(end["files"].items()):
            at = start["files"].get(name, 0)
            first = True
            while at < upto:
                stop = min(upto, at + self.most)
                parts.append(Stretch(name, paths.get(name, ""), at, stop, first))
                at, first = stop, False
        return parts

    def read(self, partition: Stretch) -> Iterator[tuple]:
        path = partition.path
        if not path or _file_name(path) != partition.name:  # renamed since the batch was planned
            path = self._files().get(partition.name)
            if path is None:
                raise FileNotFoundError(f"the file {partition.name} that a batch begins in is gone from {self.folder}")
        with open(path, "rb") as file:
            file.seek(partition.start)
            if not partition.first:  # the line that runs into this stretch belongs to the one before
                file.seek(partition.start - 1)
                file.readline()
            while (at := file.tell()) < partition.end:
                yield file.readline().decode("utf-8", "replace").rstrip("\r\n"), os.path.basename(path), at

    def commit(self, end: dict) -> None:
        pass


class TailedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tailed"

    def schema(self) -> str:
        return "value string, file string, at long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailReader(self.options)


def tailed_messages(spark: SparkSession, folder: str, pattern: str = "*", part_bytes: int = PART_BYTES) -> DataFrame:
    """Lines appended to the files of ``folder`` as a stream of (value, file, at), ``at`` being the line's first byte."""
    spark.dataSource.register(TailedFiles)
    return (spark.readStream.format("tailed").option("pattern", pattern).option("partbytes", str(part_bytes)).load(folder))
