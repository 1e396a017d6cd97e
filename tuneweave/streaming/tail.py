r"""Tail of growing log files: a stream source that reads what was appended, from where it stopped.

Rows are `source, line_no, value`. `line_no` is the byte at which the line begins in its source:
it grows along the source and is known without reading what lies before. Use `numbered` where lines
are to be counted. A line belongs to a batch once its line feed is written; a half-written last line waits.

A file is known by device and inode, so a renamed file goes on where it was. Its `source` is the path it was first
seen at; a new file at that path (rotation) and a file that got shorter (truncation) go on in the
same source behind the bytes before. Writers must have left a file before it is rotated. Each
batch cuts what was appended into splits of at most `split` bytes, and a task reads one of them or several small
ones; the driver only looks at the sizes of files and at the last bytes of those that grew. Files must be
reachable by path from driver and executors.

    spark.dataSource.register(LogTail)
    spark.readStream.format("log_tail").option("path", folder).option("registry", file).load()

`registry` names a small file in which the driver keeps which source a file belongs to, across restarts.
Carriage returns before a line feed are dropped; bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT = 64 << 20
WINDOW = 1 << 16
# Bytes that opening a file counts as when small splits are put together.
OPEN_COST = 1 << 18


@dataclass
class Split(InputPartition):
    path: str
    file: str
    source: str
    base: int
    start: int
    stop: int
    end: int
    more: tuple[Split, ...] = ()  # small splits of other files, read by the same task


def local(path: str) -> str:
    return path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")


def identity(found: os.stat_result) -> str:
    return f"{found.st_dev}:{found.st_ino}"


def last_line_end(path: str, least: int, size: int) -> int:
    """Where the last whole line ends: after the last line feed, looked for backwards from `size`."""
    with open(path, "rb") as file:
        while size > least:
            at = max(least, size - WINDOW)
            file.seek(at)
            found = file.read(size - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            size = at
    return least


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = local(options["path"])
        self.pattern = options.get("pattern", "*")
        self.split = int(options.get("split", SPLIT))
        self.registry = local(options["registry"])

    def files(self) -> dict[str, tuple[str, int]]:
        found = {}
        for folder, folders, names in os.walk(self.folder):
            folders.sort()
            for name in sorted(fnmatch.filter(names, self.pattern)):
                path = os.path.join(folder, name)
                try:
                    stat = os.stat(path)
                except FileNotFoundError:
                    continue  # renamed or deleted since it was listed
                found[identity(stat)] = (path, stat.st_size)
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """For each file its path, source, the bytes of the source before it, and where its last whole line ends."""
        try:
            with open(self.registry, encoding="utf-8") as file:
                known = json.load(file)
        except FileNotFoundError:
            known = {}
        ends = known.setdefault("ends", {})  # bytes of each source so far
        owners = known.setdefault("files", {})
        out = {}
        for key, (path, size) in self.files().items():
            own = owners.get(key)
            if own is None or size < own["end"]:
                source = own["source"] if own else path
                own = {"source": source, "base": ends.get(source, 0), "end": 0}
            if size > own["end"]:
                own["end"] = last_line_end(path, own["end"], size)
            ends[own["source"]] = max(ends.get(own["source"], 0), own["base"] + own["end"])
            owners[key] = own
            out[key] = {"path": path, **own}
        os.makedirs(os.path.dirname(self.registry) or ".", exist_ok=True)
        with open(self.registry + ".new", "w", encoding="utf-8") as file:
            json.dump(known, file)
        os.replace(self.registry + ".new", self.registry)
        return out

    def partitions(self, start: dict, end: dict) -> list[Split]:
        splits: list[Split] = []
        small: list[Split] = []
        room = self.split

        def pack() -> None:
            if small:
                splits.append(replace(small[0], more=tuple(small[1:])))
                small.clear()

        for key, own in sorted(end.items()):
            before = start.get(key)
            # A shorter file is read from its beginning.
            at = before["end"] if before and before["base"] == own["base"] else 0
            for start_at in range(at, own["end"], self.split):
                stop = min(start_at + self.split, own["end"])
                found = Split(own["path"], key, own["source"], own["base"], start_at, stop, own["end"])
                cost = stop - start_at + OPEN_COST
                if cost > room:
                    pack()
                    room = self.split
                small.append(found)
                room -= cost
        pack()
        return splits

    def read(self, split: Split) -> Iterator[tuple]:
        """The lines that begin in the split, and in those put together with it."""
        for one in (split, *split.more):
            yield from self.lines(one)

    def lines(self, split: Split) -> Iterator[tuple]:
        with self.opened(split) as file:
            at = split.start
            if at:
                # The line that reaches into the split, if any, belongs to the split before.
                file.seek(at - 1)
                at += len(file.readline(split.end - at + 1)) - 1
            while at < split.stop:
                line = file.readline(split.end - at)
                if not line:
                    raise OSError(f"{split.path} ended before the lines up to byte {split.end} were read")
                yield split.source, split.base + at, line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace")
                at += len(line)

    def opened(self, split: Split):
        """The split's file, also when it was renamed since the batch was planned."""
        try:
            file = open(split.path, "rb")
            if identity(os.fstat(file.fileno())) == split.file:
                return file
            file.close()
        except FileNotFoundError:
            pass
        found = self.files().get(split.file)
        if found is None:
            raise FileNotFoundError(f"{split.path} was deleted before its lines up to byte {split.end} were read")
        return open(found[0], "rb")

    def commit(self, end: dict) -> None:
        pass


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "source string, line_no long, value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def follow(spark, folder: str, registry: str, **options: str) -> DataFrame:
    """The stream of lines appended to the files below a folder."""
    spark.dataSource.register(LogTail)
    return spark.readStream.format("log_tail").options(path=folder, registry=registry, **options).load()


def numbered(lines: DataFrame, block: int = 1 << 20) -> DataFrame:
    """Lines counted from 0 in each source instead of placed by bytes: counts of blocks first, then inside blocks."""
    blocked = lines.withColumn("_block", F.expr(f"line_no div {block}"))
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocked.groupBy("source", "_block").agg(F.count("*").alias("_n"))
    counts = counts.select("source", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("source", "_block").orderBy("line_no"))
    placed = blocked.withColumn("_at", inside).join(counts, ["source", "_block"])
    return placed.select("source", (F.col("_before") + F.col("_at") - 1).alias("line_no"), "value")
