"""One JSON object in one file, replaced atomically: a data source writer that commits by renaming.

The task that has the row writes it beside the destination under a name of its own; the driver's commit renames
that file over the destination. A failed or repeated task, and a job that does not commit, leave the old file as
it was. Files are reached through Arrow's file systems, so that the destination may be a local path or a URI of any shared one.

    spark.dataSource.register(OneJson)
    df.write.format("one_json").mode("overwrite").save("out/metadata.json")

The frame must have exactly one row. Fields are sorted by name at every level; null fields are kept.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


def place(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow.fs import FileSystem

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(os.path.abspath(path) if "://" not in path else path)


class OneJsonWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> Written:
        files, path = place(self.path)
        rows = [json.dumps(row.asDict(recursive=True), sort_keys=True, indent=2, ensure_ascii=False, default=str) for row in iterator]
        if not rows:
            return Written("", 0)
        folder, name = os.path.split(path)
        files.create_dir(folder, recursive=True)
        own = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(own) as out:
            out.write((rows[0] + "\n").encode("utf-8"))
        return Written(own, len(rows))

    def commit(self, messages: list[Written | None]) -> None:
        written = [m for m in messages if m is not None and m.rows]
        if sum(m.rows for m in written) != 1:
            self.abort(messages)
            raise ValueError(f"{self.path} takes one row, not {sum(m.rows for m in written)}")
        files, path = place(self.path)
        files.move(written[0].path, path)

    def abort(self, messages: list[Written | None]) -> None:
        files, _ = place(self.path)
        for m in messages:
            if m is not None and m.path:
                files.delete_file(m.path)


class OneJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "one_json"

    def schema(self) -> str:
        raise NotImplementedError("one_json only writes")

    def writer(self, schema, overwrite: bool) -> OneJsonWriter:
        return OneJsonWriter(self.options["path"])


def write_one(df: DataFrame, path: str) -> None:
    """The only row of `df` as the JSON file `path`."""
    df.sparkSession.dataSource.register(OneJson)
    df.coalesce(1).write.format("one_json").mode("overwrite").save(path)
