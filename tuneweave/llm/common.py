"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that one step of a vectorised pass holds at a time, whatever the length of a text.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def with_result(df: DataFrame, result, fields: dict[str, str]) -> DataFrame:
    """`df` with the fields of the struct column `result`; columns of `df` with the same names are replaced.

    `fields` maps output names to fields of the struct.
    """
    taken = {name.lower() for name in fields}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    holder = "_result"
    while holder in {c.lower() for c in df.columns}:
        holder += "_"
    return df.select(*kept, result.alias(holder)).select(
        *kept, *[F.col(holder)[field].alias(name) for name, field in fields.items()]
    )


# Bytes of one Arrow batch: a batch is held by the JVM and by the worker, both as it is sent and as it is built.
BATCH = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """`df`, whose session sends batches of at most BATCH bytes to Python from now on, if it sent larger ones."""
    held = df.sparkSession.conf.get(_BATCH_SETTING).lower().removesuffix("b")
    if not held.isdigit() or int(held) > BATCH:
        df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH))
    return df


def release() -> None:
    """Gives memory that is no longer used back to the machine: workers share an executor's with its JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not a GNU system


def map_batches(df: DataFrame, schema: str, function: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """mapInArrow over dicts of columns: `function` gets {name: pyarrow array} and yields {name: values}."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (dict(zip(b.schema.names, b.columns)) for b in batches)
        for out in function(columns):
            arrays = [
                out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
            release()

    return bounded(df).mapInArrow(run, fields)


def kept_rows(docs: DataFrame, load: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of `docs` whose text the loaded function accepts, with all their columns: each row passes Arrow once."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = load()
        for batch in batches:
            yield batch.filter(pa.array([accept(t.as_py()) for t in batch.column(at)], pa.bool_()))
            release()

    return bounded(docs).mapInArrow(run, docs.schema)


def letters(text: str) -> bool:
    """Whether the text holds a letter of any script."""
    return any(map(str.isalpha, text))


def four_grams(data: bytes, bits: int) -> Iterator[np.ndarray]:
    """Buckets of all overlapping four-byte grams of `data`, chunk after chunk; a shorter text is padded with spaces."""
    if len(data) < 4:
        data = data + b" " * (4 - len(data))
    for start in range(0, len(data) - 3, CHUNK):
        count = min(CHUNK, len(data) - 3 - start)
        grams = np.ndarray((count,), "<u4", data, start, (1,))
        yield (grams * np.uint32(2654435761)) >> np.uint32(32 - bits)


class Frequent:
    """Lossy counter: keeps every value whose share of all values added is at least `share`, in bounded memory."""

    def __init__(self, share: float):
        self.share, self.counts, self.seen, self.dropped, self.next = share, Counter(), 0, 0, int(4 / share)

    def add(self, values: Iterable, count: int) -> None:
        self.counts.update(values)
        self.seen += count
        if len(self.counts) > self.next:
            self.dropped = max(self.dropped, int(self.seen * self.share / 4))
            self.counts = Counter({k: v for k, v in self.counts.items() if v > self.dropped})
            self.next = max(int(4 / self.share), 2 * len(self.counts))

    def result(self) -> dict:
        floor = max(1, self.seen * self.share / 2)
        return {k: v for k, v in self.counts.items() if v >= floor}
