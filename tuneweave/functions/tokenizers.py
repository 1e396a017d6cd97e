"""Plugging in a sub-word tokenizer.

`load` returns an object with `encode(text) -> ids` and `decode(ids) -> text`. It
runs once per task; texts come in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...


Load = Callable[[], Tokenizer]


def token_ids(text: Column, load: Load) -> Column:
    """The ids of a text as `array<int>`; null stays null."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load()
        for batch in batches:
            yield batch.map(lambda t: None if t is None else list(tokenizer.encode(t)))

    return encode(text)


def cut_text(text: Column, load: Load, limit: int) -> Column:
    """`struct<text, n_tokens>`: the text cut to `limit` ids, and how many there were."""

    @F.pandas_udf("text string, n_tokens long")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = load()
        for batch in batches:
            ids = [[] if t is None else list(tokenizer.encode(t)) for t in batch]
            kept = [t if len(i) <= limit else tokenizer.decode(i[:limit]) for t, i in zip(batch, ids)]
            yield pd.DataFrame({"text": kept, "n_tokens": [len(i) for i in ids]})

    return cut(text)
