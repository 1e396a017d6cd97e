"""Log records stitched on a stream: keyed state holds the open record of each source.

Lines of a source arrive in order from batch to batch; inside a batch they may come in any
order. A record leaves when the next header of its source arrives, `timeout` after the last line
of its source, or at a row whose `value` is null, which says that its source has ended. The
rows are those of `operators.logs.read_records(..., headless=True)` on the same lines, whatever the batches; only
lines that arrive after a time-out make a further row of their record and segment.
State of a source is at most `per_row` lines, and goes when the source ends or `expiry` after its time-out.
Time-outs need a stream that keeps running: Spark never ends an `availableNow` run that has timers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.logs import HEADER, LINES_PER_ROW, RECORD

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EXPIRY = 3_600_000
STITCHED = "source string, record long, segment long, stamp string, level string, logger string, message string"
OPEN = "record long, first long, segment long, stamp string, level string, logger string, flushed boolean, lines array<string>"

_stitched = Row("source", "record", "segment", "stamp", "level", "logger", "message")
_header = re.compile(HEADER, re.ASCII).match
_record = re.compile(RECORD.replace(r"\z", r"\Z"), re.ASCII).match


class Stitcher(StatefulProcessor):
    """One value per source holds its open record and the lines of it that have not left.

    Sources are many and mostly short, so a source costs one read and one write of state in a batch.
    """

    def __init__(self, per_row: int, timeout: int | None, expiry: int):
        self.per_row, self.timeout, self.expiry = per_row, timeout, expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch = sorted(((r["line_no"], r["value"]) for r in rows), key=lambda line: line[0])
        held = self.open.get()
        state, pending = self._opened(held)
        out: list[Row] = []
        for line_no, value in batch:
            if value is None:
                self._close(key, state, pending, out)
                state, pending = None, []
                continue
            if _header(value):
                self._close(key, state, pending, out)
                state, pending = [line_no, line_no, 0, "", "", "", False], []
            elif state is None:
                state = [None, line_no, 0, None, None, None, False]
            segment = (line_no - state[1]) // self.per_row
            if segment != state[2]:
                self._close(key, state, pending, out)
                state[2], pending = segment, []
            pending.append(value)
        self._forget_timers()
        if state is not None:
            state[6] = False
            self.open.update((*state, pending))
            if self.timeout is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout)
        elif held is not None:
            self.open.clear()
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """First the open lines leave, and their record may still go on; then the source is forgotten."""
        out: list[Row] = []
        state, pending = self._opened(self.open.get())
        if state is not None:
            if state[6]:
                self.open.clear()
            else:
                self._close(key, state, pending, out)
                state[6] = True
                self.open.update((*state, []))
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.expiry)
        return iter(out)

    @staticmethod
    def _opened(held: tuple | None) -> tuple[list | None, list[str]]:
        return (None, []) if held is None else (list(held[:-1]), list(held[-1]))

    def _close(self, key, state: list | None, pending: list[str], out: list[Row]) -> None:
        """The pending lines of a source become a row."""
        if not pending:
            return
        text = "\n".join(pending)
        record, _, segment, *_ = state
        message = text
        if record is not None and segment == 0 and not state[6] and state[3] == "":
            found = _record(text)
            state[3:6] = found.groups()[:3] if found else ("", "", "")
            message = found.group(4) if found else ""
        out.append(_stitched(key[0], record, segment, *state[3:6], message))

    def _forget_timers(self) -> None:
        if self.timeout is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)

    def close(self) -> None:
        pass


def stitch_stream(lines: DataFrame, per_row: int = LINES_PER_ROW, timeout: int | None = None, expiry: int = EXPIRY) -> DataFrame:
    """Records of a stream of `source, line_no, value`; times are in milliseconds, without `timeout` there are no timers.

    State is kept in RocksDB, so it may outgrow the memory of an executor.
    """
    lines.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stitched = (
        lines.select("source", "line_no", "value")
        .groupBy("source")
        .transformWithState(Stitcher(per_row, timeout, expiry), STITCHED, "Append", "None" if timeout is None else "ProcessingTime")
    )
    stamp = F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts")
    return stitched.select("source", "record", "segment", stamp, "level", "logger", "message")
