"""Replay of stored records in event-time order, and release of a stream's records in that order."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from tidemark.functions import ids
from tidemark.operators import ingest as ing

RANGE_ROWS = 100_000
EPOCH = datetime(1970, 1, 1)


def replay_slices(
    records: DataFrame, ts: str, message: str, folder: str, start: datetime, end: datetime, step: timedelta
) -> None:
    """Write the records of [start, end) as topic envelopes, one time slice after the other.

    Each slice is one distributed job with pushed-down time bounds. It is dealt out by ranges of the time, and its
    files are numbered in the order of their ranges: read by name, the lines of a slice are in the order of
    (time, message). A slice overwrites its own folder ``slice=<seconds since 1970>``, so one that is written again repeats nothing.
    There is no sleeping between the slices; the caller paces them.
    """
    at = start
    while at < end:
        part = ing.time_range(records, ts, ids.moment(at), ids.moment(min(at + step, end)))
        ranges = max(1, -(-part.count() // RANGE_ROWS))
        ordered = part.repartitionByRange(ranges, ts, message).sortWithinPartitions(ts, message)
        sent = ing.envelope(F.col(message), F.col(ts), ordered)
        sent.write.mode("overwrite").json(f"{folder}/slice={(at - EPOCH) // timedelta(seconds=1)}")
        at += step


def in_event_order(stream: DataFrame, key: str, ts: str, tie: str, delay: str, tick_s: int = 1) -> DataFrame:
    """The rows of a stream with ``offset``, per ``key`` in the order of (``ts``, ``tie``) whatever order they come in.

    ``key`` is what order is asked within, as a topic keeps it within a partition; ``tie`` is a whole number. Rows
    are held by ticks of ``tick_s`` seconds of event time, as the state of a windowed aggregate. A tick is released, sorted, once
    the watermark, ``delay`` behind the newest row, has passed its end; ``offset`` counts the released rows of the key from 0,
    and for that a key's released ticks are numbered by one call a batch, rows are not handed to Python one by one. Rows of a
    tick that is already released are dropped, as are rows without key or time; those of the last ticks stay held until
    newer rows come. The state of a key is its held rows, so ``delay`` bounds it. Needs the RocksDB state store.
    """
    rest = [c for c in stream.columns if c not in (key, ts)]
    kind = stream.schema[key].dataType.simpleString()
    formats = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    known = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    row = F.struct(
        F.unix_micros(ts).alias("_at"), F.coalesce(F.col(tie).cast("bigint"), F.lit(-1)).alias("_tie"), F.to_json(F.struct(*rest), formats).alias("_row")
    )
    ticks = known.groupBy(F.col(key).alias("_key"), F.window(ts, f"{tick_s} seconds").alias("_tick")).agg(F.collect_list(row).alias("_rows"))
    ticks = ticks.select("_key", F.unix_micros("_tick.start").alias("_start"), F.size("_rows").alias("_n"), F.to_json(F.array_sort("_rows")).alias("_rows"))
    numbered = ticks.groupBy("_key").transformWithState(_Numbered(), f"_key {kind}, _first BIGINT, _rows STRING", "append", "None")
    listed = F.from_json("_rows", "array<struct<_at: bigint, _row: string>>")
    released = numbered.select("_key", "_first", F.posexplode(listed).alias("_place", "_x"))
    ddl = ", ".join(f"`{c}` {stream.schema[c].dataType.simpleString()}" for c in rest)
    whole = released.select(
        F.col("_key").alias(key), F.timestamp_micros("_x._at").alias(ts), F.from_json("_x._row", ddl, formats).alias("_row"),
        (F.col("_first") + F.col("_place")).alias("offset"),
    )
    return whole.select(*[F.col(c) if c in (key, ts) else F.col("_row")[c].alias(c) for c in stream.columns], "offset")


class _Numbered(StatefulProcessor):
    """Gives each released tick the number of rows of its key that were released before; see :func:`in_event_order`."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sent = handle.getValueState("sent", "n BIGINT")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        first = (self.sent.get() or (0,))[0]
        for row in sorted(rows, key=lambda r: r["_start"]):
            yield Row(_key=key[0], _first=first, _rows=row["_rows"])
            first += row["_n"]
        self.sent.update((first,))

    def close(self) -> None:
        """Nothing is held beside the state."""
