"""Running totals kept on a stream: the state of each key, brought forward in event time."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from decimal import Decimal
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..session import configure
from ..sinks.parquet import _settings
from ..specs import INVENTORY
from .windows import DELAY, watermarked

_TIMES = ("timestamp", "timestamp_ntz")
_WHOLE, _FLOATS = ("tinyint", "smallint", "int", "bigint"), ("float", "double")
# Groups of keys that share their state: Python is called per group and batch.
GROUPS = 1024
# Rows given out or put back at once.
CHUNK = 10_000
# A batch puts all its changes into the state and the next
# one takes most of them out: drop them from the store's files at once, and keep no more of the
# earlier versions of the state in the checkpoint than a restart needs. Stores of many partitions
# would also take some MB each for files that stay almost empty.
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": 2,
}


def _number(kind: str):
    """What turns the text of a value of this type into a number Python can add or order."""
    return int if kind in _WHOLE else float if kind in _FLOATS else Decimal


def _packed(held: object) -> bytes:
    """What goes to the state, which lies on local disks and in the checkpoint."""
    plain = pickle.dumps(held, pickle.HIGHEST_PROTOCOL)
    return len(plain).to_bytes(8) + pa.compress(plain, "zstd", asbytes=True)


def _unpacked(data: bytes) -> object:
    if data[:1] == pickle.PROTO:  # of a checkpoint from before states were compressed
        return pickle.loads(data)
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8]), "zstd", asbytes=True))


class _Totals(StatefulProcessor):
    """Holds the changes of a group of keys until the watermark has passed them, then adds them.

    State per group: the totals of its keys, and its changes of the last ``delay`` of event
    time, in chunks with the earliest time of each. A timer at the earliest of them fires once
    nothing earlier can come in any more. Chunks and totals are pickled, as going to the state
    once per row or key would take longer than the rest, and compressed, as all changes of a
    batch wait there for the watermark.
    """

    def __init__(self, given: Sequence[str], columns: Sequence[str], keys: Sequence[str], time: str,
                 added: str, tie: str, tie_number, number) -> None:
        self.given, self.columns, self.keys = list(given), list(columns), list(keys)
        self.held = list(dict.fromkeys([*columns, added]))
        self.time, self.added, self.number = time, added, number
        self.tie, self.tie_number = tie, tie_number

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "totals binary")
        self.waiting = handle.getListState("waiting", "earliest long, changes binary")

    def _chunk(self, changes: pd.DataFrame) -> tuple[int, bytes]:
        return int(changes[self.time].min()), _packed(changes)

    def _wake_at(self, chunks: Sequence[tuple[int, bytes]]) -> None:
        earliest = min(chunk[0] for chunk in chunks)
        self.handle.registerTimer(-(-earliest // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Columns come by place: names that start with an underscore are not kept.
        frames = (frame.set_axis(self.given, axis=1) for frame in rows)
        chunks = [self._chunk(frame[self.held]) for frame in frames]
        self.waiting.appendList(chunks)
        self._wake_at(chunks)
        return iter(())

    def _in_order(self, changes: pd.DataFrame) -> pd.DataFrame:
        ties = changes[self.tie]
        if self.tie_number is not None:
            ties = ties.map(self.tie_number, na_action="ignore")
        return changes.assign(_tie=ties).sort_values([self.time, "_tie"], na_position="first")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(chunk) for chunk in self.waiting.get()]
        later = [chunk for chunk in waiting if chunk[0] > passed]
        if len(later) == len(waiting):
            return
        met = pd.concat([_unpacked(c) for at, c in waiting if at <= passed], ignore_index=True)
        past = met[self.time] <= passed
        due, rest = self._in_order(met[past]), met[~past]
        later += [self._chunk(rest[at : at + CHUNK]) for at in range(0, len(rest), CHUNK)]
        held = self.totals.get()
        totals = _unpacked(held[0]) if held else {}
        ended = []
        for place, value in zip(zip(*[due[name] for name in self.keys]), due[self.added]):
            total = totals.get(place)
            if value is not None:
                total = totals[place] = self.number(value) + (total or 0)
            ended.append(None if total is None else str(total))
        self.totals.update((_packed(totals),))
        if later:
            self.waiting.put(later)
            self._wake_at(later)
        else:
            self.waiting.clear()
        out = due[self.columns].assign(_total=ended)
        for at in range(0, len(out), CHUNK):
            yield out[at : at + CHUNK]

    def close(self) -> None:
        pass


def _plain(name: str, kind: str) -> Column:
    # Times and numbers go through pandas as text, which no time zone and no NULL changes.
    if kind in _TIMES:
        return F.unix_micros(F.col(name).cast("timestamp")).cast("string").alias(name)
    return F.col(name).cast("string").alias(name) if _as_text(kind) else F.col(name)


def _restored(name: str, kind: str) -> Column:
    if kind in _TIMES:
        return F.timestamp_micros(F.col(name).cast("long")).cast(kind).alias(name)
    return F.col(name).cast(kind).alias(name)


def _as_text(kind: str) -> bool:
    return kind in (*_WHOLE, *_FLOATS, "boolean") or kind.startswith("decimal")


def running_totals(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    value: str,
    name: str,
    delay: str = DELAY,
    groups: int = GROUPS,
) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the key's rows up to and including each one.

    The stream's rows come out, in append mode, once the watermark has passed their ``time``:
    then no row that belongs before them can still come in, whatever order batches had. Rows
    that come in behind the watermark are left out (see ``late_rows``), as are rows without a
    time; NULL values repeat the total so far, as in the batch report. A batch that is
    repeated starts from the state before it, so its totals are the same.

    Keys are dealt by hash over ``groups``, which must stay the same for the life of a
    checkpoint. What a group's task holds is its changes of one batch and of the delay, and
    the totals of its keys; a batch rewrites the totals of the groups it meets. Pick more
    groups for more than some ten million keys.
    """
    kinds = dict(rows.dtypes)
    total = rows.groupBy().agg(F.sum(value)).schema[0].dataType.simpleString()
    columns = [c for c in rows.columns if c != "_time"]
    plain = rows.where(F.col(time).isNotNull()).withColumn("_time", F.col(time).cast("timestamp"))
    at = F.unix_micros(F.col(time).cast("timestamp")).alias(time)
    # Whole numbers come as the text they are added from.
    added = value if kinds[value] in _WHOLE and total in _WHOLE else "_add"
    amount = [F.col(value).cast(total).cast("string").alias(added)] if added == "_add" else []
    plain = watermarked(plain, "_time", delay).select(
        F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("_group"),
        "_time",
        *[at if c == time else _plain(c, kinds[c]) for c in columns],
        *amount,
    )
    schema = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in plain.schema if field.name in columns
    )
    tie_number = _number(kinds[tie]) if kinds[tie] in _TIMES or _as_text(kinds[tie]) else None
    processor = _Totals(
        plain.columns, columns, keys, time, added, tie, tie_number, _number(total)
    )
    # The totals' column has a name of its own until the input's of that name is gone.
    out = plain.groupBy("_group").transformWithStateInPandas(
        processor, f"{schema}, _total string", "append", "eventTime"
    )
    kept = [_restored(c, kinds[c]) for c in columns if c != name]
    return out.select(*kept, F.col("_total").cast(total).alias(name))


def running_stock_stream(inventory: DataFrame, delay: str = DELAY) -> DataFrame:
    """Stock of each SKU in its warehouse after every change, as changes come in."""
    return running_totals(
        inventory.drop("current_stock"),
        keys=["item_sku", "warehouse_id"],
        time=INVENTORY.event_time,
        tie=INVENTORY.key,
        value="quantity_delta",
        name="current_stock",
        delay=delay,
    )


def keep_totals(
    totals: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Start a stream that adds ``totals``, running totals of a stream, to a Parquet folder.

    Its checkpoint can be continued from its last batches, and not from a hundred of them.
    """
    spark = configure(totals.sparkSession)
    writer = totals.writeStream.format("parquet").options(
        checkpointLocation=checkpoint, compression="zstd"
    )
    # A stream keeps the settings it is started with.
    with _settings(spark, _STATE):
        return (writer if trigger is None else writer.trigger(**trigger)).start(path)
