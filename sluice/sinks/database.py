"""Keyed writes into an SQL database through any DB-API driver.

Spark's own JDBC writer can only append, so conflicting keys need a statement of their
own. The rows are reduced to one per key first; each partition is then one transaction,
sent in chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row

from ..operators.keyed import first_per_key, latest_per_key, require_key
from ..specs import DatasetSpec
from .parquet import POSITION

CHUNK = 1000


def upsert_statement(
    table: str,
    columns: Sequence[str],
    key: str,
    policy: str,
    placeholder: str = "%s",
    event_time: str | None = None,
    rows: int = 1,
) -> str:
    """The insert for ``rows`` rows: ignoring a key that exists, or updating it.

    With ``event_time``, an update only happens if the row is not older than the stored one.
    """
    values = ", ".join([f"({', '.join([placeholder] * len(columns))})"] * rows)
    insert = f"INSERT INTO {table} ({', '.join(columns)}) VALUES {values} ON CONFLICT ({key}) "
    if policy == "ignore":
        return insert + "DO NOTHING"
    updates = ", ".join(f"{c} = excluded.{c}" for c in columns if c != key)
    newer = f" WHERE {table}.{event_time} <= excluded.{event_time}" if event_time else ""
    return f"{insert}DO UPDATE SET {updates}{newer}"


class DatabaseTable:
    """A database table with the policy of ``spec``.

    ``connect`` opens a connection; it is called on the executors, so it must be
    picklable. ``connections`` limits how many partitions write at once.
    """

    def __init__(
        self,
        spec: DatasetSpec,
        connect: Callable[[], Any],
        *,
        table: str | None = None,
        placeholder: str = "%s",
        guard: bool = True,
        connections: int = 8,
    ) -> None:
        self.spec, self.connect = spec, connect
        self.table, self.placeholder = table or spec.table, placeholder
        self.guard, self.connections = guard, connections

    def write(self, batch: DataFrame) -> None:
        spec = self.spec
        order = [spec.event_time, *[name for name in POSITION if name in batch.columns]]
        # One row per key also means that no key is in two transactions at once.
        pick = first_per_key if spec.policy == "ignore" else latest_per_key
        rows = pick(require_key(batch, spec.key), spec.key, order, nullable=False)
        rows = rows.drop(*POSITION)
        statement = partial(
            upsert_statement,
            self.table,
            rows.columns,
            spec.key,
            spec.policy,
            self.placeholder,
            spec.event_time if self.guard else None,
        )
        # Dealt out anew, so that only the writes pass through so few tasks.
        dealt = rows.repartition(self.connections)
        dealt.foreachPartition(_writer(self.connect, statement))


def _writer(
    connect: Callable[[], Any], statement: Callable[..., str]
) -> Callable[[Iterator[Row]], None]:
    def write(rows: Iterator[Row]) -> None:
        first = next(rows, None)
        if first is None:
            return
        connection = connect()
        try:
            cursor = connection.cursor()
            for chunk in _chunks(first, rows):
                cursor.execute(statement(rows=len(chunk)), [v for row in chunk for v in row])
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    return write


def _chunks(first: Row, rows: Iterator[Row]) -> Iterable[list[tuple]]:
    chunk = [tuple(first), *map(tuple, islice(rows, CHUNK - 1))]
    while chunk:
        yield chunk
        chunk = [tuple(row) for row in islice(rows, CHUNK)]
