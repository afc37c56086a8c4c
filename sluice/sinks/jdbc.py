from __future__ import annotations

from pyspark.sql import DataFrame


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    *,
    batch_size: int = 1000,
    connections: int | None = None,
    **options: str,
) -> None:
    """Append rows to a database table, without regard to keys.

    ``connections`` limits how many tasks write at once. To skip or update keys that
    exist, use :class:`~sluice.sinks.DatabaseTable`.
    """
    writer = rows.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=str(batch_size), **options
    )
    if connections is not None:
        writer = writer.option("numPartitions", connections)
    # Never mode("ignore"): it would drop the whole batch once the table exists.
    writer.mode("append").save()
