"""Full refresh of a database table through Spark's JDBC writer."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from lakestrata import constants as K


def jdbc_full_refresh(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    publish: Callable[[str, str], None] | None = None,
    batch_rows: int = K.JDBC_BATCH_ROWS,
    connections: int = 16,
) -> None:
    """Replace the rows of ``table``.

    Tasks insert in parallel over at most ``connections`` connections, each
    in batches. Since tasks commit on their own, an atomic refresh needs
    ``publish(staging, table)``: rows then go to ``<table>__staging`` and the
    callable swaps the tables in one database transaction. Without it the
    table is truncated and filled directly.
    """
    destination = f"{table}__staging" if publish else table
    writer = (
        df.write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
    )
    writer.jdbc(url, destination, properties=dict(properties or {}))
    if publish:
        publish(destination, table)
