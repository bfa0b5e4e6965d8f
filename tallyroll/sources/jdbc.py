"""Destination tables in a database, through Spark's JDBC source.

Connection options (`url`, `user`, `password`, `driver`) come from the caller and are
never stored here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.operators.manifest import append_new


def read_options(
    table: str,
    connection: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read by parallel tasks."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partitioned read needs both bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, table: str, connection: Mapping[str, str], **partitioning) -> DataFrame:
    options = read_options(table, connection, **partitioning)
    return spark.read.format("jdbc").options(**options).load()


def write_options(
    table: str, connection: Mapping[str, str], connections: int = 16, batch_size: int = 10_000
) -> dict[str, str]:
    """Writer options; `numPartitions` bounds how many connections are open at once."""
    return {
        **connection,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }


def append_table(rows: DataFrame, table: str, connection: Mapping[str, str], **sizes) -> None:
    rows.write.format("jdbc").options(**write_options(table, connection, **sizes)).mode("append").save()


def append_missing(
    rows: DataFrame, table: str, connection: Mapping[str, str], keys: Sequence[str], **sizes
) -> None:
    """Append the rows whose key the table does not hold, so a repeated call adds nothing.

    Only the key columns of the table are read.
    """
    held = read_table(rows.sparkSession, table, connection).select(*[F.col(k) for k in keys])
    append_table(append_new(held, rows, keys), table, connection, **sizes)
