"""Statement files as they arrive.

A stream of ticks: at each one the folders are listed again, by tasks, and what the ledger doesn't
hold goes through the batch load. The ledger is the only state. The driver remembers no files,
a file of any age is taken, and a tick that is replayed after a crash adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyroll.plans.ingest import Limits, load_files
from tallyroll.sources.statements import list_files
from tallyroll.sources.tables import Tables


def unsettled(listed: DataFrame, errors: DataFrame) -> DataFrame:
    """Listed files without an error row that would come again; what could not be read is tried again."""
    settled = errors.where(~F.col("reason").startswith("unreadable")).select("file_path")
    return listed.join(settled, "file_path", "left_anti").select(*listed.columns)


def ticks(spark: SparkSession) -> DataFrame:
    """One row a trigger, and one in all with `availableNow`."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()


def ingest_arrivals(
    spark: SparkSession,
    tables: Tables,
    mapping: Mapping[str, Sequence[str]],
    root: str,
    checkpoint: str,
    limits: Limits = Limits(),
    interval: str | None = None,
    backfill_isrc: bool = False,
) -> StreamingQuery:
    """Start loading arrivals: all that is there now, or forever at an `interval`.

    Every tick lists all folders under the root. A file that was rejected gets one error row and is
    left to the batch load from then on; one that could not be read is tried again at each tick.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}

    def load(tick: DataFrame, tick_id: int) -> None:
        arrived = unsettled(list_files(spark, root), tables.read("error_summary"))
        load_files(tables, mapping, arrived, limits, backfill_isrc)

    return (
        ticks(spark)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
