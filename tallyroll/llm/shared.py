"""What the operators share: stored intermediate tables, global offsets, bounded samples."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, one of our own if all run on
    this machine, and an error otherwise."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="tallyroll-"))
    return _own_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, lineage cut, safe
    against lost executors. The shuffle files that led to it are removed at once."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, target_bytes: int) -> int:
    """Shuffle partitions that keep each near `target_bytes`, by the optimizer's size estimate
    of the whole input; at least the session's own number."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if estimate >= 1 << 60:  # the optimizer doesn't know
        return least
    return max(least, math.ceil(estimate / target_bytes))


def learning_share(id_col: str | Column, modulus: int, held_out: int) -> Column:
    """True where a row is held out: the contract's crc32 rule on the id as text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    remainder = F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus
    return remainder == held_out


def bounded_ids(rows: DataFrame, id_col: str, by: list[str], per_class: int) -> DataFrame:
    """At most `per_class` ids of each class: the one of least hash in each of `per_class`
    hash buckets. Minima combine before the shuffle, so a hot class costs no more than others."""
    h = F.xxhash64(id_col)
    return (
        rows.groupBy(*by, F.pmod(h, F.lit(per_class)).alias("_bucket"))
        .agg(F.min(F.struct(h.alias("h"), F.col(id_col).alias("id"))).alias("_least"))
        .select(*by, F.col("_least.id").alias(id_col))
    )


@dataclass(frozen=True)
class Counter:
    """A running sum of `weight` (rows if none) among rows of the same `group` (all if none)."""

    name: str
    group: str | None = None
    weight: str | None = None


@dataclass(frozen=True)
class Running:
    rows: DataFrame
    #: By counter name: (part, group, total), as many as partitions times groups.
    totals: dict[str, list[tuple[int, int, int]]]

    def total(self, name: str) -> int:
        return sum(t for _, _, t in self.totals[name])

    def before(self, counter: Counter, groups: int = 1) -> Column:
        """The counter's sum over all earlier rows of the whole table."""
        parts = 1 + max((p for p, _, _ in self.totals[counter.name]), default=-1)
        own = [0] * (parts * groups)
        for part, group, total in self.totals[counter.name]:
            own[part * groups + group] = total
        total, start = [0] * groups, []
        for i, v in enumerate(own):
            start.append(total[i % groups])
            total[i % groups] += v
        at = F.col("part") * groups + (F.col(counter.group) if counter.group else 0)
        return F.col(counter.name) + lookup(start, at)


def running(df: DataFrame, order: list[str], counters: list[Counter], name: str) -> Running:
    """Running sums in global `order` without a global sort in one task: range partitions are
    sorted and summed on their own, and the driver adds up one number a partition and group.
    Groups are small integers from 0, never null. The rows get `part` and one column a counter.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*fields, "part int", *(f"`{c.name}` long" for c in counters)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        totals: dict[str, dict[int, int]] = {c.name: {} for c in counters}
        for batch in batches:
            columns = [*batch.columns, pa.array([part] * batch.num_rows, pa.int32())]
            for c in counters:
                weight = _numbers(batch, c.weight, 1)
                group = _numbers(batch, c.group, 0)
                out, total = np.zeros(batch.num_rows, np.int64), totals[c.name]
                for g in np.unique(group).tolist():
                    at = group == g
                    upto = np.cumsum(weight[at]) + total.get(g, 0)
                    out[at] = upto - weight[at]
                    total[g] = int(upto[-1])
                columns.append(pa.array(out))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", *totals])

    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(in_order.mapInArrow(add, schema), name)
    totals = {}
    for c in counters:
        group = F.col(c.group).cast("int") if c.group else F.lit(0)
        weight = F.sum(c.weight) if c.weight else F.count("*")
        sums = rows.groupBy("part", group.alias("group")).agg(weight.alias("total")).collect()
        totals[c.name] = [(r.part, r.group, r.total) for r in sums]
    return Running(rows, totals)


def _numbers(batch: pa.RecordBatch, column: str | None, constant: int) -> np.ndarray:
    if column is None:
        return np.full(batch.num_rows, constant, np.int64)
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def lookup(values: list[int], index: Column) -> Column:
    """Element `index` of a small list that the driver made."""
    return F.element_at(F.split(F.lit(",".join(map(str, values or [0]))), ",").cast("array<bigint>"), index + 1)


def to_arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)
