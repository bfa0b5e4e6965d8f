"""Sharding by differencing (Karmarkar-Karp), for groups that must stay together.

Partial partitions start as single groups (its bytes in one part, nothing in the others).
Again and again the two with the largest spread are combined, the largest part of one with
the smallest of the other. Each task does this for its share of the groups; the driver then
combines one partial partition a task in the same way, so nothing but those few numbers
leaves the tasks.

Defined cases. Text null: no bytes, the same group as empty text; every row counts one byte
more. Repeated rows are rows of their own. Ties go by digest of the text, then by id. No
documents: no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.shared import Counter, lookup, running, stored


def difference(partials: list[list[int]], parts: int) -> list[list[int]]:
    """Combine partial partitions (up to `parts` sums each) into one; for each of them, the
    final part that each of its sums went to."""
    parent: list[int] = []
    heap, nodes = [], []
    for order, sums in enumerate(partials):
        own = list(range(len(parent), len(parent) + len(sums)))
        parent += [-1] * len(sums)
        nodes.append(own)
        full = sorted(zip(sums, own, strict=True), reverse=True) + [(0, -1)] * (parts - len(sums))
        heap.append((full[-1][0] - full[0][0], order, full))
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = []
        for (x, i), (y, j) in zip(a, reversed(b), strict=True):
            if i < 0 or j < 0:
                both.append((x + y, max(i, j)))
            else:
                parent.append(-1)
                parent[i] = parent[j] = len(parent) - 1
                both.append((x + y, len(parent) - 1))
        both.sort(reverse=True)
        heapq.heappush(heap, (both[-1][0] - both[0][0], order, both))
        order += 1
    label = [0] * len(parent)
    for k, (_, node) in enumerate(heap[0][2] if heap else []):
        if node >= 0:
            label[node] = k
    for node in reversed(range(len(parent))):
        if parent[node] >= 0:
            label[node] = label[parent[node]]
    return [[label[n] for n in own] for own in nodes]


def balanced_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups_per_task: int = 200_000,
) -> DataFrame:
    """Rows (id, size, text_crc32, shard, slot): equal texts share a shard, and the shards'
    bytes are as even as differencing makes them. `groups_per_task` bounds a task's memory."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    tasks = max(1, math.ceil(rows.count() / groups_per_task))
    tasks = max(tasks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = TaskContext.get().partitionId(), []
        for batch in batches:
            own += zip(batch.column("bytes").to_pylist(), batch.column("digest").to_pylist(), strict=True)
        own.sort(reverse=True)
        label = difference([[size] for size, _ in own], shards)
        for at in range(0, len(own), 10_000):
            some = own[at : at + 10_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array([d for _, d in some], pa.binary()),
                    "bytes": pa.array([b for b, _ in some], pa.int64()),
                    "task": pa.array([task] * len(some), pa.int32()),
                    "label": pa.array([x for (x,) in label[at : at + 10_000]], pa.int32()),
                }
            )

    split_groups = stored(
        groups.repartition(tasks, "digest").mapInArrow(split, "digest binary, bytes long, task int, label int"),
        "shard-groups",
    )
    sums: dict[int, dict[int, int]] = {}
    for r in split_groups.groupBy("task", "label").agg(F.sum("bytes").alias("bytes")).collect():
        sums.setdefault(r.task, {})[r.label] = r.bytes
    order = sorted(sums)
    final = difference([[sums[t].get(k, 0) for k in range(shards)] for t in order], shards)
    table = [0] * ((max(order, default=-1) + 1) * shards)
    for t, labels in zip(order, final, strict=True):
        table[t * shards : (t + 1) * shards] = labels
    placed = rows.join(
        split_groups.select(
            "digest", lookup(table, F.col("task") * shards + F.col("label")).cast("int").alias("shard")
        ),
        "digest",
    ).select("id", "size", "text_crc32", "shard")
    slots = Counter("slot", group="shard")
    numbered = running(placed, ["id", "text_crc32"], [slots], "shard-slots")
    return numbered.rows.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", numbered.before(slots, shards).alias("slot")
    )


def shards(spark, sf_dir: str) -> DataFrame:
    """Query op8: all documents in 16 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return balanced_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
