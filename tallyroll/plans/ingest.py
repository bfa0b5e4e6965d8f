"""The batch load: pending statement files into payments, songs, registry and ledger.

A run lists the pending files and resolves their headers once, writes that plan next to
the tables, and works through it in batches. A batch is bounded in files and bytes, so
what the driver holds (paths) and what is broadcast (one small row per file) is bounded
too, however many files a run finds. Files go in order of report date and path, whatever the
batches, so the tables do not depend on the limits. Each batch commits on its own; a run that dies
is continued by the next one.

A file that can't be read once its batch is under way is set apart, with an error row, and the
others load: files are probed again, and if that finds none, the batch is halved until the file
stands alone.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.operators import manifest, payments, rejects, songs
from tallyroll.operators.conform import conform
from tallyroll.operators.layout import layout_columns, resolve
from tallyroll.schemas import PAYMENT, Destination
from tallyroll.sources.statements import list_files, scan_statements, with_headers
from tallyroll.sources.tables import Tables

# Row width up to which files share one scan; beyond it the width doubles per scan.
_NARROW = 32
# How Spark names a file that can't be read, while planning and while scanning (fixed values).
_READ_FAILURES = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ_FILE", "FileNotFoundException")


class Limits(NamedTuple):
    """Bounds of one batch. A single larger file is a batch of its own."""

    files: int = 10_000
    bytes: int = 1 << 40


class Slice(NamedTuple):
    """Neighbouring files in load order, the smallest piece that batches are made of."""

    part: int
    by_files: int
    by_bytes: int


class Batch(NamedTuple):
    """The files of all slices from `first` to `last`."""

    first: Slice
    last: Slice

    def of(self, files: DataFrame) -> DataFrame:
        bounds = [F.struct(*[F.lit(v).alias(n) for n, v in zip(Slice._fields, s, strict=True)]) for s in self]
        return files.where(F.struct(*Slice._fields).between(*bounds))


class Run(NamedTuple):
    """What a run did: its id and the loads it committed."""

    run_id: str
    loads: list[str]


def in_slices(files: DataFrame, limits: Limits, count: int) -> DataFrame:
    """Files in load order, cut into slices within the limits: a range partition of the order each
    in pieces by its running numbers of files and bytes."""
    parts = max(1, math.ceil(count / max(1, limits.files)))
    ordered = files.repartitionByRange(parts, *songs.FILE_ORDER).withColumn("part", F.spark_partition_id())
    upto = Window.partitionBy("part").orderBy(*songs.FILE_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    before = F.count(F.lit(1)).over(upto), F.coalesce(F.sum("bytes").over(upto), F.lit(0))
    return ordered.withColumns(
        {
            "by_files": F.floor(before[0] / F.lit(limits.files)),
            "by_bytes": F.floor(before[1] / F.lit(limits.bytes)),
        }
    )


def plan_batches(slices: Sequence, limits: Limits) -> Iterator[Batch]:
    """Batches of neighbouring slices up to the limits, from the number and bytes of each one's files."""
    group: list = []
    for own in slices:
        held_files = sum(s.files for s in group) + own.files
        held_bytes = sum(s.bytes for s in group) + own.bytes
        if group and (held_files > limits.files or held_bytes > limits.bytes):
            yield _batch(group)
            group = []
        group.append(own)
    if group:
        yield _batch(group)


def _batch(slices: Sequence) -> Batch:
    first, last = (Slice(s.part, s.by_files, s.by_bytes) for s in (slices[0], slices[-1]))
    return Batch(first, last)


def used_positions(files: DataFrame, mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT) -> list:
    """Path and needed cell positions of each of a batch's files."""
    places = [F.array(c) if c.startswith("at_") else F.col(c) for c in layout_columns(mapping, to)]
    used = F.array_distinct(F.flatten(F.filter(F.array(*places), lambda p: p.isNotNull())))
    return files.select("path", F.filter(used, lambda p: p.isNotNull()).alias("used")).collect()


def scan_batch(spark: SparkSession, chosen: Sequence) -> DataFrame:
    """Rows of a batch's files, from one scan per width class (16 at the very most)."""
    classes: dict[int, list] = {}
    for file in chosen:
        width = max(file.used, default=0) + 1
        classes.setdefault(max(_NARROW, 1 << (width - 1).bit_length()), []).append(file)
    scans = [
        scan_statements(spark, [f.path for f in group], {p for f in group for p in f.used})
        for _, group in sorted(classes.items())
    ]
    return reduce(DataFrame.unionByName, scans)


def batch_payments(
    spark: SparkSession, files: DataFrame, mapping: Mapping[str, Sequence[str]], to: Destination = PAYMENT
) -> DataFrame:
    """Payment rows of a batch, with reject reasons; no shuffle, no Python.

    The file side of the join is one small row of facts and positions per file, broadcast up
    to a number of files that the default limits stay below (`conform`).
    """
    chosen = used_positions(files, mapping, to)
    rows = conform(scan_batch(spark, chosen), files, mapping, to)
    return payments.payment_rows(payments.fill_defaults(rows), to)


def plan_files(tables: Tables, mapping: Mapping[str, Sequence[str]], files: DataFrame) -> DataFrame:
    """Files not in the ledger, with identity, layout, sale category and any problem."""
    if "list_problem" not in files.columns:
        files = files.withColumn("list_problem", F.lit(None).cast("string"))
    waiting = manifest.pending(manifest.with_identity(files), tables.read("file_summary"))
    marked = manifest.repeated_identity(waiting)
    resolved = resolve(with_headers(marked), mapping, tables.destination())
    twice = F.when(F.col("repeats").isNotNull(), F.concat(F.lit("same deal, vendor and name as "), "repeats"))
    known = resolved.withColumn("problem", F.coalesce("list_problem", twice, "problem")).drop("list_problem", "repeats")
    return payments.with_sale_category(known, tables.read("sales_category_lookup"))


def stage_songs(tables: Tables, load_id: str, rows: DataFrame, backfill_isrc: bool = False) -> None:
    """Stage the song buckets that a load's payment rows change, with the versions they retire.

    Only buckets of songs in the rows are read, and only those with a new version are written. The
    backfill has to know a title's ISRCs, which are in any bucket, so with it the keys and dates of
    the whole song table are read.
    """
    bucket = tables.song_bucket()
    by_file = rows.withColumn("report_date", F.col("Report_Date"))
    incoming = songs.candidates(by_file, normalised=True, by=songs.FILE_ORDER).withColumn("bucket", bucket)
    incoming = _kept(tables, f"{load_id}-songs", incoming)
    filled = None
    if backfill_isrc:
        heirs = songs.heirs(songs.current(tables.songs()), incoming)
        heirs = _kept(tables, f"{load_id}-heirs", heirs)
        incoming = songs.backfilled(incoming.drop("bucket"), heirs).withColumn("bucket", bucket)
        incoming = _kept(tables, f"{load_id}-backfilled", incoming)
        filled = songs.filled_keys(heirs)
    named = _buckets(incoming)
    delta = songs.song_versions(songs.current(tables.songs(named)), incoming.drop("bucket"))
    delta = _kept(tables, f"{load_id}-versions", delta.withColumn("bucket", bucket))
    changed = set(_buckets(delta))
    if filled is not None:
        changed.update(_buckets(filled.withColumn("bucket", bucket)))
    if changed:
        tables.stage_songs(load_id, songs.snapshot(tables.songs(sorted(changed)), delta, filled), sorted(changed))


def _kept(tables: Tables, name: str, rows: DataFrame) -> DataFrame:
    path = f"{tables.base}/runs/{name}"
    rows.write.mode("overwrite").parquet(path)
    return tables.spark.read.schema(rows.schema).parquet(path)


def _buckets(rows: DataFrame) -> list[int]:
    """At most as many numbers as the song table has buckets."""
    return [r.bucket for r in rows.select("bucket").distinct().collect()]


def load_batch(
    tables: Tables, mapping: Mapping[str, Sequence[str]], files: DataFrame, load_id: str, backfill_isrc: bool = False
) -> str | None:
    """Load one batch and commit it; gives the id under which it was committed.

    Payment rows are written once. Files with a bad row get an error row, which also keeps their
    payment rows out of what is read. Where another run commits first, its files are taken out and
    the batch starts again; nothing is committed where none are left.
    """
    for attempt in itertools.count():
        own_id = load_id if not attempt else f"{load_id}-{attempt}"
        after = tables.last_commit()
        waiting = manifest.pending(files, tables.read("file_summary"))
        if waiting.isEmpty():
            return None
        rows = batch_payments(tables.spark, waiting, mapping, tables.destination())
        tables.stage("payment", own_id, rows)
        outcomes = _kept(tables, f"{own_id}-outcomes", payments.file_outcomes(tables.staged("payment", own_id)))
        tables.stage("error_summary", own_id, rejects.error_rows(rejects.row_problems(outcomes)))
        errors = tables.staged("error_summary", own_id)
        rows = rejects.accepted(tables.staged("payment", own_id), errors)
        accepted = rejects.accepted(waiting, errors)
        registry = tables.read("metadata_management")
        tables.stage("metadata_management", own_id, manifest.header_versions(accepted, registry))
        stage_songs(tables, own_id, rows, backfill_isrc)
        totals = payments.ledger_totals(outcomes)
        tables.stage("file_summary", own_id, payments.ledger_rows(accepted, totals))
        if tables.commit(own_id, after):
            return own_id


def _is_read_failure(error: PySparkException) -> bool:
    return any(name in str(error) for name in _READ_FAILURES)


def load_apart(
    tables: Tables, mapping: Mapping[str, Sequence[str]], files: DataFrame, load_id: str, backfill_isrc: bool = False
) -> list[str]:
    """Load a batch; files that can't be read any more get an error row and the others load."""
    try:
        done = load_batch(tables, mapping, files, load_id, backfill_isrc)
        return [done] if done else []
    except PySparkException as error:
        if not _is_read_failure(error):
            raise
        reason = f"unreadable file: {error.getCondition() or type(error).__name__}"

    def record(bad: DataFrame, name: str) -> str:
        tables.append("error_summary", name, rejects.error_rows(bad))
        return name

    probed = with_headers(files.select("file_path")).where("header_problem is not null")
    gone = _kept(tables, f"{load_id}-gone", probed.select("file_path", F.col("header_problem").alias("reason")))
    if not gone.isEmpty():
        done = [record(gone, f"{load_id}-gone")]
        left = rejects.accepted(files, gone)
        return done if left.isEmpty() else done + load_apart(tables, mapping, left, f"{load_id}-rest", backfill_isrc)
    order = [tuple(r) for r in files.select(*songs.FILE_ORDER).orderBy(*songs.FILE_ORDER).collect()]
    if len(order) == 1:
        return [record(files.select("file_path", F.lit(reason).alias("reason")), f"{load_id}-unread")]
    middle = F.struct(*[F.lit(v).alias(n) for n, v in zip(songs.FILE_ORDER, order[len(order) // 2], strict=True)])
    at = F.struct(*songs.FILE_ORDER)
    return load_apart(tables, mapping, files.where(at < middle), f"{load_id}-a", backfill_isrc) + load_apart(
        tables, mapping, files.where(at >= middle), f"{load_id}-b", backfill_isrc
    )


def load_files(
    tables: Tables,
    mapping: Mapping[str, Sequence[str]],
    files: DataFrame,
    limits: Limits = Limits(),
    backfill_isrc: bool = False,
) -> Run:
    """Load listed files (`path`, `file_path`, `bytes`) that are not loaded yet."""
    tables.refresh()
    run_id = uuid.uuid4().hex
    planned = _kept(tables, run_id, plan_files(tables, mapping, files))

    loads = []
    ruled_out = rejects.file_problems(planned)
    if not ruled_out.isEmpty():
        loads.append(f"{run_id}-files")
        tables.append("error_summary", loads[0], rejects.error_rows(ruled_out))

    loadable = rejects.loadable(planned)
    sliced = _kept(tables, f"{run_id}-slices", in_slices(loadable, limits, loadable.count()))
    slices = (
        sliced.groupBy(*Slice._fields)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
        .orderBy(*Slice._fields)
        .collect()
    )
    for number, batch in enumerate(plan_batches(slices, limits)):
        loads += load_apart(tables, mapping, batch.of(sliced), f"{run_id}-{number:06d}", backfill_isrc)
    return Run(run_id, loads)


def ingest(
    spark: SparkSession,
    tables: Tables,
    mapping: Mapping[str, Sequence[str]],
    *roots: str,
    folders: str = "*/*",
    limits: Limits = Limits(),
    backfill_isrc: bool = False,
) -> Run:
    """Load what is new under `<root>/<deal>/<vendor>/`.

    With `backfill_isrc`, a song without ISRC goes over to the first ISRC that a file knows for its
    artist, track and album, and later lines without one count for it (`songs.heirs`).
    """
    return load_files(tables, mapping, list_files(spark, *roots, folders=folders), limits, backfill_isrc)
