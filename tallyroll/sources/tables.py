"""Destination tables as Parquet, written per load and visible once committed.

A load writes its own `load_id=<id>` folder in each table. It is committed last, by a numbered file
in `commits` that holds its id and is only created where that number is not taken. A load that
dies part-way is therefore never seen: its files are still pending and the next run loads them
under a new id, without duplicates. Of two runs at once, one gets the number; the other sees that
it worked from an older state and has to start its load again.

Songs are kept in buckets of their key. A load writes whole buckets anew, those in which
something changed, with the versions it retired; a reader takes the last commit of each bucket.
Payment rows of files that the same load rejected stay in storage and are left out on reading.

The payment table's columns are data too (`payment_layout`): rows stored before a column was added
have null there.

Many small loads are merged by `compact`: it writes their rows as one load and, with the same commit,
which loads that one stands for. A reader lists commits before data, so it sees either the old folders
or the new one. `vacuum` deletes what no reader can need any more.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyroll import schemas

SCHEMAS = {
    "payment": schemas.PAYMENT.schema,
    "payment_layout": schemas.PAYMENT_LAYOUT,
    "song": schemas.SONG,
    "song_buckets": schemas.SONG_BUCKETS,
    "metadata_management": schemas.METADATA_MANAGEMENT,
    "file_summary": schemas.FILE_SUMMARY,
    "error_summary": schemas.ERROR_SUMMARY,
    "sales_category_lookup": schemas.SALES_CATEGORY_LOOKUP,
    "merged_loads": schemas.MERGED_LOADS,
}
PARTITIONS = {"payment": ["Report_Date"], "song": ["bucket"]}
# What `compact` clusters the rows of a table by. Not error rows: which load wrote one matters.
CLUSTERS = {
    "payment": ["Report_Date", "deal_name", "vendor_name", "File_Name"],
    "file_summary": schemas.FILE_KEY,
    "metadata_management": ["deal_name", "vendor_name", "report_date"],
}
_LOAD = T.StructField("load_id", T.StringType())
_BUCKET = T.StructField("bucket", T.IntegerType())


class Tables:
    """The tables under one base path of shared storage.

    `song_buckets` is the number of buckets of a new song table; an existing one keeps its own.
    The driver lists that many rows, so choose it by the table's size (a bucket is rewritten when one
    of its songs changes), not by the number of songs.
    """

    def __init__(self, spark: SparkSession, base: str, song_buckets: int = 256):
        self.spark = spark
        self.base = base.rstrip("/")
        self._song_buckets = song_buckets
        self._destination: schemas.Destination | None = None

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def create(self) -> Tables:
        """Make the tables that are not there yet; existing ones are left alone."""
        for name, schema in SCHEMAS.items():
            more = [_LOAD, *([_BUCKET] if name == "song" else [])]
            empty = self.spark.createDataFrame([], T.StructType([*schema.fields, *more]))
            empty.write.mode("ignore").partitionBy("load_id", *PARTITIONS.get(name, [])).parquet(
                self.path(name)
            )
        folder = self._java_path(self.path("commits"))
        self._file_system(folder).mkdirs(folder)
        return self

    # --- storage -----------------------------------------------------------------------

    def _java_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    # --- loads -------------------------------------------------------------------------

    def _schema(self, name: str) -> T.StructType:
        return self.destination().schema if name == "payment" else SCHEMAS[name]

    def stage(self, name: str, load_id: str, rows: DataFrame) -> None:
        """Write a load's rows of one table; writing the same load again replaces them."""
        rows.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self._schema(name).fields]
        ).write.mode("overwrite").partitionBy(*PARTITIONS.get(name, [])).parquet(
            f"{self.path(name)}/load_id={load_id}"
        )

    def staged(self, name: str, load_id: str) -> DataFrame:
        """What a load has written to one table, committed or not."""
        return self.spark.read.schema(self._schema(name)).parquet(f"{self.path(name)}/load_id={load_id}")

    def last_commit(self) -> int:
        """The number of the last commit, 0 before the first."""
        folder = self._java_path(self.path("commits"))
        names = [s.getPath().getName() for s in self._file_system(folder).listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def commit(self, load_id: str, after: int | None = None) -> bool:
        """Make a load visible. Given the commit it worked from, only as the very next one: false
        where another has come between, and the load stays unseen."""
        while True:
            number = (self.last_commit() if after is None else after) + 1
            path = self._java_path(f"{self.path('commits')}/{number:012d}")
            try:
                out = self._file_system(path).create(path, False)
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in str(error.java_exception.getClass()):
                    raise
                if after is not None:
                    return False
                continue
            out.write(bytearray(load_id.encode()))
            out.close()
            return True

    def commits(self) -> DataFrame:
        """Committed loads and their numbers."""
        files = self.spark.read.text(self.path("commits"), wholetext=True)
        return files.select(
            F.col("value").alias("load_id"),
            F.col("_metadata.file_name").cast("long").alias("number"),
            F.col("_metadata.file_modification_time").alias("committed"),
        )

    def _merged(self, commits: DataFrame) -> DataFrame:
        """Loads that a committed one stands for, by table."""
        schema = T.StructType([*schemas.MERGED_LOADS.fields, _LOAD])
        merged = self.spark.read.schema(schema).parquet(self.path("merged_loads"))
        return merged.join(commits, "load_id").withColumnsRenamed({"load_id": "into", "merged_id": "load_id"})

    def _visible(self, name: str) -> DataFrame:
        """Ids of the loads whose rows of a table are to be read."""
        commits = self.commits()
        merged = self._merged(commits).where(F.col("table_name") == name)
        return commits.select("load_id").join(merged, "load_id", "left_anti")

    def read(self, name: str) -> DataFrame:
        """Rows of committed loads in the table's columns, and their `load_id`."""
        if name == "song":
            return self.songs()
        # Commits are listed before data: what they name is there, and later loads are left out.
        visible = self._visible(name)
        schema = T.StructType([*self._schema(name).fields, _LOAD])
        rows = self.spark.read.schema(schema).parquet(self.path(name)).join(visible, "load_id", "left_semi")
        if name == "payment":
            rejected = self.read("error_summary").select("load_id", "file_path")
            rows = rows.join(rejected, ["load_id", "file_path"], "left_anti")
        return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])

    def append(self, name: str, load_id: str, rows: DataFrame) -> None:
        """A load of one table on its own, such as new lookup rows."""
        self.stage(name, load_id, rows)
        self.commit(load_id)

    # --- payment columns ---------------------------------------------------------------

    def destination(self) -> schemas.Destination:
        """The payment table's columns, as first asked for since `refresh`."""
        if self._destination is None:
            rows = self.read("payment_layout").join(self.commits(), "load_id")
            layouts = rows.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("place", "name"))).alias("columns"))
            last = layouts.orderBy(F.desc("number")).first()
            self._destination = schemas.destination(c.name for c in last.columns) if last else schemas.PAYMENT
        return self._destination

    def refresh(self) -> None:
        """Take up columns that others have added; each run begins with it and keeps what it finds."""
        self._destination = None

    def set_payment_columns(self, columns: Sequence[str]) -> None:
        """Give the payment table these columns from now on. Stored rows have null in new ones."""
        made = schemas.destination(columns)
        rows = self.spark.createDataFrame(list(enumerate(made.columns)), schemas.PAYMENT_LAYOUT)
        self.append("payment_layout", uuid.uuid4().hex, rows.coalesce(1))
        self.refresh()

    # --- upkeep ------------------------------------------------------------------------

    def compact(self, name: str = "payment", file_bytes: int = 256 << 20) -> str | None:
        """Write the rows of all loads of a table anew as one, in files of about the given size that
        hold neighbouring rows; gives its id, or None where another commit came first.

        Rows are spread by range over the cluster columns and, within them, by a hash of the row,
        so that a date or file that holds much of the table is shared among tasks. Only the payment
        table's present columns are kept.
        """
        if name not in CLUSTERS:
            raise ValueError(f"{name} is not a table to compact; these are: {', '.join(CLUSTERS)}")
        after, load_id = self.last_commit(), uuid.uuid4().hex
        visible, rows = self._visible(name), self.read(name).drop("load_id")
        size = sum(self._bytes(f"{self.path(name)}/load_id={r.load_id}") for r in visible.collect())
        spread = [*CLUSTERS[name], F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])]
        self.stage(name, load_id, rows.repartitionByRange(max(1, math.ceil(size / file_bytes)), *spread))
        merged = visible.select(F.lit(name).alias("table_name"), F.col("load_id").alias("merged_id"))
        self.stage("merged_loads", load_id, merged.coalesce(1))
        return load_id if self.commit(load_id, after) else None

    def _bytes(self, path: str) -> int:
        folder = self._java_path(path)
        system = self._file_system(folder)
        return system.getContentSummary(folder).getLength() if system.exists(folder) else 0

    def vacuum(self, older_than: float = 7 * 86_400) -> list[str]:
        """Delete what has been out of use for so many seconds; gives the deleted folders.

        That is: folders of loads that were merged, song buckets that were written anew, drafts of
        loads that were never committed, and plans of runs. Nothing that runs may be older.
        """
        past = F.col("committed") < F.timestamp_seconds(F.lit(time.time() - older_than))
        before = (time.time() - older_than) * 1000
        drafts = {name: self._old_folders(self.path(name), before) for name in SCHEMAS}
        commits = self.commits()
        gone = [
            f"{self.path(r.table_name)}/load_id={r.load_id}"
            for r in self._merged(commits).where(past).select("table_name", "load_id").distinct().collect()
        ]
        after = F.lead("committed").over(Window.partitionBy("bucket").orderBy("number"))
        written = self.read("song_buckets").join(commits, "load_id").withColumn("committed", after)
        gone += [
            f"{self.path('song')}/load_id={r.load_id}/bucket={r.bucket}"
            for r in written.where(past).select("load_id", "bucket").collect()
        ]
        known = {r.load_id for r in commits.select("load_id").collect()}
        for name, folders in drafts.items():
            gone += [f"{self.path(name)}/{f}" for f in folders if f.startswith("load_id=") and f[8:] not in known]
        gone += [f"{self.path('runs')}/{f}" for f in self._old_folders(self.path("runs"), before)]
        return [path for path in gone if self._delete(path)]

    def _old_folders(self, path: str, before: float) -> list[str]:
        """Names of a folder's children last changed before a time in milliseconds."""
        folder = self._java_path(path)
        system = self._file_system(folder)
        children = system.listStatus(folder) if system.exists(folder) else []
        return [s.getPath().getName() for s in children if s.isDirectory() and s.getModificationTime() < before]

    def _delete(self, path: str) -> bool:
        folder = self._java_path(path)
        return self._file_system(folder).delete(folder, True)

    # --- songs -------------------------------------------------------------------------

    def _last_buckets(self) -> list:
        """For each bucket that holds songs, the last load that wrote it: one row a bucket."""
        written = self.read("song_buckets").join(self.commits(), "load_id")
        return (
            written.groupBy("bucket").agg(F.max_by("load_id", "number").alias("load_id"), F.max("buckets").alias("buckets"))
        ).collect()

    def song_bucket(self) -> Column:
        """The bucket of a song, by its key."""
        for row in self._last_buckets()[:1]:
            self._song_buckets = row.buckets
        return F.pmod(F.xxhash64(*schemas.SONG_KEY), F.lit(self._song_buckets)).cast("int")

    def songs(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All versions as of the last commit, or those of some buckets; other folders are not read."""
        schema = T.StructType([*schemas.SONG.fields, _LOAD, _BUCKET])
        paths = [
            f"{self.path('song')}/load_id={r.load_id}/bucket={r.bucket}"
            for r in self._last_buckets()
            if buckets is None or r.bucket in buckets
        ]
        if not paths:
            return self.spark.createDataFrame([], schema).drop("bucket")
        return self.spark.read.schema(schema).option("basePath", self.path("song")).parquet(*paths).drop("bucket")

    def stage_songs(self, load_id: str, rows: DataFrame, buckets: Sequence[int]) -> None:
        """Write all versions of the given buckets anew."""
        number = self.song_bucket()
        rows.select(*schemas.SONG.fieldNames(), number.alias("bucket")).repartition("bucket").write.mode(
            "overwrite"
        ).partitionBy("bucket").parquet(f"{self.path('song')}/load_id={load_id}")
        touched = self.spark.createDataFrame([(b, self._song_buckets) for b in buckets], schemas.SONG_BUCKETS)
        self.stage("song_buckets", load_id, touched.coalesce(1))
