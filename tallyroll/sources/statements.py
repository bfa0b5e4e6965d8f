"""Statement files: listing, headers and the positional CSV scan."""

from __future__ import annotations

import codecs
import csv
import fnmatch
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GLOB_CHARS = re.compile(r"([{}\[\]*?\\])")
_LINE_END = re.compile(rb"[\r\n]")
_CHUNK = 64 * 1024
_QUOTE, _COMMA, _BACKSLASH = b'",\\'
# The longest header line that is taken, some tens of thousands of names.
HEADER_BYTES = 1 << 20
csv.field_size_limit(1 << 30)

_LISTING = "path string, bytes long, file_path string, list_problem string"
_LISTED = pa.schema(
    [("path", pa.string()), ("bytes", pa.int64()), ("file_path", pa.string()), ("list_problem", pa.string())]
)
_URI_KEEPS = re.compile(r"[^A-Za-z0-9_.!~'()*,;:$&+=@/-]")


def reported_path(path: str) -> str:
    """A file's path as `_metadata` reports it for its rows: an escaped URI. Letters of other
    scripts stay, other characters that a URI may not have are escaped."""

    def escaped(found: re.Match) -> str:
        c = found[0]
        plain = ord(c) >= 128 and unicodedata.category(c) not in ("Cc", "Zs", "Zl", "Zp")
        return c if plain else quote(c, safe="")

    scheme, _, rest = path.partition(":")
    return f"{scheme}:{_URI_KEEPS.sub(escaped, rest)}"


def list_files(spark: SparkSession, *roots: str, folders: str = "*/*") -> DataFrame:
    """Every `.csv` file in the `<deal>/<vendor>` folders of the roots, as rows.

    `folders=""` lists one vendor folder itself. The suffix is case-sensitive and files
    further down are not taken. Folders are rows: each level is listed by tasks, which see every
    name, and no file is opened. Files that Spark's readers pass over (names that begin with
    `_` or `.`) and folders that can't be listed are there too, with a `list_problem`.

    Two columns name a file: `path` is what a reader takes, `file_path` is what
    `_metadata` reports for its rows (percent-encoded), the key rows are joined by.
    """
    starts = [(_qualified(spark, root), None, None, None) for root in roots]
    found = spark.createDataFrame(starts, _LISTING)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for level in [part for part in folders.split("/") if part]:
        found = found.mapInArrow(_lister(level, True), _LISTING).repartition(tasks)
    return found.mapInArrow(_lister("*.csv", False), _LISTING)


def _qualified(spark: SparkSession, root: str) -> str:
    """A root with its scheme, which a bare path takes from the session's default."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") or "/")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _lister(pattern: str, want_folders: bool):
    """Children of each folder row whose names fit the pattern; rows with a problem pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores = _Stores()
        for batch in batches:
            for row in batch.to_pylist():
                if row["list_problem"]:
                    yield pa.RecordBatch.from_pylist([row], schema=_LISTED)
                    continue
                folder, out = row["path"].rstrip("/"), []
                try:
                    store, place = stores.of(reported_path(folder))
                    children = store.get_file_info(pafs.FileSelector(place))
                except (OSError, pa.ArrowException) as error:
                    out.append(
                        {
                            "path": folder,
                            "file_path": reported_path(folder),
                            "list_problem": f"unreadable folder: {type(error).__name__}",
                        }
                    )
                    children = []
                for child in children:
                    name = child.base_name
                    is_folder = child.type == pafs.FileType.Directory
                    if is_folder == want_folders and fnmatch.fnmatchcase(name, pattern):
                        path = f"{folder}/{name}"
                        hidden = not is_folder and name[0] in "_."
                        out.append(
                            {
                                "path": path,
                                "bytes": None if is_folder else child.size,
                                "file_path": reported_path(path),
                                "list_problem": "file name begins with _ or ." if hidden else None,
                            }
                        )
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_LISTED)

    return run


class HeaderError(ValueError):
    """A first line that rows cannot be read by."""


def _ends_quoted(line: bytes) -> bool:
    """Whether a line ends inside a quoted field. A quote opens where a field begins; a backslash
    and a doubled quote stand for the character after them."""
    at_start, quoted, at = True, False, 0
    while at < len(line):
        c = line[at]
        if c == _BACKSLASH or (quoted and line[at : at + 2] == b'""'):
            at, at_start = at + 2, False
            continue
        if c == _QUOTE and (quoted or at_start):
            quoted = not quoted
        at_start = c == _COMMA and not quoted
        at += 1
    return quoted


def _fields(line: bytes) -> list[str]:
    if _ends_quoted(line):
        raise HeaderError("line end inside a quoted header name")
    return next(csv.reader([line.decode("utf-8", "replace")], escapechar="\\"))


def _lines(stream, limit: int) -> Iterator[bytes]:
    """Non-blank lines of a binary stream; holds one chunk and at most `limit` bytes of a line."""
    line, first = bytearray(), True

    def whole() -> bytes:
        text = bytes(line)
        return text.removeprefix(codecs.BOM_UTF8) if first else text

    while chunk := stream.read(_CHUNK):
        at = 0
        while at < len(chunk):
            end = _LINE_END.search(chunk, at)
            line += chunk[at : end.start() if end else len(chunk)]
            if len(line) > limit and line.strip():
                raise HeaderError(f"header line longer than {limit} bytes")
            if end and (text := whole()).strip():
                yield text
            if end or len(line) > limit:
                line, first = bytearray(), False
            at = end.end() if end else len(chunk)
    if (text := whole()).strip():
        yield text


def header_of(stream, limit: int = HEADER_BYTES) -> list[str] | None:
    """Fields of the first non-blank line of an open binary stream.

    A line beyond the limit is an error, and so is one that ends inside quotes: rows are split at
    line ends, so the rest of such a name would be read as a row.
    """
    return next((_fields(line) for line in _lines(stream, limit)), None)


class _Stores:
    """One client a store within a task."""

    def __init__(self):
        self.clients: dict[str, pafs.FileSystem] = {}

    def of(self, uri: str) -> tuple[pafs.FileSystem, str]:
        """The client for a URI, and the place in its store."""
        uri = re.sub(r"^s3[an]://", "s3://", uri)
        uri = re.sub(r"^file:/(?!//)", "file:///", uri)
        scheme, _, rest = uri.partition("://")
        store, _, place = rest.partition("/")
        if (scheme, store) not in self.clients:
            self.clients[scheme, store] = pafs.FileSystem.from_uri(f"{scheme}://{store}/")[0]
        place = unquote(place)
        # object stores name their bucket in the place, the others begin at the root
        return self.clients[scheme, store], f"{store}/{place}" if scheme in ("s3", "gs", "gcs", "abfs", "abfss") else f"/{place}"


def _probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stores = _Stores()
    for batch in batches:
        headers, problems = [], []
        for uri in batch.column("file_path").to_pylist():
            header, problem = None, None
            try:
                store, place = stores.of(uri)
                with store.open_input_stream(place, buffer_size=_CHUNK) as stream:
                    header = header_of(stream)
            except HeaderError as error:
                problem = str(error)
            except (OSError, csv.Error, pa.ArrowException) as error:
                problem = f"unreadable file: {type(error).__name__}"
            headers.append(header)
            problems.append(problem)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(headers, pa.list_(pa.string())), pa.array(problems, pa.string())],
            names=[*batch.schema.names, "header", "header_problem"],
        )


def with_headers(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Add each file's header fields, reading only the start of each file.

    Spark's own readers cannot stop after one line per file, so a header scan would read
    the whole input a second time. Here each task opens its files and reads one chunk.
    """
    spark = files.sparkSession
    tasks = tasks or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.repartition(tasks, "file_path").mapInArrow(
        _probe, f"{schema}, header array<string>, header_problem string"
    )


def escape_glob(path: str) -> str:
    """A reader expands glob characters in paths; a file's own name must not be one."""
    return _GLOB_CHARS.sub(r"\\\1", path)


def scan_statements(spark: SparkSession, paths: Sequence[str], positions: Iterable[int]) -> DataFrame:
    """Rows of files with any mix of headers, as `cells` by position, and `file_path`.

    The reader drops each file's first line and maps by position, so one scan serves all
    header layouts. Only the given positions are read; other cells are null. The extra
    last column is declared and never selected: with fewer columns asked for than
    declared, the parser selects by position and fills short rows itself, while otherwise
    each missing cell raises an exception inside the parser.
    """
    wanted = sorted(set(positions)) or [0]
    width = wanted[-1] + 1
    rows = (
        spark.read.schema(", ".join(f"c{i} string" for i in range(width + 1)))
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .csv([escape_glob(p) for p in paths])
    )
    keep = set(wanted)
    cells = [F.col(f"c{i}") if i in keep else F.lit(None).cast("string") for i in range(width)]
    return rows.select(F.array(*cells).alias("cells"), "_metadata.file_path")
