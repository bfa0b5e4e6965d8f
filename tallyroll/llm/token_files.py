"""Token-id files with a minimal perfect hash index.

A shard file holds the ids of its documents one after another, then its index, then the
index's length and a magic word. The index is a minimal perfect hash of the document keys
(levels of bit sets: a key that is alone at its bit stays, the others go one level down; the
number of bits set before it is its slot), and for each slot a fingerprint, an offset and a
length. A lookup reads a few bits and one slot, however many documents the shard holds.

Defined cases. Text null or empty: the end id alone. Id null: a key of its own, sorted first.
Repeated ids: each row is stored, numbered within its shard in order. No documents: no files.
Other columns are not read. Ids are stored in two bytes where the vocabulary allows it.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import encoder, text_chunks, with_end
from tallyroll.llm.shared import lookup, new_path, partitions_for, stored, to_arrow

MAGIC = b"TRIDS001"
#: Bits for each key of a level: about half of the keys stay at each.
BITS_PER_KEY = 1.5
_LEVELS = 48
_CATALOG = "shard int, path string, copy long, n_docs long, n_tokens long, is_shard boolean"


def key_hashes(keys: list, copies: list[int]) -> np.ndarray:
    """64-bit hashes of (key, copy)."""
    texts = ("\x01" if k is None else f"\x00{k}" for k in keys)
    return np.array(
        [xxhash.xxh3_64_intdigest(f"{t}\x00{c}") for t, c in zip(texts, copies, strict=True)],
        np.uint64,
    )


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """Independent hashes of 64-bit hashes, one for each seed (xor, shift, multiply)."""
    x = h + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """Key hashes to slots 0..n-1, without storing keys. Equal hashes are refused."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        words = np.concatenate([np.packbits(b) for b in levels]) if levels else np.zeros(0, np.uint8)
        self.bits = np.unpackbits(words)
        self.begin = np.cumsum([0] + [8 * len(np.packbits(b)) for b in levels])
        self.rank = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        levels, rest = [], h
        while len(rest):
            if len(levels) == _LEVELS:
                raise ValueError("two keys of a shard have the same hash")
            size = max(8, int(len(rest) * BITS_PER_KEY))
            at = (mixed(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slots; -1 for hashes that no level knows. An unknown key may get any slot."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for k, level in enumerate(self.levels):
            at = (mixed(h[left], k) % np.uint64(len(level))).astype(np.int64)
            hit = level[at]
            out[left[hit]] = self.rank[self.begin[k] + at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(b) for b in self.levels], "<u8").tobytes()
        return struct.pack("<I", len(self.levels)) + sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, f: io.BytesIO) -> PerfectHash:
        (n,) = struct.unpack("<I", f.read(4))
        sizes = np.frombuffer(f.read(8 * n), "<u8")
        return cls([np.unpackbits(np.frombuffer(f.read(-(-int(s) // 8)), np.uint8))[: int(s)].astype(bool) for s in sizes])


def index_bytes(h: np.ndarray, lengths: np.ndarray, dtype: str) -> bytes:
    """The index of a shard whose documents, in file order, have these hashes and lengths."""
    table = PerfectHash.build(h)
    slot = table.slots(h)
    ends = np.cumsum(lengths)
    prints, offset, length = (np.zeros(len(h), t) for t in ("<u4", "<u8", "<u4"))
    prints[slot] = mixed(h, 1000) >> np.uint64(32)
    offset[slot] = ends - lengths
    length[slot] = lengths
    body = table.dump() + prints.tobytes() + offset.tobytes() + length.tobytes()
    return struct.pack("<BQ", int(dtype[-1]), len(h)) + body


@dataclass
class Shard:
    """An open shard: ids of a key in constant time."""

    payload: np.ndarray
    table: PerfectHash
    prints: np.ndarray
    offset: np.ndarray
    length: np.ndarray

    @classmethod
    def open(cls, path: str) -> Shard:
        fs, where = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(where) as f:
            data = f.read()
        if data[-8:] != MAGIC:
            raise ValueError(f"{path}: no token file")
        (size,) = struct.unpack("<Q", data[-16:-8])
        f = io.BytesIO(data[-16 - size : -16])
        width, n = struct.unpack("<BQ", f.read(9))
        table = PerfectHash.load(f)
        prints, offset, length = (np.frombuffer(f.read(int(t[-1]) * n), t) for t in ("<u4", "<u8", "<u4"))
        return cls(np.frombuffer(data[: len(data) - 16 - size], f"<u{width}"), table, prints, offset, length)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Slots of key hashes; -1 for keys that the shard doesn't hold (by fingerprint)."""
        slot = self.table.slots(h)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == (mixed(h[known], 1000) >> np.uint64(32))
        return np.where(known, slot, -1)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = 64 << 20,
) -> DataFrame:
    """Write all documents as shard files in ascending id order; the catalog of what was written.

    The catalog has a row for each document (its id, copy number and shard) and one for each
    shard (`is_shard`, with totals). A shard is a range of ids, cut by Spark's range
    partitioning, so a repeated id may spread over neighbouring shards. A file is named by its
    attempt and counts only once the catalog names it: lost or repeated tasks do no harm.
    """
    spark = docs.sparkSession
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    key_type = pairs.schema["id"].dataType.simpleString()
    arrow = to_arrow(spark.createDataFrame([], f"id {key_type}, {_CATALOG}"))
    in_order = pairs.repartitionByRange(
        partitions_for(docs, shard_bytes), "id", F.xxhash64("text")
    ).sortWithinPartitions("id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.ids"
        enc, out, last, copy = encoder(tokenizer), None, object(), 0
        hashes, lengths = [], []
        for some in (x for batch in batches for x in text_chunks(batch, "text")):
            ids, copies = some.column("id").to_pylist(), []
            if out is None:
                fs, where = pafs.FileSystem.from_uri(path)
                fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(where)
            tokens, begin = with_end(*enc.encode_column(some.column("text")), end_id)
            out.write(pa.py_buffer(tokens))
            sizes = np.diff(begin).tolist()
            for key in ids:
                copy = copy + 1 if key == last else 0
                last = key
                copies.append(copy)
            hashes.append(key_hashes(ids, copies))
            lengths += sizes
            yield _rows(arrow, id=ids, shard=part, path=path, copy=copies, n_tokens=sizes, is_shard=False)
        if out is None:
            return
        index = index_bytes(np.concatenate(hashes), np.array(lengths, np.int64), enc.dtype)
        out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        out.close()
        yield _rows(arrow, id=[None], shard=part, path=path, n_docs=len(lengths), n_tokens=[sum(lengths)], is_shard=True)

    return stored(in_order.mapInArrow(write, f"id {key_type}, {_CATALOG}"), "token-catalog")


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """Lists as they are, single values repeated, other columns null."""
    n = len(columns["id"])
    full = [columns.get(f.name) for f in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(v if isinstance(v, list) else [v] * n, f.type) for v, f in zip(full, schema, strict=True)],
        schema=schema,
    )


def read_token_files(catalog: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document of the catalog, looked up in its shard's index: (id, start, n_tokens,
    ids_crc32), `start` being the number of ids in all documents before it. A key that the
    index doesn't give back raises an error."""
    spark = catalog.sparkSession
    keys = catalog.filter("NOT is_shard").select("shard", "path", "id", "copy")
    key_type = keys.schema["id"].dataType.simpleString()
    totals = catalog.filter("is_shard").select("shard", "n_tokens").collect()
    schema = f"shard int, id {key_type}, at long, n_tokens long, ids_crc32 long"
    arrow = to_arrow(spark.createDataFrame([], schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        for batch in batches:
            paths = np.array(batch.column("path").to_pylist(), object)
            cuts = [0, *(np.flatnonzero(paths[1:] != paths[:-1]) + 1), len(paths)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if paths[a] != at:
                    at, shard = paths[a], Shard.open(paths[a])
                part = batch.slice(a, b - a)
                ids, copies = part.column("id").to_pylist(), part.column("copy").to_pylist()
                slot = shard.find(key_hashes(ids, copies))
                if (slot < 0).any():
                    raise ValueError(f"{at}: a key is missing")
                begin, size = shard.offset[slot].astype(np.int64), shard.length[slot].astype(np.int64)
                crc = [zlib.crc32(shard.payload[s : s + n].astype("<u4").tobytes()) for s, n in zip(begin, size, strict=True)]
                yield _rows(arrow, shard=part.column("shard").to_pylist(), id=ids, at=begin.tolist(), n_tokens=size.tolist(), ids_crc32=crc)

    tokens = {r.shard: r.n_tokens for r in totals}
    sizes = [tokens.get(i, 0) for i in range(1 + max(tokens, default=-1))]
    before = lookup([0, *accumulate(sizes)], F.col("shard"))
    # a shard's file is far larger than its keys: the number of tasks is ours, not by shuffle size
    found = keys.repartition(max(1, len(tokens)), "shard").sortWithinPartitions("shard").mapInArrow(read, schema)
    return found.select(
        F.col("id").alias(id_col), (before + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(spark, sf_dir: str) -> DataFrame:
    """Query op7: all documents encoded, written, and read back through the index."""
    from public_tokenizers import path

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    catalog = write_token_files(docs, new_path(spark, "token-files"), path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(catalog)
