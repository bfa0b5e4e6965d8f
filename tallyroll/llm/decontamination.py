"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared as lower-case letters and digits with single spaces between words. Every
stretch of `WINDOW` characters of a benchmark item, from each of its places on, is a window (a
shorter item is one). A window with at most k edits in a document shares at least
m + 1 - (k + 1) q of its q-grams with it, on diagonals that lie at most k apart. So the q-grams
that a document shares with whole items are counted in overlapping bands of diagonals, windows
that hold too few in every band are dropped, and the rest are aligned within the band.
k is `EDITS` of the window's length, less where the bound would say nothing.

The benchmark is stored in the shared folder in blocks of about a number of characters. A task
reads them from there, one after another for each chunk of texts, so documents are scanned once and what a
task holds has a bound, whatever the benchmark's size; the driver holds their number.

Defined cases. Text null or empty on either side: no match. Items of fewer than Q characters:
too short to tell, no match. Repeated rows or ids: each row of documents is searched, hits are
given per id; repeated items match each by its id. Ties: the leftmost best place. Empty tables:
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import text_chunks
from tallyroll.llm.shared import new_path, to_arrow

#: The hash below is made for Q = 10.
Q, WINDOW, EDITS = 10, 80, 0.08
_SPACE, _END = 32, 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22
#: Shared q-grams that are expanded at once.
_HITS = 2_000_000
#: Blocks of the benchmark that a task keeps at a time.
_BLOCKS_HELD = 4


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point to lower-case letter or digit, else space."""
    out = np.full(0x110000, _SPACE, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def normal(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts, an end mark after each; each one's place in its text; where
    each text begins; and the number of the text of each character."""
    texts = [t or "" for t in texts]
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(size)
    begin = ends - size
    folded = _folded()[codes]
    folded[ends - 1] = _END
    keep = folded != _SPACE
    keep[1:] |= folded[:-1] > _SPACE
    before_end = ends[size > 1] - 2
    keep[before_end] &= folded[before_end] != _SPACE
    at = np.flatnonzero(keep)
    owner = np.repeat(np.arange(len(texts)), size)[at]
    return folded[at], at - begin[owner], np.searchsorted(owner, np.arange(len(texts) + 1)), owner


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q characters from each place: pairs, then pairs of those, and so on."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = lambda k: np.uint64(pow(int(_BASE), k, 1 << 64))
    h1 = codes.astype(np.uint64)
    h2 = h1[:-1] * power(1) + h1[1:]
    h4 = h2[:-2] * power(2) + h2[2:]
    h8 = h4[:-4] * power(4) + h4[4:]
    h = h8[:n] * power(2) + h2[8 : 8 + n]
    return (h ^ (h >> np.uint64(29))) * _BASE


@dataclass
class Patterns:
    """Benchmark items with an index of their q-grams; every start of an item is a window."""

    items: list
    codes: np.ndarray
    #: Where each item's characters begin in `codes`, and by item: characters, window length,
    #: edits allowed in a window and q-grams it must share.
    begin: np.ndarray
    length: np.ndarray
    size: np.ndarray
    edits: np.ndarray
    need: np.ndarray
    values: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray

    @classmethod
    def of(cls, items: list, texts: list[str | None]) -> Patterns:
        codes, _, begin, _ = normal(texts)
        owners, own = [], []
        for i, item in enumerate(items):
            if begin[i + 1] - 1 - begin[i] >= Q:
                owners.append(item)
                own.append(codes[begin[i] : begin[i + 1] - 1])
        length = np.array([len(x) for x in own], np.int64)
        size = np.minimum(length, WINDOW)
        edits = np.minimum((size * EDITS).astype(np.int64), np.maximum((size + 1) // Q - 2, 0))
        need = np.maximum(size + 1 - (edits + 1) * Q, 1)
        hashes = [grams(x) for x in own]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        item = np.repeat(np.arange(len(own)), [len(h) for h in hashes])[order]
        place = np.concatenate([np.arange(len(h)) for h in hashes] or [np.zeros(0, np.int64)])[order]
        values, first = np.unique(flat[order], return_index=True)
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[values >> np.uint64(64 - _FILTER_BITS)] = True
        return cls(
            owners, np.concatenate(own) if own else np.zeros(0, np.uint32), np.cumsum(length) - length, length, size,
            edits, need, values, np.append(first, len(flat)), item, place, bits,
        )

    def _shared(self, at: np.ndarray, slot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item and band, place in the item) of shared q-grams, some at a time. Bands are
        numbered in steps of the item's edits; each q-gram is in two of them."""
        size = self.first[slot + 1] - self.first[slot]
        upto = np.cumsum(size)
        longest = int(self.length.max(initial=0))
        cut = 0
        while cut < len(at):
            end = max(cut + 1, int(np.searchsorted(upto, (upto[cut - 1] if cut else 0) + _HITS)))
            n = size[cut:end]
            entry = np.repeat(self.first[slot[cut:end]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            item, place = self.item[entry], self.place[entry]
            band = (np.repeat(at[cut:end], n) - place + longest) // np.maximum(self.edits[item], 1) + 1
            key = item * (1 << 40) + band
            yield np.concatenate([key, key - 1]), np.concatenate([place, place])
            cut = end

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place in it where a window starts, and text place where its band begins, of
        all windows with enough shared q-grams in a band."""
        h = grams(codes)
        at = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
        slot = np.minimum(np.searchsorted(self.values, h[at]), max(len(self.values) - 1, 0))
        known = self.values[slot] == h[at] if len(self.values) else np.zeros(len(at), bool)
        at, slot = at[known], slot[known]
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for key, _ in self._shared(at, slot):
            some, count = np.unique(key, return_counts=True)
            keys.append(some)
            counts.append(count)
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(inverse, np.concatenate(counts), len(every))
        none = np.zeros(0, np.int64)
        enough = every[count >= self.need[every >> 40]] if len(every) else none
        if not len(enough):
            return none, none, none
        keys, places = [], []
        for key, place in self._shared(at, slot):
            i = np.minimum(np.searchsorted(enough, key), len(enough) - 1)
            keys.append(i[enough[i] == key])
            places.append(place[enough[i] == key])
        # bands in order, each with its shared places of the item in order, once
        pair = np.unique(np.concatenate(keys) * (1 << 32) + np.concatenate(places))
        key, place = enough[pair >> 32], pair & ((1 << 32) - 1)
        item = key >> 40
        # a window that holds as many places as needed, from one of them on, starts between `low` and `high`
        last = np.arange(len(key)) + self.need[item] - 1
        far = np.minimum(last, len(key) - 1)
        fits = (last < len(key)) & (key[far] == key) & (place[far] - place <= self.size[item] - Q)
        key, item, low, high = key[fits], item[fits], place[far][fits], place[fits]
        low = np.maximum(low - (self.size[item] - Q), 0)
        high = np.minimum(high, self.length[item] - self.size[item])
        same = key[1:] == key[:-1]
        low[1:] = np.where(same, np.maximum(low[1:], high[:-1] + 1), low[1:])
        n = np.maximum(high - low + 1, 0)
        start = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item, key = np.repeat(item, n), np.repeat(key, n)
        band = (key & ((1 << 40) - 1)) - 1
        step = np.maximum(self.edits[item], 1)
        return item, start, band * step - int(self.length.max()) - self.edits[item] + start

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, begin, end, edits) of every confirmed window and band."""
        items, starts, begins = self.candidates(codes)
        out = [np.zeros((4, 0), np.int64)]
        shape = self.size[items] * WINDOW + self.edits[items]
        for s in np.unique(shape).tolist():
            size, k = divmod(s, WINDOW)
            chosen = np.flatnonzero(shape == s)
            for i in range(0, len(chosen), 4096):
                own = chosen[i : i + 4096]
                pattern = self.codes[(self.begin[items[own]] + starts[own])[:, None] + np.arange(size)]
                edits, b, e = aligned(pattern, codes, begins[own], 4 * k + 2)
                hit = edits <= k
                out.append(np.stack([items[own][hit], b[hit], e[hit], edits[hit]]))
        return tuple(np.concatenate(out, axis=1))


def aligned(pattern, codes, begin, width):
    """Least edits of the whole pattern (or one a row) against text near each begin, in a band
    of `width` diagonals; where the best alignment begins and ends. No alignment passes an end
    mark. A cell holds edits, then the diagonal it began on, so one minimum decides both."""
    size, unit = np.shape(pattern)[-1], 1 << int(width).bit_length()
    pattern = np.broadcast_to(pattern, (len(begin), size)).T
    at = np.arange(width + size)[:, None] + begin
    text = np.where((at >= 0) & (at < len(codes)), codes[np.clip(at, 0, max(len(codes) - 1, 0))], _END)
    # edits of leaving out a text character, and those of all before it
    left_out = np.where(text == _END, 1 << 10, 1).astype(np.int32) * unit
    before = np.cumsum(left_out, axis=0, dtype=np.int32)
    cell = np.repeat(np.arange(width, dtype=np.int32)[:, None], len(begin), axis=1)
    for i in range(size):
        best = cell + np.where(text[i : i + width] == pattern[i], 0, left_out[i : i + width])
        # a pattern character without a partner: same text place, one diagonal lower
        np.minimum(best[:-1], cell[1:] + unit, out=best[:-1])
        # text characters without a partner: from lower diagonals of the same row
        best -= before[i : i + width]
        cell = np.minimum.accumulate(best, axis=0)
        cell += before[i : i + width]
    end = cell.argmin(axis=0)
    least = cell[end, np.arange(len(begin))].astype(np.int64)
    return least // unit, begin + least % unit, begin + end + size


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_characters: int = 2_000_000,
) -> DataFrame:
    """(id, item, begin, end, edits, places): every document and item of which a window occurs
    in it; from the first to the last such place (character offsets), the fewest edits,
    and how many bands of windows were confirmed."""
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {id_type}, item {item_type}, begin long, end long, edits int, places long"
    arrow = to_arrow(docs.sparkSession.createDataFrame([], schema))
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // block_characters)
    folder = new_path(docs.sparkSession, "benchmark-blocks")
    block = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n_blocks)))
    items.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(folder)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = lru_cache(maxsize=_BLOCKS_HELD)(lambda number: _patterns(f"{folder}/block={number}"))
        for some in (x for batch in batches for x in text_chunks(batch, "text", 1 << 20)):
            codes, place, _, owner = normal(some.column("text").to_pylist())
            ids = some.column("id")
            for number in range(n_blocks):
                patterns = load(number)
                if patterns is None:
                    continue
                item, begin, end, edits = patterns.search(codes)
                pair, inverse = np.unique(owner[begin] * (1 << 32) + item, return_inverse=True)
                rows = [
                    {
                        "id": ids[int(pair[i] >> 32)].as_py(),
                        "item": patterns.items[int(pair[i] & ((1 << 32) - 1))],
                        "begin": int(place[begin[own].min()]),
                        "end": int(place[end[own].max() - 1]) + 1,
                        "edits": int(edits[own].min()),
                        "places": int(own.sum()),
                    }
                    for i, own in ((i, inverse == i) for i in range(len(pair)))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    found = pairs.mapInArrow(search, schema)
    return found.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.min("edits").alias("edits"),
        F.sum("places").alias("places"),
    )


def _patterns(folder: str) -> Patterns | None:
    """The patterns of one stored block of the benchmark, None where it holds none."""
    store, path = pafs.FileSystem.from_uri(folder)
    if store.get_file_info(path).type != pafs.FileType.Directory:
        return None
    files = store.get_file_info(pafs.FileSelector(path))
    names = sorted(f.path for f in files if f.path.endswith(".parquet"))
    rows = [r for name in names for r in pq.read_table(name, filesystem=store).to_pylist()]
    rows.sort(key=lambda r: (str(r["item"]), r["text"] or ""))
    return Patterns.of([r["item"] for r in rows], [r["text"] for r in rows])


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Documents without a benchmark passage. Rows go by id and text, so that of rows that share an
    id, or have none, those with a passage go and the others stay."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    own = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    bad = leaks(own, benchmark, "key", "text", **options).select("key.id", "key.text_hash").distinct()
    same = docs[id_col].eqNullSafe(bad["id"]) & (F.xxhash64(docs[text_col]) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")


def decontamination(spark, sf_dir: str) -> DataFrame:
    """Query op2: every document that holds a passage of a benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
