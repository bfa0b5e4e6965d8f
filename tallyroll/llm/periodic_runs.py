"""Maximal periodic runs of words by internal pattern matching.

A run is a stretch with a smallest period q, at least `least` words and two periods long, that
can't be made longer. Texts' words are named by doubling: a word block of length 2^k has the
place of its group among all sorted suffixes as its name (in its own text), which gives a suffix
array and, by comparing names, exact lengths of common extensions.

A run holds, within the beginning of its first period, a dyadic block (length L = 2^k, at a
multiple of L), and the block again q words later. So each dyadic block whose interval in the
suffix array has more than itself asks a wavelet tree over the suffix array for its next
occurrences (range successor) in the window where its length is the right one for the period.
The distance to an occurrence is a candidate period. Where occurrences are a progression, the
ends of its stretch and of the block's own leave at most two candidates, unless the stretches
touch. Candidates are extended both ways; of those with one stretch the least is its period.

Defined cases. Null and empty texts: no words, no runs, nothing left. Words are compared by 64-bit
checksums. Texts of any length are worked on whole. Repeated rows and ids: each row by itself.
Empty table: no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import text_chunks
from tallyroll.llm.shared import to_arrow
from tallyroll.llm.shingles import word_hashes

#: Bytes of texts that are worked on at once, or one text.
_CHUNK = 1 << 20


class Names:
    """Names of all blocks of 1, 2, 4, ... words, up to the length from which on all differ, and
    the suffix array of every text, one after another."""

    def __init__(self, words: np.ndarray, begin: np.ndarray):
        n = len(words)
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        self.end = begin[1:][owner] if n else np.zeros(0, np.int64)
        order = np.lexsort((words, owner))
        new = np.ones(n, bool)
        new[1:] = (owner[order][1:] != owner[order][:-1]) | (words[order][1:] != words[order][:-1])
        name = np.empty(n, np.int32)
        name[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        #: levels[k][i]: name of the 2^k words from i on (or of the rest of the text)
        self.levels = [name]
        self.order = order
        while True:
            size = 1 << (len(self.levels) - 1)
            name, at = self.levels[-1], self.order
            same = np.zeros(n, bool)
            same[1:] = name[at][1:] == name[at][:-1]
            open_ = same.copy()
            open_[:-1] |= same[1:]
            some = np.flatnonzero(open_)
            if not len(some):
                break
            # only groups of more than one are sorted further, each within its own places
            suffix = at[some]
            far = suffix + size
            second = np.where(far < self.end[suffix], name[np.minimum(far, n - 1)].astype(np.int64), -1)
            by = np.lexsort((second, name[suffix]))
            suffix, second = suffix[by], second[by]
            self.order = at.copy()
            self.order[some] = suffix
            new = np.ones(len(some), bool)
            new[1:] = (name[suffix][1:] != name[suffix][:-1]) | (second[1:] != second[:-1])
            finer = name.copy()
            finer[suffix] = np.maximum.accumulate(np.where(new, some, 0))
            self.levels.append(finer)

    def interval(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes that begin with a block lie in the suffix array."""
        name = self.levels[level]
        ranked = name[self.order]
        return name[at].astype(np.int64), np.searchsorted(ranked, name[at], side="right")

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j > i on."""
        i, j = i.copy(), j.copy()
        start, end = j.copy(), self.end[i]
        for level in reversed(range(len(self.levels))):
            name, size = self.levels[level], 1 << level
            fits = j + size <= end
            fits[fits] = name[i[fits]] == name[j[fits]]
            i, j = i + size * fits, j + size * fits
        return j - start

    def backward(self, i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j > i, from `begin` on."""
        i, j = i.copy(), j.copy()
        start = i.copy()
        for level in reversed(range(len(self.levels))):
            name, size = self.levels[level], 1 << level
            fits = i - size >= begin
            fits[fits] = name[i[fits] - size] == name[j[fits] - size]
            i, j = i - size * fits, j - size * fits
        return start - i


class WaveletTree:
    """A sequence of integers from 0 to below 2^bits, for counting and selecting in its ranges.
    The levels are kept one after another, with zeros before ones (a wavelet matrix)."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        now = values
        for bit in reversed(range(self.bits)):
            one = (now >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([np.zeros(1, np.int64), np.cumsum(~one)]))
            now = np.concatenate([now[~one], now[one]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many elements of low..high are less than value."""
        count = np.zeros(len(low), np.int64)
        over = value >> self.bits > 0
        count[over] = (high - low)[over]
        for zeros, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            a, b = zeros[low], zeros[high]
            one = (value >> bit & 1).astype(bool)
            count += np.where(one & ~over, b - a, 0)
            low, high = np.where(one, low - a + zeros[-1], a), np.where(one, high - b + zeros[-1], b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) element of low..high."""
        out = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            out |= one.astype(np.int64) << bit
            k = np.where(one, k - (b - a), k)
            low, high = np.where(one, low - a + zeros[-1], a), np.where(one, high - b + zeros[-1], b)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least element of low..high that is at least value, -1 where there is none."""
        rank = self.below(low, high, value)
        found = rank < high - low
        out = np.full(len(low), -1, np.int64)
        out[found] = self.smallest(low[found], high[found], rank[found])
        return out


def windows(least: int, most: int) -> list[tuple[int, int, int]]:
    """(block length, least and greatest period it finds): the longest dyadic blocks of which the
    first in a run of any of these periods occurs again one period on."""
    out: list[tuple[int, int, int]] = []
    period = 1
    while period <= most:
        room = max(least, 2 * period) - period  # 2 * length - 1 <= room
        length = 1 << (((room + 1) // 2).bit_length() - 1)
        last = period
        if period >= least:
            last = 4 * length - 2
        if out and out[-1][0] == length and out[-1][2] == period - 1:
            out[-1] = (length, out[-1][1], last)
        else:
            out.append((length, period, last))
        period = last + 1
    return out


def _extended(names: Names, first: np.ndarray, b: np.ndarray, x: np.ndarray, least: int) -> np.ndarray:
    """(start, length, period) of the stretches with period x - b around b that are runs."""
    q = x - b
    back = names.backward(b, x, first[b])
    length = back + q + names.forward(b, x)
    return np.stack([b - back, length, q], axis=1)[length >= np.maximum(least, 2 * q)]


def _progression(
    names: Names, first: np.ndarray, b: np.ndarray, x: np.ndarray, d: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (block, occurrence) for blocks b whose occurrences go on at x, x + d, ... with 2 d
    at most their length, and where to look on. Block and occurrences lie in stretches of
    period d, from s1 to e1 and from s2 to e2.

    In one stretch, a distance is a multiple of d and no smallest period of a run. In stretches that
    don't touch, a run holds an end of both: the distance is that of the ends. Where they touch
    each occurrence may make a run of its own."""
    e2, s2 = x + d + names.forward(x, x + d), x - names.backward(x, x + d, first[x])
    e1, s1 = b + d + names.forward(b, b + d), b - names.backward(b, b + d, first[b])
    last = x + (e2 - length - x) // d * d
    apart = (s1 != s2) & (e1 < s2)
    touch = np.flatnonzero((s1 != s2) & ~apart)
    n = ((last - x) // d)[touch]
    owner = np.repeat(touch, n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + 1
    pairs = [
        np.stack([b[apart], (b + e2 - e1)[apart]], axis=1),
        np.stack([b[apart], (b + s2 - s1)[apart]], axis=1),
        np.stack([b[owner], x[owner] + step * d[owner]], axis=1),
    ]
    return np.concatenate(pairs), last + 1


def word_runs(words: np.ndarray, begin: np.ndarray, least: int = 12) -> np.ndarray:
    """All runs of texts given by their words' numbers, one text after another: rows (text, start,
    length, period), by text, start and period."""
    n = len(words)
    size = np.diff(begin)
    if not n or size.max() < least:
        return np.zeros((0, 4), np.int64)
    names = Names(words, begin)
    tree = None
    found = []
    first = np.repeat(begin[:-1], size)
    for length, low_q, high_q in windows(least, int(size.max()) // 2):
        level = length.bit_length() - 1
        if level >= len(names.levels):
            break  # no block of this length occurs twice
        tree = tree or WaveletTree(names.order)
        own = np.arange(n)
        block = own[((own - first) % length == 0) & (own + length + low_q <= names.end)]
        lo, hi = names.interval(level, block)
        many = hi - lo > 1
        block, lo, hi = block[many], lo[many], hi[many]
        ask = block + low_q
        while len(block):
            x = tree.successor(lo, hi, ask)
            near = (x >= 0) & (x <= block + high_q)
            block, lo, hi, x = block[near], lo[near], hi[near], x[near]
            ask = x + 1
            found.append(_extended(names, first, block, x, least))
            after = tree.successor(lo, hi, ask)
            line = np.flatnonzero((after >= 0) & (2 * (after - x) <= length))
            if len(line):
                b, y, d = block[line], x[line], (after - x)[line]
                more, ask[line] = _progression(names, first, b, y, d, length)
                more = more[(more[:, 1] - more[:, 0] >= low_q) & (more[:, 1] - more[:, 0] <= high_q)]
                found.append(_extended(names, first, more[:, 0], more[:, 1], least))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    text = np.searchsorted(begin, rows[:, 0], side="right") - 1
    rows = np.column_stack([text, rows[:, 0] - begin[text], rows[:, 1], rows[:, 2]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapsed_text(text: bytes, runs: np.ndarray) -> bytes:
    """The words outside the runs and in each run's first period, joined by one space."""
    words = text.split()
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", least: int = 12
) -> DataFrame:
    """Each document's (id, n_words, runs, collapsed): its runs as (start, length, period) by start
    and period, and its text without what runs repeat. No shuffle; a task holds `_CHUNK` bytes
    of texts, or one text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    columns = f"id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    arrow = to_arrow(docs.sparkSession.createDataFrame([], columns))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (x for batch in batches for x in text_chunks(batch, "text", _CHUNK)):
            words, begin = word_hashes(some.column("text"), False)
            rows = word_runs(words, begin, least)
            border = np.searchsorted(rows[:, 0], np.arange(len(begin)))
            fields = [pa.array(np.ascontiguousarray(rows[:, i])) for i in (1, 2, 3)]
            runs = pa.ListArray.from_arrays(
                pa.array(border, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            )
            texts = some.column("text").cast(pa.large_binary()).fill_null(b"")
            left = [
                collapsed_text(t.as_py(), rows[a:b, 1:])
                for t, a, b in zip(texts, border[:-1].tolist(), border[1:].tolist(), strict=True)
            ]
            made = [some.column("id"), pa.array(np.diff(begin)), runs, pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(made, arrow, strict=True)], schema=arrow)

    return docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(find, columns).withColumnRenamed("id", id_col)


def planted(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The contract's texts: one in ten, by its id's checksum, ends in a repetition of its own
    words. A null id plants nothing."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        whole = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p)))
        return F.array_join(whole, " ")

    # one lambda, so that the words are split once
    text = F.element_at(F.transform(F.array(words), repeat), 1)
    return F.when((h % 10 == 0) & F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), text).otherwise(F.col(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The number of runs, the longest (ties: least start, then period) and checksums."""
    runs = F.col("runs")
    # by structs: longest first, then the least start and period
    longest = F.array_max(
        F.transform(runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r.alias("run")))
    )["run"]
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    every = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    return found.withColumn("longest", longest).select(
        id_col,
        F.size(runs).cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(every.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def runs(spark, sf_dir: str) -> DataFrame:
    """Query op13: the periodic runs of all documents, with the contract's repetitions planted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(periodic_runs(docs, text_col=planted()))
