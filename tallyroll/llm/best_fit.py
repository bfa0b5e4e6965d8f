"""Best-fit packing into training windows, improved by swaps.

Only documents longer than a window are cut, into whole windows and a rest. Rests and shorter
documents are dealt by checksum into blocks of at most some `block` pieces. A block is packed by
best fit, longest first, and then searched locally: the least filled bin gives pieces to other
underfull bins by a move, a one-for-one or a two-for-one exchange. Every step takes ids from an
emptier bin to a fuller one, so the sum of squared fills grows, and goes on until the bin is
empty, none helps, or no fewer bins can hold the block.

What lies in a block's badly filled bins is dealt into blocks once more, as long as that leaves
at most half of the pieces, so that hardly more than one such bin is left in all. A task holds
the lengths of one block; the driver one number a round.

Defined cases. Text null or empty: the end id alone. Repeated rows and ids: each row is packed.
Texts of any length are encoded whole. Pieces of equal length go by row order. Empty table: no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import binary_column, encoder, text_chunks, with_end
from tallyroll.llm.shared import stored, to_arrow

#: How many bins in a row may prove impossible to empty before the search of a block ends.
PATIENCE = 32


def best_fit(lengths: np.ndarray, window: int) -> np.ndarray:
    """The bin of each piece: longest first, each in the fullest bin that has room for it."""
    out, bins = np.empty(len(lengths), np.int64), 0
    by_room: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0  # bit r is set where a bin has room r
    order = np.argsort(-lengths, kind="stable").tolist()
    for piece, length in zip(order, lengths[order].tolist(), strict=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, own, bins = window, bins, bins + 1
        out[piece] = own
        by_room[room - length].append(own)
        rooms |= 1 << (room - length)
    return out


class Search:
    """The local search over a block's underfull bins. `bin` is the bin of each piece."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, window: int):
        self.length, self.bin = lengths, bins.copy()
        count = int(bins.max(initial=-1)) + 1
        self.room = window - np.bincount(bins, lengths, count).astype(np.int64)
        self.window = window
        self.pieces: list[list[int]] = [[] for _ in range(count)]
        for piece, own in enumerate(bins.tolist()):
            self.pieces[own].append(piece)
        self.pairs: dict[int, np.ndarray] = {}
        self.least = -(-int(lengths.sum()) // window)

    def run(self) -> np.ndarray:
        stuck = np.zeros(len(self.room), bool)
        while (self.room < self.window).sum() > self.least and stuck.sum() < PATIENCE:
            left = np.flatnonzero((self.room > 0) & (self.room < self.window) & ~stuck)
            if not len(left):
                break
            giver = int(left[self.room[left].argmax()])
            if self._emptied(giver):
                stuck[:] = False
            else:
                stuck[giver] = True
        return self.bin

    def _emptied(self, giver: int) -> bool:
        while self.pieces[giver]:
            step = self._move(giver) or self._exchange(giver, 1, 1) or self._exchange(giver, 2, 1) or self._exchange(giver, 1, 2)
            if step is None:
                return False
            self._apply(giver, *step)
        return True

    def _others(self, giver: int) -> np.ndarray:
        """Marks of the bins as full as the giver, or fuller, with room."""
        others = (self.room > 0) & (self.room <= self.room[giver])
        others[giver] = False
        return others

    def _move(self, giver: int):
        others = np.flatnonzero(self._others(giver))
        for x in sorted(self.pieces[giver], key=lambda p: -self.length[p]):
            fits = others[self.room[others] >= self.length[x]]
            if len(fits):
                return int(fits[self.room[fits].argmin()]), (x,), ()
        return None

    def _pairs_of(self, own: int) -> np.ndarray:
        """Sums of two of a bin's pieces, with the pieces; one pair for each two lengths."""
        if own not in self.pairs:
            by_length: dict[int, list[int]] = {}
            for p in self.pieces[own]:
                by_length.setdefault(int(self.length[p]), []).append(p)
            kinds = sorted(by_length)
            rows = [(a + b, by_length[a][0], by_length[b][0]) for i, a in enumerate(kinds) for b in kinds[i + 1 :]]
            rows += [(2 * a, *by_length[a][:2]) for a in kinds if len(by_length[a]) > 1]
            self.pairs[own] = np.array(rows, np.int64).reshape(-1, 3)
        return self.pairs[own]

    def _exchange(self, giver: int, gives: int, takes: int):
        """The exchange that takes most from the giver: (bin, pieces it gets, pieces it gives)."""
        others = self._others(giver)
        if gives == 1:
            offers = {int(self.length[p]): (p,) for p in self.pieces[giver]}
        else:
            offers = {s: (a, b) for s, a, b in self._pairs_of(giver).tolist()}
        if not offers or not others.any():
            return None
        if takes == 1:
            rows = np.flatnonzero(others[self.bin])
            given, owner = self.length[rows], self.bin[rows]
            rows = rows[:, None]
        else:
            own = np.flatnonzero(others)
            pairs = [self._pairs_of(i) for i in own.tolist()]
            owner = np.repeat(own, [len(x) for x in pairs])
            rows = np.concatenate(pairs)
            given, rows = rows[:, 0], rows[:, 1:]
        offered = np.array(sorted(offers), np.int64)
        # the largest offer that fits once `given` has gone
        at = np.searchsorted(offered, given + self.room[owner], side="right") - 1
        gain = np.where(at >= 0, offered[np.maximum(at, 0)] - given, 0)
        if not len(gain) or gain.max() <= 0:
            return None
        best = int(gain.argmax())
        return int(owner[best]), offers[int(offered[at[best]])], tuple(rows[best].tolist())

    def _apply(self, giver: int, other: int, gives: tuple, takes: tuple) -> None:
        for source, target, pieces in ((giver, other, gives), (other, giver, takes)):
            for p in pieces:
                self.pieces[source].remove(p)
                self.pieces[target].append(p)
                self.bin[p] = target
                self.room[source] += self.length[p]
                self.room[target] -= self.length[p]
        self.pairs.pop(giver, None)
        self.pairs.pop(other, None)


def pack(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each piece, and the room left in each bin."""
    search = Search(lengths, best_fit(lengths, window), window)
    bins = search.run()
    order = np.argsort(bins, kind="stable")
    size = lengths[order]
    before = np.cumsum(size) - size
    new = np.ones(len(order), bool)
    new[1:] = bins[order][1:] != bins[order][:-1]
    offset = np.empty(len(order), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(new, before, 0))
    return bins, offset, search.room


def best_fit_packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = 20_000,
    with_ids: bool = False,
) -> DataFrame:
    """One row a piece: (id, piece, start, length, ids_crc32, sequence_id, offset), and its token
    ids as bytes where `with_ids`."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = f"uid long, id {id_type}, piece int, start long, length long, ids_crc32 long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for some in (x for batch in batches for x in text_chunks(batch, "text")):
            ids, begin = with_end(*enc.encode_column(some.column("text")), end_id)
            n = -(-np.diff(begin) // window)
            owner = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            first = begin[owner] + piece * window
            cuts = np.append(first, begin[-1])
            wide, places = ids.astype("<u4"), cuts.tolist()
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(places, places[1:], strict=False)]
            own = [some.column("uid").take(pa.array(owner)), some.column("id").take(pa.array(owner))]
            made = [*own, piece, piece * window, np.diff(cuts), crc]
            if with_ids:
                made.append(binary_column(wide, cuts))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if not isinstance(x, pa.Array) else x
                                              for x, f in zip(made, whole, strict=True)], schema=whole)

    whole = to_arrow(spark.createDataFrame([], columns + (", ids binary" if with_ids else "")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    pieces = stored(rows.mapInArrow(encode, columns + (", ids binary" if with_ids else "")), "bins-pieces")
    slim = pieces.drop("ids")
    # whole windows have sequences of their own, from 0 on; packed ones have negative numbers
    done = slim.filter(F.col("length") == window).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_, n = slim.filter(F.col("length") < window), None
    for number in range(1 << 10):
        count = open_.count()
        if not count or (n and 2 * count > n):
            break
        n, blocks = count, -(-count // block)
        placed = stored(_placed(open_, number, blocks, window, columns), "bins-placed")
        done = done.unionByName(placed.filter("NOT open").drop("open"))
        open_ = placed.filter("open").drop("open")
    if n and count:
        done = done.unionByName(open_)
    if with_ids:
        done = done.join(pieces.select("uid", "piece", "ids"), ["uid", "piece"])
    return done.withColumnRenamed("id", id_col).select(
        id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])
    )


def _placed(open_: DataFrame, number: int, blocks: int, window: int, columns: str) -> DataFrame:
    """The pieces packed in blocks; `open` are those in bins with more than 1/64 of room, unless
    the block is the only one."""
    names = [c.split()[0] for c in columns.split(", ")]
    schema = f"{columns}, sequence_id long, offset long, open boolean"
    dealt = open_.select(*names, F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(blocks)).alias("block"))
    arrow = to_arrow(open_.sparkSession.createDataFrame([], schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _groups(batches, "block"):
            at, offset, room = pack(own.column("length").to_numpy(), window)
            sequence = -1 - ((((number << 32) | own.column("block")[0].as_py()) << 20) + at)
            goes_on = room[at] > window // 64 if blocks > 1 else np.zeros(len(at), bool)
            yield pa.RecordBatch.from_arrays(
                [*(own.column(c) for c in names), pa.array(sequence), pa.array(offset), pa.array(goes_on)], schema=arrow
            )

    return dealt.repartition(blocks, "block").sortWithinPartitions("block", "uid").mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of one value of an ordered integer column, as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[0].column(column)[0].as_py() != values[a]:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Query op11: all documents in as few sequences of at most 4096 tokens as the search finds."""
    from public_tokenizers import path

    return best_fit_packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), path("word_bpe_49k.json"))
