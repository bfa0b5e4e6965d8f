"""Removal of repeated passages by blockwise suffix sorting.

A byte goes when it lies in a passage of `LENGTH` bytes that also starts in a document with a
smaller id. Passages (windows) are found in three steps.

1. Buckets. Every window is named by the least-hashed `SEED`-byte string in it, so equal
   windows, wherever they are, have the same name at the same place. Names found in one
   document only are dropped: their windows can't repeat.
   Names are shuffled once, with their places, packed by shares of the hashes, and judged where
   they arrive. What has more than the least id among the names that a task packs together is
   known to have company, so of a very frequent name few are held to be judged.
   Long stretches (from one rarer name to the second next) that a smaller id has too are settled
   as a whole by their 128-bit checksum; what is left are the borders of repeated text, and
   short passages. A document that is the least to have a name has nothing to drop there; its
   surroundings are fetched only for names that others still ask about.
2. Blocks. The surroundings of a name's occurrences (the windows it names) are the suffixes of
   one bucket, without repetition. A task takes some buckets at a time and sorts their suffixes
   for each place of the name: by their first 16 bytes, and longer ties by the rank of the
   suffix at the next place of a difference cover modulo 16. Cover ranks are computed once a
   block, from the last cover column to the first, each from the bytes up to the next column
   and that column's rank. So memory is a few numbers a suffix, however long the ties.
   Neighbours in order that share `LENGTH` bytes are one passage; its least id is kept.
3. Spans. Each document drops the windows whose least id is smaller than its own.

A bucket too large for a block (a very common string in ever new surroundings) has its windows
grouped by Spark instead, with the same result. Names are 64-bit hashes; bytes are compared.

Defined cases. Text null or empty: nothing to remove. Repeated rows or ids: equal ids aren't
smaller, so such rows don't remove each other's bytes. Id null: after all other ids. Ids are
integers. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.jaccard import _chunks
from tallyroll.llm.shared import stored, to_arrow
from tallyroll.llm.shingles import hashes_of, mix, text_bytes

LENGTH, SEED = 50, 24
_PLACES = LENGTH - SEED + 1
_LAST = (1 << 63) - 1
#: Differences of these cover all residues modulo 16.
COVER, PERIOD = (0, 1, 2, 5, 8), 16
#: Columns of a bucket's row: the name begins at column `_PLACES - 1`.
_WIDTH = _PLACES - 1 + LENGTH
_BYTE = mix(np.arange(256, dtype=np.uint64), 40)
#: Bytes that are hashed at a time.
_SOME = 1 << 16
_BASE, _BASE_2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
#: One in so many names is a rarer one.
_RARER = 8
#: Names are dealt into so many shares at least; a task packs so many at a time.
_SHARES, _PACK = 1024, 1 << 19
#: Columns of a packed name: hash, second checksum, id, hash of the text, spot.
_CLAIM = 5


def seeds(raw: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each place."""
    n = max(len(raw) - SEED + 1, 0)
    h = np.empty(n, np.uint64)
    # some at a time, so that all steps find them in the processor's cache
    for at in range(0, n, _SOME):
        out = h[at : at + _SOME]
        x = _BYTE[raw[at : at + len(out) + SEED - 1]]
        for step in (1, 2, 4):
            x = x[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + x[step:]
        # x has eight bytes each now
        x16 = x[:-8] * np.uint64(pow(_BASE, 8, 1 << 64)) + x[8:]
        x = x16[: len(out)] * np.uint64(pow(_BASE, 8, 1 << 64)) + x[16 : 16 + len(out)]
        out[:] = mix(x)
    return h


def runs(raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same naming seed, each within one text: begin of the first window,
    number of windows, where the seed is, its hash, and the number of the text."""
    last = len(raw) - LENGTH + 1
    if last < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), none
    h = seeds(raw)
    # the least hash and, of equal ones, the first place: the place is in the low bits
    bits = np.uint64(len(h).bit_length())
    least = np.empty(last, np.uint64)
    for at in range(0, last, _SOME):
        x = h[at : at + _SOME + _PLACES - 1] >> bits << bits
        x |= np.arange(at, at + len(x), dtype=np.uint64)
        span = 1
        while span < _PLACES:
            step = min(span, _PLACES - span)
            x = np.minimum(x[:-step], x[step:])
            span += step
        least[at : at + _SOME] = x
    new = np.ones(last, bool)
    new[1:] = least[1:] != least[:-1]
    # where a text begins, and where its windows would reach into the next
    for cut in (begin[:-1], np.maximum(begin[1:] - LENGTH + 1, begin[:-1])):
        new[cut[cut < last]] = True
    first = np.flatnonzero(new)
    count = np.diff(first, append=last)
    owner = np.searchsorted(begin, first, side="right") - 1
    whole = first + LENGTH <= begin[owner + 1]
    first, count, owner = first[whole], count[whole], owner[whole]
    place = (least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return first, count, place, h[place], owner


def stretches(raw: np.ndarray, begin: np.ndarray, place: np.ndarray, h: np.ndarray) -> tuple:
    """Begin, end and two checksums of the stretches between rarer names of one text."""
    at = place[h % np.uint64(_RARER) == 0]
    low, high = at[:-2], at[2:] + SEED
    same = np.searchsorted(begin, low, side="right") == np.searchsorted(begin, high - 1, side="right")
    use = same & (high - low >= LENGTH)
    low, high = low[use], high[use]
    length = mix((high - low).astype(np.uint64), 43)
    return low, high, hashes_of(raw, low, high) ^ length, hashes_of(raw, low, high, _BASE_2) ^ length


def grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (columns of h, second checksum, id and more) in order of hash and checksum, where
    each pair begins, and the least id of each row's pair."""
    order = np.argsort(rows[0])
    h, second = rows[0][order], rows[1][order]
    if ((h[1:] == h[:-1]) & (second[1:] != second[:-1])).any():
        order = np.lexsort((rows[1], rows[0]))
    rows = np.stack([v[order] for v in rows])
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
    begin = np.flatnonzero(new)
    lo = np.minimum.reduceat(rows[2].view(np.int64), begin) if len(begin) else np.zeros(0, np.int64)
    return rows, begin, lo[np.cumsum(new) - 1]


def packed_shares(rows: np.ndarray, shares: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Rows by share of the hashes: those still to be judged, and those known not to be the first:
    of one pair all with more than its least id here, but one that tells of them."""
    rows, begin, lo = grouped(rows)
    sure = rows[2].view(np.int64) > lo
    many = np.concatenate([[0], np.cumsum(sure)])
    told = np.flatnonzero(sure & (many[:-1] == np.repeat(many[begin], np.diff(begin, append=len(sure)))))
    sure[told] = False
    share = ((rows[0] >> np.uint64(32)) * np.uint64(shares) >> np.uint64(32)).astype(np.int64)
    # byte by byte, first bytes of all before second ones, which compresses better
    parts = [(_planes(rows, of), np.searchsorted(share[of], np.arange(shares + 1)).tolist()) for of in (~sure, sure)]
    for i in np.flatnonzero(np.bincount(share, minlength=shares)).tolist():
        yield i, *(planes[:, :, at[i] : at[i + 1]].copy().tobytes() for planes, at in parts)


def _planes(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The first bytes of all values of a row, then the second ones, and so on."""
    out = np.empty((len(rows), 8, int(of.sum())), np.uint8)
    for planes, values in zip(out, rows, strict=True):
        planes[:] = values[of].view(np.uint8).reshape(-1, 8).T
    return out


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(_CLAIM, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).reshape(_CLAIM, -1).view(np.uint64)


def judged_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Claims (h, id_, text_hash, spot): names, or settled stretches if h is null, that are not of
    the least id; and (h, least id) of each name that has claims. Shares arrive one after another."""
    claims: tuple[list, list] = ([], [])
    least: list[np.ndarray] = []

    def ready() -> Iterator[pa.RecordBatch]:
        for kind, parts in enumerate([*claims, least]):
            if parts:
                h, *others = (pa.array(v) for v in np.concatenate(parts, axis=1).view(np.int64))
                none = pa.nulls(len(h), pa.int64())
                columns = ([h, *others[1:]], [none, *others[1:]], [h, *others, none, none])[kind]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "id_", "text_hash", "spot"])
                parts.clear()

    def judge(kind: int, held: list[np.ndarray]) -> None:
        rows, begin, lo = grouped(np.concatenate(held, axis=1))
        late = rows[2].view(np.int64) > lo
        if late.any():
            claims[kind].append(rows[:, late])
            if kind == 0:
                some = begin[np.add.reduceat(late, begin, dtype=np.int64) > 0]
                least.append(np.stack([rows[0][some], lo[some].view(np.uint64)]))

    key, held = None, []
    for batch in batches:
        for share, kind, unsure, sure in zip(*(batch.column(c) for c in ("share", "kind", "unsure", "sure")), strict=True):
            at = share.as_py(), kind.as_py()
            if key not in (None, at):
                judge(key[1], held)
                held = []
            key = at
            held.append(_from_planes(unsure.as_buffer()))
            if len(sure.as_buffer()):
                claims[at[1]].append(_from_planes(sure.as_buffer()))
            if len(claims[0]) + len(claims[1]) >= 64:
                yield from ready()
    if held:
        judge(key[1], held)
    yield from ready()


def passage_ids(rows: np.ndarray, first: np.ndarray, last: np.ndarray, bucket: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row (bytes around a name) and place (windows first..last begin there) the least
    id of all rows of the bucket with the same window. The sort of step 2."""
    n = len(rows)
    columns = [c for c in range(_WIDTH) if c % PERIOD in COVER]
    padded = np.zeros((n, _WIDTH + 8), np.uint8)
    padded[:, :_WIDTH] = rows
    ranks: dict[int, np.ndarray] = {}
    rank = np.zeros(n, np.int64)
    for c, following in zip(reversed(columns), [_WIDTH, *reversed(columns)], strict=False):
        gap = np.zeros((n, 8), np.uint8)
        gap[:, 8 - (following - c) :] = padded[:, c:following]
        key = gap.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((rank, key))
        new = np.ones(n, bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (rank[order][1:] != rank[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        ranks[c] = rank
    out = np.full((n, _PLACES), _LAST, np.int64)
    for o in range(_PLACES):
        at = np.flatnonzero((first <= o) & (o <= last))
        if not len(at):
            continue
        tie = next(c for c in columns if c >= o)
        heads = [np.ascontiguousarray(padded[at, o + s : o + s + 8]).view(">u8").ravel() for s in (0, 8)]
        order = np.lexsort((ranks[tie][at], heads[1], heads[0], bucket[at]))
        at = at[order]
        window = padded[at, o : o + LENGTH]
        new = np.ones(len(at), bool)
        new[1:] = (bucket[at][1:] != bucket[at][:-1]) | (window[1:] != window[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        out[at, o] = np.minimum.reduceat(ids[at], np.flatnonzero(new))[group]
    return out


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, block_rows: int, bucket_rows: int) -> DataFrame:
    """(id_, text_hash, spans): bytes that go, as stretches (at, length) or, from the window at
    `at` on, which of the next windows go."""
    spark = docs.sparkSession
    own = _keyed(docs, id_col, text_col)

    shares = max(_SHARES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Names (kind 0) and stretches (kind 1) of some texts at a time, with the second checksum,
        both ids and where it is (`spot`): from which byte on and, in the low half, the length of
        the stretch, or the `place` and number of the name's windows."""
        held: tuple[list, list] = ([], [])

        def packed() -> Iterator[pa.RecordBatch]:
            for kind, parts in enumerate(held):
                found = list(packed_shares(np.concatenate(parts, axis=1), shares)) if parts else []
                if found:
                    share, unsure, sure = zip(*found, strict=True)
                    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    columns = [pa.array(c, t) for c, t in zip((share, [kind] * len(share), unsure, sure), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["share", "kind", "unsure", "sure"])
                parts.clear()

        for some in _chunks(batches):
            raw, begin = text_bytes(some.column("text"))
            ids = [some.column(c).to_numpy() for c in ("id_", "text_hash")]
            first, count, place, h, owner = runs(raw, begin)
            low, high, g1, g2 = stretches(raw, begin, place, h)
            whose = np.searchsorted(begin, low, side="right") - 1
            # where the first window begins, counted so that the name is at _PLACES - 1
            within = first - place + _PLACES - 1
            for parts, one, two, of, at, extent in (
                (held[0], h, np.zeros(len(h), np.uint64), owner, first, within << 8 | count),
                (held[1], g1, g2, whose, low, high - low),
            ):
                spot = (at - begin[of]) << 32 | extent
                parts.append(np.stack([one, two, *(v[of].view(np.uint64) for v in ids), spot.view(np.uint64)]))
            if sum(p.shape[1] for parts in held for p in parts) >= _PACK:
                yield from packed()
        yield from packed()

    key = ["id_", "text_hash"]
    # each name and stretch is shuffled once and judged where it arrives
    each = own.mapInArrow(name, "share int, kind int, unsure binary, sure binary")
    ordered = each.repartition("share").sortWithinPartitions("share", "kind")
    judged = stored(ordered.mapInArrow(judged_shares, "h long, id_ long, text_hash long, spot long"), "repeat-claims")
    claims = judged.filter("spot IS NOT NULL")
    common = judged.filter("spot IS NULL").select("h", F.col("id_").alias("lo"))
    # joins below shuffle both sides at any size: what is common grows with the input
    lists = claims.groupBy(*key).agg(F.collect_list(F.struct("h", "spot")).alias("claims"))

    target_schema = "h long, id_ long, text_hash long, at long, place int, around binary"
    target_arrow = to_arrow(spark.createDataFrame([], target_schema))

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each run of windows of a claimed name outside settled stretches; rows without
        a name are settled stretches (`place` is their length)."""
        for some in _chunks(batches):
            raw, begin = text_bytes(some.column("text"))
            each = some.column("claims").flatten()
            owner = np.repeat(np.arange(len(some)), some.column("claims").value_lengths().to_numpy())
            spot, settled = each.field("spot").to_numpy(), each.field("h").is_null().to_numpy(zero_copy_only=False)
            start, extent = begin[owner] + (spot >> 32), spot & 0xFFFFFFFF
            low, length = start[settled], extent[settled]
            change = np.zeros(len(raw) + 2, np.int32)
            np.add.at(change, low, 1)
            np.add.at(change, low + length - LENGTH + 1, -1)
            closed = np.cumsum(change) > 0
            named = np.flatnonzero(~settled)
            count = extent[named] & 0xFF
            run = np.repeat(named, count)
            window = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            open_ = ~closed[window]
            run, window = run[open_], window[open_]
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1)
            a = np.flatnonzero(new)
            run, first, behind = run[a], window[a], window[np.append(a[1:], len(window)) - 1] + LENGTH
            place = (extent[run] >> 8) + first - start[run]
            at = np.concatenate([run, np.flatnonzero(settled)])
            of, whose = each.take(pa.array(at)), owner[at]
            columns = {
                "h": of.field("h"),
                "id_": some.column("id_").take(pa.array(whose)),
                "text_hash": some.column("text_hash").take(pa.array(whose)),
                "at": pa.array(np.concatenate([first, low]) - begin[whose]),
                "place": pa.array(np.concatenate([place, length]).astype(np.int32)),
                "around": pa.array([*_slices(raw, first, behind), *[None] * len(low)], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in target_arrow], schema=target_arrow)

    targets = stored(own.join(lists.hint("merge"), key).mapInArrow(surround, target_schema), "repeat-targets")
    named = targets.filter("h IS NOT NULL")

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each run of windows of a name that others ask about."""
        for some in _chunks(batches):
            raw, begin = text_bytes(some.column("text"))
            first, count, place, h, owner = runs(raw, begin)
            hit = _listed(some.column("asked"), h, owner)
            first, count, place, h, owner = (v[hit] for v in (first, count, place, h, owner))
            around = _slices(raw, first, first + count - 1 + LENGTH)
            columns = {
                "h": pa.array(h.view(np.int64)),
                "place": pa.array((first - place + _PLACES - 1).astype(np.int32)),
                "around": pa.array(around, pa.binary()),
                "id_": some.column("id_").take(pa.array(owner)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    least = named.select("h").distinct().join(common.hint("merge"), "h")
    asked = least.groupBy(F.col("lo").alias("id_")).agg(F.collect_list("h").alias("asked"))
    held = own.join(asked.hint("merge"), "id_").mapInArrow(hold, "h long, place int, around binary, id_ long")
    sources = stored(held, "repeat-sources")
    members = named.select("h", "place", "around", "id_").union(sources)
    rows = stored(
        members.groupBy("h", "place", "around").agg(F.min("id_").alias("lo"), F.max("id_").alias("hi")), "repeat-rows"
    )
    sizes = rows.groupBy("h").agg(F.count("*").alias("rows")).filter(F.col("rows") > bucket_rows)
    sizes = stored(sizes.select(F.col("h").alias("large")), "repeat-large")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_rows):
            h, place, lo = (block.column(c).to_numpy() for c in ("h", "place", "lo"))
            flat, offsets = _flat_bytes(block.column("around"))
            sizes = np.diff(offsets)
            row = np.repeat(np.arange(len(h)), sizes)
            matrix = np.zeros((len(h), _WIDTH), np.uint8)
            matrix[row, np.arange(len(flat)) - offsets[row] + place[row]] = flat
            windows = sizes - LENGTH + 1
            least = passage_ids(matrix, place, place + windows - 1, h, lo)
            column = np.arange(_PLACES)
            used = (column >= place[:, None]) & (column < (place + windows)[:, None])
            ends = np.concatenate([[0], np.cumsum(windows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(least[used]))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in ("h", "place", "around", "hi")), ids], names=["h", "place", "around", "hi", "ids"]
            )

    out = "h long, place int, around binary, hi long, ids array<long>"
    usual = rows.join(sizes, rows["h"] == sizes["large"], "left_anti")
    judged = usual.repartition("h").sortWithinPartitions("h").mapInArrow(sort, out)
    if sizes.limit(1).count():
        judged = judged.unionByName(_large_buckets(rows.join(sizes, rows["h"] == sizes["large"]).drop("large")))
    # what no member has to drop is left out
    judged = judged.filter(F.array_min("ids") < F.col("hi")).select(*_row_key(), "ids")
    judged = stored(judged, "repeat-judged")
    found = targets.select("id_", "text_hash", "at", *_row_key()).join(judged, ["k1", "k2"]).filter(
        F.array_min("ids") < F.col("id_")
    ).select("id_", "text_hash", "at", F.transform("ids", lambda i: i < F.col("id_")).alias("gone"), F.lit(0).alias("length"))
    whole = targets.filter("h IS NULL").select(
        "id_", "text_hash", "at", F.lit(None).cast("array<boolean>").alias("gone"), F.col("place").alias("length")
    )
    spans = F.collect_list(F.struct("at", "gone", "length")).alias("spans")
    return found.union(whole).groupBy("id_", "text_hash").agg(spans)


def _slices(raw: np.ndarray, first: np.ndarray, behind: np.ndarray) -> list[bytes]:
    data = raw.tobytes()
    return [data[s:e] for s, e in zip(first.tolist(), behind.tolist(), strict=True)]


def _flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and where each value begins, with the end."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


def _covered(spans: pa.Array, begin: np.ndarray, size: int) -> np.ndarray:
    """Which bytes of a chunk go, by the `spans` of its texts."""
    each = spans.flatten()
    owner = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start = begin[owner] + each.field("at").to_numpy(zero_copy_only=False)
    length = each.field("length").to_numpy(zero_copy_only=False)
    gone = each.field("gone")
    windows = gone.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    within = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    first = (np.repeat(start, windows) + within)[gone.flatten().to_numpy(zero_copy_only=False).astype(bool)]
    whole = length > 0
    opened = np.concatenate([first, start[whole]])
    closed = np.concatenate([first + LENGTH, (start + length)[whole]])
    change = np.bincount(opened, minlength=size + 1) - np.bincount(closed, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def _listed(lists: pa.Array, h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which hashes are in the list of their text."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    known = np.sort(mix(flat ^ mix(np.repeat(np.arange(len(lists)), size).astype(np.uint64), 41)))
    key = mix(h ^ mix(owner.astype(np.uint64), 41))
    slot = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
    return known[slot] == key if len(known) else np.zeros(len(h), bool)


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id_"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
        *more,
    )


def _row_key() -> list:
    return [F.xxhash64("h", "place", "around").alias("k1"), F.xxhash64(F.lit(7), "around", "h", "place").alias("k2")]


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets (rows of equal h, which arrive together), some `rows` at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        if size >= rows:
            # cut where a bucket ends
            last = held[-1].column("h")[-1].as_py()
            cut = int(np.argmax(h != last)) if (h != last).any() else len(h)
            held.append(batch.slice(0, cut))
            size += cut
            if cut < len(h):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [batch.slice(cut)], len(h) - cut
        else:
            held.append(batch)
            size += len(h)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _large_buckets(rows: DataFrame) -> DataFrame:
    """The same as the sort, window by window in Spark."""
    number = F.sequence(F.lit(0), F.length("around") - LENGTH)
    windows = rows.select("*", F.explode(number).alias("i")).withColumn(
        "window", F.expr(f"substring(around, i + 1, {LENGTH})")
    ).withColumn("o", F.col("place") + F.col("i"))
    least = windows.groupBy("h", "o", "window").agg(F.min("lo").alias("id"))
    found = windows.drop("lo").join(least, ["h", "o", "window"])
    return found.groupBy("h", "place", "around", "hi").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda x: x["id"]).alias("ids")
    )


_COUNTS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_rows: int = 50_000,
    bucket_rows: int = 50_000,
    whole_characters: bool = False,
) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document; `row` is the
    whole row, `kept` are the bytes left. A cut may split a character, unless `whole_characters`:
    then a character goes with any of its bytes."""
    spans = stored(repeated_spans(docs, id_col, text_col, block_rows, bucket_rows), "repeat-spans")
    whole = _keyed(docs, id_col, text_col, F.struct("*").alias("row")).drop("id", "text")
    own = whole.join(spans, ["id_", "text_hash"], "left").withColumn("text", F.col(f"row.`{text_col}`"))
    schema = f"row {own.schema['row'].dataType.simpleString()}, {_COUNTS}"
    arrow = to_arrow(docs.sparkSession.createDataFrame([], schema))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches):
            raw, begin = text_bytes(some.column("text"))
            covered = _covered(some.column("spans"), begin, len(raw))
            if whole_characters and len(raw):
                character = np.flatnonzero((raw & 0xC0) != 0x80)
                covered = np.repeat(np.logical_or.reduceat(covered, character), np.diff(np.append(character, len(raw))))
            before = np.zeros(len(raw), bool)
            before[1:] = covered[:-1]
            before[begin[:-1][begin[:-1] < len(raw)]] = False
            removed = np.concatenate([[0], np.cumsum(covered)])[begin]
            spans_upto = np.concatenate([[0], np.cumsum(covered & ~before)])[begin]
            left = raw[~covered].tobytes()
            ends = (begin - removed).tolist()
            kept = [left[x:y] for x, y in zip(ends, ends[1:], strict=False)]
            rows = (np.diff(begin), np.diff(removed), np.diff(spans_upto), [hashlib.sha256(x).hexdigest() for x in kept], kept)
            columns = [some.column("row"), *(pa.array(c) for c in rows)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return own.select("row", "text", "spans").mapInArrow(cut, schema)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with what is left of their texts (null stays null; characters that a cut would
    split go whole, all others stay), and all other columns."""
    found = without_repeats(docs, id_col, text_col, whole_characters=True, **options)
    left = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("kept").cast("string"))
    return found.select(*((left if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def repeats(spark, sf_dir: str) -> DataFrame:
    """Query op6: what is left of every document without earlier documents' passages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
