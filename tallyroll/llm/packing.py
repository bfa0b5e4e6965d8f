"""Packing into training windows by non-negative least squares over length combinations.

A document gives full windows and one rest shorter than a window. Rests are counted by length
bin (a window has `units` bins), which is all that reaches the driver. Every combination of at
most `depth` bins that fills a window is a column of a matrix; non-negative least squares
finds how often to use each, and the numbers are rounded down to what the histogram holds.
Rests get their places by rank within their bin. Bins are floors, so a combination holds a
window's tokens or a little more, and what runs over is cut off. Cut tails and rests without a
place are packed greedily one after another, cut at window borders; the last, partial window
is cut at powers of two, where no padding is due. So no padding is left at all.

Defined cases. Text null or empty: the end id alone. Repeated rows and ids: each row is packed.
Ties within a bin go by id. No documents: no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.llm.encoding import binary_column, encoder, text_chunks, with_end
from tallyroll.llm.shared import Counter, running, stored, to_arrow


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """All non-increasing tuples of 1 to `depth` bins (each below `units`) that sum to `units`."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(chosen)
        elif len(chosen) < depth:
            for b in range(min(left, most), 0, -1):
                extend((*chosen, b), left - b, b)

    extend((), units, units - 1)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """min |ax - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        if not len(gradient) or gradient.max() <= slack:
            break
        active[int(gradient.argmax())] = True
        while True:
            s = np.zeros_like(x)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            below = active & (s <= 0)
            if not below.any():
                x = s
                break
            step = (x[below] / (x[below] - s[below])).min()
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], units: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with their repeat counts; together they use no bin more often than it occurs."""
    combos = combinations(units, depth)
    matrix = np.zeros((units, len(combos)))
    for j, combo in enumerate(combos):
        for b in combo:
            matrix[b, j] += 1
    have = np.array([histogram.get(b, 0) if b else 0 for b in range(units)], float)
    scale = max(1.0, have.max())
    repeats = nonnegative_least_squares(matrix, have / scale) * scale
    out, left = [], have.astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        need = matrix[:, j].astype(np.int64)
        n = min(int(repeats[j] + 1e-6), int((left[need > 0] // need[need > 0]).min()))
        if n > 0:
            out.append((combos[j], n))
            left -= n * need
    return out


def packed(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    units: int = 64,
    depth: int = 4,
    with_ids: bool = False,
) -> DataFrame:
    """One row a piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and the
    piece's token ids where `with_ids`. Sequences are numbered without gaps; each is full or has
    a power of two of ids."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    unit = window // units

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for some in (x for batch in batches for x in text_chunks(batch, "text")):
            ids, begin = with_end(*enc.encode_column(some.column("text")), end_id)
            yield pa.RecordBatch.from_arrays(
                [some.column("uid"), some.column("id"), pa.array(np.diff(begin)), binary_column(ids, begin)],
                names=["uid", "id", "n", "ids"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    tokens = stored(rows.mapInArrow(encode, f"uid long, id {id_type}, n long, ids binary"), "pack-tokens")

    lengths = tokens.select(
        "uid", "id", "n",
        F.floor(F.col("n") / window).alias("full"),
        (F.col("n") % window).alias("rest"),
        F.floor((F.col("n") % window) / unit).cast("int").alias("bin"),
    )
    full, rank = Counter("full_upto", weight="full"), Counter("rank", group="bin")
    ranked = running(lengths, ["id", "uid"], [full, rank], "pack-ranks")
    histogram: dict[int, int] = {}
    for _, b, n in ranked.totals["rank"]:
        histogram[b] = histogram.get(b, 0) + n
    chosen = plan(histogram, units, depth)
    n_full = ranked.total("full_upto")
    bases = list(accumulate((n for _, n in chosen), initial=n_full))
    # for each bin: its places, as (first rank, sequence of it, slot in the combination)
    places: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(range(units), 0)
    for (combo, n), base in zip(chosen, bases, strict=False):
        for slot, b in enumerate(combo):
            places.append((b, taken[b], taken[b] + n, base, slot))
            taken[b] += n
    ranked_rows = ranked.rows.select(
        "uid", "n", "full", "rest", "bin",
        ranked.before(full).alias("full_upto"),
        ranked.before(rank, units).alias("rank"),
    )

    whole = ranked_rows.filter("full > 0").select(
        "uid",
        F.explode(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.col("full") - 1),
                lambda k: F.struct(
                    (k * window).alias("start"),
                    F.lit(window).cast("long").alias("length"),
                    (F.col("full_upto") + k).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset"),
                ),
            )
        ).alias("piece"),
    ).select("uid", "piece.*")

    # at most units * number of combinations rows: broadcast whatever the data's size
    table = spark.createDataFrame(places, "bin int, first long, behind long, base long, slot int")
    rests = ranked_rows.filter("rest > 0").join(
        F.broadcast(table),
        (ranked_rows["bin"] == table["bin"]) & F.col("rank").between(F.col("first"), F.col("behind") - 1),
        "left",
    ).select(
        "uid", "rest", "slot",
        (F.col("n") - F.col("rest")).alias("start"),
        (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"),
    )
    rests = stored(rests, "pack-rests")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    combined = rests.filter("sequence_id IS NOT NULL").select(
        "uid", "start", "rest", "sequence_id",
        F.least(F.coalesce(F.sum("rest").over(earlier), F.lit(0)), F.lit(window)).alias("offset"),
    ).withColumn("length", F.least(F.col("rest"), window - F.col("offset")))
    combined = stored(combined, "pack-combined")
    placed = combined.filter("length > 0").select("uid", "start", "length", "sequence_id", "offset")

    left = rests.filter("sequence_id IS NULL").select("uid", "start", F.col("rest").alias("length")).unionByName(
        combined.filter("length < rest").select(
            "uid",
            (F.col("start") + F.col("length")).alias("start"),
            (F.col("rest") - F.col("length")).alias("length"),
        )
    )
    position = Counter("position", weight="length")
    stream = running(left, ["uid", "start"], [position], "pack-residuals")
    base = bases[-1] if chosen else n_full
    greedy = _cut_stream(
        stream.rows.select("uid", "start", "length", stream.before(position).alias("position")),
        stream.total("position"), base, window,
    )

    pieces = whole.unionByName(placed).unionByName(greedy)
    by_doc = pieces.groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    columns = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    columns += ", ids binary" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer).dtype
        for batch in batches:
            pieces = batch.column("pieces")
            owner = np.repeat(np.arange(len(pieces)), pieces.value_lengths().to_numpy())
            each = dict(zip(("start", "length", "sequence_id", "offset"), pieces.flatten().flatten(), strict=True))
            ids = [np.frombuffer(x.as_buffer(), dtype) for x in batch.column("ids")]
            places = zip(owner.tolist(), each["start"].to_pylist(), each["length"].to_pylist(), strict=True)
            data = [ids[i][s : s + n].astype("<u4").tobytes() for i, s, n in places]
            made = {
                **each,
                "id": batch.column("id").take(pa.array(owner)),
                "doc_tokens": batch.column("n").take(pa.array(owner)),
                "ids_crc32": pa.array([zlib.crc32(x) for x in data], pa.int64()),
            }
            if with_ids:
                made["ids"] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays([made[f.name] for f in arrow], schema=arrow)

    arrow = to_arrow(spark.createDataFrame([], columns))
    return tokens.join(by_doc, "uid").mapInArrow(cut, columns).withColumnRenamed("id", id_col)


def _cut_stream(stream: DataFrame, total: int, base: int, window: int) -> DataFrame:
    """Cut a stream of pieces at window borders, and its last partial window at powers of two,
    the largest first."""
    tail = total - total % window
    borders, ids, at = [], [], tail
    for power in reversed(range(window.bit_length())):
        if (total - tail) >> power & 1:
            borders.append(at)
            ids.append(base + tail // window + len(ids))
            at += 1 << power
    first, last = F.col("position"), F.col("position") + F.col("length")
    lows = F.array(*(F.lit(b).cast("long") for b in borders)) if borders else F.expr("array()").cast("array<bigint>")
    cuts = F.array_sort(
        F.array_distinct(
            F.concat(
                F.array(first),
                F.when(
                    F.floor((last - 1) / window) > F.floor(first / window),
                    F.transform(
                        F.sequence(F.floor(first / window) + 1, F.floor((last - 1) / window)), lambda k: k * window
                    ),
                ).otherwise(F.expr("array()").cast("array<bigint>")),
                F.filter(lows, lambda b: (b > first) & (b < last)),
            )
        )
    )
    pieces = stream.withColumn("cuts", cuts).select(
        "uid", "start", "length", "position", F.posexplode("cuts").alias("i", "low"), "cuts"
    )
    high = F.coalesce(F.try_element_at("cuts", F.col("i") + 2), last)
    sequence = base + F.floor(F.col("low") / window)
    begin = F.floor(F.col("low") / window) * window
    for border, number in zip(borders, ids, strict=True):
        sequence = F.when(F.col("low") >= border, F.lit(number)).otherwise(sequence)
        begin = F.when(F.col("low") >= border, F.lit(border)).otherwise(begin)
    return pieces.select(
        "uid",
        (F.col("start") + F.col("low") - F.col("position")).alias("start"),
        (high - F.col("low")).alias("length"),
        sequence.cast("long").alias("sequence_id"),
        (F.col("low") - begin).cast("long").alias("offset"),
    )


def packing(spark, sf_dir: str) -> DataFrame:
    """Query op4: all documents packed into sequences of at most 2048 tokens."""
    from public_tokenizers import path

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(docs, path("byte_bpe_50k.json"))
