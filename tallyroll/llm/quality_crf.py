"""Quality classifier: a linear-chain conditional random field over lines.

Every line with a word gets features of its own, of its neighbours and of the whole document's
repetition; the field labels lines good or bad, with transitions between them. Its weights are
fitted by gradient steps on the exact likelihood, on a bounded sample of labelled documents (a
document's lines carry its label). A document's quality is the mean of its lines' marginal
probabilities of being good (forward-backward), weighted by their length, and made a
probability by a logistic fit.

Defined cases. Text null, empty or without a word: score 0. Repeated rows: each is scored.
Without labelled rows of both kinds: score 0.5, except for texts without a word. Empty table: no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.jaccard import _chunks
from tallyroll.llm.shared import bounded_ids, learning_share, to_arrow
from tallyroll.llm.shingles import hashes_of, sums_by, text_bytes, word_bounds
from tallyroll.llm.toxicity import logistic

#: Features of one line, before neighbours: see `line_features`.
N_OWN = 12
_KINDS = np.zeros(256, np.uint8)  # 0 other, 1 lower or beyond ASCII, 2 upper, 3 digit, 4 symbol, 5 mark
_KINDS[[*range(97, 123), *range(128, 256)]] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 3
_KINDS[[ord(c) for c in "#*$%&|<>"]] = 4
_KINDS[[ord(c) for c in "!?;:.,"]] = 5


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines by N_OWN) of all lines with a word, their bytes, and where each text's
    lines begin, with the end."""
    raw, begin = text_bytes(column)
    breaks = np.flatnonzero(raw == 10) + 1
    line = np.unique(np.concatenate([begin, breaks])) if len(raw) else np.zeros(1, np.int64)
    starts, ends, first = word_bounds(raw, line)
    n_words = np.diff(first)
    full = np.flatnonzero(n_words > 0)
    if not len(full):
        return np.zeros((0, N_OWN)), np.zeros(0), np.zeros(len(begin), np.int64)
    size = np.diff(line)[full].astype(float)
    words = n_words[full].astype(float)
    kinds = _KINDS[raw]
    share = []
    for kind in (1, 2, 3, 4, 5):
        upto = np.concatenate([[0], np.cumsum(kinds == kind)])
        share.append((upto[line[1:]] - upto[line[:-1]])[full])
    letters = np.maximum(share[0] + share[1], 1)
    bang = np.concatenate([[0], np.cumsum(raw == ord("!"))])
    h = hashes_of(raw, starts, ends)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((h, owner))
    again = np.zeros(len(h))
    again[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    per_line = lambda x, o: np.bincount(o, x, len(n_words))[full]
    # lines that are in the same document before
    text_of = np.searchsorted(begin, line[full], side="right") - 1
    content = sums_by(owner, h, len(n_words))[full]
    seen = np.lexsort((np.arange(len(full)), content, text_of))
    repeat = np.zeros(len(full))
    repeat[seen[1:]] = (content[seen][1:] == content[seen][:-1]) & (text_of[seen][1:] == text_of[seen][:-1])
    features = np.stack(
        [
            np.log1p(size) / 5,
            share[1] / letters,
            share[2] / size * 10,
            share[3] / words,
            share[4] / words,
            (bang[line[1:]] - bang[line[:-1]])[full] / words,
            size / words / 8,
            per_line(same, owner) / words,
            per_line(again, owner[order]) / words,
            repeat,
            (words < 3).astype(float),
            letters / size,
        ],
        axis=1,
    )
    return np.clip(features, 0, 4), size, np.searchsorted(text_of, np.arange(len(begin)))


def with_neighbours(own: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Features of a line, the one before and the one after (0 at a document's ends), and 1."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    inner = begin[(begin > 0) & (begin < len(own))]
    before[inner], after[inner - 1] = 0, 0
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1)


def marginals(good: np.ndarray, move: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once, a line of each a step: the probability of
    good for each line, of each pair of labels for neighbouring lines (summed by document), and
    each document's log normaliser. `good` is the log potential of good against bad."""
    n = np.diff(begin)
    order = np.argsort(-n, kind="stable")
    sorted_n = n[order]
    longest = int(sorted_n[0]) if len(n) else 0
    active = [int(np.searchsorted(-sorted_n, -t, side="left")) for t in range(longest)]
    emit = np.stack([np.zeros_like(good), good], axis=1)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    for t in range(longest):
        at = begin[order[: active[t]]] + t
        if t == 0:
            forward[at] = emit[at]
        else:
            forward[at] = emit[at] + np.logaddexp(forward[at - 1, :1] + move[0], forward[at - 1, 1:] + move[1])
    for t in range(longest - 2, -1, -1):
        at = begin[order[: active[t + 1]]] + t
        ahead = emit[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(ahead[:, :1] + move[:, 0], ahead[:, 1:] + move[:, 1])
    whole = forward + backward
    z_line = np.logaddexp(whole[:, 0], whole[:, 1])
    normal = np.zeros(len(n))
    normal[n > 0] = z_line[begin[:-1][n > 0]]
    first = np.ones(len(good), bool)
    first[begin[:-1][n > 0]] = False
    later = np.flatnonzero(first)
    pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = np.exp(
                forward[later - 1, a] + move[a, b] + emit[later, b] + backward[later, b] - z_line[later]
            ).sum()
    return np.exp(whole[:, 1] - z_line), pairs, normal


@dataclass(frozen=True)
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def quality(self, own: np.ndarray, size: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Length-weighted mean marginal of each document (nan without lines)."""
        x = with_neighbours((own - self.mean) / self.scale, begin)
        good, _, _ = marginals(x @ self.weights, self.move, begin)
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        total = np.bincount(owner, size, len(begin) - 1)
        with np.errstate(invalid="ignore"):
            return np.bincount(owner, good * size, len(begin) - 1) / total

    def score(self, quality: np.ndarray) -> np.ndarray:
        x = self.slope * _logit(quality) + self.intercept
        return np.where(np.isnan(quality), 0.0, 1 / (1 + np.exp(-np.clip(x, -30, 30))))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(np.nan_to_num(p, nan=0.5), 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def fit_field(documents: list[tuple[int, np.ndarray, np.ndarray]], shares: dict[int, float], steps: int = 300) -> Field:
    """Fit on (label, features, sizes) of each document; `shares` are the labels' true shares."""
    documents = [d for d in documents if len(d[1])]
    flat = np.full(N_OWN, 0.0)
    if len({y for y, _, _ in documents}) < 2:
        return Field(flat, flat + 1, np.zeros(3 * N_OWN + 1), np.zeros((2, 2)))
    own = np.concatenate([f for _, f, _ in documents])
    begin = np.concatenate([[0], np.cumsum([len(f) for _, f, _ in documents])])
    mean, scale = own.mean(axis=0), np.maximum(own.std(axis=0), 1e-3)
    x = with_neighbours((own - mean) / scale, begin)
    label = np.array([y for y, _, _ in documents])
    y = np.repeat(label, np.diff(begin))
    inside = np.ones(len(y), bool)
    inside[begin[:-1]] = False
    seen = np.zeros((2, 2))
    for a in (0, 1):
        seen[a, a] = np.count_nonzero(inside & (y == a))
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        move = theta[-4:].reshape(2, 2)
        good, pairs, _ = marginals(x @ theta[:-4], move, begin)
        gradient = np.append(x.T @ (y - good), (seen - pairs).ravel()) / len(y) - 1e-3 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    raw = Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))
    quality = raw.quality(own, np.concatenate([s for _, _, s in documents]), begin)
    weight = np.array([shares[int(v)] / np.count_nonzero(label == v) for v in label])
    slope, intercept = logistic(_logit(quality), label.astype(float), weight * len(label) / weight.sum())
    return Field(mean, scale, raw.weights, raw.move, slope, intercept)


def fitted_field(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, documents: int) -> Field:
    """Fit on all lines of at most `documents` labelled rows of each kind, chosen by hash."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull())
    chosen = bounded_ids(known, id_col, ["quality"], documents).select(F.col(id_col).alias("_id"), "quality")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = own.join(F.broadcast(chosen), own["id"] == chosen["_id"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches):
            own, size, begin = line_features(some.column("text"))
            lines = [slice(a, b) for a, b in zip(begin, begin[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("quality"),
                    pa.array([own[c].astype("<f4").tobytes() for c in lines], pa.binary()),
                    pa.array([size[c].astype("<f4").tobytes() for c in lines], pa.binary()),
                ],
                names=["quality", "own", "size"],
            )

    rows = sample.select(F.col("quality").cast("int").alias("quality"), "text")
    found = rows.mapInArrow(features, "quality int, own binary, size binary").collect()
    shares = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    read = lambda b: np.frombuffer(b, "<f4").astype(float)
    ordered = sorted((r.quality, bytes(r.own), bytes(r.size)) for r in found)
    return fit_field([(q, read(o).reshape(-1, N_OWN), read(s)) for q, o, s in ordered], shares)


def quality_scores(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_lines) of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, score double, n_lines long"
    arrow = to_arrow(docs.sparkSession.createDataFrame([], schema))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches):
            own, size, begin = line_features(some.column("text"))
            score = field.score(field.quality(own, size, begin))
            columns = [some.column("id"), pa.array(score), pa.array(np.diff(begin))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(judge, schema).withColumnRenamed("id", id_col)


def quality(spark, sf_dir: str) -> DataFrame:
    """Query op10: quality of every document, learned from three quarters of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~learning_share("doc_id", 4, 2))
    field = fitted_field(docs, labels, "doc_id", "text", 2000)
    return quality_scores(docs, field).select(
        "doc_id", learning_share("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_lines",
    )
