"""Toxicity by maximal-scoring segments of word log-odds.

From a bounded sample of labelled documents every word, and every beginning of a word (so that
inflected and made-up forms count too), gets its log-odds between toxic and clean documents
(by places with different neighbours), with an informative Dirichlet prior (its share of the whole sample), and their standard
deviation. Where they are significant a word carries the largest of them as score, any other
word a small cost. A linear scan finds every maximal segment (Ruzzo and Tompa). A segment of score
S in n words is expected K n exp(-lambda S) times by chance (Karlin and Altschul), so a
document's strongest segments follow an extreme-value law: the location is fitted on clean
documents of the sample, and the normalised score becomes a probability by a logistic fit.

Defined cases. Text null, empty or without words: no segment, the score of a document with
none. Repeated rows: each is scored. No labelled toxic or clean rows: score 0 for all. Empty
table: no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import text_chunks
from tallyroll.llm.shared import bounded_ids, learning_share, to_arrow

_WORD = re.compile(r"[^\W\d_]+")
#: Weight of the prior, as a share of the sample; least standard score and log-odds of a feature that
#: carries its log-odds; cost of any other word. A feature is a word, or its beginning marked with `*`.
PRIOR, LEAST_Z, LEAST_ODDS, COST, BEGINNINGS = 0.15, 2.8, 1.2, 0.25, (4, 5, 6)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


def log_odds(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Significant features (clean and toxic places with it) with their smoothed log-odds."""
    clean, toxic = (sum(c[i] for c in counts.values()) for i in (0, 1))
    prior, out = PRIOR * (clean + toxic), {}
    for w, (y0, y1) in counts.items():
        a = PRIOR * (y0 + y1)
        odds1 = (y1 + a) / (toxic + prior - y1 - a)
        odds0 = (y0 + a) / (clean + prior - y0 - a)
        delta = float(np.log(odds1) - np.log(odds0))
        if delta >= LEAST_ODDS and delta / np.sqrt(1 / (y1 + a) + 1 / (y0 + a)) >= LEAST_Z:
            out[w] = delta
    return out


class Weights(dict):
    """Score of a word, None without a significant feature; `known` words are remembered."""

    def __init__(self, of: dict[str, float], known: int = 200_000):
        self.of, self.known = of, known

    def __missing__(self, word: str) -> float | None:
        if len(self) >= self.known:
            self.clear()
        self[word] = score = max((self.of[f] for f in features(word) if f in self.of), default=None)
        return score


def segments(own: list[str], weights: Weights) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (begin, end, score) in order, in one pass: each positive
    word is a segment that swallows earlier ones as long as that raises the score."""
    total, stack = 0.0, []  # (begin, end, sum before, sum with)
    at = 0
    for i, w in enumerate(own):
        score = weights[w]
        if score is None:
            continue
        total -= COST * (i - at)
        at = i + 1
        low, high, begin = total, total + score, i
        total = high
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            if j < 0 or stack[j][3] >= high:
                break
            begin, low = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((begin, i + 1, low, high))
    return [(b, e, high - low) for b, e, low, high in stack]


def decay(scores: list[float], shares: list[float]) -> float:
    """lambda > 0 with sum(share * exp(lambda * score)) = 1: how fast chance segments get rare."""
    s, p = np.array([*scores, -COST]), np.array([*shares, 1 - sum(shares)])
    if not scores or (s * p).sum() >= 0:
        return 0.1
    low, high = 0.0, 1.0
    while (p * np.exp(high * s)).sum() < 1:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * s)).sum() < 1 else (low, middle)
    return high


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    rate: float = 0.1
    location: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        """Sum over significant segments of lambda * S - ln n, above the location of chance."""
        each = [self.rate * s - np.log(n) - self.location for _, _, s in found]
        return float(sum(x for x in each if x > 0) or max(each, default=-10.0))

    def score(self, n: int, found: list[tuple[int, int, float]]) -> float:
        if not self.weights:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.evidence(n, found) + self.intercept, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a slight pull to zero."""
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(beta[0]), float(beta[1])


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, documents: int) -> Model:
    """Fit on at most `documents` labelled rows of each class, chosen by hash."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull())
    chosen = bounded_ids(known, id_col, ["toxic"], documents).select(F.col(id_col).alias("_id"), "toxic")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = own.join(F.broadcast(chosen), own["id"] == chosen["_id"])
    rows = [(r[0], words(r[1])) for r in sample.select("toxic", "text").collect()]
    if len({toxic for toxic, _ in rows}) < 2:
        return Model({})
    # a place counts once however often its neighbourhood is copied, or the words of a copied
    # document would pass for toxic
    counts: dict[str, list[int]] = {}
    seen: set[tuple] = set()
    for toxic, own in rows:
        for place in zip(["", *own], own, [*own[1:], ""], strict=False):
            if (toxic, place) not in seen:
                seen.add((toxic, place))
                for f in features(place[1]):
                    counts.setdefault(f, [0, 0])[toxic] += 1
    weights = Weights(log_odds(counts))
    clean = Counter(weights[w] for toxic, own in rows if not toxic for w in own)
    scores = [s for s in clean if s is not None]
    rate = decay(scores, [clean[s] / clean.total() for s in scores])
    found = [segments(own, weights) for _, own in rows]
    chance = [
        max((rate * s for _, _, s in f), default=0.0) - np.log(len(own))
        for (toxic, own), f in zip(rows, found, strict=True)
        if not toxic and own
    ]
    # Gumbel by moments: the mode is the mean less Euler's constant times the scale
    location = float(np.mean(chance) - 0.5772 * np.std(chance) * np.sqrt(6) / np.pi) if chance else 0.0
    raw = Model(weights.of, rate, location)
    x = np.array([raw.evidence(len(own), f) for (_, own), f in zip(rows, found, strict=True)])
    # the sample holds both classes alike; weights bring back the labels' own shares
    whole = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    own = Counter(t for t, _ in rows)
    y = np.array([t for t, _ in rows])
    weight = np.array([whole[t] / own[t] for t in y.tolist()])
    slope, intercept = logistic(x, y.astype(float), weight * len(y) / weight.sum())
    return Model(weights.of, rate, location, slope, intercept)


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    spans: bool = False) -> DataFrame:
    """(id, score, n_segments) of every row; with `spans` also the segments' words."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, score double, n_segments long" + ", passages array<string>" * spans
    arrow = to_arrow(docs.sparkSession.createDataFrame([], schema))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.weights)
        for batch in batches:
            for some in text_chunks(batch, "text", 1 << 21):
                texts = some.column("text").to_pylist()
                own = [words(t) for t in texts]
                found = [segments(w, weights) for w in own]
                scores = [model.score(len(w), f) for w, f in zip(own, found, strict=True)]
                columns = [some.column("id"), pa.array(scores, pa.float64()), pa.array([len(f) for f in found])]
                if spans:
                    columns.append(pa.array([[" ".join(w[b:e]) for b, e, _ in f] for w, f in zip(own, found, strict=True)]))
                columns = [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(judge, schema).withColumnRenamed("id", id_col)


def toxicity(spark, sf_dir: str) -> DataFrame:
    """Query op9: toxicity of every document, learned from four fifths of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~learning_share("doc_id", 5, 0))
    model = fitted(docs, labels, "doc_id", "text", 2000)
    return toxicity_scores(docs, model).select(
        "doc_id", learning_share("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments",
    )
