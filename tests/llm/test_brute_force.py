"""Differencing and maximal segments against their definitions, worked out the long way."""

import random
from collections import Counter

import pytest

from tallyroll.llm import shards, toxicity


def maximal(scores, begin=0):
    """The segment of the greatest sum, and those of what lies left and right of it."""
    best = max(
        ((sum(scores[b:e]), b, e) for b in range(len(scores)) for e in range(b + 1, len(scores) + 1)),
        default=(0, 0, 0),
    )
    if best[0] <= 0:
        return []
    total, b, e = best
    return [*maximal(scores[:b], begin), (begin + b, begin + e, total), *maximal(scores[e:], begin + e)]


def test_segments_equal_the_recursive_definition():
    rng = random.Random(3)
    for _ in range(300):
        weights = toxicity.Weights({f"w{i}": rng.uniform(0.1, 1.5) for i in range(6)})
        own = [rng.choice([*weights.of, *["clean"] * rng.randint(1, 20)]) for _ in range(rng.randint(0, 30))]
        scores = [weights.of.get(w, -toxicity.COST) for w in own]
        got, want = toxicity.segments(own, weights), maximal(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want], own
        assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))


def by_whole_partitions(sizes, parts):
    """Differencing over lists of groups: the two partitions of the largest spread are put together,
    the largest part of one with the smallest of the other."""
    held = [[[i]] + [[] for _ in range(parts - 1)] for i in range(len(sizes))]

    def size(part):
        return sum(sizes[i] for i in part)

    while len(held) > 1:
        held.sort(key=lambda p: max(map(size, p)) - min(map(size, p)))
        a, b = held.pop(), held.pop()
        held.append([x + y for x, y in zip(sorted(a, key=size), sorted(b, key=size, reverse=True), strict=True)])
    return {frozenset(part) for part in held[0] if part}


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_differencing_equals_whole_partitions(parts):
    rng = random.Random(parts)
    for n in [1, 2, parts, 9, 40]:
        sizes = [rng.randrange(1, 10**12) for _ in range(n)]
        labels = [x for (x,) in shards.difference([[s] for s in sizes], parts)]
        got = {frozenset(i for i in range(n) if labels[i] == k) for k in set(labels)}
        assert got == by_whole_partitions(sizes, parts)


def test_shards_differ_by_less_than_a_group(spark):
    """However the groups are dealt to tasks, a third of all rows being copies of one text."""
    rng = random.Random(8)
    texts = [f"{i} " + "x" * rng.randrange(4000) for i in range(300)]
    rows = list(enumerate([*texts, *["copied " * 3] * 150, None, ""]))
    got = shards.balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=6, groups_per_task=40).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    held, groups = Counter(), Counter()
    for r in got:
        held[r.shard] += r.size
        groups[rows[r.doc_id][1] or ""] += r.size
    assert len(held) == 6 and max(held.values()) - min(held.values()) <= max(groups.values())
    assert len({(r.shard, rows[r.doc_id][1] or "") for r in got}) == len(groups)
