"""Periodic runs against a comparison of every word with every other."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallyroll.llm import periodic_runs as periodic

SCHEMA = "doc_id long, text string, runs string, id string, collapsed string, n_words int, longest string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def naive_runs(words, least=12):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def texts():
    rng = random.Random(13)
    out = []
    for size in (2, 3, 30):
        for _ in range(150):
            out.append([rng.randrange(size) for _ in range(rng.randint(0, 70))])
    for _ in range(300):  # powers of powers, with single changes and touching stretches
        word = [rng.randrange(3) for _ in range(rng.randint(1, 5))]
        word = word * rng.randint(1, 9) + [rng.randrange(3) for _ in range(rng.randint(0, 3))]
        word = (word * rng.randint(1, 6))[:250]
        if rng.random() < 0.5 and word:
            word[rng.randrange(len(word))] = 9
        out.append([rng.randrange(3) for _ in range(rng.randint(0, 6))] + word + word[::-1][: rng.randint(0, 60)])
    out += [[0, 1] * 40 + [1, 0] * 40, [5] * 300, [0, 0, 1] * 60 + [0, 1, 0] * 30, [*range(100), *range(100)]]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    return [*out, b]


@pytest.mark.parametrize("least", [12, 2, 5, 40])
def test_runs_of_numbers(least):
    every = texts()
    begin = np.cumsum([0, *map(len, every)])
    got = periodic.word_runs(np.array(sum(every, []), np.uint64), begin, least)
    want = [(i, *run) for i, words in enumerate(every) for run in naive_runs(words, least)]
    assert list(map(tuple, got.tolist())) == want


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 37, 200)
    tree = periodic.WaveletTree(values)
    low = rng.integers(0, 200, 500)
    high = rng.integers(low, 201)
    ask = rng.integers(0, 70, 500)
    for lo, hi, v, found in zip(low, high, ask, tree.successor(low, high, ask), strict=True):
        assert found == min((x for x in values[lo:hi] if x >= v), default=-1)


def test_progressions_take_few_rounds():
    """A block in a long repetition asks a few times only, whatever the repetition's length."""
    asked = []
    plain = periodic.WaveletTree.successor

    class Counting(periodic.WaveletTree):
        def successor(self, low, high, value):
            asked.append(len(low))
            return plain(self, low, high, value)

    for words in ([7] * 20_000, [0, 1] * 5_000 + [1, 0] * 5_000):
        asked.clear()
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(periodic, "WaveletTree", Counting)
            periodic.word_runs(np.array(words, np.uint64), np.array([0, len(words)]))
        assert len(asked) < 200 and sum(asked) < 20 * len(words)


def expected(doc_id, text):
    words = words_of(text)
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = naive_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)))


def test_whole_result(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(str(rng.randrange(40)) for _ in range(rng.randint(0, 150)))) for i in range(150)]
    odd = [None, "", " \n", "a", "\xa0 a\x1cb", "ab " * 700, "x" * 100_000, "é ü\t" * 30, "\na b\r\n" * 40, "word " * 30_000]
    rows += [(1000 + i, t) for i, t in enumerate(odd)] + [(None, "a b " * 20), (None, None), rows[3], rows[3]]
    docs = spark.createDataFrame([(i, t, "r", "i", "c", 1, "l") for i, t in rows], SCHEMA).repartition(3)
    got = periodic.digest(periodic.periodic_runs(docs, text_col=periodic.planted()))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i is not None) > 5
    got = got.collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got if r.doc_id is None} == {expected(None, t) for i, t in rows if i is None}
    by_id = {r.doc_id: tuple(r) for r in got if r.doc_id is not None}
    for i, t in rows:
        if i is not None and i != 1009:  # too long for the comparison
            assert by_id[i] == expected(i, t), (i, t)
    assert by_id[1009][:6] == (1009, 1, 0, 30_000, 1, 30_000_000)


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert periodic.digest(periodic.periodic_runs(none, text_col=periodic.planted())).count() == 0
    docs = spark.createDataFrame([(1, "a b " * 6 + "c", "r", "i", "c", 1, "l"), (None, None, "r", "i", "c", 1, "l")], SCHEMA)
    first, null = sorted(periodic.periodic_runs(docs).collect(), key=lambda r: r.doc_id is None)
    assert [tuple(r) for r in first.runs] == [(0, 12, 2)] and first.collapsed == "a b c" and first.n_words == 13
    assert (null.runs, null.collapsed, null.n_words) == ([], "", 0)
