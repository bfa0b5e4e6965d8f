"""Best-fit packing: the search against exact optima, and whole results against the library's ids."""

import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from tallyroll.llm import best_fit

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, uid string, id string, piece string, length string, block string"


def optimum(lengths, window):
    """The least number of bins, by trying every subset of what is left."""

    @lru_cache(None)
    def go(left):
        if not left:
            return 0
        first, rest, best = left[0], left[1:], len(left)
        for pick in range(1 << len(rest)):
            own = [x for i, x in enumerate(rest) if pick >> i & 1]
            if first + sum(own) <= window:
                best = min(best, 1 + go(tuple(x for i, x in enumerate(rest) if not pick >> i & 1)))
        return best

    return go(tuple(sorted(lengths, reverse=True)))


def check_bins(lengths, bins, window):
    fill = np.bincount(bins, lengths) if len(lengths) else np.zeros(0)
    assert (fill <= window).all()
    return int((fill > 0).sum())


def test_search_is_near_the_optimum():
    rng, over = random.Random(1), 0
    for _ in range(300):
        window = rng.choice([10, 20, 50])
        lengths = np.array([rng.randint(1, window) for _ in range(rng.randint(1, 9))], np.int64)
        start = best_fit.best_fit(lengths, window)
        found = best_fit.Search(lengths, start, window).run()
        most, n = check_bins(lengths, start, window), check_bins(lengths, found, window)
        least = optimum(lengths.tolist(), window)
        assert least <= n <= most
        over += n - least
    assert over <= 3


def test_steps_grow_squared_fills_and_empty_bins(monkeypatch):
    rng = np.random.default_rng(2)
    squares, kinds = [], set()
    apply = best_fit.Search._apply

    def counted(self, giver, other, gives, takes):
        kinds.add((len(gives), len(takes)))
        apply(self, giver, other, gives, takes)
        squares.append(int(((self.window - self.room) ** 2).sum()))

    monkeypatch.setattr(best_fit.Search, "_apply", counted)
    for lengths in (rng.integers(1200, 2200, 900), rng.integers(300, 1700, 900)):
        squares.clear()
        start = rng.permutation(len(lengths)) // 2  # two by two, by chance: far from full
        before = check_bins(lengths, start, 4400)
        search = best_fit.Search(lengths, start, 4400)
        after = check_bins(lengths, search.run(), 4400)
        assert after < 0.88 * before
        assert all(a < b for a, b in zip(squares, squares[1:], strict=False)) and len(squares) > 50
        assert (search.room == 4400 - np.bincount(search.bin, lengths, len(search.room))).all()
    assert kinds == {(1, 0), (1, 1), (2, 1), (1, 2)}


def test_pack_has_no_gaps():
    lengths = np.random.default_rng(3).integers(1, 60, 500)
    bins, offset, room = best_fit.pack(lengths, 64)
    for b in np.unique(bins):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1]]
        assert room[b] == 64 - lengths[own].sum()
    assert len(best_fit.pack(np.zeros(0, np.int64), 64)[0]) == 0


@pytest.mark.parametrize(("window", "block"), [(4096, 20_000), (64, 50)])
def test_whole_result(spark, window, block):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdrklmst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(300)]
    texts += [None, "", " \n", "x" * 3000, " ".join(word() for _ in range(9000)), "It's ÉTÉ 日本 <|endoftext|> 12", texts[0]]
    rows = [(i, t, "u", "i", "p", "l", "b") for i, t in enumerate(texts)] + [(3, texts[3], *"uiplb"), (None, "no id", *"uiplb")]
    plain = tokenizers.Tokenizer.from_file(TOKENIZER)
    want = {}
    for i, t, *_ in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), window):
            key = (i, k // window, k, len(ids[k : k + window]), zlib.crc32(ids[k : k + window].tobytes()))
            want[key] = want.get(key, 0) + 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = best_fit.best_fit_packed(docs, TOKENIZER, window=window, block=block, with_ids=True).collect()
    got, bins = {}, {}
    for r in found:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    total = sum(r.length for r in found)
    assert len(bins) <= -(-total // window) * 1.02 + 2


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert best_fit.best_fit_packed(none, TOKENIZER).count() == 0
    long = spark.createDataFrame([(i, "word " * 127, *"uiplb") for i in range(5)], SCHEMA)
    found = best_fit.best_fit_packed(long, TOKENIZER, window=64).collect()
    assert {(r.length, r.offset) for r in found} == {(64, 0)} and len({r.sequence_id for r in found}) == 10
    assert found[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    # pieces of more than half a window: no two fit, and the rounds end
    large = spark.createDataFrame([(i, "word " * 39, *"uiplb") for i in range(200)], SCHEMA)
    found = best_fit.best_fit_packed(large, TOKENIZER, window=64, block=10).collect()
    assert len({r.sequence_id for r in found}) == 200
