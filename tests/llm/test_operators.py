"""Operators against brute force, exact round trips and held-out labels, on small tables with
nulls, empty and long texts, ties, repeated rows and columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import decontamination, encoding, jaccard, language, packing, quality_crf, quality_rules, repeats, shards
from tallyroll.llm import token_files, toxicity
from tallyroll.llm.components import components
from tallyroll.llm.shared import new_path

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Names that the operators use for columns of their own.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, id_ string, row string, score string, toxic int, quality int, _id string, key string, block int"


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ba", "do", "ri", "ke", "lu", "mo", "st", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(20, 120)) for _ in range(40)]
    long = sentence(rng, 6000)
    near = [" ".join(w if rng.random() > 0.004 else "changed" for w in texts[0].split()) for _ in range(12)]
    passage = sentence(rng, 40)
    shared = [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(8)]
    odd = [None, "", " ", "\n\n", "a", "a b", "12 34", "é", "x" * 5000, "ab " * 700, "a\tb  c d\r\n", "日本語 の テキスト"]
    every = [*texts, long, long + " end", *near, *shared, *texts[:5], *odd]
    out = [(i, t, ["en", "de", None][i % 3], "s", None if t is None else len(t), "x", "y", "z", "w", 1, 0, "v", "u", 3) for i, t in enumerate(every)]
    out += [out[3], out[3], (None, "no id here", *[None] * 12)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, rows):
    made = [(r[0], i % 4 != 0, i % 5 == 0) for i, r in enumerate(rows)] + [(None, None, None)]
    made = [(i, None if q is None else int(q), None if t is None else int(t)) for i, q, t in made]
    return spark.createDataFrame(made, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def tokenizer():
    made = tokenizers.Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return made


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- 1


def naive_phrases(text, sample):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(1)
    samples = {"a": sentence(rng, 40), "b": sentence(rng, 30)}
    own = language.Parser(samples)
    texts = ["", "zzz", "!?", "ba do", *(sentence(rng, n) for n in (1, 5, 30))]
    phrases, size, letters = own.parse(texts)
    plain = lambda t: re.sub(r"[^a-z]+", " ", t + " ").lstrip()
    for i, t in enumerate(texts):
        for k, lang in enumerate(own.languages):
            assert size[i] <= language.BLOCK
            assert phrases[k, i] == naive_phrases(plain(t), plain(samples[lang])), (t, lang)
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]


def test_language_edges(docs, none, rows):
    found = language.languages(docs, docs).collect()
    assert len(found) == len(rows)
    by_text = {r.doc_id: r for r in found}
    for i, t, *_ in rows:
        if i is not None and not any(c.isalpha() for c in t or ""):
            assert (by_text[i].lang_pred, by_text[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in language.languages(docs, none).collect()} == {"und"}
    assert language.languages(none, docs).count() == 0


# --- 2


def test_leaks(spark, docs, none, rows):
    rng = random.Random(3)
    item = sentence(rng, 50)
    edited = list(item)
    for at in (30, 140, 200):
        edited[at] = "q"
    cases = {1: f"before {item} after", 2: item.upper(), 3: "x " + "".join(edited), 4: item[:50], 5: sentence(rng, 80),
             6: item.replace(" ", "\n-- "), 7: None, 8: ""}
    own = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "short"), (12, None), (13, item)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.leaks(own, bench).collect()}
    assert {k[0] for k in found} == {1, 2, 3, 6} and {k[1] for k in found} == {10, 13}
    hit = found[1, 10]
    assert cases[1][hit.begin : hit.end] == item and hit.edits == 0
    blocks = decontamination.leaks(own, bench, block_characters=10).collect()
    assert sorted(blocks) == sorted(found.values())
    kept = decontamination.without_leaks(own, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7, 8] and kept.columns == own.columns
    assert decontamination.without_leaks(docs, bench).count() == len(rows)
    alike = own.withColumn("doc_id", F.lit(None).cast("long"))  # rows without an id are judged one by one
    assert Counter(r.text for r in decontamination.without_leaks(alike, bench).collect()) == Counter(r.text for r in kept.collect())
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == len(rows)
    assert decontamination.leaks(none, bench).count() == 0


def test_leaks_are_found_at_every_offset():
    rng = random.Random(11)
    item = re.sub(" $", "x", sentence(rng, 50)[:224])
    patterns = decontamination.Patterns.of([10], [item])
    for size in (80, 81, 90, 100, 110, 118):
        cuts = [item[at : at + size] for at in range(len(item) - size + 1)]
        around = [(sentence(rng, 20) + " 1", "2 " + sentence(rng, 20)) for _ in cuts]
        codes, _, _, owner = decontamination.normal([f"{a}{c}{b}" for c, (a, b) in zip(cuts, around, strict=True)])
        _, begin, _, edits = patterns.search(codes)
        assert set(owner[begin[edits <= 1]].tolist()) == set(range(len(cuts))), size
        if size in (80, 110):
            changed = [c[:10] + "7" + c[11:40] + c[41:60] + "99" + c[60:70] + "7" + c[71:] for c in cuts]
            codes, _, _, owner = decontamination.normal([f"{a}{c}{b}" for c, (a, b) in zip(changed, around, strict=True)])
            assert set(owner[patterns.search(codes)[1]].tolist()) == set(range(len(cuts))), size


def test_banded_alignment_is_edit_distance():
    rng = random.Random(5)
    for _ in range(200):
        pattern = [rng.choice("ab c") for _ in range(rng.randint(10, 30))]
        text = list(pattern)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["b"], ["a", text[at]]])
        whole = ["z"] * 6 + text + ["z"] * 40
        least = list(range(len(pattern) + 1))
        best = least[-1]
        for c in whole:
            before, least[0] = least[0], 0
            for i, p in enumerate(pattern, 1):
                before, least[i] = least[i], min(least[i] + 1, least[i - 1] + 1, before + (c != p))
            best = min(best, least[-1])
        codes = lambda s: np.array([ord(c) for c in s], np.uint32)
        got, begin, end = decontamination.aligned(codes(pattern), codes(whole), np.array([0]), 14)
        assert got[0] == best and 0 <= begin[0] <= end[0] <= len(whole)


# --- 3


def test_quality_rules_edges(docs, none, labels, rows):
    found = quality_rules.judged(docs, labels).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        w = words_of(texts[r.doc_id])
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = Counter(tri)
        covered = {p for i, g in enumerate(tri) if count[g] > 1 for p in (i, i + 1, i + 2)}
        assert (r.n_words, r.n_repeat_words, r.word_chars) == (len(w), len(covered), sum(map(len, w)))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    kept = quality_rules.passing(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.kept)
    unlabelled = quality_rules.judged(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in unlabelled)
    assert quality_rules.judged(none, labels).count() == 0


def test_all_trusted_documents_count(spark):
    seen = {}
    for b in range(1, 5000):
        a = seen.setdefault(zlib.crc32(str(b).encode()) % 16_384, b)
        if a != b:
            break
    own = spark.createDataFrame([(a, "one two three " * 20), (b, "four five six " * 20)], "doc_id long, text string")
    good = spark.createDataFrame([(a, 1), (b, 1), (b, 1)], "doc_id long, quality int")
    # all text is trusted, so no gram is likelier in the target than in the whole
    assert {r.score for r in quality_rules.judged(own, good).collect()} == {0}


def test_op3_counts_all_trusted_documents(spark, tmp_path):
    """Of many trusted documents some share one of 16,384 hash buckets; the query takes them all."""
    n = 5000
    assert len({zlib.crc32(str(i).encode()) % 16_384 for i in range(n)}) < n
    own = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.concat("id", F.lit(" ")), 60).alias("text"))
    own.write.parquet(f"{tmp_path}/documents.parquet")
    own.select("doc_id", F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    # all text is trusted, so no gram is likelier in the target than in the whole
    assert {r.score for r in quality_rules.quality_rules(spark, str(tmp_path)).collect()} == {0}


# --- 4


def test_least_squares():
    rng = np.random.default_rng(2)
    a = rng.random((12, 20))
    true = np.where(rng.random(20) < 0.3, rng.random(20), 0)
    x = packing.nonnegative_least_squares(a, a @ true)
    assert (x >= 0).all() and np.allclose(a @ x, a @ true, atol=1e-6)
    assert {sum(c) for c in packing.combinations(16, 3)} == {16}
    left = Counter({b: 10 for b in range(1, 16)})
    for combo, n in packing.plan(dict(left), 16, 3):
        for b in combo:
            left[b] -= n
    assert min(left.values()) >= 0


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(docs, none, rows, tokenizer, window):
    pieces = packing.packed(docs, TOKENIZER, window=window, units=32 if window == 64 else 64, with_ids=True).collect()
    want = Counter((r[0], ids_of(tokenizer, r[1], 1).tobytes()) for r in rows)
    total, by_sequence, by_doc = 0, {}, {}
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        total += p.length
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, bytes(p.ids), p.doc_tokens))
    assert total == sum(len(b) // 4 * n for (_, b), n in want.items())
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)
    for (doc, ids), n in want.items():
        own = sorted(x for x in by_doc[doc] if x[3] == len(ids) // 4)
        at = 0
        for start, length, data, _ in own:
            assert ids[4 * start : 4 * (start + length)] == data
            at += length
        assert at == n * len(ids) // 4
    assert packing.packed(none, TOKENIZER).count() == 0


def test_added_tokens_are_encoded_as_by_the_library(spark):
    plain = tokenizers.Tokenizer.from_file(TOKENIZER)
    texts = ["a<|endoftext|>b", "one two <|endoftext|> three four", "<|endoftext|>", "x <|endoftext|><|endoftext|>\n y",
             "a <|endoftext| > b", "one two three", "", None]
    made = encoding.Encoder(TOKENIZER)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [made.encode(t).tolist() for t in texts] == want
    assert 50256 in want[0]
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packs = packing.packed(own, TOKENIZER).select("doc_id", "doc_tokens").distinct().collect()
    files = token_files.read_token_files(token_files.write_token_files(own, new_path(spark, "test-added"), TOKENIZER, 2))
    sizes = {i: len(ids) + 1 for i, ids in enumerate(want)}
    assert dict(map(tuple, packs)) == sizes == {r.doc_id: r.n_tokens for r in files.collect()}


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "other"])
def test_ids_are_those_of_the_library(file, tmp_path):
    path = public_tokenizers.path(file if file != "other" else "byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    if file == "other":  # a pattern of its own: texts go to the library whole
        plain.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=True)
        plain.save(path := str(tmp_path / "other.json"))
    made = encoding.Encoder(path, most_pieces=500)
    rng = random.Random(11)
    signs = [*"abcXYZ  \n\t'''s.t!?0129éßÜ日本İΣǅ٣²|<>", "\x00", "\x1c", "\x85", "\xa0", "́", "　"]
    signs += ["'re", "'ll", "'S", " '", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += [None, "", "  ", "\n\n\nx", " \n x  ", "x" * 3000, "it's we'll\n'tis ''s can'test"]
    for at in range(0, len(texts), 700):
        ids, begin = made.encode_column(pa.array(texts[at : at + 700], pa.string()))
        for i, text in enumerate(texts[at : at + 700]):
            assert ids[begin[i] : begin[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


# --- 5


def naive_components(rows, k, num, den):
    sets = {}
    for i, t, *_ in rows:
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i is not None and j is not None and i < j and sets[i]:
                both = len(sets[i] & sets[j])
                if den * both >= num * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    return {i: (len(s), None if i is None else find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "num", "block", "passes"), [(3, 90, 2_000_000, 1), (5, 80, 500, 2), (2, 60, 300, 3)])
def test_jaccard(docs, none, rows, k, num, block, passes):
    got = jaccard.jaccard_components(docs, k, num, 100, block=block, passes=passes).collect()
    want = naive_components(rows, k, num, 100)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert jaccard.jaccard_components(none).count() == 0


def test_first_of_group(docs, rows):
    kept = jaccard.first_of_group(docs, k=5, num=80)
    want = naive_components(rows, 5, 80, 100)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i is not None and c[1] == i)
    assert None in ids and kept.columns == docs.columns


def test_first_of_group_keeps_rows_without_id_and_one_of_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, 5, "a", True, 0), (1, text, 4, "b", True, 0), (2, text, 1, "c", True, 0), (3, "another text", 1, "d", True, 0),
            (3, "and one more of the same id", 1, "e", True, 0), (None, text, 1, "f", True, 0), (None, text, 1, "f", True, 0),
            (None, None, 1, "g", True, 0), (4, None, 1, "h", True, 0), (4, None, 1, "h", True, 0)]
    names = "doc_id long, text string, _id int, rows string, later boolean, _row int"
    kept = [
        sorted(map(str, jaccard.first_of_group(spark.createDataFrame(some, names), k=5, num=80).collect()))
        for some in (rows, rows[::-1])
    ]
    assert kept[0] == kept[1]
    assert sorted(re.search("rows='(.)'", r)[1] for r in kept[0])[-6:] == ["d", "e", "f", "f", "g", "h"]
    assert len(kept[0]) == 7


def test_passages_that_many_share_join_no_families(spark, monkeypatch):
    """Families stay as small as the links make them, however many texts share a long passage."""
    rng = random.Random(9)
    passage = sentence(rng, 120)
    texts = [f"{passage} {sentence(rng, 60)}" for _ in range(60)]
    near = [texts[0] + " end", texts[0] + " other end", *(f"{t} x" for t in texts[1:4])]
    made = spark.createDataFrame(list(enumerate([*texts, *near])), "doc_id long, text string")
    pairs = []
    plain = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda edges: pairs.append(edges.count()) or plain(edges))
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(made, 5, 80, 100).collect()}
    assert {i for i, c in got.items() if i != c} == {60, 61, 62, 63, 64}
    assert pairs[0] <= 10


def test_tree_finds_all_links():
    rng = np.random.default_rng(4)
    for _ in range(60):
        base = [np.unique(rng.integers(0, 60, rng.integers(5, 40))).astype(np.uint64) for _ in range(3)]
        sets = [np.setdiff1d(b, rng.choice(b, rng.integers(0, 3))) for b in base for _ in range(5)]
        sets = [s for s in sets if len(s)]
        parent = list(range(len(sets)))
        find = lambda i: i if parent[i] == i else find(parent[i])  # noqa: B023, E731
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if 10 * len(np.intersect1d(x, y)) >= 8 * len(np.union1d(x, y)):
                    parent[find(i)] = find(j)
        want = [find(i) for i in range(len(sets))]
        parent = list(range(len(sets)))
        for i, j in jaccard.join_family(sets, [-1] * len(sets), 8, 10):
            parent[find(i)] = find(j)
        got = [find(i) for i in range(len(sets))]
        same = lambda p: {frozenset(np.flatnonzero(np.array(p) == v).tolist()) for v in p}
        assert same(got) == same(want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (300, 200), (7, 7), (5, 5), (50, 51), (51, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 200: 100, 300: 100, 50: 50, 51: 50}


# --- 6


def naive_repeats(rows):
    order = [(float("inf") if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for i, b in order:
        for j in range(len(b) - 49):
            w = b[j : j + 50]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, b in order:
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if least[b[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 3}, {"block_rows": 5}])
def test_repeats(docs, none, rows, limits):
    got = repeats.without_repeats(docs, **limits).drop("row", "kept").collect()
    assert sorted(map(tuple, got)) == naive_repeats(rows)
    cut = repeats.cut_repeats(docs, **limits)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert cut.filter("text IS NULL").count() == sum(r[1] is None for r in rows)
    assert repeats.without_repeats(none).count() == 0


def test_names_are_shuffled_once_and_packed(spark, monkeypatch):
    """One pass over the texts names them; its rows are shares of many names, not single names."""
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, 7))) for _ in range(300)]
    passage = " ".join(words[:40])
    texts = [" ".join(rng.choice(words, 60)) + passage * (i % 3 > 0) for i in range(60)]
    rows = [(i // 2 if i % 7 else None, t) for i, t in enumerate([*texts, *texts[:5], "", None, "short"])]
    plans, real = {}, repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, name: plans.setdefault(name, df) and real(df, name))
    monkeypatch.setattr(repeats, "_PACK", 200)  # many packs, so that names are told and judged across them
    own = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.without_repeats(own).drop("row", "kept").collect()
    assert sorted(map(tuple, got)) == naive_repeats(rows)
    plan = plans["repeat-claims"]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [share" in plan and plan.count("MapInArrow") == 2
    assert "repeat-names" not in plans and "Generate" not in plan


def test_packed_shares_keep_all_and_hold_few_of_frequent_names():
    rng = np.random.default_rng(6)
    rows = rng.integers(0, 1 << 62, (5, 4000)).astype(np.uint64)
    rows[0] = np.uint64(1 << 60) * (rows[0] % np.uint64(9))  # equal hashes, also with other checksums
    rows[1] %= np.uint64(2)
    rows[2] %= np.uint64(500)
    held, known = [], []
    for _, unsure, sure in repeats.packed_shares(rows, 16):
        held += map(tuple, repeats._from_planes(unsure).T.tolist())
        known += map(tuple, repeats._from_planes(sure).T.tolist())
    assert sorted(held + known) == sorted(map(tuple, rows.T.tolist()))
    least = {}
    for h, second, i, *_ in map(tuple, rows.T.tolist()):
        least[h, second] = min(least.get((h, second), i), i)
    assert all(r[2] > least[r[:2]] for r in known) and len(held) < 100


def test_runs_are_the_windows_by_their_least_seed():
    rng = np.random.default_rng(7)
    for letters, some in ((1, 1 << 16), (2, 1 << 16), (26, 1 << 16), (26, 64)):
        sizes = rng.choice([0, 1, 49, 50, 51, 76, 77, 300], 12)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        raw = rng.integers(97, 97 + letters, begin[-1]).astype(np.uint8)
        whole = repeats.seeds(raw)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(repeats, "_SOME", some)
            assert (repeats.seeds(raw) == whole).all()
            first, count, place, h, owner = repeats.runs(raw, begin)
        low = np.uint64(len(whole).bit_length())
        want = []
        for t, (b, e) in enumerate(zip(begin, begin[1:], strict=False)):
            for w in range(b, e - repeats.LENGTH + 1):
                at = min(range(w, w + repeats.LENGTH - repeats.SEED + 1), key=lambda p: (int(whole[p] >> low), p))
                want.append((w, at, int(whole[at]), t))
        got = [(f + k, p, int(x), t) for f, c, p, x, t in zip(first, count, place, h, owner, strict=True) for k in range(c)]
        assert got == want


def test_cuts_take_whole_characters_and_leave_others(spark):
    passage = "été 日本 " * 12
    texts = [f"a\ufffdb {passage}", f"\ufffd zé{passage}日x \ufffd", "no cut \ufffd here"]
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.text for r in repeats.cut_repeats(own).collect()}
    assert (left[0], left[2]) == (texts[0], texts[2])
    assert left[1].startswith("\ufffd z") and left[1].endswith("日x \ufffd") and len(left[1]) < 20


def test_cover_is_a_difference_cover():
    found = {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER}
    assert found == set(range(repeats.PERIOD))


# --- 7


def test_token_files(spark, docs, none, rows, tokenizer):
    catalog = token_files.write_token_files(docs, new_path(spark, "test-tokens"), TOKENIZER, 2, shard_bytes=1 << 16)
    got = token_files.read_token_files(catalog).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    want = Counter((r[0], len(ids_of(tokenizer, r[1], 2)), zlib.crc32(ids_of(tokenizer, r[1], 2).tobytes())) for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    empty = token_files.write_token_files(none, new_path(spark, "test-tokens"), TOKENIZER, 2)
    assert token_files.read_token_files(empty).count() == 0


def test_perfect_hash():
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    table = token_files.PerfectHash.build(h)
    assert sorted(table.slots(h).tolist()) == list(range(5000))
    with pytest.raises(ValueError, match="same hash"):
        token_files.PerfectHash.build(np.array([3, 3], np.uint64))


# --- 8


def test_shards(docs, none, rows):
    got = shards.balanced_shards(docs, shards=4).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    place = {}
    for r in got:
        assert place.setdefault(r.text_crc32, r.shard) == r.shard
    for s in range(4):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    assert shards.balanced_shards(none).count() == 0


def test_differencing_is_even():
    rng = random.Random(9)
    sizes = [rng.randint(1, 5000) for _ in range(800)]
    labels = shards.difference([[s] for s in sizes], 16)
    total = Counter()
    for s, (k,) in zip(sizes, labels, strict=True):
        total[k] += s
    assert max(total.values()) - min(total.values()) <= 2
    parts = [[rng.randint(0, 99) for _ in range(4)] for _ in range(9)]
    assert all(sorted(x) == [0, 1, 2, 3] for x in shards.difference(parts, 4))


# --- 9


def test_segments_are_maximal():
    weights = toxicity.Weights({"bad": 3.0, "foul": 1.0})
    own = ["ok", "bad", "ok", "foul", *["ok"] * 30, "foul", "bad"]
    assert toxicity.segments(own, weights) == [(1, 4, 3.75), (34, 36, 4.0)]
    assert toxicity.segments([], weights) == []
    rate = toxicity.decay([2.0], [0.01])
    assert abs(0.01 * np.exp(rate * 2) + 0.99 * np.exp(-rate * toxicity.COST) - 1) < 1e-6


def test_toxicity_edges(spark, docs, none, labels, rows):
    model = toxicity.fitted(docs, labels, "doc_id", "text", 50)
    got = toxicity.toxicity_scores(docs, model, spans=True).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    unknown = toxicity.fitted(docs, labels.limit(0), "doc_id", "text", 50)
    assert {r.score for r in toxicity.toxicity_scores(docs, unknown).collect()} == {0.0}
    assert toxicity.toxicity_scores(none, model).count() == 0


# --- 10


def test_marginals_are_sums_over_labellings():
    rng = np.random.default_rng(3)
    good, move, begin = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([0, 4, 4, 7])
    got, pairs, normal = quality_crf.marginals(good, move, begin)
    want, want_pairs = np.zeros(7), np.zeros((2, 2))
    for d, (a, b) in enumerate([(0, 4), (4, 4), (4, 7)]):
        n, z = b - a, 0.0
        each = []
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            p = np.exp(sum(good[a + i] for i in range(n) if y[i]) + sum(move[y[i], y[i + 1]] for i in range(n - 1)))
            each.append((y, p))
            z += p
        for y, p in each:
            want[a:b] += np.array(y) * p / z
            for u, v in zip(y, y[1:], strict=False):
                want_pairs[u, v] += p / z
        if n:
            assert abs(normal[d] - np.log(z)) < 1e-9
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_quality_edges(docs, none, labels, rows):
    field = quality_crf.fitted_field(docs, labels, "doc_id", "text", 50)
    got = quality_crf.quality_scores(docs, field).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    texts = {r[0]: r[1] for r in rows}
    assert all(r.score == 0 and r.n_lines == 0 for r in got if not words_of(texts[r.doc_id]))
    plain = quality_crf.fitted_field(docs, labels.limit(0), "doc_id", "text", 50)
    assert {round(r.score, 6) for r in quality_crf.quality_scores(docs, plain).collect()} == {0.0, 0.5}
    assert quality_crf.quality_scores(none, field).count() == 0


def test_all_lines_are_fitted(spark, monkeypatch):
    texts = {1: "a clean line of words\n" * 130 + "###!! $$ %%\n" * 70, 2: "good words here\n" * 40}
    own = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    known = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    monkeypatch.setattr(quality_crf, "fit_field", lambda documents, shares: documents)
    fitted = quality_crf.fitted_field(own, known, "doc_id", "text", 50)
    assert [(label, f.shape, len(size)) for label, f, size in fitted] == [(0, (200, 12), 200), (1, (40, 12), 40)]


@pytest.mark.parametrize("name", ["op9_toxicity", "op10_quality", "op1_language"])
def test_held_out(spark, name):
    from tallyroll.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf).filter("held_out")
    if name == "op1_language":
        pairs = got.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
        right = pairs.filter("lang IS NOT NULL").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    else:
        column = "toxic" if "tox" in name else "quality"
        pairs = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
        right = pairs.select(F.avg((F.col(column) == F.col("predicted")).cast("int")))
    assert right.first()[0] > (0.85 if name == "op9_toxicity" else 0.95)


def test_shingles_are_shuffled_once(spark, monkeypatch):
    """Each share of the shingles is counted where it arrives, without a join back to the sets."""
    from tallyroll.llm import jaccard as module

    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(module, "stored", seen)
    rows = [(1, "a b c d e"), (2, "a b c d f"), (3, "a b c d e"), (4, "x y z"), (5, None)]
    docs = spark.createDataFrame(rows, "id long, text string").select("text")
    first = sorted((r.n, len(r.first)) for r in module._first_shingles(docs, 3, 50, 100, 2).collect())
    assert first == [(3, 1), (3, 2)]
    assert len(plans) == 2
    assert all(p.count("MapInArrow") == 1 and "Join" not in p for p in plans)
