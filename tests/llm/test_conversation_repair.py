"""Conversation repair against a search over all edits."""

import hashlib
import itertools
import random
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tallyroll.llm import conversation_repair as repair

sys.setrecursionlimit(20_000)
VISIBLE = " \t\n\v\f\r"


def cheapest(codes, most_inserts=4):
    """(cost, audit) by trying every edit from every state of the grammar."""

    @lru_cache(None)
    def go(i, state, inserts):
        found = [(0, "")] if i == len(codes) and state in ("", "a") else []
        step = "a" if state == "u" else "u"
        if inserts < most_inserts:
            found.append((2, "I", *go(i, step, inserts + 1)))
        if i < len(codes):
            found.append((3, "D", *go(i + 1, state, 0)))
            own, cut = codes[i].lower(), codes[i].isupper()
            for to in (step, "s") if state == "" else (step,):
                if own == to:
                    found.append((cut, "K", *go(i + 1, to, 0)))
                elif own != "d" and to != "s":
                    found.append((2 + cut, "R", *go(i + 1, to, 0)))
        flat = [(f[0] + (f[2] if len(f) > 2 else 0), f[1] + (f[3] if len(f) > 2 else "")) for f in found]
        return min(flat, default=(1 << 60, ""))

    return go(0, "", 0)


def by_operator(codes, segment):
    own = repair.Repair(segment=segment)
    for i, c in enumerate(codes):
        role = {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool")
        fault = "truncated" if c.isupper() else "blank" if c == "d" else None
        own.add(i, role, f"t{i}", fault)
    out = own.done()
    return out["cost"], out["audit"]


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_every_short_conversation(segment):
    for n in range(5 if segment > 2 else 4):
        for codes in itertools.product("suaodSUAO", repeat=n):
            codes = "".join(codes)
            assert by_operator(codes, segment) == cheapest(codes), codes


@pytest.mark.parametrize("segment", [5, 64, 1000])
def test_long_conversations(segment):
    rng = random.Random(segment)
    for weights in ((1, 4, 4, 1, 1, 0, 1, 1), (0, 1, 0, 0, 0, 0, 0, 0), (0, 0, 3, 1, 0, 0, 0, 1), (0, 0, 0, 0, 1, 0, 0, 0)):
        for n in (9, 40, 150):
            codes = "".join(rng.choices("suaodSUA", weights, k=n))
            assert by_operator(codes, segment) == cheapest(codes), codes


def test_band_bounds_the_table():
    assert repair.align("uaua", "ua", 5, True) is None
    assert repair.align("uaua", "ua", 6, True) == (6, "DDKK")
    assert repair.align("", "ua", 4, False) is None and repair.align("", "ua", 4, True) == (4, "II")


def expected(rows):
    """The contract, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        made = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            shown = [" " if v is None else str(v) for v in (conv, turn)]
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(":".join(shown).encode()) % 20
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            role = "user" if kind == 4 else role
            made += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        codes, counts, seen = "", {"blank": 0, "duplicate": 0, "truncated": 0}, set()
        for _, role, text in made:
            code, end = role[:1] if role[:1] in ("s", "u", "a") else "o", text.rstrip(VISIBLE)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
                code = code.upper() if fault == "truncated" else "d"
            codes += code
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(made))
        turns = [t for t, *_ in made if t is not None]
        cost, audit = cheapest(codes)
        lines, at, state = [], 0, ""
        for edit in audit:
            role, text = (made[at][1:] if edit != "I" else ("", ""))
            at += edit != "I"
            if edit == "D":
                continue
            state = "s" if edit == "K" and role[:1] == "s" else "a" if state == "u" else "u"
            lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = ["Well.", "So? ", "cut off", "", " \n", "Same!", "é…", "Long " * 30_000 + "end.", None]
    out = []
    for conv in [*range(150), None]:
        turns = [t if rng.random() > 0.05 else None for t in range(rng.randint(1, 9)) if rng.random() > 0.1]
        out += [(conv, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(texts)) for t in turns]
    hot = [(7000, t, ["user", "assistant"][t % 2], f"Turn {t}." if t % 9 else f"open {t}") for t in range(600) if t % 41]
    return out + hot + out[:7] + [out[0]]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_result(spark, rows):
    found = repair.repaired(repair.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3)), present=F.col("present"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == ["conv_id", *names]
    got = found.collect()
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(repair.damaged(none), present=F.col("present")).count() == 0
    odd = "id string, present string, same int, turn int, role string, text string, fault string, again string, key string"
    clash = spark.createDataFrame([("a", "p", 1, 1, "user", "x.", "f", "g", "k"), ("a", "p", 1, 2, "assistant", "y", "f", "g", "k")], odd)
    (row,) = repair.repaired(clash, id_col="key", with_turns=True).collect()
    assert (row.key, row.cost, row.audit) == ("k", 1, "KK")
    assert [tuple(t) for t in row.turns] == [("user", "x."), ("assistant", "y")]
    gone = spark.createDataFrame([(1, 1, "user", "x.")], SCHEMA)
    (row,) = repair.repaired(gone, present=F.lit(False)).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
