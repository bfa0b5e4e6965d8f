"""Repair of conversations by alignment with the grammar `(s?(ua)+)?` of role initials.

The turns of a conversation are aligned (Wagner and Fischer) with the alternating string of
every length that can still win: kept as they are, given another role, deleted or filled up with
empty turns. The best cost so far bounds the deletions and insertions of the next alignment
(Ukkonen's band). Each table is traced back to its ASCII-least audit, and audits of equal cost
are compared.

Turns are read as a stream in order. Whenever `SEGMENT` turns are there and another follows,
they are aligned from each state the grammar can be in before them, to each state behind them,
and the best audit per state is carried on, with the checksum of what it repaired. An insertion
belongs to the turn behind it, so that segments have no edit in common. Two audits of equal cost
over the same turns are never one a beginning of the other, so the least whole audit is made of
least parts and the result is that of one alignment. A task holds a segment and the audits,
never a conversation's texts.

Defined cases. Null roles and texts: one space. Turns: ascending, nulls first; ties go by role,
then text. Equal rows at one turn: all after the first are duplicates. A null conversation id
is a conversation like others. Texts of any length are hashed whole. Empty table: no rows. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.llm.shared import partitions_for, to_arrow

#: Turns that are aligned at once; longer conversations are streamed in so many at a time.
SEGMENT = 64
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: White space that doesn't count as text.
_SPACES = " \t\n\v\f\r"
_NAMES = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60


def _alternating(first: str, length: int) -> str:
    other = {"u": "a", "a": "u"}[first]
    return ((first + other) * (length // 2 + 1))[:length]


def _turn_cost(code: str, target: str) -> int:
    """What it costs that a turn stands for `target`. A code is the turn's initial (`o` for any
    other), in upper case for a truncated turn, or `d` for one that has to go."""
    cut = TRUNCATED if code.isupper() else 0
    if code.lower() == target:
        return cut
    return _NEVER if target == "s" or code == "d" else REROLE + cut


def align(codes: str, target: str, most: int, trailing: bool) -> tuple[int, str] | None:
    """Cost and ASCII-least audit of the cheapest edits that turn the turns into `target`, if they
    cost at most `most`. Insertions behind the last turn are allowed where `trailing`."""
    n, m = len(codes), len(target)
    # deletions less insertions are n - m, which with the cost bounds both
    deletions = (most + 2 * (n - m)) // (DELETE + INSERT)
    insertions = deletions - (n - m)
    if deletions < 0 or insertions < 0:
        return None
    rest: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here, below = rest[i], rest[i + 1] if i < n else {}
        for j in range(min(m, i + insertions), max(0, i - deletions) - 1, -1):
            best = _NEVER
            if i == n and j == m:
                best = 0
            if i < n:
                best = DELETE + below.get(j, _NEVER)
                if j < m:
                    best = min(best, _turn_cost(codes[i], target[j]) + below.get(j + 1, _NEVER))
            if j < m and target[j] != "s" and (i < n or trailing):
                best = min(best, INSERT + here.get(j + 1, _NEVER))
            if best <= most:
                here[j] = best
    if 0 not in rest[0]:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = rest[i][j]
        turn = _turn_cost(codes[i], target[j]) if i < n and j < m else _NEVER
        if i < n and DELETE + rest[i + 1].get(j, _NEVER) == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and (i < n or trailing) and INSERT + rest[i].get(j + 1, _NEVER) == left:
            audit.append("I")
            j += 1
        else:
            assert turn + rest[i + 1].get(j + 1, _NEVER) == left
            audit.append("K" if codes[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def align_segment(codes: str, state: str, last: bool) -> tuple[tuple[str, int, str], ...]:
    """(state behind, cost, audit) for each state the grammar can be in behind these turns, from
    `state` before them. A state is the last initial, or empty at the beginning; only the states
    where the grammar may end count where the turns are the last."""
    n, keep = len(codes), sum(c != "d" for c in codes)
    nothing = align(codes, "", DELETE * n, last)
    best: dict[str, tuple[int, str]] = {}
    if not last or state in ("", "a"):
        best[state] = nothing

    def targets(length: int) -> Iterator[str]:
        yield _alternating("a" if state == "u" else "u", length)
        if state == "":
            yield "s" + _alternating("u", length - 1)

    def try_all(target: str, most: int) -> None:
        found = align(codes, target, min(most, best.get(target[-1], (most,))[0]), last)
        if found and (target[-1] not in best or found < best[target[-1]]):
            best[target[-1]] = found

    # Keeping all that may stay gives each state a first cost: at its own length, or a little more.
    stay = [c for c in codes if c != "d"]
    bound: dict[str, int] = {}
    for length in range(max(keep, 1), keep + 3):
        if n or last:
            target = next(targets(length))
            cost = DELETE * (n - keep) + INSERT * (length - keep)
            cost += sum(map(_turn_cost, stay, target[length - keep :]))
            bound[target[-1]] = min(cost, bound.get(target[-1], cost))
    if "s" in [c.lower() for c in stay]:
        bound["s"] = DELETE * (n - 1) + TRUNCATED
    if last:
        bound = {"a": bound["a"]}

    def limit() -> int:
        return max(best[s][0] if s in best and s != state else most for s, most in bound.items())

    # from the likeliest length outwards, until no length on that side can be as cheap
    for length, step in ((max(keep, 1), 1), (keep - 1, -1)):
        while bound and length > 0:
            gone = max(n - keep, n - length)
            if DELETE * gone + INSERT * (gone - (n - length)) > limit():
                break
            for target in targets(length):
                if target[-1] in bound:
                    try_all(target, bound[target[-1]])
            length += step
    return tuple((s, *found) for s, found in sorted(best.items()))


class _Best:
    """The best repair that ends in one state of the grammar."""

    __slots__ = ("cost", "audit", "sha", "turns", "n")

    def __init__(self, cost, audit, sha, turns, n):
        self.cost, self.audit, self.sha, self.turns, self.n = cost, audit, sha, turns, n


class Repair:
    """One conversation's turns, one after another, then `done`."""

    def __init__(self, with_turns: bool = False, segment: int = SEGMENT):
        self.segment, self.waiting = segment, []
        self.best = {"": _Best(0, "", hashlib.sha256(), [] if with_turns else None, 0)}
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.turns: list = []  # first, last, number of different ones

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if len(self.waiting) == self.segment:
            self._advance(False)
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = turn, self.turns[2] + 1
        code = initial if initial in ("s", "u", "a") else "o"
        if fault == "blank":
            self.blank, code = self.blank + 1, "d"
        elif fault == "duplicate":
            self.duplicate, code = self.duplicate + 1, "d"
        elif fault == "truncated":
            self.truncated, code = self.truncated + 1, code.upper()
        self.waiting.append((code, role, text))

    def _advance(self, last: bool) -> None:
        codes = "".join(code for code, _, _ in self.waiting)
        chosen: dict[str, tuple] = {}
        for state, own in self.best.items():
            for behind, cost, audit in align_segment(codes, state, last):
                offer = (own.cost + cost, own.audit + audit, state, audit)
                if behind not in chosen or offer < chosen[behind]:
                    chosen[behind] = offer
        self.best = {
            behind: self._applied(self.best[state], state, cost, whole, audit)
            for behind, (cost, whole, state, audit) in chosen.items()
        }
        self.waiting = []

    def _applied(self, own: _Best, state: str, cost: int, whole: str, audit: str) -> _Best:
        sha, n, at = own.sha.copy(), own.n, 0
        turns = None if own.turns is None else list(own.turns)
        for edit in audit:
            role = text = ""
            if edit != "I":
                code, role, text = self.waiting[at]
                at += 1
                if edit == "D":
                    continue
            state = "s" if edit == "K" and code.lower() == "s" else "a" if state == "u" else "u"
            if edit != "K":
                role = _NAMES[state]
            sha.update(f"{'\n' if n else ''}{role}:{text}".encode())
            n += 1
            if turns is not None:
                turns.append({"role": role, "text": text})
        return _Best(cost, whole, sha, turns, n)

    def done(self) -> dict:
        self._advance(True)
        best = min((self.best[s] for s in ("", "a") if s in self.best), key=lambda b: (b.cost, b.audit))
        first, latest, different = self.turns or (0, -1, 0)
        return {
            "gaps": latest - first + 1 - different,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": best.cost,
            "audit": best.audit,
            "repaired_sha256": best.sha.hexdigest(),
            "turns": best.turns,
        }


def faults(text: Column, again: Column) -> Column:
    """A turn's first fault, null where it has none. `again`: role and text were there before."""
    seen = F.rtrim(text, F.lit(_SPACES))
    return (
        F.when(seen == "", "blank")
        .when(again, "duplicate")
        .when(~F.right(seen, F.lit(1)).isin(".", "!", "?"), "truncated")
    )


def repaired(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    with_turns: bool = False,
    partition_bytes: int = 32 << 20,
) -> DataFrame:
    """One row a conversation: (id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), and the repaired `turns` (role, text) where asked for, which a task then
    holds whole. Where `present` is false, a row only says that its conversation exists.

    One shuffle, by conversation; duplicates are found by sorting the same partitions."""
    id_type = turns.schema[id_col].dataType.simpleString()
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    ).repartition(partitions_for(turns, partition_bytes), "id")
    same = F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"))
    earlier = Window.partitionBy("id", "present", "same").orderBy(F.col("turn").asc_nulls_first())
    judged = (
        rows.withColumn("same", same)
        .withColumn("again", F.row_number().over(earlier) > 1)
        .select("id", "turn", "role", "text", "present", "again", faults(F.col("text"), F.col("again")).alias("fault"))
    )
    order = ["id", F.col("turn").asc_nulls_first(), "role", "text", "again"]
    columns = f"id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    if with_turns:
        columns += ", turns array<struct<role: string, text: string>>"
    arrow = to_arrow(turns.sparkSession.createDataFrame([], columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, out = None, None, []
        for batch in batches:
            for c, turn, role, text, is_there, _, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if own is None or c != key:
                    if own is not None:
                        out.append({"id": key, **own.done()})
                    key, own = c, Repair(with_turns)
                if is_there:
                    own.add(turn, role, text, fault)
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if own is not None:
            out.append({"id": key, **own.done()})
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return judged.sortWithinPartitions(*order).mapInArrow(run, columns).withColumnRenamed("id", id_col)


def damaged(turns: DataFrame) -> DataFrame:
    """`conversations` with the contract's damage: rows by crc32(`conv_id:turn`) % 20 dropped
    (`present` false), emptied, without sentence ends, repeated, or given the role user."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.translate(shown("text"), ".!?", ""))
        .otherwise(shown("text"))
    )
    return (
        turns.select("conv_id", "turn", "role", "text", kind.alias("kind"))
        .withColumn("copy", F.explode(copies))
        .select(
            "conv_id", "turn", text.alias("text"),
            F.when(F.col("kind") == 4, "user").otherwise(shown("role")).alias("role"),
            (F.col("kind") != 0).alias("present"),
        )
    )


def conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Query op12: all conversations, damaged by their checksums and repaired."""
    turns = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repaired(turns, present=F.col("present"))
