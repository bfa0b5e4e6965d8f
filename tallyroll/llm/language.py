"""Language identification by cross-parsing entropy.

For each language some labelled text is turned into a suffix automaton, which follows any
substring of that text. A document is cut greedily into the longest phrases that occur in the
labelled text; few phrases mean that it is like that text. The language with the lowest
phrases * log2(labelled characters) / characters wins.

Letters are lower-cased, everything else counts as one space, and runs of it as one. A document
is parsed in blocks of `BLOCK` characters (a phrase ends with its block), all blocks of a batch
and all languages at once, one character a step.

Defined cases. Text null or without any letter: `und`, score 0. Ties: the first language in
alphabetical order. Repeated rows: each is judged. No labelled rows: all `und`. Empty table:
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.encoding import text_chunks
from tallyroll.llm.shared import bounded_ids, learning_share, to_arrow

BLOCK = 512
#: Symbols: 0 is the space, 1 any letter that isn't among the learned ones.
SYMBOLS = 64


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a text; state 0 is the empty string."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
        last = new
    return step


class Parser:
    """Phrase counts of many texts against labelled texts, one for each language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = Counter(c for s in samples.values() for c in s.lower() if c.isalpha() and len(c) == 1)
        common = sorted(letters, key=lambda c: (-letters[c], c))[: SYMBOLS - 2]
        self.symbol = np.zeros(0x110000, np.uint8)
        self.symbol[[i for i in range(0x110000) if chr(i).isalpha()]] = 1
        for i, c in enumerate(common):
            self.symbol[ord(c)] = i + 2
            if len(c.upper()) == 1:
                self.symbol[ord(c.upper())] = i + 2
        tables, self.start, self.bits, rows = [], [], [], 0
        for language in self.languages:
            text = self.symbols([samples[language]])[0]
            step = automaton(text.tolist())
            # value: twice the next state's row begin, plus 1 where a new phrase begins. The
            # row after the last state is the one before any phrase.
            base, outside = rows * SYMBOLS, (rows + len(step)) * SYMBOLS
            first = np.full(SYMBOLS, 2 * outside + 1, np.int32)
            for c, to in step[0].items():
                first[c] = 2 * (base + to * SYMBOLS) + 1
            table = np.tile(first, (len(step) + 1, 1))
            for state, edges in enumerate(step[1:], 1):
                for c, to in edges.items():
                    table[state, c] = 2 * (base + to * SYMBOLS)
            tables.append(table.ravel())
            self.start.append(outside)
            self.bits.append(np.log2(max(2, len(text))))
            rows += len(step) + 1
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts in a row, each text's begin (and the end), and its letters."""
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.symbol[codes]
        keep = symbols > 0
        letters = np.concatenate([[0], np.cumsum(keep)])
        keep[1:] |= symbols[:-1] > 0
        ends = np.cumsum([len(t) + 1 for t in texts])
        begins = ends - [len(t) + 1 for t in texts]
        if len(begins):
            keep[begins] = symbols[begins] > 0
        upto = np.concatenate([[0], np.cumsum(keep)])
        return symbols[keep], np.append(upto[begins], upto[-1]), letters[ends] - letters[begins]

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (languages by texts), symbols and letters of each text."""
        symbols, begin, letters = self.symbols(texts)
        size = np.diff(begin)
        n_blocks = -(-size // BLOCK)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        at = begin[owner] + within * BLOCK
        length = np.minimum(size[owner] - within * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        active = len(at) - np.searchsorted(length[::-1], np.arange(BLOCK), side="right")
        state = np.repeat(np.array(self.start, np.int32)[:, None], len(at), axis=1)
        phrases = np.zeros((len(self.languages), len(at)), np.int32)
        for t in range(int(length[0]) if len(length) else 0):
            k = active[t]
            value = self.table.take(state[:, :k] + symbols[at[:k] + t])
            phrases[:, :k] += value & 1
            state[:, :k] = value >> 1
        total = np.zeros((len(self.languages), len(texts)), np.int64)
        for i in range(len(self.languages)):
            total[i] = np.bincount(owner[order], phrases[i], len(texts))
        return total, size, letters

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        phrases, size, letters = self.parse(texts)
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        entropy = phrases * np.array(self.bits)[:, None] / np.maximum(size, 1)
        best = entropy.argmin(axis=0)
        first = np.sort(entropy, axis=0)
        second = first[1] if len(first) > 1 else np.full(len(texts), np.inf)
        score = np.where(np.isinf(second), 1.0, second / np.maximum(first[0] + second, 1e-12))
        known = letters > 0
        names = [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0).tolist()


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(samples))


def labelled_text(
    learn: DataFrame, id_col: str, text_col: str, lang_col: str, documents: int, characters: int
) -> tuple[tuple[str, str], ...]:
    """For each language, a passage of up to `characters` from each of up to `documents`
    documents chosen by hash: the bounded sample that the automata are made of."""
    known = learn.filter(F.col(lang_col).isNotNull())
    chosen = bounded_ids(known, id_col, [lang_col], documents)
    begin = F.pmod(F.xxhash64(text_col), F.greatest(F.length(text_col) - characters, F.lit(1))) + 1
    rows = (
        known.select(id_col, text_col, lang_col)
        .join(F.broadcast(chosen), [id_col, lang_col])
        .filter(F.length(text_col) > 0)
        .select(lang_col, F.substring(text_col, begin.cast("int"), F.lit(characters)).alias("passage"))
        .distinct()
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for r in sorted(rows):
        if len(texts.setdefault(r[0], [])) < documents:
            texts[r[0]].append(r[1])
    return tuple(sorted((lang, " ".join(own)) for lang, own in texts.items()))


def languages(
    docs: DataFrame,
    learn: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_documents: int = 128,
    sample_characters: int = 256,
) -> DataFrame:
    """(id, lang_pred, score) of every row of `docs`, learned from `learn`."""
    samples = labelled_text(learn, id_col, text_col, lang_col, sample_documents, sample_characters)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, lang_pred string, score double"
    arrow = to_arrow(docs.sparkSession.createDataFrame([], schema))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(samples)
        for batch in batches:
            for some in text_chunks(batch, "text", 1 << 21):
                texts = some.column("text").to_pylist()
                names, scores = own.predict([t or "" for t in texts])
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(names), pa.array(scores)], schema=arrow)

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(judge, schema).withColumnRenamed("id", id_col)


def language(spark, sf_dir: str) -> DataFrame:
    """Query op1: the language of every document, learned from four fifths of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = docs.filter(~learning_share("doc_id", 5, 0))
    found = languages(docs, learn)
    return found.select("doc_id", learning_share("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")
