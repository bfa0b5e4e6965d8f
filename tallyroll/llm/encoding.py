"""Fast exact encoding with a BPE tokenizer file, whole Arrow columns at a time.

A BPE tokenizer first cuts a text at its pattern and then encodes each piece on its own. The
cuts follow from the classes of neighbouring characters, so they are found for a column of
texts at once; pieces are encoded by the tokenizers library when first met and remembered, and
a text is its pieces' ids joined.

Two patterns are known: that of byte-level tokenizers (a space goes to the piece behind it), and
that of word tokenizers which drop white space and normalise. In the latter, words with other
than ASCII characters go to the library whole. Texts that hold one of the tokenizer's added
tokens, and all texts of other tokenizers, go to the library as they are.

Defined cases: null and empty texts have no ids; texts of any length are encoded whole.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyroll.llm.shingles import text_bytes

#: Pieces in one call of the library.
_CALL = 1000
#: Classes of characters; white space other than the space, and the space, come last.
_UNKNOWN, _LETTER, _NUMBER, _OTHER, _WHITE, _SPACE = range(6)
_ASCII = np.full(128, _OTHER, np.uint8)
_ASCII[[*range(65, 91), *range(97, 123)]] = _LETTER
_ASCII[48:58] = _NUMBER
_ASCII[9:14] = _WHITE
_ASCII[32] = _SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What follows an apostrophe in a piece of its own (fixed values of both patterns).
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_characters() -> dict[int, str]:
    """Byte to the visible character that stands for it in byte-level vocabularies: printable
    bytes stand for themselves, the others follow from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _starts(points: np.ndarray, kind: np.ndarray, begin: np.ndarray, spaces_lead: bool) -> np.ndarray:
    """Marks of the first character of each piece, white space included. `begin` holds the
    places where texts begin; pieces don't cross them."""
    white = kind >= _WHITE
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    before[begin] = 0
    was_white = before >= _WHITE
    mark = kind != before
    mark &= ~(white & was_white)
    if spaces_lead:
        mark &= white | (before != _SPACE)
        after = np.zeros_like(kind)
        after[:-1] = kind[1:]
        after[begin[begin > 0] - 1] = 0
        # the last of several white characters leads or stands alone
        mark |= white & was_white & (after > 0) & (after < _WHITE)
    else:
        mark |= kind == _NUMBER
    mark[begin] = True
    first = np.zeros(len(kind) + 3, bool)
    first[begin] = True
    first[len(kind) :] = True
    for at in np.flatnonzero((points == 39) & mark).tolist():
        for ending in _ENDINGS:
            end = at + 1 + len(ending)
            if not first[at + 1 : end].any() and all(points[at + 1 + i] == ord(c) for i, c in enumerate(ending)):
                mark[at + 1 : end] = False
                mark[end : end + 1] = True
                break
    return mark


class Encoder:
    """Memory is bounded: beyond `most_pieces` the pieces met last are forgotten, down to half;
    the older half has the frequent ones, which come early."""

    def __init__(self, path: str, most_pieces: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)
        #: The library finds these anywhere, also inside words.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = "<u4" if wide else "<u2"
        self.characters = _byte_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        ending = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        #: Characters of each token, without the mark of a word's end.
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token.removesuffix(ending))
        self.pattern = self._known_pattern(path)
        self.classes = np.zeros(0x110000, np.uint8)
        self.classes[:128] = _ASCII
        self.most = most_pieces
        self._forget(0)

    def _known_pattern(self, path: str) -> str | None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut, normal = spec["pre_tokenizer"], spec["normalizer"]
        if spec["model"].get("ignore_merges") or spec["post_processor"] or not cut:
            return None
        plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        if plain and normal is None:
            return "byte"
        words = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        inner = cut.get("pretokenizers", [])
        if len(inner) == 2 and inner[0].get("pattern") == {"Regex": words} and inner[0]["invert"]:
            steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
            if steps == ["NFC", "Replace", "Lowercase"] and not inner[1]["add_prefix_space"]:
                return "word"
        return None

    def _forget(self, keep: int) -> None:
        if keep:
            self.numbers = dict(list(self.numbers.items())[:keep])
            self.first = self.first[: keep + 1]
            self.flat = self.flat[: self.first[-1]]
        else:
            self.numbers: dict[bytes, int] = {}
            self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, self.dtype)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin, with the end."""
        column = column.cast(pa.large_string()).fill_null("")
        whole = np.full(len(column), self.pattern is None)
        for token in self.added:
            whole |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_pieces(column)
        rest = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), column)
        ids, begin = self._by_pieces(rest)
        parts = [ids[begin[i] : begin[i + 1]] for i in range(len(column))]
        for i in np.flatnonzero(whole).tolist():
            parts[i] = np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, self.dtype)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_column(pa.array([text], pa.string()))[0]

    def _by_pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, begin = text_bytes(column)
        if not len(raw):
            return np.zeros(0, self.dtype), np.zeros(len(column) + 1, np.int64)
        raw, starts = self._cut_words(raw, begin) if self.pattern == "word" else self._cut_bytes(raw, begin)
        ends = np.append(starts, len(raw)).astype(np.int64)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))]
        ).dictionary_encode()
        if len(self.numbers) > self.most:
            self._forget(self.most // 2)
        number = self._numbered(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        size = self.first[number + 1] - self.first[number]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        at = np.repeat(self.first[number] - upto[:-1], size) + np.arange(upto[-1])
        return self.flat[at], upto[np.searchsorted(starts, begin)]

    def _cut_bytes(self, raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = begin[begin < len(raw)]
        if raw.max() < 128:
            return raw, np.flatnonzero(_starts(raw, _ASCII[raw], begin, True))
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
        kind = self.classes[points]
        if not kind.all():
            for point in np.unique(points[kind == _UNKNOWN]).tolist():
                self.classes[point] = self._class_of(chr(point))
            kind = self.classes[points]
        place = np.flatnonzero((raw & 0xC0) != 0x80)
        return raw, place[_starts(points, kind, np.searchsorted(place, begin), True)]

    def _class_of(self, character: str) -> int:
        """The class that the tokenizer's own pattern gives a character."""
        for kind, same in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
            if len(self.tokenizer.pre_tokenizer.pre_tokenize_str(same + character)) == 1:
                return kind
        return _WHITE

    def _cut_words(self, raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = begin[begin < len(raw)]
        lower = _LOWER[raw]
        high = raw >= 128
        if not high.any():
            return lower, np.flatnonzero(_starts(lower, _ASCII[lower], begin, False))
        kind = _ASCII[lower & 127]
        kind[high] = _LETTER
        mark = _starts(lower, kind, begin, False)
        # words with a byte from 128 on stay whole, as they are
        edge = (kind >= _WHITE) != np.append(True, kind[:-1] >= _WHITE)
        edge[begin] = True
        stretch = np.flatnonzero(edge)
        odd = np.repeat(np.maximum.reduceat(raw, stretch) >= 128, np.diff(np.append(stretch, len(raw))))
        lower[odd] = raw[odd]
        mark[odd] = edge[odd]
        return lower, np.flatnonzero(mark)

    def _numbered(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of pieces, after learning the ids of those not met before."""
        get = self.numbers.get
        out = np.fromiter((get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(out < 0).tolist()
        if new:
            own = self._learned([pieces[i] for i in new])
            known = len(self.numbers)
            out[new] = np.arange(known, known + len(new))
            self.numbers.update((pieces[i], known + k) for k, i in enumerate(new))
            ends = self.first[-1] + np.cumsum([len(x) for x in own])
            self.first = np.concatenate([self.first, ends])
            self.flat = np.concatenate([self.flat, *own]).astype(self.dtype, copy=False)
        return out

    def _learned(self, pieces: list[bytes]) -> list[np.ndarray]:
        out = [np.zeros(0, self.dtype)] * len(pieces)
        inner, odd = range(len(pieces)), []
        if self.pattern == "word":
            odd = [i for i, p in enumerate(pieces) if not p.isascii()]
            inner = [i for i, p in enumerate(pieces) if p.isascii() and not p.isspace()]
        texts = [pieces[i].decode() for i in odd]
        for i, e in zip(odd, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, self.dtype)
        shown = [pieces[i].decode("latin1").translate(self.characters) for i in inner]
        calls = [shown[i : i + _CALL] for i in range(0, len(shown), _CALL)]
        for k, e in enumerate(self.bare.encode_batch_fast(calls, is_pretokenized=True, add_special_tokens=False)):
            # tokens don't cross pieces, so a piece ends where as many characters have passed
            ids = np.array(e.ids, self.dtype)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(p) for p in calls[k]])) + 1
            at = 0
            for i, end in zip(inner[k * _CALL :], ends.tolist(), strict=False):
                out[i], at = ids[at:end], end
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker and tokenizer file."""
    return Encoder(path)


def with_end(ids: np.ndarray, begin: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of `encode_column` with `end_id` behind each text's, and where each begins."""
    n = len(begin) - 1
    out = np.full(len(ids) + n, end_id, ids.dtype)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(begin))] = ids
    return out, begin + np.arange(n + 1)


def binary_column(ids: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Each stretch of ids as little-endian bytes."""
    offsets = (begin * ids.itemsize).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
    ).cast(pa.binary())


def text_chunks(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `most` bytes (or one row)."""
    texts = batch.column(column).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, bisect.bisect_right(offsets, offsets[at] + most) - 1)
        yield batch.slice(at, end - at)
        at = end
