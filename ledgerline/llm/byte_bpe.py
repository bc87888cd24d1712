"""Byte-level BPE by backtracking from longest matches.

A sequence of tokens is what the merges give if, and only if, each two neighbours are compatible: the merges leave
their joint bytes as these two tokens. So a piece is encoded from left to right with the longest token that fits its
predecessor; where none fits, the last token is taken back and a shorter one tried, and positions that failed are
not tried again. Work is linear in the bytes. Tokens are found by an Aho-Corasick automaton over bytes written as
Latin-1 characters; compatibility is remembered per pair.

Null text is empty and has no tokens; so has empty text. Special tokens are not known here: their strings are text.
Bytes that are not UTF-8 read as U+FFFD. Every row is encoded for itself; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import slices, utf8

_PAIRS = 1 << 16
#: Bytes of a generation of remembered words, of which there are two; an entry costs about ``_ENTRY`` bytes besides its own.
_GENERATION, _ENTRY, _LONGEST = 20 << 20, 250, 64
#: Bytes of texts, and a number of tokens, that are worked on at once.
_SLICE, _TOKENS = 1 << 20, 1 << 19
#: New words that the pattern is run over at once.
_NEW = 4096


class Codec:
    """Encoder and decoder of a rank file (one token in base64 and its rank per line) and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.by_rank = pa.array(map(self.tokens.get, range(max(ranks.values()) + 1)), pa.large_binary())
        self.split = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        self.left, self.right = (array("i", [-1]) * (max(ranks.values()) + 1) for _ in range(2))  # what a token is merged from
        for token, rank in ranks.items():
            parts = self._parts(token, 2)
            if len(parts) <= 2:  # others only stand for whole pieces
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
                if len(parts) == 2:
                    self.left[rank], self.right[rank] = map(ranks.__getitem__, parts)
        self.ordered = all(left < rank or len(self.tokens[left]) == 1 for half in (self.left, self.right)
                           for rank, left in enumerate(half) if left >= 0)
        self.automaton.make_automaton()
        numbers = range(max(ranks.values()) + 1)
        self.sizes = [len(self.tokens.get(rank, b"")) for rank in numbers]
        self.shorter = [self._shorter(self.tokens.get(rank, b"")) for rank in numbers]  # -1: there is none
        self.compatible = lru_cache(_PAIRS)(self._compatible)
        self.young: dict[str, bytes] = {}  # words that follow a blank
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _shorter(self, token: bytes) -> int:
        """The longest token that ``token`` begins with, of those that stand in sequences."""
        at = next((i for i in range(len(token) - 1, 0, -1) if token[:i].decode("latin-1") in self.automaton), 0)
        return self.ranks[token[:at]] if at else -1

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as file:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}, pattern)

    def _parts(self, data: bytes, least: int) -> list[bytes]:
        """The merges as defined, the adjacent pair of lowest rank first, until ``least`` parts are left."""
        parts, get, none = [data[i : i + 1] for i in range(len(data))], self.ranks.get, 1 << 60
        pairs = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while len(parts) > least and (rank := min(pairs)) != none:
            at = pairs.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], none)
        return parts

    def merged(self, data: bytes) -> list[int]:
        """Tokens by the merges as defined. For short bytes only."""
        return [self.ranks[p] for p in self._parts(data, 1)]

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens, the last one first: the two parts that meet in the middle must at no time have
        been the next to merge. Merges come in the order of their ranks, where no part has a higher rank than the whole."""
        tokens, get = self.tokens, self.ranks.get
        if not self.ordered:
            return self.merged(tokens[left] + tokens[right]) == [left, right]
        limit = 1 << 60
        while True:
            if get(tokens[left] + tokens[right], limit) < limit:
                return False
            made_left = left if self.left[left] >= 0 else -1  # a byte was always there
            made_right = right if self.left[right] >= 0 else -1
            if made_left > made_right:
                limit, left = left, self.right[left]
            elif made_right >= 0:
                limit, right = right + 1, self.left[right]  # of equal ranks the left one merges first
            else:
                return True

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        letters, compatible, sizes = data.decode("latin-1"), self.compatible, self.sizes
        longest = [rank for _, (_, rank) in self.automaton.iter_long(letters)]
        fits = [*map(compatible, longest, longest[1:])]
        if False not in fits:
            return longest  # nothing to take back
        found = longest[: fits.index(False) + 1]
        at, end, shorter, match = sum(map(sizes.__getitem__, found)), len(data), self.shorter, self.automaton.iter_long
        closed: set[int] = set()
        rank = shorter[longest[len(found)]]  # the longest one does not fit
        while True:
            if found:
                last = found[-1]
                while rank >= 0 and (at + sizes[rank] in closed or not compatible(last, rank)):
                    rank = shorter[rank]
            else:
                while rank >= 0 and at + sizes[rank] in closed:
                    rank = shorter[rank]
            if rank >= 0:
                found.append(rank)
                at += sizes[rank]
                if at == end:
                    return found
                rank = next(match(letters, at))[1][1]
            else:
                closed.add(at)
                last = found.pop()
                at -= sizes[last]
                rank = shorter[last]

    def _split(self, text: str) -> bytes:
        return b"".join([array("i", self.piece(part.encode("utf-8", "replace"))).tobytes() for part in self.split(text)])

    def _word(self, word: str) -> bytes:
        """Tokens of a blank and a word after it. Words are remembered up to a number of bytes; when it is reached, those
        not met again since it was reached before are forgotten."""
        ids = self.young.get(word)
        if ids is not None:
            return ids
        ids = self.old.get(word)
        if ids is None:
            first, *more = self.split(" " + word)
            ids = array("i", self.piece(first.encode("utf-8", "replace"))).tobytes() if not more else \
                (self._word(first[1:]) if first[0] == " " and len(first) > 1 else self._split(first)) + b"".join(
                    [array("i", self.piece(part.encode("utf-8", "replace"))).tobytes() for part in more])
        self._keep(word, ids)
        return ids

    def _keep(self, word: str, ids: bytes) -> None:
        if len(word) <= _LONGEST:
            self.young[word] = ids
            self.held += _ENTRY + 2 * len(word) + len(ids)
            if self.held > _GENERATION:
                self.old, self.young, self.held = self.young, {}, 0

    def _words(self, words: list[str]) -> list[bytes]:
        """Tokens of blanks and the words after them, which have no space at either end. The pattern is run over many new
        words at once, as the blank before each begins a match."""
        found = [*map(self.young.get, words)]
        missing = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(missing), _NEW):
            new, young, old, piece = [], self.young.get, self.old.get, self.piece
            for i in missing[at : at + _NEW]:
                found[i] = old(words[i])
                if found[i] is None:
                    new.append(i)
                else:
                    self._keep(words[i], found[i])
            parts = self.split(" " + " ".join([words[i] for i in new])) if new else []
            made = dict.fromkeys(parts)
            for part in made:
                ids = young(part[1:]) if part[0] == " " else None
                made[part] = array("i", piece(part.encode("utf-8", "replace"))).tobytes() if ids is None else ids
            ids = [*map(made.__getitem__, parts)]
            begins = [n for n, part in enumerate(parts) if part[0] == " "]
            if len(begins) != len(new):
                raise ValueError(f"{len(begins)} words came back of {len(new)}")
            for i, first, last in zip(new, begins, [*begins[1:], len(parts)]):
                own = found[i] = ids[first] if last - first == 1 else b"".join(ids[first:last])
                self._keep(words[i], own)
        return found

    def encode(self, text: str) -> np.ndarray:
        """Tokens of a text. A single blank between two other characters begins a piece in any text, so what lies
        between such blanks is encoded, and remembered, for itself."""
        words = text.split(" ")
        found = [*map(self.young.get, words[1:])]
        if None in found:
            if "" in words or _ODD.search(text):
                words = _BLANK.split(text)
                found = [None] * (len(words) - 1)
            found = [self._word(word) if ids is None else ids for word, ids in zip(words[1:], found)]
        return np.frombuffer(b"".join([self._split(words[0]), *found]), np.int32)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many texts, one after the other, and where each text's begin and end. What lies between blanks is
        encoded once and put together by its number; texts with blanks beside other space are encoded one by one."""
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        words, bounds = split.flatten(), bounds - bounds[0]
        coded = words.dictionary_encode()
        distinct, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        row = np.repeat(np.arange(len(texts)), np.diff(bounds))
        odd = np.array([not w or w != w.strip() for w in distinct], bool)
        alone = np.zeros(len(texts), bool)
        alone[row[odd[numbers]]] = True
        first = np.zeros(len(words), bool)
        first[bounds[:-1]] = True
        later = np.zeros(len(distinct), bool)
        later[numbers[~first & ~alone[row]]] = True
        found = np.full(len(distinct), b"", object)
        found[later] = self._words([w for w, wanted in zip(distinct, later.tolist()) if wanted])
        found = found.tolist()
        begins, single = numbers[bounds[:-1]].tolist(), alone.tolist()
        found += [self.encode(texts[i].as_py()).tobytes() if single[i] else self._split(distinct[begins[i]])
                  for i in range(len(texts))]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        numbers = np.where(first, len(distinct) + row, numbers)[first | ~alone[row]]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
        counts = np.where(alone, 1, np.diff(bounds))
        at = np.concatenate([[0], np.cumsum(sizes[numbers])])[np.concatenate([[0], np.cumsum(counts)])]
        return lists.take(pa.array(numbers)).flatten().to_numpy(), at

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Bytes of many sequences of ids, whose beginnings and ends are ``bounds``."""
        data = self.by_rank.take(pa.array(ids))
        if data.null_count:
            raise KeyError("an id has no token")
        ends = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1)[bounds] if len(data) else bounds * 0
        if ends[-1] - ends[0] < 1 << 31:
            body = data.buffers()[2] or pa.py_buffer(b"")
            return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
                None, pa.py_buffer((ends - ends[0]).astype(np.int32)), body.slice(int(ends[0]))])
        return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())


#: A blank beside another one, and a blank with something else on both sides.
_ODD = regex.compile(r"[\s\x1c-\x1f] | [\s\x1c-\x1f]")
_BLANK = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and file."""
    return Codec.from_file(path, pattern)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts of a batch, about ``_SLICE`` bytes at a time. Bytes that are not UTF-8 are replaced."""
    try:
        texts = texts.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
    return slices(texts, _SLICE)


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text: array of int."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        coder, found, bounds = codec(path, pattern), [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for some in _slices(texts):
            tokens, ends = coder.encode_all(some)
            found.append(tokens)
            bounds.append(ends[1:] + bounds[-1][-1])
        ends, tokens = np.concatenate(bounds), pa.array(np.concatenate(found))
        if ends[-1] < 1 << 31:
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens)
        return pa.LargeListArray.from_arrays(pa.array(ends), tokens).cast(pa.list_(pa.int32()))
    return ids(utf8(text))


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of an array of ids; null has none."""
    @F.arrow_udf(T.BinaryType())
    def data(arrays: pa.Array) -> pa.Array:
        coder = codec(path, pattern)
        values, ends = arrays.values.to_numpy(zero_copy_only=False), arrays.offsets.to_numpy().astype(np.int64)
        found, first = [pa.array([], pa.binary())], 0
        while first < len(arrays):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + _TOKENS, "right")) - 1)
            found.append(coder.decode_all(values[ends[first] : ends[last]], ends[first : last + 1] - ends[first]))
            first = last
        return pa.concat_arrays(found)
    return data(F.coalesce(ids, F.array().cast("array<int>")))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one blank."""
    return F.array_join(ids.cast("array<string>"), " ")
