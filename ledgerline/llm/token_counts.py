"""Token counts by a tokenizer compiled to a deterministic transducer.

Word BPE is compiled to a transducer over bytes. A state holds what the merges of a word's beginning can still
depend on: its longest end that a token may begin with, and the last token before each place in it where a token may
begin. A transition is annotated with the tokens it emits, counted up to the byte read; as longer tokens replace
shorter ones this may be less than none. States are made when a text first reaches them, and kept per worker.

Texts are dealt in chunks, and a chunk is mapped for itself, whatever state it is entered in. A blank leads from every
state to the start, so a chunk's state map is: the bytes up to its first blank (where the entry state matters), the
tokens from there on, and the bytes after its last blank (its exit state). Maps compose associatively, and a text's
chunks are combined by a parallel prefix scan.

Null text is empty and has no tokens. Strings of special tokens inside a text count as one token, as the library reads
them. Each row is counted for itself, whatever its key; columns beside key and text are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import BLANKS, map_batches

CHUNK = 1 << 16
_STATES = 200_000
_WORDS = 1_000_000
#: Stands for the end of a word within symbols and tokens.
_END = "￿"
_BLANK_BYTES = frozenset(BLANKS.encode())


def byte_characters() -> str:
    """The character that byte-level tokenizers write for each byte: printable ones as they are, the others in order
    from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


class WordTransducer:
    """Deterministic transducer of a word BPE with an end-of-word suffix."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: set[str]):
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.tokens = vocabulary
        self.beginnings = {t[:i] for t in vocabulary for i in range(1, len(t))}
        self.compatible = lru_cache(1 << 18)(self._compatible)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.ends: list[dict[str, int]] = []
        self.start = self._state(("", (None,), (0,)))

    def _state(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
            self.moves.append({})
            self.ends.append({})
        return number

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges as defined: the pair of lowest rank first. For short symbol lists only."""
        parts, none = list(symbols), len(self.ranks)
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), none), i) for i in range(len(parts) - 1))
            if rank == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @staticmethod
    def symbols(token: str) -> list[str]:
        return [*token[:-2], token[-2:]] if token.endswith(_END) else list(token)

    def _compatible(self, left: str | None, right: str) -> bool:
        if left is None:
            return self.merged(self.symbols(right)) == [right]
        return self.merged(self.symbols(left) + self.symbols(right)) == [left, right]

    def _last(self, state: tuple, symbol: str) -> tuple[str, int]:
        """The last token after one more symbol, and the tokens up to it, counted from the state's place."""
        window, lasts, counts = state
        for at in range(len(window) + 1):
            token = window[at:] + symbol
            if counts[at] is not None and token in self.tokens and self.compatible(lasts[at], token):
                return token, counts[at] + 1
        raise ValueError(f"no token for {symbol!r}")

    def _move(self, number: int, symbol: str) -> tuple[int, int]:
        state = self.states[number]
        token, emitted = self._last(state, symbol)
        window, lasts, counts = state[0] + symbol, [*state[1], token], [*state[2], emitted]
        first = next(i for i in range(len(window) + 1) if i == len(window) or window[i:] in self.beginnings)
        window, lasts, counts = window[first:], lasts[first:], counts[first:]
        for i in range(len(window)):  # places where no longer token can begin do not matter
            if window[i:] not in self.beginnings:
                lasts[i] = counts[i] = None
        counts = [None if c is None else c - emitted for c in counts]
        made = self.moves[number][symbol] = self._state((window, tuple(lasts), tuple(counts))), emitted
        return made

    def tokens_of(self, word: str) -> int:
        """Run the transducer over a word of byte characters."""
        if len(self.states) > _STATES:
            self._reset()
        number, total, moves = self.start, 0, self.moves
        for symbol in word[:-1]:
            number, emitted = moves[number].get(symbol) or self._move(number, symbol)
            total += emitted
        last = word[-1]
        emitted = self.ends[number].get(last)
        if emitted is None:
            emitted = self.ends[number][last] = self._last(self.states[number], last + _END)[1]
        return total + emitted


class StateMap(NamedTuple):
    """What a chunk does to any entry state. Without a blank (``reset`` false) it is all ``head``."""

    head: bytes
    tokens: int
    tail: bytes
    reset: bool


class Compiled(dict):
    """A ``tokenizers`` file of the kind "NFC, white space, lower case; word BPE over bytes", compiled. As a dict it
    remembers the tokens of what stands between blanks."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not suffix or steps != ["NFC", "Replace", "Lowercase"] or model["dropout"] or \
                [s["type"] for s in splits] != ["Split", "ByteLevel"] or any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a tokenizer of the kind compiled here")

        def marked(token: str) -> str:
            return token[: -len(suffix)] + _END if token.endswith(suffix) and token != suffix else token
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = WordTransducer([(marked(a), marked(b)) for a, b in merges], {marked(t) for t in model["vocab"]})
        pattern = splits[0]["pattern"]["Regex"].replace("\\s", "\\p{White_Space}")
        self.pieces = regex.compile(pattern).findall
        contents = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(contents, key=len, reverse=True)))) if contents else None
        self.begins = {c[0].encode()[:1] for c in contents}
        self.characters = {b: c for b, c in enumerate(byte_characters())}

    def simple(self, data: bytes) -> bool:
        """ASCII without the beginning of a special token: normalising only makes it lower case."""
        return data.isascii() and not any(c in data for c in self.begins)

    @staticmethod
    def normalised(text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final sigma there

    def _plain(self, text: str) -> int:
        return sum(
            self.words.tokens_of(piece.encode().decode("latin-1").translate(self.characters))
            for piece in self.pieces(self.normalised(text)))

    def __missing__(self, data: bytes) -> int:
        if len(self) > _WORDS:
            self.clear()
        if self.simple(data):
            tokens_of, characters = self.words.tokens_of, self.characters
            total = self[data] = sum(tokens_of(p.translate(characters)) for p in self.pieces(data.decode().lower()))
            return total
        text = data.decode("utf-8", "replace")
        parts = self.special.split(text) if self.special else [text]
        total = self[data] = sum(map(self._plain, parts)) + len(parts) - 1
        return total

    def state_map(self, data: bytes) -> StateMap:
        words = data.split()
        if not data or (len(words) == 1 and len(words[0]) == len(data)):
            return StateMap(data, 0, b"", False)
        head = b"" if data[0] in _BLANK_BYTES else words.pop(0)
        tail = b"" if data[-1] in _BLANK_BYTES else words.pop()
        return StateMap(head, sum(map(self.__getitem__, words)), tail, True)

    def then(self, first: StateMap, second: StateMap) -> StateMap:
        """The map of one chunk followed by another."""
        if not first.reset:
            return second._replace(head=first.head + second.head)
        if not second.reset:
            return first._replace(tail=first.tail + second.head)
        middle = first.tail + second.head
        return StateMap(first.head, first.tokens + (self[middle] if middle else 0) + second.tokens, second.tail, True)

    def total(self, whole: StateMap) -> int:
        """Tokens if the map is entered in the start state and the text ends after it."""
        return whole.tokens + sum(self[part] for part in (whole.head, whole.tail) if part)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Maps of all prefixes: neighbours are joined, then their scan fills the gaps."""
        if len(maps) < 2:
            return maps
        joined = self.scan([self.then(a, b) for a, b in zip(maps[::2], maps[1::2])])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(joined[i // 2] if i % 2 else self.then(joined[i // 2 - 1], maps[i]))
        return out


    def whole(self, maps: list[StateMap]) -> StateMap:
        """The last of the scan alone, joined in pairs: what is held besides the chunks is as long as they are."""
        while len(maps) > 1:
            maps = [self.then(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]


@lru_cache(2)
def compiled(path: str) -> Compiled:
    """One compiled tokenizer per worker process and file."""
    return Compiled(path)


def _maps(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = compiled(path)
        for batch in batches:
            maps = [tokenizer.state_map(c or b"") for c in batch.column("chunk").to_pylist()]
            columns = list(zip(*maps)) if maps else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row_no", "doc_key", "n_bytes", "number")), pa.array(columns[0], pa.binary()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.bool_())],
                ["row_no", "doc_key", "n_bytes", "number", "head", "tokens", "tail", "reset"])
    return run


def counted(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``key``, n_bytes and n_tokens of every row. ``chunk`` is the most code points mapped at once."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(key).alias("doc_key"),
        F.octet_length(body).cast("bigint").alias("n_bytes"), body.alias("body"))
    cut = rows.select("row_no", "doc_key", "n_bytes", F.posexplode_outer(
        F.regexp_extract_all("body", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("number", "chunk"))
    kind = rows.schema["doc_key"].dataType.simpleString()
    maps = map_batches(
        cut.withColumn("chunk", F.col("chunk").cast("binary")), _maps(tokenizer),
        f"row_no bigint, doc_key {kind}, n_bytes bigint, number int, head binary, tokens bigint, tail binary, reset boolean")

    @F.arrow_udf(T.LongType())
    def tokens(groups: pa.Array) -> pa.Array:
        made = compiled(tokenizer)
        out = []
        for group in groups.to_pylist():
            out.append(made.total(made.whole([StateMap(m["head"], m["tokens"], m["tail"], m["reset"]) for m in group])))
        return pa.array(out, pa.int64())
    grouped = maps.groupBy("row_no").agg(
        F.first("doc_key").alias(key), F.first("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("number", "head", "tokens", "tail", "reset"))).alias("maps"))
    return grouped.select(key, "n_bytes", tokens("maps").alias("n_tokens"))
