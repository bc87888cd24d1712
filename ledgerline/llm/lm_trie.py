"""Language-model scores from an n-gram trie of Elias-Fano levels.

Words are numbered by the rank of their hash. A level's entries are pairs of a context (an entry of the level above)
and a word; they are kept if they were seen ``min_count`` times or more. A level consists of shards, each a file in the
shared folder that tasks map into memory: the contexts, monotone pointers to where their words begin, the words made
monotone by adding the last number of the context before, and the discounted probabilities as 16-bit logarithms. A
query finds its context, takes the range and base of its words, and searches the successor of base + word in it.

Smoothing is interpolated absolute discounting: P(w | c) = max(n(c w) - d, 0) / n(c) + rest(c) P(w | shorter c), where
the rest is what the kept entries leave, so probabilities add up to one whatever is dropped. Below lies the share of
the word, discounted by d1 = n1 / (n1 + 2 n2), 0.9 at most; what that leaves goes to all unknown words together. A text is its
words and one end; it begins in the context of an end.

Texts are split once to count words, and once to store the number of each word for the levels and the scores. Counting
is done by Spark over all training texts: tasks count what they read, sort it, and send it by shard, keys as
an Elias-Fano sequence; a shard's task adds up. A context's shard is the one that it lies in as an entry of the level
above, so the keys of a shard lie close together however many shards there are. Shards grow in number with the corpus,
not in size. A context's entries are in one shard, but for contexts with over a 4096th of all tokens, whose entries are
dealt by context and word.

Null and empty texts consist of an end. Rows with a null key are for training. Repeated rows count repeatedly. Without
any training text all words are unknown, and the end too. Columns beside key and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, slices, stored, utf8, words_of
from ledgerline.llm.elias_fano import EliasFano, mapped_arrays, write_arrays
from ledgerline.session import work_dir

END = b"\n"
_HEAVY = 4096
_TOKENS = 1 << 20
_STEP = 2000.0  # quantised logarithms: steps of 1 / 2000 down from 0
_PARTS = "kind string, shard int, n bigint, value double, path string"


def hashes_of(words: list[bytes]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return (hashes >> np.uint64(1)).astype(np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as an Elias-Fano sequence from the first one on, and counts, of which most are small."""
    made = EliasFano.of(keys - keys[0])
    small = np.minimum(counts, 255).astype(np.uint8)
    rest = zlib.compress(small.tobytes() + counts[small == 255].astype("<i8").tobytes(), 1)
    head = np.array([len(keys), keys[0], made.bits, len(made.low), len(made.high)], "<i8")
    return head.tobytes() + made.low.tobytes() + made.high.tobytes() + rest


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, first, bits, low, high = np.frombuffer(blob, "<i8", 5).tolist()
    numbers = np.frombuffer(blob, np.uint64, low + high, 40)
    keys = EliasFano(size, bits, numbers[:low], numbers[low:], np.zeros(high, np.int64)).all() + first
    rest = zlib.decompress(blob[40 + 8 * (low + high) :])
    counts = np.frombuffer(rest, np.uint8, size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(rest, "<i8", offset=size)
    return keys, counts


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[firsts], np.add.reduceat(counts, firsts) if len(firsts) else counts


def _dealt(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per shard with its part of sorted keys."""
    numbers, blobs = [], []
    for shard, part in _groups(shards):
        numbers.append(shard)
        blobs.append(_packed(keys[part], counts[part]))
    if numbers:
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "counts"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """A shard's rows added up, some at a time."""
    keys, counts, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
    for batch in batches:
        for blob in batch.column("counts").to_pylist():
            waiting.append(_unpacked(blob))
            held += len(waiting[-1][0])
            if held > 1 << 22:
                keys, counts = _added(np.concatenate([keys, *(w[0] for w in waiting)]), np.concatenate([counts, *(w[1] for w in waiting)]))
                waiting, held = [], 0
    return _added(np.concatenate([keys, *(w[0] for w in waiting)]), np.concatenate([counts, *(w[1] for w in waiting)]))


def _summary(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "shard", "n", "value", "path"])


@dataclass
class Level:
    """Shards of a level: files, first entry number of each, the first context of each, and what is known of heavy
    contexts. A context's shard is the one that holds the context in the level above."""

    paths: list[str] = field(default_factory=list)
    firsts: list[int] = field(default_factory=list)
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    heavy: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    heavy_counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    heavy_rest: np.ndarray = field(default_factory=lambda: np.empty(0))

    def heavy_at(self, contexts: np.ndarray) -> np.ndarray:
        """Number of each context among the heavy ones, or -1."""
        if not len(self.heavy):
            return np.full(len(contexts), -1)
        at = np.minimum(np.searchsorted(self.heavy, contexts), len(self.heavy) - 1)
        return np.where(self.heavy[at] == contexts, at, -1)

    def shard_of(self, contexts: np.ndarray, words: np.ndarray, shards: int) -> np.ndarray:
        found = np.searchsorted(self.starts, contexts, "right") - 1
        heavy = np.flatnonzero(self.heavy_at(contexts) >= 0)
        found[heavy] = _mixed(contexts[heavy] * 1_000_003 + words[heavy]) % np.uint64(shards)
        return found


@dataclass
class Trie:
    """A trained model: small numbers and paths; the levels stay in their files."""

    words: Level
    n_tokens: int
    n_words: int
    discount: float
    levels: list[Level] = field(default_factory=list)

    def word_shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> 31) * len(self.words.paths)) >> 32

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if it is unknown."""
        hashes = hashes_of(words)
        numbers = np.full(len(words), -1, np.int64)
        if not self.words.paths:
            return numbers
        for shard, own in _groups(self.word_shard(hashes)):
            arrays = mapped_arrays(self.words.paths[shard])
            index, equal = EliasFano.mapped(arrays, "hashes").successor(hashes[own])
            numbers[own[equal]] = index[equal] + self.words.firsts[shard]
        return numbers

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all tokens of the texts, ends included, and where each text begins."""
        words, lengths = words_of(texts, lower=True)
        coded = words.dictionary_encode()
        numbers = self.numbers([END, *coded.dictionary.to_pylist()])
        flat = np.zeros(len(words) + len(lengths), np.int64)
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        body = np.ones(len(flat), bool)
        body[begins + lengths] = False
        flat[body] = coded.indices.to_numpy() + 1
        return numbers[flat], begins

    @property
    def kind(self) -> str:
        """How numbers are stored; all ones stand for unknown words."""
        return "<u4" if self.n_words < (1 << 32) - 1 else "<u8"

    def stored_numbers(self, tokens: np.ndarray, begins: np.ndarray) -> pa.Array:
        """Numbers of the tokens of each text as bytes."""
        data = tokens.astype(self.kind)
        ends = np.append(begins, len(tokens)) * data.itemsize
        if ends[-1] >= 1 << 31:
            return pa.array([data[a:b].tobytes() for a, b in zip(begins, [*begins[1:], len(tokens)])], pa.binary())
        return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])

    def read_numbers(self, stored_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all tokens, -1 for unknown words, and where each text begins."""
        ends = np.frombuffer(stored_.buffers()[1], np.int32, len(stored_) + 1, 4 * stored_.offset)
        size = np.dtype(self.kind).itemsize
        begins = (ends - ends[0]).astype(np.int64) // size
        found = np.frombuffer(stored_.buffers()[2], self.kind, begins[-1], int(ends[0]))
        tokens = found.astype(np.int64)
        tokens[found == np.iinfo(found.dtype).max] = -1
        return tokens, begins[:-1]

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        """Count of each token, 0 of unknown words."""
        distinct, back = np.unique(tokens, return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        known = np.flatnonzero(distinct >= 0)
        if len(known):
            firsts = np.array(self.words.firsts)
            for shard, own in _groups(np.searchsorted(firsts, distinct[known], "right") - 1):
                own = known[own]
                counts[own] = mapped_arrays(self.words.paths[shard])["counts"][distinct[own] - firsts[shard]]
        return counts[back]

    def contexts(self, tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """First-level context of each token: the word before; a text begins after an end."""
        before = np.concatenate([[-1], tokens[:-1]])
        before[begins] = self.numbers([END])[0]
        return before

    def children(self, depth: int, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of context and word at a level, sorted by context: entry number (-1: none), discounted probability (0) and the
        context's rest (1 where it has no entries)."""
        level = self.levels[depth]
        entry, share, rest = np.full(len(words), -1, np.int64), np.zeros(len(words)), np.ones(len(words))
        heavy = level.heavy_at(contexts)
        rest[heavy >= 0] = level.heavy_rest[heavy[heavy >= 0]] if len(level.heavy) else 1
        for shard, own in _groups(level.shard_of(contexts, words, len(level.paths))):
            arrays = mapped_arrays(level.paths[shard])
            asked = contexts[own]
            new = np.concatenate([[True], asked[1:] != asked[:-1]])
            known, back = asked[new], np.cumsum(new) - 1
            at, there = EliasFano.mapped(arrays, "contexts").successor(known)
            there_at = at[there]
            pointers, below = EliasFano.mapped(arrays, "pointers"), EliasFano.mapped(arrays, "words")
            begin, end, base = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
            begin[there], end[there] = pointers.get_two(there_at)
            later = np.flatnonzero(begin > 0)
            base[later] = below.get(begin[later] - 1) + 1
            left = np.ones(len(known))
            left[there] = _probability(arrays["rest"][there_at])
            light = heavy[own] < 0
            rest[own[light]] = left[back[light]]
            asked = np.flatnonzero(there[back])
            index, equal = below.successor(base[back[asked]] + words[own[asked]])
            equal &= index < end[back[asked]]
            entry[own[asked[equal]]] = index[equal] + level.firsts[shard]
            share[own[asked[equal]]] = _probability(arrays["shares"][index[equal]])
        return entry, share, rest

    def probabilities(self, tokens: np.ndarray, counts: np.ndarray, begins: np.ndarray) -> np.ndarray:
        known = (counts - self.discount) / max(self.n_tokens, 1)
        unknown = self.discount * self.n_words / self.n_tokens if self.n_tokens else 1.0
        result = np.where(counts > 0, known, max(unknown, 1e-12))
        contexts = self.contexts(tokens, begins)
        for depth in range(len(self.levels)):
            asked = np.flatnonzero((contexts >= 0) & (tokens >= 0))
            pairs, back = np.unique(np.stack([contexts[asked], tokens[asked]]), axis=1, return_inverse=True) \
                if self.n_words > 1 << 31 else _pairs(contexts[asked], tokens[asked], self.n_words)
            entry, share, rest = self.children(depth, pairs[0], pairs[1])
            result[asked] = share[back] + rest[back] * result[asked]
            alone = np.flatnonzero((contexts >= 0) & (tokens < 0))  # an unknown word after a known one
            if len(alone):
                lone, at = np.unique(contexts[alone], return_inverse=True)
                result[alone] *= self.children(depth, lone, np.zeros(len(lone), np.int64))[2][at]
            nodes = np.full(len(tokens), -1, np.int64)
            nodes[asked] = entry[back]
            contexts = np.concatenate([[-1], nodes[:-1]])
            contexts[begins] = -1
        return result


def _pairs(contexts: np.ndarray, words: np.ndarray, n_words: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    keys, back = np.unique(contexts * n_words + words, return_inverse=True)
    return (keys // n_words, keys % n_words), back


def _groups(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places that have it, in order."""
    if len(shards) and shards.max() < 1 << 16:
        shards = shards.astype(np.uint16)  # sorted by counting
    order = np.argsort(shards, kind="stable")
    bounds = np.flatnonzero(np.diff(shards[order].astype(np.int64), prepend=-1))
    for a, b in zip(bounds, [*bounds[1:], len(order)]):
        yield int(shards[order[a]]), order[a:b]


def _quantised(probabilities: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.rint(-np.log(probabilities) * _STEP), 65535).astype(np.uint16)


#: What each quantised logarithm stands for.
_VALUES = np.append(np.exp(-np.arange(65535) / _STEP), 0.0)


def _probability(quantised: np.ndarray) -> np.ndarray:
    return _VALUES[quantised]


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, ends = [], 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            keys, sums = _added(*map(np.concatenate, zip(*waiting, (hashes_of([END]), np.array([ends])))))
            yield from _dealt(keys, sums, ((keys >> 31) * shards) >> 32)
        for batch in batches:
            for texts in slices(batch.column("b"), 6 * _TOKENS):
                words, lengths = words_of(texts, lower=True)
                found = words.value_counts()
                waiting.append((hashes_of(found.field("values").to_pylist()), found.field("counts").to_numpy()))
                held, ends = held + len(found), ends + len(lengths)
                if held > 1 << 21:
                    yield from out()
                    waiting, held, ends = [], 0, 0
        if ends:
            yield from out()
    return run


def _write_words(folder: str):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        keys, counts = _gathered(batches)
        path = write_arrays(folder, f"words-{shard:06d}", {**EliasFano.of(keys).arrays("hashes"), "counts": counts})
        yield _summary([
            ("entries", shard, len(keys), 0.0, path), ("tokens", shard, int(counts.sum()), 0.0, None),
            ("ones", shard, int((counts == 1).sum()), 0.0, None), ("twos", shard, int((counts == 2).sum()), 0.0, None)])
    return run


def _heavy_words(trie: Trie):
    """Words with over a 4096th of all tokens: there are fewer than that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                counts = mapped_arrays(trie.words.paths[shard])["counts"]
                often = np.flatnonzero(counts * _HEAVY > trie.n_tokens)
                yield _summary([("heavy", shard, int(i) + trie.words.firsts[shard], float(counts[i]), None) for i in often])
    return run


def _count_pairs(trie: Trie, depth: int, level: Level, shards: int):
    """Pairs of context and word of a new level, for contexts that the level above has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            if waiting:
                keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
                contexts, words = np.divmod(keys, trie.n_words)
                yield from _dealt(keys, counts, level.shard_of(contexts, words, shards))
        for batch in batches:
            for some in slices(batch.column("numbers"), 4 * _TOKENS):
                tokens, begins = trie.read_numbers(some)
                contexts = trie.contexts(tokens, begins)
                for above in range(depth):
                    asked = np.flatnonzero(contexts >= 0)
                    nodes = np.full(len(tokens), -1, np.int64)
                    pairs, back = _pairs(contexts[asked], tokens[asked], trie.n_words)
                    nodes[asked] = trie.children(above, *pairs)[0][back]
                    contexts = np.concatenate([[-1], nodes[:-1]])
                    contexts[begins] = -1
                asked = contexts >= 0
                waiting.append(contexts[asked] * trie.n_words + tokens[asked])
                held += len(waiting[-1])
                if held > 1 << 22:
                    yield from out()
                    waiting, held = [], 0
        yield from out()
    return run


def _write_pairs(trie: Trie, depth: int, level: Level, folder: str, min_count: int, discount: float):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        keys, counts = _gathered(batches)
        contexts, words = np.divmod(keys, trie.n_words)
        firsts = np.flatnonzero(np.diff(contexts, prepend=-1))
        totals = np.add.reduceat(counts, firsts) if len(firsts) else np.empty(0, np.int64)
        heavy = level.heavy_at(contexts[firsts])
        totals = np.where(heavy >= 0, level.heavy_counts[heavy] if len(level.heavy) else 0, totals)
        of = np.repeat(np.arange(len(firsts)), np.diff([*firsts, len(keys)]))
        kept = counts >= min_count
        mass = np.bincount(of[kept], counts[kept] - discount, len(firsts))
        used = np.flatnonzero(np.bincount(of[kept], minlength=len(firsts)) > 0)
        sizes = np.bincount(of[kept], minlength=len(firsts))[used]
        below, of, counts = words[kept], of[kept], counts[kept]
        ends = np.cumsum(sizes)
        bases = np.cumsum([0, *(below[ends - 1] + 1)])[:-1] if len(ends) else np.empty(0, np.int64)
        shares = (counts - discount) / np.maximum(totals[of], 1)
        path = write_arrays(folder, f"level-{depth}-{shard:06d}", {
            **EliasFano.of(contexts[firsts][used]).arrays("contexts"),
            **EliasFano.of(np.concatenate([[0], ends])).arrays("pointers"),
            **EliasFano.of(below + np.repeat(bases, sizes)).arrays("words"),
            "shares": _quantised(shares), "rest": _quantised(1 - mass[used] / np.maximum(totals[used], 1))})
        rows = [("entries", shard, len(below), 0.0, path)]
        rows += [("mass", shard, int(contexts[firsts[i]]), float(mass[i]), None) for i in used if heavy[i] >= 0]
        often = np.flatnonzero(counts * _HEAVY > trie.n_tokens)
        rows += [("heavy", shard, int(i), float(counts[i]), None) for i in often]
        yield _summary(rows)
    return run


def _placed(summary: DataFrame, shards: int) -> Level:
    """Paths and first numbers of a level's shards; a shard without entries has none."""
    rows = {r["shard"]: r for r in summary.where("kind = 'entries'").collect()}
    level, first = Level(), 0
    for shard in range(shards):
        level.paths.append(rows[shard]["path"] if shard in rows else "")
        level.firsts.append(first)
        first += rows[shard]["n"] if shard in rows else 0
    return level


def _trained_words(rows: DataFrame, shards: int, folder: str) -> tuple[Trie, DataFrame]:
    """The words of the texts ``b``, and the summary of their shards."""
    summary = stored(map_batches(rows, _count_words(shards), "shard int, counts binary").groupBy("shard").applyInArrow(
        _write_words(folder), _PARTS), "lm-words")
    sums = {r["kind"]: r["n"] for r in summary.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    words = _filled(_placed(summary, shards), folder, "words")
    ones, twos = sums.get("ones", 0), sums.get("twos", 0)
    trie = Trie(words, sums.get("tokens", 0), sums.get("entries", 0), min(0.9, ones / (ones + 2 * twos)) if ones else 0.0)
    if not trie.n_tokens:
        trie.words = Level()
    return trie, summary


def _coded(trie: Trie):
    """Texts ``b`` as word numbers; other columns stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("b"), 6 * _TOKENS):
                some = batch.slice(at, len(texts)).drop_columns("b")
                at += len(texts)
                yield some.append_column("numbers", trie.stored_numbers(*trie.texts(texts)))
    return run


def trained(rows: DataFrame, training: Column, order: int = 2, min_count: int = 2, discount: float = 0.75,
            shard_tokens: int = 3_000_000, n_bytes: int | None = None) -> tuple[Trie, DataFrame]:
    """Train on those of ``rows``, with texts as bytes ``b``, for which ``training`` is true; all rows with their word
    ``numbers`` for ``b``, which are looked up once and stored. ``shard_tokens`` sets the number of shards; results do not
    depend on it."""
    spark, own = rows.sparkSession, rows.where(training).select("b")
    if n_bytes is None:
        n_bytes = own.agg(F.sum(F.octet_length("b"))).first()[0] or 0
    shards = 1 + n_bytes // (6 * shard_tokens)
    folder = work_dir(spark, "lm")
    trie, summary = _trained_words(own, shards, folder)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "b")
    coded = stored(map_batches(rows, _coded(trie), f"{schema}, numbers binary" if schema else "numbers binary"), "lm-numbers")
    if not trie.n_tokens:
        return trie, coded
    own = coded.where(training).select("numbers")
    level, above = Level(), trie.n_words
    heavy = map_batches(summary.where("kind = 'entries'").select("shard"), _heavy_words(trie), _PARTS)
    for depth in range(order - 1):
        if above * trie.n_words >= 1 << 63:
            raise OverflowError(f"pairs of {above} contexts and {trie.n_words} words don't fit 63 bits")
        often = sorted((r["n"], int(r["value"])) for r in heavy.collect())
        starts = np.array((trie.levels[-1] if trie.levels else trie.words).firsts, np.int64)
        level = Level(starts=starts, heavy=np.array([o[0] for o in often], np.int64), heavy_counts=np.array([o[1] for o in often], np.int64))
        summary = stored(map_batches(own, _count_pairs(trie, depth, level, shards), "shard int, counts binary").groupBy(
            "shard").applyInArrow(_write_pairs(trie, depth, level, folder, min_count, discount), _PARTS), f"lm-level-{depth}")
        placed = _filled(_placed(summary, shards), folder, f"level-{depth}")
        mass = {r["n"]: r["value"] for r in summary.where("kind = 'mass'").groupBy("n").agg(F.sum("value").alias("value")).collect()}
        above = summary.where("kind = 'entries'").agg(F.sum("n")).first()[0] or 0
        level.paths, level.firsts = placed.paths, placed.firsts
        level.heavy_rest = np.array([1 - mass.get(int(h), 0.0) / c for h, c in zip(level.heavy, level.heavy_counts)])
        trie.levels.append(level)
        first = F.create_map(*[F.lit(v) for pair in enumerate(level.firsts) for v in pair])
        heavy = summary.where("kind = 'heavy'").withColumn("n", F.col("n") + first[F.col("shard")])
    return trie, coded


def _filled(level: Level, folder: str, name: str) -> Level:
    """Empty files for shards that got no rows."""
    none = np.empty(0, np.int64)
    if "" in level.paths:
        empty = EliasFano.of(none)
        path = write_arrays(folder, f"{name}-none", {
            **empty.arrays("hashes"), **empty.arrays("contexts"), **EliasFano.of(np.zeros(1, np.int64)).arrays("pointers"),
            **empty.arrays("words"), "counts": none, "shares": none.astype(np.uint16), "rest": none.astype(np.uint16)})
        level.paths = [p or path for p in level.paths]
    return level


def _score(trie: Trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_tokens, n_known, base, score = [], [], [], []
            for some in slices(batch.column("numbers"), 4 * _TOKENS):
                tokens, begins = trie.read_numbers(some)
                counts = trie.counts(tokens)
                logs = np.log10(trie.probabilities(tokens, counts, begins))
                plain = np.log10((counts + 1) / (trie.n_tokens + trie.n_words + 1))
                n_tokens += np.diff([*begins, len(tokens)]).tolist()
                n_known += np.add.reduceat((counts > 0).astype(np.int64), begins).tolist()
                base += np.add.reduceat(plain, begins).tolist()
                score += np.add.reduceat(logs, begins).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), batch.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                ["doc_key", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def held_out(key: Column) -> Column:
    """A seventh of the keys, by the CRC of their text; null keys are for training."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Train on the rows that are not held out, score all: ``key``, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score, log10 probabilities of the whole text."""
    rows = docs.select(F.col(key).alias("doc_key"), held_out(F.col(key)).alias("held_out"), utf8(F.col(text)).alias("b"))
    trie, coded = trained(rows, ~F.col("held_out"), **options)
    kind = rows.schema["doc_key"].dataType.simpleString()
    found = map_batches(
        coded, _score(trie), f"doc_key {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return found.select(
        F.col("doc_key").alias(key), "held_out", "n_tokens", "n_known", F.lit(trie.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score")
