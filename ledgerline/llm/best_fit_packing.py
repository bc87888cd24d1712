"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

A document's ids are cut into pieces of at most a sequence's length. Whole pieces fill a sequence alone; the others
are dealt at random to cells of about ``cell_rows`` pieces, so no task grows with the input. Each cell is packed by
several islands. An island keeps a population of packings; a child takes over the well-filled sequences of one
parent, then those of the other parent that share no piece with them, and the displaced pieces go where they fit
best. After an epoch each island's best packing migrates to the next island of the cell, and another epoch runs. The
best island's packing counts. Sequences that stay poorly filled are opened again, and their pieces from all cells
make up new cells for a last round.

Null text is an empty document, which still has its end id. Equal rows are packed each for itself; null keys too. An
empty table gives no pieces. Columns beside key and text are not read.
"""

from __future__ import annotations

import os
import random
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, numbered, slices, stored, utf8, words_of
from ledgerline.llm.token_counts import compiled

_SLICE = 4 << 20
#: Words that a worker remembers, their bytes with those of their ids, and pieces. Words are held as Arrow arrays, which
#: take less than Python objects; pieces are such objects.
_REMEMBERED, _REMEMBERED_BYTES = 300_000, 64 << 20
_REMEMBERED_PIECES = 100_000
_AFTER_WORDS = b".,;:!?"
_MARKS = frozenset(_AFTER_WORDS.decode())


class WordIds:
    """Ids of texts by a ``tokenizers`` file, as little-endian unsigned 32-bit numbers.

    The file must be of the kind that ``token_counts.Compiled`` reads: it drops white space, so that what stands
    between blanks is encoded for itself. Such words are split into the tokenizer's own pieces, and pieces that are
    new are encoded by the library, many in one call. Words that are not stable under normalising go to it one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # there are as many tasks as cores already
        self.tokenizer, self.kind = Tokenizer.from_file(path), compiled(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None  # for ASCII in lower case, which normalising leaves as it is
        suffix = self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # tokens that a piece ends with
        self.last[[i for t, i in self.tokenizer.get_vocab(False).items() if t.endswith(suffix)]] = True
        self.words, self.ids = pa.array([], pa.large_binary()), pa.array([], pa.large_binary())
        self.pieces: dict[str, bytes] = {}

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _split(self, word: bytes) -> list[str] | None:
        if self.kind.simple(word):
            return self.kind.pieces(word.decode().lower())
        text = word.decode("utf-8", "replace")
        if text.isalpha() and "Σ" not in text:  # letters of any kind: one piece if lower case leaves them so
            lower = text.lower()
            if lower.isalpha() and lower.lower() == lower and all(
                    unicodedata.is_normalized("NFC", t) for t in (text, lower)):
                return [lower]
        normal = self.kind.normalised(text)
        if self.kind.special.search(text) or self.kind.normalised(normal) != normal:
            return None
        return self.kind.pieces(normal)

    def _split_others(self, words: list[bytes]) -> Iterator[list[str] | None]:
        """What ``_split`` gives for words that are not all ASCII; what letters need is seen for many words at once."""
        for at in range(0, len(words), 200):
            some = words[at : at + 200]
            joined = b" ".join(some).decode("utf-8", "replace")
            low = joined.lower()
            if "Σ" in joined or low.lower() != low or not all(unicodedata.is_normalized("NFC", t) for t in (joined, low)):
                yield from map(self._split, some)
                continue
            for word, text, lower in zip(some, joined.split(" "), low.split(" ")):
                if text.isalpha() and lower.isalpha():
                    yield [lower]
                elif lower[-1] in _MARKS and text[:-1].isalpha() and lower[:-1].isalpha():
                    yield [lower[:-1], lower[-1]]
                else:
                    yield self._split(word)

    def _encoded(self, new: list[str]) -> None:
        """Ids of new pieces, encoded many in one call; each ends with its only token of the end of a word."""
        ascii_ = [p.isascii() for p in new]
        for tokenizer, wanted in ((self.plain, True), (self.tokenizer, False)):
            own = [p for p, a in zip(new, ascii_) if a == wanted]
            for at in range(0, len(own), 2000):
                some = own[at : at + 2000]
                found = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                ids, edges = found.tobytes(), (4 * (np.flatnonzero(self.last[found]) + 1)).tolist()
                if len(edges) != len(some) or edges[-1] != len(ids):
                    raise ValueError(f"{len(edges)} pieces came back of {len(some)}")
                self.pieces.update(zip(some, [ids[i:j] for i, j in zip([0, *edges], edges)]))

    def _learn(self, words: list[bytes]) -> list[bytes]:
        if len(self.pieces) > _REMEMBERED_PIECES:
            self.pieces.clear()
        known, letters, marked, foreign, others = self.pieces, [], [], [], {}
        for word in words:
            if word.isalpha():  # ASCII letters, by far the most: one piece
                letters.append(word)
            elif word[:-1].isalpha() and word[-1] in _AFTER_WORDS:  # and a mark: two
                marked.append(word)
            elif word.isascii():
                others[word] = self._split(word)
            else:
                foreign.append(word)
        others.update(zip(foreign, self._split_others(foreign)))
        lower = b" ".join(letters).lower().decode().split(" ") if letters else []
        stems = b" ".join([w[:-1] for w in marked]).lower().decode().split(" ") if marked else []
        marks = [chr(w[-1]) for w in marked]
        new = set().union(lower, stems, marks).difference(known)
        new.update(p for pieces in others.values() for p in pieces or () if p not in known)
        self._encoded(list(new))
        learnt = dict(zip(letters, map(known.__getitem__, lower)))
        learnt.update(zip(marked, map(add, map(known.__getitem__, stems), map(known.__getitem__, marks))))
        for word, pieces in others.items():
            if pieces is None:
                learnt[word] = self._alone(word.decode("utf-8", "replace"))
            else:
                learnt[word] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])
        return [learnt[w] for w in words]

    def of(self, texts: pa.Array | list[bytes]) -> list[bytes]:
        """Ids of each text. Words are looked up once however often they occur, and put together by their numbers."""
        words, counts = words_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary())
        places = pc.index_in(distinct, value_set=self.words)
        if places.null_count:
            is_new = pc.is_null(places).to_numpy(zero_copy_only=False)
            new = distinct.filter(pa.array(is_new))
            learnt = pa.array(self._learn(new.to_pylist()), pa.large_binary())
            if len(self.words) > _REMEMBERED or self.words.nbytes + self.ids.nbytes > _REMEMBERED_BYTES:
                stay = places.drop_null()
                self.words, self.ids = self.words.take(stay), self.ids.take(stay)
                places = np.empty(len(distinct), np.int64)
                places[~is_new] = np.arange(len(stay))
            else:
                places = places.fill_null(0).to_numpy().astype(np.int64)
            places[is_new] = np.arange(len(self.words), len(self.words) + len(new))
            places = pa.array(places)
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, learnt])
        data = self.ids.take(places).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(counts)])
        if not len(data):
            return [b""] * len(counts)
        body, ends = memoryview(data.buffers()[2] or b""), np.frombuffer(data.buffers()[1], np.int64, len(data) + 1)[ends]
        return [bytes(body[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    """One per worker process and file."""
    return WordIds(path)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at = 0
            for texts in slices(batch.column("b"), _SLICE):
                some = batch.slice(at, len(texts))
                at += len(texts)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, data in enumerate(ids_of.of(texts)):
                    data += end
                    for number, first in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[first : first + 4 * capacity]
                        row.append(k)
                        piece.append(number)
                        start.append(first // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4"))
                arrays = [some.column("doc_key").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                          pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_key", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = 4096,
           end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``doc_key``, piece, start, length, ids_crc32 and, if asked for, the ids."""
    rows = docs.select(F.col(key).alias("doc_key"), utf8(F.col(text)).alias("b"))
    schema = f"doc_key {rows.schema['doc_key'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_batches(rows, _cut(tokenizer, capacity, end_id, with_ids), schema + ", ids array<bigint>" * with_ids)


class Packing:
    """Groups of pieces (their numbers), each with the room left."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.groups: list[list[int]] = []
        self.room: list[int] = []
        self._by_room: list[tuple[int, int]] = []

    def add(self, group: list[int]) -> None:
        room = self.capacity - sum(self.lengths[i] for i in group)
        insort(self._by_room, (room, len(self.groups)))
        self.groups.append(list(group))
        self.room.append(room)

    def best_fit(self, items: list[int]) -> Packing:
        """Put each item into the fullest group that has room for it, or into a new one."""
        for item in items:
            length = self.lengths[item]
            at = bisect_left(self._by_room, (length, -1))
            if at == len(self._by_room):
                self.add([item])
                continue
            room, group = self._by_room.pop(at)
            self.groups[group].append(item)
            self.room[group] = room - length
            if room > length:
                insort(self._by_room, (room - length, group))
        return self

    def fitness(self) -> tuple[int, int]:
        """Fewer groups are better; of as many, those with the room in fewer places."""
        return -len(self.groups), sum(r * r for r in self.room)


def _by_length(items: list[int], lengths: list[int]) -> list[int]:
    return sorted(items, key=lambda i: -lengths[i])


def child(mother: Packing, father: Packing, chance: random.Random) -> Packing:
    """Well-filled groups of the mother, then the father's groups without their pieces, the rest by best fit."""
    made = Packing(mother.lengths, mother.capacity)
    by_room = sorted(range(len(mother.groups)), key=lambda g: (mother.room[g], chance.random()))
    taken: set[int] = set()
    for g in by_room[: max(1, len(by_room) * chance.randint(40, 80) // 100)]:
        made.add(mother.groups[g])
        taken.update(mother.groups[g])
    displaced = []
    for g, group in enumerate(father.groups):
        if taken.isdisjoint(group) and father.room[g] <= mother.capacity // 64:
            made.add(group)
        else:
            displaced += [i for i in group if i not in taken]
    if chance.random() < 0.5:
        return made.best_fit(_by_length(displaced, mother.lengths))
    chance.shuffle(displaced)
    return made.best_fit(displaced)


def evolve(lengths: list[int], capacity: int, seeds: list[list[list[int]]], chance: random.Random,
           population: int = 4, generations: int = 6) -> Packing:
    """Best packing of an epoch. ``seeds`` are packings to start from; others are made anew."""
    items, packings = list(range(len(lengths))), []
    for groups in seeds:
        packing = Packing(lengths, capacity)
        for group in groups:
            packing.add(group)
        packings.append(packing)
    if not packings:
        packings.append(Packing(lengths, capacity).best_fit(_by_length(items, lengths)))
    least = -(-sum(lengths) // capacity)
    while len(packings) < population:
        mixed = _by_length(items, lengths)
        for _ in range(len(items) // 8):
            a, b = chance.randrange(len(items)), chance.randrange(len(items))
            mixed[a], mixed[b] = mixed[b], mixed[a]
        packings.append(Packing(lengths, capacity).best_fit(mixed))
    for _ in range(generations):
        packings.sort(key=Packing.fitness, reverse=True)
        if len(packings[0].groups) == least:
            break
        mother, father = packings[0], packings[chance.randrange(1, len(packings))]
        packings[-1] = child(mother, father, chance) if chance.random() < 0.5 else child(father, mother, chance)
    return max(packings, key=Packing.fitness)


_PACKED = "cell bigint, island int, item bigint, length bigint, bin int, place bigint, bin_fill bigint"


def _epoch(capacity: int, seed: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by([("item", "ascending")]).to_pydict()
        cell, island = key[0].as_py(), key[1].as_py()
        numbers: dict[int, int] = {}
        lengths: list[int] = []
        parents: dict[int, dict[int, list[int]]] = {}
        for item, length, guest, group in zip(rows["item"], rows["length"], rows["guest"], rows["bin"]):
            if item not in numbers:
                numbers[item] = len(lengths)
                lengths.append(length)
            if group is not None:
                parents.setdefault(guest, {}).setdefault(group, []).append(numbers[item])
        chance = random.Random(f"{seed} {cell} {island} {len(parents)}")
        best = evolve(lengths, capacity, [[*p.values()] for p in parents.values()], chance)
        items, out = list(numbers), []
        for number, group in enumerate(best.groups):
            place, fill = 0, capacity - best.room[number]
            for i in group:
                out.append((items[i], lengths[i], number, place, fill))
                place += lengths[i]
        n, columns = len(out), list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array([cell] * n, pa.int64()), pa.array([island] * n, pa.int32()), pa.array(columns[0], pa.int64()),
             pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()),
             pa.array(columns[4], pa.int64())],
            ["cell", "island", "item", "length", "bin", "place", "bin_fill"])
    return run


def _packed(items: DataFrame, capacity: int, cell_rows: int, islands: int, epochs: int, seed: int) -> DataFrame:
    """Best packing of each cell: cell, item, length, bin, place, bin_fill."""
    cells = max(1, -(-items.count() // cell_rows))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(cells)).alias("cell"))
    rows = dealt.select(
        "cell", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), "item", "length",
        F.lit(None).cast("int").alias("bin"), F.lit(0).alias("guest"))
    for epoch in range(epochs):
        best = stored(rows.groupBy("cell", "island").applyInArrow(_epoch(capacity, seed + epoch), _PACKED), f"islands-{epoch}")
        own = best.select("cell", "island", "item", "length", "bin", F.lit(0).alias("guest"))
        rows = own.unionByName(own.withColumn("island", (F.col("island") + 1) % islands).withColumn("guest", F.lit(1)))
    room = F.lit(capacity) - F.col("bin_fill")
    scores = best.where("place = 0").groupBy("cell", "island").agg(
        F.count("*").alias("bins"), F.sum(room * room).alias("rooms"))
    winner = scores.groupBy("cell").agg(F.min(F.struct("bins", -F.col("rooms"), "island")).alias("w")).select(
        "cell", F.col("w.island").alias("island"))
    return best.join(winner, ["cell", "island"]).drop("island")


def pack(parts: DataFrame, capacity: int = 4096, cell_rows: int = 1024, islands: int = 2, epochs: int = 2,
         seed: int = 1) -> DataFrame:
    """Rows of ``parts`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and gapless ``offset``."""
    parts = numbered(parts, "pieces", "item")
    open_items = parts.where(F.col("length") < capacity).select("item", "length")
    first = stored(_packed(open_items, capacity, cell_rows, islands, epochs, seed), "packed")
    full = F.col("bin_fill") >= capacity - capacity // 64
    last = _packed(first.where(~full).select("item", "length"), capacity, cell_rows, islands, epochs, seed + 1000)
    places = [
        df.select("item", ((F.lit(turn << 41) + F.col("cell")) * F.lit(1 << 20) + F.col("bin")).alias("sequence_id"),
                  F.col("place").alias("offset"))
        for turn, df in enumerate((first.where(full), last))]
    alone = parts.where(F.col("length") >= capacity).select(
        "item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return parts.join(places[0].unionByName(places[1]).unionByName(alone), "item").drop("item")
