"""Line dedup by winnowing over line hashes.

A document is its sequence of lines that have a word. A passage is a run of consecutive lines with ``min_words`` words
or more; wherever it stands a second time (documents in the order of key and locator, places in the order of lines)
its lines are deleted.

From each line on, the shortest run with enough words is a window; of its line hashes the smallest is selected, the
last one of equals. A passage that repeats has a whole window in common with its copy, so both select the same hash: the
selected lines are guaranteed fingerprints. Fingerprints that stand at one place only are done with. At the others the
match is extended both ways: the windows that lie on them, forwards and backwards, are compared by a hash of all their
lines, and those that stood somewhere before are deleted. A line is in a repeated passage exactly if one of its windows
is repeated, so nothing is lost to the choice of a place to compare with.

``without_passages`` finds passages wherever they begin and end. A document is its sequence of words there, and a window
any ``min_words`` words of it, across line ends. Runs of half as many words are hashed; of the runs in a window the one
with the smallest hash is selected, so equal windows select equal fingerprints. Neighbouring windows that select the same
place are a span: the fingerprint, extended both ways. A row per span travels, none per window. Equal spans (two 64-bit
hashes) are joined to their first place, and all but the first are deleted whole. Only where unequal spans share a
fingerprint, at the edges of passages, their first places are compared window by window, by 128 bits. The result equals
that of comparing all windows. What ``deduplicated`` deletes is among them, because a run of whole lines consists of
such windows.

Null or empty text has no lines. Lines without a word stay. Repeated rows are documents of their own, so all but the
first lose their passages. Null keys come first in the order. Columns beside key and text are not read, whatever their
names. A text of any length is one row; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import located, map_batches, numbered, stored, utf8


_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
_BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def lines_of(text: bytes) -> tuple[list[bytes], list[int]]:
    """All lines, and the numbers of those with a word."""
    lines = text.split(b"\n")
    return lines, [i for i, line in enumerate(lines) if line and not line.isspace()]


def forward_ends(words: list[int], least: int) -> list[int]:
    """For each line the end (exclusive) of the shortest run from it with enough words; 0 where there is none."""
    ends, end, held = [], 0, 0
    for at, own in enumerate(words):
        while end < len(words) and held < least:
            held += words[end]
            end += 1
        ends.append(end if held >= least else 0)
        held -= own
    return ends


def backward_starts(words: list[int], least: int) -> list[int]:
    """For each line the start of the shortest run that ends with it and has enough words; -1 where there is none."""
    size = len(words)
    return [size - end if end else -1 for end in forward_ends(words[::-1], least)][::-1]


def fingerprints(hashes: list[int], ends: list[int]) -> list[int]:
    """Selected line of each window, by the window's start; -1 where there is none."""
    return [max(range(at, end), key=lambda i: (-hashes[i], i)) if end else -1 for at, end in enumerate(ends)]


def _sequences(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words, selected = [], [], []
            for text in batch.column("b").to_pylist():
                lines, used = lines_of(text)
                own = [xxhash.xxh3_64_intdigest(lines[i]) - (1 << 63) for i in used]
                count = [len(lines[i].split()) for i in used]
                hashes.append(own)
                words.append(count)
                selected.append(fingerprints(own, forward_ends(count, least)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), batch.column("at"), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array(words, pa.list_(pa.int32())), pa.array(selected, pa.list_(pa.int32()))],
                ["doc_key", "at", "hashes", "words", "selected"])
    return run


def _windows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, stops, digests = [], [], [], []
            for k, row in enumerate(batch.select(["hashes", "words", "selected", "hits"]).to_pylist()):
                hits, selected = set(row["hits"]), row["selected"]
                own = np.array(row["hashes"], np.int64)
                runs = {(at, end) for at, end in enumerate(forward_ends(row["words"], least)) if end}
                runs |= {(at, end) for end, at in enumerate(backward_starts(row["words"], least), 1) if at >= 0}
                for at, end in sorted(runs):
                    if selected[at] in hits:
                        rows.append(k)
                        starts.append(at)
                        stops.append(end)
                        digests.append(xxhash.xxh3_128_digest(own[at:end].tobytes()))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_no").take(taken), batch.column("doc_key").take(taken), pa.array(starts, pa.int32()),
                 pa.array(stops, pa.int32()), pa.array(digests, pa.binary())],
                ["row_no", "doc_key", "start", "stop", "digest"])
    return run


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_lines, n_gone, n_words = [], [], [], []
        for row in batch.select(["b", "runs"]).to_pylist():
            lines, used = lines_of(row["b"])
            gone = {used[i] for run in row["runs"] or () for i in range(run["start"], run["stop"])}
            texts.append(b"\n".join(line for i, line in enumerate(lines) if i not in gone).decode("utf-8", "replace"))
            n_lines.append(len(used))
            n_gone.append(len(gone))
            n_words.append(sum(len(lines[i].split()) for i in gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_key"), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64()),
             pa.array(n_words, pa.int64()), batch.column("first_keys"), pa.array(texts, pa.string())],
            ["doc_key", "n_lines", "n_removed_lines", "n_removed_words", "first_keys", "text"])


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Windows that stood before: ``at`` (locator), doc_key, start, stop (numbers among the lines with a word) and
    first_key, the key of the document that has them first."""
    rows = located(docs, key, text)
    kind = rows.schema["doc_key"].dataType.simpleString()
    sequences = numbered(map_batches(
        rows.select("doc_key", "at", utf8(F.col("body")).alias("b")), _sequences(min_words),
        f"doc_key {kind}, at struct<path:string,row:bigint>, hashes array<bigint>, words array<int>, selected array<int>"),
        "line-hashes")
    chosen = sequences.select("row_no", F.explode(F.array_distinct(F.filter("selected", lambda i: i >= 0))).alias("line"), "hashes").select(
        "row_no", "line", F.element_at("hashes", F.col("line") + 1).alias("fingerprint"))
    several = stored(chosen.groupBy("fingerprint").agg(F.count("*").alias("places")).where("places > 1").select("fingerprint"), "repeated")
    hits = chosen.join(several, "fingerprint").groupBy("row_no").agg(F.collect_list("line").alias("hits"))
    windows = stored(map_batches(
        sequences.drop("at").join(hits, "row_no"), _windows(min_words),
        f"row_no bigint, doc_key {kind}, start int, stop int, digest binary"), "windows")
    position = F.struct("doc_key", "row_no", "start")
    first = windows.groupBy("digest").agg(F.min(position).alias("first"), F.count("*").alias("places")).where("places > 1")
    later = windows.join(stored(first.select("digest", "first"), "first-windows"), "digest").where(~position.eqNullSafe(F.col("first")))
    return later.select("row_no", "start", "stop", F.col("first.doc_key").alias("first_key")).join(
        sequences.select("row_no", "doc_key", "at"), "row_no")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """One row per document: ``key``, n_lines (with a word), n_removed_lines, n_removed_words, first_keys (documents
    that have the removed passages first) and the ``text`` that is left."""
    runs = repeated_runs(docs, key, text, min_words).groupBy("at").agg(
        F.collect_list(F.struct("start", "stop")).alias("runs"),
        F.sort_array(F.collect_set("first_key")).alias("first_keys")).withColumnRenamed("at", "there")
    rows = located(docs, key, text)
    kind = rows.schema["doc_key"].dataType.simpleString()
    joined = rows.join(stored(runs, "runs").hint("merge"), F.col("at") == F.col("there"), "left").select(
        "doc_key", utf8(F.col("body")).alias("b"), "runs",
        F.coalesce("first_keys", F.array().cast(f"array<{kind}>")).alias("first_keys"))
    return map_batches(
        joined, _cleaned, f"doc_key {kind}, n_lines bigint, n_removed_lines bigint, n_removed_words bigint, "
        f"first_keys array<{kind}>, text string").withColumnRenamed("doc_key", key)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Runs:
    """Hashes of all runs of a length, as differences of sums that are weighted by powers of an odd base."""

    def __init__(self, base: int):
        self.base, self.back, self.size = base, pow(base, -1, 1 << 64), 0

    def _sums(self, words: np.ndarray) -> np.ndarray:
        if self.size < len(words):
            self.size = 2 * len(words)
            self.powers, self.inverse = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.size - 1, b, np.uint64)])) for b in (self.base, self.back))
        return np.concatenate([[np.uint64(0)], np.cumsum(words * self.powers[:len(words)])])

    def __call__(self, words: np.ndarray, length: int) -> np.ndarray:
        sums = self._sums(words)
        return _mixed((sums[length:] - sums[:-length]) * self.inverse[:len(words) - length + 1])

    def between(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hashes of the runs from ``starts`` to before ``stops``, signed."""
        sums = self._sums(words)
        return _mixed((sums[stops] - sums[starts]) * self.inverse[starts] + (stops - starts).astype(np.uint64)).view(np.int64)


_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 64


def words_of(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, one after the other, and where each text's words begin, with the end.

    Eight bytes are mixed in at a time; words of more than 64 bytes are hashed one by one."""
    size = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    bounds = np.frombuffer(texts.buffers()[1], size)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_BLANK[data]
    firsts, lasts = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    firsts[cuts] |= inside[1:-1][cuts]
    lasts[cuts - 1] |= inside[1:-1][cuts - 1]
    starts = np.flatnonzero(firsts)
    lengths = np.flatnonzero(lasts) + 1 - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    hashes = _mixed(lengths.astype(np.uint64) * np.uint64(_BASES[0]))
    todo, done = np.flatnonzero(lengths <= _LONG), 0
    while len(todo):
        part = eight[starts[todo] + done] & _FIRST_BYTES[np.minimum(lengths[todo] - done, 8)]
        hashes[todo] = _mixed((hashes[todo] ^ part) + np.uint64(_BASES[1]))
        done += 8
        todo = todo[lengths[todo] > done]
    for i in np.flatnonzero(lengths > _LONG):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + lengths[i]].tobytes())
    return hashes, np.searchsorted(starts, bounds)


def winnowed(words: np.ndarray, least: int, runs: _Runs) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of half a window, and for each window the run selected, the last one of equals."""
    half = max(least // 2, 1)
    hashes = runs(words, half)
    low, at, size, width = hashes, np.arange(len(hashes)), 1, least - half + 1
    while size < width:
        step = min(size, width - size)
        right = low[step:] <= low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        size += step
    return hashes.view(np.int64), at


def _some_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _groups(ends: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Neighbouring texts with about ``most`` words together; a longer text is a group of its own."""
    first = 0
    while first < len(ends) - 1:
        stop = max(int(np.searchsorted(ends, ends[first] + most, "right")) - 1, first + 1)
        yield first, stop
        first = stop


def _spans(least: int):
    """Places of fingerprints with the windows that selected them: of each the fingerprint, a hash of all words of its
    windows, the first window's start and how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = map(_Runs, _BASES)
        for batch in _some_rows(batches):
            words, ends = words_of(batch.column("b"))
            parts, n_spans = [], np.zeros(batch.num_rows, np.int64)
            for first, stop in _groups(ends):
                own = words[ends[first]:ends[stop]]
                if len(own) < least:
                    continue
                begins = ends[first:stop] - ends[first]
                n_windows = np.maximum(np.diff(ends[first:stop + 1]) - least + 1, 0)
                text = np.repeat(np.arange(stop - first), n_windows)
                windows = np.arange(len(text)) + (begins - np.cumsum(n_windows) + n_windows)[text]
                hashes, at = winnowed(own, least, one)
                new = np.flatnonzero(np.diff(at[windows], prepend=-1) > 0)
                starts, sizes = windows[new], np.diff(new, append=len(windows))
                n_spans[first:stop] = np.bincount(text[new], minlength=stop - first)
                parts.append((hashes[at[starts]], two.between(_mixed(own), starts, starts + sizes - 1 + least),
                              (starts - begins[text[new]]).astype(np.int32), sizes.astype(np.int32)))
            some = n_spans > 0
            offsets = pa.array(np.concatenate([[0], np.cumsum(n_spans[some])]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(column) if parts else [], kind))
                     for column, kind in zip(list(zip(*parts)) or [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key").filter(pa.array(some)), batch.column("at").filter(pa.array(some)), *lists],
                ["doc_key", "at", "mark", "span", "start", "size"])
    return run


def _span_windows(least: int):
    """The windows of some spans, each with two hashes of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = map(_Runs, _BASES)
        for batch in _some_rows(batches):
            rows, columns = [], []
            hashes, ends = words_of(batch.column("b"))
            for k, spans in enumerate(batch.column("spans")):
                words = hashes[ends[k]:ends[k + 1]]
                fields = spans.values
                first, size = (fields.field(name).to_numpy().astype(np.int64) for name in ("start", "size"))
                which = np.repeat(np.arange(len(size)), size)
                on = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]
                lows, highs = one(words, least)[on], two(_mixed(words), least)[on]
                rows.append(np.full(len(on), k))
                columns.append((fields.field("mark").to_numpy()[which], fields.field("span").to_numpy()[which],
                                (on - first[which]).astype(np.int32), on.astype(np.int32), lows.view(np.int64), highs.view(np.int64)))
            if rows:
                taken = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_no").take(taken), batch.column("doc_key").take(taken), *map(pa.array, map(np.concatenate, zip(*columns)))],
                    ["row_no", "doc_key", "mark", "span", "offset", "start", "low", "high"])
    return run


def cut_out(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int, int, int]:
    """Text without the words from ``starts`` to before ``stops``: lines that lose all their words go, others keep what is around. Also the numbers of
    lines with a word, of those that go, and of the words that go."""
    lines = text.split(b"\n")
    n_words = np.array([len(line.split()) for line in lines], np.int64)
    ends = np.cumsum(n_words)
    gone = np.zeros(ends[-1] + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, stops, -1)
    gone = np.cumsum(gone)[:-1] > 0
    n_before = np.concatenate([[0], np.cumsum(gone)])
    lost = n_before[ends] - n_before[ends - n_words]
    left = []
    for i, line in enumerate(lines):
        if not lost[i]:
            left.append(line)
        elif lost[i] < n_words[i]:
            out = gone[ends[i] - n_words[i]:ends[i]]
            spans = [m.span() for m in _WORD.finditer(line)]
            tails = [b for b, _ in spans[1:]] + [len(line)]
            kept = line[:spans[0][0]] + b"".join(line[a:end] for (a, _), end, cut in zip(spans, tails, out) if not cut)
            left.append(kept.rstrip() if out[-1] else kept)
    return b"\n".join(left), int((n_words > 0).sum()), len(lines) - len(left), int(gone.sum())


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column("b").to_pylist(), batch.column("runs")):
                if runs.is_valid:
                    start, size = (runs.values.field(name).to_numpy().astype(np.int64) for name in ("start", "size"))
                    rows.append(cut_out(text, start, start + size - 1 + least))
                else:
                    rows.append((text, len(lines_of(text)[1]), 0, 0))
            texts, n_lines, n_gone, n_words = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_key"), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(n_words, pa.int64()),
                 batch.column("first_keys"), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                ["doc_key", "n_lines", "n_removed_lines", "n_removed_words", "first_keys", "text"])
    return run


def _first_windows(rows: DataFrame, marked: DataFrame, each: DataFrame, min_words: int) -> DataFrame:
    """What stood before of the spans that share a fingerprint with other spans: (mark, span), ``offsets`` of the windows
    in the span's first place that stood somewhere before, ``keys`` of the documents that have those first. All windows
    of the other spans stand first in the span's first place."""
    contested = each.groupBy("mark").agg(F.count("*").alias("spans")).where("spans > 1").select("mark")
    rivals = each.join(stored(contested, "contested").hint("merge"), "mark").groupBy(F.col("first.row_no").alias("row_no")).agg(
        F.collect_list(F.struct(F.col("first.start").alias("start"), "size", "mark", "span")).alias("spans"))
    there = stored(marked.select("row_no", F.col("at").alias("there")).join(rivals, "row_no"), "rivals")
    kind = rows.schema["doc_key"].dataType.simpleString()
    windows = stored(map_batches(
        rows.join(there.hint("merge"), F.col("at") == F.col("there")).select("row_no", "doc_key", "b", "spans"), _span_windows(min_words),
        f"row_no bigint, doc_key {kind}, mark bigint, span bigint, offset int, start int, low bigint, high bigint"), "word-windows")
    position = F.struct("doc_key", "row_no", "start")
    first = windows.groupBy("low", "high").agg(F.min(position).alias("first"), F.count("*").alias("places")).where("places > 1")
    later = windows.join(stored(first.select("low", "high", "first"), "first-windows").hint("merge"), ["low", "high"]).where(
        ~position.eqNullSafe(F.col("first")))
    return later.groupBy("mark", "span").agg(F.collect_list("offset").alias("offsets"), F.collect_set("first.doc_key").alias("keys"))


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Windows of words that stood before, a row per document that has some: ``at`` (locator), ``runs`` of windows
    (number of the first one's first word, number of windows) and ``first_keys``."""
    rows = located(docs, key, text).select("doc_key", "at", utf8(F.col("body")).alias("b"))
    kind = rows.schema["doc_key"].dataType.simpleString()
    marked = numbered(map_batches(
        rows, _spans(min_words), f"doc_key {kind}, at struct<path:string,row:bigint>, mark array<bigint>, span array<bigint>, "
        "start array<int>, size array<int>"), "word-marks")
    several = marked.select(F.explode("mark").alias("mark")).groupBy("mark").agg(F.count("*").alias("places")).where("places > 1")
    places = marked.select("row_no", "doc_key", F.inline(F.arrays_zip("mark", "span", "start", "size")))
    shared = stored(places.join(stored(several.select("mark"), "repeated-marks").hint("merge"), "mark"), "shared-marks")
    position = F.struct("doc_key", "row_no", "start")
    each = stored(shared.groupBy("mark", "span").agg(F.min(position).alias("first"), F.first("size").alias("size")), "first-spans")
    windows = stored(_first_windows(rows, marked, each, min_words), "rival-windows")

    told = each.drop("size").join(windows.hint("merge"), ["mark", "span"], "left")
    own = position.eqNullSafe(F.col("first"))
    n_before = F.coalesce(F.size("offsets"), F.lit(0))
    first_key = F.array_compact(F.array("first.doc_key"))
    start = F.col("start")
    runs = F.when(own, F.transform("offsets", lambda i: F.struct((start + i).alias("start"), F.lit(1).alias("size")))).otherwise(
        F.array(F.struct("start", "size")))
    keys = F.when(own | (n_before == F.col("size")), F.col("keys")).when(n_before > 0, F.concat("keys", first_key)).otherwise(first_key)
    hit = shared.join(told.hint("merge"), ["mark", "span"]).where(~own | (n_before > 0)).select(
        "row_no", runs.alias("runs"), keys.alias("keys"))
    gathered = hit.groupBy("row_no").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.sort_array(F.flatten(F.collect_set("keys"))).alias("first_keys"))
    return gathered.join(marked.select("row_no", "at").hint("merge"), "row_no").select(
        "at", "runs", F.array_distinct("first_keys").alias("first_keys"))


def without_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """One row per document, as ``deduplicated``, without the words of all passages of ``min_words`` or more that stood
    before, wherever in lines they begin and end; n_removed_lines are lines that lose all their words."""
    runs = repeated_windows(docs, key, text, min_words).withColumnRenamed("at", "there")
    rows = located(docs, key, text)
    kind = rows.schema["doc_key"].dataType.simpleString()
    joined = rows.join(stored(runs, "word-runs").hint("merge"), F.col("at") == F.col("there"), "left").select(
        "doc_key", utf8(F.col("body")).alias("b"), "runs",
        F.coalesce("first_keys", F.array().cast(f"array<{kind}>")).alias("first_keys"))
    return map_batches(
        joined, _cut(min_words), f"doc_key {kind}, n_lines bigint, n_removed_lines bigint, n_removed_words bigint, "
        f"first_keys array<{kind}>, text string").withColumnRenamed("doc_key", key)
