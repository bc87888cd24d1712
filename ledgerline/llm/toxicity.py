"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer turns words into symbols: insult (with a weight), threat, target, negation, reported speech, other.
It is a trie of word beginnings: a few fixed words, and the beginnings and whole words that labelled texts show to be
toxic, however they are inflected. Three more transducers rewrite the symbols: one weakens what stands within three
words of a negation, one what stands in quotes or after a verb of saying, and one gathers a clause and says at its end
what was matched: a bare insult, an insult with a target, a negated one, a reported one, a threat with a target, or a
weakened threat. They are composed into one machine with one step per word. A clause adds the weights on its path to its
kind of match; a logistic regression over the kinds gives the score. A word outside a matching clause counts nothing.

Everything is learned from labelled rows alone; language, source and key are never looked at. Null and empty texts have
no clause and get the lowest score there is. Keys that are labelled more than once are toxic if any label says so; rows
with the same key are scored one by one. Texts are read whole, ``CHUNK`` characters at a time. Without labelled rows of
both kinds the fixed words and the starting weights decide. Columns other than the named ones are never looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import map_batches, stored

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, BREAK, STOP = range(9)
#: Symbols between the machines: weakened insults and threats.
NEGATED_INSULT, REPORTED_INSULT, WEAK_THREAT = 9, 10, 11
#: What the last machine says at the end of a clause.
KINDS = ("plain", "targeted", "negated", "reported", "threat", "weak_threat")
#: Totals by kind; the heaviest clause and the three heaviest words of clauses that nothing weakens; weight per 100 words.
FEATURES = (*KINDS, "strongest", "surest", "density")

FIXED = {
    INSULT: "idiot idiots moron morons imbecile stupid scum scumbag loser losers worthless pathetic disgusting "
            "arschloch dummkopf abschaum versager connard salaud abruti ordure idiota imbécil estúpido basura cabrón",
    THREAT: "kill murder stab strangle shoot hurt töten umbringen erwürgen tuer égorger étrangler matar asesinar apuñalar",
    TARGET: "you your yours yourself u ya he him she her they them these those du dich dir euch ihr sie tu te toi vous ils "
            "elles tú ti usted ustedes ellos ellas",
    NEGATION: "not no never nor isn aren wasn don doesn didn without nicht kein keine keiner nie niemals ohne pas jamais "
              "aucun aucune sans nunca jamás ningún ninguna sin",
    REPORT: "said says say told tells called calls wrote writes claimed claims quoted alleged sagte sagt schrieb nannte "
            "behauptete dit disait écrit appelé prétend dijo dice escribió llamó afirmó",
}
FIXED_WEIGHT = 3.0
THREAT_WEIGHT = 4.0
SCOPE = 3  # words after a negation
SHORTEST, LONGEST = 3, 12  # beginnings of words
CHUNK = 1 << 18
_TOKEN = re.compile(r"\w+|[\"«»“”„]|[.!?]+|[,;:()\n]")
_MARKS = {**dict.fromkeys("\"«»“”„", QUOTE), **dict.fromkeys(".!?", STOP), **dict.fromkeys(",;:()\n", BREAK)}
_REMEMBERED, _LONG_WORD = 200_000, 40


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``step(state, symbol)`` gives the next state and the symbol it writes. States are tuples."""

    start: tuple
    step: Callable[[tuple, int], tuple[tuple, int]]

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: ``other`` reads what this one writes."""
        def step(state: tuple, symbol: int) -> tuple[tuple, int]:
            mine, written = self.step(state[0], symbol)
            theirs, out = other.step(state[1], written)
            return (mine, theirs), out
        return Transducer((self.start, other.start), step)

    def compiled(self, symbols: Iterable[int]) -> list[list[tuple[int, int]]]:
        """Table of all states that can be reached: row per state, (next row, written symbol) per symbol."""
        number, table = {self.start: 0}, []
        waiting = deque([self.start])
        while waiting:
            state, row = waiting.popleft(), []
            for symbol in symbols:
                after, out = self.step(state, symbol)
                if after not in number:
                    number[after] = len(number)
                    waiting.append(after)
                row.append((number[after], out))
            table.append(row)
        return table


def _negation(state: tuple, symbol: int) -> tuple[tuple, int]:
    left, = state
    if symbol in (BREAK, STOP):
        return (0,), symbol
    if symbol == NEGATION:
        return (SCOPE,), OTHER
    if left:
        symbol = {INSULT: NEGATED_INSULT, THREAT: WEAK_THREAT}.get(symbol, symbol)
    return (max(left - 1, 0),), symbol


def _report(state: tuple, symbol: int) -> tuple[tuple, int]:
    after_verb, in_quotes = state
    if symbol == STOP:
        return (False, False), symbol
    if symbol == REPORT:
        return (True, in_quotes), OTHER
    if symbol == QUOTE:
        return (after_verb, not in_quotes), OTHER
    if after_verb or in_quotes:
        symbol = {INSULT: REPORTED_INSULT, THREAT: WEAK_THREAT}.get(symbol, symbol)
    return state, symbol


def _clause(state: tuple, symbol: int) -> tuple[tuple, int]:
    """Writes 0, or at the end of a clause the number of its kind, from 1."""
    target, insult, threat = state
    if symbol in (BREAK, STOP):
        kind = 0
        if threat == THREAT and target:
            kind = KINDS.index("threat") + 1
        elif insult == INSULT:
            kind = KINDS.index("targeted" if target else "plain") + 1
        elif insult:
            kind = KINDS.index("negated" if insult == NEGATED_INSULT else "reported") + 1
        elif threat == WEAK_THREAT and target:
            kind = KINDS.index("weak_threat") + 1
        return (False, 0, 0), kind
    if symbol == TARGET:
        target = True
    elif symbol in (INSULT, NEGATED_INSULT, REPORTED_INSULT):
        insult = INSULT if INSULT in (insult, symbol) else symbol
    elif symbol in (THREAT, WEAK_THREAT):
        threat = THREAT if THREAT in (threat, symbol) else symbol
    return (target, insult, threat), 0


def grammar() -> list[list[tuple[int, int]]]:
    """The three machines as one table over the nine symbols of words and marks."""
    machine = Transducer((0,), _negation).then(Transducer((False, False), _report)).then(Transducer((False, 0, 0), _clause))
    return machine.compiled(range(STOP + 1))


class Lexicon(dict):
    """Symbol of a token; ``weight`` of an insult. Answers are remembered up to a bound of words of bounded length."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned
        self.fixed = {w: symbol for symbol, words in FIXED.items() for w in words.split()}

    def weight(self, token: str) -> float:
        """The largest weight of the word or its beginnings; a whole word has a blank at its end."""
        known = [FIXED_WEIGHT] if self.fixed.get(token) == INSULT else []
        known += [self.learned[b] for b in beginnings(token) if b in self.learned]
        return max(known, default=0.0)

    def __missing__(self, token: str) -> int:
        symbol = _MARKS.get(token[0])
        if symbol is None:
            symbol = self.fixed.get(token, OTHER)
            if symbol == OTHER and self.weight(token) > 0:
                symbol = INSULT
        if len(token) <= _LONG_WORD:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[token] = symbol
        return symbol


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + ([word + " "] if len(word) <= _LONG_WORD else [])


def chunks(text: str) -> Iterator[str]:
    """Pieces of about ``CHUNK`` characters that end before a blank or a mark, never inside a word."""
    at = 0
    while at < len(text):
        end = re.compile(r"\W").search(text, at + CHUNK)
        upto = end.start() if end else len(text)
        yield text[at:upto]
        at = upto


class Scanner:
    """Clause totals of texts: the numbers of ``FEATURES`` and the number of words."""

    def __init__(self, learned: dict[str, float]):
        self.lexicon, self.table = Lexicon(learned), grammar()

    def _sentence(self, symbols: bytes, weights: deque, totals: list[float], surest: list[float]) -> None:
        state, arcs = 0, []
        for symbol in symbols + bytes([STOP]):
            if symbol == INSULT:
                arcs.append(weights.popleft())
            elif symbol == THREAT:
                arcs.append(THREAT_WEIGHT)
            state, kind = self.table[state][symbol]
            if kind:
                totals[kind - 1] += sum(arcs)
                if KINDS[kind - 1] in ("plain", "targeted", "threat"):
                    totals[-1] = max(totals[-1], sum(arcs))
                    surest[:] = sorted([*surest, *arcs], reverse=True)[:3]
            if symbol in (BREAK, STOP):
                arcs = []

    def scan(self, text: str) -> list[float]:
        totals, surest, words = [0.0] * (len(KINDS) + 1), [], 0
        open_symbols, open_weights = b"", []
        lexicon = self.lexicon
        for chunk in chunks(text):
            tokens = _TOKEN.findall(chunk.lower())
            symbols = bytes(map(lexicon.__getitem__, tokens))
            words += len(symbols) - symbols.count(BREAK) - symbols.count(STOP) - symbols.count(QUOTE)
            if INSULT in symbols:
                open_weights += [lexicon.weight(t) for t, s in zip(tokens, symbols) if s == INSULT]
            *whole, open_symbols = (open_symbols + symbols).split(bytes([STOP]))
            open_weights = self._sentences(whole, deque(open_weights), totals, surest)
        self._sentences([open_symbols], deque(open_weights), totals, surest)
        heavy = sum(totals[:-1])
        return [*map(math.log1p, totals[:-1]), totals[-1], sum(surest), math.log1p(100 * heavy / max(words, 1))]

    def _sentences(self, sentences: list[bytes], weights: deque, totals: list[float], surest: list[float]) -> list[float]:
        """Weights that are left over: those of the sentence that goes on."""
        for symbols in sentences:
            if INSULT in symbols or THREAT in symbols:
                self._sentence(symbols, weights, totals, surest)
        return list(weights)


FEATURE_TYPE = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])


def features(text: Column, learned: dict[str, float]) -> Column:
    """Struct of the clause totals of a text."""
    made: list[Scanner] = []

    @F.arrow_udf(FEATURE_TYPE)
    def scanned(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Scanner(learned))
        rows = [made[0].scan(t.as_py() or "") for t in texts]
        columns = list(zip(*rows)) if rows else [()] * len(FEATURES)
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], list(FEATURES))

    return scanned(text)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that have a beginning of a word, by label; sent whenever many are held."""
    held = Counter(), Counter()

    def sent() -> pa.RecordBatch:
        names = list(held[0].keys() | held[1].keys())
        out = pa.record_batch({"entry": pa.array(names, pa.string()), **{
            c: pa.array([held[i][n] for n in names], pa.int64()) for i, c in enumerate(("n_clean", "n_toxic"))}})
        for h in held:
            h.clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column("body"), batch.column("toxic")):
            words = {w for chunk in chunks(text.as_py() or "") for w in _TOKEN.findall(chunk.lower()) if w.isalpha()}
            held[toxic.as_py()].update({b for w in words for b in beginnings(w)})
            if len(held[0]) + len(held[1]) > 300_000:
                yield sent()
    yield sent()


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]
    intercept: float

    def score(self, text: Column) -> Column:
        found = features(text, self.lexicon)
        # one evaluation of the function, whatever is taken from it
        return F.transform(F.array(found), lambda x: 1 / (1 + F.exp(-sum(
            (x[f] * w for f, w in zip(FEATURES, self.weights)), F.lit(self.intercept)))))[0]


#: Weights of the features before any text is seen; the fit is drawn to them.
START = (0.6, 0.8, 0.1, 0.1, 1.0, 0.1, 0.1, 0.3, 0.6)
START_INTERCEPT = -4.0


def fitted(x: np.ndarray, toxic: np.ndarray, share: float, ridge: float = 1.0, rounds: int = 30) -> tuple[tuple[float, ...], float]:
    """Logistic regression by Newton steps, rows weighted to the share of toxic rows, weights drawn to ``START``."""
    start = np.array([START_INTERCEPT, *START])
    if not toxic.any() or toxic.all():
        return START, START_INTERCEPT
    n, k = len(toxic), int(toxic.sum())
    weight = np.where(toxic, share * n / k, (1 - share) * n / (n - k))
    rows, beta = np.column_stack([np.ones(n), x]), start.copy()
    pull = np.full(len(start), ridge)
    pull[0] = ridge / 10

    def loss(b):
        z = rows @ b
        return float(weight @ (np.logaddexp(0, z) - toxic * z) + pull @ (b - start) ** 2 / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weight * (p - toxic)) + pull * (beta - start)
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + np.diag(pull)
        step, scale = np.linalg.solve(bend, slope), 1.0
        while scale > 1e-4 and loss(beta - scale * step) > loss(beta):
            scale /= 2
        beta = beta - scale * step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, beta[1:])), float(beta[0])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_labelled: int = 10_000, max_entries: int = 20_000, trust: float = 8.0, least: float = 1.5) -> Model:
    """Learn lexicon and weights from labelled rows.

    ``max_labelled`` bounds the sample of each label (the keys with the smallest hash), ``max_entries`` the lexicon. Two
    thirds of the sample show the toxic words, the last third the weights of the clauses. A word's weight is the rise of
    the log odds of a toxic text, drawn to none by ``trust`` texts; ``least`` is the smallest that counts.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("doc_key")).agg(
        F.max((F.col(label) == 1).cast("int")).alias("toxic"))
    counts = dict(known.groupBy("toxic").count().collect())
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    drawn = known.withColumn("h", F.xxhash64("doc_key"))
    sample = drawn.where("toxic = 1").orderBy("h", "doc_key").limit(max_labelled).unionByName(
        drawn.where("toxic = 0").orderBy("h", "doc_key").limit(max_labelled))
    texts = stored(docs.select(F.col(key).alias("doc_key"), F.col(text).alias("body")).join(F.broadcast(sample), "doc_key"), "labelled")
    for_words = texts.where(F.pmod("h", F.lit(3)) < 2)
    base = max(share, 1e-6)
    drawn_counts = {r["toxic"]: r["count"] for r in for_words.groupBy("toxic").count().collect()}
    n_toxic, n_clean = drawn_counts.get(1, 0), drawn_counts.get(0, 0)
    lexicon = {}
    if n_toxic and n_clean:
        # clean texts count as many as there are for each toxic one outside the sample
        scale = (1 - base) / base * n_toxic / n_clean
        entries = map_batches(for_words.select("body", "toxic"), _counted, "entry string, n_clean bigint, n_toxic bigint")
        odds = entries.groupBy("entry").agg(F.sum("n_toxic").alias("t"), (F.sum("n_clean") * scale).alias("c")).where("t > 1")
        q = (F.col("t") + trust * base) / (F.col("t") + F.col("c") + trust)
        rise = odds.withColumn("weight", F.log(q / (1 - q)) - float(np.log(base / (1 - base)))).where(F.col("weight") >= least)
        lexicon = {r["entry"]: r["weight"] for r in rise.orderBy(F.desc("weight"), "entry").limit(max_entries).collect()}
    rest = texts.where(F.pmod("h", F.lit(3)) == 2)
    if rest.where("toxic = 1").limit(5).count() < 5:
        rest = texts  # too few to hold any back
    rows = rest.select("h", "toxic", features(F.col("body"), lexicon).alias("f")).select("toxic", "f.*").toPandas()
    weights, intercept = fitted(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["toxic"].to_numpy(bool), share)
    return Model(lexicon, weights, intercept)


def held_out(key: Column) -> Column:
    """Rows that are never learned from: remainder 1 of the CRC-32 of the key as text; a row without a key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           at_least: float = 0.7, **options) -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` per row; labels of held-out keys are not used."""
    model = learn(docs, labels.where(~held_out(F.col(key))), key, text, label, **options)
    scores = docs.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), model.score(F.col(text)).alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= at_least).cast("int"))
