"""Quality rules: a decision list learned by sequential covering, emitted as one conditional expression.

Rules are conjunctions of thresholds on text statistics. A rule is grown on two thirds of the labelled rows
by information gain, pruned on the last third, and taken if it is precise there; the rows it covers leave and
the next rule is grown. The ordered rules become ``CASE WHEN`` branches, so scoring stays in Spark's own code.

Null text counts as empty. Rows without a label teach nothing. With no labelled rows of both kinds the list is
empty and keeps all that the base rules keep. Rows with the same key are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import BLANKS, stored, utf8

SYMBOLS = "#*$%&|<>"
WINDOW = 5
_NOT_UPPER = bytes(set(range(256)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_NOT_MARKS = bytes(set(range(256)) - set(b"!?@~^=+_\\/[]{}`"))

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
STAT_TYPE = T.StructType([T.StructField(s, T.LongType()) for s in STATISTICS])
#: What the rules compare: shares, so that thresholds learned on short texts hold for long ones.
FEATURES = {
    "n_words": "CAST({s}n_words AS DOUBLE)",
    "word_length": "{s}word_chars / greatest({s}n_words, 1)",
    "symbol_share": "{s}n_symbols / greatest({s}word_chars, 1)",
    "mark_share": "{s}n_marks / greatest({s}word_chars, 1)",
    "upper_share": "{s}n_upper / greatest({s}word_chars, 1)",
    "dup_line_share": "{s}n_dup_lines / greatest({s}n_lines, 1)",
    "repeat_share": "{s}n_repeat_words / greatest({s}n_words, 1)",
}


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of five words found at two places or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    count, covered, upto = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if count[window] > 1:
            covered += at + WINDOW - max(at, upto)
            upto = at + WINDOW
    return covered


def statistics_of(data: bytes) -> tuple[int, ...]:
    text, words = data.decode("utf-8", "replace"), data.split()
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), len(lines),
        len(data.translate(None, _NOT_UPPER)), len(data.translate(None, _NOT_MARKS)),
    )


@F.arrow_udf(STAT_TYPE)
def _statistics(texts: pa.Array) -> pa.Array:
    rows = [statistics_of(t) for t in texts.to_pylist()]
    columns = list(zip(*rows)) if rows else [()] * len(STATISTICS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(STATISTICS))


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text."""
    return _statistics(utf8(text))


def features(prefix: str = "") -> list[Column]:
    return [F.expr(e.format(s=prefix)).alias(name) for name, e in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values >= self.threshold if self.at_least else values < self.threshold

    def column(self, prefix: str) -> Column:
        value = F.expr(FEATURES[self.feature].format(s=prefix))
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects the text."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self, prefix: str = "") -> Column:
        """Number of the first rule that holds, from 1; 0 if none does."""
        verdict = F.lit(0)
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            holds = F.lit(True)
            for condition in rule:
                holds = holds & condition.column(prefix)
            verdict = F.when(holds, F.lit(number)).otherwise(verdict)
        return verdict

    def keeps(self, prefix: str = "") -> Column:
        return self.rule_number(prefix) == 0


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -1.0)


def _best(rows: dict[str, np.ndarray], bad: np.ndarray, cuts: int) -> tuple[Condition, float]:
    """The condition that gains most. Thresholds lie between neighbouring values, at quantiles of both classes."""
    p0, n0, best = int(bad.sum()), int((~bad).sum()), (Condition("n_words", True, -np.inf), 0.0)
    for name, values in rows.items():
        marks = np.linspace(0, 1, cuts)
        edges = np.unique(np.concatenate([np.quantile(values[k], marks, method="nearest") for k in (bad, ~bad) if k.any()]))
        if len(edges) < 2:
            continue
        middle = (edges[1:] + edges[:-1]) / 2
        of_bad, of_good = np.sort(values[bad]), np.sort(values[~bad])
        below_p, below_n = np.searchsorted(of_bad, middle), np.searchsorted(of_good, middle)
        for at_least, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gains = _gain(p.astype(float), n.astype(float), p0, n0)
            k = int(np.argmax(gains))
            if gains[k] > best[1] + 1e-9:
                best = (Condition(name, at_least, float(middle[k])), float(gains[k]))
    return best


def _covered(rule: tuple[Condition, ...], rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    holds = np.ones(n, bool)
    for condition in rule:
        holds &= condition.holds(rows)
    return holds


def cover(rows: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, support: int = 5,
          longest: int = 4, cuts: int = 64, most_rules: int = 24) -> DecisionList:
    """Sequential covering. ``rows`` has the features in a stable order; ``bad`` marks the rows to reject."""
    order = np.arange(len(bad)) % 3 < 2  # rows come in the order of a hash
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules:
        grow, prune = left & order, left & ~order
        inside, rule = grow.copy(), ()
        while len(rule) < longest and bad[inside].any() and not bad[inside].all():
            condition, gain = _best({k: v[inside] for k, v in rows.items()}, bad[inside], cuts)
            if gain <= 0:
                break
            rule += (condition,)
            inside &= condition.holds(rows)
        scores = []
        for size in range(1, len(rule) + 1):
            held = _covered(rule[:size], rows, len(bad)) & prune
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            scores.append((p - n) / max(p + n, 1))
        if not scores:
            break
        rule = rule[: int(np.argmax(scores)) + 1]
        held = _covered(rule, rows, len(bad)) & left
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        checked = held & prune
        if p < support or p < precision * (p + n) or (checked & bad).sum() < precision * checked.sum():
            break
        rules.append(rule)
        left &= ~held
    return DecisionList(tuple(rules))


def sampled(labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled keys, those with the smallest hash: ``key`` and ``label_``."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    return known.select(F.col(key).alias(key), F.col(label).alias("label_")).orderBy(
        F.xxhash64(key), key, "label_").limit(most)


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
          max_labelled: int = 20_000, **options) -> DecisionList:
    """Learn from labelled statistics; ``label`` 0 marks rows to reject.

    ``max_labelled`` bounds the sample that the driver fits on: the labelled keys with the smallest hash, and
    as many rows at most where keys repeat.
    """
    labelled = stats.join(F.broadcast(sampled(labels, key, label, max_labelled)), key)
    sample = labelled.select(F.xxhash64(key).alias("h"), F.col(key).alias("k"), "label_", *features()).orderBy(
        "h", "k", "label_", *FEATURES).limit(max_labelled).toPandas()
    bad = (sample["label_"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return DecisionList(())
    return cover({f: sample[f].to_numpy(dtype=float) for f in FEATURES}, bad, **options)


def base_failed(prefix: str = "") -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 10) | (100 * repeated > 20 * n)


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Statistics and verdict per row: key, statistics, ``base_failed``, ``rule`` (0: none) and ``kept``."""
    stats = stored(docs.select(F.col(key).alias(key), statistics(F.col(text)).alias("s")).select(key, "s.*"), "quality")
    rules = learn(stats, labels, key, **options)
    return stats.select(
        "*", base_failed().alias("base_failed"), rules.rule_number().alias("rule"),
        (~base_failed() & rules.keeps()).alias("kept"))


def filtered(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             max_labelled: int = 20_000, **options) -> DataFrame:
    """``docs`` without the rejected rows; columns as before. Learns on the sample of labelled rows, then judges."""
    sample = sampled(labels, key, label, max_labelled)
    known = docs.select(key, text).join(F.broadcast(sample.select(key)), key, "left_semi")
    stats = known.select(key, statistics(F.col(text)).alias("s")).select(key, "s.*")
    rules = learn(stats, labels, key, label, max_labelled, **options)
    whole = docs.select(F.struct("*").alias("d"), statistics(F.col(text)).alias("s"))
    return whole.where(~base_failed("s.") & rules.keeps("s.")).select("d.*")
