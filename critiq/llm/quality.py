"""Operator 13: document quality by learned decision lists.

Every text is described by a few statistics (words, their lengths, symbols, repeated
lines, words and windows, capitals, digits, punctuation). From labelled rows a list of
rules for the rarer label is learned by sequential covering:

* a rule is grown on two thirds of the rows, one threshold condition after the other,
  each the one with the largest FOIL gain, until it covers no row of the other label;
* it is pruned on the last third: its final conditions go as long as that does not
  lower (hits - misses) / (hits + misses) there;
* the rows it covers go, and the next rule is learned from the rest, until a rule is
  not precise enough on the last third or covers too little.

The list becomes one ordered Spark conditional expression over the statistics: the
first rule that holds gives the verdict, the default is the other label.

The sample is at most SAMPLE labelled rows, the smallest hashes of their ids; all
statistics are computed over whole texts and the rules apply to every document.

Null and empty texts have no words and fail the base rules, as do texts of under 50
words and those in which repeated 3-word windows hold more than half of the words.
Of several labels of a doc_id the smallest counts; labels other than 0 and 1 and null
ids teach nothing; without both labels the list is empty and keeps all that the base
rules leave. Repeated rows get a row each; an empty table gives no rows. Further
columns are kept, and added columns get underscores before names that exist already.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, add_columns, free_name

#: Labelled rows to learn from, at most.
SAMPLE = 20_000
#: Thresholds tried per statistic and condition; conditions of a rule and rules of a list, at most.
THRESHOLDS, CONDITIONS, RULES = 64, 4, 24
#: Least precision of a rule on the rows it is pruned on, and least number of rows it covers there.
PRECISION, COVER = 0.9, 5
MIN_WORDS, MAX_REPEATED = 50, 50

# White space and symbols of the contract, ASCII capitals, digits and punctuation.
WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CAPITALS, SMALL, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_GAP = re.compile(rb"[\x20\x09-\x0D]")

#: Whole-text counts, in the order in which ``count_text`` gives them.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct", "n_top_word", "n_capitals", "n_letters", "n_digits", "n_marks")

#: Statistics that conditions may test: name, counted part and its whole.
RATIOS = (("word_length", "word_chars", "n_words"), ("symbols", "n_symbols", "n_words"), ("dup_lines", "n_dup_lines", "n_lines"),
          ("repeated", "n_repeat_words", "n_words"), ("distinct", "n_distinct", "n_words"), ("top_word", "n_top_word", "n_words"),
          ("capitals", "n_capitals", "n_letters"), ("digits", "n_digits", "word_chars"), ("marks", "n_marks", "n_words"),
          ("line_words", "n_words", "n_lines"))
STATISTICS = ("n_words", *(r[0] for r in RATIOS))


def word_numbers(text: bytes, piece: int = 1 << 20) -> np.ndarray:
    """The words of a text as numbers, equal for equal words; long texts are read in pieces."""
    number = defaultdict(count().__next__)
    out, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + piece) if at + piece < len(text) else None
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        out.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    base = int(ids.max()) + 1
    if base < 1 << 20:
        window = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        window = np.unique(ids[:-2] << 32 | ids[1:-1], return_inverse=True)[1] << 32 | ids[2:]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if len(twice) == 0:
        return 0
    again = np.isin(window, twice)
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i:n - 2 + i] |= again
    return int(inside.sum())


def _without(text: bytes, chars: bytes) -> int:
    """How many of the characters a text has."""
    return len(text) - len(text.translate(None, chars))


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of a text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    ids = word_numbers(raw)
    seen: set[bytes] = set()
    lines = doubles = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            doubles += line in seen
            seen.add(line)
    occurrences = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    capitals = _without(raw, CAPITALS)
    return (len(ids), len(text) - _without(raw, WHITE), _without(raw, SYMBOLS), doubles, repeated_words(ids), lines,
            len(occurrences) if len(ids) else 0, int(occurrences.max()), capitals, capitals + _without(raw, SMALL),
            _without(raw, DIGITS), _without(raw, MARKS))


def with_counts(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with a column per count, and the names these columns got."""
    names = {c: free_name(docs, c) for c in COUNTS}

    def verdicts(texts: list[str | None]) -> list[pa.Array]:
        found = np.array([count_text(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return [pa.array(np.ascontiguousarray(found[:, i])) for i in range(len(COUNTS))]

    return add_columns(docs, "text", [(c, "long") for c in COUNTS], verdicts), names


def statistic(name: str, names: dict[str, str]) -> Column:
    """A statistic as an expression over the count columns; 0 where there is nothing to divide by."""
    if name in names:
        return F.col(names[name]).cast("double")
    _, part, whole = next(r for r in RATIOS if r[0] == name)
    return F.when(F.col(names[whole]) > 0, F.col(names[part]) / F.col(names[whole])).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] >= self.threshold if self.above else x[self.name] < self.threshold

    def expression(self, names: dict[str, str]) -> Column:
        s = statistic(self.name, names)
        return s >= self.threshold if self.above else s < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order, the label they give, and how many rows of each label they hit where they were pruned."""

    label: int = 0
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    precision: list[float] = field(default_factory=list)

    def rule(self, names: dict[str, str]) -> Column:
        """Number of the first rule that holds, from 1; null where none does."""
        out = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            test = F.lit(True)
            for c in self.rules[i - 1]:
                test = test & c.expression(names)
            out = F.when(test, F.lit(i)).otherwise(out)
        return out

    def keeps(self, names: dict[str, str]) -> Column:
        """Is the label 1?"""
        return (self.rule(names).isNull() if self.label == 0 else self.rule(names).isNotNull()) if self.rules else F.lit(True)

    def verdicts(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.zeros(len(next(iter(x.values()))), bool)
        for r in self.rules:
            hit |= np.logical_and.reduce([c.holds(x) for c in r])
        return np.where(hit, self.label, 1 - self.label) if self.rules else np.ones(len(hit), np.int64)

    def __str__(self) -> str:
        lines = [f"{i}. if {' and '.join(map(str, r))}: {self.label} ({p:.3f})" for i, (r, p) in enumerate(zip(self.rules, self.precision), 1)]
        return "\n".join([*lines, f"otherwise: {1 - self.label if self.rules else 1}"])


def _thresholds(values: np.ndarray) -> np.ndarray:
    """Middles between neighbouring values, or between as many quantiles where there are more."""
    levels = np.unique(values)
    if len(levels) > THRESHOLDS:
        levels = np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS), method="nearest"))
    return (levels[1:] + levels[:-1]) / 2


def best_condition(x: dict[str, np.ndarray], hit: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the largest FOIL gain over rows ``x``, of which ``hit`` have the wanted label."""
    before = math.log2(max(int(hit.sum()), 1) / max(len(hit), 1))
    best: tuple[float, Condition | None] = (1e-9, None)
    for name in STATISTICS:
        cuts = _thresholds(x[name])
        if len(cuts) == 0:
            continue
        wanted, other = np.sort(x[name][hit]), np.sort(x[name][~hit])
        for above in (True, False):
            p, n = np.searchsorted(wanted, cuts, "left").astype(float), np.searchsorted(other, cuts, "left").astype(float)
            if above:
                p, n = len(wanted) - p, len(other) - n
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -np.inf)
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-9:
                best = (float(gain[at]), Condition(name, above, float(cuts[at])))
    return best


def grow(x: dict[str, np.ndarray], wanted: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    rows = np.arange(len(wanted))
    while len(rule) < CONDITIONS and not wanted[rows].all():
        _, found = best_condition({k: v[rows] for k, v in x.items()}, wanted[rows])
        if found is None:
            break
        rule.append(found)
        rows = rows[found.holds({k: v[rows] for k, v in x.items()})]
    return rule


def prune(rule: list[Condition], x: dict[str, np.ndarray], wanted: np.ndarray) -> tuple[list[Condition], int, int]:
    """The beginning of a rule that does best on ``x``, the shortest of equals, with its hits and misses."""
    best, kept = (-math.inf, 0, 0), rule
    covered = np.ones(len(wanted), bool)
    for size, c in enumerate(rule, 1):
        covered &= c.holds(x)
        hits, misses = int((covered & wanted).sum()), int((covered & ~wanted).sum())
        worth = (hits - misses) / (hits + misses) if hits + misses else -1.0
        if worth > best[0] + 1e-12:
            best, kept = (worth, hits, misses), rule[:size]
    return kept, best[1], best[2]


def learn(x: dict[str, np.ndarray], label: np.ndarray, third: np.ndarray) -> DecisionList:
    """Sequential covering; rows with ``third`` true are for pruning."""
    ones, zeros = int((label == 1).sum()), int((label == 0).sum())
    if not ones or not zeros:
        return DecisionList()
    out = DecisionList(label=0 if zeros <= ones else 1)
    wanted, left = label == out.label, np.ones(len(label), bool)
    while len(out.rules) < RULES:
        growing, pruning = left & ~third, left & third
        if not wanted[growing].any() or not wanted[pruning].any():
            break
        rule = grow({k: v[growing] for k, v in x.items()}, wanted[growing])
        if not rule:
            break
        rule, hits, misses = prune(rule, {k: v[pruning] for k, v in x.items()}, wanted[pruning])
        if hits + misses < COVER or hits < PRECISION * (hits + misses):
            break
        out.rules.append(tuple(rule))
        out.precision.append(hits / (hits + misses))
        left &= ~np.logical_and.reduce([c.holds(x) for c in rule])
    return out


def base_failed(names: dict[str, str]) -> Column:
    words, again = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < MIN_WORDS) | (again * 100 > words * MAX_REPEATED)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Statistics, label and part of at most ``rows`` labelled rows that the base rules leave."""
    stages = Stages(docs.sparkSession, "quality")
    marked = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most ``rows`` rows of two numbers are broadcast.
    own = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counted, names = with_counts(own)
    columns = [statistic(s, names).alias(s) for s in STATISTICS]
    found = counted.where(~base_failed(names)).select("doc_id", "quality", *columns)
    found = found.withColumn("text_hash", F.xxhash64("doc_id", *STATISTICS))
    # Repeated doc_ids may give more rows than were chosen: one row each.
    found = found.groupBy("doc_id").agg(F.min(F.struct("text_hash", "quality", *STATISTICS)).alias("r"))
    found = stages.save(found.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)).alias("part"), "r.*"), "sample")
    data = found.orderBy("doc_id").toArrow()
    stages.drop(found)
    x = {s: data.column(s).to_numpy() for s in STATISTICS}
    return x, data.column("quality").to_numpy(), data.column("part").to_numpy() == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DecisionList:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks 0 or 1."""
    return learn(*sample(docs, labels, rows))


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` with the counts, base_failed, rule (the first that holds, or null) and kept."""
    counted, names = with_counts(docs)
    failed, rule, kept = (free_name(docs, c) for c in ("base_failed", "rule", "kept"))
    out = counted.withColumn(failed, base_failed(names)).withColumn(rule, rules.rule(names))
    return out.withColumn(kept, ~F.col(failed) & rules.keeps(names))
