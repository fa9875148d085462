"""Operator 9: toxicity by a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms and look-alike letters of
other scripts to Latin ones, accents and zero-width characters away, digits and
signs that stand for letters to those letters. What is then no letter separates
words.

The lexicon is learned from labelled rows, a bounded sample of them (SAMPLE rows
with the smallest hash of their id; each text once): word beginnings of 4 to 10
letters that toxic texts hold far more often than others, by a cautious estimate of
the log-odds, which is the weight. Phrases of two words around a lexicon word that
appear in clean texts only become exceptions: matches inside them do not count.

The score is the sum of weights per word of the text (with a constant added to the
length), scaled so that 0.7 lies where the F1 over the sample is best.

Null and empty texts, and all texts where nothing was learned, have score 0. Null
labels teach nothing; of several labels of a doc_id the largest counts; repeated
rows get a row each; empty tables give no rows. Further columns are kept as they are.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, add_columns, map_arrow, slices

#: Labelled rows to learn from, at most; lexicon entries and exceptions, at most.
SAMPLE = 20_000
LEXICON = 5_000
#: Shortest and longest word beginnings in the lexicon.
SHORT, LONG = 4, 10
#: Share of the toxic texts that must hold an entry, and its least cautious odds.
LEAST_SHARE, LEAST_ODDS = 0.01, 8.0
#: Words added to a text's length.
PRIOR_WORDS = 50
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and the signs used for letters.
# i, l, 1 and | are one letter here, since 1 stands for both.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "ɑ": "a", "ɡ": "g",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i", "l": "i"}
ZERO_WIDTH = "​‌‍⁠﻿­"


class _Folding(dict):
    """Code point to its folded letters, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c in ZERO_WIDTH:
            out = ""
        else:
            out = "".join(self._letter(x) for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x))
            out = out or ("" if unicodedata.combining(c) else " ")
        self[code] = out
        return out

    @staticmethod
    def _letter(c: str) -> str:
        c = SIGNS.get(c) or LOOKALIKES.get(c) or c
        return c if c.isalpha() else " "


FOLDING = _Folding()


def fold(text: str) -> list[str]:
    """Folded words of a text."""
    return text.translate(FOLDING).split()


@dataclass
class Lexicon:
    weight: dict[str, float] = field(default_factory=dict)  # word beginning: weight
    exceptions: list[str] = field(default_factory=list)  # two folded words
    scale: float = 0.0  # density with score 1/2

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for stem, w in self.weight.items():
            a.add_word(f" {stem}", (len(stem), w))
        for phrase in self.exceptions:
            a.add_word(f" {phrase} ", (len(phrase) + 1, None))
        a.make_automaton()
        return a

    def score(self, density: float) -> float:
        return density / (density + self.scale) if self.scale > 0 else 0.0


def matches(automaton, words: list[str]) -> list[tuple[int, int, float]]:
    """Start, end and weight of the longest lexicon match at each word, without those in exceptions."""
    text = f" {' '.join(words)} "
    hits, outs = {}, []
    for end, (size, weight) in automaton.iter(text):
        if weight is None:
            outs.append((end - size, end))
        else:
            hits[end - size] = (end, weight)
    # By place, an exception that ends last covers a match if any that begins before it does.
    outs.sort()
    kept, covered, i = [], -1, 0
    for a in sorted(hits):
        while i < len(outs) and outs[i][0] <= a:
            covered = max(covered, outs[i][1])
            i += 1
        b, w = hits[a]
        if b > covered:
            kept.append((a, b, w))
    return kept


def density(automaton, words: list[str]) -> float:
    return sum(w for _, _, w in matches(automaton, words)) / (len(words) + PRIOR_WORDS) if words else 0.0


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([t for _, t in keys], pa.int32()),
                                       pa.array([counts[k] for k in keys], pa.int64())], ["item", "toxic", "n"])


def _count(sample: DataFrame, items) -> DataFrame:
    """item, and the number of toxic (t) and other (c) rows of the sample that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in slices(batches, "text"):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                counts.update((x, toxic) for x in items(fold(text)))
            if len(counts) > 300_000:
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    rows = map_arrow(sample, run, "item string, toxic int, n long")
    return rows.groupBy("item").agg(F.sum(F.expr("if(toxic = 1, n, 0)")).alias("t"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("c"))


def beginnings(words: list[str]) -> set[str]:
    return {w[:n] for w in set(words) for n in range(SHORT, min(LONG, len(w)) + 1)}


def caution(t: float, c: float, toxic: int, clean: int) -> float:
    """Lower estimate of the log-odds that a text with the item is toxic, against the average text."""
    low, high = t - 2 * math.sqrt(t) + 0.5, c + 2 * math.sqrt(c) + 2
    return math.log(low / toxic / (high / clean)) if low > 0 else -math.inf


def choose(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries with enough weight; of a beginning and longer ones, the longest that nearly all its texts hold."""
    kept: dict[str, tuple[int, float]] = {}
    for item, t, c in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        weight = caution(t, c, toxic, clean)
        if weight < math.log(LEAST_ODDS):
            continue
        shorter = next((item[:n] for n in range(len(item) - 1, SHORT - 1, -1) if item[:n] in kept), None)
        if shorter is not None:
            if t >= 0.9 * kept[shorter][0]:
                del kept[shorter]
            elif weight <= kept[shorter][1] + 1:
                continue
        kept[item] = (t, weight)
    return {k: min(w, 8.0) for k, (_, w) in kept.items()}


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> Lexicon:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks 0 or 1."""
    stages = Stages(docs.sparkSession, "toxicity")
    marked = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.where("text is not null").select("doc_id", "text")
    # The chosen ids are at most sample_rows rows of two numbers.
    joined = texts.join(F.broadcast(chosen), "doc_id").groupBy(F.sha2("text", 256).alias("h"), "toxic").agg(F.first("text").alias("text"))
    sample = stages.save(joined.select("text", "toxic"), "sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    found = _count(sample, beginnings).where(F.col("t") >= max(3, math.ceil(LEAST_SHARE * toxic)))
    odds = F.col("t") / toxic / ((F.col("c") + 2) / F.lit(clean))
    rows = [tuple(r) for r in found.where(odds >= LEAST_ODDS).orderBy(F.desc("t"), "item").limit(20 * LEXICON).collect()]
    weight = choose(rows, toxic, clean)
    lexicon = Lexicon(dict(sorted(weight.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]))
    if not lexicon.weight:
        return lexicon

    def around(words: list[str]) -> set[str]:
        """Two-word phrases with a lexicon word in them."""
        text, out = f" {' '.join(words)} ", set()
        for start, end, _ in matches(_automaton(lexicon), words):
            stop = text.index(" ", end)
            if (after := text.find(" ", stop + 1)) > 0:
                out.add(text[start + 1:after])
            if start > 0:
                out.add(text[text.rfind(" ", 0, start) + 1:stop])
        return out

    seen = _count(sample, around).where((F.col("c") >= 5) & (F.col("t") / toxic * 10 < F.col("c") / F.lit(clean)))
    lexicon.exceptions = [r["item"] for r in seen.orderBy(F.desc("c"), "item").limit(LEXICON).collect()]
    lexicon.scale = best_threshold(*_densities(sample, lexicon)) * (1 - THRESHOLD) / THRESHOLD
    stages.drop(sample)
    return lexicon


def _densities(sample: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Density and label of the sample's rows, two numbers for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            d = [density(_automaton(lexicon), fold(t)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.float64()), part.column("toxic")], ["d", "toxic"])

    rows = map_arrow(sample, run, "d double, toxic int").toArrow()
    return rows.column("d").to_numpy(), rows.column("toxic").to_numpy()


def best_threshold(d: np.ndarray, toxic: np.ndarray) -> float:
    """Least density to call toxic, by F1; half-way (in ratio) to the next lower density."""
    levels = np.unique(d[d > 0])
    if len(levels) == 0:
        return 0.0
    hit = np.array([[(toxic[d >= x] == 1).sum(), (d >= x).sum()] for x in (levels if len(levels) <= 512 else np.quantile(levels, np.linspace(0, 1, 512)))])
    levels = levels if len(levels) <= 512 else np.quantile(levels, np.linspace(0, 1, 512))
    best = int(np.argmax(2 * hit[:, 0] / (hit[:, 1] + (toxic == 1).sum())))
    below = d[d < levels[best]].max(initial=0.0)
    return math.sqrt(levels[best] * max(below, levels[best] / 4))


_BUILT: dict[int, tuple[Lexicon, object]] = {}


def _automaton(lexicon: Lexicon):
    """The lexicon's automaton, built once per task."""
    if id(lexicon) not in _BUILT:
        _BUILT.clear()
        _BUILT[id(lexicon)] = (lexicon, lexicon.automaton())
    return _BUILT[id(lexicon)][1]


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with score, predicted and n_matches."""

    def verdicts(texts: list[str | None]) -> list[pa.Array]:
        out, hits = [], []
        for t in texts:
            words = fold(t) if t and lexicon.weight else []
            found = matches(_automaton(lexicon), words) if words else []
            hits.append(len(found))
            out.append(lexicon.score(sum(w for _, _, w in found) / (len(words) + PRIOR_WORDS)))
        s = np.array(out, np.float64)
        return [pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(hits, pa.int64())]

    return add_columns(docs, "text", [("score", "double"), ("predicted", "int"), ("n_matches", "long")], verdicts)
