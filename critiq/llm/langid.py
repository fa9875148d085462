"""Operator 3: language identification with labelled spans for mixed-language text.

Fitting counts letter trigrams (hashed to a fixed number of buckets) and scripts by
language, over all rows given; the counts are summed in every task first, so the
model has at most buckets x languages numbers however large the corpus is.

Prediction scores every word by its trigrams' log-probabilities. The script of a
word (code point ranges) narrows its candidates to the languages seen in that
script. A Viterbi path over the words of a text, which pays a penalty for every
change of language, labels spans; a document has the language with most letters.
The path is computed for all texts of a batch at once: blocks of words get their
best scores from every state to every state, blocks are chained per text, and the
chosen path is followed back inside each block.

Null texts and texts without a letter are ``und`` with score 0 and no spans, as are
all texts where nothing was learned. Ties go to the language that sorts first.
Repeated rows get a row each; rows with a null lang teach nothing; an empty table
gives no rows. Further columns are kept as they are.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import add_columns, map_arrow, slices

UNDETERMINED = "und"
BUCKETS = 1 << 16
#: Log-probability that a change of language costs.
SWITCH = 12.0
#: A language is a candidate for a script from this share of its training letters on.
SCRIPT_SHARE = 1e-3
BLOCK = 64
#: States up to which blocks of words are scored from every state to every state.
BLOCK_STATES = 16

# First and last code point of the scripts told apart; all others are one script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower-case letter, or 0 where it is no letter; its script's number."""
    lower = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            lower[c] = ord(ch.lower()[0])
    script = np.zeros(0x110000, np.uint8)
    for i, (_, first, last) in enumerate(SCRIPTS, 1):
        script[first:last + 1] = i
    return lower, script


@dataclass
class Words:
    """Words of a batch of texts: runs of letters, with the trigram bucket of every letter."""

    bucket: np.ndarray  # per letter
    first: np.ndarray  # per word: index of its first letter
    letters: np.ndarray  # per word
    script: np.ndarray  # per word
    start: np.ndarray  # per word: place in its text
    doc: np.ndarray  # per word
    ptr: np.ndarray  # per text: index of its first word; one more at the end


def words_of(texts: list[str]) -> Words:
    lower, script = _tables()
    flat = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    c = np.zeros(len(flat) + 2, np.uint32)
    c[1:-1] = lower[flat]
    at = np.flatnonzero(c[1:-1])
    with np.errstate(over="ignore"):
        h = c[at] * np.uint32(0x9E3779B1) + c[at + 1] * np.uint32(0x85EBCA77) + c[at + 2] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        bucket = (h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)
    first = np.flatnonzero(c[at] == 0)  # no letter before it
    place = at[first]
    doc = np.searchsorted(begin, place, side="right") - 1
    ptr = np.searchsorted(doc, np.arange(len(texts) + 1))
    letters = np.diff(np.append(first, len(at)))
    return Words(bucket, first, letters, script[flat[place]], place - begin[doc], doc, ptr)


@dataclass
class Model:
    langs: list[str]
    score: np.ndarray  # [bucket, language]
    banned: np.ndarray  # [script, language]: a penalty where the language is no candidate


def fit(docs: DataFrame) -> Model:
    """Learn from the rows of ``docs`` (text, lang); both columns are strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            w = words_of(part.column("text").to_pylist())
            langs = np.array(part.column("lang").to_pylist(), object)
            by_word = langs[w.doc]
            for lang in set(by_word):
                own = by_word == lang
                n = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
                n[:BUCKETS] += np.bincount(w.bucket[np.repeat(own, w.letters)], minlength=BUCKETS)
                n[BUCKETS:] += np.bincount(w.script[own], w.letters[own], len(SCRIPTS) + 1).astype(np.int64)
        for lang, n in counts.items():
            key = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int32)),
                                              pa.array(n[key])], ["lang", "bucket", "n"])

    learn = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = map_arrow(learn.where("text is not null and lang is not null"), run, "lang string, bucket int, n long")
    # At most (buckets + scripts) x languages rows.
    total = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(total.column("lang").to_pylist()))
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), np.float32))
    n = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(langs)))
    n[total.column("bucket").to_numpy(), np.searchsorted(langs, total.column("lang").to_pylist())] = total.column("n").to_numpy()
    grams, scripts = n[:BUCKETS], n[BUCKETS:]
    score = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS))
    candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    candidate[~candidate.any(1)] = True  # a script that no language is seen in narrows nothing
    return Model(langs, score.astype(np.float32), np.where(candidate, 0, -1e4).astype(np.float32))


def viterbi_steps(score: np.ndarray, ptr: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """``viterbi`` word by word, all texts at once: memory in proportion to words x states."""
    n, k = score.shape
    words = np.diff(ptr)
    order = np.argsort(-words, kind="stable")
    first, left = ptr[:-1][order], -words[order]  # texts by length; the first ones are still under way at a step
    stays = np.zeros((n, k), bool)
    other = np.zeros(n, np.int32)  # the best state before a word
    v = np.zeros((len(words), k))
    for i in range(int(words.max(initial=0))):
        m = int(np.searchsorted(left, -i))
        at, own = first[:m] + i, v[:m]
        if i:
            best = own.argmax(1)
            most = own[np.arange(m), best][:, None] - switch
            stays[at], other[at] = own >= most, best
            np.maximum(own, most, out=own)
        own += score[at]
    state = v.argmax(1)
    out = np.zeros(n, np.int64)
    for i in range(int(words.max(initial=0)) - 1, -1, -1):
        m = int(np.searchsorted(left, -i))
        at = first[:m] + i
        out[at] = state[:m]
        if i:
            state[:m] = np.where(stays[at, state[:m]], state[:m], other[at])
    return out


def viterbi(score: np.ndarray, ptr: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best state of each word; score is [word, state], text d has words ptr[d] .. ptr[d + 1] - 1.

    Few states go by blocks of words, whose tables grow with the square of the states;
    more of them go word by word, with the same path.
    """
    n, k = score.shape
    if k > BLOCK_STATES:
        return viterbi_steps(score, ptr, switch)
    words = np.diff(ptr)
    blocks = -(-words // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    total = int(first[-1])
    if total == 0:
        return np.zeros(0, np.int64)
    # Place of each word in the padded blocks; only a text's last block has padding, with score 0.
    doc = np.repeat(np.arange(len(words)), words)
    inside = np.arange(n) - ptr[doc]
    block, step = first[doc] + inside // BLOCK, inside % BLOCK
    s = np.zeros((BLOCK, total, k), np.float64)
    s[step, block] = score
    # Best score from the state before a block to each state at its end.
    change = np.where(np.eye(k, dtype=bool), 0.0, -switch)
    through = s[0][:, None, :] + change[None]
    for t in range(1, BLOCK):
        through = s[t][:, None, :] + np.maximum(through, through.max(2, keepdims=True) - switch)
    # Chain the blocks of each text, all texts with a k-th block at once.
    order = np.argsort(-blocks, kind="stable")
    before = np.zeros((total, k))
    at_end = np.zeros((len(words), k))
    for i in range(int(blocks.max())):
        d = order[:int((blocks > i).sum())]
        b = first[d] + i
        before[b] = at_end[d]
        at_end[d] = (at_end[d][:, :, None] + through[b]).max(1)
    state = at_end.argmax(1)
    came, left = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for i in range(int(blocks.max()) - 1, -1, -1):
        d = order[:int((blocks > i).sum())]
        b = first[d] + i
        left[b] = state[d]
        came[b] = (before[b] + through[b, :, state[d]]).argmax(1)
        state[d] = came[b]
    # Inside the blocks, from the state that each is entered with to the one it is left in.
    v = s[0] + change[came]
    back = np.zeros((BLOCK, total, k), np.int8)  # BLOCK_STATES at most
    own = np.arange(k, dtype=np.int8)[None]
    for t in range(1, BLOCK):
        best = v.argmax(1)
        most = v.max(1, keepdims=True) - switch
        back[t] = np.where(v >= most, own, best[:, None].astype(np.int8))
        v = s[t] + np.maximum(v, most)
    states = np.zeros((BLOCK, total), np.int64)
    states[-1] = left
    rows = np.arange(total)
    for t in range(BLOCK - 1, 0, -1):
        states[t - 1] = back[t][rows, states[t]]
    return states[step, block]


SPANS = "array<struct<start: int, end: int, lang: string>>"


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` with lang_pred, score (share of the letters in it) and spans (places in the text)."""
    langs, k = model.langs, len(model.langs)
    names = np.array([*langs, UNDETERMINED], object)
    # The model (buckets x languages x 4 bytes, a fixed bound) travels as one broadcast.
    shared = docs.sparkSession.sparkContext.broadcast((model.score, model.banned))

    def verdicts(texts: list[str | None]) -> list[pa.Array]:
        by_bucket, banned = shared.value
        w, n = words_of([t or "" for t in texts]), len(texts)
        if k and len(w.first):
            score = np.add.reduceat(by_bucket[w.bucket].astype(np.float64), w.first, axis=0) + banned[w.script]
            state = viterbi(score, w.ptr, switch)
            share = np.bincount(w.doc * k + state, w.letters, n * k).reshape(n, k)
        else:
            state, share = np.zeros(len(w.first), np.int64), np.zeros((n, max(k, 1)))
        all_letters = share.sum(1)
        best = np.where(all_letters > 0, share.argmax(1), k)
        certain = np.divide(share.max(1), all_letters, out=np.zeros(n), where=all_letters > 0)
        # Spans: words of one text with one state on end.
        new = np.ones(len(state), bool)
        new[1:] = (state[1:] != state[:-1]) | (w.doc[1:] != w.doc[:-1])
        at = np.flatnonzero(new) if k else np.zeros(0, np.int64)
        last = np.append(at[1:], len(state))[:len(at)] - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(w.start[at].astype(np.int32)), pa.array((w.start[last] + w.letters[last]).astype(np.int32)),
             pa.array(list(names[state[at]]), pa.string())], ["start", "end", "lang"])
        ends = np.searchsorted(w.doc[at], np.arange(n + 1)).astype(np.int32)
        return [pa.array(list(names[best]), pa.string()), pa.array(certain), pa.ListArray.from_arrays(pa.array(ends), spans)]

    return add_columns(docs, "text", [("lang_pred", "string"), ("score", "double"), ("spans", SPANS)], verdicts)
