"""Operator 4: SentencePiece encoding (merge type, byte fallback) and decoding.

Encoding by backtracking. A row of tokens is what the merge procedure gives
exactly if every two neighbours are what it gives for their joined text. So the
encoder follows the longest matches of an Aho-Corasick automaton over the
vocabulary, checks each against the token before it by merging the two again
(answers are kept), takes the next shorter token where they do not agree, and
steps back where no token is left. A bitfield marks the places from which no
tokenisation goes on, so each place fails once.

A token never holds a space mark after another character, and characters that
occur in no token become their bytes, so texts are cut before each run of spaces
and at line ends and the pieces of a cut are kept per worker, in a table that is
emptied when it is full.

Null texts count as empty; the empty text has no ids and decodes to the empty
text. As in the library, decoding gives a space for the space mark, drops one
space at the start and writes U+FFFD for bytes that are no UTF-8. An empty table
gives no rows; repeated rows give a row each; further columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import map_arrow, slices, task_cache

# Fixed values of the model format: the space mark, and the kinds of a piece.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

#: Cuts and pairs a worker keeps before it starts again.
CACHE = 200_000



def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id, from the model file's repeated message field 1."""
    with open(path, "rb") as f:
        data = f.read()
    return [_piece(body) for number, body in _fields(data) if number == 1]


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Field number and content of each field of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
            yield key >> 3, value.to_bytes(8, "little")
            continue
        if wire == 2:
            size, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}[wire]
        yield key >> 3, data[at:at + size]
        at += size


def _piece(body: bytes) -> tuple[str, float, int]:
    text, score, kind = "", 0.0, NORMAL
    for number, value in _fields(body):
        if number == 1:
            text = value.decode("utf-8")
        elif number == 2:
            score = float(np.frombuffer(value, "<f4")[0])
        elif number == 3:
            kind = int.from_bytes(value, "little")
    return text, score, kind


class PieceModel:
    """Vocabulary of a model file with encoding and decoding of single texts."""

    def __init__(self, path: str):
        import ahocorasick

        pieces = read_model(path)
        self.text = [p for p, _, _ in pieces]
        self.score = {p: s for p, s, k in pieces if k == NORMAL}
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.chars = {c for p in self.id for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.id) or "\n" in self.chars:
            raise ValueError("a piece reaches over a space or a line end; texts can't be cut there")
        # Bytes of each id in a decoded text; control and unknown ids write nothing of their own.
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                      " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
                      for p, _, k in pieces]
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int] = {}  # the longest token that begins a token, without itself
        for p, i in self.id.items():
            if self.merge(list(p)) == [p]:  # others never come out of the merge procedure
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        for p, i in self.id.items():
            for n in range(len(p) - 1, 0, -1):
                if p[:n] in self.automaton:
                    self.shorter[i] = self.id[p[:n]]
                    break
        self.cut = re.compile(r" *[^ \n]+| +|\n")
        self.cuts: dict[str, list[int]] = {}
        self.pairs: dict[int, bool] = {}  # by left id * number of pieces + right id
        self.last: dict[str, tuple[float, str, str] | None] = {}

    # ---- merging, for short strings only -------------------------------------------------
    def merge(self, parts: list[str], least: int = 1) -> list[str]:
        """The merge procedure: join the neighbours of best score, leftmost first, while any can be joined."""
        parts = list(parts)
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: int, right: int) -> bool:
        """Do two neighbours come out again when their joined text is merged?"""
        key = left * len(self.text) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            # The pieces of runs of spaces have equal scores, so those are merged as a whole.
            known = self.merge(list(a + b)) == [a, b] if b[0] == MARK else self._stay_apart(a, b)
            self.pairs[key] = known
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """Undo the last merges beside the border, latest first; no state may join over it.

        In a state the pieces at the border are ``left`` and ``right``. It ends with the
        earlier of the two merges that use them. A piece over the border would be joined
        first if its score is better than that merge's (or equal, left of it).
        """
        ends, or_equal = None, False  # score of the merge that ends the state; none ends the last
        while True:
            joined = self.score.get(left + right)
            if joined is not None and (ends is None or joined > ends or or_equal and joined == ends):
                return False
            a, b = self.made(left), self.made(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] < b[0]:
                ends, or_equal, left = a[0], False, a[2]
            else:
                ends, or_equal, right = b[0], True, b[1]

    def made(self, piece: str) -> tuple[float, str, str] | None:
        """Score of a piece's last merge and the two parts it joined; None for one character."""
        known = self.last.get(piece, False)
        if known is False:
            known = None
            if len(piece) > 1:
                parts = self.merge(list(piece), 2)
                if max(self.worst(p) for p in parts) > -self.score[piece]:
                    raise ValueError(f"the parts of {piece!r} have worse scores than itself")
                known = (self.score[piece], *parts)
            self.last[piece] = known
        return known

    def worst(self, piece: str) -> float:
        """The last of a piece's merges, as a negative score; characters are there from the start."""
        return -self.score[piece] if len(piece) > 1 else float("-inf")

    # ---- encoding -------------------------------------------------------------------------
    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters all occur in the vocabulary."""
        n, at, ids = len(text), 0, []
        pairs, pieces, width, longest = self.pairs, self.text, len(self.text), self.automaton.iter_long
        failed = 0  # bit i: no tokenisation goes on from place i
        while at < n:
            for end, token in longest(text, at):
                stop = end + 1
                if failed >> stop & 1 or ids and not (
                        pairs.get(ids[-1] * width + token) or self.agree(ids[-1], token)):
                    break  # go on below from the next shorter token
                ids.append(token)
                at = stop
            else:
                return ids
            token = self.shorter.get(token)
            while True:
                while token is not None:
                    stop = at + len(pieces[token])
                    if not failed >> stop & 1 and (not ids or self.agree(ids[-1], token)):
                        break
                    token = self.shorter.get(token)
                if token is not None:
                    ids.append(token)
                    at = stop
                    break
                if not ids:
                    raise ValueError(f"no tokenisation of {text!r}")
                failed |= 1 << at
                token = ids.pop()
                at -= len(pieces[token])
                token = self.shorter.get(token)
        return ids

    def encode_cut(self, cut: str) -> list[int]:
        """Ids of one cut, from the worker's table if it is there."""
        ids = self.cuts.get(cut)
        if ids is None:
            marked = cut.replace(" ", MARK)
            if self.chars.issuperset(marked):
                ids = self.backtrack(marked)
            else:
                ids = []
                for known, run in itertools.groupby(marked, self.chars.__contains__):
                    run = "".join(run)
                    ids += self.backtrack(run) if known else [self.byte_id[b] for b in run.encode()]
            if len(cut) <= 64:
                if len(self.cuts) >= CACHE:
                    self.cuts.clear()
                self.cuts[cut] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids without begin and end ids; a space is put before the text."""
        if not text:
            return []
        out: list[int] = []
        for cut in self.cut.findall(" " + text.replace(MARK, " ")):
            out += self.cuts.get(cut) or self.encode_cut(cut)
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids))
        if ids and raw.startswith(b" ") and self.text[ids[0]].startswith(MARK):
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return _replace_bytes(raw)


def _replace_bytes(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def model(path: str) -> PieceModel:
    """One model per Python worker."""
    kept = task_cache("piece_bpe")
    if path not in kept:
        kept[path] = PieceModel(path)
    return kept[path]


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for part in slices(batches, "text"):
            rows = [m.encode(t or "") for t in part.column("text").to_pylist()]
            ends = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(r) for r in rows], out=ends[1:])
            flat = np.fromiter((i for r in rows for i in r), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array([m.decode(r) for r in rows], pa.string())], ["doc_id", "ids", "decoded"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, ids array<int>, decoded string")
