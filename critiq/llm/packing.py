"""Operator 8: packing of tokenised documents by the harmonic algorithm.

Documents may be cut freely, so a document of n ids is cut into pieces whose
lengths are exactly capacity / k for the reciprocal classes k = 1, 2, 4, ...,
capacity: n // capacity full pieces and one piece for each binary digit of the
rest. A bin of class k takes k pieces, so a full bin has no padding. Every task
fills its own bins and talks to no other task: there is no shuffle. What is left
in a task's open bins at its end (fewer than k pieces of class k, fewer than
2 * capacity pieces in all) is closed in bins of 2^i pieces of one class; their
total is a power of two, which needs no padding either.

Null and empty texts have one id, the end id. An empty table gives no rows.
Repeated rows are packed as separate documents with the same doc_id; a null
doc_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import map_arrow, slices, task_cache

CAPACITY = 1024
END_ID = 0
PIECE_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
                "sequence_id long, offset long")

class _Encoder:
    """Ids of ``tokenizers`` for its byte-level vocabulary, computed by ``tiktoken``.

    Both libraries hold the same vocabulary (tests compare them); ``tiktoken`` is
    several times faster and hands out numpy arrays. A text that holds the string
    of a special token goes to ``tokenizers`` itself, whose default makes it one id,
    and so does one with a run of white space that ``tiktoken`` cannot take.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.reference = Tokenizer.from_file(path)
        special = {t.content for t in self.reference.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        vocab = self.reference.get_vocab(with_added_tokens=True)
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        import public_tokenizers
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4")
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        except ValueError:  # a run of some 10^6 blanks or line ends is too long for its pattern matcher
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> _Encoder:
    """One encoder per Python worker."""
    kept = task_cache("packing")
    if path not in kept:
        kept[path] = _Encoder(path)
    return kept[path]


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Piece lengths of a document with n ids: full pieces, then the binary digits of the rest."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << b for b in range(capacity.bit_length() - 2, -1, -1) if rest >> b & 1]


class _Bins:
    """Open bins of one task. A piece is placed when its bin is closed."""

    def __init__(self, worker: int, capacity: int):
        self.capacity = capacity
        self.next_id = worker << 33
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple, length: int) -> list[tuple]:
        """Placed pieces, (piece, sequence_id, offset), of the bin that this piece fills."""
        if length == self.capacity:
            return self._close([piece], length)
        waiting = self.open.setdefault(length, [])
        waiting.append(piece)
        if len(waiting) * length == self.capacity:
            self.open[length] = []
            return self._close(waiting, length)
        return []

    def rest(self) -> list[tuple]:
        out = []
        for length, waiting in sorted(self.open.items()):
            while waiting:
                take = 1 << (len(waiting).bit_length() - 1)
                out += self._close(waiting[:take], length)
                waiting = waiting[take:]
        return out

    def _close(self, pieces: list[tuple], length: int) -> list[tuple]:
        at = self.next_id
        self.next_id += 1
        return [(p, at, i * length) for i, p in enumerate(pieces)]


def _arrow(placed: list[tuple]) -> pa.RecordBatch:
    pieces = [p for p, _, _ in placed]
    col = [pa.array([p[i] for p in pieces], kind) for i, kind in
           enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))]
    col += [pa.array([s for _, s, _ in placed], pa.int64()), pa.array([o for _, _, o in placed], pa.int64())]
    return pa.RecordBatch.from_arrays(col, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack the ids into sequences of ``capacity``.

    One row per piece: doc_id, start and length in the document's ids, the ids
    themselves (little-endian unsigned 32 bit), doc_tokens (with the end id),
    sequence_id and the offset there. ``capacity`` must be a power of two.
    """
    if capacity & (capacity - 1) or capacity < 2:
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        bins = _Bins(TaskContext.get().partitionId(), capacity)
        end = np.array([end_id], dtype="<u4").tobytes()
        placed: list[tuple] = []
        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = (encode(text).tobytes() if text else b"") + end
                total, start = len(ids) // 4, 0
                for length in cuts(total, capacity):
                    piece = (doc_id, start, length, ids[4 * start:4 * (start + length)], total)
                    placed += bins.add(piece, length)
                    start += length
            if len(placed) >= 4096:
                yield _arrow(placed)
                placed = []
        placed += bins.rest()
        if placed:
            yield _arrow(placed)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, PIECE_SCHEMA)
