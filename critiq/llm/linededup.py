"""Operator 10: removal of lines that many documents share, by perfect-hash arrays.

1. Every document's distinct long line keys become 128-bit hashes, counted per key
   in two steps (by key and document, then by key), so a line that a third of all
   documents hold is summed in every task before it is shuffled.
2. The keys found in enough documents are dealt by hash over shards of bounded
   size. Each shard builds a minimal perfect hash: a cascade of bit arrays in which
   a key owns its bit on the first level where no other key of the shard falls on
   it; the rank of the bit is the key's slot. The slots index compact arrays: a
   64-bit fingerprint, the document count and the document that keeps the line.
   A shard is one file in the shared checkpoint folder.
3. The documents are read again and probe the arrays, shard after shard; a task
   keeps the last shards it has opened, up to a bound in bytes. No line is joined.

Null and empty texts are one empty line, which is never dropped. A document whose
lines are all dropped has an empty text. Rows with the same doc_id count as one
document. Rows with a null doc_id are not counted and keep their lines. With no
shared line, and for an empty table, nothing is built and nothing is dropped.
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, free_name, group_arrow, map_arrow, slices

# The white space stripped at a line's ends.
WHITE = b" \t\n\x0b\x0c\r"

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys of a shard, about; 24 bytes each in the arrays.
SHARD_KEYS = 250_000
#: Bytes of opened shards that a task keeps.
OPEN_BYTES = 128 << 20
#: Bits of a level per key that is left.
GAMMA = 2.0
LEVELS = 40


def line_hash(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """128-bit hash of the line's key, or None where the key is short."""
    key = line.strip(WHITE)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars:
        return None
    h = xxhash.xxh3_128_intdigest(key.lower())  # of bytes: A-Z only
    return h >> 64, h & 0xFFFFFFFFFFFFFFFF


def _mix(x: np.ndarray, level: int) -> np.ndarray:
    """An independent hash of 64-bit keys for each level."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: slots 0 .. n - 1, other keys get any slot or -1."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        counts = np.array([int(b.sum()) for b in bits], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.ranks = [np.cumsum(b, dtype=np.int32) for b in bits]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        bits, left = [], keys
        for level in range(LEVELS):
            if len(left) == 0:
                break
            size = max(8, int(GAMMA * len(left)))
            at = (_mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            left = left[~alone[at]]
        if len(left):
            raise ValueError("keys are not distinct")
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            if len(todo) == 0:
                break
            at = (_mix(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            own = bits[at]
            hit = todo[own]
            out[hit] = self.first[level] + self.ranks[level][at[own]] - 1
            todo = todo[~own]
        return out


class Shard:
    """Perfect hash with its fingerprint, count and keeper arrays; one file."""

    def __init__(self, hash_: PerfectHash, fingerprint: np.ndarray, count: np.ndarray, keeper: np.ndarray):
        self.hash, self.fingerprint, self.count, self.keeper = hash_, fingerprint, count, keeper
        self.bytes = sum(5 * len(b) for b in hash_.bits) + 24 * len(count)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, docs: np.ndarray, keeper: np.ndarray) -> "Shard":
        h = PerfectHash.build(high)
        order = np.argsort(h.slots(high))
        return cls(h, low[order], docs[order], keeper[order])

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and keeper of each key; count 0 where the shard does not hold it."""
        slot = self.hash.slots(high)
        inside = slot >= 0
        inside[inside] = self.fingerprint[slot[inside]] == low[inside]
        count, keeper = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        count[inside], keeper[inside] = self.count[slot[inside]], self.keeper[slot[inside]]
        return count, keeper

    def dump(self) -> bytes:
        out = io.BytesIO()
        sizes = np.array([len(b) for b in self.hash.bits], np.int64)
        np.savez(out, sizes=sizes, fingerprint=self.fingerprint, count=self.count, keeper=self.keeper,
                 bits=np.packbits(np.concatenate(self.hash.bits)))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Shard":
        with np.load(io.BytesIO(data)) as z:
            flat = np.unpackbits(z["bits"])[:int(z["sizes"].sum())].astype(bool)
            bits = np.split(flat, np.cumsum(z["sizes"])[:-1])
            return cls(PerfectHash(bits), z["fingerprint"], z["count"], z["keeper"])


def _store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """high, low (the key's hash), n_docs and keeper (largest doc_id) of every long line key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            high, low, ids = [], [], []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                found = {h for line in text.encode().split(b"\n") if (h := line_hash(line, min_chars))}
                for a, b in found:
                    high.append(a)
                    low.append(b)
                ids += [doc_id] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(np.array(low, np.uint64).view(np.int64)),
                 pa.array(ids, pa.int64())], ["high", "low", "doc_id"])

    lines = map_arrow(docs.where("doc_id is not null and text is not null").select("doc_id", "text"), run,
                      "high long, low long, doc_id long")
    return lines.groupBy("high", "low").agg(F.count_distinct("doc_id").alias("n_docs"),
                                            F.max("doc_id").alias("keeper"))


def build_shards(shared: DataFrame, n_shards: int, folder: str) -> DataFrame:
    """Write one file per shard of ``shared`` (high, low, n_docs, keeper) and return the shard numbers."""

    def run(t: pa.Table) -> pa.Table:
        high, low = (t.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        first = np.unique(high, return_index=True)[1]  # one key per high half; a clash of halves is a 2^-64 event
        shard = Shard.build(high[first], low[first], t.column("n_docs").to_numpy()[first].astype(np.int64),
                            t.column("keeper").to_numpy()[first].astype(np.int64))
        number = t.column("shard")[0].as_py()
        fs, path = _store(folder)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{number:06d}.npz") as f:  # the same bytes if a task runs again
            f.write(shard.dump())
        return pa.table({"shard": pa.array([number], pa.int32()), "keys": pa.array([len(first)], pa.int64())})

    dealt = shared.withColumn("shard", F.pmod(F.col("high"), F.lit(n_shards)).cast("int"))
    return group_arrow(dealt, ["shard"], run, "shard int, keys long")


class _Shards:
    """Shards a task has opened, the last used kept up to a bound in bytes."""

    def __init__(self, folder: str, n_shards: int):
        self.fs, self.path = _store(folder)
        self.n, self.open, self.bytes = n_shards, OrderedDict(), 0

    def get(self, number: int) -> Shard | None:
        if number in self.open:
            self.open.move_to_end(number)
            return self.open[number]
        file = f"{self.path}/{number:06d}.npz"
        shard = None
        if self.fs.get_file_info(file).type == pa.fs.FileType.File:
            with self.fs.open_input_stream(file) as f:
                shard = Shard.load(f.read())
        self.open[number] = shard
        self.bytes += shard.bytes if shard else 0
        while self.bytes > OPEN_BYTES and len(self.open) > 1:
            _, old = self.open.popitem(last=False)
            self.bytes -= old.bytes if old else 0
        return shard

    def find(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, keeper = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        shard_of = (high.view(np.int64) % self.n).astype(np.int64)
        for number in np.unique(shard_of):
            if shard := self.get(int(number)):
                mine = shard_of == number
                count[mine], keeper[mine] = shard.find(high[mine], low[mine])
        return count, keeper


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the kept text in ``text`` and two more columns, n_lines and n_dropped.

    The new columns get underscores before their names where ``docs`` has such columns.
    """
    spark = docs.sparkSession
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    stages = Stages(spark, "lines")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = stages.save(line_counts(ids, min_chars).where(F.col("n_docs") >= min_docs), "shared")
    n_shards = -(-shared.count() // SHARD_KEYS)
    folder = stages.path("shards")
    if n_shards:
        build_shards(shared, n_shards, folder).write.format("noop").mode("overwrite").save()
    stages.drop(shared)
    names = [*docs.columns, n_lines, n_dropped]
    id_at, text_at = (next(i for i, c in enumerate(docs.columns) if c.lower() == n) for n in ("doc_id", "text"))
    text_name = docs.columns[text_at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, n_shards) if n_shards else None
        for part in slices(batches, text_name):
            lines = [(t or "").encode().split(b"\n") for t in part.column(text_at).to_pylist()]
            drop = [[False] * len(x) for x in lines]
            if shards:
                high, low, where = [], [], []
                doc_ids = part.column(id_at).to_pylist()
                for i, own in enumerate(lines):
                    if doc_ids[i] is None:
                        continue
                    for j, line in enumerate(own):
                        if h := line_hash(line, min_chars):
                            high.append(h[0])
                            low.append(h[1])
                            where.append((i, j))
                count, keeper = shards.find(np.array(high, np.uint64), np.array(low, np.uint64))
                for k in np.flatnonzero(count):
                    i, j = where[k]
                    drop[i][j] = int(keeper[k]) != doc_ids[i]
            kept = [b"\n".join([x for x, gone in zip(own, out) if not gone]).decode("utf-8") for own, out in zip(lines, drop)]
            columns = list(part.columns)
            columns[text_at] = pa.array(kept, pa.string())
            columns += [pa.array([len(x) for x in lines], pa.int64()), pa.array([sum(x) for x in drop], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = [(c, "string" if i == text_at else k) for i, (c, k) in enumerate(docs.dtypes)]
    schema = ", ".join(f"`{c}` {k}" for c, k in [*kinds, (n_lines, "long"), (n_dropped, "long")])
    return map_arrow(docs.withColumn(text_name, F.col(text_name).cast("string")), run, schema)
