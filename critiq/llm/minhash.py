"""Operator 2: near-duplicate documents by SetSketch registers.

1. Every text becomes its set of word shingles (64-bit hashes). Texts with the same
   set are one class, known by its smallest doc_id; all later steps see classes.
2. A class has M registers: the register of an element is drawn with its hash, and
   it holds the largest floor(1 - log_base x) over truncated exponential minima x, so
   registers are exponentially spaced, mergeable and locality-sensitive.
3. Registers are banded by ROWS. Members of a bucket are candidates with the
   smallest id and with one hashed member of the bucket: two edges per member, not
   all pairs. Set sizes and the joint likelihood of two sketches (three counts:
   larger, smaller, equal registers) drop pairs that are far below the threshold.
4. Candidates are verified on the full sets, computed from the texts again.
5. In buckets that still hold several components, the members outside the largest
   one are tried with hashed members of it, for at most PIVOT_ROUNDS rounds and while
   a round links a PIVOT_YIELD of its pairs. Then an exact pass compares what is still outside with all members of other components by
   sketch, in blocks of bounded size, each pair in the first band it shares, and
   verifies what passes on the full sets in the task. So no pair that shares a
   bucket and could join two components goes untested, and no pairs are emitted.

Texts without words, null texts and null ids are linked with nothing; their
component is their own doc_id. A text with fewer words than a shingle is one shingle.
Repeated rows with one doc_id and different texts are told apart by row inside the
job and give a row each, with the class's smallest doc_id. An empty table gives no
rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, group_arrow, map_arrow, slices, utf8_views, with_row_id
from critiq.llm.components import components

#: Registers of a sketch, and registers of a band: a pair at similarity 0.8 misses all
#: 24 bands with probability (1 - 0.8^4)^24 = 3e-6.
M, ROWS = 96, 4
# Parameters of the sketch: base, rate and largest register value.
BASE, RATE, LARGEST = 1.001, 20.0, 65_534
#: Members of a bucket that meet in one task of the exact pass.
BLOCK = 2_048
#: Standard deviations that an estimate may lie below the threshold.
SLACK = 4.0
#: Rounds of hashed members of the largest component, each with two of them, before the exact pass.
PIVOT_ROUNDS = 3
#: Share of a round's pairs that must be links for another round; the exact pass tests whatever is left.
PIVOT_YIELD = 0.05
#: Bits of the filter that keeps texts without candidates from being shuffled: 16 MB, whatever the input.
FILTER_BITS = 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of all texts, and each text's first word; one more at the end."""
    raw, off = utf8_views(texts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~_SPACE[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = off[(off > 0) & (off < len(raw))]
    start[inner] = word[inner]
    at = np.flatnonzero(start)
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    stop[inner - 1] = word[inner - 1]
    length = np.flatnonzero(stop) + 1 - at
    # Sum of table[byte] * odd^(place in the word), reduced per word.
    letters = np.flatnonzero(word)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
    powers = np.ones(int(length.max(initial=0)) + 1, np.uint64)
    with np.errstate(over="ignore"):
        powers[1:] = np.multiply.accumulate(np.full(len(powers) - 1, _ODD, np.uint64))
        value = _TABLE[_LOWER[raw[letters]]] * powers[place]
        first = np.cumsum(length) - length
        h = np.add.reduceat(value, first) if len(first) else np.zeros(0, np.uint64)
        h = mix(h + length.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(at, off)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, ptr = word_hashes(texts)
    n = len(ptr) - 1
    with np.errstate(over="ignore"):
        grams = np.zeros(max(len(h) - k + 1, 0), np.uint64)
        for j in range(k):
            grams = mix(grams * _ODD + h[j:j + len(grams)] + _U(j + 1))
        out = []
        for i in range(n):
            a, b = int(ptr[i]), int(ptr[i + 1])
            if b - a >= k:
                out.append(np.unique(grams[a:b - k + 1]))
            elif b > a:  # the whole sequence as one shingle; its length keeps it apart from longer ones
                short = np.zeros(1, np.uint64)
                for j in range(a, b):
                    short = mix(short * _ODD + h[j] + _U(j - a + 1))
                out.append(mix(short + _U(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set, [set, M]. Elements send their stratified minima, smallest first,
    to the registers in an order of their own; a set stops when no later one can be the largest."""
    n = len(sets)
    reg = np.zeros(n * M, np.int64)
    if not n:
        return reg.reshape(0, M).astype(np.uint16)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    h = np.concatenate(sets) if len(doc) else np.zeros(0, np.uint64)
    # Register order of an element: a first register and a step; M = 96 needs a step coprime to it.
    steps = np.array([s for s in range(1, M) if np.gcd(s, M) == 1], np.int64)
    go = mix(h ^ _U(0xA0761D6478BD642F))
    first = (go % _U(M)).astype(np.int64)
    step = steps[((go >> _U(32)) % _U(len(steps))).astype(np.int64)]
    log_base = np.log(BASE)
    for j in range(M):
        if not len(doc):
            break
        with np.errstate(over="ignore"):
            u = (mix(h + _U(j + 1) * _ODD) >> _U(11)).astype(np.float64) * 2.0**-53
        x = -np.log1p(-(j + u) / M) / RATE
        value = np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / log_base), 0, LARGEST + 1).astype(np.int64)
        np.maximum.at(reg, doc * M + (first + j * step) % M, value)
        if j + 1 < M:
            next_most = np.floor(1 - np.log(-np.log1p(-(j + 1) / M) / RATE) / log_base)
            going = (reg.reshape(n, M).min(1) < next_most)[doc]
            doc, h, first, step = doc[going], h[going], first[going], step[going]
    return reg.reshape(n, M).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sketches, the maximum of the likelihood of their register
    comparison given the set sizes, over a grid."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = M - more - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 201)[None] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    up, down = np.clip(p(u - v * grid), 1e-12, 1), np.clip(p(v - u * grid), 1e-12, 1)
    likely = more * np.log(up) + less * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))
    return grid[np.arange(len(grid)), likely.argmax(1)]


def _floor(percent: int) -> float:
    t = percent / 100
    return t - SLACK * np.sqrt(t * (1 - t) / M)


def _possible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose sizes allow the threshold and whose estimate is not far below it."""
    ok = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    ok[ok] = estimate(a[ok], b[ok], size_a[ok], size_b[ok]) >= _floor(percent) if ok.any() else False
    return ok


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def sketch_table(docs: DataFrame, k: int) -> DataFrame:
    """row, doc_id, size, high and low (hash of the set) and sketch of each row (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), k)
            whole = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            high = np.array([w >> 64 for w in whole], np.uint64).view(np.int64)
            low = np.array([w & 0xFFFFFFFFFFFFFFFF for w in whole], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(high),
                 pa.array(low), pa.array([r.tobytes() for r in sketches(sets)], pa.binary())],
                ["row", "doc_id", "size", "high", "low", "sketch"])

    return map_arrow(docs.select("row", "doc_id", "text"), run,
                     "row long, doc_id long, size long, high long, low long, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    """id, size, band and bucket of every band of every class (id, size, sketch)."""
    width = 2 * ROWS
    bands = F.explode(F.sequence(F.lit(0), F.lit(M // ROWS - 1))).alias("band")
    return classes.select("id", "size", "sketch", bands).select(
        "id", "size", "band", F.expr(f"xxhash64(band, substring(sketch, band * {width} + 1, {width}))").alias("bucket"))


def _filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of class ids that the sketches leave, with both set sizes."""
    side = classes.select("id", "size", "sketch").hint("merge")
    full = (pairs.join(side.toDF("a", "size_a", "sketch_a"), "a").join(side.toDF("b", "size_b", "sketch_b"), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            for i in range(0, p.num_rows, 4096):
                part = p.slice(i, 4096)
                keep = _possible(_matrix(part.column("sketch_a")), _matrix(part.column("sketch_b")),
                                 part.column("size_a").to_numpy(), part.column("size_b").to_numpy(), percent)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return map_arrow(full, run, "a long, b long")


def _texts_of(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """id and text of the rows whose id is in ``ids``, and of few others.

    The ids set bits of a filter of fixed size, which every task holds against its rows,
    so only texts that are needed are shuffled. More ids than bits only let more through.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    bits = ids.select(place.alias("place")).groupBy(F.expr("place div 32768").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.expr("place % 32768")).alias("bits")).collect()
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, part in bits:  # bitmap_construct_agg gives 32768 bits; places count from 0
        found[bucket * len(part):(bucket + 1) * len(part)] = np.frombuffer(bytes(part), np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            at = p.column("place").to_numpy()
            yield p.select(["id", "text"]).filter(pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return map_arrow(rows.select("id", "text", place.alias("place")), run, "id long, text string")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union.

    The texts of the second ids arrive in the order of the join, so a text that many
    pairs share is turned into its set once per batch. Texts are merge-joined: either
    side grows with the input.
    """
    texts = texts.hint("merge")
    full = (pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_a"):
            sets: dict[int, np.ndarray] = {}
            for ids, column in (("a", "text_a"), ("b", "text_b")):
                number = part.column(ids).to_numpy()
                own, at = np.unique(number, return_index=True)
                new = np.array([x not in sets for x in own], bool)
                sets |= zip(own[new].tolist(), shingle_sets(part.column(column).take(pa.array(at[new])), k))
            keep = []
            for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                x, y = sets[a], sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(full, run, "a long, b long")


def _mixed(bands: DataFrame, parts: DataFrame) -> DataFrame:
    """id, band, bucket and component of the members of buckets with several components, with the
    bucket's largest component and its number of blocks. Classes without a link are their own part."""
    inside = bands.join(parts, "id", "left").select("id", "band", "bucket", F.coalesce("component", "id").alias("component"))
    per = inside.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = (per.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"))
             .where("parts > 1").select("bucket", F.col("most.component").alias("largest"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    return inside.join(mixed, "bucket")


def _pivots(members: DataFrame, seed: int) -> DataFrame:
    """Pairs of every member outside its bucket's largest component with two hashed members of that."""
    pivot = members.where("component = largest").groupBy("bucket").agg(
        *[F.min_by("id", F.xxhash64("id", F.lit(2 * seed + i))).alias(f"p{i}") for i in (0, 1)])
    pairs = members.where("component <> largest").join(pivot, "bucket").select("id", F.explode(F.array("p0", "p1")).alias("p"))
    return pairs.select(F.greatest("id", "p").alias("a"), F.least("id", "p").alias("b")).distinct()


def _outside_pairs(t: pa.Table, reg: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each member outside the largest component with the members of other components that the
    sketches leave; a pair counts in the first band that it shares."""
    rest = np.array(t.column("rest").to_pylist(), bool)
    part, size = t.column("component").to_numpy(), t.column("size").to_numpy()
    banded, band = reg.reshape(len(reg), -1, ROWS), t.column("band")[0].as_py()
    others = np.flatnonzero(~rest)
    for i in np.flatnonzero(rest):
        j = others[part[others] != part[i]]
        # Equal registers alone bound the estimate from above; the likelihood decides on what is left.
        j = j[(reg[j] == reg[i]).mean(1) >= _floor(percent) - 0.1]
        j = j[(banded[j] == banded[i]).all(2).argmax(1) == band]
        if len(j):
            j = j[_possible(np.repeat(reg[i][None], len(j), 0), reg[j], np.repeat(size[i], len(j)), size[j], percent)]
        if len(j):
            yield i, j


def _exact_pass(members: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int, stages: Stages) -> DataFrame:
    """Links over components inside buckets, one per member and component that it reaches.

    The members of a bucket outside its largest component meet all its members, in
    blocks of at most BLOCK on either side. A first pass by sketch says which members
    have a pair that may be a link; a second gets the texts of those only and tests
    their pairs on the full sets inside the task, so pairs themselves are never rows.
    """
    members = stages.save(members.join(classes.select("id", "size", "sketch"), "id")
                          .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))), "members")
    every = F.explode(F.expr("sequence(0L, blocks - 1L)"))
    columns = ["bucket", "band", "id", "component", "size", "sketch"]
    left = members.where("component <> largest").select(*columns, F.lit(True).alias("rest"), F.col("block").alias("i"), every.alias("j"))
    right = members.select(*columns, F.lit(False).alias("rest"), every.alias("i"), F.col("block").alias("j"))
    busy = left.select("bucket", "i", "j").distinct()
    meet = left.unionByName(right.join(busy, ["bucket", "i", "j"], "left_semi"))
    names = ["bucket", "i", "j", "band", "id", "component", "size", "rest"]

    def likely(t: pa.Table) -> pa.Table:
        needed = np.zeros(len(t), bool)
        for i, j in _outside_pairs(t, _matrix(t.column("sketch")), percent):
            needed[i] = needed[j] = True
        return t.select(names).filter(pa.array(needed))

    def verify(t: pa.Table) -> pa.Table:
        sets = shingle_sets(t.column("text").combine_chunks(), k)
        ids, part = t.column("id").to_numpy(), t.column("component").to_numpy()
        out = []
        for i, partners in _outside_pairs(t, sketches(sets), percent):
            reached = set()
            for j in partners:
                if part[j] not in reached:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        reached.add(part[j])
                        out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    kinds = "bucket long, i long, j long, band int, id long, component long, size long, rest boolean"
    flagged = stages.save(group_arrow(meet, ["bucket", "i", "j"], likely, kinds), "flagged")
    full = flagged.join(_texts_of(flagged.select("id").distinct(), texts).hint("merge"), "id")
    return group_arrow(full, ["bucket", "i", "j"], verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text).

    Rows are numbered and written once: a number given anew by each job that reads
    ``docs`` would follow the splits of that job.
    """
    stages = Stages(docs.sparkSession, "minhash")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return near_rows(stages.save(with_row_id(rows, "row"), "rows"), k, percent, stages)


def near_rows(rows: DataFrame, k: int, percent: int, stages: Stages) -> DataFrame:
    """``near_duplicates`` of a stored table (row, doc_id, text) whose rows carry their number."""
    sketched = stages.save(sketch_table(rows, k), "sketches")
    usable = sketched.where("size > 0 and doc_id is not null")
    # One class per set: its smallest row stands for it; the sketch is the same for all its rows.
    classes = stages.save(usable.groupBy("high", "low").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("sketch").alias("sketch")), "classes")
    bands = _bands(classes)
    stars = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("low"),
                                        F.min_by("id", F.xxhash64("id")).alias("some")).where("n > 1")
    stars = stages.save(bands.join(stars, "bucket").select("id", "band", "bucket", "low", "some"), "buckets")
    edge = [stars.select(F.col("id").alias("a"), F.col(c).alias("b")) for c in ("low", "some")]
    pairs = edge[0].union(edge[1]).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    candidates = stages.save(_filtered(pairs, classes, percent), "candidates")
    texts = rows.select(F.col("row").alias("id"), "text")

    def links_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        return stages.save(_verified(pairs, _texts_of(ids, texts), k, percent), "links")

    def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
        """Components after further links: the stars of the present ones stand for all links so far."""
        stars = parts.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        return components(stars.union(links), stages)

    tested = candidates
    parts = components(links_of(candidates), stages)
    members = stages.save(_mixed(stars, parts), "mixed")
    for seed in range(PIVOT_ROUNDS):
        pairs = _pivots(members, seed).join(tested.hint("merge"), ["a", "b"], "left_anti")
        pairs = stages.save(_filtered(pairs, classes, percent), "more")
        links = links_of(pairs)
        tried, found = pairs.count(), links.count()
        if found:
            tested, parts = tested.union(pairs), joined(parts, links)
            members = stages.save(_mixed(members.select("id", "band", "bucket"), parts), "mixed")
        if found <= PIVOT_YIELD * tried:
            break
    last = stages.save(_exact_pass(members, classes, texts, k, percent, stages), "last")
    if not last.isEmpty():
        parts = joined(parts, last)
    # From rows to the smallest doc_id: classes carry theirs, components take the least of their classes.
    named = classes.join(parts, "id", "left").select("high", "low", F.coalesce("component", "id").alias("component"), "doc_id")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("high", "low", "component_id")
    out = sketched.withColumn("linked", F.expr("size > 0 and doc_id is not null"))
    out = out.join(named.withColumn("linked", F.lit(True)), ["high", "low", "linked"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
