"""Operator 11: product codes of vectors, with LAESA pivots in place of full searches.

Vectors become integers (floor of 4096 times the component) and are cut into 8 equal
parts; each part has a codebook of 16 entries, fitted by rounds of assignment and
averaging in exact integers.

A few of the first entries of each codebook, far apart from each other, are pivots
and stay fixed. The distances from every part to its pivots are computed once and
stored with the vectors. In each round the distances from the pivots to the present
entries are computed anew (16 entries); for a part x, an entry y and a pivot z,
|d(x, z) - d(y, z)| is a lower bound of d(x, y). A part's entries are tried in the
order of their largest bound, and the search ends at the first entry whose bound is
above the best exact squared distance so far. Bounds are taken a little lower than
floating point gives them, so ties and near ties are always evaluated exactly.

A task sends one row per part and entry it used (a count and a sum per component),
so a round shuffles at most 128 rows a task; the codebooks, 128 entries, are the
only thing the driver holds.

Rows whose vector is null or holds null or non-finite components are dropped. The
dimension is that of the kept row with the smallest vec_id (nulls last, then by the
vector); a kept vector of another dimension has null code and errors and takes no
part. A dimension that is no multiple of 8 is filled up with zeros at the end. With
fewer than 16 rows the codebooks have that many entries; ties go to the lower index,
of repeated vec_ids the smaller vector comes first. Integers are exact up to 2^62 in
size, larger ones count as 2^62; errors above 2^63 - 1 show as that number. Rows with
a null label share a sum. Empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, map_arrow

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
#: Rows a task works on at once.
ROWS = 4096
#: Integers up to this size keep squared distances within 64 bits (for parts of up to 256 components).
SMALL = 1 << 26
LARGEST = (1 << 63) - 1
#: Labels that are broadcast with their sums: rows and bytes, checked before.
MAX_LABELS, MAX_LABEL_BYTES, SALTS = 100_000, 8 << 20, 32


def integers(vectors: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """[row, part, component] integers of a matrix of vectors; Python's own where 64 bits may not do."""
    n, dim = vectors.shape
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    whole = np.clip(scaled, -2.0 ** 62, 2.0 ** 62).astype(np.int64)
    length = -(-dim // parts)
    if length * parts > dim:
        whole = np.concatenate([whole, np.zeros((n, length * parts - dim), np.int64)], axis=1)
    whole = whole.reshape(n, parts, length)
    small = length <= 256 and (whole.size == 0 or max(whole.max(), -whole.min()) < SMALL)
    return whole if small else whole.astype(object)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis."""
    d = x - y
    return (d * d).sum(-1)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)).astype(np.float32)


def choose_pivots(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """[part, pivot, component]: the first entry, then always that with the largest sum of distances to those chosen."""
    out = []
    for own in entries:
        chosen, total = [0], root(squared(own, own[0])).astype(np.float64)
        while len(chosen) < min(count, len(own)):
            total[chosen] = -1
            chosen.append(int(total.argmax()))
            total += root(squared(own, own[chosen[-1]]))
        out.append(own[chosen])
    return np.stack(out)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """[row, part, pivot] distances, to single precision."""
    return np.stack([root(squared(x, pivots[None, :, i])) for i in range(pivots.shape[1])], axis=2)


class Codebooks:
    """Entries [part, entry, component] and their distances to the pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        small = entries.size == 0 or max(entries.max(), -entries.min()) < SMALL
        self.entries, self.pivots = entries.astype(np.int64) if small else entries.astype(object), pivots
        self.away = np.stack([root(squared(self.entries, pivots[:, i:i + 1])) for i in range(pivots.shape[1])], axis=2)

    def bounds(self, part: int, away: np.ndarray) -> np.ndarray:
        """[row, entry] squared lower bounds of a part's distances, given those to its pivots."""
        most = np.zeros((len(away), self.entries.shape[1]))
        for i in range(away.shape[1]):
            a, b = away[:, i, None].astype(np.float64), self.away[part, None, :, i].astype(np.float64)
            np.maximum(most, np.abs(a - b) - 1.3e-7 * (a + b), out=most)  # both are rounded to 24 bits
        return most * most * (1 - 1e-12)

    def assign(self, x: np.ndarray, away: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry and squared distance of every part, and the number of exact evaluations."""
        n, parts, _ = x.shape
        code = np.zeros((n, parts), np.int64)
        least = np.zeros((n, parts), self.entries.dtype if x.dtype != object else object)
        evaluated = 0
        for part in range(parts):
            own, entries = x[:, part], self.entries[part]
            bound = self.bounds(part, away[:, part])
            order = np.argsort(bound, axis=1, kind="stable")
            best = order[:, 0].copy()
            dist = squared(own, entries[best])
            evaluated += n
            active = np.arange(n)
            for rank in range(1, len(entries)):
                entry = order[active, rank]
                open_ = bound[active, entry] <= dist[active].astype(np.float64)
                active, entry = active[open_], entry[open_]
                if len(active) == 0:
                    break
                found = squared(own[active], entries[entry])
                evaluated += len(active)
                better = (found < dist[active]) | ((found == dist[active]) & (entry < best[active]))
                rows = active[better.astype(bool)]
                best[rows], dist[rows] = entry[better.astype(bool)], found[better.astype(bool)]
            code[:, part], least[:, part] = best, dist
        return code, least, evaluated

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.reshape(-1)).encode()).hexdigest()


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), flat.size // max(len(column), 1))


def _decoded(batches: Iterator[pa.RecordBatch], pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the stored table with their integers and pivot distances."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            x = integers(_matrix(piece.column("embedding")))
            yield piece, x, _matrix(piece.column("away")).reshape(piece.num_rows, PARTS, pivots)


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, n and the sum of each component over the parts assigned to the entry."""
    parts, entries, length = books.entries.shape
    pivots = books.pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, length), object)
        for _, x, away in _decoded(batches, pivots):
            code, _, _ = books.assign(x, away)
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=entries)
                own = np.zeros((entries, length), x.dtype)
                np.add.at(own, code[:, p], x[:, p])
                total[p] += own
        at = np.argwhere(count)
        sums = [[Decimal(int(v)) for v in total[p, e]] for p, e in at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(count[at[:, 0], at[:, 1]]),
             pa.array(sums, pa.list_(pa.decimal128(38, 0)))], ["part", "entry", "n", "sums"])

    found = map_arrow(rows.select("embedding", "away"), run, "part int, entry int, n long, sums array<decimal(38,0)>")
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(length))).alias("sums"))


def fit(rows: DataFrame, entries: np.ndarray, pivots: np.ndarray, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after the given rounds over ``rows`` (embedding, away), from the first ``entries``."""
    books = Codebooks(entries, pivots)
    for _ in range(rounds if entries.size else 0):
        new = books.entries.astype(object)
        for r in _sums(rows, books).collect():  # at most parts x entries rows
            new[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
        books = Codebooks(new, pivots)
    return books


def codes(vectors: DataFrame, stages: Stages | None = None) -> DataFrame:
    """vec_id, label, code, error and codebooks_sha256 of the kept rows of ``vectors`` (vec_id, embedding, label)."""
    stages = stages or Stages(vectors.sparkSession, "codes")
    kept = vectors.select("vec_id", "label", "embedding").where("embedding is not null").where(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()]
    first = kept.orderBy(*order).select(F.size("embedding").alias("d")).limit(1).collect()
    empty = "vec_id long, label string, code string, error long, codebooks_sha256 string"
    if not first:
        return vectors.sparkSession.createDataFrame([], empty)
    whole = kept.where(F.size("embedding") == first[0]["d"])
    seeds = integers(np.array([r["embedding"] for r in whole.orderBy(*order).limit(ENTRIES).collect()], np.float64))
    entries = seeds.transpose(1, 0, 2)
    pivots = choose_pivots(entries)
    count, dim = pivots.shape[1], first[0]["d"]
    kind = dict(kept.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                away = pivot_distances(integers(_matrix(piece.column("embedding"))), pivots).reshape(-1)
                ends = pa.array(np.arange(0, len(away) + 1, PARTS * count, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.ListArray.from_arrays(ends, pa.array(away))],
                                                 ["vec_id", "label", "embedding", "away"])

    schema = ", ".join(f"{c} {kind[c]}" for c in ("vec_id", "label", "embedding"))
    rows = stages.save(map_arrow(whole, measure, f"{schema}, away array<float>"), "rows")
    books = fit(rows, entries, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x, away in _decoded(batches, count):
            code, dist, _ = books.assign(x, away)
            text = ["".join(f"{c:02x}" for c in row) for row in code.tolist()]
            error = [min(int(d), LARGEST) for d in dist.astype(object).sum(1)]
            yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("label"), pa.array(text, pa.string()),
                                              pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    out = map_arrow(rows, run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")
    other = kept.where(F.size("embedding") != dim).select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                                          F.lit(None).cast("long").alias("error"))
    return out.unionByName(other).withColumn("codebooks_sha256", F.lit(books.digest()))


def with_label_error(coded: DataFrame, stages: Stages) -> DataFrame:
    """``coded`` with the sum of its errors over rows with an equal label, nulls together."""
    own = stages.save(coded, "codes")
    sums = own.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    label_error = F.when(F.col("s") > Decimal(LARGEST), F.lit(LARGEST)).otherwise(F.col("s").cast("long"))
    sums = stages.save(sums.select("of", label_error.alias("label_error")), "labels")
    size = sums.agg(F.count("*").alias("n"), F.sum(F.length(F.col("of").cast("string"))).alias("b")).collect()[0]
    if size["n"] <= MAX_LABELS and (size["b"] or 0) <= MAX_LABEL_BYTES:
        return own.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    # Many labels: a frequent one is dealt over SALTS partitions.
    salted = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = own.withColumn("at", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("at") == F.col("salt")), "left").drop("of", "at", "salt")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept vector."""
    stages = Stages(vectors.sparkSession, "codes")
    return with_label_error(codes(vectors, stages), stages)


def oracle_sql(rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``compress``, by full searches; all vectors must have one dimension, a multiple of 8."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT id, p, e, d FROM (
    SELECT x.id, x.p, c.e, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{r} c ON c.p = x.p AND c.i = x.i GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY id, p ORDER BY d, e) = 1)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT a.p, a.e, x.i, sum(x.v) AS s, count(*) AS n FROM a{r} a JOIN x ON x.id = a.id AND x.p = a.p GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.i, CASE WHEN s.n IS NULL THEN c.v ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS v
  FROM c{r} c LEFT JOIN s{r} s ON s.p = c.p AND s.e = c.e AND s.i = c.i)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda y: CAST(floor(4096 * CAST(y AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // {PARTS} AS size
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (SELECT id, (j - 1) // size AS p, (j - 1) % size AS i, v FROM
  (SELECT id, size, unnest(v) AS v, generate_subscripts(v, 1) AS j FROM kept)),
c0 AS MATERIALIZED (SELECT p, id - 1 AS e, i, v FROM x WHERE id <= {ENTRIES}),{','.join(steps)},
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM c{rounds}),
coded AS (
  SELECT id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), books
"""
