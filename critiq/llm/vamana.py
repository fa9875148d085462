"""Operator 5: near-duplicate vectors by a flat graph with robust pruning.

1. Equal vectors are one class with a count. Null, zero and non-finite vectors, and
   those with a null component, are linked with nothing.
2. k-means centroids come from a bounded sample of classes (SAMPLE rows with the
   smallest hash); every class joins the OVERLAP nearest clusters, its shards. A
   shard above BLOCK classes is dealt by hash over base blocks, and each of its
   classes is a query to all of them, so a shard of any size is searched whole.
3. In every block each class takes its nearest classes as candidates and robustly
   prunes them to DEGREE neighbours; as many reverse edges are added. Lists of one
   class from several shards are united.
4. Every class is searched in its shards: a greedy beam search from the block's
   medoid (and from the class itself where it is in the block), then a range
   expansion over neighbours that are no more than SLACK below the threshold.
5. What is found is verified by cosine in double precision. A link is counted in the
   first shard that both classes share. A task returns a count per query and, for the
   components, one edge per class to the smallest class of its local component; pairs
   of a group are never emitted.

``audit`` measures recall against brute force on a bounded sample of queries.

Vectors of different lengths are in different shards and never linked. Repeated rows
are vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.common import Stages, group_arrow, map_arrow
from critiq.llm.components import components

#: Classes that centroids are fitted on, at most; classes per cluster, about; clusters a class joins.
SAMPLE, CLUSTER, OVERLAP = 20_000, 2_000, 3
#: Base classes of a block.
BLOCK = 4_096
#: Candidates of a class, neighbours it keeps, and the pruning factor.
CANDIDATES, DEGREE, ALPHA = 96, 24, 1.2
#: Beam of the greedy search, and how far below the threshold the range expansion goes on.
BEAM, SLACK = 32, 0.05


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors from a column of float64 bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def vector_keys(vectors: DataFrame) -> DataFrame:
    """vec_id, key (hash of the vector; null where it takes no part), dims and unit (float64 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            keys, dims, units = [], [], []
            for v in p.column("embedding").to_pylist():
                x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
                with np.errstate(all="ignore"):
                    scaled = x / np.abs(x).max() if len(x) and np.isfinite(x).all() and x.any() else None
                if scaled is None:
                    keys.append(None), dims.append(None), units.append(None)
                    continue
                keys.append(xxhash.xxh3_128_hexdigest((x + 0.0).tobytes()))
                dims.append(len(x))
                units.append((scaled / np.sqrt(scaled @ scaled)).tobytes())
            yield pa.RecordBatch.from_arrays([p.column("vec_id"), pa.array(keys, pa.string()), pa.array(dims, pa.int32()),
                                              pa.array(units, pa.binary())], ["vec_id", "key", "dims", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return map_arrow(rows, run, "vec_id long, key string, dims int, unit binary")


def fit_centroids(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Spherical k-means by vector length on a bounded sample; about n / CLUSTER clusters in all."""
    rows = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("dims", "unit").toArrow()
    out = {}
    for d in np.unique(rows.column("dims").to_numpy()):
        own = rows.filter(pa.compute.equal(rows.column("dims"), int(d)))
        x = _matrix(own.column("unit"))
        k = int(np.clip(round(n * len(x) / len(rows) / CLUSTER), 1, max(1, len(x) // 8)))
        centre = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ centre.T).argmax(1)
            new = np.zeros_like(centre)
            np.add.at(new, near, x)
            size = np.linalg.norm(new, axis=1, keepdims=True)
            centre = np.where(size > 0, new / np.maximum(size, 1e-300), centre)
        out[int(d)] = centre
    return out


def assign(classes: DataFrame, centroids: dict[int, np.ndarray]) -> DataFrame:
    """Classes with their shards; shard numbers are unique over vector lengths."""
    first, start = {}, 0
    for d, c in sorted(centroids.items()):
        first[d], start = start, start + len(c)
    other = start  # lengths outside the sample: a shard per length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            shards: list = [None] * p.num_rows
            dims = p.column("dims").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) not in centroids:
                    for i in at:
                        shards[i] = [other + int(d)]
                    continue
                sims = _matrix(p.column("unit").take(pa.array(at))) @ centroids[int(d)].T
                for i, best in zip(at, np.argsort(-sims, axis=1)[:, :OVERLAP]):
                    shards[i] = sorted(first[int(d)] + int(b) for b in best)
            yield pa.RecordBatch.from_arrays([*p.columns, pa.array(shards, pa.list_(pa.int32()))], [*p.schema.names, "shards"])

    return map_arrow(classes.select("id", "n", "dims", "unit"), run, "id long, n long, dims int, unit binary, shards array<int>")


def prune(x: np.ndarray) -> list[np.ndarray]:
    """Robustly pruned neighbours of each row of ``x`` among all rows (unit vectors)."""
    m = len(x)
    k = min(CANDIDATES, m - 1)
    if k < 1:
        return [np.zeros(0, np.int64)] * m
    candidates, near = np.zeros((m, k), np.int64), np.zeros((m, k))
    for i in range(0, m, 1024):
        sims = x[i:i + 1024] @ x.T
        sims[np.arange(len(sims)), np.arange(i, i + len(sims))] = -2
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(sims, top, 1), axis=1, kind="stable")
        candidates[i:i + 1024] = np.take_along_axis(top, order, 1)
        near[i:i + 1024] = np.take_along_axis(sims, candidates[i:i + 1024], 1)
    alive = np.ones((m, k), bool)
    kept: list[list[int]] = [[] for _ in range(m)]
    rows = np.arange(m)
    for _ in range(DEGREE):
        rows = rows[alive[rows].any(1)]
        if not len(rows):
            break
        pick = alive[rows].argmax(1)
        chosen = candidates[rows, pick]
        for r, c in zip(rows, chosen):
            kept[r].append(int(c))
        alive[rows, pick] = False
        for i in range(0, len(rows), 512):  # candidates closer to the chosen one than to the row go
            part = rows[i:i + 512]
            between = np.einsum("rkd,rd->rk", x[candidates[part]], x[chosen[i:i + 512]])
            alive[part] &= ALPHA * np.sqrt(np.maximum(2 - 2 * between, 0)) > np.sqrt(np.maximum(2 - 2 * near[part], 0))
    return _with_reverse([np.array(a, np.int64) for a in kept])


def _with_reverse(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Neighbour lists with up to DEGREE reverse edges each, those of the least pointed-to classes first,
    so that a class which nobody kept can be reached."""
    source = np.repeat(np.arange(len(lists)), [len(a) for a in lists])
    target = np.concatenate(lists)
    pointed = np.bincount(target, minlength=len(lists))
    order = np.lexsort((source, pointed[source], target))
    source, target = source[order], target[order]
    ends = np.searchsorted(target, np.arange(len(lists) + 1))
    out = []
    for i, a in enumerate(lists):
        back = source[ends[i]:ends[i + 1]]
        out.append(np.concatenate([a, back[~np.isin(back, a)][:DEGREE]]))
    return out


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs within the threshold; ``graph`` is [row, neighbour] with -1 for none,
    ``own`` each query's row in ``x`` or -1."""
    m, q = len(x), len(queries)
    seen = np.zeros((q, m), bool)
    medoid = int((x @ x.mean(0)).argmax())
    width = min(BEAM, m)
    beam, sims = np.full((q, width), -1), np.full((q, width), -3.0)
    done = np.ones((q, width), bool)
    beam[:, 0], sims[:, 0], done[:, 0] = medoid, queries @ x[medoid], False
    seen[:, medoid] = True
    starts = np.flatnonzero((own >= 0) & (own != medoid))
    if width > 1:
        beam[starts, 1], done[starts, 1] = own[starts], False
        sims[starts, 1] = np.einsum("qd,qd->q", queries[starts], x[own[starts]])
        seen[starts, own[starts]] = True
    found_q, found_x = [], []

    def note(qs: np.ndarray, xs: np.ndarray, s: np.ndarray) -> None:
        hit = s >= threshold - SLACK
        found_q.append(qs[hit])
        found_x.append(xs[hit])

    note(np.repeat(np.arange(q), width)[beam.ravel() >= 0], beam[beam >= 0], sims[beam >= 0])
    active = np.arange(q)
    while len(active):
        open_ = np.where(done[active], -4.0, sims[active])
        best = open_.argmax(1)
        going = open_[np.arange(len(active)), best] > -3.5
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = graph[beam[active, best]]
        ok = (near >= 0) & ~seen[active[:, None], near]
        r, c = np.nonzero(ok)
        qs, xs = active[r], near[r, c]
        seen[qs, xs] = True
        s = np.einsum("pd,pd->p", queries[qs], x[xs])
        note(qs, xs, s)
        fresh = np.full(near.shape, -3.0)
        fresh[r, c] = s
        all_sims = np.concatenate([sims[active], fresh], 1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        sims[active] = np.take_along_axis(all_sims, top, 1)
        beam[active] = np.take_along_axis(np.concatenate([beam[active], near], 1), top, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], ~ok], 1), top, 1)
    # Range expansion from all that lies near the threshold or above it.
    front_q, front_x = np.concatenate(found_q), np.concatenate(found_x)
    while len(front_q):
        next_q, next_x = [], []
        for i in range(0, len(front_q), 65_536):
            near = graph[front_x[i:i + 65_536]]
            qs = np.repeat(front_q[i:i + 65_536], near.shape[1])
            xs = near.ravel()
            ok = (xs >= 0) & ~seen[qs, xs]
            pair = np.unique(qs[ok] * m + xs[ok])
            qs, xs = pair // m, pair % m
            seen[qs, xs] = True
            hit = np.einsum("pd,pd->p", queries[qs], x[xs]) >= threshold - SLACK
            next_q.append(qs[hit])
            next_x.append(xs[hit])
        front_q, front_x = np.concatenate(next_q), np.concatenate(next_x)
        found_q.append(front_q)
        found_x.append(front_x)
    qs, xs = np.concatenate(found_q), np.concatenate(found_x)
    keep = np.zeros(len(qs), bool)
    for i in range(0, len(qs), 65_536):
        keep[i:i + 65_536] = np.einsum("pd,pd->p", queries[qs[i:i + 65_536]], x[xs[i:i + 65_536]]) >= threshold
    return qs[keep], xs[keep]


def _local(a: np.ndarray, b: np.ndarray, n: int, order: np.ndarray) -> np.ndarray:
    """Smallest ``order`` in the component of each of n nodes with edges (a, b)."""
    label = order.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (label == before).all():
            return label


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id, embedding)."""
    stages = Stages(vectors.sparkSession, "vectors")
    rows = stages.save(vector_keys(vectors), "rows")
    classes = stages.save(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("dims").alias("dims"), F.first("unit").alias("unit"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    placed = stages.save(assign(classes, fit_centroids(classes, classes.count())), "placed")
    sizes = placed.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = placed.select("*", F.explode("shards").alias("shard")).join(sizes, "shard")
    member = member.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("id").to_numpy()
        lists = [ids[a] for a in prune(_matrix(t.column("unit")))]
        ends = np.concatenate([[0], np.cumsum([len(a) for a in lists])]).astype(np.int32)
        return pa.table({"id": ids, "near": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))})

    lists = group_arrow(member.select("shard", "block", "id", "unit"), ["shard", "block"], build, "id long, near array<long>")
    graph = stages.save(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")

    columns = ["shard", "id", "n", "unit", "shards"]
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    base = member.join(graph, "id").select(*columns, "near", F.col("block").alias("i"), every.alias("j"), F.lit(True).alias("is_base"))
    query = member.select(*columns, F.lit(None).cast("array<long>").alias("near"), every.alias("i"), F.col("block").alias("j"),
                          F.lit(False).alias("is_base"))

    def find(t: pa.Table) -> pa.Table:
        is_base = np.array(t.column("is_base").to_pylist(), bool)
        ids, n = t.column("id").to_numpy(), t.column("n").to_numpy()
        shard = t.column("shard")[0].as_py()
        unit = _matrix(t.column("unit"))
        at_base, at_query = np.flatnonzero(is_base), np.flatnonzero(~is_base)
        number = {int(v): i for i, v in enumerate(ids[at_base])}
        near = [[number[v] for v in a if v in number] for a in t.column("near").filter(pa.array(is_base)).to_pylist()]
        graph = np.full((len(near), max(map(len, near), default=0) or 1), -1)
        for i, a in enumerate(near):
            graph[i, :len(a)] = a
        own = np.array([number.get(int(v), -1) for v in ids[at_query]])
        qs, xs = search(unit[at_base], graph, unit[at_query], own, threshold)
        other = own[qs] != xs
        qs, xs = at_query[qs[other]], at_base[xs[other]]
        # Counted in the first shard that both share.
        shards = t.column("shards").to_pylist()
        table = np.full((len(ids), max(map(len, shards))), -1)
        for i, s in enumerate(shards):
            table[i, :len(s)] = s
        mine = np.ones(len(qs), bool)
        for k in range(table.shape[1]):
            s = table[qs, k]
            mine &= ~((s >= 0) & (s < shard) & (table[xs] == s[:, None]).any(1))
        links = np.bincount(qs[mine], n[xs[mine]], len(ids)).astype(np.int64)
        least = _local(qs, xs, len(ids), ids.copy())
        return pa.table({"id": ids[at_query], "links": links[at_query], "least": least[at_query]})

    found = stages.save(group_arrow(base.unionByName(query), ["shard", "i", "j"], find, "id long, links long, least long"), "found")
    parts = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")), stages)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("key", "id", "n", "vec_id").join(links, "id", "left").join(parts, "id", "left") \
        .withColumn("part", F.coalesce("component", "id"))
    least = named.groupBy("part").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "part").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "key").join(named, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def audit(vectors: DataFrame, result: DataFrame, threshold: float = 0.9, every: int = 50, most: int = 2_000) -> tuple[int, int]:
    """(links found, links by brute force) over the vectors whose id is divisible by ``every``,
    at most ``most`` of them, each against all rows."""
    keyed = vector_keys(vectors)
    queries = keyed.where(f"key is not null and vec_id % {every} = 0").orderBy("vec_id").limit(most).select("vec_id", "dims", "unit").toArrow()
    ids, dims, unit = queries.column("vec_id").to_pylist(), queries.column("dims").to_numpy(), queries.column("unit").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for p in batches:
            for d in np.unique(dims):
                own = p.filter(pa.compute.equal(p.column("dims"), int(d)))
                at = np.flatnonzero(dims == d)
                if own.num_rows:
                    x = np.frombuffer(b"".join(unit[i] for i in at), np.float64).reshape(len(at), -1)
                    total[at] += (x @ _matrix(own.column("unit")).T >= threshold).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total)], ["vec_id", "n"])

    true = map_arrow(keyed.where("key is not null"), run, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    row = true.join(result.select("vec_id", "n_links"), "vec_id").agg(F.sum(F.least("n", "n_links")), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)
