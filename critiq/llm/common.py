"""Helpers shared by the operators of this folder: tables, materialised stages, Arrow texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import critiq
from critiq.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables, read whole; Catalyst prunes the columns."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Tables written under the shared checkpoint folder to cut lineage.

    Every table lies in a folder of its own below ``spark.checkpoint.dir``, which
    all executors see, so a lost executor loses nothing that was written. ``drop``
    deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` once and return the table read back (fresh lineage)."""
        path = self.path(name)
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """A number per row that is unique within one job; repeated ids stay separate rows."""
    return df.withColumn(name, F.monotonically_increasing_id())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores where a column of the input has it already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a piece take about ``max_bytes``.

    A single text above the bound makes a piece of its own, whole.
    """
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
                           .to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 offsets into them; a null text has no bytes."""
    column = pa.compute.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as any job's --py-files would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(critiq.__file__ or critiq.__path__[0]).resolve()
    root = root.parent if root.is_file() else root
    file = Path(tempfile.mkdtemp(prefix="critiq-py-")) / "critiq.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
        if not (root / "__init__.py").exists():
            z.writestr("critiq/__init__.py", "")
    sc.addPyFile(str(file))
    _SHIPPED.add(sc.applicationId)


_CACHES: dict[str, dict] = {}


def task_cache(owner: str) -> dict:
    """What an operator keeps in a Python worker between its tasks; what others kept there goes."""
    for other in [o for o in _CACHES if o != owner]:
        del _CACHES[other]
    return _CACHES.setdefault(owner, {})


#: Memory of a Python worker from which it gives back what it has freed.
LARGE_WORKER = 250 << 20


def _resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def give_back(least: int = LARGE_WORKER) -> None:
    """Return freed memory of a large Python worker to the machine; workers live on after their task."""
    with contextlib.suppress(OSError, AttributeError):  # other systems have other calls; there it stays as it is
        if _resident() < least:
            return
        gc.collect()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)


def _returning(run):
    """``run`` over batches, with its memory given back at the end of the task."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(_returning(run), schema)


def group_arrow(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """``applyInArrow`` on groups with this package on the executors."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(run, schema)


def add_columns(df: DataFrame, text: str, fields: list[tuple[str, str]], verdicts) -> DataFrame:
    """``df`` with the columns that ``verdicts(texts)`` gives for each batch of its text column.

    ``fields`` are (name, type) pairs; a name that ``df`` has already gets underscores
    before it. Rows stay where they are: nothing is shuffled.
    """
    names = [free_name(df, n) for n, _ in fields]
    at = next(i for i, c in enumerate(df.columns) if c.lower() == text)
    columns, out = [*df.columns, *names], df.columns[at]
    df = df.withColumn(out, F.col(f"`{out}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, out):
            yield pa.RecordBatch.from_arrays([*part.columns, *verdicts(part.column(at).to_pylist())], columns)

    kinds = [*df.dtypes, *((n, k) for n, (_, k) in zip(names, fields))]
    return map_arrow(df, run, ", ".join(f"`{c}` {k}" for c, k in kinds))
