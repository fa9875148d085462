"""Stored stages that a later run takes up again.

A stage's output is kept under a key made of what it depends on: its inputs (files with
size and time, or the keys of earlier stages), its parameters and the source text of the
code that builds it. A run with the same key reads the output; any change gives another
key and computes anew, so a stored stage is never out of date.

``by_document`` stages work on each document by itself. They keep, next to their rows,
a fingerprint of every document they have seen: a run computes the documents that are
new or have changed, adds them as one more part, and drops the rows of documents that
are gone or have changed. Where the files of the table are the same as in the last run,
nothing is read at all.

A stage counts once its manifest is there, which is written last, under another name
first and then renamed; a run that died leaves a folder that no manifest names.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session setting that names the folder in which the registered text queries keep their stages.
SETTING = "spark.critiq.stages.dir"
DOC = "_doc"


def code_version(*parts) -> str:
    """Hash of the source text of functions, classes or modules."""
    return hashlib.sha256("\n".join(inspect.getsource(p) for p in parts).encode()).hexdigest()


class StageStore:
    """Stages below one folder, which all executors must see."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def of(cls, spark: SparkSession) -> "StageStore | None":
        """The store that the session names, if any."""
        root = spark.conf.get(SETTING, None)
        return cls(spark, root) if root else None

    # ---- manifests

    def _read(self, folder: str) -> dict | None:
        path = self._path(f"{folder}/_MANIFEST.json")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _write(self, folder: str, manifest: dict) -> None:
        new = self._path(f"{folder}/_{uuid.uuid4().hex}.json")
        stream = self._fs.create(new, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        path = self._path(f"{folder}/_MANIFEST.json")
        if self._fs.exists(path):
            self._fs.delete(path, False)
        if not self._fs.rename(new, path):
            raise OSError(f"manifest of {folder} could not be renamed")

    def fingerprint(self, source: DataFrame | str) -> str:
        """Of a stage: its key. Of a table: its files with size and time, and its schema."""
        if isinstance(source, str):
            return source
        if key := getattr(source, "_stage_key", None):
            return key
        files = []
        for name in sorted(source.inputFiles()):
            path = self._path(name)
            status = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(path)
            files.append((name, status.getLen(), status.getModificationTime()))
        if not files:
            raise ValueError("a stage's input must be read from files or be a stage itself")
        return hashlib.sha256(json.dumps([files, source.schema.json()]).encode()).hexdigest()

    @staticmethod
    def _key(**parts) -> str:
        return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()

    # ---- whole stages

    def stage(self, name: str, build: Callable[[], DataFrame], inputs: Sequence[DataFrame | str], params: dict | None = None,
              code: Sequence = ()) -> DataFrame:
        """The stored output of ``build``, computed if its inputs, parameters or code are new."""
        key = self._key(name=name, inputs=[self.fingerprint(i) for i in inputs], params=params, code=code_version(build, *code))
        folder = f"{self.root}/{name}/{key}"
        manifest = self._read(folder)
        if manifest is None:
            data = f"data-{uuid.uuid4().hex}"
            out = build()
            out.write.parquet(f"{folder}/{data}")
            manifest = {"data": data, "schema": out.schema.json()}
            self._write(folder, manifest)
        return self._table(f"{folder}/{manifest['data']}", manifest["schema"], key)

    def _table(self, paths: str | list[str], schema: str, key: str) -> DataFrame:
        from pyspark.sql.types import StructType

        out = self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*([paths] if isinstance(paths, str) else paths))
        out._stage_key = key
        return out

    # ---- stages by document

    def by_document(self, name: str, docs: DataFrame, build: Callable[[DataFrame], DataFrame], params: dict | None = None,
                    code: Sequence = (), runs: bool = False) -> DataFrame:
        """Rows that ``build`` makes of each document by itself; only new and changed documents are computed.

        ``build`` gets documents with a column ``_doc``, which its rows must keep; equal documents
        count with their number. With ``runs``, the column ``_run`` tells which run (from 1) made a row.
        """
        kept = self._key(name=name, params=params, code=code_version(build, *code), schema=docs.schema.json())
        folder, source = f"{self.root}/{name}/{kept}", self.fingerprint(docs)
        manifest = self._read(folder) or {"parts": [], "runs": 0, "source": None, "schema": None}
        if manifest["source"] != source:
            before = manifest["parts"]
            manifest = self._bring_up(folder, manifest, docs, build)
            manifest["source"] = source
            self._write(folder, manifest)
            for part in set(before) - set(manifest["parts"]):  # replaced: tables read before this run are gone with it
                self._fs.delete(self._path(f"{folder}/{part}"), True)
        key = self._key(stage=kept, source=source)
        out = self._table([f"{folder}/{p}/rows" for p in manifest["parts"]], manifest["schema"], key)
        out = out if runs else out.drop("_run")
        result = out.drop(DOC)
        result._stage_key = key
        return result

    def _bring_up(self, folder: str, manifest: dict, docs: DataFrame, build: Callable[[DataFrame], DataFrame]) -> dict:
        """Bring the parts up to ``docs``: at most two parts are written."""
        run = manifest["runs"] + 1
        marked = docs.withColumn(DOC, F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})))
        now = marked.groupBy(DOC).agg(F.count("*").alias("n"))
        parts, schema = list(manifest["parts"]), manifest["schema"]
        if parts:
            seen = self.spark.read.schema(f"{DOC} string, n long").parquet(*[f"{folder}/{p}/seen" for p in parts])
            both = now.join(seen.withColumnRenamed("n", "was"), DOC, "full").where("not (n <=> was)")
            change = f"{folder}/change-{uuid.uuid4().hex}"
            both.write.parquet(change)
            both = self.spark.read.schema(f"{DOC} string, n long, was long").parquet(change)
            if not both.where("was is not null").isEmpty():  # rows of documents that are gone or changed
                part = f"part-{uuid.uuid4().hex}"
                gone = both.where("was is not null").select(DOC)
                rows = self._table([f"{folder}/{p}/rows" for p in parts], schema, "")
                rows.join(gone, DOC, "left_anti").write.parquet(f"{folder}/{part}/rows")
                seen.join(gone, DOC, "left_anti").write.parquet(f"{folder}/{part}/seen")
                parts = [part]
            new = both.where("n is not null").select(DOC, "n")
            if new.isEmpty():
                self._fs.delete(self._path(change), True)
                return {"parts": parts, "runs": run, "schema": schema}
            marked, now = marked.join(new, DOC, "left_semi"), new
        part = f"part-{uuid.uuid4().hex}"
        out = build(marked).withColumn("_run", F.lit(run))
        out.write.parquet(f"{folder}/{part}/rows")
        now.write.parquet(f"{folder}/{part}/seen")
        if manifest["parts"]:
            self._fs.delete(self._path(change), True)
        schema = schema or out.select(*[F.col(c) for c in out.columns]).schema.json()
        return {"parts": [*parts, part], "runs": run, "schema": schema}
