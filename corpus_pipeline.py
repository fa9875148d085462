"""Corpus pipeline: stages over ``documents``, each the input of the next, ending in packed sequences.

STAGES names the stages in order; a stage takes (spark, docs, sf_dir), works on all
rows its predecessor kept and returns a DataFrame, which ``run`` writes as Parquet
under the shared checkpoint folder and reads again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm import langid, linededup, minhash, toxicity
from critiq.llm.common import Stages, free_name, table, with_row_id
from critiq.llm.packing import CAPACITY, pack
from critiq.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, fitted on the documents themselves: those without a language go."""
    out = langid.predict(docs, langid.fit(docs))
    return out.where(F.col(free_name(docs, "lang_pred")) != langid.UNDETERMINED).select(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, fitted on the labelled documents: toxic ones go."""
    out = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return out.where(F.col(free_name(docs, "predicted")) == 0).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: shared lines go from all but one document; n_chars follows the text."""
    out = linededup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 on five-word shingles at 0.8: of a group, the first row stays.

    Rows are told apart by a number that is written with them once, so repeated ids are no trouble.
    """
    stages, row = Stages(spark, "near-dedup"), free_name(docs, "row")
    rows = stages.save(with_row_id(docs, row), "rows")
    numbered = rows.select(F.col(row).alias("row"), F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = minhash.near_rows(numbered, 5, 80, stages).where("not kept").select(F.col("doc_id").alias(row))
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of at most 1024 ids in sequences without padding."""
    pieces = pack(docs, tokenizer_file("byte_bpe_50k.json"), CAPACITY)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter), ("line_dedup", line_dedup),
          ("near_dedup", near_dedup), ("packing", packing)]

#: Language ID, toxicity and tokenisation have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is that of the last stage."""
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stages.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
