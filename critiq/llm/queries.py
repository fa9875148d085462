"""Registered queries of the operators and the pipeline, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm import collocations, licenses, merkle, pivotcodes
from critiq.llm.common import table


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def id_remainder(n: int):
    """crc32 of doc_id as text, modulo n: decides which rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents")).drop("spans")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.langid import fit, predict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(4) == 2
    out = predict(docs.select("doc_id", "text"), fit(docs.where(~held_out)))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.piece_bpe import encode_decode

    rows = encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_vamana(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.vamana import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.htmltext import extract

    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.merkle import fingerprints

    rows = fingerprints(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(3) == 1
    lexicon = fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score(docs, lexicon).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.linededup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotcodes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critiq.llm.quality import fit, judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text")


OP10_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (s.key IS NOT NULL AND s.keeper <> k.doc_id) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_minhash": op2_minhash,
    "op3_language_id": op3_language_id,
    "op4_piece_bpe": op4_piece_bpe,
    "op5_vamana": op5_vamana,
    "op6_html_text": op6_html_text,
    "op7_merkle": op7_merkle,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_pivot_codes": op11_pivot_codes,
    "op12_collocations": op12_collocations,
    "op13_quality": op13_quality,
}

ORACLE: dict[str, str] = {
    "op1_licenses": licenses.oracle_sql(),
    "op7_merkle": merkle.oracle_sql(),
    "op10_line_dedup": OP10_SQL,
    "op11_pivot_codes": pivotcodes.oracle_sql(),
    "op12_collocations": collocations.oracle_sql(),
}
