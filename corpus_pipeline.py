"""A training corpus from raw documents: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm.common import join_documents, stage
from acreage.llm.decontam import decontaminate
from acreage.llm.langid import UNKNOWN, identify
from acreage.llm.line_dedup import line_dedup
from acreage.llm.minhash_join import drop_near_duplicates
from acreage.llm.pieces import encode
from acreage.llm.queries import PIECE_MODEL

#: Mean label probability below which the language of a document counts as not recognised; with
#: four languages a guess has 0.25.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; `lang` becomes the predicted one."""
    found = identify(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    found = found.select("doc_id", "text_key", "lang_pred").dropDuplicates(["doc_id", "text_key"])
    kept = [F.col("lang_pred").alias(c) if c == "lang" else F.col(f"doc.`{c}`") for c in docs.columns]
    return join_documents(docs, found, "doc_id", "text").select(*kept)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier in the corpus; a document of which nothing is left goes."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "n_chars")])
    left = line_dedup(docs.select("doc_id", "text", rest.alias("rest")), window=1)
    gone = (F.col("dedup.n_removed") > 0) & (F.trim("dedup.text") == "")
    new = {"doc_id": F.col("doc_id"), "text": F.col("dedup.text"), "n_chars": F.length("dedup.text").cast("long")}
    kept = [new[c].alias(c) if c in new else F.col(f"rest.`{c}`") for c in docs.columns]
    return left.where(~F.coalesce(gone, F.lit(False))).select(*kept)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return encode(docs, PIECE_MODEL).withColumn("n_pieces", F.size("pieces"))


STAGES = [
    ("language_id", language), ("line_dedup", lines), ("near_dedup", near_duplicates),
    ("decontamination", benchmark), ("sentencepiece", tokens),
]

#: Trained models and vocabularies are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
