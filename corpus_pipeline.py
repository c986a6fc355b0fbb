"""From raw documents to token ids: five stages, each written as Parquet and read again.

1. language_id: documents without a letter, or whose language is not clear, go.
2. exact_dedup: of equal texts, one document stays.
3. jaccard_join: of each group of linked near duplicates, the document with the
   smallest id stays.
4. mix_sources: sources are mixed to their target weights; a document comes as
   often as the mix takes it.
5. piece_sampling: the text as sampled SentencePiece ids. Each copy of a document has
   a number and draws its own pieces.

Inside a stage a document is known by its id and a hash of its text, so ids may
be NULL or repeat; rows equal in both count as one document from stage 2 on. ``run``
removes a stage's folder when its reader is done; the folder of stage 4 stays, because the result is read from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from blotter.llm import exact_dedup, jaccard_join, language_id, mixing, piece_sampling
from blotter.session import checkpoint_dir
from blotter.sources import files

MIN_LANGUAGE_SCORE = 0.5  # below it no language has most of the evidence

ORACLE_SQL = None  # model fits, sampled pieces: tests hold the stages against brute force


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, id, text, source): the whole row beside what the operators look at."""
    return docs.select(F.struct("*").alias("row"), F.struct("doc_id", F.xxhash64("doc_id", "text").alias("text_hash")).alias("id"),
                       "text", "source")


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    # the rows are dealt by id once, for the join and for the repeated rows
    return _keyed(docs).select("id", "row").join(ids, "id", "left_semi").dropDuplicates(["id"]).select("row.*")


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    found = language_id.identify(_keyed(docs).select("row", "text"), model)
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(_keyed(docs), id_col="id")
    return _keep(docs, found.filter("kept").select(F.col("doc_id").alias("id")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(_keyed(docs), id_col="id")
    return _keep(docs, found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("id")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(_keyed(docs), id_col="id")
    times = found.filter("copies > 0").groupBy(F.col("doc_id").alias("id")).agg(F.sum("copies").alias("copies"))
    rows = _keyed(docs).select("id", "row").join(times, "id").dropDuplicates(["id"])
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    numbered = docs.select("doc_id", "text").withColumn("copy", F.row_number().over(same))
    keyed = numbered.select("doc_id", "copy", F.struct("doc_id", "copy").alias("draw"), "text")
    return piece_sampling.encode_pieces(keyed, key_col="draw").drop("draw")


STAGES = [
    ("language_id", languages),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("mix_sources", mixture),
    ("piece_sampling", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                files.delete(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
