"""A training-data pipeline over `documents`: each stage is one operator, written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxseries.llm import bpe, digest_index, langid, mixing, ngram_join
from voxseries.llm.common import Stages
from voxseries.llm.queries import WEIGHTS, domain, language_model, tokenizer_path

#: SQL has no mixture inference and no BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that are in no learned language (no letters), or of which no language makes up half."""
    marked = langid.identify(docs, language_model(docs))
    return marked.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= 0.5)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (blanks aside) the row with the smallest doc_id stays."""
    index = digest_index.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", f"{Stages(spark, 'index').root}/digests",
                                     docs.schema["doc_id"].dataType)
    return digest_index.drop_copies(index, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles of similarity 0.8 or more, the one with the smallest doc_id stays."""
    return ngram_join.drop_near_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen so that domains, languages and sources have their weights. None is repeated here."""
    taken = mixing.select(docs, domain(), WEIGHTS, share=0.8, other=0.1, max_epochs=1, seed=17, marked=True,
                          tokens=mixing.pieces(F.col("text")))
    return mixing.keep_taken(docs, taken, domain())


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids."""
    return bpe.encode(docs.select("doc_id", "text", "lang", "source"), tokenizer_path()).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language identification", identify_language),
    ("exact deduplication", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("BPE encoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
