"""A corpus pipeline of five stages over ``documents``: quality rules, near-dedup, benchmark decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents, whatever they are named; an empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import decontaminate, mixing, near_copies, quality, token_files
from textloom.llm._util import Scratch, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are among them. A null language is judged by script."""
    rules = quality.Rules(public_tokenizers.path("piece_bpe_32k.model"))
    return docs.where(quality.kept_column(rules, F.col("text"), F.col("lang")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays (sets of five-word shingles alike to 0.8 or more, and what these link): that of
    the smallest id (null last), of equal ids that of the smallest hash of its text. Null and empty texts are one group; rows equal in
    id and text are copies."""
    return near_copies.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go. Null and empty texts repeat none, null and empty items are repeated by none."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a null source is a source, a text without words is never taken. Rows of equal id
    are taken together."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back: doc_id, start, n_tokens, ids_crc32. Null ids come first; a null text is the end id alone."""
    return token_files.token_table(docs, token_files.Vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [("quality", quality_stage), ("simhash", dedup_stage), ("decontaminate", decontaminate_stage), ("mix", mix_stage), ("tokens", token_stage)]

#: Tokenisers and fingerprints are beyond SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.save(docs, name)
            if k:
                scratch.drop(STAGES[k - 1][0])
    return docs
