"""A training-corpus pipeline over ``documents``, stage after stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` applies them in order to the
table. Rows with null text or text without letters go in the first stage; no
later stage drops a clean document.

Every stage looks at whole texts, gives no rows for an empty table, and keeps
all columns that it gets, whatever their names, but for the last, which reads
id, text and source only. Null and repeated ids have no meaning of their own:
each stage says what it does with repeated rows and ties.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolens.llm import byte_bpe, decontaminate, language_id, line_dedup, minhash_dedup
from aerolens.llm.queries import RANKS, held_out, small_batches


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go (operator 2): null, empty and
    letterless texts, and texts too far from every learned language. Repeated
    rows share their fate; null ids are predicted but not learned from."""
    small_batches(spark)
    return language_id.accepted(docs, language_id.train(docs, ~held_out()))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, up to two edits, go (operator 8), and documents of
    which nothing is left. Null and empty texts stay as they are. A null id
    counts as the largest; rows equal in id and text keep the same lines."""
    small_batches(spark)
    return line_dedup.drop_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (operator 1): shingles
    of five words, similarity 0.8. It is that of the smallest id (null the
    largest), then text hash, then JSON, so of repeated rows one stays. Texts
    without words (null, empty) are in no group and all stay."""
    small_batches(spark)
    return minhash_dedup.one_of_each(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go (operator 10). Null and
    empty texts hold none; repeated rows share their fate."""
    small_batches(spark)
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of the round trip (operator 6); a row
    for each row, null and empty texts without tokens."""
    small_batches(spark)
    return byte_bpe.tokenized(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_documents),
    ("byte-level BPE", encode_tokens),
]

#: SQL can't express the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
