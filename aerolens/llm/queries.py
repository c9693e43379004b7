"""The registered queries of the text operators: (spark, sf_dir) -> DataFrame.

Each calls its operator over whole tables and derives the digest columns of
its contract from the operator's results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolens.llm import (
    byte_bpe,
    decontaminate,
    embedding_forest,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    secret_scan,
    substring_rlz,
    suffix_dedup,
    token_alignment,
    url_templates,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary file; only its name is fixed here.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Likewise the two sides of the alignment.
SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


#: Rows of an Arrow batch: documents are long, so Spark's 10,000 would be tens of
#: megabytes, several times over in each worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Whether a row (by ``doc_id``) is kept out of training."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, ~held_out())
    return language_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE_RULES]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_rlz.substring_dedup_digest(_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup_digest(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe_digest(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.close_vectors(_table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licenses(_table(spark, sf_dir, "documents"))
    spans = F.transform("findings", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(spans, ",").alias("findings"),
        F.coalesce(F.array_max(F.transform("findings", lambda x: x["coverage"])), F.lit(0.0)).alias("coverage"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignments(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(SIDE_A),
        public_tokenizers.path(SIDE_B),
        groups=False,
    ).drop("groups")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return found.codes.withColumn("codebooks_sha256", F.lit(found.digest()))


# The rules that pages are judged by.
URL_RULES = [
    url_templates.Rule("allow", "com", "/"),
    url_templates.Rule("block", "example.com", "/en/"),
    url_templates.Rule("allow", "www.example.com", "/en/"),
    url_templates.Rule("block", "net", "/es/"),
    url_templates.Rule("block", "net", "/fr/"),
]


def op13_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def queries() -> dict[str, Query]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_language_id": op2_language_id,
        "op3_secret_scan": op3_secret_scan,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_line_dedup": op8_line_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_decontamination": op10_decontamination,
        "op11_token_alignment": op11_token_alignment,
        "op12_vector_codes": op12_vector_codes,
        "op13_url_templates": op13_url_templates,
    }
