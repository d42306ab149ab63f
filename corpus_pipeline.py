"""From raw documents to token ids: the corpus operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`docs`.  `run` writes what a stage returns to the shared folder and hands the reread table to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import bpe, mixing, neardup, pii, quality
from panelwright.llm.catalog import PII_KEY
from panelwright.llm.common import cut


def _length_anew(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now, where the table has that column."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level quality rules keep."""
    measured = cut(quality.measure(docs))
    rates = cut(quality.host_rates(measured))
    return quality.judged(measured, rates).where("_quality_verdict.kept").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates (0.8 on 5-word shingles)."""
    kept = neardup.near_duplicates(docs.select("doc_id", "text"), width=5, percent=80).where("kept")
    kept = cut(kept.select("doc_id").distinct())
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their personal data pseudonymised."""
    return _length_anew(pii.pseudonymised(docs, key=PII_KEY))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return _length_anew(mixing.mixed(docs))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, checked by decoding them."""
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids="token_ids", into="_decoded")
    return coded.select(
        *(c for c in docs.columns if c != "text"),
        F.expr("CAST(length(token_ids) div 4 AS BIGINT)").alias("n_tokens"),
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
        (F.sha2("_decoded", 256) == F.sha2(F.coalesce("text", F.lit("")), 256)).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", keep_good),
    ("near_dedup", keep_one_of_each),
    ("pii", replace_personal_data),
    ("mix", mix_sources),
    ("bpe", to_token_ids),
]

#: The keyed permutations, the shuffle's hash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
