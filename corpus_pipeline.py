"""The corpus pipeline: quality rules, language ID, near-duplicates, decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, the last one their encodings. `run` writes the output of
each stage to the shared folder and hands what it reads back to the next one.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from admetrics.llm import bpe, langid, quality_rules, simhash, tiling
from admetrics.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Least posterior of the predicted language.
LEAST_SCORE = 0.5
#: Words of a shingle, and bits in which linked fingerprints may differ.
SHINGLE, BITS = 4, 4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learnt from the labelled ones."""
    model = langid.train(docs, TOKENIZER)
    judged = langid.predict(docs.select(F.struct("*").alias("row"), "text"), model, TOKENIZER)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=SHINGLE, bits=BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the text decoded from them."""
    fields = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode_texts(docs.select("doc_id", "text"), TOKENIZER, fields=fields).select("doc_id", *fields)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encoding),
]

#: SQL can't express language models, fingerprints, tiling or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
