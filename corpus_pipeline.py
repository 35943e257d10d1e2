"""A corpus pipeline of five stages over ``documents``, each an operator of ``lodestream.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``.  A document is a row; the stages handle null and
empty texts as their operators say.
"""

from __future__ import annotations

import tempfile
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import line_dedup, packing, pii, quality, simhash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host is rejected, go."""
    return quality.keep_good(docs.select(*COLUMNS))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites stay in one document only."""
    return line_dedup.remove_boilerplate(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id."""
    return simhash.keep_one_each(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind."""
    return pii.redact(docs.select(*COLUMNS), pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left are tokenised and packed; one row per piece."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Fingerprints and token ids are not expressible in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared checkpoint folder."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="pipeline-")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return made
        path = f"{base}/pipeline-{uuid.uuid4().hex}/{number}-{name}"
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
