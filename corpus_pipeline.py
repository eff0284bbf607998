"""A corpus pipeline: documents in, token ids of a clean, mixed corpus out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of documents; ``run`` writes each result and reads it again.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from linkrank.llm.bpe import encode_documents
from linkrank.llm.jaccard import keep_one_of_each
from linkrank.llm.langid import keep_identified
from linkrank.llm.mixing import mix_documents
from linkrank.llm.toxicity import keep_clean
from linkrank.session import scratch_folder, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores 0.5 or more go."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with enough confidence go."""
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share four fifths of their runs of five words the smallest doc_id stays."""
    return keep_one_of_each(docs, words=5, least=Fraction(4, 5))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix in training order: a document may be left out or come twice, always whole."""
    return mix_documents(docs, whole=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and the digests that tell ids and decoded text."""
    return encode_documents(docs, ("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Trained models and a BPE are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{number}-{name}")
    return docs
