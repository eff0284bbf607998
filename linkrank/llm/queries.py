"""One query per operator over the test tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.ann import build_index, search
from linkrank.llm.bpe import encode_documents
from linkrank.llm.conversations import conversation_nodes
from linkrank.llm.copies import exact_copies
from linkrank.llm.jaccard import similar_documents
from linkrank.llm.langid import languages
from linkrank.llm.lattice import near_duplicates
from linkrank.llm.licenses import scan_licenses
from linkrank.llm.mixing import mix_plan
from linkrank.llm.negatives import hard_negatives
from linkrank.llm.oracles import ORACLES
from linkrank.llm.token_files import token_digests, write_token_files
from linkrank.llm.toxicity import toxicity_scores
from linkrank.llm.warc import read_archives, write_archives
from linkrank.session import scratch_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives and reads them back."""
    archives = write_archives(_table(spark, sf_dir, "pages"), scratch_folder(spark, "warc"))
    return read_archives(archives, payloads=False).drop("payload")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents to seekable files and reads them back."""
    return token_digests(write_token_files(_table(spark, sf_dir, "documents"), scratch_folder(spark, "tokens")))


def op3_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector, among all."""
    vectors = _table(spark, sf_dir, "embeddings")
    return search(build_index(vectors), vectors.where("vec_id % 50 = 0"))


def op4_lattice_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with equal labels."""
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes all documents."""
    return encode_documents(_table(spark, sf_dir, "documents"), ("ids_sha256", "decoded_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores all documents, after learning from the labels outside the held-out fold."""
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of each document, in training order."""
    return mix_plan(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt outside the held-out fold."""
    return languages(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of each document."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share nine tenths of their word triples."""
    return similar_documents(_table(spark, sf_dir, "documents"))


def op11_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts that each document is in, and whether it is the one that stays."""
    return exact_copies(_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All beginnings that the rebuilt conversations share or have to themselves."""
    return conversation_nodes(_table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every fiftieth vector; every seventh vector has moved to the next label."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", moved)
    return hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_roundtrip": op1_warc_roundtrip,
    "op2_token_files": op2_token_files,
    "op3_projected_neighbours": op3_projected_neighbours,
    "op4_lattice_duplicates": op4_lattice_duplicates,
    "op5_bpe_lexicon": op5_bpe_lexicon,
    "op6_toxicity": op6_toxicity,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_language_id": op8_language_id,
    "op9_license_scan": op9_license_scan,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_exact_copies": op11_exact_copies,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": pipeline,
}
