"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm import chat, fingerprints, langid, merkle, mixing, packing, pages, quality, sharding, simjoin, spelling, toxicity, vectors
from noticelake.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_control_case(spark, table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(turns))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_simjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.linked_documents(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_documents(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_pages": op3_pages,
    "op4_chat": op4_chat,
    "op5_fingerprints": op5_fingerprints,
    "op6_vectors": op6_vectors,
    "op7_simjoin": op7_simjoin,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_langid": op10_langid,
    "op11_merkle": op11_merkle,
    "op12_toxicity": op12_toxicity,
    "op13_spelling": op13_spelling,
}
ORACLE_SQL = {"op1_mixing": mixing.ORACLE_SQL, "op4_chat": chat.ORACLE_SQL, "op11_merkle": merkle.ORACLE_SQL, "op13_spelling": spelling.ORACLE_SQL}
