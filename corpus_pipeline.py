"""The corpus pipeline: language ID, quality, near duplicates, mixture and packing over the table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticelake.llm import langid, mixing, packing, quality, simjoin
from noticelake.llm.common import checkpoint, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or not of any language that the documents teach, go.

    Null and empty texts go; a null language teaches nothing and its document is judged as all are; documents that nobody can judge stay
    (see langid.keep_identified). Repeated rows stay or go together, other columns stay as they are, and an empty table stays empty.
    """
    return langid.keep_identified(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is over their language's threshold go.

    A null text is empty and counts its end alone; a null language has a threshold of its own; without trusted documents all stay, and so do
    those at the very threshold. Repeated rows stay or go together, other columns stay as they are, and an empty table stays empty.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest doc_id stays.

    Null and wordless texts are classes of their own; a null doc_id comes last, ties go to the smaller md5 of the text, and of fully repeated
    rows one stays. Other columns stay as they are, and an empty table stays empty.
    """
    return simjoin.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mixture takes it.

    A null language or source is a leaf of its own, a null text has no tokens and comes with its leaf's whole epochs, rows of one doc_id in one
    leaf are taken together. Other columns stay as they are, and an empty table stays empty.
    """
    return mixing.apply_mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences.

    Every row is a document of its own, repeated ones and those with a null doc_id too; a null text is the separator alone, and an empty
    table gives no pieces. Other columns are not read.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the checkpoint folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs


#: The classifiers and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
