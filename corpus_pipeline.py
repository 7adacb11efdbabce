"""A corpus pipeline: quality, near-duplicate removal, redaction, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of the documents they were given. Rows go to Python by
bytes, not by number (``bounded_batches``), and Python workers live on from
stage to stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cumload.llm import jaccard, mixing, packing, pii, quality
from cumload.llm.common import bounded_batches, checkpointed, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that are not held out, does not reject.

    Null and empty texts are scored like any other; long texts are read whole; rows alike are judged alike; an empty
    table stays empty; the columns stay as they are, also those named ``score`` or ``predicted``.
    """
    bounded_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~quality.held_out()))
    return quality.kept(docs, model)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Texts without words are groups of their own by id; rows alike in id and text stay once; of a group the lowest id
    stays; an empty table stays empty; the columns stay as they are.
    """
    bounded_batches(spark)
    return jaccard.one_of_each(docs, jaccard.join(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind.

    Null texts stay null and empty ones empty; long texts are searched whole; rows alike each stay; an empty table stays
    empty; the columns stay as they are, also those named ``found``.
    """
    return pii.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and pass over its source, with the words taken in that pass.

    Null, empty and blank texts have no words to take and give no rows; long texts may be taken in parts; rows alike
    count once; an empty table stays empty; the columns stay as they are, also those named ``taken``.
    """
    bounded_batches(spark)
    return mixing.mixed_documents(docs, mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of the closing id; long texts are cut into full sequences; rows alike are packed
    each; an empty table gives no rows; columns other than doc_id and text are left out.
    """
    bounded_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: A fitted classifier, chosen paths and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
