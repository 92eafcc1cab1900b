"""A pipeline over documents: stages of the training-data operators, each written as a table that the next one reads.

Every stage works on all that the one before kept, and all columns of documents stay up to the last stage, whatever their names.
Null and empty texts pass all filters but exact dedup, where they are copies of each other, and end as rows without pieces. Rows
without doc_id are nobody's copy. Rows that repeat as a whole become one in exact dedup. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import common, exact_dedup, jaccard_join, mixing, sentencepieces, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; labels of training rows only are read."""
    return toxicity.drop_toxic(docs, common.table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the one with the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those it takes less than half of go."""
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the ids of its pieces."""
    return sentencepieces.encode(docs)


STAGES = [("toxicity", toxic), ("exact dedup", exact), ("n-gram jaccard join", near), ("mix sources", mix), ("sentencepiece", pieces)]

#: The stages hold a trained classifier and sampled segmentations, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each but the last is written to the shared folder and read again.

    What a stage has written for itself is removed once its result stands; so is the result once the next one does.
    """
    scratch, before = common.Scratch(spark), None
    docs = common.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        since = common.mark()
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.keep(docs)
            common.clear(spark, since)
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs
