"""Exact duplicates by distributed most-significant-digit radix partitioning.

Documents are split by their length and first bytes, then again and again by the bytes that follow, each digit wider than the
one before. A group of one document is done and leaves; a group whose bytes have ended holds equal texts. Bytes are compared
as they are: no digest takes part. Only counts and the smallest id of each group are aggregated, with partial sums before the
shuffle, so a group that holds a third of all rows reaches the reducers as one row for each task. The number of rounds is
logarithmic in the longest text that has a copy.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Bytes of the first digit, and how many times wider each next one is.
FIRST, WIDER = 64, 64


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.SPACE_RUN, " ")


def _found(docs: DataFrame, scratch: C.Scratch, first: int, wider: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, sha of all rows, and doc_id, sha, keep_id, group_size of those that have equals, each once."""
    base = docs.select("doc_id", normalised(docs["text"]).alias("t"))
    base = base.select("doc_id", F.col("t").cast("binary").alias("b"), F.unhex(F.sha2("t", 256)).alias("sha"))
    active = base.where(F.col("doc_id").isNotNull()).select("doc_id", "sha", F.octet_length("b").cast("long").alias("g"), "b")
    width, done = first, []
    while True:
        digit = F.substring("b", 1, width)
        groups = active.groupBy("g", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where("n > 1")
        # a table of their own, so that the join can split a hot group; merged at any size, so that needs grow with the input
        groups = scratch.keep(groups).hint("merge")
        split = (
            active.withColumn("digit", digit)
            .join(groups, ["g", "digit"])
            .select("doc_id", "sha", F.col("least").alias("g"), "n", F.substring("b", width + 1, 2**31 - 1 - width).alias("b"))
            .withColumn("ended", F.octet_length("b") == 0)
        )
        split = scratch.keep(split)
        done.append(split.where("ended").select("doc_id", "sha", F.col("g").alias("keep_id"), F.col("n").alias("group_size")))
        active = split.where("not ended").select("doc_id", "sha", "g", "b")
        if active.isEmpty():
            break
        width *= wider
    return base.select("doc_id", "sha"), reduce(DataFrame.unionAll, done).distinct()


def exact_groups(docs: DataFrame, first: int = FIRST, wider: int = WIDER) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (doc_id, text, ...).

    Texts are equal when identical after `normalised`; the smallest doc_id of equal texts is kept. Empty, blank-free and null
    texts are equal to each other. Rows that repeat both doc_id and text are one document: each counts in group_size and all
    get the same answer. A row without doc_id is nobody's copy: keep_id is null, group_size 1, kept true. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    scratch = C.Scratch(docs.sparkSession)
    rows, found = _found(docs, scratch, first, wider)
    return rows.join(scratch.keep(found).hint("merge"), ["doc_id", "sha"], "left").select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that `exact_groups` keeps, with all columns, whatever their names.

    Rows that repeat both doc_id and text stay once; rows without doc_id all stay. Null and empty texts are equal. An empty
    table stays empty.
    """
    scratch = C.Scratch(docs.sparkSession)
    found = scratch.keep(_found(docs, scratch, FIRST, WIDER)[1])
    sha, has, its, keeper = C.fresh(docs, "_sha", "_has", "_its", "_keeper")
    found = found.select(F.col("doc_id").alias(has), F.col("sha").alias(its), F.col("keep_id").alias(keeper))
    rows = docs.withColumn(sha, F.unhex(F.sha2(normalised(docs["text"]), 256)))
    rows = rows.join(found.hint("merge"), (F.col("doc_id") == F.col(has)) & (F.col(sha) == F.col(its)), "left")
    alone = rows.where(F.col(keeper).isNull())
    first = rows.where(F.col(keeper) == F.col("doc_id")).dropDuplicates(["doc_id", sha])
    return alone.unionAll(first).select(*docs.columns)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`exact_groups` over all documents."""
    return exact_groups(C.table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
