"""Graphs that arrive over time, merged into a corpus: a file stream and one merge for each batch.

Nodes lie in buckets by the hash of their id. A batch reads the buckets that its own nodes fall into, merges those and writes them
anew; all others stay as they are. The manifest (`sources.commits`) tells which batch each bucket is read from, so that readers see
a batch whole or not at all, a batch that is replayed changes nothing, and buckets that are read no more are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..sources.commits import Store

NODE = "source_ord bigint, node_pos bigint, node_id string, types array<string>, props map<string,string>"
CORPUS = "bucket string, node_id string, types array<string>, props map<string,string>, seen_ord bigint, seen_pos bigint"
BUCKETS = 256


def bucket_of(node_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(node_id), F.lit(buckets)).cast("string")


def _state(store: Store) -> tuple[int, int | None]:
    """The last batch that was merged, and how many buckets the corpus has."""
    r = store.manifest().select(F.split("digest", "/").alias("d")).agg(F.max(F.col("d")[0].cast("bigint")), F.max(F.col("d")[1].cast("int"))).first()
    return (-1 if r[0] is None else r[0]), r[1]


def add_batch(corpus_root: str, batch: DataFrame, batch_id: int, buckets: int = BUCKETS) -> bool:
    """Merge a batch of nodes (NODE) into the corpus; False if it was merged before, whatever it holds now.

    buckets counts when the corpus is begun. What is there comes before what is new, earlier batches before later ones. Nodes
    without id go. An empty batch changes nothing.
    """
    spark = batch.sparkSession
    store = Store(spark, corpus_root, "bucket")
    last, known = _state(store)
    if batch_id <= last:
        return False
    buckets = known or buckets
    commit = store.begin()
    order = (F.lit(batch_id + 1).cast("bigint") * F.lit(1 << 32).cast("bigint") + F.col("source_ord")).alias("source_ord")
    new = batch.where("node_id is not null").select(order, "node_pos", "node_id", "types", "props", bucket_of(F.col("node_id"), buckets).alias("bucket"))
    touched = new.select("bucket").distinct()
    old = store.read("nodes", CORPUS).join(F.broadcast(touched), "bucket", "left_semi")  # at most `buckets` rows; prunes the scan
    both = old.select(F.col("seen_ord").alias("source_ord"), F.col("seen_pos").alias("node_pos"), "node_id", "types", "props").unionByName(new.drop("bucket"))
    merged = graph.merge(both).select(bucket_of(F.col("node_id"), buckets).alias("bucket"), "node_id", "types", "props", F.col("seen.source_ord").alias("seen_ord"), F.col("seen.node_pos").alias("seen_pos"))
    made = store.write("nodes", commit, merged.repartition("bucket"))
    store.publish(commit, made.select(F.col("bucket").alias("part")).distinct().withColumn("digest", F.lit(f"{batch_id}/{buckets}")))
    store.vacuum()
    return True


def corpus(spark: SparkSession, corpus_root: str) -> DataFrame:
    """node_id, types, props, seen of all nodes; seen sorts them as they were first met."""
    nodes = Store(spark, corpus_root, "bucket").read("nodes", CORPUS)
    return nodes.select("node_id", "types", "props", F.struct(F.col("seen_ord").alias("source_ord"), F.col("seen_pos").alias("node_pos")).alias("seen"))


def start(spark: SparkSession, source: str, corpus_root: str, checkpoint: str, available_now: bool = True):
    """Stream of node files (parquet with NODE's columns) into the corpus."""
    stream = spark.readStream.schema(NODE).parquet(source).writeStream.foreachBatch(lambda df, i: add_batch(corpus_root, df, i) and None).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()
