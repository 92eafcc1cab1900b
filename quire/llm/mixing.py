"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets are found by water filling over the table of sources. Each source then gets a whole number of blocks by the highest
quotients target / (2k + 1); each source's blocks go to its shards in the same way, in proportion to the shards' sizes. What
the blocks leave over or short of a source's target is settled in words, shard by shard, so that no source is too small for a
block. A shard lists its documents in a seeded order and gives its first words, as often round as its quota asks. Shards hold
a bounded number of documents, so a source with a third of all rows is many groups. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

SHARD_DOCS, BLOCK_WORDS, MOST_REPEATS, SEED = 4096, 64, 3, "mix-1"


def apportion(df: DataFrame, group: list[str], weight: str, seats: str, order: list[str], out: str) -> DataFrame:
    """df with `out`: the row's seats of the group's `seats`, by highest quotients weight / (2k + 1); ties go by `order`, then to the lower k.

    Seats that are certain are given at once: with divisor W / (seats - n/2) rounding gives no more than `seats` in all, and
    with W / (seats + n/2) no fewer. Only the seats between are ranked, about as many as there are rows. Rows of a group whose
    weights are all 0 get none.
    """
    w = Window.partitionBy(*group)
    total, n = F.sum(weight).over(w), F.count(F.lit(1)).over(w)
    df = df.withColumn("_total", total).withColumn("_n", n)
    low = F.when((F.col(seats) * 2 > F.col("_n")) & (F.col("_total") > 0), F.floor(F.col(weight) * (F.col(seats) - F.col("_n") / 2.0) / F.col("_total") + 0.5))
    high = F.when(F.col("_total") > 0, F.floor(F.col(weight) * (F.col(seats) + F.col("_n") / 2.0) / F.col("_total") + 0.5) + 1)
    df = df.withColumn("_low", F.greatest(F.coalesce(low, F.lit(0)) - 1, F.lit(0)).cast("long"))
    df = df.withColumn("_high", F.greatest(F.least(F.coalesce(high, F.lit(0)), F.col(seats)), F.col("_low")).cast("long"))
    df = df.withColumn("_left", F.col(seats) - F.sum("_low").over(w))
    keys = group + order
    contested = df.where("_high > _low").select(*keys, weight, "_left", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_k"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), *order, "_k"))
    won = contested.withColumn("_rank", rank).where("_rank <= _left").groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_won"))
    on = [df[k].eqNullSafe(won[f"_{i}"]) for i, k in enumerate(keys)]
    return df.join(won, on, "left").withColumn(out, F.col("_low") + F.coalesce("_won", F.lit(0))).select(*[c for c in df.columns if c[0] != "_" or c in keys], out)


def _unit(doc_id: Column, text: Column, seed: str) -> Column:
    """A seeded place in the order of documents; rows without doc_id are told apart by their text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.xxhash64(text).cast("string")))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """sources (source, source_size, docs) with at (place), all_size and target: the sum of sizes shared by weight, none above `repeats` times its size."""
    w_all = Window.partitionBy()  # a row for each source
    at = F.row_number().over(w_all.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sources.withColumn("at", at).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * repeats).withColumn("all_size", F.sum("source_size").over(w_all))
    fill = w_all.orderBy((F.col("cap") / F.col("weight")).asc(), "at")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    spent, gone = F.coalesce(F.sum("cap").over(upto), F.lit(0)), F.coalesce(F.sum("weight").over(upto), F.lit(0))
    s = s.withColumn("level", (F.col("all_size") - spent) / (F.sum("weight").over(w_all) - gone))
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "at", "level"))).over(w_all)["level"]
    return s.withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), level * F.col("weight")), F.lit(0.0))).drop("level", "cap", "weight")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), repeats: int = MOST_REPEATS, block: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of docs (doc_id, text, source, ...).

    Size is the number of words (null: 0). Sources in code point order, null last, weigh `weights`, repeating, and share the
    sum of sizes; a target stops at `repeats` times its source's size and the excess is shared anew. taken is how many words
    of the document the mix takes, repeats counted, at most `repeats` times its size; a source's taken words add up to its
    target, rounded. Empty texts and sources have nothing to give and take 0; an empty table gives no rows. Rows that share a
    doc_id are ordered by their size; rows that repeat as a whole share what one of them alone would get in no fixed order.
    Other columns are ignored, whatever their names.
    """
    unit = _unit(docs["doc_id"], docs["text"], seed)
    rows = docs.select("doc_id", "source", F.size(C.words(docs["text"])).cast("long").alias("size"), unit.alias("unit"))
    rows = C.Scratch(docs.sparkSession).keep(rows)  # four narrow columns: texts are read once
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    # one row for each source from here on
    s = targets(sources, weights, repeats).withColumn("blocks", F.floor(F.col("all_size") / block))
    s = apportion(s.withColumn("one", F.lit(1)), ["one"], "target", "blocks", ["at"], "quota")
    s = s.select(F.col("source").alias("src"), "at", "source_size", "target", "quota", F.ceil(F.col("docs") / shard_docs).alias("shards"))

    rows = rows.join(s, rows["source"].eqNullSafe(s["src"]))
    rows = rows.withColumn("shard", F.conv(F.substring("unit", 1, 8), 16, 10).cast("long") % F.col("shards"))
    shards = rows.groupBy("at", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"), F.first("target").alias("goal"))
    shards = apportion(shards, ["at"], "shard_size", "quota", ["shard"], "shard_quota")
    # blocks that the shard has words for, then words up to the source's target, or back to it, in the order of shards
    shards = shards.withColumn("most", F.col("shard_size") * repeats).withColumn("given", F.least(F.col("shard_quota") * block, F.col("most")))
    shards = shards.withColumn("short", F.round("goal").cast("long") - F.sum("given").over(Window.partitionBy("at")))
    room = F.when(F.col("short") > 0, F.col("most") - F.col("given")).otherwise(F.col("given"))
    shards = shards.withColumn("room", room).withColumn("before", F.sum("room").over(Window.partitionBy("at").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("room"))
    more = F.least(F.greatest(F.abs("short") - F.col("before"), F.lit(0)), F.col("room"))
    shards = shards.select(F.col("at").alias("_at"), F.col("shard").alias("_shard"), "shard_size", (F.col("given") + F.signum("short").cast("long") * more).alias("give"))
    rows = rows.join(shards, (F.col("at") == F.col("_at")) & (F.col("shard") == F.col("_shard")))
    line = Window.partitionBy("at", "shard").orderBy("unit", "size", "doc_id")
    rows = rows.withColumn("start", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("give") / F.col("shard_size"))).otherwise(0)
    rest = F.when(F.col("shard_size") > 0, F.col("give") % F.col("shard_size")).otherwise(0)
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    return rows.select("doc_id", "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them: each row as often as its taken words come nearest to, so those of which less than half is taken go.

    Texts stay whole. Rows without words stay once, for they weigh nothing. Rows that share a doc_id are taken alike. All
    columns stay, whatever their names. An empty table stays empty.
    """
    key, times, turn = C.fresh(docs, "_id", "_times", "_turn")
    plan = mix(docs, **options).groupBy(F.col("doc_id").alias(key)).agg(F.sum("size").alias("s"), F.sum("taken").alias("t"))
    plan = plan.select(key, F.when(F.col("s") > 0, F.floor((2 * F.col("t") + F.col("s")) / (2 * F.col("s")))).otherwise(1).cast("int").alias(times))
    rows = docs.join(plan, F.col("doc_id").eqNullSafe(F.col(key))).where(F.col(times) > 0)
    return rows.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`mix` over all documents, sources weighing 1, 2, 3 in turn."""
    return mix(C.table(spark, sf_dir, "documents"))
