"""Similarity self-join on word shingles by a grouped prefix join, as connected components.

Documents with equal shingle sets are one class. A set's prefix holds its first n - ceil(t * n) + 1 shingles in an order that
puts frequent ones last; two sets of Jaccard similarity t or more share a shingle of their prefixes. Classes of equal size and
prefix collapse into one group, and only groups that meet on a prefix shingle, and the members of one group, are looked at. A
list of groups under one shingle isn't paired off: first each group is held against one leader, and what is linked is one
component from then on, so a large group of near copies costs as many comparisons as it has members. Lists that still hold more than one component are expanded to their members. Pairs of short lists whose
prefixes share enough, and the members of long lists, are edges between members; each component of these edges is cut into
blocks by component and size, and the blocks that may hold a link between different components are compared as a whole, by
products of their member-shingle matrices. Each comparison counts shared shingles exactly; no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import graphs

C.by_value(__name__)

#: Shingles of more sets' prefixes than this go to the end of the order; at most so many are sent to the executors (8 bytes each).
FREQUENT, MOST_FREQUENT = 32, 4_000_000
#: Lists up to this length are expanded to pairs before anything else is known; members of a block; columns of a product.
SHORT_LIST, BLOCK, COLUMNS = 48, 256, 8192
#: Ids are broadcast to filter a scan up to this number, and joined by a shuffle beyond it.
BROADCAST_IDS = 2_000_000


def shingle_sets(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each list of word hashes and their owners, sorted by owner and value; a short list is one shingle."""
    g, ok = C.grams(h, k), C.starts_of(off, k)
    own = C.owners(off)[: len(g)][ok]
    g = g[ok]
    short = np.flatnonzero((np.diff(off) > 0) & (np.diff(off) < k))
    if len(short):
        extra = np.array([C.grams(h[off[i] : off[i + 1]], int(off[i + 1] - off[i]), int(off[i + 1] - off[i]))[0] for i in short], np.uint64)
        g, own = np.concatenate([g, extra]), np.concatenate([own, short])
    order = np.lexsort((g, own))
    g, own = g[order], own[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    return g[new], own[new]


def _first(counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """Prefix lengths for sets of these sizes."""
    return np.where(counts > 0, counts - -(-counts * num // den) + 1, 0)


def _leading(k: int, num: int, den: int):
    """Twice the prefix in the order of values, to find what is frequent there."""

    def run(batches):
        for whole in batches:
            for b in C.text_parts(whole):
                h, off = C.hash_words(b.column("text"), True)
                g, own = shingle_sets(h, off, k)
                n = np.bincount(own, minlength=len(off) - 1)
                rank = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(g[rank < np.repeat(2 * _first(n, num, den), n)].view(np.int64))], ["token"])

    return C.lean(run)


def _sets(k: int, num: int, den: int, frequent):
    def run(batches):
        heavy = frequent.value
        for whole in batches:
            for b in C.text_parts(whole):
                h, off = C.hash_words(b.column("text"), True)
                g, own = shingle_sets(h, off, k)
                rows = len(off) - 1
                n = np.bincount(own, minlength=rows)
                sums = [np.zeros(rows, np.uint64) for _ in range(2)]
                has = n > 0
                starts = (np.cumsum(n) - n)[has]
                for s, salt in zip(sums, (0, 0x5851F42D4C957F2D), strict=True):
                    if len(starts):
                        s[has] = np.add.reduceat(C.mix(g ^ np.uint64(salt)), starts)
                if len(heavy) and len(g):
                    at = np.minimum(np.searchsorted(heavy, g), len(heavy) - 1)
                    late = heavy[at] == g
                    if late.any():
                        order = np.lexsort((g, late, own))
                        g = g[order]
                rank = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
                p = _first(n, num, den)
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(p)]).astype(np.int32)), pa.array(g[rank < np.repeat(p, n)].view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), *[pa.array(s.view(np.int64)) for s in sums], prefix], ["doc_id", "n", "d1", "d2", "prefix"])

    return C.lean(run)


def _linked(k: int, num: int, den: int):
    """Of pairs with both texts' word hashes, those with den * intersection >= num * union."""

    def run(batches):
        for whole in batches:
            for b in C.text_parts(whole, ("ta", "tb")):
                g, own = zip(*[shingle_sets(*C.hash_words(b.column(c), True), k) for c in ("ta", "tb")], strict=True)
                size = len(g[0]) + len(g[1])
                allg, allo = np.concatenate(g), np.concatenate(own)
                order = np.lexsort((allg, allo))
                allg, allo = allg[order], allo[order]
                same = (allg[1:] == allg[:-1]) & (allo[1:] == allo[:-1]) if size else np.zeros(0, bool)
                inter = np.bincount(allo[1:][same], minlength=b.num_rows)
                union = np.bincount(allo, minlength=b.num_rows) - inter
                ok = den * inter >= num * union
                yield pa.RecordBatch.from_arrays([pa.array(b.column(c).to_numpy()[ok]) for c in ("a", "b")], ["a", "b"])

    return C.lean(run)


def _block_links(k: int, num: int, den: int):
    """Links within a pair of blocks, as a star for each component of what is linked here."""

    def run(key, table):
        text = table["text"].combine_chunks()
        text = text.chunk(0) if hasattr(text, "chunk") else text
        ids = table["cid"].to_numpy()
        g, own = [], []
        rows = pa.RecordBatch.from_arrays([text, pa.array(np.arange(len(ids)))], ["text", "at"])
        for b in C.text_parts(rows):
            x, y = shingle_sets(*C.hash_words(b.column("text"), True), k)
            g.append(x)
            own.append(b.column("at").to_numpy()[y])
        g, own = np.concatenate(g), np.concatenate(own)
        size = np.bincount(own, minlength=len(ids)).astype(np.float64)
        order = np.argsort(g, kind="stable")
        g, own = g[order], own[order]
        head = np.ones(len(g), bool)
        head[1:] = g[1:] != g[:-1]
        place = np.cumsum(head) - 1
        many = np.bincount(place) > 1  # shingles of one member only are in no intersection
        own, place = own[many[place]], (np.cumsum(many) - 1)[place[many[place]]]
        both = np.zeros((len(ids), len(ids)))
        cut = np.searchsorted(place, np.arange(0, (int(place[-1]) if len(place) else 0) + 1 + COLUMNS, COLUMNS))
        for i, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            x = np.zeros((len(ids), COLUMNS), np.float32)
            x[own[lo:hi], place[lo:hi] - i * COLUMNS] = 1
            both += x @ x.T
        linked = den * both >= num * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(linked, True)
        low = np.arange(len(ids))
        while True:
            new = np.where(linked, low[None, :], len(ids)).min(1)
            if (new == low).all():
                break
            low = new
        apart = low != np.arange(len(ids))
        return pa.table({"a": ids[apart], "b": ids[low[apart]]})

    return run


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text, ...): documents whose sets of k-word shingles have den * |A and B| >= num * |A or B| are linked.

    A-Z are lower-cased; words are runs of other than white space. Fewer than k words are one shingle; empty and null texts
    have no set and are linked with nothing. component_id is the smallest doc_id that links reach. Rows that share a doc_id
    are one node; rows without doc_id get the component of what equals them and stand alone otherwise.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    rows = docs.select("doc_id", "text")
    counts = rows.select("text").mapInArrow(_leading(k, num, den), "token bigint").groupBy("token").count().where(F.col("count") > FREQUENT)
    frequent = counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT).select("token").toArrow()["token"].to_numpy()
    heavy = spark.sparkContext.broadcast(np.sort(frequent.view(np.uint64)))
    sets = scratch.keep(rows.mapInArrow(_sets(k, num, den, heavy), "doc_id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>"))

    key = ["n", "d1", "d2"]
    classes = sets.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("rows")).where("cid is not null")
    reps = sets.join(classes.select(*key, F.col("cid").alias("doc_id")), [*key, "doc_id"]).groupBy(*key, F.col("doc_id").alias("cid")).agg(F.first("prefix").alias("prefix"))
    reps = scratch.keep(reps)
    groups = scratch.keep(reps.groupBy("n", "prefix").agg(F.min("cid").alias("gid"), F.count(F.lit(1)).alias("members")))
    posts = groups.select("gid", "n", F.explode("prefix").alias("token"))
    meet = posts.groupBy("token").agg(F.count(F.lit(1)).alias("len"), F.min("gid").alias("lead")).where("len > 1")
    active = scratch.keep(posts.join(meet, "token"))  # lists with more than one group
    shared = reps.join(groups.where("members > 1").select("n", "prefix", "gid"), ["n", "prefix"]).select("cid", "gid")

    fits = lambda a, b: F.least(a, b) * den >= F.greatest(a, b) * num
    size_of = groups.select(F.col("gid").alias("lead"), F.col("n").alias("lead_n"))
    first = active.where("gid <> lead").groupBy("gid", "n", "lead").agg(F.count(F.lit(1)).alias("common"))
    first = first.join(size_of, "lead").where(fits(F.col("n"), F.col("lead_n")))
    first = first.groupBy("gid").agg(F.max_by("lead", F.struct("common", -F.col("lead"))).alias("lead"))
    pairs = first.select(F.col("gid").alias("a"), F.col("lead").alias("b")).union(shared.where("cid <> gid").select("cid", "gid")).distinct()

    def texts(ids: DataFrame) -> DataFrame:
        """id and whole text of these ids: a filter on the scan where they are few, else a join."""
        few = ids.count() <= BROADCAST_IDS
        return rows.withColumnRenamed("doc_id", "id").join(F.broadcast(ids) if few else ids, "id", "left_semi")

    def verify(pairs: DataFrame) -> DataFrame:
        ids = scratch.keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        body = texts(ids)
        both = pairs.join(body.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(body.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        return scratch.keep(both.mapInArrow(_linked(k, num, den), "a bigint, b bigint"))

    slim = reps.select("cid", "n", "prefix")

    def promising(pairs: DataFrame) -> DataFrame:
        """Of different pairs those whose prefixes share enough for the overlap that a link needs."""
        for x in "ab":
            pairs = pairs.join(slim.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("prefix").alias(f"p{x}")), x)
        return scratch.keep(pairs.where(_can_link(num, den)).select("a", "b"))

    links = verify(promising(pairs))
    comps = graphs.components(links, scratch)

    # what lists still hold more than one component, with all of their members
    of_group = reps.join(groups.select("n", "prefix", "gid"), ["n", "prefix"]).select("cid", "gid", "n")
    # the members of a group share its prefix, whether other groups do or not: each group of several is a list of its own
    own = groups.where("members > 1").select(F.xxhash64("gid").alias("token"), "gid")
    lists = active.select("token", "gid").union(own).join(of_group, "gid").join(comps.select(F.col("node").alias("cid"), "comp"), "cid", "left")
    lists = scratch.keep(lists.select("token", "cid", "n", F.coalesce("comp", "cid").alias("comp")))
    mixed = lists.groupBy("token").agg(F.count(F.lit(1)).alias("len"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("cid").alias("lead")).where("c0 < c1").select("token", "len", "lead")
    lists = scratch.keep(lists.join(mixed, "token"))
    short = lists.where(F.col("len") <= SHORT_LIST).select("token", "cid", "n", "comp")
    other = short.select("token", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    met = short.join(other, "token").where((F.col("cid") > F.col("b")) & (F.col("comp") != F.col("cb")) & fits(F.col("n"), F.col("nb")))
    edges = promising(met.select(F.col("cid").alias("a"), "b").distinct()).union(lists.where((F.col("len") > SHORT_LIST) & (F.col("cid") != F.col("lead"))).select("cid", "lead")).distinct()
    edges = scratch.keep(edges)
    if not edges.isEmpty():
        family = graphs.components(edges, scratch)
        # a family's smallest member is no node of its own
        family = family.select(F.explode(F.array("node", "comp")).alias("cid"), F.col("comp").alias("family")).distinct()
        members = family.join(reps.select("cid", "n"), "cid").join(comps.select(F.col("node").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        line = Window.partitionBy("family").orderBy("comp", "n", "cid")
        members = scratch.keep(members.withColumn("block", F.floor((F.row_number().over(line) - 1) / BLOCK)))
        blocks = members.groupBy("family", "block").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
        x, y = blocks.alias("x"), blocks.alias("y")
        close = (F.col("x.n0") * num <= F.col("y.n1") * den) & (F.col("y.n0") * num <= F.col("x.n1") * den)
        differ = ~((F.col("x.c0") == F.col("x.c1")) & (F.col("y.c0") == F.col("y.c1")) & (F.col("x.c0") == F.col("y.c0")))
        tasks = x.join(y, (F.col("x.family") == F.col("y.family")) & (F.col("x.block") <= F.col("y.block")) & close & differ)
        tasks = tasks.select(F.col("x.family").alias("family"), F.col("x.block").alias("i"), F.col("y.block").alias("j"))
        sides = tasks.select("family", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
        dealt = scratch.keep(members.join(sides, ["family", "block"]).select("family", "i", "j", "cid"))
        body = texts(dealt.select(F.col("cid").alias("id")).distinct()).withColumnRenamed("id", "cid")
        more = dealt.join(body, "cid").groupBy("family", "i", "j").applyInArrow(_block_links(k, num, den), "a bigint, b bigint")
        comps = graphs.components(links.union(scratch.keep(more)), scratch)
    # only classes of several rows and linked ones, as a table of their own, so that the join can split a class with very many rows
    named = classes.join(comps.select(F.col("node").alias("cid"), "comp"), "cid", "left").where("rows > 1 or comp is not null")
    named = scratch.keep(named.select(*key, F.coalesce("comp", "cid").alias("comp")))
    return sets.select("doc_id", *key).join(named, key, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"))


def _can_link(num: int, den: int):
    """Whether a pair with sizes na, nb and prefixes pa, pb can have the overlap that it needs, num / (num + den) of both sizes.

    Of two prefixes, what lies in the one that ends first is in the other or in none; so the overlap is at most what the
    prefixes share and all that follows that one. Which ends first isn't looked up: the longer rest is safe.
    """
    shared = F.size(F.array_intersect("pa", "pb"))
    rest = F.greatest(F.col("na") - F.size("pa"), F.col("nb") - F.size("pb"))
    return (shared + rest) * (num + den) >= (F.col("na") + F.col("nb")) * num


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one document of each group of near duplicates, the one with the smallest doc_id; other rows stay as they are.

    Rows that share a doc_id stay or go together; rows without one stay, and so do empty and null texts. All columns stay,
    whatever their names. An empty table stays empty.
    """
    (gone,) = C.fresh(docs, "_gone")
    out = jaccard_components(docs, k, num, den).where("doc_id <> component_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(out, F.col("doc_id") == F.col(gone), "left_anti")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`jaccard_components` over all documents: three words, 0.9."""
    return jaccard_components(C.table(spark, sf_dir, "documents"), 3, 90, 100)
