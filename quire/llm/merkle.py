"""A Merkle manifest of a dataset: trees of fan-out 16 for each group of rows, and one above their roots.

Rows are sorted by group and key over all partitions and numbered there, so each partition holds runs of whole numbers. It walks
them with a mountain range: a stack of peaks that counts in base 16, where a full run of 16 is hashed and carried one level up.
What stands at a partition's edges and lacks siblings is merged level by level in Spark, 16 rows a group at most. Runs at a
group's end are short and hashed as they are. Every node keeps its children's digests, so paths to the root are joined from the
top down, each parent with its 16 children: no step sees more rows of a hot group than of any other.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

C.by_value(__name__)

FANOUT, SIZE = 16, 32
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "k string, n bigint, level int, idx bigint, digest binary, kids binary"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    leaves: DataFrame  # k, id, idx, n, leaf, other: the group's key, the row's key, its place among n, its digest and that of a changed row
    nodes: DataFrame  # k, n, level, idx, digest, kids of the groups' trees
    groups: DataFrame  # k, subroot, root, above: the path from a group's root upward


def field(c: Column) -> Column:
    """A value with its length in bytes before it, `-` for null: no two rows give the same text."""
    v = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def digest_of(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in values]), 256))


def spelled(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def level_size(level: int) -> Column:
    """How many nodes a tree of n leaves has on this level."""
    return F.expr(f"(n + {FANOUT**level - 1}L) div {FANOUT**level}L")


def indexed(rows: DataFrame, scratch: C.Scratch) -> DataFrame:
    """rows (k, id, leaf, other) with idx, the place by id (null first, then by digest) among the n rows of the same k.

    Sorted by range over all partitions; only counts of each partition and group take part in numbering.
    """
    rows = scratch.keep(rows)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "k", "id", "leaf").sortWithinPartitions("k", "id", "leaf")
    rows = scratch.keep(rows.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    own = rows.groupBy("part", "k").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    group = Window.partitionBy("k")
    before = F.coalesce(F.sum("c").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.select("part", "k", (before - F.col("first")).alias("shift"), F.sum("c").over(group).alias("n"))
    return rows.join(scratch.keep(own), ["part", "k"]).select("k", "id", (F.col("at") + F.col("shift")).alias("idx"), "n", "leaf", "other")


class Range:
    """The mountain range over consecutive leaves of one tree. pend[l]: the first place and the digests on level l that wait for siblings."""

    def __init__(self, k: str, n: int, out: list):
        self.k, self.n, self.out = k, n, out
        self.sizes, self.pend = [n], []
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // FANOUT))
            self.pend.append((0, []))

    def push(self, level: int, first: int, digests: list[str]) -> None:
        """Take what follows on this level, hash the runs that are full and carry them up."""
        if self.sizes[level] == 1:
            return
        at, held = self.pend[level]
        if not held:
            at = first
        held = held + digests
        done, up = 0, []
        while done < len(held):
            run, skip = divmod(at + done, FANOUT)
            want = min(FANOUT, self.sizes[level] - run * FANOUT) - skip
            if len(held) - done < want:
                break
            kids = held[done : done + want]
            if skip:
                self.edges(level, at + done, kids)
            else:
                joined = "".join(kids)
                up.append((run, hashlib.sha256(joined.encode()).hexdigest()))
                self.out.append((self.k, self.n, level + 1, run, bytes.fromhex(up[-1][1]), bytes.fromhex(joined)))
            done += want
        self.pend[level] = (at + done, held[done:])
        if up:
            self.push(level + 1, up[0][0], [d for _, d in up])

    def edges(self, level: int, first: int, digests: list[str]) -> None:
        self.out.extend((self.k, self.n, level, first + i, bytes.fromhex(d), None) for i, d in enumerate(digests))

    def close(self) -> None:
        for level, (at, held) in enumerate(self.pend):
            self.edges(level, at, held)


def _ranges(batches):
    """Node records of sorted leaves, and without kids the nodes at the edges of each range that lack siblings here."""
    names = [c.split()[0] for c in NODES.split(",")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    now, stop, out = None, 0, []

    def made():
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, types, strict=True)], names)

    for b in batches:
        k, idx, n = b.column("k").to_pylist(), b.column("idx").to_numpy(), b.column("n").to_numpy()
        text = b"".join(b.column("leaf").to_pylist()).hex()
        fresh = np.ones(len(idx), bool)
        fresh[1:] = idx[1:] != idx[:-1] + 1
        fresh[1:] |= np.array([x != y for x, y in zip(k[1:], k[:-1], strict=True)], bool)
        heads = np.append(np.flatnonzero(fresh), len(idx))
        for a, z in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            first = int(idx[a])
            if now is None or now.k != k[a] or first != stop:
                if now is not None:
                    now.close()
                now = Range(k[a], int(n[a]), out)
            now.push(0, first, [text[2 * SIZE * i : 2 * SIZE * (i + 1)] for i in range(a, z)])
            stop = first + z - a
        if len(out) > 10_000:
            yield made()
            out.clear()
    if now is not None:
        now.close()
    if out:
        yield made()


def tree(leaves: DataFrame, scratch: C.Scratch) -> DataFrame:
    """All nodes above these leaves (k, idx, n, leaf), with their children's digests."""
    made = scratch.keep(leaves.select("k", "idx", "n", "leaf").sortWithinPartitions("k", "idx").mapInArrow(_ranges, NODES))
    nodes, edges = made.where("kids is not null"), made.where("kids is null").drop("kids")
    top = edges.agg(F.max("n")).first()[0]
    level, waiting = 0, None
    while top is not None and top > FANOUT**level:
        at = edges.where(F.col("level") == level)
        at = at.unionByName(waiting) if waiting is not None else at
        runs = at.groupBy("k", "n", F.expr(f"idx div {FANOUT}").alias("idx")).agg(F.sort_array(F.collect_list(F.struct(F.col("idx").alias("i"), "digest"))).alias("all"))
        kids = F.aggregate("all", F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))
        runs = runs.select("k", "n", F.lit(level + 1).alias("level"), "idx", kids.alias("kids")).withColumn("digest", F.unhex(F.sha2(spelled(F.col("kids")), 256)))
        runs = scratch.keep(runs)
        nodes, waiting = nodes.unionByName(runs), runs.where(level_size(level + 1) > 1).drop("kids")
        level += 1
    return nodes


def tops(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """k, subroot of each tree: the node that has no sibling left, or the lone leaf."""
    last = F.expr(f"n <= power({FANOUT}, level)")
    return nodes.where(last).select("k", F.col("digest").alias("subroot")).unionByName(leaves.where("n = 1").select("k", F.col("leaf").alias("subroot")))


def _beside(kids: Column, idx: Column) -> Column:
    """A step of a path: the digests left and right of a child."""
    place = (idx % FANOUT).cast("int") * SIZE
    return F.array(F.struct(F.substring(kids, F.lit(1), place).alias("left"), F.substring(kids, place + SIZE + 1, F.lit(FANOUT * SIZE)).alias("right")))


def with_paths(leaves: DataFrame, nodes: DataFrame, groups: DataFrame, height: int) -> DataFrame:
    """leaves with subroot, root and path, the siblings on each level from the leaf upward; groups has what is above a tree."""
    over = None
    parent = F.expr(f"idx div {FANOUT}").alias("up")
    for level in range(height, 0, -1):
        at = nodes.where(F.col("level") == level).select("k", "n", "idx", "kids")
        rows = at.where(level_size(level) == 1).join(groups, "k").select("k", "idx", "kids", "subroot", "root", "above")
        if over is not None:
            below = at.where(level_size(level) > 1).select("*", parent).join(over, ["k", "up"])
            rows = rows.unionByName(below.select("k", "idx", "kids", "subroot", "root", F.concat(_beside(F.col("run"), F.col("idx")), "above").alias("above")))
        over = rows.select("k", F.col("idx").alias("up"), F.col("kids").alias("run"), "subroot", "root", "above")
    alone = leaves.where("n = 1").join(groups, "k").withColumnRenamed("above", "path")
    if over is None:
        return alone
    rows = leaves.where("n > 1").select("*", parent).join(over, ["k", "up"])
    return rows.select(*leaves.columns, "subroot", "root", F.concat(_beside(F.col("run"), F.col("idx")), "above").alias("path")).unionByName(alone.select(*leaves.columns, "subroot", "root", "path"))


def height_of(leaves: DataFrame) -> int:
    most, levels = leaves.agg(F.max("n")).first()[0] or 1, 0
    while FANOUT**levels < most:
        levels += 1
    return levels


def manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", columns: tuple[str, ...] = COLUMNS, changed: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """The manifest of docs: a tree for each value of `group` with its leaves in order of `key`, and one above the groups.

    changed, where: columns as someone else's copy has them, in the rows that meet `where`; their digests are leaves' `other`.
    Rows without key come first in their group, rows without group are a group of their own before all others; rows that repeat
    are leaves of their own, side by side. An empty table has no nodes and no root. Columns besides `columns` don't count.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    other = digest_of([(changed or {}).get(c, docs[c]) for c in columns])
    other = F.when(where, other) if where is not None else F.lit(None).cast("binary")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("")).alias("k"), docs[key].alias("id"), digest_of([docs[c] for c in columns]).alias("leaf"), other.alias("other"))
    leaves = scratch.keep(indexed(rows, scratch))
    nodes = tree(leaves, scratch)
    roots = tops(leaves, nodes).select(F.lit("").alias("k"), F.col("k").alias("id"), F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("other"))
    upper = scratch.keep(indexed(roots, scratch))
    above = tree(upper, scratch)
    top = scratch.keep(tops(upper, above)).select("k", "subroot", F.col("subroot").alias("root"), F.expr("cast(array() as array<struct<left: binary, right: binary>>)").alias("above"))
    groups = with_paths(upper, above, top, height_of(upper)).select(F.col("id").alias("k"), F.col("leaf").alias("subroot"), "root", F.col("path").alias("above"))
    return Manifest(leaves, nodes, scratch.keep(groups))


def proofs(m: Manifest) -> DataFrame:
    """id, leaf, other, subroot, root, path of every row of the dataset."""
    return with_paths(m.leaves, m.nodes, m.groups, height_of(m.leaves)).select("id", "leaf", "other", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hexadecimal, that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, spelled(leaf), lambda acc, x: F.sha2(F.concat(spelled(x["left"]), acc, spelled(x["right"])), 256))


def report(docs: DataFrame, changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; see `manifest` for edge rows."""
    rows = proofs(manifest(docs, changed=changed, where=where))
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(spelled(x["left"]), spelled(x["right"]))), ""), 256)
    rows = rows.select(F.col("id").alias("doc_id"), spelled(F.col("leaf")).alias("leaf"), spelled(F.col("subroot")).alias("subroot"), spelled(F.col("root")).alias("root"), proof.alias("proof_sha256"), folded(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`report` over all documents, where every fifth by crc32 is held against a copy whose letters A-Z are lower-cased."""
    docs = C.table(spark, sf_dir, "documents")
    lowered = {"text": F.translate(docs["text"], UPPER, LOWER)}
    return report(docs, lowered, F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0)


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
  FROM (SELECT doc_id, s, i, CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(s, i // 8 + 1, 1))::BIGINT) ELSE c END AS x FROM crc WHERE i < 8 * length(s))
),
hit AS (SELECT DISTINCT doc_id FROM crc WHERE i = 8 * length(s) AND xor(c, 4294967295) % 5 = 0),
rows AS (
  SELECT d.doc_id, source, concat(coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         text, h.doc_id IS NOT NULL AS changed
  FROM documents d LEFT JOIN hit h ON d.doc_id = h.doc_id
),
leaves AS (
  SELECT doc_id, source, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
         CASE WHEN changed THEN sha256(concat(head, coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))) END AS other
  FROM rows
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
t AS (
  SELECT 0 AS level, source, idx, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM numbered
  UNION ALL
  SELECT level + 1, source, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM t WHERE n > 1 GROUP BY level, source, idx // 16
),
subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, idx, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 15) // 16 FROM u WHERE n > 1 GROUP BY level, idx // 16
),
runs AS (
  SELECT 'a' || coalesce('=' || source, '') AS k, level, idx // 16 AS up, list(h ORDER BY idx) AS kids FROM t WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 'b', level, idx // 16, list(h ORDER BY idx) FROM u WHERE n > 1 GROUP BY ALL
),
low AS (
  SELECT doc_id, leaf, 'a' || coalesce('=' || source, '') AS k, source, 0 AS level, idx, coalesce(other, leaf) AS f, '' AS p, row_number() OVER () AS r FROM numbered
  UNION ALL
  SELECT l.doc_id, l.leaf, l.k, l.source, l.level + 1, l.idx // 16, sha256(concat(array_to_string(kids[1:l.idx % 16], ''), f, array_to_string(kids[l.idx % 16 + 2:], ''))),
         concat(p, array_to_string(kids[1:l.idx % 16], ''), array_to_string(kids[l.idx % 16 + 2:], '')), r
  FROM low l JOIN runs ON runs.k = l.k AND runs.level = l.level AND runs.up = l.idx // 16
),
mid AS (SELECT * FROM low QUALIFY level = max(level) OVER (PARTITION BY r)),
high AS (
  SELECT m.doc_id, m.leaf, s.subroot, 0 AS level, s.idx, m.f, m.p, m.r FROM mid m JOIN subroots s ON m.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT doc_id, leaf, subroot, h.level + 1, h.idx // 16, sha256(concat(array_to_string(kids[1:h.idx % 16], ''), f, array_to_string(kids[h.idx % 16 + 2:], ''))),
         concat(p, array_to_string(kids[1:h.idx % 16], ''), array_to_string(kids[h.idx % 16 + 2:], '')), r
  FROM high h JOIN runs ON runs.k = 'b' AND runs.level = h.level AND runs.up = h.idx // 16
)
SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(p) AS proof_sha256, f AS folded_root, f = (SELECT h FROM u WHERE n = 1) AS verified
FROM (SELECT * FROM high QUALIFY level = max(level) OVER (PARTITION BY r))
"""
