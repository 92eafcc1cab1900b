"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of paragraphs: its lines, without their ends; blank lines are none. Each paragraph is hashed to a wide
vector of whole numbers, and a fingerprint is the sum of its paragraphs' vectors, each place modulo 2^32. The order of
paragraphs doesn't matter, and paragraphs can be put in or taken out by adding or subtracting their vectors. A vector has two
parts: 8 places of 32 bits hashed from the whole paragraph, which tell texts apart, and 64 places of 8 bits summed over the
paragraph's pieces (every 64 characters from its start), which show how alike two texts are: once centred, two sums have about
the cosine of the texts' piece counts, within some 0.12. Each hash starts from a state of its own, so none is a function of
another. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Places from whole paragraphs, places from pieces, the modulus of all, characters of a piece.
WHOLE, PARTS, MODULUS, PIECE = 8, 64, 1 << 32, 64
BUCKET_BYTES, MOST_BUCKETS = 64 << 20, 100_000


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text; none of an empty or null one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\\n"), lambda x: x != "")


def _summed(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, then the places of the fingerprint of `text` summed over the rows of equal keys, as columns."""
    lines = df.select(*keys, F.explode_outer(paragraphs(F.col(text))).alias("_line"))
    cut = F.regexp_extract_all("_line", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    parts = lines.select(*keys, "_line", F.posexplode_outer(cut).alias("_at", "_part"))
    # the first piece's row also stands for the whole paragraph
    whole = F.when(F.col("_at") == 0, F.col("_line"))
    hashes = [F.when(whole.isNotNull(), C.digest(whole, i)).alias(f"_w{i}") for i in range(WHOLE // 2)]
    hashes += [F.when(F.col("_part").isNotNull(), C.digest(F.col("_part"), WHOLE + i)).alias(f"_p{i}") for i in range(PARTS // 8)]
    rows = parts.select(*keys, (F.col("_at") == 0).cast("long").alias("_first"), (F.col("_at") >= 0).cast("long").alias("_one"), *hashes)
    taken = lambda c, bits, j: F.shiftrightunsigned(c, bits * j).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    places = [F.col("_first"), *[taken(f"_w{i}", 32, j) for i in range(WHOLE // 2) for j in range(2)]]
    places += [F.col("_one"), *[taken(f"_p{i}", 8, j) for i in range(PARTS // 8) for j in range(8)]]
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"_v{i}") for i, c in enumerate(places)])


def vector(df: DataFrame, keys: list[str], text: str, out: str = "vector") -> DataFrame:
    """keys and the fingerprint of `text` (array of bigint) of each row's keys: paragraphs and their places, pieces and their places.

    Rows of equal keys are summed: the fingerprint of a multiset union. No exchange is made if df is dealt by some of keys.
    """
    sums = _summed(df, keys, text)
    return sums.select(*keys, F.array(*[_mod(F.col(f"_v{i}")) for i in range(WHOLE + PARTS + 2)]).alias(out))


def _mod(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MODULUS - 1).cast("long"))


def add(a: Column, b: Column) -> Column:
    """The fingerprint vector of two multisets together."""
    return F.zip_with(a, b, lambda x, y: _mod(x + y))


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint vector of what is left when the paragraphs of b are taken out of a."""
    return F.zip_with(a, b, lambda x, y: _mod(x - y))


def text_of(v: Column) -> Column:
    """A fingerprint as hexadecimal text of fixed length."""
    return F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two fingerprints, 1 for equal ones; a text without paragraphs is like nothing but its equals."""
    pieces = lambda v: F.element_at(v, WHOLE + 2)
    # twice the sum less its mean, which is small whatever the sum has wrapped to
    centred = lambda v, n: F.transform(F.slice(v, WHOLE + 3, PARTS), lambda x: (F.pmod(2 * x - 255 * n + MODULUS, F.lit(2 * MODULUS)) - MODULUS).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    x, y = centred(a, pieces(a)), centred(b, pieces(b))
    size = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(a == b, 1.0).when(size > 0, F.least(F.greatest(dot(x, y) / size, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def _cuts(sizes: DataFrame, scratch: C.Scratch, bucket_bytes: int) -> list[int]:
    """The least doc_id of each range of about bucket_bytes; sizes has doc_id and bytes. At most MOST_BUCKETS reach the driver."""
    spark = sizes.sparkSession
    total, n = sizes.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    width = max(bucket_bytes, math.ceil((total or 1) / MOST_BUCKETS))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n >> 20)
    dealt = scratch.keep(sizes.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()))
    # a row for each part
    before = dealt.groupBy("part").agg(F.sum("bytes").alias("b")).select("part", (F.sum("b").over(Window.orderBy("part")) - F.col("b")).alias("before"))
    upto = F.sum("bytes").over(Window.partitionBy("part").orderBy("doc_id").rangeBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("upto", upto).join(F.broadcast(before), "part").select("doc_id", F.floor((F.col("upto") + F.col("before") - 1) / width).alias("range"))
    return sorted(r["least"] for r in placed.groupBy("range").agg(F.min("doc_id").alias("least")).collect())


def _bucket(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the cuts are no greater than doc_id, by binary search in one constant array; 0 for null."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in range(len(cuts).bit_length() - 1, -1, -1)])
    fits = lambda i: (i <= len(cuts)) & (F.element_at(table, F.least(i, F.lit(len(cuts)))) <= doc_id)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at + step), at + step).otherwise(at))


def neighbours(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """bucket, seq, doc_id, text, next_text, borrowed: each row with the text of the next one in descending doc_id, the last with the first's.

    Rows are dealt by ranges of doc_id of about bucket_bytes and ordered within them, in one exchange of the texts. The first
    row of each range is also lent to the range before, where it comes last (borrowed). Rows without doc_id come last, as one
    range; rows that share a doc_id are in one range, ordered by their text. A single row's next is itself.
    """
    scratch = C.Scratch(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    sizes = scratch.keep(rows.where("doc_id is not null").select("doc_id", (F.octet_length("text") + 64).cast("long").alias("bytes")))
    cuts = _cuts(sizes, scratch, bucket_bytes)
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), cuts))
    # a row for each range: its first doc_id, and the range that comes before it
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    line = Window.orderBy(F.col("bucket").desc())
    last = F.last("bucket").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = scratch.keep(tops.select(F.col("bucket").alias("of"), "top", F.coalesce(F.lag("bucket").over(line), last).alias("to")))
    lent = rows.join(F.broadcast(tops), (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top")))
    lent = lent.groupBy("to").agg(F.max(F.struct("doc_id", "text")).alias("r")).select(F.col("r.doc_id").alias("doc_id"), F.col("r.text").alias("text"), F.col("to").alias("bucket"))
    both = rows.withColumn("borrowed", F.lit(False)).unionByName(lent.withColumn("borrowed", F.lit(True)))
    both = both.repartitionById(len(cuts) + 1, F.col("bucket").cast("int"))
    w = Window.partitionBy("bucket").orderBy("borrowed", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    return both.select("bucket", F.row_number().over(w).alias("seq"), "doc_id", "text", F.lead("text").over(w).alias("next_text"), "borrowed")


def edited_text(text: Column, other: Column) -> Column:
    """The last floor(n / 3) code points replaced by the first as many (or all) of the other text."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(other, F.lit(1), cut))


def edit_report(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of docs (doc_id, text, ...).

    Null texts are empty. Equal texts have equal fingerprints, and so have texts that hold the same paragraphs in another
    order. Rows that share a doc_id each have a row; other columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows = neighbours(docs, bucket_bytes)
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    side = lambda k, body, sha, n: F.struct(F.lit(k).alias("side"), body.alias("body"), sha.alias("sha"), n.alias("n"))
    sides = F.array(
        side(0, F.col("text"), F.lit(None).cast("string"), F.char_length("text")),
        side(1, F.when(~F.col("borrowed"), F.col("edited")), F.sha2("edited", 256), F.lit(None).cast("int")),
    )
    rows = rows.select("bucket", "seq", "doc_id", "borrowed", F.inline(F.filter(sides, lambda s: s["body"].isNotNull())))
    v = vector(rows, ["bucket", "seq", "doc_id", "borrowed", "side", "sha", "n"], "body")
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    v = v.groupBy("bucket", "seq", "doc_id", "borrowed").agg(pick(1, "sha").alias("edited_sha256"), pick(0, "n").cast("long").alias("n_chars"), *[pick(i, "vector").alias(f"f{i}") for i in range(2)])
    v = v.withColumn("f2", F.lead("f0").over(Window.partitionBy("bucket").orderBy("seq"))).where(~F.col("borrowed"))
    return v.select(
        "doc_id", "n_chars", "edited_sha256",
        text_of(F.col("f0")).alias("fingerprint"), text_of(F.col("f1")).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1")).alias("near_edited"), likeness(F.col("f0"), F.col("f2")).alias("near_next"),
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`edit_report` over all documents."""
    return edit_report(C.table(spark, sf_dir, "documents"))
