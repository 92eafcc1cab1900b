"""Ranked lexical search over a bit-sliced impact index.

The index holds blocks of documents. For each term of a block it has bitmaps, one for each bit of the term's impacts, of the 64-bit
words in which the term occurs. Scores of all documents of a block are summed by bitwise carry arithmetic, for all queries at once,
and a query's best documents are found by descending from the most significant slice of its sums. Only each block's best go on.
The index covers the terms of the searched items, of every document and whole text; items are taken in batches of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

C.by_value(__name__)

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms of the items that are searched together, and documents and postings of a block.
BATCH_TERMS, BLOCK, BLOCK_POSTINGS = 100_000, 4096, 400_000
#: Words of the sums that are held at a time, over all queries.
HELD_WORDS = 1 << 16
#: Share of the document's length in its m, in hundredths.
LENGTH = 90
ONE = np.uint64(1)


def term_bytes() -> np.ndarray:
    ink = np.ones(256, bool)
    for a, z in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        ink[a : z + 1] = False
    return ink


def terms(text: Column) -> Column:
    """The different terms of a text; null has none."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(PATTERN), F.lit(0)))


def _postings(shared):
    def run(batches):
        vocabulary, ink = pa.array(shared.value, pa.large_binary()), term_bytes()
        for whole in batches:
            for b in C.text_parts(whole):
                found, first = C.tokens(b.column("text"), ink, lower=True)
                code = pc.index_in(found, value_set=vocabulary).fill_null(-1).to_numpy().astype(np.int64)
                n, own = np.diff(first), C.owners(first)
                key = (own * max(len(vocabulary), 1) + code)[code >= 0]
                key, tf = np.unique(key, return_counts=True)
                doc, term = np.divmod(key, max(len(vocabulary), 1))
                ends = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term.astype(np.int32), tf.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "terms", "tf"])

    return C.lean(run)


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in the vocabulary) and tf of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(_postings(shared), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with so many terms; in whole numbers of any size where 64 bits might not do."""
    if int(n.max(initial=0)) * n_docs * LENGTH < 1 << 63:
        return 100 - LENGTH + LENGTH * n * n_docs // max(n_terms, 1)
    return np.array([100 - LENGTH + LENGTH * int(x) * n_docs // max(n_terms, 1) for x in n], np.int64)


def slices_of(doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps of postings sorted by term and document: terms, the first column of each, the 64-bit word of each column, [bits, columns]."""
    word = doc >> 6
    head = np.ones(len(doc), bool)
    head[1:] = (term[1:] != term[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(head)
    owner, first = np.unique(term[at], return_index=True)
    bits = int(impact.max(initial=0)).bit_length()
    out = np.zeros((bits, len(at)), np.uint64)
    if len(at):
        place = (doc & 63).astype(np.uint64)
        for j in range(bits):
            out[j] = np.bitwise_or.reduceat(((impact >> np.uint64(j)) & ONE) << place, at)
    return owner, np.append(first, len(at)), word[at], out


INDEX = "ids array<bigint>, terms array<int>, first array<int>, places array<int>, slices array<binary>"


def _index(shared):
    def run(batches):
        weight, n_docs, n_terms = shared.value
        held, rows, size = [], 0, 0

        def block():
            t = pa.Table.from_batches(held).combine_chunks()
            order = pc.sort_indices(t, sort_keys=[("doc_id", "ascending")])  # null comes last
            t = t.take(order).combine_chunks()
            lists = t.column("terms").chunk(0)
            off = lists.offsets.to_numpy().astype(np.int64)
            term = lists.values.to_numpy()[off[0] : off[-1]]
            tf = t.column("tf").chunk(0).values.to_numpy()[off[0] : off[-1]]
            doc = C.owners(off - off[0])
            m = norm(t.column("n").to_numpy(), n_docs, n_terms)
            impact = (weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))).astype(np.uint64)
            order = np.lexsort((doc, term))
            owner, first, places, out = slices_of(doc[order], term[order], impact[order])
            wrap = lambda x, kind: pa.array([x], pa.list_(kind))
            return pa.RecordBatch.from_arrays([pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64())), wrap(owner, pa.int32()), wrap(first, pa.int32()), wrap(places, pa.int32()), wrap([x.tobytes() for x in out], pa.binary())], ["ids", "terms", "first", "places", "slices"])

        for whole in batches:
            at = 0
            ends = np.asarray(whole.column("terms").offsets)
            while at < whole.num_rows:
                to = int(np.searchsorted(ends, ends[at] + max(1, BLOCK_POSTINGS - size), "right")) - 1
                to = min(whole.num_rows, at + BLOCK - rows, max(at + 1, to))
                held.append(whole.slice(at, to - at))
                rows, size, at = rows + to - at, size + int(ends[to] - ends[at]), to
                if rows >= BLOCK or size >= BLOCK_POSTINGS:
                    yield block()
                    held, rows, size = [], 0, 0
        if rows:
            yield block()

    return C.lean(run)


def add(sums: np.ndarray, more: np.ndarray) -> None:
    """Add numbers to sums, both as bit slices [bits, ...], by a ripple of carries."""
    carry = None
    for j in range(len(sums)):
        b = more[j] if j < len(more) else None
        if b is None and carry is None:
            break
        if carry is None:
            carry = sums[j] & b
            sums[j] ^= b
        elif b is None:
            carry, sums[j] = sums[j] & carry, sums[j] ^ carry
        else:
            x = sums[j] ^ b
            carry, sums[j] = (sums[j] & b) | (x & carry), x ^ carry


def best(sums: np.ndarray, k: int) -> list[np.ndarray]:
    """The places of each query's k largest sums above 0 [bits, queries, words], of equal ones those that come first."""
    alive = np.bitwise_or.reduce(sums, 0) if len(sums) else np.zeros(sums.shape[1:], np.uint64)
    sure = np.zeros_like(alive)
    for s in sums[::-1]:
        x = sure | (alive & s)
        many = np.bitwise_count(x).sum(1)
        over = (many > k)[:, None]
        sure = np.where(over, sure, x)
        alive = np.where(over, alive & s, alive & ~s)
    out = []
    for g, e in zip(sure, alive, strict=True):
        g, e = (np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little")) for x in (g, e))
        out.append(np.concatenate([g, e[: max(0, k - len(g))]]))
    return out


def _search(shared, k: int):
    def run(batches):
        codes, n_vocabulary = shared.value  # of each query, the places of its terms
        for whole in batches:
            for i in range(whole.num_rows):
                b = {name: whole.column(name)[i] for name in whole.schema.names}
                n = (len(b["ids"]) + 63) // 64
                terms, first, places = (b[x].values.to_numpy() for x in ("terms", "first", "places"))
                where = np.full(n_vocabulary, -1)
                where[terms] = np.arange(len(terms))
                slices = np.array([np.frombuffer(x.as_buffer(), np.uint64) for x in b["slices"]]).reshape(len(b["slices"]), len(places))
                ids = b["ids"].values
                step = max(1, HELD_WORDS // max(n, 1))
                for q in range(0, len(codes), step):
                    own = [x[x >= 0] for x in (where[c] for c in codes[q : q + step])]
                    most = max(map(len, own), default=0)
                    if not most:
                        continue
                    bits = len(slices) + most.bit_length()
                    sums = np.zeros((bits, len(own), n), np.uint64)
                    for t in range(most):
                        more = np.zeros((len(slices), len(own), n), np.uint64)
                        for j, c in enumerate(own):
                            if t < len(c):
                                a, z = first[c[t]], first[c[t] + 1]
                                more[:, j, places[a:z]] = slices[:, a:z]
                        add(sums, more)
                    found = best(sums, k)
                    who = np.repeat(np.arange(len(own)), list(map(len, found)))
                    at = np.concatenate(found)
                    bit = (sums[:, who, at >> 6] >> (at & 63).astype(np.uint64)) & ONE
                    score = (bit << np.arange(bits, dtype=np.uint64)[:, None]).sum(0).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array((q + who).astype(np.int32)), ids.take(pa.array(at)), pa.array(score)], ["q", "doc_id", "score"])

    return C.lean(run)


def weights(rows: DataFrame, vocabulary: list[bytes]) -> tuple[np.ndarray, int, int]:
    """The weight of each term, how many documents have terms and how many terms they have, from `postings`."""
    n_docs, n_terms = rows.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[r["t"]] = r["count"]
    return np.maximum(np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64), 0), n_docs, n_terms


def build(rows: DataFrame, stats: tuple[np.ndarray, int, int]) -> DataFrame:
    """The index of `postings`: a row for each block (ids, terms, first, places, slices)."""
    return rows.mapInArrow(_index(rows.sparkSession.sparkContext.broadcast(stats)), INDEX)


def search(docs: DataFrame, items: DataFrame, k: int = 10, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best rows of docs, best first, equal scores by doc_id.

    docs: doc_id, text, ...; items: item_id, text, ... Null and empty texts have no terms: as documents they are never found, as
    items they find nothing. Rows of docs that repeat are found side by side, rows without doc_id come last among equals. Rows of
    items that repeat are one; different texts of one item_id are items of their own. Other columns are ignored, whatever their
    names. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    rows = scratch.keep(items.select("item_id", F.array_sort(terms(items["text"])).alias("terms"), F.xxhash64("text").alias("h")).where(F.size("terms") > 0).distinct())
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    kind, parts = items.schema["item_id"].dataType, []
    for i in range(-(-total // batch_terms)):
        given = rows.where(F.pmod(F.xxhash64("item_id", "h"), F.lit(-(-total // batch_terms))) == i).collect()
        vocabulary = sorted({t.encode() for r in given for t in r["terms"]})
        code = {t: j for j, t in enumerate(vocabulary)}
        found = scratch.keep(postings(docs, vocabulary))
        stats = spark.sparkContext.broadcast(weights(found, vocabulary))
        asked = spark.sparkContext.broadcast(([np.array([code[t.encode()] for t in r["terms"]], np.int64) for r in given], len(vocabulary)))
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        index, look = _index(stats), _search(asked, k)
        # each block is searched where it is built, and only what is found leaves the task
        found = found.mapInArrow(lambda batches, index=index, look=look: look(index(batches)), "q int, doc_id bigint, score bigint").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(given)], f"q int, item_id {kind.simpleString()}")
        parts.append(scratch.keep(found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")))
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    for p in parts:
        out = p if len(parts) == 1 else out.unionByName(p)
    return out


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH tok AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
n AS (SELECT doc_id, len(t) AS n FROM tok WHERE len(t) > 0),
s AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, nd),
i AS (SELECT tf.doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nd) // l))) AS impact FROM tf JOIN n USING (doc_id) JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM r
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""
