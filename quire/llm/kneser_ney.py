"""Language-model scoring by an interpolated n-gram model with modified Kneser-Ney discounts.

Counting runs in Spark, one shuffle for each order: a task sums the n-grams of its texts and deals them by the hash of their
context; whoever gets a shard merges them, writes it to the shared folder as arrays sorted by hash, and sends on how many
different words stand before each shorter n-gram (its continuation count). Contexts that end in a very frequent word are dealt by
the whole n-gram instead, and their totals are summed in a second step, so no shard grows with one word. Which words are
frequent is told by a sample of the texts; it decides where counts are summed, not what they are.
Scoring workers map the arrays into memory and look up the n-grams of many texts at a time, in order of their hashes: only the
pages in which they fall are read. Discounts follow from the counts of counts of each order; unigrams are interpolated with one
share for each known word and one for all unknown ones, so the probabilities after any context add up to one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

C.by_value(__name__)

ORDER = 2
#: Bytes of text to a task of a merge, shards to a task, tokens that are counted at a time, bytes of text that are scored at a time.
TASK_BYTES, SHARDS_A_TASK, COUNTED, SCORED_BYTES = 64 << 20, 4, 3_000_000, 4 << 20
#: Bytes of text in the sample that tells frequent words; a word is frequent that makes up 1 / (FREQUENT * shards) of it.
SAMPLE_BYTES, FREQUENT = 32 << 20, 8
START, END = np.uint64(0x5354415254202020), np.uint64(0x454E442020202020)
_ODD = np.uint64(0x9E3779B97F4A7C15)
ROWS = "kind string, level int, shard int, a binary, b binary, c binary, d binary, path string, stats array<bigint>"
NAMES = [x.split()[0] for x in ROWS.split(", ")]
TYPES = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.string(), pa.list_(pa.int64())]


@dataclass
class Model:
    """What workers need to find and use the arrays; as large as the number of shards."""

    order: int
    shards: int
    frequent: np.ndarray  # hashes of contexts of one word, sorted
    train_tokens: int = 0
    n_words: int = 0
    total: int = 0  # of continuation counts of words
    kinds: list[int] = field(default_factory=lambda: [0, 0, 0])  # words with count 1, 2, 3 and more
    discounts: dict[int, list[float]] = field(default_factory=dict)
    files: dict = field(default_factory=dict)  # (kind, level, shard): path, entries, bytes a count


def plain(m: Model) -> tuple:
    return m.order, m.shards, m.frequent, m.train_tokens, m.n_words, m.total, m.kinds, m.discounts, m.files


# n-grams of a batch of texts


def sequences(column, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of every token (the words of each text and one end) its hash and those of its contexts of 1 to order - 1 tokens; each text's first token."""
    h, first = C.hash_words(column, lower=True)
    n, pad = np.diff(first) + 1, order - 1
    start = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=start[1:])
    own = np.repeat(np.arange(len(n)), n)
    all_of = np.full(int(start[-1]) + pad * len(n), START)
    at = np.arange(int(start[-1])) + pad * (own + 1)
    end = start[1:] - 1
    words = np.ones(len(own), bool)
    words[end] = False
    all_of[at[words]] = h
    all_of[at[end]] = END
    contexts = []
    for k in range(1, order):
        before = all_of[at - k]
        contexts.append(C.mix(before + _ODD) if k == 1 else C.mix(contexts[-1] * _ODD + before))
    return all_of[at], contexts, start


def key(contexts: list[np.ndarray], word: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from its longest context's and its last word's."""
    return C.mix(contexts[-1] * _ODD + word) if contexts else word


def deal(contexts: list[np.ndarray], k: np.ndarray, frequent: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram."""
    route = k
    if contexts:
        route = np.where(is_in(contexts[0], frequent), k, contexts[-1])
    return ((C.mix(route) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def deal_context(c: np.ndarray, shards: int) -> np.ndarray:
    return ((C.mix(c) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def is_in(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(x), bool)
    return among[np.minimum(np.searchsorted(among, x), len(among) - 1)] == x


def heads(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


def summed(contexts: list[np.ndarray], word: np.ndarray, counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[np.ndarray]]:
    """Each different n-gram once, by hash: contexts, words, hashes, sums of counts."""
    k = key(contexts, word)
    order = np.argsort(k)
    at = heads(k[order])
    first = order[at]
    return [c[first] for c in contexts], word[first], k[first], [np.add.reduceat(c[order], at) if len(at) else c for c in counts]


def packed(level: int, contexts: list[np.ndarray], word: np.ndarray, k: np.ndarray, counts: list[np.ndarray], frequent: np.ndarray, shards: int):
    """Rows for each shard: its contexts with the lengths of their runs, words, counts."""
    shard = deal(contexts, k, frequent, shards)
    order = np.lexsort((contexts[-1], shard)) if contexts else np.argsort(shard, kind="stable")
    contexts, word, counts, shard = [c[order] for c in contexts], word[order], [c[order] for c in counts], shard[order]
    cut = np.append(heads(shard), len(shard))
    for a, z in zip(cut[:-1], cut[1:], strict=True):
        at = heads(contexts[-1][a:z]) if contexts else np.zeros(1, np.int64)
        runs = np.diff(np.append(at, z - a)).astype(np.uint32)
        chain = np.concatenate([c[a:z][at] for c in contexts]) if contexts else np.empty(0, np.uint64)
        yield ("low", level, int(shard[a]), chain.tobytes(), runs.tobytes(), word[a:z].tobytes(), b"".join(c[a:z].astype(np.uint64 if i else np.uint32).tobytes() for i, c in enumerate(counts)), None, None)


def unpacked(rows: list[tuple], level: int) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    contexts, words, counts, raws = [[] for _ in range(level - 1)], [], [], []
    for a, b, c, d in rows:
        runs, word = np.frombuffer(b, np.uint32), np.frombuffer(c, np.uint64)
        chain = np.frombuffer(a, np.uint64).reshape(level - 1, -1) if level > 1 else ()
        for x, part in zip(contexts, chain, strict=True):
            x.append(np.repeat(part, runs))
        words.append(word)
        counts.append(np.frombuffer(d, np.uint32, len(word)).astype(np.int64))
        raws.append(np.frombuffer(d, np.uint64, len(word), 4 * len(word)).astype(np.int64) if len(d) > 4 * len(word) else counts[-1])
    return [np.concatenate(x) for x in contexts], np.concatenate(words), [np.concatenate(counts), np.concatenate(raws)]


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


def _count(order: int, frequent: np.ndarray, shards: int):
    def run(batches):
        held, size = [], 0

        def flush():
            word = np.concatenate([w for w, _ in held])
            contexts = [np.concatenate(x) for x in zip(*(c for _, c in held), strict=True)]
            held.clear()
            contexts, word, k, counts = summed(contexts, word, [np.ones(len(word), np.int64)])
            for row in packed(order, contexts, word, k, counts, frequent, shards):
                yield batch([row])

        for whole in batches:
            for b in C.text_parts(whole):
                word, contexts, _ = sequences(b.column("text"), order)
                held.append((word, contexts))
                size += len(word)
                if size >= COUNTED:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    return C.lean(run)


# shards


def _write(root: str, name: str, arrays: list[np.ndarray]) -> str:
    """A file of these arrays in the shared folder; a task that is run again writes one of its own."""
    store, folder = pafs.FileSystem.from_uri(root)
    store.create_dir(folder, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{folder}/{name}") as out:
        for x in arrays:
            out.write(np.ascontiguousarray(x))
    return f"{root}/{name}"


def narrow(x: np.ndarray) -> np.ndarray:
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def totals(context: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each context once, sorted, and [4, contexts]: the sum of its counts, how many are 1, 2, 3 and more."""
    order = np.argsort(context, kind="stable")
    at, c = heads(context[order]), count[order]
    if not len(at):
        return context, np.zeros((4, 0), np.int64)
    return context[order][at], np.stack([np.add.reduceat(x, at) for x in (c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64))])


def _merge(level: int, root: str, frequent: np.ndarray, shards: int):
    """Write the shards of this level; rows on: files, counts of counts, totals of contexts that lie in several shards, counts for the level below."""

    def run(batches):
        now, held, below = None, [], []

        def shard():
            contexts, word, counts = unpacked(held, level)
            contexts, word, k, (count, raw) = summed(contexts, word, counts)
            small = narrow(count)
            path = _write(root, f"grams-{level}-{now}", [k, small] + ([raw] if level == 1 else []))
            tally = [int((count == i).sum()) for i in (1, 2, 3, 4)]
            yield ("grams", level, now, None, None, None, None, path, [len(k), small.itemsize, *tally, int(count.sum()), int(raw.sum()), int((count > 2).sum())])
            if contexts:
                spread = is_in(contexts[0], frequent)
                context, t = totals(contexts[-1][~spread], count[~spread])
                if len(context):
                    path = _write(root, f"contexts-{level}-{now}", [context, t])
                    yield ("contexts", level, now, None, None, None, None, path, [len(context)])
                context, t = totals(contexts[-1][spread], count[spread])
                for s in np.unique(deal_context(context, shards)) if len(context) else ():
                    own = deal_context(context, shards) == s
                    yield ("spread", level, int(s), context[own].tobytes(), np.ascontiguousarray(t[:, own]).tobytes(), None, None, None, None)
                below.append((contexts[:-1], word, raw))

        def down():
            contexts = [np.concatenate(x) for x in zip(*(c for c, _, _ in below), strict=True)]
            word, raw = (np.concatenate([x[i] for x in below]) for i in (1, 2))
            below.clear()
            contexts, word, k, counts = summed(contexts, word, [np.ones(len(word), np.int64), raw])
            for row in packed(level - 1, contexts, word, k, counts, frequent, shards):
                yield batch([row])

        for b in batches:
            for row in zip(*(b.column(x).to_pylist() for x in NAMES), strict=True):
                if row[0] != "low":
                    yield batch([row])
                    continue
                if now is not None and row[2] != now:
                    for out in shard():
                        yield batch([out])
                    held.clear()
                now = row[2]
                held.append(row[3:7])
        if held:
            for out in shard():
                yield batch([out])
            held.clear()
        if below:
            yield from down()

    return C.lean(run)


def _gather(root: str):
    """Sum the totals of contexts that lie in several shards and write them."""

    def run(batches):
        now, held = None, []

        def done():
            context = np.concatenate([np.frombuffer(a, np.uint64) for a, _ in held])
            t = np.concatenate([np.frombuffer(b, np.int64).reshape(4, -1) for _, b in held], 1)
            order = np.argsort(context, kind="stable")
            at = heads(context[order])
            path = _write(root, f"spread-{now[0]}-{now[1]}", [context[order][at], np.add.reduceat(t[:, order], at, axis=1)])
            return batch([("spread", *now, None, None, None, None, path, [len(at)])])

        for b in batches:
            for row in zip(*(b.column(x).to_pylist() for x in NAMES), strict=True):
                if now is not None and (row[1], row[2]) != now:
                    yield done()
                    held.clear()
                now = (row[1], row[2])
                held.append(row[3:5])
        if held:
            yield done()

    return C.lean(run)


def discounts(tally: list[int]) -> list[float]:
    """Discounts of counts 0, 1, 2, 3 and more from how many n-grams have counts 1 to 4; fixed ones where those don't tell."""
    n1, n2, n3, n4 = tally
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        out = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < d <= i for i, d in enumerate(out[1:], 1)):
            return out
    return [0.0, 0.5, 1.0, 1.5]


def _frequent(batches):
    for whole in batches:
        for b in C.text_parts(whole):
            word, n = np.unique(sequences(b.column("text"), 1)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["h", "n"])


def fit(docs: DataFrame, order: int = ORDER) -> Model:
    """Count the n-grams of all rows of docs (text, ...). Null texts are empty; each text ends with a token of its own; rows that repeat count."""
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    root = f"{scratch.root}/model"
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    shards = SHARDS_A_TASK * tasks
    words = texts.sample(min(1.0, SAMPLE_BYTES / max(size, 1)), 1).mapInArrow(_frequent, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    words = scratch.keep(words)
    seen = words.agg(F.sum("n")).first()[0] or 0
    top = np.array([r["h"] for r in words.where(F.col("n") * (FREQUENT * shards) >= seen).collect()], np.int64).view(np.uint64)
    m = Model(order, shards, np.sort(np.append(C.mix(top + _ODD), C.mix(np.array([START]) + _ODD))))
    rows = texts.mapInArrow(_count(order, m.frequent, shards), ROWS)
    for level in range(order, 0, -1):
        rows = rows.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(_merge(level, root, m.frequent, shards), ROWS)
    rows = scratch.keep(rows)
    spread = rows.where("kind = 'spread'").repartition(tasks, "shard").sortWithinPartitions("level", "shard").mapInArrow(_gather(root), ROWS)
    tally = {level: [0] * 4 for level in range(1, order + 1)}
    for r in [*rows.where("kind in ('grams', 'contexts')").select("kind", "level", "shard", "path", "stats").collect(), *spread.select("kind", "level", "shard", "path", "stats").collect()]:
        m.files[r["kind"], r["level"], r["shard"]] = (r["path"], r["stats"][0], r["stats"][1] if r["kind"] == "grams" else 8)
        if r["kind"] == "grams":
            tally[r["level"]] = [x + y for x, y in zip(tally[r["level"]], r["stats"][2:6], strict=True)]
            if r["level"] == 1:
                m.n_words, m.total, m.train_tokens = m.n_words + r["stats"][0], m.total + r["stats"][6], m.train_tokens + r["stats"][7]
                m.kinds = [x + y for x, y in zip(m.kinds, (r["stats"][2], r["stats"][3], r["stats"][8]), strict=True)]
    m.discounts = {level: discounts(t) for level, t in tally.items()}
    return m


# scoring


class Arrays:
    """Sorted hash arrays, mapped into memory when they are first used."""

    def __init__(self, m: Model):
        self.m, self.open = m, {}

    def mapped(self, kind: str, level: int, shard: int):
        at = (kind, level, shard)
        if at not in self.open:
            self.open[at] = self._map(*self.m.files[at], kind, level) if at in self.m.files else None
        return self.open[at]

    def _map(self, path: str, n: int, width: int, kind: str, level: int):
        store, name = pafs.FileSystem.from_uri(path)
        own = None
        if not isinstance(store, pafs.LocalFileSystem):  # a copy that is gone when nothing maps it any more
            handle, own = tempfile.mkstemp()
            with store.open_input_stream(name) as given, os.fdopen(handle, "wb") as out:
                while part := given.read(1 << 24):
                    out.write(part)
        keys = np.memmap(own or name, np.uint64, "r", 0, (n,))
        if kind == "grams":
            out = (keys, np.memmap(own or name, f"u{width}", "r", 8 * n, (1, n)), np.memmap(own or name, np.int64, "r", (8 + width) * n, (1, n)) if level == 1 else None)
        else:
            out = (keys, np.memmap(own or name, np.int64, "r", 8 * n, (4, n)), None)
        if own:
            os.unlink(own)
        return out

    def find(self, kind: str, level: int, shard: np.ndarray, k: np.ndarray, values: np.ndarray, raw: np.ndarray | None = None) -> None:
        """Fill values [rows, len(k)] (and raw) for the sorted hashes k; what isn't found stays."""
        order = np.argsort(shard, kind="stable")
        cut = np.append(heads(shard[order]), len(order))
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            got = self.mapped(kind, level, int(shard[order[a]]))
            if got is None or not len(got[0]):
                continue
            own = order[a:z]
            at = np.minimum(np.searchsorted(got[0], k[own]), len(got[0]) - 1)
            hit = got[0][at] == k[own]
            values[:, own[hit]] = got[1][:, at[hit]]
            if raw is not None:
                raw[own[hit]] = got[2][0, at[hit]]


def token_scores(m: Model, arrays: Arrays, word: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The model's probability of each token after its context, and how often training texts have it."""
    p = np.full(len(word), 1.0 / (m.n_words + 1))
    raws = np.zeros(len(word), np.int64)
    for level in range(1, m.order + 1):
        own = contexts[: level - 1]
        k, first, back = np.unique(key(own, word), return_index=True, return_inverse=True)
        count, raw = np.zeros((1, len(k)), np.int64), np.zeros(len(k), np.int64)
        arrays.find("grams", level, deal([c[first] for c in own], k, m.frequent, m.shards), k, count, raw if level == 1 else None)
        d = np.array(m.discounts.get(level, [0.0] * 4))
        taken = np.maximum(count[0] - d[np.minimum(count[0], 3)], 0)[back]
        if level == 1:
            raws = raw[back]
            t = np.array([m.total, *m.kinds])[:, None]
        else:
            c, first, back = np.unique(own[-1], return_index=True, return_inverse=True)
            t, spread, shard = np.zeros((4, len(c)), np.int64), is_in(own[0][first], m.frequent), deal_context(c, m.shards)
            for kind, which in (("contexts", ~spread), ("spread", spread)):
                part = np.zeros((4, int(which.sum())), np.int64)
                arrays.find(kind, level, shard[which], c[which], part)
                t[:, which] = part
            t = t[:, back]
        seen = t[0] > 0
        total = np.where(seen, t[0], 1)
        p = np.where(seen, taken / total + (d[1] * t[1] + d[2] * t[2] + d[3] * t[3]) / total * p, p)
    return p, raws


def _score(shared):
    def run(batches):
        m = Model(*shared.value)
        arrays = Arrays(m)
        for whole in batches:
            for b in C.text_parts(whole, part=SCORED_BYTES):
                word, contexts, start = sequences(b.column("text"), m.order)
                p, raw = token_scores(m, arrays, word, contexts)
                base = np.log10((raw + 1) / (m.train_tokens + m.n_words + 1))
                sums = [np.add.reduceat(x, start[:-1]) for x in (np.log10(p), base, (raw > 0).astype(np.int64))]
                n = np.diff(start)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array(n), pa.array(sums[2]), pa.array(np.full(len(n), m.train_tokens)), pa.array(sums[1]), pa.array(sums[0]), pa.array(10.0 ** np.minimum(-sums[0] / n, 300))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
                )

    return C.lean(run)


def score(docs: DataFrame, m: Model, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row of docs (doc_id, text, ...).

    score: log10 of the text's probability with its end; base_score: the same by unigrams with one added to each count. Null and
    empty texts have one token, their end. Rows that repeat are scored alike. A model of no texts gives every token probability 1.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    shared = spark.sparkContext.broadcast(plain(m))
    rows = docs.select("doc_id", (held_out if held_out is not None else F.lit(False)).alias("held_out"), docs["text"].alias("text"))
    return rows.mapInArrow(_score(shared), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double")


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`score` of all documents, learned from those whose crc32 modulo 7 isn't 2."""
    docs = C.table(spark, sf_dir, "documents")
    out = C.crc_mod(F.col("doc_id"), 7) == 2
    return score(docs, fit(docs.where(~out)), out)
