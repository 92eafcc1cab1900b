"""Removal of repeated word windows: a count-min prefilter, then exact grouping of what may repeat.

Each window is counted under its seed, the least of its 5-word hashes: equal windows have equal seeds, so a seed's count is
never below the window's, and there are five times fewer of them. Partitions make sparse sketches that are summed slice by
slice; two bits a cell (two documents or more, very many) go to the executors. The second pass emits only windows whose cell is
set and groups them exactly by a 96-bit hash. Windows of one seed travel together, to where all equal ones meet; those of a
seed that very many documents have are grouped within each task first, and what is left is keyed by its own hash. Whole copies are found
beforehand by digest and emit no windows. The sketch's width follows the input up to a bound; beyond it more windows pass and none is lost.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import windows as W

C.by_value(__name__)

WINDOW, SEED = 13, 5
#: Windows of hot seeds that a task holds at a time (24 bytes each).
FLUSH = 1 << 20


def _late(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of these windows a smaller document has among them too, and which not."""
    order = np.lexsort((doc, h2, h1))
    h1, h2, doc = h1[order], h2[order], doc[order]
    head = np.ones(len(h1), bool)
    head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    late = doc > doc[np.flatnonzero(head)][np.cumsum(head) - 1]
    return order[late], order[~late]


def _by_doc(doc: np.ndarray, pos: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Places as one list for each document."""
    order = np.lexsort((pos, doc))
    ids, first = np.unique(doc[order], return_index=True)
    return pa.array(ids), pa.ListArray.from_arrays(pa.array(np.concatenate([first, [len(doc)]]).astype(np.int32)), pa.array(pos[order].astype(np.int32)))


_HASHES = np.dtype([("h1", "<i8"), ("h2", "<i4")])


def _runs(key, doc, pos, wins, head):
    """Rows of windows: wins holds the hashes, 12 bytes each, of consecutive places from pos on; head tells where rows start."""
    cuts = np.concatenate([head, [len(wins)]]).astype(np.int64) * 12
    packed = pa.Array.from_buffers(pa.large_binary(), len(head), [None, pa.py_buffer(cuts), pa.py_buffer(wins)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(key[head].view(np.int64)), pa.array(doc[head]), pa.array(pos[head]), packed, pa.nulls(len(head), pa.list_(pa.int32()))], _NAMES)


_NAMES = ["key", "doc_id", "pos", "wins", "at"]


def _suspects(window: int, seed: int, sketch):
    """Windows that may repeat, in rows keyed so that all equal ones meet.

    Windows of one seed travel in runs, keyed by the seed. Those of a hot seed are grouped here first: what a smaller document
    of this task has too is decided (a row with places, at, keyed by document), and the others travel singly, keyed by their
    hash. So a window that any number of documents have is sent once for each FLUSH windows of a task.
    """

    def settle(parts):
        wins, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        late, rest = _late(wins["h1"], wins["h2"], doc)
        if len(late):
            ids, at = _by_doc(doc[late], pos[late])
            n = len(ids)
            yield pa.RecordBatch.from_arrays([ids, ids, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), at], _NAMES)
        wins = wins[rest]
        yield _runs(np.ascontiguousarray(wins["h1"]), doc[rest], pos[rest], wins, np.arange(len(rest)))

    def run(batches):
        some, many = sketch.value
        parts, held = [], 0
        for whole in batches:
            for b in C.text_parts(whole):
                h, off = C.hash_words(b.column("text"))
                least, ok = W.window_seeds(h, off, seed, window)
                at = np.flatnonzero(ok)
                at = at[W.in_cells(least[at], some)]
                own = C.owners(off)[at]
                hashes = np.empty(len(at), _HASHES)
                hashes["h1"] = C.grams(h, window)[at].view(np.int64)
                hashes["h2"] = (C.grams(h, window, 7)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                doc, pos = b.column("doc_id").to_numpy()[own], (at - off[own]).astype(np.int32)
                hot = W.in_cells(least[at], many)
                if hot.any():
                    parts.append((hashes[hot], doc[hot], pos[hot]))
                    held += int(hot.sum())
                    if held > FLUSH:
                        yield from settle(parts)
                        parts, held = [], 0
                cool = ~hot
                at, own, key = at[cool], own[cool], least[at[cool]]
                head = np.ones(len(at), bool)
                head[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]) | (own[1:] != own[:-1])
                yield _runs(key, doc[cool], pos[cool], hashes[cool], np.flatnonzero(head))
        if parts:
            yield from settle(parts)

    return run


def _opened(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Hashes, documents and places of all windows of a batch of runs."""
    wins = b.column("wins").to_pylist()
    n = np.array(list(map(len, wins))) // 12
    hashes = np.frombuffer(b"".join(wins), np.dtype([("h1", "<i8"), ("h2", "<i4")]))
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
    return hashes["h1"], hashes["h2"], np.repeat(b.column("doc_id").to_numpy(), n), (np.repeat(b.column("pos").to_numpy(), n) + place).astype(np.int32)


def _repeats(batches):
    """For each document, the places of its windows that stand in a smaller doc_id, among all rows of the same keys."""
    for held in W.chunks(batches):
        parts = []
        for b in held:
            done = np.asarray(b.column("at").is_valid())
            if done.any():
                yield b.filter(pa.array(done)).select(["doc_id", "at"])
                b = b.filter(pa.array(~done))
            if b.num_rows:
                parts.append(_opened(b))
        if parts:
            h1, h2, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
            late, _ = _late(h1, h2, doc)
            yield pa.RecordBatch.from_arrays(list(_by_doc(doc[late], pos[late])), ["doc_id", "at"])


def _cut(window: int):
    split = re.compile(C.SPACE_RUN)

    def run(batches):
        for b in batches:
            n, gone, sha, kept = [], [], [], []
            for text, whole, at in zip(b.column("text").to_pylist(), b.column("whole").to_pylist(), b.column("at").to_pylist(), strict=True):
                text = (text or "").strip(C.SPACES)
                words = split.split(text) if text else []
                n.append(len(words))
                if whole and len(words) >= window:
                    words = []
                elif at:
                    cover = np.zeros(len(words) + 1, np.int32)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.minimum(np.array(at) + window, len(words)), -1)
                    stay = np.cumsum(cover)[:-1] == 0
                    words = [w for w, s in zip(words, stay, strict=True) if s]
                gone.append(n[-1] - len(words))
                kept.append(" ".join(words))
                sha.append(hashlib.sha256(kept[-1].encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot: int = W.HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every row of docs (doc_id, text, ...).

    A word goes if it lies in a window whose word sequence also starts in a document of smaller doc_id; windows are judged on
    the input. Empty and null texts have no words; texts shorter than a window lose none. Rows that share a doc_id are one
    document; rows without one lose nothing and take nothing from others. Seeds of `hot` documents or more are grouped before
    the shuffle.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    whole = W.copies(docs, scratch)
    firsts = W.without(docs.where(docs["doc_id"].isNotNull()).select("doc_id", "text"), whole)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    cells = W.cells_for(total, 2 / (window - seed + 2))
    sketch = spark.sparkContext.broadcast(W.repeated_cells(firsts, seed, window, cells, hot))
    runs = firsts.mapInArrow(_suspects(window, seed, sketch), "key bigint, doc_id bigint, pos int, wins binary, at array<int>")
    # equal windows have equal keys, so a partition by key holds all of them
    some = W.meet(runs, total).mapInArrow(C.lean(_repeats), "doc_id bigint, at array<int>")
    repeats = some.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    marks = repeats.select("doc_id", "at", F.lit(False).alias("whole")).union(whole.select("doc_id", F.lit(None), F.lit(True)))
    rows = docs.select("doc_id", "text").join(marks.groupBy("doc_id").agg(F.first("at", True).alias("at"), F.max("whole").alias("whole")), "doc_id", "left")
    return rows.mapInArrow(_cut(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`remove_repeats` over all documents, without the texts."""
    return remove_repeats(C.table(spark, sf_dir, "documents")).drop("kept_text")
