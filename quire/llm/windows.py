"""Seeds of word windows, their count-min sketch, and classes of equal word sequences: shared by the passage operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

C.by_value(__name__)

#: Cells of a slice of the sketch; least and most cells in all (a bit each where it is sent to the executors: 128 MB at most).
SLICE, LEAST_CELLS, MOST_CELLS = 22, 1 << 16, 1 << 30
#: Cells for each seed that is expected, and bytes of text for each seed at a density of one.
CELLS_A_SEED, BYTES_A_WORD = 8, 6
#: Ids are broadcast to filter a scan up to this number, and joined by a shuffle beyond it.
BROADCAST_IDS = 2_000_000
#: Seeds of so many documents are grouped before the shuffle.
HOT = 2000
FLUSH = 4_000_000
#: Bytes of text whose rows go to one partition, and bytes of rows that are grouped there at a time (and the rest of their last key).
PARTITION_BYTES, CHUNK_BYTES = 128 << 20, 32 << 20


def sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each w consecutive values, by doubling."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have * 2 <= w:
        out = f(out[: len(out) - have], out[have:])
        have *= 2
    return f(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])


def window_seeds(h: np.ndarray, off: np.ndarray, k: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The least k-gram hash in each window of so many words (by its start), and which starts are windows of one list."""
    least = sliding(C.grams(h, k), words - k + 1, np.minimum)
    return least, C.starts_of(off, words)[: len(least)]


def seed_places(h: np.ndarray, off: np.ndarray, k: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the k-grams stand that are least in some window, and their hashes: any two equal windows have the same ones."""
    g = C.grams(h, k)
    least, ok = window_seeds(h, off, k, words)
    if not ok.any():
        return np.empty(0, np.int64), g[:0]
    w = words - k + 1
    least = np.where(ok, least, np.uint64(0))
    pad = np.zeros(w - 1, np.uint64)
    reach = sliding(np.concatenate([pad, least, pad]), w, np.maximum)
    at = np.flatnonzero(reach[: len(g)] == g)
    return at, g[at]


def cells_for(total_bytes: int, density: float) -> int:
    want = total_bytes / BYTES_A_WORD * density * CELLS_A_SEED
    return int(min(MOST_CELLS, max(LEAST_CELLS, 1 << int(np.ceil(np.log2(max(want, 2)))))))


def meet(rows: DataFrame, total_bytes: int) -> DataFrame:
    """rows dealt by key and sorted by it, as `chunks` expects them."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // PARTITION_BYTES))
    return rows.repartition(n, "key").sortWithinPartitions("key")


def chunks(batches, most: int = CHUNK_BYTES):
    """Lists of batches, of about so many bytes, from batches that are sorted by key; all rows of a key are in one list."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.get_total_buffer_size()
        if size > most:
            key = held[-1].column("key")
            if held[0].column("key")[0] == key[-1]:
                continue
            # the last key's rows wait for more of them
            at = next(i for i in range(len(held) - 1, -1, -1) if held[i].column("key")[0] != key[-1])
            cut = int(np.searchsorted(held[at].column("key").to_numpy(), key[-1].as_py(), "left"))
            yield [*held[:at], held[at].slice(0, cut)]
            held = [x for x in (held[at].slice(cut), *held[at + 1 :]) if x.num_rows]
            size = sum(x.nbytes for x in held)
    if held:
        yield held


def _partition_sketch(k: int, words: int, cells: int):
    """Each partition's sketch, sparse: for each slice its cells, each as often as documents have it."""
    bits = 64 - (cells.bit_length() - 1)

    def flush(parts):
        cell = np.sort(np.concatenate(parts))
        cut = np.searchsorted(cell, np.arange(0, cells + 1, min(cells, 1 << SLICE)))
        for i in np.flatnonzero(np.diff(cut)):
            part = (cell[cut[i] : cut[i + 1]] - (int(i) << SLICE)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "cells"])

    def run(batches):
        parts, size = [], 0
        for whole in batches:
            for b in C.text_parts(whole):
                h, off = C.hash_words(b.column("text"))
                at, seed = seed_places(h, off, k, words)
                own = C.owners(off)[at]
                order = np.lexsort((seed, own))  # a seed counts once for each document
                seed, own = seed[order], own[order]
                new = np.ones(len(seed), bool)
                new[1:] = (seed[1:] != seed[:-1]) | (own[1:] != own[:-1])
                parts.append((seed[new] >> np.uint64(bits)).astype(np.int64))
                size += len(parts[-1])
                if size > FLUSH:
                    yield from flush(parts)
                    parts, size = [], 0
        if size:
            yield from flush(parts)

    return run


def repeated_cells(docs: DataFrame, k: int, words: int, cells: int, hot: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Two bits for each cell of the merged sketch: whether seeds of two documents or more fall into it, and of `hot` or more.

    docs has the column text. Partition sketches are summed by slice, so no task sees more than a slice of them.
    """
    parts = docs.select("text").mapInArrow(_partition_sketch(k, words, cells), "slice int, cells binary")
    merged = parts.repartition(max(1, cells >> SLICE), "slice").mapInArrow(_merge(cells, hot), "slice int, some binary, many binary").toArrow()
    out = np.zeros((2, cells // 8), np.uint8)
    width = min(cells, 1 << SLICE) // 8
    for column, name in enumerate(("some", "many")):
        for i, bits in zip(merged["slice"].to_pylist(), merged[name].to_pylist(), strict=True):
            out[column, i * width : (i + 1) * width] = np.frombuffer(bits, np.uint8)
    return out[0], out[1]


def _merge(cells: int, hot: int):
    """Sums of the slices dealt to this task, of 4 million cells each."""

    def run(batches):
        width, sums = min(cells, 1 << SLICE), {}
        for b in batches:
            for i, blob in zip(b.column("slice").to_pylist(), b.column("cells"), strict=True):
                s = sums.setdefault(i, np.zeros(width, np.uint16))
                cell, n = np.unique(np.frombuffer(blob.as_buffer(), np.uint32), return_counts=True)
                s[cell] = np.minimum(s[cell].astype(np.int64) + n, 65535)
        for i, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([np.packbits(s >= least).tobytes()], pa.binary()) for least in (2, hot)]], ["slice", "some", "many"])

    return run


def in_cells(seed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cell = seed >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7)).astype(np.uint8))) & 1 > 0


def copies(docs: DataFrame, scratch: C.Scratch) -> DataFrame:
    """doc_id, first_id of the documents whose whole word sequence is that of a smaller doc_id (two independent 64-bit hashes).

    Only groups of several go into the join, as a table of their own: it is small or, where it isn't, a hot group can be split.
    """
    seq = F.regexp_replace(C.trimmed(docs["text"]), C.SPACE_RUN, " ")
    rows = docs.where(docs["doc_id"].isNotNull()).select("doc_id", seq.alias("t")).where("t <> ''").select("doc_id", C.digest(F.col("t"), 0).alias("d1"), C.digest(F.col("t"), 1).alias("d2"))
    rows = scratch.keep(rows)
    first = scratch.keep(rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    return scratch.keep(rows.join(first, ["d1", "d2"]).where("doc_id > first_id").select("doc_id", "first_id").distinct())


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without these doc_ids: a filter on the scan where the ids are few, else a join."""
    ids = gone.select("doc_id")
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti")
