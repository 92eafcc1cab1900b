"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

Each text's piece lattice is summed forward and a segmentation is drawn backward, with random numbers that depend on the row's
key and the place in the text only; a rerun, another batch size or another partitioning gives the same ids. Piece weights come
from the order of the public vocabulary, raised to `theta`: the smaller, the more varied. Characters without a piece are
written as their bytes, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import lattice as L

C.by_value(__name__)

SEED = 1
#: Bytes of text whose lattice is held at a time (some hundred times that in memory), also within a longer text.
PART_BYTES = 1 << 19


def spaced(text: Column) -> Column:
    """The text with a space before it; an empty or null text stays empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", t).otherwise(F.concat(F.lit(" "), t))


def cut_units(column) -> tuple[pa.Array, np.ndarray]:
    """The units of an Arrow column of `spaced` texts, cut before each space that follows something else, and each text's first unit.

    No byte is copied: units are slices of the column's own bytes.
    """
    column = column.cast("large_binary")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    n, base = int(off[-1] - off[0]), int(off[0])
    off = off - base
    if not n:
        return pa.array([], pa.string()), np.zeros(len(off), np.int64)
    space = np.frombuffer(column.buffers()[2], np.uint8)[base : base + n] == 32
    head = space.copy()
    head[1:] &= ~space[:-1]
    head[off[:-1][np.diff(off) > 0]] = True
    at = np.flatnonzero(head)
    bounds = pa.py_buffer(np.concatenate([at, [n]]) + base)
    return pa.LargeStringArray.from_buffers(len(at), bounds, column.buffers()[2]), np.searchsorted(at, off, "left")


def expand(pieces: np.ndarray, byte_base: int, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fallback characters (-1 - code point) become the ids of their bytes; count: pieces of each row, before and after."""
    c = -1 - pieces
    many = np.where(pieces < 0, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
    out = np.repeat(pieces, many)
    lone = pieces < 0
    if lone.any():
        raw = "".join(map(chr, c[lone].tolist())).encode("utf-8", "surrogatepass")
        out[np.repeat(lone, many)] = byte_base + np.frombuffer(raw, np.uint8).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(many)])
    stop = np.cumsum(count)
    return out.astype(np.int32), ends[stop] - ends[stop - count]


def decode_ids(ids, table: list[bytes]) -> str:
    """The text of a row of ids, whose first space is the one that encoding put before it."""
    return b"".join([table[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


def byte_table(v: L.Vocabulary) -> list[bytes]:
    table = [p.encode("utf-8", "surrogatepass") for p in v.pieces]
    for x in range(256):
        table[v.byte_base + x] = bytes([x])
    return table


def spans(units) -> list[tuple[int, int]]:
    """Ranges of units with about PART_BYTES of text each."""
    ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset + 1 : units.offset + len(units) + 1] if len(units) else np.empty(0, np.int64)
    out, at = [], 0
    while at < len(ends):
        start = ends[at - 1] if at else ends[0]
        to = max(at + 1, int(np.searchsorted(ends, start + PART_BYTES, "right")))
        out.append((at, to))
        at = to
    return out


def _draw(v: L.Vocabulary, p: np.ndarray, units, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A segmentation of each unit, and how many pieces it has."""
    coded = units.dictionary_encode()
    lat = L.build(coded.dictionary.to_pylist(), v)
    alpha, _, shift = L.forward(lat, p[None])
    pieces, count, _ = L.sample(lat, alpha[0], shift, p, coded.indices.to_numpy(), stream)
    return pieces, count


def _encode(shared, seed: int, digests: bool):
    def run(batches):
        fields, p = shared.value
        v = L.Vocabulary(*fields)
        table = byte_table(v)
        for whole in batches:
            for b in C.text_parts(whole, part=PART_BYTES):
                units, off = cut_units(b.column("text"))
                key = C.mix(b.column("key").to_numpy().view(np.uint64) ^ np.uint64(seed))
                n = np.diff(off)
                place = np.arange(off[-1]) - np.repeat(off[:-1], n)
                stream = C.mix(np.repeat(key, n) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                drawn = [_draw(v, p, units[a:z], stream[a:z]) for a, z in spans(units)]
                pieces, count = (np.concatenate(x) for x in zip(*drawn, strict=True)) if drawn else (np.empty(0, np.int64), np.empty(0, np.int64))
                del units, stream, drawn
                stops = np.concatenate([[0], np.cumsum(count)])[off]
                ids, rows = expand(pieces, v.byte_base, np.diff(stops))
                ends = np.concatenate([[0], np.cumsum(rows)]).astype(np.int64)
                if digests:
                    parts = [ids[ends[i] : ends[i + 1]] for i in range(len(rows))]
                    back = [decode_ids(x.tolist(), table) for x in parts]
                    given = b.column("text").to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id"), pa.array(rows.astype(np.int64)), pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in parts]), pa.array([x == y[1:] for x, y in zip(back, given, strict=True)])],
                        ["doc_id", "n_pieces", "ids_sha256", "lossless"],
                    )
                else:
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))], ["doc_id", "ids"])

    return C.lean(run)


def _shared(spark: SparkSession, model: str, theta: float):
    v = L.load(model)
    return spark.sparkContext.broadcast((L.plain(v), L.zipf(v, theta)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("key"), spaced(docs["text"]).alias("text"))


def encode(docs: DataFrame, model: str = L.DEFAULT_MODEL, theta: float = 1.0, seed: int = SEED) -> DataFrame:
    """doc_id, ids (array of int) of every row of docs (doc_id, text, ...). Empty and null texts have no ids; equal rows have equal ids.

    Rows without doc_id share one stream of draws. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    return _rows(docs).mapInArrow(_encode(_shared(spark, model, theta), seed, False), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str = L.DEFAULT_MODEL) -> DataFrame:
    """doc_id, text of rows of `encode`; null ids and no ids are the empty text. Other columns are ignored; an empty table gives no rows."""
    C.small_batches(encoded.sparkSession)
    table = encoded.sparkSession.sparkContext.broadcast(byte_table(L.load(model)))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([decode_ids(x or [], table.value) for x in b.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def encode_report(docs: DataFrame, model: str = L.DEFAULT_MODEL, theta: float = 1.0, seed: int = SEED) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (ids as little-endian 32-bit integers), lossless: whether decoding the ids gives the text back."""
    spark = docs.sparkSession
    C.small_batches(spark)
    return _rows(docs).mapInArrow(_encode(_shared(spark, model, theta), seed, True), "doc_id bigint, n_pieces bigint, ids_sha256 string, lossless boolean")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`encode_report` over all documents."""
    return encode_report(C.table(spark, sf_dir, "documents"))
