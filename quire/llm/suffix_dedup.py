"""Repeated passages by sparse suffix arrays.

Of each document the suffixes are retained that start at content-selected places: where a 16-word hash is the least of some
window of a passage's minimum length, so that equal windows retain the same suffix. A count-min sketch leaves out suffixes whose
first words no other document can have. The rest are dealt by their first words and sorted twice, by the words that follow and,
backwards, by the words before; the common lengths of neighbours in either order split them into classes for every depth, and a
suffix whose best neighbours agree on too few words in all is dropped. Two suffixes share a window that reaches o words to the
left exactly if they are in one class at depth o to the left and in one at the rest to the right; so matches are extended to both
sides among all holders of a passage, not only between neighbours that happen to be alike on one side. What a document of smaller
id also has is reported, consecutive windows as one span, and overlapping spans are joined.

Windows of a suffix start that very many documents have don't fit one task: they are grouped within each task first, and what is
left is keyed by its own 96-bit hash. Whole copies of a document are found beforehand by digest and reported whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import substring_dedup as S
from . import windows as W

C.by_value(__name__)

PASSAGE, GRAM = 50, 16


def _hashes(h: np.ndarray, passage: int) -> np.ndarray:
    """A 96-bit hash of each run of so many words, by doubling."""
    out = np.empty(max(0, len(h) - passage + 1), S._HASHES)
    one, two = (W.sliding(C.mix(h ^ np.uint64(salt)), passage, lambda x, y: C.mix(x * np.uint64(C._ODD) + y)) for salt in (0, 0x5851F42D4C957F2D))
    out["h1"], out["h2"] = one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _leads(group: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a smaller document in their group, and the first row of the smallest one."""
    order = np.argsort(group, kind="stable")
    same = group[order[1:]] == group[order[:-1]]
    met = np.zeros(len(group), bool)
    met[1:] |= same
    met[:-1] |= same
    order = order[met]
    order = order[np.lexsort((pos[order], doc[order], group[order]))]
    head = np.ones(len(order), bool)
    head[1:] = group[order[1:]] != group[order[:-1]]
    lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    late = doc[order] > doc[lead]
    return order[late], lead[late]


def _late(wins: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of these windows a smaller document has among them too, and where: the first place in the smallest one."""
    order = np.lexsort((wins["h2"], wins["h1"]))
    new = np.ones(len(order), bool)
    new[1:] = (wins["h1"][order[1:]] != wins["h1"][order[:-1]]) | (wins["h2"][order[1:]] != wins["h2"][order[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return _leads(group, doc, pos)


def _spans(d: np.ndarray, p: np.ndarray, d0: np.ndarray, p0: np.ndarray, passage: int) -> list[np.ndarray]:
    """Windows and their leads as spans: windows that follow each other are one, with the first one's lead."""
    order = np.lexsort((p0, d0, p, d))
    d, p, d0, p0 = d[order], p[order], d0[order], p0[order]
    head = np.ones(len(d), bool)
    head[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)
    at = np.flatnonzero(head)
    last = np.concatenate([at[1:], [len(d)]])[: len(at)] - 1
    return [d[at], p[at].astype(np.int32), (p[last] + passage).astype(np.int32), d0[at], p0[at].astype(np.int32)]


def _listed(group: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A row of each group and the group's places, in order, as lists."""
    order = np.lexsort((pos, group))
    _, first = np.unique(group[order], return_index=True)
    ends = np.concatenate([first, [len(pos)]]).astype(np.int32)
    return order[first], pa.ListArray.from_arrays(pa.array(ends), pa.array(pos[order].astype(np.int32)))


_COLUMNS = ["doc_id", "start", "stop", "other_id", "other_start"]
_NAMES = ["key", "doc_id", "pos", "windows", "words", "stop", "other_id", "other_start"]
_SCHEMA = "key bigint, doc_id bigint, pos array<int>, windows bigint, words binary, stop int, other_id bigint, other_start int"


def _sides(windows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words to the left and to the right a suffix needs for its windows (bit o: the one that starts o words before it)."""
    bits = (windows[:, None] >> np.arange(reach + 1)) & 1
    return reach - bits[:, ::-1].argmax(1), reach - bits.argmax(1)


def _suffixes(h: np.ndarray, off: np.ndarray, least: np.ndarray, ok: np.ndarray, k: int, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of retained suffixes and the windows that each is the least of, as bits."""
    g, reach = C.grams(h, k), passage - k
    windows = np.zeros(len(g), np.int64)
    start = np.flatnonzero(ok)
    for o in range(reach + 1):
        mine = start[g[start + o] == least[start]]
        windows[mine + o] |= 1 << o
    at = np.flatnonzero(windows)
    return at, windows[at]


def _context(h: np.ndarray, at: np.ndarray, windows: np.ndarray, k: int, reach: int) -> pa.Array:
    """The hashes of the words before each suffix, nearest first, and of those after its first k words, as far as its windows go."""
    left, right = _sides(windows, reach)
    n = left + right
    ends = np.cumsum(n)
    j = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
    before = np.repeat(left, n)
    here = np.repeat(at, n)
    words = h[np.where(j < before, here - 1 - j, here + k + j - before)]
    bounds = np.concatenate([[0], ends]).astype(np.int64) * 8
    return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(words)]).cast(pa.binary())


def _rows(key, doc, pos, windows, words) -> pa.RecordBatch:
    n = len(key)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pos, windows if windows is not None else pa.nulls(n, pa.int64()), words, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], _NAMES)


def _alike(own: np.ndarray, seed: np.ndarray, windows: np.ndarray, words: pa.Array) -> np.ndarray:
    """A number for each suffix, the same for those of one text whose words agree as far as their windows go, as in a text that repeats itself."""
    order = np.lexsort((seed, own))
    same = (own[order[1:]] == own[order[:-1]]) & (seed[order[1:]] == seed[order[:-1]])
    often = np.zeros(len(own), bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    group, at, seen = np.arange(len(own)), np.flatnonzero(often), {}
    if len(at):
        for i, *what in zip(at.tolist(), own[at].tolist(), seed[at].tolist(), windows[at].tolist(), words.take(pa.array(at)).to_pylist(), strict=True):
            group[i] = seen.setdefault(tuple(what), i)
    return group


def _suspects(passage: int, k: int, sketch):
    """Suffixes that another document may have, in rows keyed by their first words.

    Those of a start that very many documents have come as single windows, keyed by their own hash (no windows bits), once
    for each FLUSH of a task; spans that are decided here come out as such (stop). What a text holds several times is one row.
    """
    reach = passage - k

    def settle(parts):
        wins, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        late, lead = _late(wins, doc, pos)
        if len(late):
            d, start, *others = (pa.array(x) for x in _spans(doc[late], pos[late], doc[lead], pos[lead], passage))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32)), start)
            yield pa.RecordBatch.from_arrays([d, d, lists, pa.nulls(len(d), pa.int64()), pa.nulls(len(d), pa.binary()), *others], _NAMES)
        rest = np.ones(len(doc), bool)
        rest[late] = False
        wins, doc, pos = wins[rest], doc[rest], pos[rest]
        order = np.lexsort((doc, wins["h2"], wins["h1"]))
        new = np.ones(len(order), bool)
        new[1:] = (wins[order[1:]] != wins[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new)
        one, lists = _listed(group, pos)
        wins, n = wins[one], len(one)
        packed = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int64) * 12), pa.py_buffer(wins)]).cast(pa.binary())
        yield _rows(np.ascontiguousarray(wins["h1"]), doc[one], lists, None, packed)

    def run(batches):
        some, many = sketch.value
        parts, held = [], 0
        for whole in batches:
            for b in C.text_parts(whole):
                h, off = C.hash_words(b.column("text"))
                least, ok = W.window_seeds(h, off, k, passage)
                if not ok.any():
                    continue
                ok &= W.in_cells(least, some)
                hot = ok & W.in_cells(least, many)
                ids = b.column("doc_id").to_numpy()
                at = np.flatnonzero(hot)
                if len(at):
                    own = C.owners(off)[at]
                    parts.append((_hashes(h, passage)[at], ids[own], (at - off[own]).astype(np.int32)))
                    held += len(at)
                    if held > S.FLUSH:
                        yield from settle(parts)
                        parts, held = [], 0
                at, windows = _suffixes(h, off, least, ok & ~hot, k, passage)
                own, seed = C.owners(off)[at], C.grams(h, k)[at].view(np.int64)
                words = _context(h, at, windows, k, reach)
                one, lists = _listed(_alike(own, seed, windows, words), at - off[own])
                yield _rows(seed[one], ids[own[one]], lists, pa.array(windows[one]), words.take(pa.array(one)))
        if parts:
            yield from settle(parts)

    return C.lean(run)


def _depths(key: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by key and words, and how many words each has in common with the one before (-1: another key)."""
    order = np.lexsort((*words.T[::-1], key))
    key, words = key[order], words[order]
    differ = np.ones((len(key), words.shape[1] + 1), bool)
    differ[1:, :-1] = words[1:] != words[:-1]
    common = differ.argmax(1)
    common[0] = -1
    common[1:][key[1:] != key[:-1]] = -1
    return order, common


def extend(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, windows: np.ndarray, words: np.ndarray, k: int, passage: int) -> list[np.ndarray]:
    """Windows that a smaller document has too: suffix, the suffix that leads there, and how many words before them the window starts.

    All suffixes of the given keys take part; words holds each one's context as `_context` gives it, one after another.
    """
    reach = passage - k
    left, right = _sides(windows, reach)
    places = np.arange(reach)
    both = np.zeros((len(key), 2 * reach), np.uint64)
    both[np.concatenate([places < left[:, None], places < right[:, None]], 1)] = words
    sides = both[:, :reach], both[:, reach:]
    live = np.arange(len(key))
    while True:  # drop suffixes whose best neighbours agree on too few words, until none is left
        sorted_by = [_depths(key[live], side[live]) for side in sides]
        best = np.zeros((2, len(live)), np.int64)
        for b, (order, common) in zip(best, sorted_by, strict=True):
            b[order] = np.maximum(common, np.append(common[1:], -1))
        stay = (best.min(0) >= 0) & (best.sum(0) >= reach)
        if stay.all():
            break
        live = live[stay]
        if not len(live):
            return [np.empty(0, np.int64)] * 3
    found = []
    for o in range(reach + 1):
        has = (windows[live] >> o) & 1 > 0
        # the class of each suffix at the depth that the window needs, to the left and to the right
        classes = []
        for depth, (order, common) in zip((o, reach - o), sorted_by, strict=True):
            c = np.empty(len(live), np.int64)
            c[order] = np.cumsum(common < depth)
            classes.append(c)
        at = live[has]
        late, lead = _leads(classes[0][has] * (len(live) + 1) + classes[1][has], doc[at], pos[at])
        found.append((at[late], at[lead], np.full(len(late), o)))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def _opened(late: np.ndarray, lead: np.ndarray, before: np.ndarray, doc: np.ndarray, places: pa.Array, passage: int) -> pa.RecordBatch:
    """Spans of all places of late rows; a lead's first place stands for it."""
    off = places.offsets.to_numpy().astype(np.int64)
    flat = places.values.to_numpy()
    n = np.diff(off)[late]
    row = np.repeat(np.arange(len(late)), n)
    pos = flat[off[late][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] - before[row]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in _spans(doc[late][row], pos, doc[lead][row], (flat[off[lead]] - before)[row], passage)], _COLUMNS)


def _matches(passage: int, k: int):
    """Spans of a document that a smaller one has too, among all rows of the same keys."""

    def joined(parts):
        t = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        places = t.column("pos")
        return t, t.column("doc_id").to_numpy(), places, places.values.to_numpy()[places.offsets.to_numpy()[:-1]], b"".join(t.column("words").to_pylist())

    def run(batches):
        for held in W.chunks(batches):
            suffixes, singles = [], []
            for b in held:
                done = np.asarray(b.column("stop").is_valid())
                if done.any():
                    given = b.filter(pa.array(done))
                    start = given.column("pos").flatten()  # one place each
                    yield pa.RecordBatch.from_arrays([given.column("doc_id"), start, *(given.column(c) for c in ("stop", "other_id", "other_start"))], _COLUMNS)
                for valid, out in ((True, suffixes), (False, singles)):
                    part = b.filter(pa.array(~done & (np.asarray(b.column("windows").is_valid()) == valid)))
                    if part.num_rows:
                        out.append(part)
            if singles:
                t, doc, places, first, words = joined(singles)
                late, lead = _late(np.frombuffer(words, S._HASHES), doc, first)
                yield _opened(late, lead, np.zeros(len(late), np.int64), doc, places, passage)
            if suffixes:
                t, doc, places, first, words = joined(suffixes)
                wins = extend(t.column("key").to_numpy(), doc, first, t.column("windows").to_numpy(), np.frombuffer(words, np.uint64), k, passage)
                yield _opened(*wins, doc, places, passage)

    return C.lean(run)


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, k: int = GRAM, hot: int = W.HOT) -> DataFrame:
    """Passages of `passage` words or more that a document shares with one of smaller doc_id: doc_id, start, stop, n_words, other_id, other_start.

    docs: doc_id, text, ... start and stop count words; other_id and other_start tell where a first part of the passage also
    stands: in the smallest doc_id, or where a seed of `hot` documents or more is grouped before the shuffle, in some smaller one.
    A document without such a passage has no row, as have empty, null and short texts. A copy of a whole document is one
    passage. Rows that share a doc_id are one document; rows without one are left out. Overlapping passages of a document are one.
    """
    if not k <= passage <= k + 62:
        raise ValueError("a passage has at least k words and at most k + 62")
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark)
    named = docs.where(docs["doc_id"].isNotNull()).select("doc_id", "text")
    whole = W.copies(docs, scratch)
    firsts = W.without(named, whole)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    cells = W.cells_for(total, 2 / (passage - k + 2))
    sketch = spark.sparkContext.broadcast(W.repeated_cells(firsts, k, passage, cells, hot))
    # equal windows have equal keys, so a partition by key holds all of them
    found = W.meet(firsts.mapInArrow(_suspects(passage, k, sketch), _SCHEMA), total).mapInArrow(_matches(passage, k), "doc_id bigint, start int, stop int, other_id bigint, other_start int")
    w = F.size(C.words(F.col("text")))
    copied = named.join(whole, "doc_id").select("doc_id", F.lit(0).alias("start"), w.alias("stop"), F.col("first_id").alias("other_id"), F.lit(0).alias("other_start")).where(F.col("stop") >= passage).distinct()
    # join overlapping spans of a document: at most as many as it has windows
    spans = found.union(copied).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop", "other_id", "other_start"))).alias("s"))

    def grow(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"), last["other_id"].alias("other_id"), last["other_start"].alias("other_start"))
        return F.when((F.size(done) > 0) & (last["stop"] >= x["start"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    kind = "array<struct<start:int,stop:int,other_id:bigint,other_start:int>>"
    merged = spans.select("doc_id", F.inline(F.aggregate("s", F.array().cast(kind), grow)))
    return merged.select("doc_id", "start", "stop", (F.col("stop") - F.col("start")).alias("n_words"), "other_id", "other_start")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`repeated_passages` over all documents: 50 words or more."""
    return repeated_passages(C.table(spark, sf_dir, "documents"))
