"""The lattice of vocabulary pieces over short units of text, vectorised over many units at once.

A unit is a run of text that no piece crosses: a word with the space before it. Spaces stand for the vocabulary's word mark;
a character that is no piece falls back to its bytes, and no piece holds it. Forward sums are kept in linear scale: each
character has a fixed factor, one that falls back such that its only edge weighs 1, and units whose sums leave the range from TINY
to HUGE all the same are brought back to 1, at every BLOCK characters. As no piece weighs less than LEAST, nothing under- or overflows. Units of
more than LONG characters are summed by themselves, one character at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from . import common as C

C.by_value(__name__)

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Scale per character of forward sums, and after how many characters they are looked at.
LIFT, BLOCK, TINY, HUGE = np.exp(3.0), 8, 1e-60, 1e60
#: The least weight of a piece in sums; units longer than this are summed alone.
LEAST, LONG = 1e-12, 256
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    pieces: list[str]  # with spaces for word marks; empty for control and byte pieces
    byte_base: int  # the id of byte 0
    ranks: np.ndarray  # of normal pieces, best first; the number of pieces for others
    longest: int
    hashes: np.ndarray
    table: np.ndarray  # [ways, slots]: the pieces of a slot, then none
    shift: int


def plain(v: Vocabulary) -> tuple:
    """The vocabulary as built-in types and arrays, for executors that don't have this package: Vocabulary(*plain(v)) is v."""
    return v.pieces, v.byte_base, v.ranks, v.longest, v.hashes, v.table, v.shift


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a SentencePiece model with byte fallback, on the driver; what the executors need is sent to them."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)]
    byte_base = next(i for i in range(n) if sp.is_byte(i))
    pieces = [sp.id_to_piece(i).replace("▁", " ") if normal[i] else "" for i in range(n)]
    pieces = [p if p.strip(" ").count(" ") == 0 else "" for p in pieces]  # a piece that crosses words has no place here
    lone = {p for p in pieces if len(p) == 1}
    pieces = [p if all(c in lone for c in p) else "" for p in pieces]  # nor one with characters that are no pieces
    order = sorted((i for i in range(n) if pieces[i]), key=lambda i: (-sp.get_score(i), i))
    ranks = np.full(n, n, np.int64)
    ranks[order] = np.arange(len(order))
    ids = np.array(order)
    hashes = np.zeros(n + 1, np.uint64)
    for i in ids:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in pieces[i]:
                h = h * BASE + np.uint64(ord(c) + 1)
        hashes[i] = h
    bits = max(8, int(np.ceil(np.log2(16 * max(1, len(ids))))))
    slot = _slot(hashes[ids], 64 - bits)
    by_slot = np.argsort(slot, kind="stable")
    slot, ids = slot[by_slot], ids[by_slot]
    way = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
    table = np.full((int(way.max(initial=0)) + 1, 1 << bits), n, np.int32)
    table[way, slot] = ids
    return Vocabulary(pieces, byte_base, ranks, max(map(len, pieces)), hashes, table, 64 - bits)


def _slot(h: np.ndarray, shift: int) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype(np.int64)


def zipf(v: Vocabulary, theta: float = 1.0) -> np.ndarray:
    """Piece probabilities from the vocabulary's own order, 1 / (rank + 10) to the power theta; bytes share what one rare piece has."""
    p = np.where(v.ranks < len(v.ranks), 1.0 / (v.ranks + 10.0) ** theta, 0.0)
    return with_fallback(p / p.sum())


def with_fallback(p: np.ndarray, byte: float = 1e-5) -> np.ndarray:
    """Piece probabilities (any leading axes), then 0 for no piece and those of one to four bytes."""
    tail = np.array([0.0, byte, byte**2 * 10, byte**3 * 100, byte**4 * 1000])
    return np.concatenate([p, np.broadcast_to(tail, (*p.shape[:-1], 5))], -1)


@dataclass
class Lattice:
    n_units: int
    length: np.ndarray  # of each unit, longest first
    where: np.ndarray  # place of each given unit in that order
    cp: np.ndarray
    first: np.ndarray  # the first character of each unit
    ids: np.ndarray  # [longest, characters]: the piece that starts there and has this length, or none


def build(units: list[str], v: Vocabulary) -> Lattice:
    n, none = np.array(list(map(len, units)), np.int64), len(v.pieces)
    order = np.argsort(-n, kind="stable")
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    length = n[order]
    cp = np.frombuffer("".join([units[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    first = np.cumsum(length) - length
    left = np.repeat(first + length, length) - np.arange(len(cp))  # characters to the unit's end
    most = int(min(v.longest, length[0] if len(length) else 0))
    ids = np.full((max(most, 1), len(cp)), none, np.int32)
    h = np.zeros(len(cp), np.uint64)
    alive = np.arange(len(cp))
    for k in range(most):
        alive = alive[left[alive] > k]
        h = h[: len(alive)] if k == 0 else h
        if k:
            h = h_all[alive]
        now = h * BASE + (cp[alive + k] + 1).astype(np.uint64)
        slot = _slot(now, v.shift)
        found = v.table[0][slot]
        bad = np.flatnonzero((found != none) & (v.hashes[found] != now))
        for way in v.table[1:]:
            if len(bad):
                found[bad] = way[slot[bad]]
                bad = bad[(found[bad] != none) & (v.hashes[found[bad]] != now[bad])]
        found[bad] = none
        ids[k, alive] = found
        h_all = np.zeros(len(cp), np.uint64) if k == 0 else h_all
        h_all[alive] = now
    if len(cp):
        lone = ids[0] == none
        c = cp[lone]
        ids[0, lone] = none + 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    return Lattice(len(units), length, where, cp, first, ids)


def node_of(lat: Lattice) -> np.ndarray:
    """The first node of each unit; a unit of n characters has n + 1."""
    return lat.first + np.arange(lat.n_units)


def scaled(p: np.ndarray) -> np.ndarray:
    """Weights for sums: no piece below LEAST, and a fallback's times the scale of its character is 1."""
    out = np.maximum(p, LEAST)
    out[..., -5] = 0
    out[..., -4:] = 1 / LIFT
    return out


def fallback_logs(lat: Lattice, p: np.ndarray) -> np.ndarray:
    """What `scaled` leaves out of each unit's log sum, for each row of p."""
    none = p.shape[1] - 5
    at = np.flatnonzero(lat.ids[0] > none) if len(lat.cp) else np.empty(0, np.int64)
    if not len(at):
        return np.zeros((len(p), lat.n_units))
    unit = np.repeat(np.arange(lat.n_units), lat.length)[at]
    n = np.stack([np.bincount(unit[lat.ids[0, at] == none + k], minlength=lat.n_units) for k in range(1, 5)])
    return (np.log(p[:, -4:]) + np.log(LIFT)) @ n


def edges_of(lat: Lattice, u: int, none: int) -> list[list[tuple[int, int]]]:
    """For each character of a unit the (length, piece) of what starts there."""
    part = lat.ids[:, lat.first[u] : lat.first[u] + lat.length[u]]
    c, k = np.nonzero(part.T != none)
    out = [[] for _ in range(int(lat.length[u]))]
    for i, n, piece in zip(c.tolist(), (k + 1).tolist(), part[k, c].tolist(), strict=True):
        out[i].append((n, piece))
    return out


def _forward_long(edges: list, p: np.ndarray, most: int) -> tuple[list[float], list[float], float]:
    """Forward sums of one unit under one row of weights, the log of each node's scale, the log of the last one."""
    n, p, lift = len(edges), p.tolist(), [float(LIFT**k) for k in range(most + 1)]
    a, logs, log = [0.0] * (n + 1), [0.0] * (n + 1), 0.0
    a[0] = 1.0
    for t, out in enumerate(edges):
        if t % BLOCK == 0 and not TINY < a[t] < HUGE:
            top, first, stop = max(a[t : t + most + 1]), max(0, t - most), min(n, t + most) + 1
            log += float(np.log(top))
            a[first:stop] = [x / top for x in a[first:stop]]
            logs[first : t + 1] = [log] * (t + 1 - first)
        x = a[t]
        for k, piece in out:
            a[t + k] += x * (p[piece] * lift[k])
        logs[t + 1] = log
    return a, logs, log


def forward(lat: Lattice, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Sums over all segmentations up to each node, for each row of p [m, pieces + 5], and the log of each unit's sum.

    Values are scaled by LIFT a character and, where they get small, by what brings the largest that is still to be used back to 1.
    The logs of these last scales, by node for the first row of p, come third (None if there were none).
    """
    m, base, none, most = len(p), node_of(lat), p.shape[1] - 5, len(lat.ids)
    w = scaled(p)
    alpha = np.zeros((m, len(lat.cp) + lat.n_units))
    alpha[:, base] = 1
    logs, shift = np.zeros((m, lat.n_units)), None
    lift = LIFT ** np.arange(1, most + 1)
    longer = int(np.searchsorted(-lat.length, -LONG, "left"))
    for u in range(longer):
        edges = edges_of(lat, u, none)
        shift = np.zeros(alpha.shape[1]) if shift is None else shift
        own = slice(base[u], base[u] + lat.length[u] + 1)
        for i in range(m):
            alpha[i, own], scale, logs[i, u] = _forward_long(edges, w[i], most)
            if i == 0:
                shift[own] = scale
    alive = lat.n_units
    for t in range(int(lat.length[longer]) if lat.n_units > longer else 0):
        while lat.length[alive - 1] <= t:
            alive -= 1
        at, node = lat.first[longer:alive] + t, base[longer:alive] + t
        if t and t % BLOCK == 0:
            small = longer + np.flatnonzero(((alpha[:, node] < TINY) | (alpha[:, node] > HUGE)).any(0))
            if len(small):
                shift = np.zeros(alpha.shape[1]) if shift is None else shift
                first, stop = max(0, t - most), lat.length[small, None]
                near = base[small, None] + np.minimum(np.arange(first, t + most + 1)[None], stop)
                top = alpha[:, near[:, t - first :]].max(2)
                alpha[:, near] /= top[:, :, None]  # a node that stands twice gets the same value twice
                logs[:, small] += np.log(top)
                shift[near[:, : t + 1 - first]] = logs[0, small, None]
            if shift is not None:
                moved = longer + np.flatnonzero(logs[0, longer:alive])
                shift[base[moved, None] + np.minimum(np.arange(t + 1, t + BLOCK + 1)[None], lat.length[moved, None])] = logs[0, moved, None]
        for k in range(most):
            cut = int(np.searchsorted(-lat.length[longer:alive], -(t + k + 1), "right"))
            if not cut:
                break
            ids = lat.ids[k, at[:cut]]
            hit = np.flatnonzero(ids != none)
            if len(hit):
                alpha[:, node[hit] + k + 1] += alpha[:, node[hit]] * (w[:, ids[hit]] * lift[k])
    end = alpha[:, base + lat.length]
    return alpha, np.log(end) + logs - np.log(LIFT) * lat.length + fallback_logs(lat, p), shift


def _backward_long(edges: list, p: np.ndarray, most: int, a: list[float], logs: list[float], weight: float, out: np.ndarray) -> None:
    n, p, lift = len(edges), p.tolist(), [float(LIFT**k) for k in range(most + 1)]
    b = [0.0] * (n + 1)
    b[n] = weight / a[n]
    for t in range(n - 1, -1, -1):
        total = 0.0
        for k, piece in edges[t]:
            flow = p[piece] * lift[k] * b[t + k]
            if logs[t] != logs[t + k]:
                flow *= float(np.exp(logs[t] - logs[t + k]))
            total += flow
            out[piece] += a[t] * flow
        b[t] = total


def expected(lat: Lattice, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (and of the fallbacks) under p [pieces + 5], units weighed; forward-backward over whole units.

    Backward sums take the scales of the forward ones, so that their product at a node is that node's share of the unit.
    """
    alpha, _, shift = forward(lat, p[None])
    alpha, base, none, most = alpha[0], node_of(lat), len(p) - 5, len(lat.ids)
    w = scaled(p)
    beta = np.zeros_like(alpha)
    ends = base + lat.length
    beta[ends] = weight / alpha[ends]
    lift = LIFT ** np.arange(1, most + 1)
    out = np.zeros(len(p))
    longer = int(np.searchsorted(-lat.length, -LONG, "left"))
    for u in range(longer):
        own = slice(base[u], ends[u] + 1)
        _backward_long(edges_of(lat, u, none), w, most, alpha[own].tolist(), shift[own].tolist(), float(weight[u]), out)
    alive = longer
    for t in range((int(lat.length[longer]) if lat.n_units > longer else 0) - 1, -1, -1):
        while alive < lat.n_units and lat.length[alive] > t:
            alive += 1
        at, node = lat.first[longer:alive] + t, base[longer:alive] + t
        for k in range(most):
            cut = int(np.searchsorted(-lat.length[longer:alive], -(t + k + 1), "right"))
            if not cut:
                break
            ids = lat.ids[k, at[:cut]]
            hit = np.flatnonzero(ids != none)
            if len(hit):
                start, end = node[hit], node[hit] + k + 1
                flow = w[ids[hit]] * lift[k] * beta[end]
                if shift is not None:
                    flow *= np.exp(shift[start] - shift[end])
                beta[start] += flow
                out += np.bincount(ids[hit], alpha[start] * flow, len(p))
    return out


def sample(lat: Lattice, alpha: np.ndarray, shift: np.ndarray | None, p: np.ndarray, unit: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backward sampling: for each occurrence of a unit a segmentation drawn from the lattice's distribution.

    stream: a 64-bit key for each occurrence; draws depend on it and on the step only. Thresholds are whole numbers, so the
    result doesn't depend on which units share a call. Returns piece ids (-1 - code point for a fallback), each occurrence's
    pieces in order, and how many there are for each.
    """
    base, none = node_of(lat), len(p) - 5
    k_at, c_at = np.nonzero(lat.ids != none)
    unit_of = np.repeat(np.arange(lat.n_units), lat.length)
    start = c_at + unit_of[c_at]
    end = start + k_at + 1
    w = alpha[start] * scaled(p)[lat.ids[k_at, c_at]] * LIFT ** (k_at + 1.0)
    if shift is not None:
        w *= np.exp(shift[start] - shift[end])
    order = np.argsort(end, kind="stable")  # edges come in order of their length
    start, end, w, piece = start[order], end[order], w[order], lat.ids[k_at, c_at][order].astype(np.int64)
    piece = np.where(piece > none, -1 - lat.cp[c_at[order]], piece)
    head = np.ones(len(end), bool)
    head[1:] = end[1:] != end[:-1]
    heads = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    # sums within each node, term by term, so that they don't depend on other nodes
    within = w.copy()
    sizes = np.diff(np.append(heads, len(w)))
    for j in range(1, int(sizes.max(initial=0))):
        i = heads[sizes > j] + j
        within[i] += within[i - 1]
    last = np.concatenate([heads[1:], [len(w)]]) - 1 if len(heads) else heads
    total = within[last][group] if len(heads) else within
    limit = np.minimum(np.floor(within / total * 2.0**32), 2.0**32 - 1).astype(np.int64)
    limit[last] = 2**32 - 1
    key = (end.astype(np.int64) << 32) | limit
    place_of = lat.where[unit]
    first, node = base[place_of], base[place_of] + lat.length[place_of]
    live = np.flatnonzero(node > first)
    steps, count = [], np.zeros(len(unit), np.int64)
    while len(live):
        u = C.mix(stream[live] + count[live].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)
        edge = np.searchsorted(key, (node[live] << 32) | u.astype(np.int64), "left")
        steps.append((live, piece[edge]))
        node[live] = start[edge]
        count[live] += 1
        live = live[node[live] > first[live]]
    stop = np.cumsum(count)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.int64)
    for s, (who, what) in enumerate(steps):
        out[stop[who] - 1 - s] = what
    return out, count, stop
