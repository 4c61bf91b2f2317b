"""Hierarchical navigable small-world graphs in flat numpy arrays.

Nodes are ordered by level, so that level l is the prefix of the first
``sizes[l]`` nodes, and its links are one int32 array (nodes x width, -1 where
empty). Levels are built from the top down by insertion: a round of new nodes
looks for its neighbours in the graph of the nodes before it, by the same beam
search that answers queries; both ends note each other, and neighbours of
neighbours are compared once, which joins nodes of one round. A node links to
those of its candidates that are nearer to it than to a candidate already
kept, and links run both ways. Nothing compares all nodes with all.

Searches run for many queries at once: a beam of the best nodes is widened
along the links until it no longer improves, level by level, each giving the
entry points of the next. Similarity is the dot product of unit vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Links of a node unless told otherwise, candidates they are chosen from, beam of an insertion.
WIDTH, CANDIDATES, INSERT_BEAM = 24, 24, 32
#: One node in so many reaches the next level.
LEVEL_SHARE = 16
#: Nodes that are compared as a whole: the first of a level, and a top level up to this size.
SMALL = 64
#: Beam of the upper levels, or that of the ground level if it is smaller; half of its nodes are where the next level starts.
UPPER_BEAM = 48
#: Candidates whose own candidates are compared.
HOP = 10


@dataclass
class Graph:
    """``order`` has the caller's number of each node; ``sizes`` and ``links`` start with the ground level; ``near`` are each node's candidates, best first, as packed entries."""

    vectors: np.ndarray
    order: np.ndarray
    sizes: list[int]
    links: list[np.ndarray]
    near: np.ndarray


#: An entry is one integer that sorts by similarity: distance steps, then the node, then whether it was widened.
_STEPS = float(1 << 29)
_NONE = np.int64(1) << 62
_LOW = np.int64(0xFFFFFFFF)


def _pack(sims: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return (np.maximum((1 - sims.astype(np.float64)) * _STEPS, 0).astype(np.int64) << 32) | (nodes.astype(np.int64) << 1)


def _nodes(keys: np.ndarray) -> np.ndarray:
    """Nodes of packed entries, -1 where there is none."""
    return np.where(keys < _NONE, (keys & _LOW) >> 1, -1).astype(np.int32)


def _sims(keys: np.ndarray) -> np.ndarray:
    return np.where(keys < _NONE, 1 - (keys >> 32) / _STEPS, -2).astype(np.float32)


def _dots(x: np.ndarray, nodes: np.ndarray, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x[nodes], q[rows])


def _diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int, block: int = 1024) -> np.ndarray:
    """Of each node's candidates, best first, those that are nearer to it than to any candidate kept before; filled up with the best others."""
    n, k = ids.shape
    out = np.full((n, width), -1, np.int32)
    for lo in range(0, n, block):
        c, s = ids[lo : lo + block], sims[lo : lo + block]
        v = x[np.maximum(c, 0)]
        among = np.matmul(v, v.transpose(0, 2, 1))
        kept = np.zeros(c.shape, bool)
        closest = np.full(c.shape, -2, np.float32)
        for j in range(k):
            keep = (closest[:, j] < s[:, j]) & (c[:, j] >= 0)
            kept[:, j] = keep
            np.maximum(closest, np.where(keep[:, None], among[:, :, j], -2), out=closest)
        rank = np.where(kept, 0, k) + np.arange(k)
        rank[c < 0] = 3 * k
        order = np.argsort(rank, axis=1)[:, :width]
        chosen = np.take_along_axis(c, order, 1)
        out[lo : lo + block, : chosen.shape[1]] = chosen
    return out


def _both_ways(links: np.ndarray, width: int) -> np.ndarray:
    """Own links first, then links from others, up to ``width`` in all."""
    n, w = links.shape
    src = np.repeat(np.arange(n, dtype=np.int32), w)
    dst = links.ravel()
    ok = dst >= 0
    a = np.concatenate([src[ok], dst[ok]])
    b = np.concatenate([dst[ok], src[ok]])
    tier = np.concatenate([np.tile(np.arange(w), n)[ok], w + np.tile(np.arange(w), n)[ok]])
    order = np.lexsort((tier, a))
    a, b = a[order], b[order]
    first = np.searchsorted(a, np.arange(n))
    slot = np.arange(len(a)) - first[a]
    out = np.full((n, width), -1, np.int32)
    keep = slot < width
    out[a[keep], slot[keep]] = b[keep]
    return out


def _link(x: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
    return _both_ways(_diverse(x, _nodes(near), _sims(near), width // 2), width)


def _note(near: np.ndarray, rows: np.ndarray, keys: np.ndarray) -> None:
    """Puts each entry into the sorted candidates of its row, if it is among the best there."""
    good = keys < near[rows, -1]
    rows, keys = rows[good], keys[good]
    if not len(rows):
        return
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    hit, start, count = np.unique(rows, return_index=True, return_counts=True)
    slot = np.arange(len(rows)) - np.repeat(start, count)
    some = slot < near.shape[1]  # more than that can't be among the best
    both = np.full((len(hit), near.shape[1] + min(int(count.max()), near.shape[1])), _NONE, np.int64)
    both[:, : near.shape[1]] = near[hit]
    both[np.repeat(np.arange(len(hit)), count)[some], near.shape[1] + slot[some]] = keys[some]
    both.sort(axis=1)
    near[hit] = both[:, : near.shape[1]]


def _hop(x: np.ndarray, near: np.ndarray, lo: int, hi: int, block: int = 256) -> None:
    """Compares nodes lo..hi with the best candidates of their best candidates."""
    ids = _nodes(near[:, :HOP])
    for s in range(lo, hi, block):
        rows = np.arange(s, min(hi, s + block))
        mid = ids[rows]
        far = np.where(mid[:, :, None] >= 0, ids[mid], -1).reshape(len(rows), -1)
        far[far == rows[:, None]] = -1
        far.sort(axis=1)
        far[:, 1:][far[:, 1:] == far[:, :-1]] = -1
        r, c = np.nonzero(far >= 0)
        keys = _pack(_dots(x, far[r, c], x, rows[r]), far[r, c])
        good = keys < near[rows[r], -1] + (_NONE >> 20)  # a known neighbour may be off by a rounding error
        both = np.full((len(rows), near.shape[1] + far.shape[1]), _NONE, np.int64)
        both[:, : near.shape[1]] = near[rows]
        both[r[good], near.shape[1] + c[good]] = keys[good]
        # of an entry that stands twice the better one stays
        node = (both & _LOW) | np.where(both < _NONE, 0, np.int64(1) << 33)
        order = np.argsort(node, axis=1, kind="stable")
        both = np.take_along_axis(both, order, 1)
        node = np.take_along_axis(node, order, 1)
        both[:, 1:][(node[:, 1:] == node[:, :-1]) & (both[:, 1:] < _NONE)] = _NONE
        both.sort(axis=1)
        near[rows] = both[:, : near.shape[1]]


def build(x: np.ndarray, draw: np.ndarray, beam: int = INSERT_BEAM, width: int = WIDTH) -> Graph:
    """The graph of unit vectors; ``draw`` holds a uniform number for each that sets its level and its turn."""
    n = len(x)
    order = np.argsort(draw, kind="stable")
    x = np.ascontiguousarray(x[order])
    sizes = [n]
    while sizes[-1] > SMALL:
        sizes.append(max(1, int(np.searchsorted(draw[order], 1.0 / LEVEL_SHARE ** len(sizes)))))
        if sizes[-1] >= sizes[-2]:
            sizes[-1] = max(1, sizes[-2] // LEVEL_SHARE)
    g = Graph(x, order.astype(np.int64), sizes, [np.zeros((0, width), np.int32)] * len(sizes), np.zeros((0, CANDIDATES), np.int64))
    for level in range(len(sizes) - 1, -1, -1):
        size = sizes[level]
        near = np.full((size, CANDIDATES), _NONE, np.int64)
        a = min(size, SMALL)
        rows, cols = np.nonzero(~np.eye(a, dtype=bool))
        _note(near, rows, _pack((x[:a] @ x[:a].T)[rows, cols], cols))
        while a < size:
            b = min(size, a + max(SMALL, a // 2))
            g.links[level] = _link(x, near[:a], width)
            for lo in range(a, b, 256):
                rows = np.arange(lo, min(b, lo + 256))
                found = _descend(g, x[rows], beam, level, a)[:, :CANDIDATES]
                near[rows, : found.shape[1]] = found & ~np.int64(1)
            own = near[a:b]
            r, c = np.nonzero(own < _NONE)
            _note(near, _nodes(own[r, c]), (own[r, c] & ~_LOW) | ((a + r) << 1))
            _hop(x, near[:b], a, b)
            a = b
        if size > SMALL:
            _hop(x, near, 0, size)
        g.links[level] = _link(x, near, width)
    g.near = near
    return g


def search(g: Graph, q: np.ndarray, k: int, beam: int = 48, own: np.ndarray | None = None, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """The k best nodes found for every query, best first: (the caller's numbers, sims); -1 and -2 where there are fewer.

    ``own`` gives the graph's node of each query, where queries are nodes: the
    search then starts there.
    """
    ids, sims = np.full((len(q), k), -1, np.int64), np.full((len(q), k), -2, np.float32)
    if not len(g.vectors):
        return ids, sims
    beam = max(beam, k)
    for lo in range(0, len(q), block):
        part = q[lo : lo + block]
        if own is None:
            keys = _descend(g, part, beam)
        else:
            at = own[lo : lo + block]
            first = np.concatenate([_pack(np.ones((len(at), 1)), at[:, None]), g.near[at, : beam - 1]], axis=1)
            keys = _beam(g.vectors, g.links[0], part, beam, first)
        keys = keys[:, :k]
        node = _nodes(keys)
        ids[lo : lo + block, : keys.shape[1]] = np.where(node >= 0, g.order[node], -1)
        sims[lo : lo + block, : keys.shape[1]] = _sims(keys)
    return ids, sims


def _descend(g: Graph, q: np.ndarray, beam: int, ground: int = 0, among: int | None = None) -> np.ndarray:
    """Sorted beams of packed entries at level ``ground``, of whose nodes the first ``among`` are linked yet."""
    top = len(g.sizes) - 1
    upper = min(UPPER_BEAM, beam)
    n = g.sizes[top] if top > ground or among is None else among
    n = min(n, SMALL)
    keys = np.sort(_pack(q @ g.vectors[:n].T, np.broadcast_to(np.arange(n), (len(q), n))), axis=1)
    for level in range(top - 1 if top > ground else ground, ground - 1, -1):
        last = level == ground
        first = keys[:, : upper // 2] & ~np.int64(1)
        if last and among is not None and among < g.sizes[min(level + 1, top)]:
            first = np.where((first < _NONE) & (((first & _LOW) >> 1) < among), first, _NONE | 1)
            lost = (first >= _NONE).all(axis=1)
            if lost.any():
                first[lost, 0] = _pack(q[lost] @ g.vectors[0], np.zeros(int(lost.sum()), np.int64))
            first.sort(axis=1)
        keys = _beam(g.vectors, g.links[level], q, beam if last else upper, first)
    return keys[:, :beam]


def _beam(x: np.ndarray, graph: np.ndarray, q: np.ndarray, beam: int, first: np.ndarray, spread: int = 8) -> np.ndarray:
    """Sorted beams (queries x beam) of packed entries, grown from the entries ``first`` along the links."""
    n, m = len(q), len(graph)
    links = np.where(graph < 0, m, graph)
    beams = np.full((n, beam), _NONE | 1, np.int64)
    width = min(beam, first.shape[1])
    beams[:, :width] = np.where(first[:, :width] < _NONE, first[:, :width], _NONE | 1)
    stride = m + 1  # the last column stands for "no node"
    seen = np.zeros(n * stride, np.uint16)
    seen[np.arange(n) * stride + m] = 1
    r, c = np.nonzero(beams < _NONE)
    seen[r * stride + ((beams[r, c] & _LOW) >> 1)] = 1
    live = np.arange(n)
    while len(live):
        own = beams[live]
        fresh = (own & 1) == 0
        # the best entries of the beam that haven't been widened
        now = fresh & (np.cumsum(fresh, axis=1) <= spread)
        own |= now
        beams[live] = own
        r, c = np.nonzero(now)
        near = links[(own[r, c] & _LOW) >> 1]
        at = (live[r, None] * stride + near).ravel()
        at = at[seen[at] == 0]
        # of a node reached twice in this round one ticket stays
        for lo in range(0, len(at), 60_000):
            part = at[lo : lo + 60_000]
            if lo:
                at[lo : lo + 60_000] = part = np.where(seen[part] == 0, part, m)
            ticket = np.arange(1, len(part) + 1, dtype=np.uint16)
            seen[part] = ticket
            at[lo : lo + 60_000] = np.where((seen[part] == ticket) & (part != m), part, -1)
        at = at[at >= 0]
        row, node = at // stride, at % stride
        key = _pack(_dots(x, node, q, row), node)
        good = key < beams[row, -1]
        row, key = row[good], key[good]
        if len(row):
            # rows are in order, as the entries of the beam were
            count = np.bincount(row, minlength=n)
            hit = np.flatnonzero(count)
            start = np.cumsum(count) - count
            both = np.full((len(hit), beam + int(count.max())), _NONE | 1, np.int64)
            both[:, :beam] = beams[hit]
            place = np.cumsum(count > 0) - 1
            both[place[row], beam + np.arange(len(row)) - start[row]] = key
            both.sort(axis=1)
            beams[hit] = both[:, :beam]
        live = live[((beams[live] & 1) == 0).any(1)]
    return beams
