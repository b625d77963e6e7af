"""A robust-pruned flat graph over the vectors of one region, and range search on it."""

from __future__ import annotations

import numpy as np

#: Vectors per shard aimed at, and shards a vector joins.
SHARD, OVERLAP = 1000, 2
#: Nearest candidates and neighbours kept of them; the same of candidates from all over the shard, which
#: lead into and out of groups of copies that are larger than a list.
CANDIDATES, DEGREE, FAR_CANDIDATES, FAR_DEGREE = 64, 16, 48, 8
#: A neighbour is dropped if a kept one is nearer to it by this factor.
ALPHA = 1.2
#: Beam of the greedy phase, and how far below the threshold the range phase still walks.
BEAM, SLACK = 12, 0.05
#: Recall that an audit must find; below it the beam doubles, and after TRIES the region is scanned whole.
RECALL, TRIES, AUDIT_SHARE = 0.99, 3, 20
QUERIES, FRONTIER = 256, 4096


def pivots(ids: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows spread by a hash of their ids."""
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.argsort(mixed ^ (mixed >> np.uint64(31)), kind="stable")[:count]


def _prune(x: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Robust neighbours of every member, near ones and far ones; -1 pads."""
    own = x[members].astype(np.float32)
    m = len(members)
    out = np.full((m, DEGREE + FAR_DEGREE), -1, np.int64)
    width = min(CANDIDATES, m - 1)
    for low in range(0, m if width > 0 else 0, 256):
        rows = np.arange(low, min(m, low + 256))
        sims = own[rows] @ own.T
        sims[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        spread = (rows[:, None] * 7919 + np.arange(1, min(FAR_CANDIDATES, m - 1) + 1) * 104729) % m
        for kept, candidates, first in ((DEGREE, near, 0), (FAR_DEGREE, spread, DEGREE)):
            order = np.argsort(-np.take_along_axis(sims, candidates, 1), axis=1, kind="stable")
            candidates = np.take_along_axis(candidates, order, 1)
            away = 1 - np.take_along_axis(sims, candidates, 1)
            picked = own[candidates]
            between = 1 - picked @ picked.transpose(0, 2, 1)
            alive = np.isfinite(away)
            for k in range(kept):
                has = alive.any(1)
                if not has.any():
                    break
                pick = alive.argmax(1)  # candidates stand by distance
                out[rows[has], first + k] = members[candidates[has, pick[has]]]
                alive &= ALPHA * between[np.arange(len(rows)), pick] > away
                alive[np.arange(len(rows)), pick] = False
    return out


def build(x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adjacency (-1 pads) united over overlapping cluster shards, and a medoid of every shard."""
    n = len(x)
    centres = x[pivots(ids, max(1, -(-n * OVERLAP // SHARD) // 2))]
    joined = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, : min(OVERLAP, len(centres))]
    medoids, lists = [], []
    for shard in range(len(centres)):
        members = np.flatnonzero((joined == shard).any(1))
        if not len(members):
            continue
        mean = x[members].mean(0)
        medoids.append(members[np.argmax(x[members] @ mean)])
        near = _prune(x, members)
        at, k = np.nonzero(near >= 0)
        lists.append(np.stack([members[at], near[at, k]], 1))
    edges = np.concatenate(lists)
    keys = np.unique(np.concatenate([edges[:, 0] * n + edges[:, 1], edges[:, 1] * n + edges[:, 0]]))
    edges = np.stack([keys // n, keys % n], 1)
    # Nearest first; a hub's farthest reverse edges beyond the width are left to the audit.
    sims = np.einsum("ed,ed->e", x[edges[:, 0]], x[edges[:, 1]])
    edges = edges[np.lexsort((edges[:, 1], -sims, edges[:, 0]))]
    place = np.arange(len(edges)) - np.searchsorted(edges[:, 0], edges[:, 0])
    width = 2 * (DEGREE + FAR_DEGREE)
    graph = np.full((n, width), -1, np.int64)
    keep = place < width
    graph[edges[keep, 0], place[keep]] = edges[keep, 1]
    return graph, np.array(medoids)


def search(x: np.ndarray, graph: np.ndarray, medoids: np.ndarray, who: np.ndarray, threshold: float, beam: int):
    """Pairs (query, row) with similarity of ``threshold`` or more: greedy from medoids, then through the range."""
    q, n = len(who), len(x)
    seen = np.zeros((q, n), bool)
    hits_q, hits_n = [], []

    def look(at: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        sims = np.einsum("pd,pd->p", x[who[at]], x[nodes])
        near = sims >= threshold - SLACK
        hits_q.append(at[near])
        hits_n.append(nodes[near])
        return sims

    entry = np.argsort(-(x[who] @ x[medoids].T), axis=1, kind="stable")[:, : min(2, len(medoids))]
    ids = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf)
    done = np.zeros((q, beam), bool)
    width = min(beam, entry.shape[1])
    ids[:, :width] = medoids[entry[:, :width]]
    flat = np.repeat(np.arange(q), width)
    seen[flat, ids[:, :width].ravel()] = True
    sims[:, :width] = look(flat, ids[:, :width].ravel()).reshape(q, width)
    expanded = np.zeros((q, n), bool)
    while True:
        open_ = np.where(done | (ids < 0), -np.inf, sims)
        pick = open_.argmax(1)
        live = np.flatnonzero(open_[np.arange(q), pick] > -np.inf)
        if not len(live):
            break
        nodes = ids[live, pick[live]]
        done[live, pick[live]] = True
        expanded[live, nodes] = True
        near = graph[nodes]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        row, col = np.nonzero(fresh)
        if not len(row):
            continue
        found = near[row, col]
        seen[live[row], found] = True
        got = np.full(near.shape, -np.inf)
        got[row, col] = look(live[row], found)
        all_sims = np.concatenate([sims[live], got], 1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        sims[live] = np.take_along_axis(all_sims, top, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], 1), top, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], 1), top, 1)
    walked = 0
    while walked < len(hits_q):
        at, nodes = hits_q[walked], hits_n[walked]
        walked += 1
        todo = ~expanded[at, nodes]
        at, nodes = at[todo], nodes[todo]
        for low in range(0, len(at), FRONTIER):
            a, b = at[low : low + FRONTIER], nodes[low : low + FRONTIER]
            expanded[a, b] = True
            near = graph[b]
            row, col = np.nonzero((near >= 0) & ~seen[a[:, None], near])
            if not len(row):
                continue
            key = np.unique(a[row] * n + near[row, col])
            fresh_q, fresh_n = key // n, key % n
            seen[fresh_q, fresh_n] = True
            look(fresh_q, fresh_n)
    return np.concatenate(hits_q), np.concatenate(hits_n)


def _exact(x: np.ndarray, who: np.ndarray, threshold: float):
    return np.nonzero(x[who] @ x.T >= threshold)


def near_pairs(x: np.ndarray, ids: np.ndarray, threshold: float):
    """For blocks of queries, the rows (query, other) that may be within ``threshold``.

    Every row is a query.  The recall on every AUDIT_SHARE-th row is measured against all rows
    first; where it stays below RECALL with wider beams, all rows are compared block by block.
    """
    n = len(x)
    graph, medoids = build(x, ids)
    audit = pivots(ids, max(1, n // AUDIT_SHARE))
    beam, recall = BEAM, 0.0
    for _ in range(TRIES):
        found = total = 0
        for low in range(0, len(audit), QUERIES):
            who = audit[low : low + QUERIES]
            true = set(zip(*(a.tolist() for a in _exact(x, who, threshold)), strict=True))
            got = set(zip(*(a.tolist() for a in search(x, graph, medoids, who, threshold, beam)), strict=True))
            found, total = found + len(true & got), total + len(true)
        recall = found / max(total, 1)
        if recall >= RECALL:
            break
        beam *= 2
    for low in range(0, n, QUERIES):
        who = np.arange(low, min(n, low + QUERIES))
        a, b = search(x, graph, medoids, who, threshold, beam) if recall >= RECALL else _exact(x, who, threshold - 1e-9)
        yield who[a], b
