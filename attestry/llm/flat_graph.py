"""A flat proximity graph over one bounded shard of unit vectors: built, pruned and searched in a task."""

from __future__ import annotations

import numpy as np

NEAREST, DEGREE, FAR, ALPHA, BEAM, CHUNK = 48, 12, 4, 1.2, 24, 256


def pruned_neighbours(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a robust-pruned graph, with their reverses.

    A node keeps at most ``DEGREE`` of its nearest candidates, each time dropping those that are
    ``ALPHA`` times nearer to a kept one than to the node, and ``FAR`` random nodes as long edges.
    """
    n = len(vectors)
    rng = np.random.default_rng(seed)
    sources, targets = [], []
    for start in range(0, n, CHUNK):
        rows = np.arange(start, min(n, start + CHUNK))
        near = vectors[rows] @ vectors.T
        near[np.arange(len(rows)), rows] = -np.inf
        count = min(NEAREST, n - 1)
        if count <= 0:
            break
        picked = np.argpartition(-near, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(near, picked, axis=1), axis=1, kind="stable")
        picked = np.take_along_axis(picked, order, axis=1)
        for row, candidates in zip(rows, picked):
            apart = 1 - vectors[candidates] @ vectors[candidates].T
            own = 1 - near[row - start, candidates]
            alive, kept = np.ones(len(candidates), dtype=bool), []
            while alive.any() and len(kept) < DEGREE:
                best = int(alive.argmax())
                kept.append(candidates[best])
                alive &= ALPHA * apart[best] > own
                alive[best] = False
            kept = np.append(kept, rng.integers(0, n, FAR)).astype(np.int64)
            kept = kept[kept != row]
            sources.append(np.full(len(kept), row))
            targets.append(kept)
    if not sources:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(sources), np.concatenate(targets)
    codes = np.unique(np.concatenate([a * n + b, b * n + a]))
    return codes // n, codes % n


def _expand(rows: np.ndarray, nodes: np.ndarray, bounds: np.ndarray, targets: np.ndarray):
    """The neighbours of every (row, node)."""
    degree = bounds[nodes + 1] - bounds[nodes]
    first = np.repeat(bounds[nodes] - (np.cumsum(degree) - degree), degree)
    return np.repeat(rows, degree), targets[first + np.arange(len(first))]


def range_search(
    vectors: np.ndarray, bounds: np.ndarray, targets: np.ndarray, queries: np.ndarray,
    own: np.ndarray, least: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) with cosine of at least ``least`` that the graph search reaches.

    A beam walks greedily from the medoid (and from the query's own node, ``own`` >= 0, if it is
    indexed) to the nearest nodes; from every node in range the search goes on through all its
    neighbours until no new one is in range. Cosines are in double precision.
    """
    n = len(vectors)
    medoid = int((vectors @ vectors.sum(axis=0)).argmax())
    found_query, found_node = [], []
    for start in range(0, len(queries), CHUNK):
        rows = np.arange(start, min(len(queries), start + CHUNK))
        local = np.arange(len(rows))
        seen = np.full((len(rows), n), -np.inf)
        expanded = np.zeros((len(rows), n), dtype=bool)

        def visit(at: np.ndarray, nodes: np.ndarray) -> None:
            fresh = np.unique((at * n + nodes)[np.isneginf(seen[at, nodes])])
            at, nodes = fresh // n, fresh % n
            seen[at, nodes] = np.einsum("ij,ij->i", queries[rows[at]], vectors[nodes])

        visit(local, np.full(len(rows), medoid))
        indexed = own[rows] >= 0
        visit(local[indexed], own[rows][indexed])
        width = min(BEAM, n)
        while True:
            limit = np.partition(seen, n - width, axis=1)[:, n - width]
            open_ = np.where(expanded, -np.inf, seen)
            best = open_.argmax(axis=1)
            going = local[(open_[local, best] >= limit) & (open_[local, best] > -np.inf)]
            if not len(going):
                break
            expanded[going, best[going]] = True
            visit(*_expand(going, best[going], bounds, targets))
        done = np.zeros_like(expanded)
        while True:
            at, nodes = np.nonzero((seen >= least) & ~done)
            if not len(at):
                break
            done[at, nodes] = True
            visit(*_expand(at, nodes, bounds, targets))
        at, nodes = np.nonzero(done)
        found_query.append(rows[at])
        found_node.append(nodes)
    if not found_query:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_query), np.concatenate(found_node)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of every node's component under the pairs (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new
