"""A navigable small-world graph over unit vectors, in numpy batches.

Points enter in batches: a batch searches the graph, its points are linked to
diverse neighbours among what they found and among each other, and links back
are pruned by the same rule. Searches run all queries of a batch in lockstep,
each with a beam of its own.
"""

from __future__ import annotations

import io
from typing import Dict, List, Optional, Tuple

import numpy as np

LINKS, LINKS_ABOVE = 24, 12
ROOM = 8  # a link list may overflow by this much before it is pruned
BUILD_BEAM = 48
EXPAND = 4
DESCENT = 2
BATCH = 256
CELLS = 1 << 21  # numbers of one temporary array
PEERS = 8
LEVEL_SCALE = 1 / np.log(16)


#: A place of a beam that holds nothing; it counts as expanded.
NONE = np.int64(-(2**63) + 1)


def _keys(sims: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One number per candidate: its similarity, as bits that sort alike, then
    its id, then (the last bit) whether it was expanded."""
    bits = sims.view(np.int32)
    bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))
    return (bits.astype(np.int64) << 32) | (ids.astype(np.int64) << 1)


def _unkeyed(keys: np.ndarray) -> Tuple[np.ndarray, np.ndarray]:
    """(ids, sims); -1 and -inf for places that hold nothing."""
    bits = (keys >> 32).astype(np.int32)
    sims = (bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))).view(np.float32)
    none = keys == NONE
    ids = ((keys & np.int64(0xFFFFFFFF)) >> 1).astype(np.int32)
    return np.where(none, np.int32(-1), ids), np.where(none, np.float32(-np.inf), sims)


def diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, n: int) -> np.ndarray:
    """Per row at most n of the candidates (-1: none): nearest first, each only
    if it is nearer to the row's point than to any chosen one; what room is
    left goes to the nearest others."""
    step = max(1, CELLS // (ids.shape[1] * max(1, ids.shape[1], vectors.shape[1])))
    if len(ids) > step:
        return np.concatenate([diverse(vectors, ids[lo : lo + step], sims[lo : lo + step], n) for lo in range(0, len(ids), step)])
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    valid = np.isfinite(sims)
    v = vectors[np.maximum(ids, 0)]
    between = np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, dtype=bool)
    for j in range(ids.shape[1]):
        worst = np.where(chosen[:, :j], between[:, j, :j], -np.inf).max(axis=1, initial=-np.inf)
        chosen[:, j] = valid[:, j] & (worst < sims[:, j]) & (chosen[:, :j].sum(axis=1) < n)
    place = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    first = np.argsort(place, axis=1)[:, :n]
    out = np.take_along_axis(ids, first, axis=1)
    return np.where(np.take_along_axis(valid, first, axis=1), out, -1)


class Graph:
    def __init__(self, dim: int, capacity: int):
        self.vectors = np.zeros((capacity, dim), dtype=np.float32)
        self.n = 0
        self.layers: List[np.ndarray] = []
        self.entry = -1
        self.more: Dict[str, np.ndarray] = {}

    def _layer(self, level: int) -> np.ndarray:
        while len(self.layers) <= level:
            width = (LINKS if not self.layers else LINKS_ABOVE) + ROOM
            self.layers.append(np.full((len(self.vectors), width), -1, dtype=np.int32))
        return self.layers[level]

    def _dots(self, q: np.ndarray, counts: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Products of each query with its ``counts`` nodes, CELLS numbers at a time."""
        row = np.repeat(np.arange(len(q)), counts)
        out = np.empty(len(nodes), dtype=np.float32)
        step = max(1, CELLS // q.shape[1])
        for lo in range(0, len(nodes), step):
            hi = lo + step
            out[lo:hi] = np.einsum("rd,rd->r", self.vectors.take(nodes[lo:hi], axis=0), q.take(row[lo:hi], axis=0))
        return out

    def _beam(self, q: np.ndarray, entry: np.ndarray, beam: int, level: int) -> Tuple[np.ndarray, np.ndarray]:
        """(ids, sims) of each query's beam, worst first; -1 where it is not full."""
        links, rows = self.layers[level], len(q)
        out = np.full((rows, beam), NONE, dtype=np.int64)
        beams = out.copy()  # of the queries still under way, each row sorted
        beams[:, -1] = _keys(np.einsum("rd,rd->r", self.vectors[entry], q), entry)
        seen = np.zeros(rows * self.n, dtype=bool)
        base = np.arange(rows, dtype=np.int64) * self.n
        seen[base + entry] = True
        live = np.arange(rows)
        width = min(EXPAND, beam)
        while len(live):
            waiting = np.where(beams & 1, NONE, beams)
            pick = np.argpartition(waiting, beam - width, axis=1)[:, beam - width :] if width < beam else np.tile(np.arange(beam), (len(live), 1))
            best = np.take_along_axis(waiting, pick, axis=1)
            going = (best != NONE).any(axis=1)
            if not going.all():
                out[live[~going]] = beams[~going]
                live, beams, pick, best, q, base = live[going], beams[going], pick[going], best[going], q[going], base[going]
                if not len(live):
                    break
            np.put_along_axis(beams, pick, np.take_along_axis(beams, pick, axis=1) | 1, axis=1)
            some = best != NONE
            found = links[np.where(some, (best & np.int64(0xFFFFFFFF)) >> 1, 0)]
            found[~some] = -1
            found = np.sort(found.reshape(len(live), -1), axis=1)
            fresh = found >= 0
            fresh[:, 1:] &= found[:, 1:] != found[:, :-1]  # reached twice in one step
            at = base[:, None] + np.maximum(found, 0)
            fresh &= ~seen.take(at)
            seen[at[fresh]] = True
            counts, nodes = fresh.sum(axis=1), found[fresh]
            new = _keys(self._dots(q, counts, nodes), nodes)
            row = np.repeat(np.arange(len(live)), counts)
            better = new > beams[row, 0]
            new, row = new[better], row[better]
            counts = np.bincount(row, minlength=len(live))
            room = int(counts.max(initial=0))
            if room:
                both = np.full((len(live), room + beam), NONE, dtype=np.int64)
                both[:, room:] = beams
                both[row, np.arange(len(row)) - (np.cumsum(counts) - counts)[row]] = new
                both.sort(axis=1)
                beams = both[:, room:]
        return _unkeyed(out)

    def _descend(self, q: np.ndarray, down_to: int) -> np.ndarray:
        entry = np.full(len(q), self.entry, dtype=np.int64)
        for level in range(len(self.layers) - 1, down_to, -1):
            ids, sims = self._beam(q, entry, DESCENT, level)
            entry = ids[np.arange(len(q)), sims.argmax(axis=1)].astype(np.int64)
        return entry

    def search(self, q: np.ndarray, beam: int) -> Tuple[np.ndarray, np.ndarray]:
        q = q.astype(np.float32)
        if beam >= self.n:  # the beam holds everything
            sims = q @ self.vectors[: self.n].T
            return np.tile(np.arange(self.n, dtype=np.int32), (len(q), 1)), sims
        return self._beam(q, self._descend(q, 0), beam, 0)

    def add(self, new: np.ndarray, levels: np.ndarray, known: Optional[Tuple[np.ndarray, np.ndarray]] = None) -> None:
        """Link a batch into every layer up to each point's level. ``known``:
        what ``search`` has just found for it with BUILD_BEAM."""
        at = np.arange(self.n, self.n + len(new))
        self.vectors[at] = new
        new = self.vectors[at]
        peers = new @ new.T
        np.fill_diagonal(peers, -np.inf)
        had, plans = self.n > 0, []
        for level in range(int(levels.max()), -1, -1):  # all searches see the graph as it was
            own = np.flatnonzero(levels >= level)
            among = np.where((levels >= level)[None, :], peers[own], -np.inf)
            n_peers = min(len(new), PEERS if had else BUILD_BEAM)
            near = np.argpartition(-among, n_peers - 1, axis=1)[:, :n_peers]
            ids, sims = at[near].astype(np.int32), np.take_along_axis(among, near, axis=1).astype(np.float32)
            if had and level <= self.entry_level:
                g_ids, g_sims = known if level == 0 and known else self._beam(new[own], self._entry_for(new[own], level), BUILD_BEAM, level)
                ids, sims = np.concatenate([g_ids, ids], axis=1), np.concatenate([g_sims, sims], axis=1)
            plans.append((level, own, ids, sims))
        self.n += len(new)
        for level, own, ids, sims in plans:
            links, cap = self._layer(level), LINKS if level == 0 else LINKS_ABOVE
            out = diverse(self.vectors, ids, sims, cap)
            links[at[own], : out.shape[1]] = out
            self._link_back(links, at[own], out, cap)
        top = int(levels.argmax())
        if self.entry < 0 or levels[top] > self.entry_level:
            self.entry, self.entry_level = int(at[top]), int(levels[top])

    entry_level = -1

    def _entry_for(self, q: np.ndarray, level: int) -> np.ndarray:
        entry = np.full(len(q), self.entry, dtype=np.int64)
        for up in range(self.entry_level, level, -1):
            ids, sims = self._beam(q, entry, DESCENT, up)
            entry = ids[np.arange(len(q)), sims.argmax(axis=1)].astype(np.int64)
        return entry

    def _link_back(self, links: np.ndarray, points: np.ndarray, out: np.ndarray, cap: int) -> None:
        r, c = np.nonzero(out >= 0)
        target, source = out[r, c].astype(np.int64), points[r]
        order = np.lexsort((source, target))
        target, source = target[order], source[order]
        while len(target):
            first = np.ones(len(target), dtype=bool)
            first[1:] = target[1:] != target[:-1]
            t, s = target[first], source[first]
            target, source = target[~first], source[~first]
            known = (links[t] == s[:, None]).any(axis=1)
            t, s = t[~known], s[~known]
            used = (links[t] >= 0).sum(axis=1)
            full = used >= links.shape[1]
            links[t[~full], used[~full]] = s[~full]
            t, s = t[full], s[full]
            if len(t):
                ids = np.concatenate([links[t], s[:, None].astype(np.int32)], axis=1)
                sims = np.empty(ids.shape, dtype=np.float32)
                step = max(1, CELLS // (ids.shape[1] * self.vectors.shape[1]))
                for lo in range(0, len(t), step):
                    hi = lo + step
                    sims[lo:hi] = np.einsum("rcd,rd->rc", self.vectors[np.maximum(ids[lo:hi], 0)], self.vectors[t[lo:hi]])
                kept = diverse(self.vectors, ids, np.where(ids >= 0, sims, -np.inf), cap)
                links[t] = -1
                links[t[:, None], np.arange(kept.shape[1])] = kept

    def dump(self, **more: np.ndarray) -> bytes:
        """``more``: arrays to be kept with the graph."""
        out = io.BytesIO()
        layers = {f"layer{i}": x[: self.n] for i, x in enumerate(self.layers)}
        np.savez(out, vectors=self.vectors[: self.n], entry=np.array([self.entry]), **layers, **{f"own_{k}": x for k, x in more.items()})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> "Graph":
        with np.load(io.BytesIO(data)) as z:
            g = Graph(1, 0)
            g.vectors, g.entry = z["vectors"], int(z["entry"][0])
            g.n = len(g.vectors)
            g.layers = [z[f"layer{i}"] for i in range(sum(k.startswith("layer") for k in z.files))]
            g.entry_level = len(g.layers) - 1
            g.more = {k[4:]: z[k] for k in z.files if k.startswith("own_")}
        return g


def levels_of(ids: np.ndarray) -> np.ndarray:
    """Geometric levels from a hash of the ids: the same on every run."""
    x = (ids.astype(np.int64).view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
    return np.minimum(8, np.floor(-np.log(u) * LEVEL_SCALE)).astype(np.int64)


def build(ids: np.ndarray, unit: np.ndarray, absorb: float) -> Tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, leader row of each node, leader of each row, cosine to it).

    A row whose cosine to a node reaches ``absorb`` is not linked but counted
    to that node, its leader; so copies never crowd the graph."""
    graph = Graph(unit.shape[1], len(ids))
    leader = np.full(len(ids), -1, dtype=np.int64)
    cosine = np.ones(len(ids))
    node_row = np.zeros(len(ids), dtype=np.int64)
    levels = levels_of(ids)
    for lo in range(0, len(ids), BATCH):
        rows = np.arange(lo, min(lo + BATCH, len(ids)))
        known = None
        if graph.n:
            found, sims = graph.search(unit[rows], BUILD_BEAM)
            best = found[np.arange(len(rows)), sims.argmax(axis=1)]
            exact = np.einsum("rd,rd->r", unit[node_row[best]], unit[rows])
            hit = exact >= absorb
            leader[rows[hit]], cosine[rows[hit]] = node_row[best[hit]], exact[hit]
            rows, known = rows[~hit], (found[~hit], sims[~hit])
        among = unit[rows] @ unit[rows].T >= absorb
        fresh: List[int] = []
        for i, row in enumerate(rows):
            near: Optional[int] = next((j for j in fresh if among[i, j]), None) if among[i].sum() > 1 else None
            if near is None:
                fresh.append(i)
            else:
                leader[row], cosine[row] = rows[near], float(unit[row] @ unit[rows[near]])
        rows, known = rows[fresh], known and (known[0][fresh], known[1][fresh])
        if len(rows):
            node_row[graph.n : graph.n + len(rows)] = rows
            leader[rows] = rows
            graph.add(unit[rows], levels[rows], known)
    return graph, node_row[: graph.n], leader, cosine
