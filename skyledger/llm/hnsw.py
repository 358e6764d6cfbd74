"""A hierarchical navigable small-world graph in flat numpy arrays.

An extra component brings all vectors to the length of the longest, so that the nearest
neighbour of a query is the vector with the largest inner product. Distances between
vectors are those of their differences; of the extra component only what it lacks to
the full length is kept. So one vector that is very much longer than the rest does not
drown what sets the others apart. Searches of many queries advance together: in each
step every query expands its nearest unexpanded nodes, all their neighbours are scored
by one product, and each query keeps its best ``ef``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LINKS = 16
BOTTOM_LINKS = 32
BUILD_EF = 64
SEARCH_EF = 160
#: Nodes inserted together at most; the first batches are small, because the first
#: nodes of a graph get the long links. Up to ``BRUTE`` nodes are scored directly.
BATCH = 256
FIRST_BATCH = 8
BRUTE = 512
TOGETHER = 256
EXPANDED = 4
_WIDEST = 48
_WIDEST_BACK = 96


def same_length(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled to a longest one of length 1, and what an extra component lacks to 1.

    The component would be e = sqrt(1 - length^2); kept is 1 - e = length^2 / (1 + e),
    which is exact for short vectors too.
    """
    scaled = vectors.astype(np.float64)
    scaled = scaled / (np.abs(scaled).max(initial=0) or 1)
    norms = (scaled**2).sum(axis=1)
    top = norms.max(initial=0) or 1
    norms = norms / top
    lacking = norms / (1 + np.sqrt(np.maximum(1 - norms, 0)))
    return np.column_stack([scaled / np.sqrt(top), lacking]).astype(np.float32)


def _apart(differences: np.ndarray) -> np.ndarray:
    """Squared lengths of differences of rows of ``same_length``."""
    return np.einsum("...d,...d->...", differences, differences)


def _all_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of two blocks."""
    squares = (a[:, :-1] ** 2).sum(axis=1)[:, None] + (b[:, :-1] ** 2).sum(axis=1)
    return squares - 2 * (a[:, :-1] @ b[:, :-1].T) + (a[:, -1:] - b[:, -1]) ** 2


@dataclass
class Level:
    """Nodes of a level and their links: a row of ``links`` for each node of the shard."""

    nodes: np.ndarray
    links: np.ndarray  # node x link, -1 where there is none


@dataclass
class Graph:
    vectors: np.ndarray
    levels: list[Level] = field(default_factory=list)  # the bottom first

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0) -> Graph:
        """Levels from the top, each entered through the one above."""
        graph = cls(same_length(vectors))
        n = len(vectors)
        drawn = np.random.default_rng(seed).random(n)
        height = np.floor(-np.log(1 - drawn) / np.log(LINKS)).astype(int)
        above: Level | None = None
        for h in range(int(height.max(initial=0)), -1, -1):
            first = above.nodes if above is not None else np.empty(0, dtype=np.int64)
            rest = np.setdiff1d(np.flatnonzero(height >= h), first)
            level = Level(
                np.concatenate([first, rest]),
                np.full((n, LINKS if h else BOTTOM_LINKS), -1, dtype=np.int32),
            )
            graph._link(level)
            graph.levels.insert(0, level)
            above = level
        return graph

    def _link(self, level: Level) -> None:
        """Insert the nodes of a level in batches; the upper levels are whole."""
        nodes, done = level.nodes, 0
        while done < len(nodes):
            batch = nodes[done : done + min(BATCH, max(FIRST_BATCH, done))]
            queries = self.vectors[batch]
            if done <= BRUTE:
                near = np.broadcast_to(nodes[:done], (len(batch), done))
                away = _all_apart(queries, self.vectors[nodes[:done]])
            else:
                entries = self._enter(queries, True)
                near, away = self._search(level.links, queries, entries, BUILD_EF, True)
            own = _all_apart(queries, queries)
            np.fill_diagonal(own, np.inf)
            near = np.concatenate([near, np.broadcast_to(batch, own.shape)], axis=1)
            away = np.concatenate([away, own], axis=1)
            keep = min(_WIDEST, near.shape[1])
            at = np.argpartition(away, keep - 1, axis=1)[:, :keep]
            near, away = np.take_along_axis(near, at, 1), np.take_along_axis(away, at, 1)
            level.links[batch] = self._diverse(near, away, level.links.shape[1])
            self._link_back(level, batch)
            done += len(batch)

    def _diverse(self, near: np.ndarray, away: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` links a row: nodes nearer to the row than to a chosen one first."""
        order = np.argsort(away, axis=1, kind="stable")
        near, away = np.take_along_axis(near, order, 1), np.take_along_axis(away, order, 1)
        rows, width = near.shape
        chosen = np.zeros((rows, width), dtype=bool)
        real = np.isfinite(away) & (near >= 0)
        # How near a candidate is to the nearest chosen one.
        closest = np.full((rows, width), np.inf, dtype=np.float32)
        among = self.vectors[near]
        for c in range(width):
            good = real[:, c] & (away[:, c] < closest[:, c]) & (chosen.sum(axis=1) < most)
            chosen[good, c] = True
            if good.any():
                between = _apart(among[good, c][:, None, :] - among[good])
                closest[good] = np.minimum(closest[good], between)
        # Free places go to the nearest of the others.
        rank = np.where(chosen, 0, np.where(real, 1, 2)) * width + np.arange(width)
        pick = np.argsort(rank, axis=1)[:, :most]
        out = np.where(
            np.take_along_axis(real, pick, 1), np.take_along_axis(near, pick, 1), -1
        )
        if out.shape[1] < most:
            pad = np.full((rows, most - out.shape[1]), -1)
            out = np.concatenate([out, pad], axis=1)
        return out.astype(np.int32)

    def _link_back(self, level: Level, batch: np.ndarray) -> None:
        """Add the opposite of the batch's links; full rows are chosen anew."""
        most = level.links.shape[1]
        sources = np.repeat(batch, most)
        targets = level.links[batch].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        touched = np.unique(targets)
        held = level.links[touched]
        to = np.concatenate([np.repeat(touched, most), targets])
        frm = np.concatenate([held.ravel(), sources])
        to, frm = to[frm >= 0], frm[frm >= 0]
        both = np.unique(np.stack([to, frm], axis=1), axis=0)
        to, frm = both[:, 0], both[:, 1]
        away = _apart(self.vectors[to] - self.vectors[frm])
        order = np.lexsort((away, to))
        to, frm, away = to[order], frm[order], away[order]
        starts = np.searchsorted(to, touched)
        place = np.arange(len(to)) - starts[np.searchsorted(touched, to)]
        counts = np.diff(np.append(starts, len(to)))
        width = int(min(counts.max(initial=1), _WIDEST_BACK))
        near = np.full((len(touched), width), -1, dtype=np.int64)
        far = np.full((len(touched), width), np.inf, dtype=np.float32)
        fits = place < width
        row = np.searchsorted(touched, to[fits])
        near[row, place[fits]] = frm[fits]
        far[row, place[fits]] = away[fits]
        over = counts > most
        short = np.full((len(touched), most), -1, dtype=np.int32)
        short[:, : min(width, most)] = near[:, :most]
        level.links[touched[~over]] = short[~over]
        for at in np.array_split(np.flatnonzero(over), max(1, over.sum() // 1024)):
            if len(at):
                level.links[touched[at]] = self._diverse(near[at], far[at], most)

    def _away(self, queries: np.ndarray, nodes: np.ndarray, stored: bool) -> np.ndarray:
        """From queries that are ``stored`` vectors, or directions, to nodes, row by row."""
        if stored:
            return _apart(queries - self.vectors[nodes])
        return -np.einsum("kd,kd->k", queries, self.vectors[nodes])

    def _enter(self, queries: np.ndarray, stored: bool) -> np.ndarray:
        """Descend through the levels that there are, to one entry node each."""
        if not self.levels:
            raise ValueError("there is no level above")
        entries = np.full(len(queries), self.levels[-1].nodes[0])
        for level in reversed(self.levels):
            entries = self._search(level.links, queries, entries, 1, stored)[0][:, 0]
        return entries

    def _search(self, links, queries, entries, ef, stored):
        """Nodes and distances of the ``ef`` nearest found, unordered."""
        parts = [
            self._search_together(
                links, queries[i : i + TOGETHER], entries[i : i + TOGETHER], ef, stored
            )
            for i in range(0, len(queries), TOGETHER)
        ]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _search_together(self, links, queries, entries, ef, stored):
        b, n = len(queries), len(self.vectors)
        seen = np.zeros((b, n + 1), dtype=bool)
        seen[:, n] = True  # stands for no node
        near = np.full((b, ef), n, dtype=np.int64)
        away = np.full((b, ef), np.inf, dtype=np.float32)
        open_ = np.zeros((b, ef), dtype=bool)
        near[:, 0] = entries
        away[:, 0] = self._away(queries, entries, stored)
        open_[:, 0] = True
        seen[np.arange(b), entries] = True
        active = np.arange(b)
        step = min(EXPANDED, ef)
        while len(active):
            order = np.where(open_[active], away[active], np.inf)
            at = np.argpartition(order, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(order, at, 1))
            open_[active[:, None], at] = False
            grown = links[np.where(live, near[active[:, None], at], 0)]
            grown = np.where(live[:, :, None] & (grown >= 0), grown, n)
            grown = np.sort(grown.reshape(len(active), -1), axis=1)
            grown[:, 1:][grown[:, 1:] == grown[:, :-1]] = n  # reached by two ways
            grown[seen[active[:, None], grown]] = n
            seen[active[:, None], grown] = True
            new = grown < n
            row, col = np.nonzero(new)
            scores = np.full(grown.shape, np.inf, dtype=np.float32)
            scores[row, col] = self._away(queries[active[row]], grown[row, col], stored)
            all_near = np.concatenate([near[active], grown], axis=1)
            all_away = np.concatenate([away[active], scores], axis=1)
            all_open = np.concatenate([open_[active], new], axis=1)
            best = np.argpartition(all_away, ef - 1, axis=1)[:, :ef]
            near[active] = np.take_along_axis(all_near, best, 1)
            away[active] = np.take_along_axis(all_away, best, 1)
            open_[active] = np.take_along_axis(all_open, best, 1)
            active = active[open_[active].any(axis=1)]
        return near, away

    def search(self, queries: np.ndarray, ef: int = SEARCH_EF) -> np.ndarray:
        """Up to ``ef`` near nodes for each query, -1 where there are fewer."""
        scaled = queries.astype(np.float64)
        scaled /= np.maximum(np.sqrt((scaled**2).sum(axis=1, keepdims=True)), 1e-300)
        queries = np.column_stack([scaled, np.zeros(len(scaled))]).astype(np.float32)
        entries = self._enter(queries, False)
        near, away = self._search(self.levels[0].links, queries, entries, ef, False)
        return np.where(np.isfinite(away), near, -1)
