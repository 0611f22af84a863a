"""Block scoring: k nearest members of a block for every query, exactly.

A matrix product in single precision ranks candidates, a cache's worth of pairs at a
time; each query's k-th place so far is the floor for its next members. Everything within
rounding reach of the last floor is then rescored in double and in index order, so equal
vectors get equal scores and ties fall back to the key. Queries with more candidates than
that can tell apart (copies, vectors far from the origin) are ranked in double. Used
inside tasks on blocks whose size the caller bounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

_SLACK = 1e-9
_MATRIX_CELLS = 4_000_000
_PAIR_CHUNK = 200_000
#: Queries and members that are compared at a time.
_QUERIES, _MEMBERS = 512, 2048
#: Squares up to which single precision is trusted, and what its smallest products may lose.
_LARGE, _TINY = 1e30, 1e-28


@dataclass
class Hits:
    """Aligned arrays: query position, key, score."""

    query: np.ndarray
    key: np.ndarray
    score: np.ndarray

    def __len__(self) -> int:
        return len(self.query)

    @staticmethod
    def empty(keys: np.ndarray | None = None) -> "Hits":
        none = np.empty(0, np.int64)
        return Hits(none, none if keys is None else keys[:0], np.empty(0))

    def take(self, rows: np.ndarray) -> "Hits":
        return Hits(self.query[rows], self.key[rows], self.score[rows])

    @staticmethod
    def joined(parts: list["Hits"]) -> "Hits":
        return Hits(
            np.concatenate([p.query for p in parts]),
            np.concatenate([p.key for p in parts]),
            np.concatenate([p.score for p in parts]),
        )


def _first_places(group: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The first k entries of ``order`` in each run of equal ``group[order]``."""
    if not len(order):
        return order
    g = group[order]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[place < k]


def best(hits: Hits, k: int, descending: bool) -> Hits:
    """Keep the k closest hits of each query, ties by key."""
    value = -hits.score if descending else hits.score
    order = _first_places(hits.query, np.lexsort((hits.key, value, hits.query)), k)
    return Hits(hits.query[order], hits.key[order], hits.score[order])


def best_by_key(hits: Hits, k: int, descending: bool) -> Hits:
    """:func:`best` for keys of any type: ordering integers is far cheaper than ordering keys."""
    names, rank = ranked_keys(hits.key)
    kept = best(Hits(hits.query, rank, hits.score), k, descending)
    return Hits(kept.query, names[kept.key], kept.score)


def best_once(hits: Hits, k: int, descending: bool) -> Hits:
    """:func:`best_by_key` where a hit may come twice."""
    names, rank = ranked_keys(hits.key)
    order = np.lexsort((rank, -hits.score if descending else hits.score, hits.query))
    query, key, score = hits.query[order], rank[order], hits.score[order]
    first = np.append(True, (query[1:] != query[:-1]) | (key[1:] != key[:-1]) | (score[1:] != score[:-1]))[: len(query)]
    kept = best(Hits(query[first], key[first], score[first]), k, descending)
    return Hits(kept.query, names[kept.key], kept.score)


def ranked_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys in their order, and the place of each; a null comes first, as in Spark."""
    if keys.dtype != object:
        return np.unique(keys, return_inverse=True)
    null = np.array([x is None for x in keys], bool)
    if not null.any():
        return np.unique(keys, return_inverse=True)
    names, place = np.unique(keys[~null], return_inverse=True)
    rank = np.zeros(len(keys), np.int64)
    rank[~null] = place + 1
    return np.append(np.array([None], object), names), rank


def thin_copies(block: np.ndarray, keys: np.ndarray, k: int, cells: np.ndarray | None = None) -> np.ndarray:
    """Of identical vectors (of a cell) only the k lowest keys can ever be returned: their places."""
    raw = np.ascontiguousarray(block).view(np.dtype((np.void, block.shape[1] * 8))).ravel()
    group = np.unique(raw, return_inverse=True)[1].ravel()
    if cells is not None:
        group = group * (int(cells.max(initial=0)) + 1) + cells
    return np.sort(_first_places(group, np.lexsort((keys, group)), k))


class Scorer:
    """Scores blocks of members against a fixed block of query vectors."""

    def __init__(self, metric: str, queries: np.ndarray, k: int, max_norm: float | None = None, bound: np.ndarray | None = None):
        """``bound`` is a score for each query (or NaN) that its k-th hit is known to reach: worse ones may be left out."""
        self.metric, self.k, self.bound = metric, k, bound
        self.q = np.asarray(queries, dtype=np.float64)
        self.q_sq = _sq(self.q)
        self.q_norm = np.sqrt(self.q_sq)
        self.max_norm = max_norm
        self.descending = metric == "ip"

    def top(
        self, block: np.ndarray, keys: np.ndarray, so_far: Hits | None = None, cells: np.ndarray | None = None, mask: np.ndarray | None = None
    ) -> Hits:
        """Best k per query among ``so_far`` and the members of ``block``.

        With ``cells``, the members' cells, a query meets only those that its row of ``mask`` has.
        """
        if so_far is None or not len(so_far):
            so_far = Hits.empty(keys)
        if not len(block) or not len(self.q):
            return so_far
        if cells is None:
            cells, mask = np.zeros(len(block), np.int64), np.ones((len(self.q), 1), bool)
        members = _Members(self.metric, block, keys)
        floor = self._floor(so_far, members.largest_sq)
        wild, found = np.flatnonzero(members.wild), []
        if len(wild):
            found = self._plain(np.arange(len(self.q)), members.take(wild), cells[wild], mask, floor)
            tame = np.flatnonzero(~members.wild)
            members, cells = members.take(tame), cells[tame]
        hits, left = self._fast(members, cells, mask, floor)
        found += hits
        if len(left):
            thin, kept = members.thin(self.k, cells)
            if len(kept) < len(cells):
                members, cells = thin, cells[kept]
                again, left = self._fast(members, cells, mask, floor, left)
                found += again
        found += self._plain(left, members, cells, mask, floor)
        new = Hits.joined(found) if found else Hits.empty(keys)
        if not len(new):
            return so_far
        # Only queries with a new hit are ranked again.
        touched = np.zeros(len(self.q), dtype=bool)
        touched[new.query] = True
        again = touched[so_far.query]
        ranked = self._best_by_key(Hits.joined([so_far.take(again), new]))
        return Hits.joined([so_far.take(~again), ranked])

    def _best_by_key(self, hits: Hits) -> Hits:
        return best_by_key(hits, self.k, self.descending)

    def _slack(self, largest_sq: float) -> np.ndarray:
        """Rounding reach of a closeness value, generously."""
        if self.metric == "cosine":
            return _SLACK * self.q_norm
        reach = self.q_norm * np.sqrt(largest_sq)
        return _SLACK * (self.q_sq + largest_sq + reach if self.metric == "l2" else reach)

    def _floor(self, so_far: Hits, largest_sq: float) -> np.ndarray:
        """Least closeness that can still matter: that of the current k-th hit."""
        n = len(self.q)
        worst = np.full(n, np.inf if self.descending else -np.inf)
        (np.minimum if self.descending else np.maximum).at(worst, so_far.query, so_far.score)
        value = self._closeness(worst, largest_sq)
        full = np.bincount(so_far.query, minlength=n) >= self.k
        floor = np.where(full & np.isfinite(value), value, -np.inf)
        if self.bound is not None:
            value = self._closeness(self.bound, largest_sq)
            floor = np.where(np.isfinite(value), np.maximum(floor, value), floor)
        return floor

    def _closeness(self, worst: np.ndarray, largest_sq: float) -> np.ndarray:
        """The least product that a score may come from."""
        with np.errstate(all="ignore"):
            if self.metric == "l2":
                value = (self.q_sq - worst**2) / 2
            elif self.metric == "ip":
                value = worst
            elif self.metric == "cosine":
                value = (1.0 - worst) * self.q_norm
            else:
                value = (self.max_norm**2 + self.q_sq - worst**2) / 2
            return value - self._slack(largest_sq)

    def _fast(self, members: "_Members", cells: np.ndarray, mask: np.ndarray, floor: np.ndarray, of: np.ndarray | None = None) -> tuple[list[Hits], np.ndarray]:
        """Hits of the queries ``of``, or all; and the queries that must be ranked in double instead."""
        of = np.arange(len(self.q)) if of is None else of
        if self.metric == "cosine":
            of = of[~(self.q_sq[of] == 0)]
        # Products that may overflow are none of single precision's business.
        if members.largest_sq > _LARGE:
            return [], of
        plain = ~(self.q_sq[of] <= _LARGE)
        left, of = [of[plain]], of[~plain]
        order = np.flatnonzero(~members.void)
        order = order[np.argsort(cells[order], kind="stable")]
        cells = cells[order]
        if not len(order):
            return [], order
        starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        parts = cells[starts], starts, np.append(starts[1:], len(order))
        single = members.compared[order].astype(np.float32).T.copy()
        # Of a sum of d + 1 products of rounded factors, twice over.
        far = self.q_norm * (1.0 if self.metric == "cosine" else np.sqrt(members.largest_sq)) + (members.largest_sq / 2 if self.metric == "l2" else 0.0)
        coarse = 2.0**-23 * (len(single) + 4) * far + _TINY
        found = []
        for at in range(0, len(of), _QUERIES):
            qs = of[at : at + _QUERIES]
            query, member, many = self._candidates(qs, single, parts, mask[qs], floor[qs] - coarse[qs], coarse[qs] + self._slack(members.largest_sq)[qs])
            left.append(qs[many])
            query, member = qs[query], order[member]
            scores = self._exact(query, member, members.block)
            ok = ~np.isnan(scores)
            hits = best(Hits(query[ok], members.rank[member[ok]], scores[ok]), self.k, self.descending)
            found.append(Hits(hits.query, members.names[hits.key], hits.score))
        return found, np.concatenate(left)

    def _candidates(self, qs, single: np.ndarray, parts, mask: np.ndarray, cut: np.ndarray, slack: np.ndarray):
        """``(query, member)`` of the pairs within reach of the k-th place, and the queries with too many of them.

        ``cut`` is the least product that counts so far, ``slack`` what a product may be off.
        """
        q = self.q[qs].astype(np.float32)
        q = np.column_stack([q, np.ones(len(q), np.float32)]) if self.metric == "l2" else q
        most, k = 8 * self.k + 64, self.k
        query, member, value = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        fresh, n_fresh, alive = [], 0, np.ones(len(qs), bool)

        def lower(x: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return np.nextafter(x.astype(np.float32), np.float32(-np.inf))

        def pruned():
            query, member, value = (np.concatenate(x) for x in zip(held, *fresh, strict=True))
            order = np.lexsort((-value, query))
            query, member, value = query[order], member[order], value[order]
            starts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else order
            kth = starts + k - 1
            full = kth < np.append(starts[1:], len(query))
            own = query[starts[full]]
            cut[own] = np.maximum(cut[own], value[kth[full]] - 2 * slack[own])
            near = value >= lower(cut)[query]
            alive[np.bincount(query[near], minlength=len(qs)) > most] = False
            near &= alive[query]
            return query[near], member[near], value[near]

        held = (query, member, value)
        # Cells next to each other that the same queries meet are one.
        cells, starts, ends = parts
        met = mask[:, cells]
        joined = np.flatnonzero(np.append(True, (met[:, 1:] != met[:, :-1]).any(axis=0)))
        for cell, first, end in zip(cells[joined], starts[joined], np.append(ends[joined[1:] - 1], ends[-1:]), strict=True):
            for a in range(first, end, _MEMBERS):
                b = min(a + _MEMBERS, end)
                act = np.flatnonzero(mask[:, cell] & alive)
                if not len(act):
                    break
                close = (q if len(act) == len(q) else q[act]) @ single[:, a:b]
                open_ = np.flatnonzero(np.isneginf(cut[act]))
                if len(open_) and b - a > k:
                    kth = np.partition(close[open_], b - a - k, axis=1)[:, b - a - k]
                    cut[act[open_]] = kth - 2 * slack[act[open_]]
                at = np.flatnonzero(close >= lower(cut[act])[:, None])
                if not len(at):
                    continue
                fresh.append((act[at // (b - a)], a + at % (b - a), close.ravel()[at]))
                n_fresh += len(at)
                if n_fresh > 2 * len(qs):
                    held, fresh, n_fresh = pruned(), [], 0
        query, member, _ = pruned()
        return query, member, np.flatnonzero(~alive)

    def _plain(self, left: np.ndarray, members: "_Members", cells: np.ndarray, mask: np.ndarray, floor: np.ndarray) -> list[Hits]:
        """Hits of the queries ``left``, cell by cell in double precision."""
        found = []
        for cell in np.unique(cells) if len(left) else ():
            qs, inside = left[mask[left, cell]], np.flatnonzero(cells == cell)
            if not len(qs):
                continue
            own = members if len(inside) == len(cells) else members.take(inside)
            step = max(1, _MATRIX_CELLS // len(inside))
            found += [self._block_hits(qs[at : at + step], own, floor[qs[at : at + step]]) for at in range(0, len(qs), step)]
        return found

    def _block_hits(self, qs, members: "_Members", floor: np.ndarray) -> Hits:
        near = self._near(qs, members, floor)
        if not members.thinned and np.count_nonzero(near) > 8 * self.k * len(qs) + 65_536:
            thin, _ = members.thin(self.k)
            if len(thin.keys) < len(members.keys):
                return self._block_hits(qs, thin, floor)
        qi, xi = np.nonzero(near)
        used, place = np.unique(xi, return_inverse=True)
        names, rank = ranked_keys(members.keys[used])
        found = Hits.empty()
        for start in range(0, len(qi), _PAIR_CHUNK):
            part = slice(start, start + _PAIR_CHUNK)
            scores = self._exact(qs[qi[part]], xi[part], members.block)
            ok = ~np.isnan(scores)
            chunk = Hits(qs[qi[part]][ok], rank[place[part]][ok], scores[ok])
            found = best(Hits.joined([found, chunk]), self.k, self.descending)
        return Hits(found.query, names[found.key], found.score)

    def _near(self, qs, members: "_Members", floor: np.ndarray) -> np.ndarray:
        """Candidates: at or within rounding reach of the k-th place."""
        wild = ~np.isfinite(self.q_sq[qs])
        with np.errstate(all="ignore"):
            q = self.q[qs]
            if self.metric == "l2":
                q = np.column_stack([q, np.ones(len(q))])
            close = q @ members.compared.T
        if members.wild.any():
            close[:, members.wild] = -np.inf
        open_ = np.flatnonzero(np.isneginf(floor) & ~wild)
        cut = floor.copy()
        if len(open_) and close.shape[1] > self.k:
            at = close.shape[1] - self.k
            kth = np.partition(close[open_], at, axis=1)[:, at]
            cut[open_] = kth - self._slack(members.largest_sq)[qs[open_]]
        near = close >= cut[:, None]
        # Pairs whose product may overflow are always scored exactly.
        near[:, members.wild] = True
        near[wild] = True
        near[:, members.void] = False
        return near

    def _exact(self, qi, xi, block) -> np.ndarray:
        a, b = block[xi].T, self.q[qi].T
        with np.errstate(all="ignore"):
            if self.metric == "l2":
                return np.sqrt(_ordered(a, b, lambda x, y: (x - y) ** 2))
            ip = _ordered(a, b, np.multiply)
            if self.metric == "ip":
                return ip
            if self.metric == "cosine":
                scale = np.sqrt(_ordered(a, a, np.multiply)) * np.sqrt(_ordered(b, b, np.multiply))
                return np.where(scale == 0, np.nan, 1.0 - ip / scale)
            q_sq = _ordered(b, b, np.multiply)
            return np.sqrt(np.maximum(0.0, self.max_norm * self.max_norm + q_sq - ip * 2.0))


class _Members:
    """A block of members in the form the matrix product compares.

    A larger product means closer: x and -|x|^2 / 2 for l2, x / |x| for cosine, x
    itself for the other two.
    """

    def __init__(self, metric: str, block: np.ndarray, keys: np.ndarray, thinned: bool = False):
        self.metric, self.block, self.keys, self.thinned = metric, block, keys, thinned
        sq = _sq(block)
        self.wild = ~np.isfinite(sq)
        self.void = sq == 0 if metric == "cosine" else np.zeros(len(sq), dtype=bool)
        self.largest_sq = float(sq.max(initial=0.0, where=~self.wild))
        with np.errstate(all="ignore"):
            if metric == "l2":
                self.compared = np.column_stack([block, sq / -2])
            elif metric == "cosine":
                self.compared = block / np.where(self.void, 1.0, np.sqrt(sq))[:, None]
            else:
                self.compared = block

    @cached_property
    def named(self) -> tuple[np.ndarray, np.ndarray]:
        return ranked_keys(self.keys)

    @property
    def names(self) -> np.ndarray:
        """The keys in their order, and in ``rank`` the place of each member's."""
        return self.named[0]

    @property
    def rank(self) -> np.ndarray:
        return self.named[1]

    def take(self, rows: np.ndarray) -> "_Members":
        return _Members(self.metric, self.block[rows], self.keys[rows], self.thinned)

    def thin(self, k: int, cells: np.ndarray | None = None) -> tuple["_Members", np.ndarray]:
        """Without the copies that can never be returned (in each cell), and the places of the others."""
        kept = thin_copies(self.block, self.rank, k, cells)
        return _Members(self.metric, self.block[kept], self.keys[kept], thinned=True), kept


def _sq(block: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.einsum("ij,ij->i", block, block)


def _ordered(a: np.ndarray, b: np.ndarray, op) -> np.ndarray:
    total = np.zeros(a.shape[1])
    for x, y in zip(a, b):
        total += op(x, y)
    return total
