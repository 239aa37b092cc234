"""An inverted index over sparse unit vectors that gives the exact nearest ones and reads few of them."""

from __future__ import annotations

import numpy as np

DENSE = 0.25  # filled share of the matrix above which rows are scored by a matrix product
LOOKS = 4  # times k leading rows are scored to see what the k-th best has at least
SCORES = 1 << 19  # scores of one matrix product
SLACK = 1e-7  # bounds give way by more than rounding takes


def scaled(starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of rows divided by their row's length (plus 1e-9, so that a zero vector stays zero)."""
    sizes = np.diff(starts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    length = np.sqrt(np.bincount(row, weights=weights * weights, minlength=len(sizes)))
    return weights / (length + 1e-9)[row]


class Postings:
    """Rows in the order that breaks ties; row i has the slots and weights from starts[i] to starts[i + 1].

    A negative slot adds to the length of a vector and matches nothing. ``search`` reads the posting lists of the
    slots that tell most for their length first. What the lists not yet read can still give is bounded by the
    largest weights in them and by the length of the query's rest, as rows are unit vectors; the rows that lead so
    far are scored to see what the k-th best has at least. Once no row outside can reach it, the long lists that
    remain are not read: the rows inside are looked up in them, and fall out as soon as their bound does.
    ``touched`` counts postings read and rows looked up, ``scored`` the rows scored in full.
    """

    def __init__(self, starts: np.ndarray, slots: np.ndarray, weights: np.ndarray):
        self.starts, self.slots, self.n = starts, slots, len(starts) - 1
        self.weights = scaled(starts, weights)
        row = np.repeat(np.arange(self.n), np.diff(starts))
        order = np.argsort(slots, kind="stable")
        order = order[np.searchsorted(slots[order], 0) :]
        self.known, first = np.unique(slots[order], return_index=True)
        self.bounds = np.append(first, len(order))
        self.rows, self.listed = row[order], self.weights[order]  # a list's rows ascend
        self.most = np.maximum.reduceat(self.listed, first) if len(first) else np.zeros(0)
        self.least = np.minimum.reduceat(self.listed, first) if len(first) else np.zeros(0)
        self.full = len(self.known) > 0 and len(slots) > DENSE * self.n * len(self.known)
        if self.full:
            self.matrix = np.zeros((self.n, len(self.known)))
            self.matrix[self.rows, np.searchsorted(self.known, slots[order])] = self.listed
        self.sums, self.met = np.zeros(self.n), np.zeros(self.n, dtype=bool)
        self.touched = self.scored = 0

    def _placed(self, slots: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the query's slots in this index and their weights."""
        if not len(self.known):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.known, slots), len(self.known) - 1)
        here = (self.known[at] == slots) & (weights != 0)  # no negative slot is known
        return at[here], weights[here]

    def _exact(self, rows: np.ndarray, slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of the given rows from their own vectors."""
        order = np.argsort(slots)
        slots, weights = slots[order], weights[order]
        sizes = self.starts[rows + 1] - self.starts[rows]
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.starts[rows] - first, sizes)
        found = np.minimum(np.searchsorted(slots, self.slots[at]), max(0, len(slots) - 1))
        gain = np.zeros(len(at))
        if len(slots):
            same = (slots[found] == self.slots[at]) & (self.slots[at] >= 0)
            gain[same] = weights[found[same]] * self.weights[at[same]]
        self.scored += len(rows)
        return np.bincount(np.repeat(np.arange(len(rows)), sizes), weights=gain, minlength=len(rows))

    def _list(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[slot], self.bounds[slot + 1])
        return self.rows[part], self.listed[part]

    def _inside(self, slots: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that can be among the k best."""
        at, weights = self._placed(slots, query)
        sizes = self.bounds[at + 1] - self.bounds[at]
        order = np.argsort(-(weights * weights) / sizes, kind="stable")
        at, weights = at[order], weights[order]
        ends = weights * self.most[at], weights * self.least[at]
        tail = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0.0)
        length = np.sqrt(tail(weights * weights))
        gains = np.minimum(tail(np.maximum(0.0, np.maximum(*ends))), length)  # of the lists from each place on
        losses = np.maximum(tail(np.minimum(0.0, np.minimum(*ends))), -length)
        touched: list[np.ndarray] = []
        n_met, looked, bar, read = 0, np.inf, -np.inf, 0
        for slot, weight in zip(at, weights, strict=True):
            rows, listed = self._list(slot)
            self.sums[rows] += weight * listed
            new = rows[~self.met[rows]]
            self.met[new] = True
            touched.append(new)
            n_met, read = n_met + len(new), read + 1
            self.touched += len(rows)
            # a look costs some exact scores: again only when the bound has come down
            if n_met < k or gains[read] > 0.9 or gains[read] > 0.8 * looked:
                continue
            looked = gains[read]
            rows = np.concatenate(touched)
            few = rows
            if len(rows) > LOOKS * k:
                few = rows[np.argpartition(-self.sums[rows], LOOKS * k)[: LOOKS * k]]
            bar = max(bar, np.partition(self._exact(few, slots, query), -k)[-k] - SLACK)
            if gains[read] < bar:
                break
        rows = np.concatenate(touched) if touched else np.zeros(0, dtype=np.int64)
        if gains[read] < bar:
            sums = self.sums[rows]
            inside = rows[sums + gains[read] >= bar]
            sums = self.sums[inside]
            for j in range(read, len(at)):
                found, listed = self._list(at[j])
                place = np.minimum(np.searchsorted(found, inside), len(found) - 1)
                sums += np.where(found[place] == inside, weights[j] * listed[place], 0.0)
                self.touched += len(inside)
                if len(sums) >= k:
                    bar = max(bar, np.partition(sums, -k)[-k] + losses[j + 1] - SLACK)
                kept = sums + gains[j + 1] >= bar
                inside, sums = inside[kept], sums[kept]
        else:  # all lists are read: rows that were not met score 0, the first of them go before the others
            inside = np.append(rows, np.flatnonzero(~self.met[: n_met + k])[:k])
        self.sums[rows], self.met[rows] = 0.0, False
        return inside

    def search(self, slots: np.ndarray, weights: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best, scores rounded to ``digits``, ties to the smaller row; ``weights`` of a unit vector."""
        rows = self._inside(slots, weights, k) if self.n > k else np.arange(self.n)
        scores = np.round(self._exact(rows, slots, weights), digits)
        best = np.lexsort((rows, -scores))[:k]
        return rows[best], scores[best]

    def search_full(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, digits: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search`` for many queries by matrix products."""
        out = []
        step = max(1, SCORES // max(1, self.n))
        for first in range(0, len(queries), step):
            part = queries[first : first + step]
            q = np.zeros((len(part), len(self.known)))
            for i, (slots, weights) in enumerate(part):
                at, known = self._placed(slots, weights)
                q[i, at] = known
            scores = np.round(q @ self.matrix.T, digits)
            # Only what reaches the k-th best score is sorted; ties at it are all kept until then.
            last = max(0, self.n - k)
            query, row = np.nonzero(scores >= np.partition(scores, last, axis=1)[:, last : last + 1])
            score = scores[query, row]
            order = np.lexsort((row, -score, query))
            starts = np.searchsorted(query, np.arange(len(part)))
            out += [(row[o], score[o]) for o in (order[a : a + min(k, self.n)] for a in starts)]
            self.scored += self.n * len(part)
        return out
