"""Sums of exp(-|q - c|^2 / tau) over context rows c by class, for many queries q of few features.

Rows are put in boxes of a grid.  With the centres n of a query's box and m of
a context row's, u = q - n, v = c - m and D = n - m,

    -|q - c|^2 = -|q - m|^2 + (2 D v - |v|^2) + 2 u v .

The first part is the query's alone, the second the context row's for all
queries of a box, and in a box's width the exponential of the third is a short
series of products of powers of u and of v.  So the context rows of a box are
summed once for a box of queries, by power of v and class, and each query meets
these sums instead of the rows.  All terms are positive and none is left out;
the series' end is under 4e-13 of a pair's weight, wherever the boxes are.
Rows in boxes too empty to be worth it, and those that are not finite, are left
to the caller, who compares them pair by pair.
"""

from __future__ import annotations

import functools
import math

import numpy as np

#: A box's side, as a share of sqrt(tau / features), and the first power that is left out.
SIDE, ORDER = 0.7, 10
#: A series of more terms is not used (so at most four features).
MOST_TERMS = 1000
#: A box of fewer queries is not worth the sums made for it, one of fewer context rows than
#: 1 / PAIRS of the products (terms by classes) not what a query takes to meet them.
FEW_QUERIES, PAIRS = 8, 40
#: Boxes of queries, rows of a box, and sums, that are worked on at once.
QUERY_BOXES, ROWS, SUMS = 1024, 4096, 1 << 22


@functools.lru_cache
def series(d: int) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """(an earlier product, the feature it is multiplied by) of every product of
    powers after the first; the degrees and 1 / (the powers' factorials) of all."""
    products, at = [(0,) * d], {(0,) * d: 0}
    steps = []
    for p in products:
        last = max((j for j in range(d) if p[j]), default=0)
        for j in range(last, d):
            if sum(p) < ORDER - 1:
                longer = (*p[:j], p[j] + 1, *p[j + 1:])
                steps.append((at[p], j))
                at[longer] = len(products)
                products.append(longer)
    return steps, np.array(list(map(sum, products))), np.array([1 / math.prod(map(math.factorial, p)) for p in products])


def usable(d: int) -> bool:
    return d > 0 and math.comb(ORDER - 1 + d, d) <= MOST_TERMS


def powers(v: np.ndarray) -> np.ndarray:
    """Products of powers of the columns of ``v``, a row a product."""
    steps, *_ = series(v.shape[1])
    out, columns = np.empty((len(steps) + 1, len(v))), np.ascontiguousarray(v.T)
    out[0] = 1.0
    for k, (p, j) in enumerate(steps, 1):
        np.multiply(out[p], columns[j], out=out[k])
    return out


def boxes(x: np.ndarray, side: float, least: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Row numbers and centre of each box of at least ``least`` rows, and which rows are in none."""
    rows, left = np.flatnonzero(np.isfinite(x).all(axis=1)), np.ones(len(x), bool)
    found, centres = [], []
    if len(rows):
        with np.errstate(over="ignore", invalid="ignore"):
            cell = np.floor((x[rows] - x[rows].min(axis=0)) / side)
        order = np.lexsort(cell.T)
        rows, cell = rows[order], cell[order]
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)])
        for own in np.split(rows, starts[1:]):
            if len(own) >= least:
                low, high = x[own].min(axis=0), x[own].max(axis=0)
                if (high - low <= 1.001 * side).all():  # else the numbers are too large to tell cells apart
                    found.append(own)
                    centres.append((low + high) / 2)
                    left[own] = False
    return found, np.array(centres).reshape(len(found), x.shape[1]), left


def _gather(v: np.ndarray, y: np.ndarray, far: np.ndarray, tau: float, out: np.ndarray) -> np.ndarray:
    """Adds up the rows of one box, sorted by class, for each box of queries
    (``far``: 2 D / tau) into ``out`` (boxes of queries, products, classes), over the
    largest weight, whose logarithm is returned."""
    own = (v * v).sum(axis=1)[:, None] / tau
    weight = lambda k: v[k:k + ROWS] @ far.T - own[k:k + ROWS]
    top = np.max([weight(k).max(axis=0) for k in range(0, len(v), ROWS)], axis=0)
    for k in range(0, len(v), ROWS):
        w = weight(k)
        w -= top
        np.exp(w, out=w)
        p = powers(v[k:k + ROWS])
        edges = np.searchsorted(y[k:k + ROWS], np.arange(out.shape[2] + 1))
        for c, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                out[:, :, c] += (p[:, a:b] @ w[a:b]).T
    return top


def box_sums(cx: np.ndarray, cy: np.ndarray, x: np.ndarray, width: int, tau: float, merge):
    """(m, s, queries left, context rows left): for each query that is in a box the
    sums s by class of exp(logit - m) over the context rows that are, with m near the
    largest such logit; -inf and zeros for others.  ``merge(m, s, m2, s2)`` puts two together."""
    n, d = x.shape
    side, (_, degree, factor) = SIDE * math.sqrt(tau / d), series(d)
    m, s = np.full(n, -np.inf), np.zeros((n, width))
    y = np.arange(width)[cy.astype(int)]
    near, mu, left_c = boxes(cx, side, max(2, len(factor) * width // PAIRS))
    asked, nu, left_x = boxes(x, side, FEW_QUERIES) if near else ([], np.zeros((0, d)), np.ones(n, bool))
    if not asked:
        return m, s, left_x, np.ones(len(cx), bool)
    near = [own[np.argsort(y[own], kind="stable")] for own in near]
    factor = (factor * (2 / tau) ** degree)[:, None]
    at_once = max(1, min(QUERY_BOXES, SUMS // (len(factor) * width)))
    for i in range(0, len(asked), at_once):
        some = asked[i:i + at_once]
        each = max(1, SUMS // (max(len(some) * len(factor), ROWS) * width))
        for k in range(0, len(near), each):
            part, at = near[k:k + each], mu[k:k + each]
            sums, top = np.zeros((len(some), len(factor), len(part), width)), np.empty((len(some), len(part)))
            for j, own in enumerate(part):
                top[:, j] = _gather(cx[own] - at[j], y[own], 2 * (nu[i:i + at_once] - at[j]) / tau, tau, sums[:, :, j])
            for g, mine in enumerate(some):
                meets = sums[g].reshape(len(factor), -1)
                rows = max(1, min(ROWS, SUMS // meets.shape[1]))
                for own in np.split(mine, range(rows, len(mine), rows)):
                    q = x[own]
                    logit = top[g] - sum(np.square(q[:, f, None] - at[:, f]) for f in range(d)) / tau
                    most = logit.max(axis=1)
                    logit -= most[:, None]
                    np.exp(logit, out=logit)
                    by_box = (powers(q - nu[i + g]) * factor).T @ meets
                    got = np.einsum("qb,qbc->qc", logit, by_box.reshape(len(own), len(part), width))
                    m[own], s[own] = merge(m[own], s[own], most, got)
    return m, s, left_x, left_c

