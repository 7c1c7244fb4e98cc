"""Singular values and right vectors of a small square matrix, by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal; the shifted
differential qd transform (dqds) finds its singular values to high relative
accuracy; twisted factorisations of the shifted product give the vectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Squared singular values nearer than this share of themselves are taken together.
CLUSTER = 1e-4


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and ``v`` with ``r = u b v.T`` for some orthogonal ``u``."""
    a = np.array(r, float)
    n = len(a)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        h = x / size
        h[0] += np.copysign(1.0, h[0])
        return h / np.linalg.norm(h)
    for k in range(n):
        h = reflector(a[k:, k])
        if h is not None:
            a[k:, k:] -= 2 * np.outer(h, h @ a[k:, k:])
        if k + 2 < n:
            h = reflector(a[k, k + 1:])
            if h is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ h, h)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One transform of a qd array with a shift, and its ``d``; one below zero means that the shift is too large."""
    n = len(q)
    old_q, old_e = q.tolist(), e.tolist()
    new_q, new_e, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = ds[0] = old_q[0] - shift
    for k in range(n - 1):
        new_q[k] = d + old_e[k]
        if d < 0 or new_q[k] <= 0:
            return q, e, np.array([-1.0])
        ratio = old_q[k + 1] / new_q[k]
        new_e[k] = old_e[k] * ratio
        d = ds[k + 1] = d * ratio - shift
    new_q[n - 1] = d
    return np.array(new_q), np.array(new_e), np.array(ds)


def squares(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of a bidiagonal matrix without zeros on its diagonal.

    Without a shift, the ``d`` of a transform are the inverses of the diagonal
    of the inverse product, so one over the sum of their inverses is a lower
    bound of the least eigenvalue: a shift that always leaves the array positive.
    """
    found: list[float] = []
    work = [(diagonal.astype(float) ** 2, above.astype(float) ** 2, 0.0)]
    while work:
        q, e, moved = work.pop()
        while len(q) > 1:
            small = np.flatnonzero(e <= (4 * EPS) ** 2 * (moved + np.minimum(q[:-1], q[1:])))
            if len(small):
                cut = int(small[-1]) + 1
                work.append((q[:cut], e[:cut - 1], moved))
                q, e = q[cut:], e[cut:]
                continue
            if q[0] < q[-1]:  # the transform sorts falling values fast
                q, e = q[::-1], e[::-1]
            new_q, new_e, d = _dqds(q, e, 0.0)
            shift = (1 - 8 * EPS * len(q)) / np.sum(1 / d) if d.min() > 0 else 0.0
            if shift > EPS * moved:
                shifted = _dqds(q, e, shift)
                if shifted[2].min() >= 0:
                    new_q, new_e, moved = shifted[0], shifted[1], moved + shift
            q, e = new_q, new_e
        found += [x + moved for x in q]
    return np.sort(np.maximum(np.array(found), 0))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gamma`` of every twist, and the multipliers down and up, of the shifted product; one column a value."""
    n, tiny = len(diagonal), np.finfo(float).tiny * 1e10
    d, low = diagonal ** 2, above / diagonal[:-1]
    safe = lambda x: np.where(np.abs(x) < tiny, tiny, x)
    s, p = np.empty((n, len(values))), np.empty((n, len(values)))
    down, up = np.empty((max(n - 1, 0), len(values))), np.empty((max(n - 1, 0), len(values)))
    s[0] = -values
    for k in range(n - 1):
        down[k] = d[k] * low[k] / safe(s[k] + d[k])
        s[k + 1] = down[k] * low[k] * s[k] - values
    p[n - 1] = d[n - 1] - values
    for k in range(n - 2, -1, -1):
        ratio = d[k] / safe(d[k] * low[k] ** 2 + p[k + 1])
        up[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - values
    return s + p + values, down, up


def _solved(twist: np.ndarray, down: np.ndarray, up: np.ndarray) -> np.ndarray:
    """The vector of each column's twist, of length one (zero if it overflows)."""
    n, m = len(down) + 1, len(twist)
    z = np.zeros((n, m))
    z[twist, np.arange(m)] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(n - 2, -1, -1):
            z[k] = np.where(k < twist, -down[k] * z[k + 1], z[k])
        for k in range(n - 1):
            z[k + 1] = np.where(k >= twist, -up[k] * z[k], z[k + 1])
        size = np.linalg.norm(z, axis=0)
    return np.where(np.isfinite(size), z, 0) / np.where(np.isfinite(size), size, 1)  # a twist far off may overflow


def vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors, one column for each squared singular value of ``values`` (falling).

    A value apart from the others takes the twist with the least ``gamma``,
    after a correction of the value by its quotient. For values close together
    the vectors of all twists at each of them span the same space: the
    strongest orthogonal directions of those with the least residuals are
    taken and turned within it.
    """
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    ends = np.append(np.flatnonzero(values[:-1] - values[1:] > CLUSTER * values[:-1]) + 1, len(values))
    begins = np.append(0, ends[:-1])
    alone = begins[ends - begins == 1]
    some, columns = values[alone], np.arange(len(alone))
    for _ in range(2):
        gamma, down, up = _twisted(diagonal, above, some)
        twist = np.abs(gamma).argmin(axis=0)
        out[:, alone] = z = _solved(twist, down, up)
        some = some + gamma[twist, columns] * z[twist, columns] ** 2
    for begin, end in zip(begins.tolist(), ends.tolist()):
        if end - begin > 1:
            out[:, begin:end] = _spanned(diagonal, above, values[begin:end])
    return out


def _spanned(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthogonal vectors of values close together."""
    n, size = len(diagonal), len(values)
    parts, rest = [], []
    for value in np.unique(values):
        gamma, down, up = _twisted(diagonal, above, np.full(n, value))
        z = _solved(np.arange(n), down, up)
        parts.append(z)
        rest.append(np.where(z.any(axis=0), np.abs(np.diagonal(gamma) * np.diagonal(z)), np.inf))
    z, rest = np.concatenate(parts, axis=1), np.concatenate(rest)
    good = rest <= max(np.sort(rest)[size - 1] * 4, CLUSTER * values[0])
    weight = 1 / (rest[good] + EPS * values[0])  # the vectors that satisfy the equations best count most
    base = np.linalg.svd(z[:, good] * (weight / weight.max()), full_matrices=False)[0][:, :size]
    inner = base.T @ _times(diagonal, above, base)
    return base @ np.linalg.eigh((inner + inner.T) / 2)[1][:, ::-1]


def _times(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The product ``b.T b`` with columns."""
    y = diagonal[:, None] * z
    y[:-1] += above[:, None] * z[1:]
    out = diagonal[:, None] * y
    out[1:] += above[:, None] * y[:-1]
    return out


def decompose(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and right singular vectors (columns) of a square matrix.

    Values below the rounding error of the largest one are zero, and so are
    their vectors. A zero on the diagonal is replaced by a value that small.
    """
    n = len(r)
    top = np.abs(r).max() if n else 0.0
    if not top:
        return np.zeros(n), np.zeros((n, n))
    diagonal, above, v = bidiagonal(r / top)
    least = EPS * max(np.abs(diagonal).max(), np.abs(above).max() if n > 1 else 0.0) / n
    diagonal = np.where(np.abs(diagonal) < least, least, diagonal)
    values, out = np.zeros(n), np.zeros((n, n))
    # zeros above the diagonal part the matrix
    cuts = np.append(np.flatnonzero(np.abs(above) < least) + 1, n)
    found, begin = [], 0
    for end in cuts.tolist():
        d, b = diagonal[begin:end], above[begin:end - 1]
        of = squares(d, b)
        full = np.zeros((n, end - begin))
        full[begin:end] = vectors(d, b, of)
        found.append((of, full))
        begin = end
    values = np.concatenate([x for x, _ in found])
    out = v @ np.concatenate([z for _, z in found], axis=1)
    order = np.argsort(-values, kind="stable")
    values, out = values[order], out[:, order]
    none = values <= (EPS * n) ** 2 * values[0]
    values[none], out[:, none] = 0.0, 0.0
    return values * top ** 2, out
