"""Chinese-restaurant seating in blocks: the numbers of tables of all dishes of a restaurant, drawn together and exactly.

Given the masses p of its dishes, a restaurant of strength s and discount d whose dish k has n_k customers at t_k tables, T in
all, has probability proportional to s (s + d) ... (s + (T - 1) d) times the product of S(n_k, t_k) p_k ** t_k, where S are the
generalised Stirling numbers of d (they sum over all seatings of n customers at t tables). The rising factorial ties the dishes
together. It is d ** T gamma(s / d + T) / gamma(s / d), an integral over a gamma variable: with g drawn from
gamma(s / d + T), the dishes are independent, and t_k has weights S(n_k, t_k) q_k ** t_k with q_k = d g p_k. Drawing g, then every
t_k, is a Gibbs sampler of the restaurant; a dish's own tables play no part in its draw but through g.

``tables`` draws t for many dishes at once, exactly for any number of customers: by the table of Stirling numbers up to TABLE
customers; beyond, by rejection. The weights are log-concave in t (the polynomials of S have real roots only), so the two lines
through neighbouring values on both sides of the middle lie above them; a value drawn under the lines is accepted by its own
weight. That takes S itself, which a contour integral of its generating function around the branch cut gives to rounding.

``root_masses`` draws the measure of the root restaurant given its seating: the masses of dishes with tables and of the rest are Dirichlet.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

TABLE = 1024
_CELLS = 1 << 20
#: The contour: a hyperbola of this angle, in steps of U from the vertex on.
_ANGLE = 0.45
_U = np.linspace(0, 7.0, 141)


def restaurant_masses(tables_: np.ndarray, strength: float, discount: float, rng: np.random.Generator) -> np.ndarray:
    """d g of each restaurant: what the mass of a dish is multiplied with."""
    return discount * rng.standard_gamma(strength / discount + tables_)


def root_masses(customers: np.ndarray, tables_: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """The masses, not yet divided by the sum of all, of the root's dishes; 0 for those without customers."""
    return rng.standard_gamma(np.maximum(customers - discount * tables_, 0))


@lru_cache(maxsize=8)
def log_stirling(d: float) -> np.ndarray:
    """log S(n, t) for n and t up to TABLE; -inf where t > n or t = 0 < n."""
    out = np.full((TABLE + 1, TABLE + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(TABLE + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(TABLE):
            join = np.where(n > d * t, np.log(np.maximum(n - d * t, 1e-300)), -np.inf)
            out[n + 1] = np.logaddexp(np.concatenate([[-np.inf], out[n, :-1]]), out[n] + join)
    return out


def _few(n: int, q: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    out = np.empty(len(q), dtype=np.int64)
    t = np.arange(1, n + 1)
    base = log_stirling(d)[n, 1 : n + 1]
    step = max(1, _CELLS // n)
    for k in range(0, len(q), step):
        w = base + np.log(q[k : k + step, None]) * t
        w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
        out[k : k + step] = 1 + (w < (rng.random(len(w)) * w[:, -1])[:, None]).sum(axis=1)
    return out


def _log_factorial(x: np.ndarray) -> np.ndarray:
    y = x + 10.0
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return out - np.log(x[:, None] + np.arange(1, 10)).sum(axis=1)


def log_coefficient(n: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log of the coefficient of x ** n in phi(x) ** t, phi(x) = (1 - (1 - x) ** d) / d. S(n, t) is n! / t! times that."""
    out = np.zeros(len(n))
    for k in range(0, len(n), 2048):
        part = slice(k, k + 2048)
        out[part] = _integral(n[part].astype(float), t[part].astype(float), d)
    return np.where(t >= n, np.where(t == n, 0.0, -np.inf), out)


def _slope(s: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Minus the derivative by s of t log phi(exp(-s))."""
    y = -np.expm1(-s)
    return t * d * y ** (d - 1) * np.exp(-s) / np.maximum(-np.expm1(d * np.log(y)), 1e-300)


def _integral(n: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """With x = exp(-s): the integral of phi ** t exp(n s) along a hyperbola around the cut, whose vertex is the saddle point, or near 1 / n where that is closer."""
    low, high = np.full(len(n), -80.0), np.full(len(n), 4.0)
    for _ in range(60):
        mid = (low + high) / 2
        less = _slope(np.exp(mid), t, d) > n
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    s0 = np.maximum(np.exp(high), 0.7 / n)
    step = s0 * 1e-4
    curve = (_slope(s0 - step, t, d) - _slope(s0 + step, t, d)) / (2 * step)
    mu = 2.0 / np.sqrt(np.maximum(curve, 1e-300))
    mu = np.minimum(np.maximum(mu, 0.5 * s0), np.maximum(5.0 / n, s0))
    sin, cos = np.sin(_ANGLE), np.cos(_ANGLE)
    u = _U * np.minimum(1.0, np.arccosh(1 + 60 / (n * mu * sin))[:, None] / _U[-1])
    s = s0[:, None] - mu[:, None] * sin * (np.cosh(u) - 1) + 1j * mu[:, None] * cos * np.sinh(u)
    turn = mu[:, None] * (-sin * np.sinh(u) + 1j * cos * np.cosh(u))
    # far from the cut: the circle itself, as far as the integrand reaches
    circle = s0 > 0.3
    y = _U / _U[-1] * np.minimum(np.pi, 14 / np.sqrt(np.maximum(curve, 1e-300)))[:, None]
    s, turn, u = np.where(circle[:, None], s0[:, None] + 1j * y, s), np.where(circle[:, None], 1j, turn), np.where(circle[:, None], y, u)
    with np.errstate(divide="ignore", invalid="ignore"):
        log = n[:, None] * s + t[:, None] * (np.log(-np.expm1(d * np.log(-np.expm1(-s)))) - np.log(d))
        top = log[:, 0].real
        f = (np.exp(log - top[:, None]) * turn).imag
    total = (f.sum(axis=1) - f[:, 0] / 2 - np.where(circle, f[:, -1] / 2, 0)) * (u[:, 1] - u[:, 0]) / np.pi
    return top + np.log(np.maximum(total, 1e-300))


def _middle(n: np.ndarray, q: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """About the mean and the standard deviation of t: of a compound Poisson process given its sum."""
    low, high = np.full(len(n), -700.0), np.full(len(n), 700.0)  # z = 1 / (1 + exp(-x)); its mean grows with x
    for _ in range(80):
        x = (low + high) / 2
        z, rest = 1 / (1 + np.exp(-x)), 1 / (1 + np.exp(x))
        less = q * z * rest ** (d - 1) < n
        low, high = np.where(less, x, low), np.where(less, high, x)
    rate = q * (1 - rest**d) / d
    spread = rate * np.maximum(1 - (n / rate) ** 2 / (n / rate * (1 + z * (1 - d) / rest)), 0)
    return np.clip(rate, 1, n), np.maximum(np.sqrt(spread), 0.7)


def _geometric(ratio: np.ndarray, m: np.ndarray, u: np.ndarray) -> np.ndarray:
    """k in 0 .. m - 1 with weights ratio ** k, ratio < 1."""
    log = np.log(ratio)
    return np.clip(np.floor(np.log1p(u * np.expm1(m * log)) / log), 0, m - 1)


def _many(n: np.ndarray, q: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    def log_weight(k: np.ndarray, t: np.ndarray) -> np.ndarray:
        return t * np.log(q[k]) - _log_factorial(t) + log_coefficient(n[k], t, d)

    every = np.arange(len(n))
    mean, spread = _middle(n, q, d)
    a = np.clip(np.floor(mean - spread), 1, n - 1)
    b = np.clip(np.ceil(mean + spread), a, n - 1)
    at_a, at_b = log_weight(every, a), log_weight(every, b)
    up, down = log_weight(every, a + 1) - at_a, log_weight(every, b + 1) - at_b  # slopes of the lines on both sides
    while len(bad := np.flatnonzero((up <= 1e-9) & (a > 1))):  # the middle is further left
        a[bad] = np.maximum(np.floor(a[bad] - 2 * spread[bad]), 1)
        at_a[bad] = log_weight(bad, a[bad])
        up[bad] = log_weight(bad, a[bad] + 1) - at_a[bad]
    while len(bad := np.flatnonzero((down >= -1e-9) & (b < n - 1))):
        b[bad] = np.minimum(np.ceil(b[bad] + 2 * spread[bad]), n[bad] - 1)
        at_b[bad] = log_weight(bad, b[bad])
        down[bad] = log_weight(bad, b[bad] + 1) - at_b[bad]
    # the last place of the left line: where the lines meet; 0 without a left line, n without a right one
    with np.errstate(divide="ignore", invalid="ignore"):
        meet = np.floor((at_b - at_a + up * a - down * b) / (up - down))
    meet = np.where(up <= 1e-9, 0, np.where(down >= -1e-9, n, np.clip(meet, 0, n)))
    left = np.where(meet > 0, at_a + up * (meet - a) - np.log(-np.expm1(-np.maximum(up, 1e-9))) + np.log(-np.expm1(np.minimum(-np.maximum(up, 1e-9) * meet, -1e-12))), -np.inf)
    fall = np.minimum(down, -1e-9)
    right = np.where(meet < n, at_b + down * (meet + 1 - b) - np.log(-np.expm1(fall)) + np.log(-np.expm1(np.minimum(fall * (n - meet), -1e-12))), -np.inf)
    share = 1 / (1 + np.exp(np.clip(right - left, -700, 700)))
    out, left_over = np.zeros(len(n), dtype=np.int64), every
    while len(k := left_over):
        on_left = rng.random(len(k)) < share[k]
        u = rng.random(len(k))
        t = np.where(on_left, meet[k] - _geometric(np.exp(-np.maximum(up[k], 1e-9)), np.maximum(meet[k], 1), u), meet[k] + 1 + _geometric(np.exp(fall[k]), np.maximum(n[k] - meet[k], 1), u))
        line = np.where(on_left, at_a[k] + up[k] * (t - a[k]), at_b[k] + down[k] * (t - b[k]))
        taken = np.log(rng.random(len(k))) < log_weight(k, t) - line
        out[k[taken]] = t[taken]
        left_over = k[~taken]
    return out


def tables(n: np.ndarray, q: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with n customers each; 0 or 1 customers need no draw."""
    out = np.minimum(n, 1).astype(np.int64)
    if not len(n):
        return out
    q = np.maximum(np.asarray(q, dtype=float), 1e-12)
    order = np.argsort(n, kind="stable")
    sizes, starts = np.unique(n[order], return_index=True)
    ends = [*starts[1:].tolist(), len(order)]
    for size, a, b in zip(sizes.tolist(), starts.tolist(), ends, strict=True):
        if 1 < size <= TABLE:
            out[order[a:b]] = _few(int(size), q[order[a:b]], d, rng)
    if len(at := np.flatnonzero(n > TABLE)):
        out[at] = _many(n[at].astype(float), q[at], d, rng)
    return out
