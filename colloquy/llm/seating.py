"""Chinese-restaurant seating: numbers of tables and the draws that they depend on.

Given the weight a of opening one more table, the c customers of one dish sit at t tables with
probability in proportion to S(c, t) * a**t, S being generalised Stirling numbers for the discount.
All random numbers come from hashes of what is drawn and the number of the sweep, so that a
task that is run again draws the same, wherever it runs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Up to so many customers the Stirling numbers are tabulated; beyond, the same law is evaluated from its generating function.
EXACT = 1024
#: Where 1 - z of the law's saddle point is below this, one table may hold most customers, and the law follows from the one at EXACT.
NEAR_ONE = 1e-4
_TIERS = ((3, 4), (5, 8), (9, 32), (33, 128), (129, EXACT))


@lru_cache(maxsize=8)
def log_stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """log S(c, t) for c, t up to size; row and column 0 stand for 0."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(size + 1)
    for c in range(1, size):
        stay = np.log(np.maximum(c - t * discount, 1e-300))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:] + out[c, 1:])
        out[c + 1, c + 2 :] = -np.inf
    return out


def _finish(z: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two 64-bit numbers each."""
    z = _finish(first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return _finish(z + second.view(np.uint64)).view(np.int64)


def uniforms(keys: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys and the number of a stream."""
    z = _finish(keys.view(np.uint64) + np.uint64((stream + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def gammas(shapes: np.ndarray, keys: np.ndarray, stream: int) -> np.ndarray:
    """Gamma draws of the given shapes (Marsaglia and Tsang, 2000)."""
    shapes = np.asarray(shapes, float)
    low = shapes < 1
    d = np.where(low, shapes + 1, shapes) - 1 / 3
    out, left = d.copy(), np.arange(len(d))
    for attempt in range(24):
        if not len(left):
            break
        k, at = keys[left], d[left]
        u = [uniforms(k, (stream * 32 + attempt) * 4 + j) for j in range(3)]
        x = np.sqrt(-2 * np.log(u[0])) * np.cos(2 * np.pi * u[1])
        v = np.maximum(1 + x / np.sqrt(9 * at), 0) ** 3
        with np.errstate(divide="ignore"):
            good = (v > 0) & (np.log(u[2]) < x**2 / 2 + at - at * v + at * np.log(v))
        out[left[good]] = (at * v)[good]
        left = left[~good]
    boost = uniforms(keys[low], (stream * 32 + 31) * 4) ** (1 / np.maximum(shapes[low], 1e-9))
    out[low] *= boost
    return out


def _shrink(c: np.ndarray, discount: float) -> np.ndarray:
    """The factor on the weight of the law at EXACT customers that gives the law at c: about (EXACT / c) ** discount."""
    shift = 1.5 * discount + 0.5
    return ((EXACT - shift) / (np.maximum(c, EXACT) - shift)) ** discount


def _log_factorial(t: np.ndarray) -> np.ndarray:
    """log t! for t from 1 on, by Stirling's series above 16."""
    x = np.maximum(t, 17.0)
    series = x * np.log(x) - x + np.log(2 * np.pi * x) / 2 + 1 / (12 * x) - 1 / (360 * x**3)
    exact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 17)))])
    return np.where(t > 16, series, exact[np.minimum(t, 16).astype(int)])


def _inverse(values: np.ndarray, log_law: np.ndarray, u: float) -> float:
    law = np.exp(log_law - log_law.max()).cumsum()
    return float(values[min(int((law < u * law[-1]).sum()), len(values) - 1)])


def _poisson(mean: float, u: float) -> float:
    """A Poisson draw by inversion, over all values within ten standard deviations."""
    reach = 10 * np.sqrt(mean) + 20
    k = np.arange(max(0.0, np.floor(mean - reach)), np.ceil(mean + reach) + 1)
    return _inverse(k, k * np.log(max(mean, 1e-300)) - _log_factorial(k), u)


def _log_one_minus(t: np.ndarray, c: float, d: float, start: float) -> np.ndarray:
    """log(1 - z) at the saddle point of ((1 - (1 - z)**d) / d)**t / z**c, by Newton steps kept within bounds."""
    q = np.full(len(t), start)
    low, high = np.full(len(t), -700.0), np.full(len(t), -1e-12)
    for _ in range(40):  # t d z (1 - z)**(d - 1) / (1 - (1 - z)**d), the mean of the summed sizes, falls with log(1 - z)
        off = np.log(t * d) + np.log(-np.expm1(q)) + (d - 1) * q - np.log(-np.expm1(d * q)) - np.log(c)
        low, high = np.where(off > 0, q, low), np.where(off > 0, high, q)
        slope = np.exp(q) / np.expm1(q) + (d - 1) - d * np.exp(d * q) / np.expm1(d * q)
        to = q - off / slope
        to = np.where((to > low) & (to < high), to, (low + high) / 2)
        if np.abs(to - q).max() < 1e-11 * np.abs(q).max():
            break
        q = to
    return q


def _many(c: float, a: float, u: float, d: float) -> float:
    """A draw where no table holds most customers: the law from saddle points of its generating function.

    The tables' sizes are independent given that they sum to c, with (1 - (1 - z)**d) / d as generating function of one.
    """
    low, high = -80.0, 0.0
    for _ in range(60):  # the saddle point over all t gives the centre
        q = (low + high) / 2
        above = np.log(a) + np.log(-np.expm1(q)) + (d - 1) * q > np.log(c)
        low, high = (q, high) if above else (low, q)
    centre = a / d * -np.expm1(d * q)
    reach = 8 * np.sqrt(centre) + 10
    t = np.arange(max(1.0, np.floor(centre - reach)), min(c, np.ceil(centre + reach)) + 1)
    q = _log_one_minus(t, c, d, float(q))
    one, z = -np.expm1(d * q), -np.expm1(q)
    size = d * z * np.exp((d - 1) * q) / one  # mean size of a table, and its derivative by log z
    spread = size * (1 + (1 - d) * z / np.exp(q) - size)
    law = t * (np.log(a) + np.log(one / d)) - _log_factorial(t) - c * np.log(z) - np.log(np.maximum(t * spread, 1e-300)) / 2
    return _inverse(t, law, u)


def tables(c: np.ndarray, a: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """One draw of the number of tables for each dish: customers c, weights a, uniform numbers u.

    With r(c, t) = S(c, t) / S(c, 1) the recursion is r(c + 1, t) - r(c, t) = (r(c, t - 1) - (t - 1) d r(c, t)) / (c - d).
    Where one table may hold most customers it solves to this: t at c is t at EXACT with weight a s, s = (EXACT / c) ** d, plus
    Poisson(a (1 - s) / d) more. Other dishes of many customers are drawn from saddle points (_many). Both agree with
    the recursion to a total variation of less than one in a hundred.
    """
    stirling = log_stirling(discount)
    out = np.minimum(c, 1).astype(np.float64)
    shrink = _shrink(c, discount)
    few = (c > EXACT) & (np.log(np.maximum(a, 1e-300) / np.maximum(c, 1)) < (1 - discount) * np.log(NEAR_ONE))
    log_a = np.log(np.maximum(a * shrink, 1e-300))
    pair = c == 2
    out[pair] += u[pair] * (1 - discount + a[pair]) > 1 - discount  # S(2, 1) = 1 - d and S(2, 2) = 1
    for low, high in _TIERS:
        rows = np.flatnonzero((c >= low) & (c <= high) | (few if high == EXACT else False))
        t = np.arange(1, high + 1)
        step = max(64, 400_000 // high)
        for start in range(0, len(rows), step):
            at = rows[start : start + step]
            law = stirling[np.minimum(c[at], EXACT), 1 : high + 1] + t * log_a[at, None]
            law = np.exp(law - law.max(axis=1, keepdims=True)).cumsum(axis=1)
            out[at] = np.minimum(1 + (law < (u[at] * law[:, -1])[:, None]).sum(axis=1), c[at])
    for k in np.flatnonzero(c > EXACT):
        if few[k]:
            second = uniforms(np.array([int(u[k] * (1 << 62))]), 7)[0]
            out[k] += _poisson(a[k] * (1 - shrink[k]) / discount, second)
        else:
            out[k] = _many(float(c[k]), float(a[k]), float(u[k]), discount)
    return out
