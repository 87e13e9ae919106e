"""Fitted terms of the richer scale model: planted ones are found again."""

from __future__ import annotations

import numpy as np
import pytest

from reciprospark.operators import absolute, terms

A = terms.Term("a", (terms.Axis("x", 0.0, 10.0, 3), terms.Axis("y", 0.0, 10.0, 3)), smoothness=1e-9)
B = terms.Term("b", (terms.Axis("z", 0.0, 100.0, 5),), ("wedge",), smoothness=1e-9)
C = terms.Term("c", (terms.Axis("q", 0.0, 1.0, 4), terms.Axis("z", 0.0, 100.0, 2)), ("wedge",), smoothness=1e-9)
D = terms.Term("d", by=("panel_id",))
OBS = "wedge int, panel_id int, x double, y double, z double, q double, reference double, sigma double, intensity double, extra string"


def bend(z, low, points, values):
    return np.interp(z, np.linspace(*low, points), values)


def planted(n=2000, seed=1, noise=0.0):
    rng = np.random.default_rng(seed)
    wedge, panel = rng.integers(0, 2, n), rng.integers(0, 3, n)
    x, y, z, q = rng.uniform(0, 10, n), rng.uniform(0, 10, n), rng.uniform(-5, 105, n), rng.uniform(0, 1, n)
    ref, sigma = rng.uniform(-80, 120, n), rng.uniform(1, 3, n)
    a = bend(x, (0, 10), 3, [0.9, 1.0, 1.1]) * bend(y, (0, 10), 3, [1.0, 1.0, 1.0])
    b = np.where(wedge, bend(z, (0, 100), 5, [1.0, 1.2, 0.8, 1.1, 0.9]), bend(z, (0, 100), 5, [2.0, 1.9, 2.2, 2.0, 1.8]))
    c = bend(q, (0, 1), 4, [5.0, -3.0, 8.0, 0.0]) * np.where(wedge, 1.0, 0.5)
    d = np.array([0.8, 1.0, 1.2])[panel]
    intensity = a * d * (b * ref + c) + noise * rng.normal(size=n) * sigma
    rows = [(int(w), int(p), *map(float, rest), "e") for w, p, *rest in zip(wedge, panel, x, y, z, q, ref, sigma, intensity, strict=True)]
    return rows, (a, b, c, d)


def test_planted_terms_are_found_again(spark):
    rows, truth = planted()
    obs = spark.createDataFrame([*rows, (0, 0, 1.0, 1.0, 1.0, 0.5, None, 1.0, 9e9, "no reference"), (0, 0, 1.0, 1.0, 1.0, 0.5, 1.0, 0.0, 9e9, "no error"), (0, 0, 1.0, 1.0, 1.0, 0.5, 1.0, 1.0, None, "null")], OBS)
    fitted, run = terms.fit(obs, [A, B, C, D], rounds=5)
    assert run["rounds"] == 5 and run["misfits"] == sorted(run["misfits"], reverse=True) and run["misfits"][-1] < 0.05
    got = terms.with_terms(obs.where("extra = 'e'"), [A, B, C, D], fitted)
    found = {r.intensity: r for r in got.collect()}
    off = np.array([[found[row[8]][n] for n in "abcd"] for row in rows])
    a, b, c, d = truth
    scale, offset = np.abs(off[:, 0] * off[:, 1] * off[:, 3] / (a * b * d) - 1), np.abs(off[:, 0] * off[:, 2] * off[:, 3] - a * c * d)
    assert np.median(scale) < 0.003 and scale.max() < 0.05 and np.median(offset) < 0.3 and offset.max() < 6.0
    scaled = absolute.applied(got).select("intensity", "reference").collect()
    assert np.median([abs(r.intensity - r.reference) for r in scaled]) < 0.2
    values = [r.v0 for r in fitted["d"].orderBy("panel_id").collect()]
    assert np.mean(values) == pytest.approx(1.0) and values == pytest.approx([0.8, 1.0, 1.2], rel=2e-2)


def test_one_term_equals_least_squares(spark):
    rows, _ = planted(500, noise=1.0)
    obs = spark.createDataFrame(rows, OBS)
    fitted, _ = terms.fit(obs, [B], rounds=1)
    for w in (0, 1):
        own = [r for r in rows if r[0] == w]
        z, ref, sigma, y = (np.array([r[k] for r in own]) for k in (4, 6, 7, 8))
        at = np.clip(z / 25.0, 0, 4)
        x = np.maximum(0, 1 - np.abs(at[:, None] - np.arange(5))) * (ref / sigma)[:, None]
        normal = x.T @ x
        want = np.linalg.solve(normal + 1e-9 * np.trace(normal) / 5 * terms.penalty([5]), x.T @ (y / sigma))
        got = {r._cell0: (r.v0, r.v1) for r in fitted["b"].where(f"wedge = {w}").collect()}
        assert [v for k in range(4) for v in got[k]] == pytest.approx([v for k in range(4) for v in want[k : k + 2]], rel=1e-6)


def test_smoothness_fills_what_no_observation_touches(spark):
    rows = [(0, 0, 0.0, 0.0, z, 0.5, 100.0, 1.0, 100.0 * (1 + z / 100), "e") for z in (1.0, 10.0, 20.0, 24.0)]
    term = terms.Term("b", (terms.Axis("z", 0.0, 100.0, 5),), smoothness=1e-6)
    fitted, _ = terms.fit(spark.createDataFrame(rows, OBS), [term], rounds=1)
    got = sorted((r._cell0, round(r.v0, 3), round(r.v1, 3)) for r in fitted["b"].collect())
    assert got == [(0, 1.0, 1.25), (1, 1.25, 1.5), (2, 1.5, 1.75), (3, 1.75, 2.0)]
    assert terms.fit(spark.createDataFrame([], OBS), [term, D])[1]["misfits"] == [None]


def test_penalties_and_guards():
    line = np.arange(5.0)
    assert line @ terms.penalty([5]) @ line == pytest.approx(0) and np.ones(6) @ terms.penalty([2, 3]) @ np.ones(6) == pytest.approx(0)
    assert np.array([0, 0, 1.0, 0, 0]) @ terms.penalty([5]) @ np.array([0, 0, 1.0, 0, 0]) == pytest.approx(6)
    for bad in (lambda: terms.Axis("x", 0.0, 1.0, 1), lambda: terms.Axis("x", 1.0, 1.0, 2), lambda: terms.Term("e"), lambda: terms.fit(None, []), lambda: terms.fit(None, [D, D])):
        with pytest.raises(ValueError):
            bad()
