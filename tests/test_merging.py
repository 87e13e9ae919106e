from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from reciprospark.operators import absolute, counts, merging, orchestration, pixels, quantiles, scaling, symmetry
from reciprospark.operators import grid as grids

OBS = "voxel_idx long, still_id int, intensity double, sigma double"
IDENTITY = ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))


def one(spark, rows, method="inverse_variance"):
    return merging.merged(spark.createDataFrame(rows, OBS), method).first()


def test_weighted_merge_values(spark):
    rows = [(0, 1, 100.0, 10.0), (0, 2, 120.0, 5.0), (0, 3, 80.0, 20.0)]
    got = one(spark, rows)
    assert got.I_merged_relative == pytest.approx(114.2857142857) and got.Sigma_merged_relative == pytest.approx(4.3643578047)
    got = one(spark, rows, "uniform")
    assert got.I_merged_relative == pytest.approx(100.0) and got.Sigma_merged_relative == pytest.approx(7.6376261583)
    with pytest.raises(ValueError, match="weight method"):
        one(spark, rows, "other")


def test_scaled_merge(spark):
    rows = [(0, 1, 100.0, 10.0), (0, 2, 120.0, 12.0), (1, 1, 80.0, 8.0)]
    model = scaling.ScaleModel({1: 1.1, 2: 1.2})
    got = {r.voxel_idx: r for r in merging.merged(scaling.applied(model.scaled(spark.createDataFrame(rows, OBS)))).collect()}
    assert got[0].I_merged_relative == pytest.approx(95.0226244344) and got[0].Sigma_merged_relative == pytest.approx(6.7267279400)
    assert got[1].I_merged_relative == pytest.approx(72.7272727273) and got[1].num_observations == 1


def test_outlier_goes_and_small_voxels_stay(spark):
    rows = [(0, 1, 100.0 / 1.1, 9.0), (0, 1, 100.0, 10.0), (0, 1, 1000.0 / 1.1, 90.0), (1, 1, 1.0, 1.0), (1, 1, 900.0, 1.0)]
    kept = merging.without_outliers(spark.createDataFrame(rows, OBS), 2.0)
    assert sorted(r.intensity for r in kept.collect()) == pytest.approx([1.0, 100.0 / 1.1, 100.0, 900.0])


def test_equal_values_survive_a_spread_of_zero(spark):
    rows = [(0, 1, 5.0, 1.0)] * 4 + [(0, 1, 6.0, 1.0)]
    assert merging.without_outliers(spark.createDataFrame(rows, OBS)).count() == 4


def test_refinement_finds_the_ratio_of_the_scales(spark):
    rows = [(0, 0, 80.0, 10.0), (0, 1, 120.0, 10.0), (1, 0, 120.0, 12.0), (1, 1, 180.0, 12.0)]
    obs = spark.createDataFrame(rows, OBS)
    model, info = scaling.refined(obs, scaling.ScaleModel.start([0, 1]), rounds=20, tolerance=1e-4, shift_tolerance=1e-4)
    assert info["initial_r_factor"] == pytest.approx(0.2)
    assert model.stills[0] / model.stills[1] == pytest.approx(2 / 3) and info["r_factor"] < 1e-9 and info["converged"] and info["n_iterations"] == 5
    assert model.stills[0] == pytest.approx(0.76923077, abs=1e-6)


def test_smoother_derivatives_and_refinement(spark):
    s = scaling.Smoother((1.0, 1.3), 0.1, 1.0)
    assert s.at(-1.0) == 1.0 and s.at(0.1) < s.at(1.0)
    rows = [(v, k, (100.0 + 10 * v) * (1 + 0.3 * k) * (1 + 0.1 * q), 10.0, q) for v in range(6) for k in range(2) for q in (0.2, 0.5, 0.9)]
    obs = spark.createDataFrame(rows, OBS + ", q double")
    _, info = scaling.refined(obs, scaling.ScaleModel.start([0, 1], scaling.Smoother((1.0, 1.0), 0.1, 1.0)), rounds=6)
    assert info["r_factor"] < 0.3 * info["initial_r_factor"]


def test_model_guards():
    with pytest.raises(ValueError, match="components"):
        scaling.ScaleModel.start([1], components=["panel"])
    with pytest.raises(ValueError, match="control points"):
        scaling.Smoother((1.0,) * 6, 0.1, 1.0)
    with pytest.raises(ValueError, match="empty"):
        scaling.Smoother((1.0, 1.0), 1.0, 0.1)
    with pytest.raises(ValueError, match="unknown"):
        scaling.ScaleModel({1: 1.0}).with_scale(2, 1.0)


def test_unknown_still_has_scale_one(spark):
    rows = scaling.ScaleModel({1: 2.0}).scaled(spark.createDataFrame([(0, 1, 1.0, 1.0), (0, 999, 1.0, 1.0)], OBS)).collect()
    assert {r.still_id: r.scale for r in rows} == {1: 2.0, 999: 1.0}


def test_merge_statistics_of_a_map_and_of_nothing(spark):
    rows = [(0, 100.0, 10.0, 3, 0.17), (1, 200.0, 20.0, 5, 0.35), (2, 150.0, 15.0, 2, 0.52)]
    df = spark.createDataFrame(rows, "voxel_idx long, I_merged_relative double, Sigma_merged_relative double, num_observations long, q_magnitude_center double")
    got = merging.merge_statistics(df).first()
    assert got.i_mean == 150 and got.obs_total == 10
    got = merging.merge_statistics(df.limit(0)).first()
    assert got.n_voxels == 0 and got.i_mean is None and got.obs_total == 0


def test_index_round_trip_and_bounds(spark):
    g = grids.Grid(IDENTITY, (2, 3, 1), (-4, -3, -2), (4, 5, 6))
    rows = [(i, h / 2, k / 3, float(l)) for i, (h, k, l) in enumerate((h, k, l) for h in range(-4, 5) for k in range(-3, 6) for l in range(-2, 7))]
    obs = spark.createDataFrame([*rows, (9999, 10.0, 10.0, 10.0)], "id long, qx double, qy double, qz double")
    got = grids.with_centres(grids.binned(obs, g), g).collect()
    assert len(got) == len(rows) == g.total_voxels == len({r.voxel_idx for r in got})
    assert all(math.isclose(r.H_center, r.qx) and math.isclose(r.K_center, r.qy) and math.isclose(r.L_center, r.qz) for r in got)


def test_grid_errors(spark):
    obs = spark.createDataFrame([(0.1, 0.1, 0.1)], "qx double, qy double, qz double")
    with pytest.raises(ValueError, match="no observation"):
        grids.fit(obs, IDENTITY, (1, 1, 1), 100.0, 200.0)
    with pytest.raises(ValueError, match="limits"):
        grids.fit(obs, IDENTITY, (1, 1, 1), 2.0, 1.0)
    with pytest.raises(ValueError, match="positive"):
        grids.Grid(IDENTITY, (0, 1, 1), (0, 0, 0), (1, 1, 1))
    g = grids.fit(obs, IDENTITY, (1, 1, 1))
    assert grids.Grid.from_json(g.to_json()) == g


def test_misorientation_limit(spark):
    def crystals(degrees):
        rows = []
        for k, a in enumerate(map(math.radians, degrees)):
            rows.append((k, 10.0, 15.0, 20.0, 90.0, 90.0, 90.0, [math.cos(a), -math.sin(a), 0.0, math.sin(a), math.cos(a), 0.0, 0.0, 0.0, 1.0]))
        return spark.createDataFrame(rows, "still_id int, a double, b double, c double, alpha double, beta double, gamma double, u array<double>")

    with pytest.raises(ValueError, match="spread"):
        grids.check_spread(crystals([0, 15, 20]))
    assert grids.check_spread(crystals([0, 0.5, 1.0]))[1] is False
    assert grids.check_spread(crystals([0, 1.9]))[1] is True
    a = grids.setting_matrix(crystals([0.0, 0.0]))
    assert a[0][0] == pytest.approx(0.1) and a[1][1] == pytest.approx(1 / 15) and a[2][2] == pytest.approx(0.05)


def test_symmetry_mates_meet(spark):
    from reciprospark.operators import symmetry

    df = spark.createDataFrame([(1.1, 2.3, 3.7), (-1.1, 2.3, -3.7)], "h double, k double, l double")
    assert symmetry.reduced(df, symmetry.operations("P2")).distinct().count() == 1
    assert symmetry.reduced(df, symmetry.operations("P1")).distinct().count() == 2
    last = symmetry.reduced(df, symmetry.operations("P2"), "l1_last").collect()
    assert [r.h for r in last] == [-1.1, 1.1]


def test_nested_round_trip(spark):
    rows = [(0, 1, 1.0, 0.1), (0, 2, 2.0, 0.2), (5, 1, 3.0, 0.3)]
    flat = spark.createDataFrame(rows, OBS)
    back = merging.flattened(merging.nested(flat)).select("voxel_idx", "still_id", "intensity", "sigma")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_centres_of_large_indices(spark):
    g = grids.Grid(IDENTITY, (1, 1, 1), (0, 0, 0), ((1 << 20) - 1, (1 << 20) - 1, (1 << 22) - 1))
    index = 1048570 * (1 << 40) + (1 << 40) - 1
    got = grids.with_centres(spark.createDataFrame([(index,)], "voxel_idx long"), g).first()
    assert (got.H_center, got.K_center, got.L_center) == ((1 << 20) - 1, (1 << 20) - 1, 1048570)


def test_still_ids_are_whole_longs(spark):
    ids = [5_000_000_000, 7]
    obs = spark.createDataFrame([(0, s, 1.0, 1.0) for s in ids], "voxel_idx long, still_id long, intensity double, sigma double")
    few, many = scaling.ScaleModel({ids[0]: 2.0}), scaling.ScaleModel({ids[0]: 2.0} | {k: 1.0 for k in range(10**6, 10**6 + 600)})
    assert [{r.still_id: r.scale for r in m.scaled(obs).collect()} for m in (few, many)] == [{ids[0]: 2.0, 7: 1.0}] * 2


def test_steps_equal_the_whole_normal_equations(spark):
    rng = np.random.default_rng(0)
    n, p = 6, 3
    model = scaling.ScaleModel.start(range(n), scaling.Smoother((1.0, 1.1, 0.9), 0.1, 1.0))
    j = rng.normal(size=(60, n + p)) * np.concatenate([np.eye(n)[rng.integers(0, n, 60)], np.ones((60, p))], axis=1)
    r, still = rng.normal(size=60), (j[:, :n] != 0).argmax(1)
    rows = []
    for s in range(n):
        a, k, e = j[still == s, s], j[still == s, n:], r[still == s]
        row = {"still_id": s, "jj": float(a @ a), "jr": float(a @ e)} | {f"kr{i}": float(k[:, i] @ e) for i in range(p)} | {f"jk{i}": float(a @ k[:, i]) for i in range(p)} | {f"kk{i}_{o}": float(k[:, i] @ k[:, o]) for i in range(p) for o in range(i, p)}
        rows.append(Row(**row))
    shift = np.linalg.solve(j.T @ j + scaling.DAMPING * np.eye(n + p), -j.T @ r)
    scales = spark.createDataFrame([*model.stills.items(), (99, 3.0)], "still_id long, b double")  # one without observations
    sums = spark.createDataFrame([Row(**(r.asDict() | {"off": 1.0, "total": 2.0})) for r in rows])
    got, found = scaling.stepped(sums, scaling.ScaleTable(scales, model.smoother))
    after = {r.still_id: r.b for r in got.scales.collect()}
    most = found["shift"]
    assert after.pop(99) == 3.0 and (found["n"], found["off"], found["total"]) == (n, n, 2 * n)
    assert np.array([*[after[s] for s in range(n)], *got.smoother.values]) == pytest.approx(np.array([*[1.0] * n, 1.0, 1.1, 0.9]) + shift) and most == pytest.approx(np.abs(shift).max())


def test_point_groups():
    sizes = {"P 1": 1, "C 1 2 1": 2, "P 1 1 2": 2, "P 21 21 21": 4, "I 41": 4, "P 43 21 2": 8, "P 31": 3, "H 3 2": 6, "P 31 1 2": 6, "P 65": 6, "P 61 2 2": 12, "I 21 3": 12, "F 41 3 2": 24}
    assert {g: len(symmetry.operations(g)) for g in sizes} == sizes
    assert all(round(np.linalg.det(np.array(m))) == 1 for g in sizes for m in symmetry.operations(g))
    with pytest.raises(ValueError, match="no operations"):
        symmetry.operations("P 5")
    with pytest.raises(ValueError, match="no symmetry operation"):
        symmetry.parsed(["x,y"])


#: Orders of the point groups of some symbols, all 32 classes among them.
ORDERS = {
    1: "P 1", 2: "P -1,P 2,P 21,C 2,P m,P c,C c,P 1 21 1,P 1 1 m", 3: "P 3,P 31,R 3", 4: "P 2/m,P 21/c,P 1 21/c 1,C 2/c,P21/c,C2/m,P 2 2 2,P 21 21 2,P m m 2,P n a 21,Pna21,P b c 21,P 4,I 41,P -4,I -4",
    6: "P -3,R -3,P 3 2 1,P 31 1 2,R 3 2,P 3 m 1,R 3 c,R3c,P 3 1 m,P 6,P 65,P -6", 8: "P m m m,P n m a,Pnma,P b c a,F d d d,P 4/m,I 41/a,I41/a,P 4 2 2,P 43 21 2,P 4 m m,P 42 m c,I 41 c d,P -4 2 m,P -4 21 m,P-421m,I -4 2 d,I-42d,P -4 m 2",
    12: "P -3 1 m,P -3 m 1,R -3 c,R-3c,P 6/m,P 63/m,P 6 2 2,P 61 2 2,P 6 m m,P 63 m c,P -6 m 2,P -6 2 c,P-62c,P 2 3,I 21 3", 16: "P 4/m m m,P 42/n c m,I 41/a m d,I41/amd",
    24: "P 6/m m m,P 63/m m c,P63/mmc,P m -3,I a -3,Pm-3,P 4 3 2,F 41 3 2,P -4 3 m,F -4 3 c,I -4 3 d,F-43m", 48: "P m -3 m,F d -3 m,Fd-3m,I a -3 d",
}


def test_point_groups_with_mirrors_and_inversions():
    for order, groups in ORDERS.items():
        for group in groups.split(","):
            ops = symmetry.operations(group)
            assert len(ops) == order and all(abs(round(np.linalg.det(np.array(m)))) == 1 for m in ops), group
            assert {tuple(map(tuple, (np.array(a) @ np.array(b)).tolist())) for a in ops for b in ops} == set(ops), group
    centred = {g: symmetry.negative(IDENTITY) in {tuple(tuple(map(float, r)) for r in m) for m in symmetry.operations(g)} for g in ("P -1", "P m", "P 2/m", "P -4", "P 4/m", "P -6", "R -3", "P m -3", "P -4 3 m", "P n m a", "P n a 21")}
    assert [g for g, yes in centred.items() if yes] == ["P -1", "P 2/m", "P 4/m", "R -3", "P m -3", "P n m a"]
    for bad in ("P 7", "Q m", "", "P 2 2", "P 5 m", "P x y z w", "P 3 3 3 3"):
        with pytest.raises(ValueError):
            symmetry.operations(bad)


def test_indices_turn_by_the_transposed_matrices():
    """In hexagonal axes only they keep |q|, which a metric of a = b = 3, c = 5 and gamma = 120 gives."""
    a = np.array([[3.0, -1.5, 0.0], [0.0, 3.0 * np.sqrt(0.75), 0.0], [0.0, 0.0, 5.0]])
    metric = np.linalg.inv(a.T @ a)
    h = np.array([1.0, 2.0, 3.0])
    length = lambda op: (np.array(op) @ h) @ metric @ (np.array(op) @ h)
    for group in ("P 3", "P 6/m", "P 63/m m c", "P 3 2 1", "R -3 c"):
        ops = symmetry.operations(group)
        assert [length(op) for op in symmetry.for_indices(ops)] == pytest.approx([h @ metric @ h] * len(ops))
        assert max(abs(length(op) - h @ metric @ h) for op in ops) > 0.01
    assert {*symmetry.for_indices(symmetry.operations("P 4/m m m"))} == {*symmetry.operations("P 4/m m m")}


def test_settings_of_each_crystal(spark):
    cell = (10.0, 12.0, 15.0, 80.0, 95.0, 110.0)
    turn = [0.6, -0.8, 0.0, 0.8, 0.6, 0.0, 0.0, 0.0, 1.0]
    got = grids.with_settings(spark.createDataFrame([(*cell, turn)], "a double, b double, c double, alpha double, beta double, gamma double, u array<double>")).first().setting
    assert np.array(got).reshape(3, 3) == pytest.approx(np.array(turn).reshape(3, 3) @ grids.reciprocal_basis(cell))


def test_mates_are_one_reflection(spark):
    ops = symmetry.operations("P 43 21 2")
    mates = symmetry.mates(spark.createDataFrame([(1.0, 2.0, 3.0)], "h double, k double, l double"), ops)
    assert mates.count() == 8 and symmetry.reduced(mates, ops).select("h", "k", "l").distinct().count() == 1


def test_form_factors_at_rest_count_electrons(spark):
    row = spark.range(1).select(*[absolute.form_factor(e, F.lit(0.0)).alias(e) for e in absolute.ATOMS]).first()
    assert all(row[e] == pytest.approx(z, abs=0.03) for e, (z, _) in absolute.ATOMS.items())


def test_divergence_finds_the_voxel_with_peaks(spark):
    g = grids.Grid(IDENTITY, (1, 1, 1), (0, 0, 0), (9, 0, 0))
    rng = np.random.default_rng(3)
    rows = [(v, int(c)) for v in range(10) for c in rng.poisson(4, 400)] + [(5, 200)] * 40
    hist = counts.histogram(spark.createDataFrame(rows, "voxel_idx long, count int"))
    found = {r.voxel_idx: r.divergence for r in counts.divergence(hist, g).collect()}
    assert max(found[v] for v in (0, 1, 2, 8, 9)) < 0.1 < min(found[v] for v in (4, 5, 6))


def test_counts_beyond_the_bins_are_judged(spark):
    grid = grids.Grid(IDENTITY, (1, 1, 1), (0, 0, 0), (9, 9, 9))
    pixels_ = spark.createDataFrame([(5, 300), (5, 400), (7, 2), (7, 3)], "voxel_idx long, count int")
    found = [counts.outlying(counts.histogram(pixels_), counts.overflow(pixels_), grid, 1e9, most).collect() for most in (0.0, 699.0, 700.0)]
    assert [[r.voxel_idx for r in x] for x in found] == [[5], [5], []]


def test_batch_goes_on_after_a_failure(spark):
    images = spark.createDataFrame([(0, 0, 2, 2, [1.0, 2.0, 3.0, 4.0], 0.0), (1, 0, 2, 2, [1.0], None), (2, 0, 2, 2, None, 0.1)], "image_id int, panel_id int, n_slow int, n_fast int, data array<double>, increment double")
    obs, out = orchestration.process_batch(images, pixels.Panel((0.0, 0.0, 100.0)), pixels.Beam(1.0))
    assert obs.count() == 4 and {r.image_id: (r.route, r.status, r.error_code, r.n_observations) for r in out.collect()} == {0: ("stills", "SUCCESS", None, 4), 1: ("sequence", "FAILURE", "ProcessingError", 0), 2: ("sequence", "FAILURE", "InputFileError", 0)}


def test_quantiles_by_narrowing(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(size=3000), [7.0] * 900, [1e12, -1e12, 1e-300]])
    rows = spark.createDataFrame([(k % 2, float(v)) for k, v in enumerate(values)] + [(0, float("nan")), (1, None)], "key long, value double")
    shares = [0.0, 0.01, 0.5, 0.75, 0.999, 1.0]
    for most in (10, 10**6):
        got = quantiles.by_key(rows, shares, most)
        for k in (0, 1):
            assert got[k] == pytest.approx(np.quantile(values[k::2], shares).tolist())
        assert quantiles.of(rows, "value", [0.5], most) == pytest.approx([float(np.median(values))])
    assert quantiles.of(rows.limit(0), "value", [0.5, 0.9]) == [None, None]


def test_crowded_voxels_are_judged_alike(spark):
    rng = np.random.default_rng(7)
    rows = [(int(v), k % 3, float(x), 1.0) for k, (v, x) in enumerate(zip(rng.integers(0, 4, 600) ** 2 // 3, rng.standard_cauchy(600), strict=True))] + [(77, 0, 5.0, 1.0)] * 60 + [(77, 0, 6.0, 1.0)]
    obs = spark.createDataFrame(rows, OBS)
    one, other = (sorted(map(tuple, merging.without_outliers(obs, 3.0, hot).collect())) for hot in (50, 10**6))
    assert one == other and 0 < len(one) < len(rows)


def plain_rejection(rows, threshold, least):
    """What is kept, by the rule in plain numpy."""
    out, voxels = [], {}
    for r in rows:
        voxels.setdefault(r[0], []).append(r)
    for own in voxels.values():
        x = np.array([np.nan if r[2] is None else r[2] for r in own])
        with np.errstate(invalid="ignore"):
            off = np.abs(x - np.median(x))
            keep = off <= threshold * 1.4826 * np.median(off)
        if len(own) >= least:
            out += own if len(own) <= 2 or not keep.any() else [r for r, k in zip(own, keep, strict=True) if k]
    return sorted(map(str, out))


@pytest.mark.parametrize("hot", [2, 5, 10**6])
def test_one_rule_for_voxels_of_all_sizes(spark, hot):
    nan, inf = math.nan, math.inf
    cases = [[nan] * 4, [1.0, 2.0, 1.5, None, 90.0], [1.0, 2.0, 3.0, nan, 500.0], [inf] * 3, [1.0, 2.0, 3.0, inf], [1.0, inf, inf, inf, 2.0], [-inf, -inf, inf, inf], [-inf, 1.0, 2.0, 3.0, inf], [5.0, 5.0, 5.0, 6.0], [1.0], [1.0, 99.0], [None] * 3, [0.0, -0.0, 0.0, 1e-300], [1.0, 3.0] * 3, [1e308, -1e308, 1.7e308, 1.0]]
    rng = np.random.default_rng(5)
    cases += [list(map(float, np.round(rng.standard_cauchy(n), 1))) for n in (3, 4, 7, 8, 25, 26, 400)]
    rows = [(v, k % 3, x, 1.0) for v, own in enumerate(cases) for k, x in enumerate(own)]
    obs = spark.createDataFrame(rows, OBS)
    for threshold, least in ((3.0, 1), (0.1, 4)):
        assert sorted(str(tuple(r)) for r in merging.without_outliers(obs, threshold, hot, least).collect()) == plain_rejection(rows, threshold, least)


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_a_store_is_dealt_by_voxel(spark, tmp_path):
    from reciprospark.sources import store

    path = str(tmp_path / "store")
    rng = np.random.default_rng(2)
    rows = [(int(v), k % 5, float(x), 1.0) for k, (v, x) in enumerate(zip(rng.integers(0, 200, 4000), rng.normal(size=4000), strict=True))]
    first = store.create(spark.createDataFrame(rows[:3000], OBS), path, 16)
    assert first.count() == 3000
    both = store.append(spark.createDataFrame([(*r[:3], 1, r[3]) for r in rows[3000:]], "voxel_idx long, still_id int, intensity double, extra int, sigma double"), path)
    store.forget(spark, path)
    again = store.opened(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(rows) and both.columns == again.columns
    assert exchanges(again.groupBy("voxel_idx").count()) == 0 and exchanges(merging.merged(again)) == 0 and exchanges(merging.without_outliers(again)) == 0
    found = store.lookup(spark, path, 17)
    assert sorted(map(tuple, found.collect())) == sorted(r for r in rows if r[0] == 17)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # only then the plan says which buckets are read
    assert "SelectedBucketsCount: 1 out of 16" in store.lookup(spark, path, 17)._jdf.queryExecution().explainString(mode)
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert sorted(map(tuple, store.lookup(spark, path, 17, 3).collect())) == sorted(r for r in rows if r[0] in (3, 17)) and store.lookup(spark, path).count() == 0
    store.forget(spark, path)


def test_refinement_of_scales_in_a_table(spark):
    rng = np.random.default_rng(4)
    rows = [(v, s, (50.0 + v) * (0.5 + 0.01 * s), 5.0) for v in range(30) for s in rng.choice(90, 40, replace=False).tolist()]
    obs = spark.createDataFrame(rows, OBS)
    model, info = scaling.refine(obs, scaling.ScaleTable.start(obs), rounds=12)
    got = {r.still_id: r.b for r in scaling.relative(model.scales).collect()}
    mean = np.mean([0.5 + 0.01 * s for s in got])
    assert got == pytest.approx({s: (0.5 + 0.01 * s) / mean for s in got}, rel=1e-4) and info["r_factor"] < 1e-5 < info["initial_r_factor"]
    as_numbers, same = scaling.refined(obs, scaling.ScaleModel.start(got), rounds=12)
    assert {k: as_numbers.stills[k] for k in got} == pytest.approx({r.still_id: r.b for r in model.scales.collect()}) and same["r_factor"] == pytest.approx(info["r_factor"], abs=1e-9)
    assert scaling.refine(obs.limit(0), scaling.ScaleTable.start(obs))[1]["stopped_by"] == "empty"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_the_nearest_control_points_count(spark, n):
    values = (1.0, 1.4, 0.7, 1.1, 0.9)[:n]
    smoother = scaling.WindowedSmoother(values, 0.2, 1.4)
    spacing = 1.2 / max(1, n - 2 if n >= 4 else n - 1)
    points = np.array([0.2 + spacing * (k - (0.5 if n >= 4 else 0.0)) for k in range(n)])
    assert smoother.points == pytest.approx(points.tolist())
    places = [-1.0, 0.2, 0.31, 0.61, 0.81, 0.95, 1.21, 1.4, 9.0]
    rows = spark.createDataFrame([(q,) for q in places], "q double").select("q", smoother.column(F.col("q")).alias("a"), *[w.alias(f"w{k}") for k, w in enumerate(smoother.weights(F.col("q")))]).collect()
    for r in rows:
        x = min(max(r.q, 0.2), 1.4)
        near = np.argsort(np.abs(points - x), kind="stable")[:3]
        w = np.where(np.isin(np.arange(n), near), np.exp(-(((x - points) / (0.65 * spacing)) ** 2)), 0.0)
        assert r.a == pytest.approx(w @ values / w.sum()) == pytest.approx(smoother.at(r.q))
        assert [r[f"w{k}"] for k in range(n)] == pytest.approx((w / w.sum()).tolist())
