from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reciprospark.functions import air, corrections
from reciprospark.operators import masks, pixels, validation
from reciprospark.sources import headers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_closed_forms(spark):
    lab = [F.lit(100.0), F.lit(50.0), F.lit(200.0)]
    sa = corrections.solid_angle_factor(corrections.solid_angle(lab, (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), 0.172, 0.172))
    assert value(spark, sa) == pytest.approx(2033068.753, abs=0.01)
    assert air.air_attenuation(12000.0) == pytest.approx(5.661618566e-4) and air.air_density(273.15) == pytest.approx(6.542880931e-4)
    assert value(spark, corrections.air_factor(lab, 1.0)) == pytest.approx(1.000123573611, abs=1e-10)
    f = corrections.analytic_45(200.0, 0.172)
    assert value(spark, corrections.total_factor(f)) == pytest.approx(5408328.8266, abs=0.01) and value(spark, f["lp"]) == pytest.approx(2.0)


def test_q_vector(spark):
    q = pixels.q_vector([F.lit(100.0), F.lit(50.0), F.lit(200.0)], pixels.Beam(1.0))
    got = [value(spark, c) for c in q]
    assert got == pytest.approx([2.74220688, 1.37110344, 11.76759907])
    assert value(spark, pixels.q_length([F.lit(100.0), F.lit(50.0), F.lit(200.0)], pixels.Beam(1.0))) == pytest.approx(12.16042808)
    assert value(spark, pixels.d_spacing(F.lit(12.16042808))) == pytest.approx(0.51669113) and math.isinf(value(spark, pixels.d_spacing(F.lit(0.0))))


def test_air_scales_with_pressure_and_temperature():
    mu = air.air_attenuation(12000.0)
    assert air.air_attenuation(12000.0, pressure_atm=2.0) == pytest.approx(2 * mu) and air.air_attenuation(12000.0, 350.0) == pytest.approx(mu * 293.15 / 350)
    assert air.mass_attenuation("N", 10000.0) == pytest.approx(1.07e-2) and air.mass_attenuation("Xx", 1e4) == 1e-3 and air.air_attenuation(-1.0) == 0.001


def test_extraction_against_numpy(spark):
    rng = np.random.default_rng(42)
    raw = rng.poisson(100, (50, 50)).astype(float)
    bad = rng.random((50, 50)) < 0.1
    image = spark.createDataFrame([(0, 0, 50, 50, raw.ravel().tolist())], "image_id int, panel_id int, n_slow int, n_fast int, data array<double>")
    px = pixels.unfolded(image).withColumns({"lp_div": F.lit(0.8), "qe": F.lit(0.9)})
    mask = spark.createDataFrame([(0, int(s), int(f)) for s, f in np.argwhere(bad)], "panel_id int, slow int, fast int")
    panel, beam = pixels.Panel((0.0, 0.0, 200.0)), pixels.Beam(1.0)
    got = pixels.observations(px, panel, beam, pixels.Extraction(pixel_step=2, constant_background=3.0), mask).orderBy("slow", "fast").collect()
    slow, fast = np.nonzero(~bad & (np.add.outer(np.arange(50) % 2, np.arange(50) % 2) == 0) & (np.arange(50)[:, None] % 2 == 0))
    lab = np.stack([0.172 * fast, 0.172 * slow, np.full(len(slow), 200.0)], 1)
    r = np.linalg.norm(lab, axis=1)
    total = 1 / 0.8 * 0.9 * r**3 / (0.172**2 * 200.0) * np.exp(air.air_attenuation(12398.4) * r / 1000)
    assert [(x.slow, x.fast) for x in got] == list(zip(slow.tolist(), fast.tolist(), strict=True))
    assert [x.intensity for x in got] == pytest.approx(((raw[slow, fast] - 3) * total).tolist())
    assert [x.sigma for x in got] == pytest.approx((np.sqrt(raw[slow, fast]) * total).tolist())


def test_negative_variance_is_nan_and_can_go(spark):
    px = spark.createDataFrame([(0, 0, 0, 0, -5.0), (0, 0, 0, 1, 5.0)], "image_id int, panel_id int, slow int, fast int, raw double")
    panel, beam = pixels.Panel((0.0, 0.0, 200.0)), pixels.Beam(1.0)
    assert sum(math.isnan(r.sigma) for r in pixels.observations(px, panel, beam).collect()) == 1
    assert pixels.observations(px, panel, beam, pixels.Extraction(drop_invalid=True)).count() == 1


def test_mask_algebra(spark):
    det = masks.detector(spark, [(0, 10, 12)])
    static = masks.static_mask(det, [masks.in_circle(5, 5, 2)])
    assert static.where("not good").count() == 13
    spots = spark.createDataFrame([(0, 0.5, 9.4), (0, 11.6, 0.0)], "panel_id int, x double, y double")
    peaks = masks.spot_pixels(spots, 2, 10, 12)
    assert {(r.slow, r.fast) for r in peaks.collect()} == {(s, f) for s in (7, 8, 9) for f in (0, 1, 2)} | {(s, f) for s in (0, 1, 2) for f in (10, 11)}
    total = masks.total_mask(static, peaks)
    assert total.count() == 120 and total.where("good").count() == 120 - 13 - 15
    assert masks.incompatible_panels(static, total).isEmpty()
    hot = spark.createDataFrame([(0, 0, 0, 5.0), (0, 0, 1, 2e6), (0, 0, 2, -4.0)], "panel_id int, slow int, fast int, raw double")
    dynamic = {r.fast: r.good for r in masks.dynamic_mask(masks.pixel_statistics(hot), negative=1.0).collect()}
    assert dynamic == {0: True, 1: False, 2: False}


def test_spot_centres_need_a_centroid(spark):
    with pytest.raises(ValueError, match="centroid"):
        masks.spot_centres(spark.createDataFrame([(1,)], "panel int"))
    got = masks.spot_centres(spark.createDataFrame([(1, [1.0, 2.0, 3.5])], "panel int, xyzcal_px array<double>")).first()
    assert (got.panel_id, got.x, got.frame) == (1, 1.0, 3.5)


@pytest.mark.parametrize(
    ("text", "want"),
    [("# Angle_increment 0.1000 deg.", 0.1), ("# Angle_increment 0.0000", 0.0), ("  #   ANGLE_increment   -0.1000 deg.", -0.1), ("# Angle_increment x", None), ("nothing", None), ("_array_data.data\n# Angle_increment 1.0", None), ("# a\r\n# Angle_increment 0.5000 deg.\r\n", 0.5)],
)
def test_headers(spark, text, want):
    assert value(spark, headers.angle_increment(F.lit(text))) == want


def test_routes(spark):
    for x, forced, legacy, want in ((0.0, None, False, "stills"), (0.5, None, False, "sequence"), (-0.1, None, False, "sequence"), (None, None, False, "sequence"), (None, None, True, "stills"), (0.5, "STILLS", False, "stills"), (0.0, "odd", False, "stills")):
        assert value(spark, headers.route(F.lit(x).cast("double"), forced, legacy)) == want


def test_reference_cell(spark):
    c = value(spark, headers.reference_cell(F.lit("CRYST1   50.000   50.000   50.000  90.00  90.00  90.00 P 1")))
    assert (c.a, c.gamma, c.space_group) == (50.0, 90.0, "P 1") and value(spark, headers.reference_cell(F.lit("ATOM"))) is None


def test_q_consistency_of_wrong_input(spark):
    got = validation.q_consistency(spark.createDataFrame([(1,)], "a int"), pixels.Panel((0.0, 0.0, 1.0)), (0.0, 0.0, -1.0)).first()
    assert got.n == 0 and got.passed is False
    assert validation.rotation_angle(np.eye(3), -np.eye(3)) == 0.0 and validation.rotation_angle(np.zeros((3, 3)), np.eye(3)) == 180.0


def test_peaks_of_one_image_leave_the_others_alone(spark):
    px = spark.createDataFrame([(i, 0, s, f, float(10 * i + f)) for i in range(3) for s in range(2) for f in range(4)], "image_id int, panel_id int, slow int, fast int, raw double")
    peaks = spark.createDataFrame([(1, 0, 0, 2), (1, 0, 0, 2), (2, 0, 1, 3), (9, 0, 0, 0)], "image_id int, panel_id int, slow int, fast int")
    shared = masks.static_mask(masks.detector(spark, [(0, 2, 4)]), [masks.in_rectangle(0, 0, 0, 0)])
    want = {(i, s, f) for i in range(3) for s in range(2) for f in range(4)} - {(1, 0, 2), (2, 1, 3)} - {(i, 0, 0) for i in range(3)}
    good = masks.image_masks(px, shared, peaks)
    assert {(r.image_id, r.slow, r.fast) for r in good.where("good").collect()} == want and good.count() == 24
    assert {(r.image_id, r.slow, r.fast) for r in pixels.usable(pixels.usable(px, shared.where("not good")), peaks).collect()} == want
    got = pixels.observations(px, pixels.Panel((0.0, 0.0, 200.0)), pixels.Beam(1.0), bad=shared.where("not good"), peaks=peaks)
    assert {(r.image_id, r.slow, r.fast) for r in got.collect()} == want
    spots = spark.createDataFrame([(0, 0, 1.0, 0.0), (1, 0, 3.0, 1.0), (1, 0, None, 1.0)], "image_id int, panel_id int, x double, y double")
    assert {tuple(r) for r in masks.spot_pixels(spots, 0, 2, 4).collect()} == {(0, 0, 0, 1), (1, 0, 1, 3)}
    assert masks.image_masks(px, None, peaks.limit(0)).where("good").count() == 24


PANELS = "panel_id int, n_fast int, n_slow int, px_fast double, px_slow double, origin array<double>, fast_axis array<double>, slow_axis array<double>"
BEAMS = "image_id int, wavelength double, s0x double, s0y double, s0z double"


def test_tables_of_panels_and_beams_equal_single_ones(spark):
    panels = {0: pixels.Panel((-5.0, 3.0, 200.0)), 1: pixels.Panel((5.0, -3.0, 150.0), (0.6, 0.8, 0.0), (-0.8, 0.6, 0.0), 0.1, 0.2)}
    beams = {0: pixels.Beam(1.0), 1: pixels.Beam(0.7, (0.1, 0.0, -2.0)), 2: pixels.Beam(14.0)}
    px = spark.createDataFrame([(i, p, s, f, float(s * f - 2)) for i in range(4) for p in range(3) for s in range(3) for f in range(3)], "image_id int, panel_id int, slow int, fast int, raw double")
    panel_rows = spark.createDataFrame([(k, 3, 3, p.px_fast, p.px_slow, list(p.origin), list(p.fast_axis), list(p.slow_axis)) for k, p in panels.items()], PANELS)
    beam_rows = spark.createDataFrame([(k, b.wavelength, *map(float, b.s0)) for k, b in beams.items()], BEAMS)
    for settings in (pixels.Extraction(gain=2.0), pixels.Extraction(min_res=1e9, max_res=0.0, use_air=False, drop_invalid=True)):
        got = pixels.observations(px, panel_rows, beam_rows, settings).collect()
        want = [r for i, b in beams.items() for p, panel in panels.items() for r in pixels.observations(px.where(f"image_id = {i} and panel_id = {p}"), panel, b, settings).collect()]
        key = lambda r: r[:4]
        for x, y in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert x[:4] == y[:4] and x[4:] == pytest.approx(y[4:], rel=1e-12, nan_ok=True)
    with pytest.raises(ValueError, match="both"):
        pixels.observations(px, panel_rows, beams[0])


def test_attenuation_of_tables(spark):
    from reciprospark.operators import attenuation

    energies = [-1.0, 0.0, 1.0, 999.0, 1000.0, 1234.5, 5000.0, 99_999.0, 100_000.0, 1e6]
    rows = spark.createDataFrame([(n, e) for n in ("N", "Ar", "Xx") for e in [*energies, None]], "element string, energy double")
    got = {(r.element, r.energy): r.mu for r in attenuation.mass_attenuation(rows, attenuation.tabulated(spark)).collect()}
    assert len(got) == 33 and all(v is None if (e is None or e <= 0) else v == pytest.approx(air.mass_attenuation(n, e)) for (n, e), v in got.items())
    waves = [1.0, 1.0, 0.05, 20.0, 0.0, -1.0, None]
    found = attenuation.with_air(spark.createDataFrame(list(enumerate(waves)), "image_id int, wavelength double"), temperature_k=300.0).collect()
    assert {r.image_id: r.air for r in found} == pytest.approx({k: 0.001 if not w or w < 0 else air.air_attenuation(air.HC / w, 300.0) for k, w in enumerate(waves)})
    own = spark.createDataFrame([("Xx", 1000.0, 2.0), ("Xx", 10_000.0, 0.02)], "element string, energy double, coefficient double")
    assert attenuation.mass_attenuation(spark.createDataFrame([("Xx", 3162.2776601683795)], "element string, energy double"), own).first().mu == pytest.approx(0.2)


def test_angles_in_columns_equal_those_of_matrices(spark):
    rng = np.random.default_rng(8)
    pairs = []
    for k in range(60):
        turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        a = rng.normal(size=(3, 3))
        pairs.append((k, a.ravel().tolist(), (turn @ a * (1 if k % 3 else -1)).ravel().tolist()))
    pairs += [(60, np.zeros(9).tolist(), np.eye(3).ravel().tolist()), (61, np.eye(3).ravel().tolist(), np.eye(3).ravel().tolist()), (62, (np.eye(3) * 0.01).ravel().tolist(), (-np.eye(3) * 0.01).ravel().tolist())]
    got = {r.k: r.angle for r in validation.rotation_angles(spark.createDataFrame(pairs, "k int, a array<double>, b array<double>"), "a", "b").collect()}
    assert got == pytest.approx({k: validation.rotation_angle(a, b) for k, a, b in pairs}, abs=1e-4)
