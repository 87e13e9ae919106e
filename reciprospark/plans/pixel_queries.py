"""Queries of the pixel, mask and validation operators over the stand-in pixels and reflections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from reciprospark.functions import air, corrections, vec
from reciprospark.operators import grid as grids
from reciprospark.operators import attenuation, masks, pixels, scans, validation
from reciprospark.operators import orchestration as orch
from reciprospark.plans import stand_ins as st
from reciprospark.plans.registry import lister, r, rounded
from reciprospark.schema import PIXELS
from reciprospark.sources import headers
from reciprospark.sources import images as image_files
from reciprospark.sources.shared import scratch
from reciprospark.streaming import accumulate

QUERIES, ORACLES, query = lister()
sql = st.with_tables
_BAD_SQL = "slow between 2 and 3 and fast between 1 and 5"
LAB = ("lab_x", "lab_y", "lab_z")


def _pixels(spark, d):
    return pixels.unfolded(st.images(spark, d))


def _geometry(spark, d):
    return pixels.with_geometry(_pixels(spark, d), st.PANEL, st.BEAM)


K = f"(2 * pi() / {st.BEAM.wavelength!r}::double)"
st.SQL["lab"] = "lab as (select *, -60.0::double + fast * 0.172::double as lab_x, -40.0::double + slow * 0.172::double as lab_y, 200.0::double as lab_z from pixels)"
st.SQL["geometry"] = f"geometry as (select *, sqrt(qx * qx + qy * qy + qz * qz) as q, 2 * pi() / sqrt(qx * qx + qy * qy + qz * qz) as d from (select *, {K} * lab_x / r as qx, {K} * lab_y / r as qy, {K} * (lab_z / r + 1.0) as qz from (select *, sqrt(lab_x * lab_x + lab_y * lab_y + lab_z * lab_z) as r from lab)))"
GEO = "pixels lab geometry"
MU = repr(air.air_attenuation(air.HC / st.BEAM.wavelength))
SA = "(r * r * r / (0.172::double * 0.172::double * 200.0))"
AIR = f"exp({MU}::double * r / 1000.0)"
KEYS = "image_id, slow, fast"


def _per_pixel(key: str, columns, text: dict, digits: int = 6) -> None:
    """A projection of every pixel: columns() for Spark, made when it runs, text for SQL."""

    def run(spark, d):
        return _geometry(spark, d).select("image_id", "slow", "fast", *[r(c, n, digits) for n, c in columns().items()])

    select = ", ".join(f"round({t}, {digits}) as {n}" for n, t in text.items())
    query(key, sql(GEO, f"select {KEYS}, {select} from geometry"))(run)


@query("P01_pixel_grid", sql("pixels", f"select {KEYS}, round(raw, 6) as raw from pixels where slow % 3 = 0 and fast % 3 = 0"))
def pixel_grid(spark, d):
    return pixels.thinned(_pixels(spark, d), 3).select("image_id", "slow", "fast", r("raw", "raw"))



def _lab():
    return [F.col(c) for c in LAB]


def _factors() -> dict:
    omega = corrections.solid_angle(_lab(), st.PANEL.fast_axis, st.PANEL.slow_axis, st.PANEL.px_fast, st.PANEL.px_slow)
    return {
        "lp": corrections.lp_factor(F.col("fast") / 4.0), "qe": corrections.qe_factor(F.when(F.col("slow") > 2, 0.9)),
        "sa": corrections.solid_angle_factor(omega), "air": corrections.air_factor(_lab(), st.BEAM.wavelength),
    }


LP, QE = "case when fast = 0 then 1.0 else 1.0 / (fast / 4.0) end", "case when slow > 2 then 0.9 else 1.0 end"
_per_pixel("P02_lab_position", lambda: {c: F.col(c) for c in LAB}, {c: c for c in LAB})
_per_pixel("P03_q_vector", lambda: {c: F.col(c) for c in ("qx", "qy", "qz")}, {c: c for c in ("qx", "qy", "qz")})
_per_pixel("P05_q_and_d", lambda: {c: F.col(c) for c in ("q", "d")}, {c: c for c in ("q", "d")})
_per_pixel("P08_gain", lambda: {"net": corrections.net_intensity(F.col("raw"), F.lit(2.0), 1.5)}, {"net": "(raw - 2.0) * 1.5"})
_per_pixel("P09_poisson_sigma", lambda: {"sigma": corrections.poisson_sigma(F.abs("raw"), F.lit(2.0), 1.5)}, {"sigma": "sqrt((abs(raw) / 1.5 + 2.0) * 2.25)"})
_per_pixel("P10_lp_multiplier", lambda: {"lp": _factors()["lp"]}, {"lp": LP})
_per_pixel("P11_qe_multiplier", lambda: {"qe": _factors()["qe"]}, {"qe": QE})
_per_pixel("P12_solid_angle", lambda: {"sa": _factors()["sa"]}, {"sa": SA}, digits=3)
_per_pixel("P15_air_multiplier", lambda: {"air": _factors()["air"]}, {"air": AIR}, digits=9)
_per_pixel("P16_total_correction", lambda: {"total": corrections.total_factor(_factors())}, {"total": f"{LP} * {QE} * {SA} * {AIR}"}, digits=2)
_per_pixel("P19_s1_vector", lambda: {f"s{k}": c / vec.norm(_lab()) / st.BEAM.wavelength for k, c in zip("xyz", _lab(), strict=True)}, {f"s{k}": f"lab_{k} / r / {st.BEAM.wavelength!r}::double" for k in "xyz"})
_per_pixel(
    "P17_analytic_45",
    lambda: {n: c for n, c in corrections.analytic_45(F.lit(200.0) + F.col("slow"), 0.172, F.lit(100.0)).items() if n != "qe"},
    {"lp": "2.0::double", "sa": "(200.0::double + slow) * (200.0::double + slow) * 2 / (0.172::double * 0.172::double)", "air": "exp(0.1::double)"},
    digits=3,
)


@query("P04_q_map", sql(GEO, "select panel_id, slow, fast, round(max(qx), 6) as qx, round(max(qy), 6) as qy, round(max(qz), 6) as qz from geometry group by all"))
def q_map(spark, d):
    return _geometry(spark, d).groupBy("panel_id", "slow", "fast").agg(*[r(F.max(c), c) for c in ("qx", "qy", "qz")])


_BG = "background as (select panel_id, slow, fast, avg(raw) as bg from pixels where slow < 6 group by all)"


def _background(spark, d):
    return _pixels(spark, d).where("slow < 6").groupBy("panel_id", "slow", "fast").agg(F.avg("raw").alias("bg"))


@query("P07_background", "with " + st.SQL["pixels"] + ", " + _BG + " select image_id, slow, fast, round(coalesce(bg, 1.5), 5) as bg, round(coalesce(greatest(bg, 0.0), 0.0), 5) as variance from pixels left join background using (panel_id, slow, fast)")
def background(spark, d):
    out = pixels.with_background(_pixels(spark, d), _background(spark, d))
    level, variance = corrections.background(F.col("bg"), 1.5)
    return out.select("image_id", "slow", "fast", r(level, "bg", 5), r(variance, "variance", 5))


@query("J02_background_join", "with " + st.SQL["pixels"] + ", " + _BG + " select image_id, count(*) as n, count(bg) as n_with, round(sum(raw - coalesce(bg, 0)), 3) as net from pixels left join background using (panel_id, slow, fast) group by 1")
def background_join(spark, d):
    """Each image's net counts over a measured background that covers a part of the panel."""
    out = pixels.with_background(_pixels(spark, d), _background(spark, d))
    return out.groupBy("image_id").agg(F.count("*").alias("n"), F.count("bg").alias("n_with"), r(F.sum(F.col("raw") - F.coalesce("bg", F.lit(0.0))), "net", 3))


def _interpolated(element: str) -> str:
    pairs = list(zip(air.ENERGIES, air.COEFFICIENTS[element], strict=True))
    cases = " ".join(f"when e < {e1} then exp(ln({c0!r}::double) + (ln(e) - ln({e0}::double)) / (ln({e1}::double) - ln({e0}::double)) * (ln({c1!r}::double) - ln({c0!r}::double)))" for (e0, c0), (e1, c1) in zip(pairs, pairs[1:], strict=False))
    return f"case when e <= 1000 then {pairs[0][1]!r}::double {cases} else {pairs[-1][1]!r}::double end"


_AT = "(select image_id, 12398.4::double / wavelength as e from beams)"


@query("P13_mass_attenuation", sql("beams", " union all ".join(f"select image_id, '{n}' as element, round({_interpolated(n)}, 9) as mu from {_AT}" for n in air.COEFFICIENTS) + f" union all select image_id, 'Xx', 0.001 from {_AT}"))
def mass_attenuation(spark, d):
    """Coefficients of the elements of air, and of one that the table lacks, at the energy of each image's beam."""
    elements = F.explode(F.array(*map(F.lit, (*air.COEFFICIENTS, "Xx")))).alias("element")
    rows = st.beams(spark, d).select("image_id", elements, (F.lit(air.HC) / F.col("wavelength")).alias("energy"))
    return attenuation.mass_attenuation(rows, attenuation.tabulated(spark)).select("image_id", "element", r("mu", "mu", 9))


_MASS = " + ".join(f"{f!r}::double * {air.MOLAR_MASSES[n]!r}" for n, f in air.COMPOSITION.items())
_MU = " + ".join(f"{f!r}::double * {_interpolated(n)}" for n, f in air.COMPOSITION.items())
_AIR_OF = f"100 * ({_MASS}) / (0.08206::double * 293.15) / 1000 * ({_MU})"


@query("P14_air_coefficient", sql("beams", f"select image_id, round({_AIR_OF}, 12) as mu from {_AT}"))
def air_coefficient(spark, d):
    return attenuation.with_air(st.beams(spark, d)).select("image_id", r("air", "mu", 12))


# several panels, a beam for each image

st.SQL["pixels5"] = "pixels5 as (select p.* replace ((image_id % 5)::int as panel_id) from pixels p)"
st.SQL["placed5"] = "placed5 as (select *, ox + fast * (px_fast * co) + slow * (px_slow * -si) as lab_x, oy + fast * (px_fast * si) + slow * (px_slow * co) as lab_y, oz as lab_z from pixels5 join panels using (panel_id) join beams using (image_id))"
st.SQL["geometry5"] = "geometry5 as (select *, sqrt(qx * qx + qy * qy + qz * qz) as q from (select *, 2 * pi() / wavelength * (lab_x / r - s0x / s0) as qx, 2 * pi() / wavelength * (lab_y / r) as qy, 2 * pi() / wavelength * (lab_z / r + 1.0 / s0) as qz from (select *, sqrt(lab_x * lab_x + lab_y * lab_y + lab_z * lab_z) as r, sqrt(s0x * s0x + 1.0) as s0 from placed5)))"
GEO5 = "pixels pixels5 panels beams placed5 geometry5"


def _modelled(spark, d):
    rows, panel, beam = pixels.with_models(st.panelled(_pixels(spark, d)), st.panels(spark, d), st.beams(spark, d))
    return pixels.without_models(pixels.with_geometry(rows, panel, beam))


@query("P02_several_panels", sql(GEO5, "select image_id, panel_id, slow, fast, round(lab_x, 6) as lab_x, round(lab_y, 6) as lab_y, round(lab_z, 6) as lab_z from placed5"))
def several_panels(spark, d):
    """Laboratory positions on panels of a table."""
    return _modelled(spark, d).select("image_id", "panel_id", "slow", "fast", *[r(c, c) for c in LAB])


@query("P03_beam_of_each_image", sql(GEO5, "select image_id, slow, fast, round(qx, 6) as qx, round(qy, 6) as qy, round(qz, 6) as qz, round(q, 5) as q, round(2 * pi() / q, 4) as d from geometry5"))
def beam_of_each_image(spark, d):
    """Scattering vectors by the wavelength and direction of each image's beam."""
    return _modelled(spark, d).select("image_id", "slow", "fast", *[r(c, c) for c in ("qx", "qy", "qz")], r("q", "q", 5), r("d", "d", 4))


_FACTOR5 = f"(r * r * r / (px_fast * px_slow * lab_z)) * exp(({_AIR_OF}) * r / 1000.0)"


@query("J03_panels_and_beams", sql(GEO5, f"select image_id, panel_id, slow, fast, round(qx, 6) as qx, round((raw - 1.0) * factor / 1e6, 6) as intensity, case when raw < 0 then 'nan' else round(sqrt(raw) * factor / 1e6, 6)::varchar end as sigma from (select *, {_FACTOR5} as factor from (select *, 12398.4::double / wavelength as e from geometry5)) where not ({_BAD_SQL})"))
def panels_and_beams(spark, d):
    """Observations of all pixels, negative counts among them, by tables of panels and beams; attenuation in air by each image's energy."""
    out = pixels.observations(st.panelled(_pixels(spark, d)), st.panels(spark, d), st.beams(spark, d), pixels.Extraction(constant_background=1.0), st.panelled(_pixels(spark, d)).where(_BAD_SQL).select("panel_id", "slow", "fast"))
    sigma = F.when(F.isnan("sigma"), "nan").otherwise(F.round(F.col("sigma") / 1e6, 6).cast("string"))
    return out.select("image_id", "panel_id", "slow", "fast", r("qx", "qx"), r(F.col("intensity") / 1e6, "intensity"), sigma.alias("sigma"))


@query("P18_factor_check", sql("pixels", f"select {KEYS}, case when raw <= 0 then 'lp not positive' when raw < 0.1 or raw > 10 then 'lp out of range' when 1.0 + fast / 20.0 > 1.2 then 'air out of range' end as doubt from pixels"))
def factor_check(spark, d):
    f = {"lp": F.col("raw"), "qe": F.lit(1.0), "sa": F.lit(1.0), "air": 1.0 + F.col("fast") / 20.0}
    return _pixels(spark, d).select("image_id", "slow", "fast", corrections.doubtful_factor(f).alias("doubt"))


_BAD = _BAD_SQL


def _bad(spark, d):
    return _pixels(spark, d).where(_BAD).select("panel_id", "slow", "fast")


@query("J01_pixel_mask_join", sql("pixels", f"select {KEYS}, round(raw, 6) as raw from pixels where not ({_BAD})"))
def pixel_mask_join(spark, d):
    return pixels.usable(_pixels(spark, d), _bad(spark, d)).select("image_id", "slow", "fast", r("raw", "raw"))


@query("F01_mask", sql("pixels", "select image_id, count(*) as n, round(sum(raw), 3) as total from pixels where not (pow(slow - 3.0, 2) + pow(fast - 4.0, 2) <= 4.0 or (slow between 6 and 7 and fast between 0 and 2)) group by 1"))
def good_pixels(spark, d):
    """The pixels that a mask calls good."""
    out = pixels.usable(_pixels(spark, d), _static(spark, d).where("not good"))
    return out.groupBy("image_id").agg(F.count("*").alias("n"), r(F.sum("raw"), "total", 3))

_TOTAL = f"({SA} * {AIR})"
_OBSERVED = f"select {KEYS}, round(qx, 6) as qx, round(qy, 6) as qy, round(qz, 6) as qz, round(raw * {_TOTAL}, 1) as intensity, round(sqrt(raw) * {_TOTAL}, 1) as sigma from geometry where not ({_BAD}) and d between 0.4956 and 0.49575 and raw >= 0 and raw * {_TOTAL} >= 1000000"


@query("J03_extraction", sql(GEO, _OBSERVED))
def extraction(spark, d):
    """Pixels to corrected observations: mask, geometry, corrections, and both filters."""
    settings = pixels.Extraction(max_res=0.4956, min_res=0.49575, min_intensity=1e6)
    out = pixels.observations(_pixels(spark, d).where("raw >= 0"), st.PANEL, st.BEAM, settings, _bad(spark, d))
    return out.select("image_id", "slow", "fast", *[r(c, c) for c in ("qx", "qy", "qz")], r("intensity", "intensity", 1), r("sigma", "sigma", 1))


@query("F02_valid_lab", sql("pixels lab", f"select {KEYS} from lab where fast <> 3"))
def valid_lab(spark, d):
    out = pixels.with_geometry(_pixels(spark, d), st.PANEL, st.BEAM).withColumn("lab_x", F.when(F.col("fast") == 3, float("nan")).otherwise(F.col("lab_x")))
    return out.where(pixels.placed()).select("image_id", "slow", "fast")


@query("F03_resolution_limits", sql(GEO, f"select {KEYS}, round(d, 6) as d from geometry where d >= 0.4956 and d <= 0.49575"))
def resolution_limits(spark, d):
    return _geometry(spark, d).where(pixels.limits("d", 0.4956, 0.49575)).select("image_id", "slow", "fast", r("d", "d"))


@query("F04_intensity_limits", sql("pixels", f"select {KEYS} from pixels where raw >= 1.0 and raw <= 12.5"))
def intensity_limits(spark, d):
    return _pixels(spark, d).where(pixels.limits("raw", 1.0, 12.5)).select("image_id", "slow", "fast")


# masks
_DET = "det as (select 0 as panel_id, (k // 8)::int as slow, (k % 8)::int as fast from range(64) t(k))"
_STATIC = "static as (select panel_id, slow, fast, not (pow(slow - 3.0, 2) + pow(fast - 4.0, 2) <= 4.0 or (slow between 6 and 7 and fast between 0 and 2)) as good from det)"
_STATS = "stats as (select panel_id, slow, fast, sum(raw) as total, count(raw) as n, min(raw) as low, max(raw) as high from pixels group by all)"
_DYNAMIC = "dynamic as (select panel_id, slow, fast, not (low < -38.0 or high > 40.0) as good from stats)"
_COMBINED = "combined as (select panel_id, slow, fast, s.good and y.good as good from static s join dynamic y using (panel_id, slow, fast))"
_BOXES = "peaks as (select distinct panel_id, slow, fast from (select panel_id, fast, unnest(range(greatest(cy - 1, 0), least(cy + 1, 7) + 1))::int as slow from (select panel_id, cy, unnest(range(greatest(cx - 1, 0), least(cx + 1, 7) + 1))::int as fast from (select panel_id, round_even(x, 0)::bigint as cx, round_even(y, 0)::bigint as cy from reflections where round(frame) = 7))))"
MASKS = "with " + ", ".join([st.SQL["pixels"], st.SQL["reflections"], _DET, _STATIC, _STATS, _DYNAMIC, _COMBINED, _BOXES]) + " "


def _static(spark, d):
    return masks.static_mask(masks.detector(spark, [(0, 8, 8)]), [masks.in_circle(3, 4, 2), masks.in_rectangle(6, 7, 0, 2)])


def _dynamic(spark, d):
    return masks.dynamic_mask(masks.pixel_statistics(_pixels(spark, d)), hot=40.0, negative=38.0)


def _spots(spark, d):
    return masks.spot_pixels(masks.of_frame(st.reflections(spark, d), 7), 1, 8, 8)


_GOOD = "not (pow(slow - 3.0, 2) + pow(fast - 4.0, 2) <= 4.0 or (slow between 6 and 7 and fast between 0 and 2) or panel_id = 3)"
_SEEN = "select distinct (image_id % 5)::int as panel_id, slow, fast from pixels"


@query("M12_static_mask", sql("pixels", f"select *, {_GOOD} as good from ({_SEEN})"))
def static_mask(spark, d):
    """The static mask of all pixels that the images of five panels have; one panel is not trusted."""
    seen = masks.positions(st.panelled(_pixels(spark, d)))
    return masks.static_mask(seen, [masks.in_circle(3, 4, 2), masks.in_rectangle(6, 7, 0, 2)], [3])


@query("F12_regions", sql("pixels", "select image_id, count(*) filter (c) as n_circle, round(sum(raw) filter (c), 3) as circle, count(*) filter (b) as n_rectangle, round(sum(raw) filter (b), 3) as rectangle from (select *, pow(slow - 3.0, 2) + pow(fast - 4.0, 2) <= 4.0 as c, slow between 6 and 7 and fast between 0 and 2 as b from pixels) group by 1"))
def regions(spark, d):
    """Pixels and counts of each image inside a circle and inside a rectangle."""
    c, b = masks.in_circle(3, 4, 2), masks.in_rectangle(6, 7, 0, 2)
    return _pixels(spark, d).groupBy("image_id").agg(F.count_if(c).alias("n_circle"), r(F.sum(F.when(c, F.col("raw"))), "circle", 3), F.count_if(b).alias("n_rectangle"), r(F.sum(F.when(b, F.col("raw"))), "rectangle", 3))


@query("M10_pixel_statistics", MASKS + "select panel_id, slow, fast, round(total, 3) as total, n, round(low, 6) as low, round(high, 6) as high from stats")
def pixel_statistics(spark, d):
    out = masks.pixel_statistics(_pixels(spark, d))
    return out.select("panel_id", "slow", "fast", r("total", "total", 3), "n", r("low", "low"), r("high", "high"))


@query("T03_mask_accumulation", ORACLES["M10_pixel_statistics"])
def mask_accumulation(spark, d):
    """The same sums as a stream of image files gives them, batch by batch."""
    source, out = scratch(spark, "pixels"), scratch(spark, "statistics")
    _pixels(spark, d).repartition(4).write.parquet(source)
    stream = accumulate.observation_stream(spark, source, PIXELS, 2)
    accumulate.to_table(accumulate.running_mask_statistics(stream), out, scratch(spark, "checkpoint")).awaitTermination()
    return accumulate.last_batch(spark, out).select("panel_id", "slow", "fast", r("total", "total", 3), "n", r("low", "low"), r("high", "high"))


@query("M11_dynamic_mask", MASKS + "select panel_id, slow, fast, good from dynamic")
def dynamic_mask(spark, d):
    return _dynamic(spark, d)


@query("F13_hot_negative", sql("pixels", "select image_id, count(*) as n, round(sum(raw), 3) as total from pixels where raw < -20.0 or raw > 25.0 group by 1"))
def hot_negative(spark, d):
    """Single values that are hot or too negative."""
    out = _pixels(spark, d).where(masks.hot_or_negative(F.col("raw"), F.col("raw"), 25.0, 20.0))
    return out.groupBy("image_id").agg(F.count("*").alias("n"), r(F.sum("raw"), "total", 3))


@query("M13_combined_mask", MASKS + "select panel_id, slow, fast, good from combined")
def combined_mask(spark, d):
    return masks.combined_mask(_static(spark, d), _dynamic(spark, d))


@query("M14_spot_mask", MASKS + "select panel_id, slow, fast from peaks")
def spot_mask(spark, d):
    return _spots(spark, d)


def _sides(half: int) -> str:
    """Rows of reflections with the sides of their clipped boxes."""
    return f"(select *, greatest(round_even(x, 0) - {half}, 0) as x0, least(round_even(x, 0) + {half}, 7) as x9, greatest(round_even(y, 0) - {half}, 0) as y0, least(round_even(y, 0) + {half}, 7) as y9 from reflections)"


_EACH = "(select refl_id, panel_id, slow::int as slow, unnest(range(x0::bigint, x9::bigint + 1))::int as fast from (select *, unnest(range(y0::bigint, y9::bigint + 1)) as slow from " + _sides(1) + "))"


@query("F09_frame_filter", sql("reflections", "select refl_id from reflections where round(frame) = 7"))
def frame_filter(spark, d):
    return masks.of_frame(st.reflections(spark, d), 7).select("refl_id")


@query("J08_reflection_boxes", sql("reflections", f"select panel_id, slow, fast, count(*) as n, sum(refl_id)::bigint as total from {_EACH} group by all"))
def reflection_boxes(spark, d):
    """How many reflections cover each pixel, and which: the boxes of all of them."""
    out = masks.box_pixels(st.reflections(spark, d), 1, 8, 8)
    return out.groupBy("panel_id", "slow", "fast").agg(F.count("*").alias("n"), F.sum("refl_id").alias("total"))


@query("L09_distinct_pixels", sql("reflections", f"select distinct panel_id, slow, fast from {_EACH}"))
def distinct_pixels(spark, d):
    return masks.spot_pixels(st.reflections(spark, d), 1, 8, 8)


@query("U06_box_generator", sql("reflections", f"select refl_id, slow, fast from {_EACH}"))
def box_generator(spark, d):
    return masks.box_pixels(st.reflections(spark, d), 1, 8, 8).select("refl_id", "slow", "fast")


@query("F10_clip_to_panel", sql("reflections", "select refl_id, greatest(x9 - x0 + 1, 0)::bigint * greatest(y9 - y0 + 1, 0)::bigint as n from " + _sides(2) + " where x9 >= x0 and y9 >= y0"))
def clip_to_panel(spark, d):
    """Pixels that the panel leaves of each reflection's box."""
    return masks.box_pixels(st.reflections(spark, d), 2, 8, 8).groupBy("refl_id").agg(F.count("*").alias("n"))


_SHOEBOX = "select (user_id % 6)::int as x1, (event_id % 5)::int as y1, (event_id % 2)::int as z1, event_id from events"


@query("M15_shoebox_mask", f"with b as ({_SHOEBOX}), c as (select *, unnest(range(12))::int as k from b) select distinct z1 + k // 6 as panel_id, (y1 + (k % 6) // 3)::int as slow, (x1 + k % 3)::int as fast from c where (((event_id + k) % 7) * 4)::int & 20 <> 0 and y1 + (k % 6) // 3 between 0 and 7 and x1 + k % 3 between 0 and 7")
def shoebox_mask(spark, d):
    return masks.shoebox_pixels(_shoeboxes(spark, d), 8, 8)


def _shoeboxes(spark, d):
    t = st.table(spark, d, "events")
    x1, y1, z1 = (F.col("user_id") % 6).cast("int"), (F.col("event_id") % 5).cast("int"), (F.col("event_id") % 2).cast("int")
    codes = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: (((F.col("event_id") + k) % 7) * 4).cast("int"))
    box = F.struct(z1.alias("z1"), y1.alias("y1"), x1.alias("x1"), (z1 + 2).alias("z2"), (y1 + 2).alias("y2"), (x1 + 3).alias("x2"), codes.alias("mask"))
    return t.select("event_id", box.alias("shoebox"))


@query("F11_shoebox_code", f"with b as ({_SHOEBOX}) select event_id, count(*) as n from (select event_id, ((event_id + unnest(range(12))) % 7 * 4)::int as code from b) where code & 20 <> 0 group by 1")
def shoebox_code(spark, d):
    """Cells of each shoebox with a code of a peak."""
    cells = _shoeboxes(spark, d).select("event_id", F.explode("shoebox.mask").alias("code"))
    return cells.where(masks.is_peak(F.col("code"))).groupBy("event_id").agg(F.count("*").alias("n"))


@query("M16_total_mask", MASKS + "select c.panel_id, c.slow, c.fast, good and p.slow is null as good from combined c left join peaks p using (panel_id, slow, fast)")
def total_mask(spark, d):
    return masks.total_mask(masks.combined_mask(_static(spark, d), _dynamic(spark, d)), _spots(spark, d))


@query("J07_mask_algebra", MASKS + "select y.slow, y.fast, s.good as is_static, y.good as is_dynamic, s.good and y.good as both, s.good and y.good and p.slow is null as total from static s join dynamic y using (panel_id, slow, fast) left join peaks p using (panel_id, slow, fast)")
def mask_algebra(spark, d):
    """Each mask and what they give together."""
    s, y = _static(spark, d), _dynamic(spark, d)
    both = masks.combined_mask(s, y)
    parts = {"is_static": s, "is_dynamic": y, "both": both, "total": masks.total_mask(both, _spots(spark, d))}
    out = None
    for name, m in parts.items():
        m = m.withColumnRenamed("good", name)
        out = m if out is None else out.join(m, masks.KEY)
    return out.drop("panel_id")


@query("M17_mask_compatibility", sql("pixels", ", a as (select panel_id, count(*) as n1, max(slow) as slow1, max(fast) as fast1 from (" + _SEEN + ") group by 1), b as (select panel_id, count(*) as n2, max(slow) as slow2, max(fast) as fast2 from (select distinct (image_id % 5)::int as panel_id, slow, fast from pixels where image_id % 5 <> 1 and (image_id % 5 <> 4 or slow < 5)) group by 1) select panel_id, n1, slow1, fast1, n2, slow2, fast2 from a full join b using (panel_id) where n1 is distinct from n2"))
def mask_compatibility(spark, d):
    """Panels on which the masks of two sets of images do not fit: one lacks a panel, and a part of another."""
    px = st.panelled(_pixels(spark, d))
    one = masks.static_mask(masks.positions(px))
    return masks.incompatible_panels(one, masks.static_mask(masks.positions(px.where("panel_id <> 1 and (panel_id <> 4 or slow < 5)"))))


@query("R14_mask_summary", MASKS + "select panel_id, count(*) as n, count(*) filter (good) as n_good, round(avg(good::int), 9) as good_share from combined group by 1")
def mask_summary(spark, d):
    return rounded(masks.mask_summary(masks.combined_mask(_static(spark, d), _dynamic(spark, d))), 9)


# masks of each image

st.SQL["image_peaks"] = "image_peaks as (select distinct (refl_id % 37)::int as image_id, panel_id, slow, fast from " + _EACH + ")"
st.SQL["image_masks"] = "image_masks as (select p.*, s.good and k.slow is null as good, s.good as shared, k.slow is not null as peak from pixels p join static s using (panel_id, slow, fast) left join image_peaks k using (image_id, panel_id, slow, fast))"
st.SQL["det"], st.SQL["static"] = _DET, _STATIC
BY_IMAGE = "pixels reflections det static image_peaks image_masks"


def _image_peaks(spark, d):
    return masks.spot_pixels(st.image_reflections(spark, d), 1, 8, 8)


def _image_masks(spark, d):
    return masks.image_masks(_pixels(spark, d), _static(spark, d), _image_peaks(spark, d))


@query("M16_image_masks", sql(BY_IMAGE, "select image_id, slow, fast, good from image_masks"))
def image_masks(spark, d):
    """The total mask of each image: the static one, without the peaks of that image."""
    return _image_masks(spark, d).select("image_id", "slow", "fast", "good")


@query("J07_peaks_of_each_image", sql(BY_IMAGE, "select image_id, count(*) as n, count(*) filter (shared) as n_shared, count(*) filter (peak) as n_peak, count(*) filter (good) as n_good from image_masks group by 1"))
def peaks_of_each_image(spark, d):
    shared = masks.image_masks(_pixels(spark, d), _static(spark, d), None).withColumnRenamed("good", "shared")
    both = masks.image_masks(shared, None, _image_peaks(spark, d)).withColumnRenamed("good", "unhit")
    return both.groupBy("image_id").agg(F.count("*").alias("n"), F.count_if("shared").alias("n_shared"), F.count_if(~F.col("unhit")).alias("n_peak"), F.count_if(F.col("shared") & F.col("unhit")).alias("n_good"))


@query("F01_pixels_of_each_image", sql(BY_IMAGE, "select image_id, slow, fast, round(raw, 6) as raw from image_masks where good"))
def pixels_of_each_image(spark, d):
    """What an anti-join with each image's peaks leaves."""
    out = pixels.usable(pixels.usable(_pixels(spark, d), _static(spark, d).where("not good")), _image_peaks(spark, d))
    return out.select("image_id", "slow", "fast", r("raw", "raw"))


@query("M15_image_shoeboxes", f"with b as ({_SHOEBOX}), c as (select *, unnest(range(12))::int as k from b) select distinct (event_id % 37)::int as image_id, z1 + k // 6 as panel_id, (y1 + (k % 6) // 3)::int as slow, (x1 + k % 3)::int as fast from c where (((event_id + k) % 7) * 4)::int & 20 <> 0 and y1 + (k % 6) // 3 between 0 and 7 and x1 + k % 3 between 0 and 7")
def image_shoeboxes(spark, d):
    return masks.shoebox_pixels(_shoeboxes(spark, d).withColumn("image_id", (F.col("event_id") % 37).cast("int")), 8, 8)


# validation


def _s1(spark, d):
    """Reflections whose beam vectors are a little off."""
    t = st.reflections(spark, d)
    lab = (F.col("x") * 0.172 - 60.0, F.col("y") * 0.172 - 40.0, F.lit(200.0))
    n = vec.norm(lab)
    return t.withColumn("s1", F.array(lab[0] / n + F.col("partiality") * 0.002, lab[1] / n, lab[2] / n))


_DELTA = "delta as (select refl_id, partiality * 0.002::double as delta from reflections)"


@query("M18_q_consistency", "with " + st.SQL["reflections"] + ", " + _DELTA + " select count(*) as n, round(avg(delta), 9) as mean, round(median(delta), 9) as median, round(max(delta), 9) as max, avg(delta) <= 0.01 and max(delta) <= 0.05 as passed from delta")
def q_consistency(spark, d):
    return rounded(validation.q_consistency(_s1(spark, d), st.PANEL, (0.0, 0.0, -1.0), most=None), 9)


@query("J09_reflection_panel", "with " + st.SQL["reflections"] + ", " + _DELTA + " select refl_id, round(delta, 9) as delta from delta")
def reflection_panel(spark, d):
    """The residual of each reflection on its panel."""
    return validation.q_residuals(_s1(spark, d), st.PANEL, (0.0, 0.0, -1.0)).select("refl_id", r("delta", "delta", 9))


@query("J09_panels_of_a_table", sql("reflections panels", "select refl_id, round(sqrt(pow(lx / r + 0.01 * partiality - lx / r, 2)), 9) as delta from (select *, sqrt(lx * lx + ly * ly + oz * oz) as r from (select *, ox + x * (px_fast * co) + y * (px_slow * -si) as lx, oy + x * (px_fast * si) + y * (px_slow * co) as ly from (select refl_id, (refl_id % 5)::int as panel_id, x, y, partiality from reflections) join panels using (panel_id)))"))
def panels_of_a_table(spark, d):
    """Residuals of reflections on five panels; their beam vectors are off by a hundredth of the partiality."""
    t = st.reflections(spark, d).withColumn("panel_id", (F.col("refl_id") % 5).cast("int")).join(st.panels(spark, d), "panel_id")
    lab = [F.col("origin")[k] + F.col("x") * F.col("px_fast") * F.col("fast_axis")[k] + F.col("y") * F.col("px_slow") * F.col("slow_axis")[k] for k in range(3)]
    t = t.withColumn("s1", F.array(lab[0] / vec.norm(lab) + 0.01 * F.col("partiality"), lab[1] / vec.norm(lab), lab[2] / vec.norm(lab))).select("refl_id", "panel_id", "x", "y", "s1")
    return validation.q_residuals(t, st.panels(spark, d), (0.0, 0.0, -1.0)).select("refl_id", r("delta", "delta", 9))


@query("O07_consistency_outcome", "with " + st.SQL["reflections"] + ", " + _DELTA + " select count(*) as n, case when avg(delta) <= 0.0001 and max(delta) <= 0.0005 then 'SUCCESS' else 'FAILURE' end as status, 'q consistency check failed' as message, 'ConsistencyCheckFailed' as error_code from delta")
def consistency_outcome(spark, d):
    """The outcome of a check with a narrow tolerance."""
    return orch.consistency_outcome(validation.q_consistency(_s1(spark, d), st.PANEL, (0.0, 0.0, -1.0), tolerance=0.0001, most=None))


_SAMPLE = "(select * from delta order by md5(refl_id::varchar || ':42'), refl_id limit 500)"


@query("L05_sampled_reflections", "with " + st.SQL["reflections"] + ", " + _DELTA + f" select count(*) as n, round(avg(delta), 9) as mean, round(median(delta), 9) as median, round(max(delta), 9) as max, avg(delta) <= 0.01 and max(delta) <= 0.05 as passed from {_SAMPLE}")
def sampled_reflections(spark, d):
    return rounded(validation.q_consistency(_s1(spark, d), st.PANEL, (0.0, 0.0, -1.0), most=500), 9)


@query("M20_cell_check", sql("crystals", "select still_id, case when abs(a - 10.05) > 0.004 * 10.05 then 'a' when abs(b - 15.05) > 0.003 * 15.05 then 'b' when abs(c - 20.05) > 0.002 * 20.05 then 'c' when abs(alpha - 90.0) > 0.03 then 'alpha' when abs(beta - 90.0) > 0.05 then 'beta' when abs(gamma - 90.0) > 0.05 then 'gamma' end as mismatch from crystals".replace("0.003", "0.004").replace("0.002 *", "0.004 *").replace("0.05 then 'beta'", "0.03 then 'beta'").replace("0.05 then 'gamma'", "0.03 then 'gamma'")))
def cell_check(spark, d):
    return validation.cell_mismatch(st.crystals(spark, d), (10.05, 15.05, 20.05, 90.0, 90.0, 90.0), 0.004, 0.03).select("still_id", "mismatch")


@query("F17_cell_tolerance", sql("crystals", "select still_id from crystals where abs(a - 10.05) <= 0.004 * 10.05 and abs(b - 15.05) <= 0.004 * 15.05 and abs(c - 20.05) <= 0.004 * 20.05 and abs(alpha - 90.0) <= 0.03 and abs(beta - 90.0) <= 0.03 and abs(gamma - 90.0) <= 0.03"))
def cell_tolerance(spark, d):
    """Crystals within the tolerances."""
    return validation.cell_mismatch(st.crystals(spark, d), (10.05, 15.05, 20.05, 90.0, 90.0, 90.0), 0.004, 0.03).where("mismatch is null").select("still_id")


_CELLS = [("P 1", 10.05, 15.05, 20.05, 90.05, 90.05, 90.05), ("P 2", 10.0, 15.0, 20.0, 90.025, 90.025, 90.0)]
_OFF = " ".join(f"when space_group = '{g}' and abs({c} - {v!r}) > {f'0.004 * {v!r}' if k < 3 else '0.03'} then '{c}'" for g, *cell in _CELLS for k, (c, v) in enumerate(zip(("a", "b", "c", "alpha", "beta", "gamma"), cell, strict=True)))


@query("J12_reference_cell", sql("crystals", f"select still_id, space_group, case {_OFF} end as mismatch from (select *, case still_id % 3 when 0 then 'P 1' when 1 then 'P 2' else 'P 3' end as space_group from crystals)"))
def reference_cells(spark, d):
    """Crystals against the reference cell of their group, which one group lacks."""
    group = F.when(F.col("still_id") % 3 == 0, "P 1").when(F.col("still_id") % 3 == 1, "P 2").otherwise("P 3")
    references = spark.createDataFrame(_CELLS, "space_group string, r_a double, r_b double, r_c double, r_alpha double, r_beta double, r_gamma double")
    out = validation.cell_mismatch_of(st.crystals(spark, d).withColumn("space_group", group), references, 0.004, 0.03)
    return out.select("still_id", "space_group", "mismatch")


@query("R16_misorientation", sql("crystals", "select x.still_id, round(degrees(acos(greatest(least(2 * cos(x.turn - y.turn) + 1, 3.0), -1.0) / 2 - 0.5)), 3) as angle from crystals x join crystals y on y.still_id = x.still_id + 1"))
def misorientation(spark, d):
    """Angles between each crystal's orientation and the next one's."""
    cell = dict(zip(grids.CELL, (10.0, 15.0, 20.0, 90.0, 90.0, 90.0), strict=True))  # one cell, so that settings differ by rotations
    settings = grids.with_settings(st.crystals(spark, d).withColumns({c: F.lit(x) for c, x in cell.items()})).select("still_id", "setting")
    pairs = settings.join(settings.select((F.col("still_id") - 1).alias("still_id"), F.col("setting").alias("other")), "still_id")
    return validation.rotation_angles(pairs, "setting", "other").select("still_id", r("angle", "angle", 3))


@query("M19_geometry_validation", "select c_custkey as still_id, c_custkey % 4 <> 0 and c_custkey % 10 > 0 and coalesce(case when c_custkey % 3 = 0 then null else c_custkey % 3 = 1 end, true) as passed from customer")
def geometry_validation(spark, d):
    k = F.col("c_custkey")
    t = st.table(spark, d, "customer").select(k.alias("still_id"), (k % 4 != 0).alias("q_ok"), (k % 10).alias("n_reflections"), F.when(k % 3 != 0, k % 3 == 1).alias("cell_ok"), F.lit(None).cast("boolean").alias("orientation_ok"))
    return t.select("still_id", validation.geometry_passed().alias("passed"))


@query("F15_partiality", sql("reflections", "select refl_id from reflections where partiality >= 0.1"))
def partiality(spark, d):
    return st.reflections(spark, d).where(validation.enough_partiality(0.1)).select("refl_id")


@query("J10_angle_to_frame", "select event_id, ((event_id % 400) // 5)::int as frame from events")
def angle_to_frame(spark, d):
    t = st.table(spark, d, "events").select("event_id", ((F.col("event_id") % 400) * 0.1 + 10.0).alias("angle"))
    return t.select("event_id", headers.frame_of(F.col("angle"), 10.0, 0.5).alias("frame"))



_SCANS = "scans as (select s_suppkey as scan_id, (s_suppkey % 50) * 7.0::double as start, case when s_suppkey % 4 = 0 then -0.5 else 0.5 end::double as width, (10 + s_suppkey % 20)::int as n_frames from supplier where s_suppkey % 3 <> 1)"
_ANGLES = "angles as (select event_id as image_id, case when event_id % 101 <> 0 then (event_id % 3700) * 0.1::double + 0.05 end as angle from events)"


def _scans(spark, d):
    k = F.col("s_suppkey")
    return st.table(spark, d, "supplier").where("s_suppkey % 3 <> 1").select(k.alias("scan_id"), ((k % 50) * 7.0).alias("start"), F.when(k % 4 == 0, -0.5).otherwise(0.5).alias("width"), (10 + k % 20).cast("int").alias("n_frames"))


def _framed(spark, d):
    k = F.col("event_id")
    images = st.table(spark, d, "events").select(k.alias("image_id"), F.when(k % 101 != 0, (k % 3700) * 0.1 + 0.05).alias("angle"))
    return scans.framed(images, _scans(spark, d))


st.SQL["scans"], st.SQL["angles"] = _SCANS, _ANGLES
st.SQL["framed"] = "framed as (select a.image_id, a.angle, min(scan_id) as scan_id, count(scan_id) as n_scans, arg_min(f, scan_id) as frame from angles a left join (select i.image_id, scan_id, floor((angle - start) / width + 1e-9)::int as f from angles i, scans where (angle - start) / width + 1e-9 >= 0 and floor((angle - start) / width + 1e-9) < n_frames) using (image_id) group by all)"


@query("J10_frames_among_scans", sql("scans angles framed", "select image_id, scan_id, frame, n_scans, case when angle is null then 'no angle in the header' when n_scans = 0 then 'no scan has this angle' end as message from framed"))
def frames_among_scans(spark, d):
    """The scan and frame of each image by its angle; scans overlap, run in both directions, and leave gaps."""
    return _framed(spark, d).select("image_id", "scan_id", "frame", "n_scans", "message")


@query("S01_models_of_frames", sql("scans angles framed", "select image_id, scan_id, frame, case when scan_id is not null and frame >= scan_id % 4 then scan_id * 1000 + frame - (frame - scan_id % 4) % 6 end as model from framed"))
def models_of_frames(spark, d):
    """The crystal of each image's frame: models are known at every sixth frame of a scan, from one of its first on."""
    known = _scans(spark, d).select("scan_id", F.explode(F.sequence((F.col("scan_id") % 4).cast("int"), F.lit(40), F.lit(6))).alias("frame"))
    known = known.withColumn("model", F.col("scan_id") * 1000 + F.col("frame"))
    return scans.with_scan_models(_framed(spark, d), known).select("image_id", "scan_id", "frame", "model")


@query("S02_angle_increment", "select event_id, case when event_id % 5 = 0 then null else (case when event_id % 3 = 0 then -1.5 when event_id % 3 = 1 then 0.0 else 1.5 end)::double end as increment, null::double as start from events")
def angle_increment(spark, d):
    value = F.when(F.col("event_id") % 3 == 0, "-1.5000").when(F.col("event_id") % 3 == 1, "0.0000").otherwise("+1.5")
    name = F.when(F.col("event_id") % 5 == 0, "Angle").otherwise("angle_Increment")
    header = F.concat(F.lit("# Detector\n  #  "), name, F.lit("   "), value, F.lit(" deg.\n_array_data.data\n# Start_angle 9.0\n"))
    return st.table(spark, d, "events").select("event_id", headers.angle_increment(header).alias("increment"), headers.start_angle(header).alias("start"))


@query("S03_start_angle", "select event_id, ((event_id % 90) / 2.0)::double as start from events")
def start_angle(spark, d):
    header = F.concat(F.lit("# Start_angle "), F.format_string("%.4f", (F.col("event_id") % 90) / 2.0), F.lit(" deg.\n"))
    return st.table(spark, d, "events").select("event_id", headers.start_angle(header).alias("start"))


@query("S08_reference_cell", "select c_custkey, 50.0::double as a, (60 + c_custkey % 7)::double as b, 90.0::double as gamma, 'P 21 21 21' as space_group from customer")
def reference_cell(spark, d):
    line = F.format_string("CRYST1%9.3f%9.3f%9.3f%7.2f%7.2f%7.2f P 21 21 21", F.lit(50.0), 60.0 + F.col("c_custkey") % 7, F.lit(70.0), F.lit(90.0), F.lit(90.0), F.lit(90.0))
    c = headers.reference_cell(line).alias("c")
    return st.table(spark, d, "customer").select("c_custkey", c).select("c_custkey", "c.a", "c.b", "c.gamma", "c.space_group")


@query("O01_routing", "select event_id, case when event_id % 4 = 1 then 'stills' else 'sequence' end as route from events")
def routing(spark, d):
    k = F.col("event_id") % 4
    images = st.table(spark, d, "events").select("event_id", F.when(k == 1, 0.0).when(k == 2, 0.5).when(k == 3, -0.1).alias("increment"))
    return orch.routed(images).select("event_id", "route")


_MESSAGES = ["Input file gone", "mask not found", "q consistency bad", "Background shape", "cannot save", "incomplete model", "other"]


@query("O05_error_codes", "select event_id, case event_id % 7 when 0 then 'InputFileError' when 1 then 'InputFileError' when 2 then 'ConsistencyCheckFailed' when 3 then 'BackgroundFileError' when 4 then 'OutputWriteError' when 5 then 'DIALSModelIncomplete' else 'ProcessingError' end as code from events")
def error_codes(spark, d):
    message = F.element_at(F.array(*[F.lit(m) for m in _MESSAGES]), (F.col("event_id") % 7 + 1).cast("int"))
    return st.table(spark, d, "events").select("event_id", orch.error_code(message).alias("code"))


@query("S01_image_scan", sql("pixels", "select image_id, count(*) as n, round(sum(raw), 3) as total, max(slow) as slow, max(fast) as fast from pixels group by 1"))
def image_scan(spark, d):
    return _pixels(spark, d).groupBy("image_id").agg(F.count("*").alias("n"), r(F.sum("raw"), "total", 3), F.max("slow").alias("slow"), F.max("fast").alias("fast"))


@query("S01_decoded_images", sql("pixels", "select image_id, count(*) as n, sum(round(raw * 50))::bigint as total, min(round(raw * 50))::int as low, max(round(raw * 50))::int as high, max(slow) as slow, max(fast) as fast from pixels group by 1"))
def decoded_images(spark, d):
    """Images as whole files, with a header and a compressed stream of pixels, decoded to the pixels again."""

    @F.pandas_udf("binary")
    def file_of(data: pd.Series) -> pd.Series:
        head = b"# Start_angle 1.0 deg.\n_array_data.data\nX-Binary-Size-Fastest-Dimension: 8\nX-Binary-Size-Second-Dimension: 8\n\n" + image_files.START
        return data.map(lambda x: head + image_files.encoded(x))

    whole = st.images(spark, d).select("image_id", file_of(F.transform("data", lambda x: F.round(x * 50).cast("int"))).alias("content"))
    found = whole.select("image_id", image_files.decoded_column(F.col("content")).alias("f")).select("image_id", F.lit(0).alias("panel_id"), "f.n_slow", "f.n_fast", "f.data")
    raw = F.col("raw").cast("int")
    return pixels.unfolded(found).groupBy("image_id").agg(F.count("*").alias("n"), F.sum(raw).alias("total"), F.min(raw).alias("low"), F.max(raw).alias("high"), F.max("slow").alias("slow"), F.max("fast").alias("fast"))


def _batch(spark, d):
    """Images some of which have no data, or less than they say."""
    k = F.col("image_id") % 7
    images = st.images(spark, d).withColumn("data", F.when(k == 3, F.slice("data", 1, 60)).when(k != 5, F.transform("data", F.abs)))
    return orch.process_batch(images.withColumn("increment", F.when(k % 2 == 0, 0.0)), st.PANEL, st.BEAM, pixels.Extraction(max_res=0.4956, min_res=0.49575), _bad(spark, d))


_IN_BATCH = f"image_id % 7 not in (3, 5) and not ({_BAD}) and d between 0.4956 and 0.49575"


@query("O02_batch_outcomes", sql(GEO, f"select vec_id::int as image_id, case when (vec_id % 7) % 2 = 0 then 'stills' else 'sequence' end as route, case when vec_id % 7 in (3, 5) then 'FAILURE' else 'SUCCESS' end as status, case vec_id % 7 when 3 then 'image of another size than its header says' when 5 then 'Input image not found' end as message, case vec_id % 7 when 3 then 'ProcessingError' when 5 then 'InputFileError' end as error_code, coalesce(n, 0)::bigint as n_observations from embeddings left join (select image_id, count(*) as n from geometry where {_IN_BATCH} group by 1) on image_id = vec_id"))
def batch_outcomes(spark, d):
    return _batch(spark, d)[1]


@query("O02_batch_observations", sql(GEO, f"select image_id as still_id, slow, fast, round(abs(raw) * {_TOTAL}, 1) as intensity from geometry where {_IN_BATCH}"))
def batch_observations(spark, d):
    return _batch(spark, d)[0].select("still_id", "slow", "fast", r("intensity", "intensity", 1))


def _batch5(spark, d):
    """A batch of five panels and a beam for each image, with the peaks of each; images of no beam among them."""
    images = st.panelled(st.images(spark, d)).withColumns({"increment": F.lit(0.0), "data": F.transform("data", F.abs)})
    peaks = st.panelled(_image_peaks(spark, d))
    return orch.process_batch(images, st.panels(spark, d), st.beams(spark, d).where("image_id % 11 <> 4"), pixels.Extraction(), peaks=peaks)


_LEFT5 = "(select p.* from pixels5 p left join image_peaks k using (image_id, slow, fast) where k.slow is null and image_id % 11 <> 4)"


@query("O02_batch_with_models", sql("pixels reflections pixels5 image_peaks", f"select vec_id::int as image_id, 'stills' as route, case when vec_id % 11 = 4 then 'FAILURE' else 'SUCCESS' end as status, case when vec_id % 11 = 4 then 'no beam model' end as message, case when vec_id % 11 = 4 then 'DIALSModelIncomplete' end as error_code, coalesce(n, 0)::bigint as n_observations from embeddings left join (select image_id, count(*) as n from {_LEFT5} group by 1) on image_id = vec_id"))
def batch_with_models(spark, d):
    return _batch5(spark, d)[1]


@query("O02_observations_with_peaks", sql("pixels reflections pixels5 image_peaks panels beams placed5", f"select image_id as still_id, panel_id, slow, fast, round(abs(raw) * {_FACTOR5} / 1e6, 6) as intensity from (select *, sqrt(lab_x * lab_x + lab_y * lab_y + lab_z * lab_z) as r, 12398.4::double / wavelength as e from placed5) semi join {_LEFT5} using (image_id, slow, fast)"))
def observations_with_peaks(spark, d):
    return _batch5(spark, d)[0].select("still_id", "panel_id", "slow", "fast", r(F.col("intensity") / 1e6, "intensity"))


@query("O02_batch_summary", "select case when vec_id % 7 in (3, 5) then 'FAILURE' else 'SUCCESS' end as status, case vec_id % 7 when 3 then 'ProcessingError' when 5 then 'InputFileError' end as error_code, count(*) as n from embeddings group by all")
def batch_summary(spark, d):
    return orch.outcome_summary(_batch(spark, d)[1])


@query("O06_defaults", "select vec_id::int as image_id, case when vec_id % 4 = 0 then 2.5 else 1.0 end::double as gain, 0.02::double as cell_length_tolerance, 2.0::double as cell_angle_tolerance, 5.0::double as orientation_tolerance, 0.01::double as q_tolerance, case when vec_id % 3 = 0 then 4 else 1 end as pixel_step, false as lp_correction, 1000000.0::double as hot_pixel, 0.0::double as negative_pixel, 0.1::double as most_bad_pixels, 2 as peak_border, 0.1::double as least_partiality, 3 as min_spot_area from embeddings")
def defaults(spark, d):
    """The settings of each image: its own, where it has some, and the defaults."""
    k = F.col("image_id")
    own = st.beams(spark, d).select("image_id", F.when(k % 4 == 0, 2.5).alias("gain"), F.when(k % 3 == 0, 4).alias("pixel_step"))
    return orch.Defaults().filled(own)


def _indexed(spark, d):
    """What indexing gave of the images: reflections with beam vectors that are off, crystals of three groups."""
    found = _s1(spark, d).withColumn("image_id", (F.col("refl_id") % 37).cast("int")).where("image_id % 6 <> 5")
    group = F.when(F.col("still_id") % 3 == 0, "P 1").when(F.col("still_id") % 3 == 1, "P 2").otherwise("P 3")
    crystals = st.crystals(spark, d).withColumn("space_group", group).withColumnRenamed("still_id", "image_id").where("image_id % 9 <> 4")
    references = spark.createDataFrame(_CELLS, "space_group string, r_a double, r_b double, r_c double, r_alpha double, r_beta double, r_gamma double")
    images = st.beams(spark, d).select("image_id", F.when(F.col("image_id") % 2 == 0, 0.0).alias("increment"))
    return images, found, crystals, references


_INDEXED = f"""images as (select vec_id::int as image_id, case when vec_id % 2 = 0 then 'stills' else 'sequence' end as route from embeddings),
residuals as (select refl_id % 37 as image_id, count(*) as n, avg(partiality * 0.002::double) as mean, max(partiality * 0.002::double) as most from reflections where (refl_id % 37) % 6 <> 5 group by 1),
cells as (select still_id as image_id, space_group, case {_OFF} end as mismatch from (select *, case still_id % 3 when 0 then 'P 1' when 1 then 'P 2' else 'P 3' end as space_group from crystals) where still_id % 9 <> 4),
checked as (select i.image_id, route, n, mean, most, mismatch, case when c.image_id is null or n is null then null else mean <= 0.00095 and most <= 0.00475 end as q_ok, case when space_group <> 'P 3' then mismatch is null end as cell_ok from images i left join residuals using (image_id) left join cells c on c.image_id = i.image_id)"""
st.SQL["indexed"] = _INDEXED


@query("O05_process_and_validate", sql("reflections crystals indexed", "select image_id, route, case when q_ok is null then 'FAILURE_DIALS_PROCESSING' when q_ok and coalesce(cell_ok, true) then 'SUCCESS' else 'FAILURE_GEOMETRY_VALIDATION' end as status, case when q_ok is null then 'DIALS_PROCESSING_FAILED' when not (q_ok and coalesce(cell_ok, true)) then 'GEOMETRY_VALIDATION_FAILED' end as error_code, case when q_ok is null then 'no crystal or reflections' when q_ok and coalesce(cell_ok, true) then 'Processed and validated' else 'Validation failed' end as message, coalesce(n, 0)::bigint as n_reflections, round(mean, 9) as mean_residual, round(most, 9) as max_residual, q_ok, cell_ok, mismatch from checked"))
def process_and_validate(spark, d):
    """Route, processing, checks of the geometry and status of each image."""
    images, found, crystals, references = _indexed(spark, d)
    settings = orch.Defaults(q_tolerance=0.00095, cell_length_tolerance=0.004, cell_angle_tolerance=0.03)
    return rounded(orch.processed_and_validated(images, found, crystals, st.PANEL, (0.0, 0.0, -1.0), references, settings), 9)
