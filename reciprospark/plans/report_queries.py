"""Queries of the reports over stand-in observations and their merged map."""

from __future__ import annotations

from pyspark.sql import functions as F

from reciprospark.functions import vec
from reciprospark.operators import grid as grids
from reciprospark.operators import merging, reports
from reciprospark.plans import merging_queries as mq
from reciprospark.plans import stand_ins as st
from reciprospark.plans.registry import lister, r, rounded

QUERIES, ORACLES, query = lister()
sql = st.with_tables


def _obs(spark, d):
    return st.observations(spark, d).withColumn("q", vec.norm([F.col(c) for c in grids.Q]))


def _map(spark, d):
    obs, g = mq._applied(spark, d)
    v = merging.merge(obs, g)
    return v.withColumns({"I_merged_relative": F.round("I_merged_relative", 4), "Sigma_merged_relative": F.round("Sigma_merged_relative", 6)}), g


MAP = mq._centres(mq._merged_sql("applied"))
_Q = "sqrt(qx * qx + qy * qy + qz * qz)"
_BIN = "least(floor((v - lo) / (hi - lo) * 50), 49)::int"


@query("R01_radial_average", sql("obs", f"select {_BIN} as bin, round(min(lo + ({_BIN} + 0.5) * (hi - lo) / 50), 6) as q_mid, round(avg(intensity), 3) as mean, round(1.0 / sqrt(sum(1.0 / (sigma * sigma))), 5) as error, count(*) as n from (select *, {_Q} as v, min({_Q}) over () as lo, max({_Q}) over () as hi from obs) group by 1"))
def radial_average(spark, d):
    out = reports.radial_average(_obs(spark, d))
    return out.select("bin", r("q_mid", "q_mid"), r("mean", "mean", 3), r("error", "error", 5), "n")


@query("R02_occupancy", sql(st.APPLIED, "select min(n) as n_min, max(n) as n_max, round(avg(n), 6) as n_mean, median(n)::double as n_median, sum(n)::bigint as n_total, count(*) filter (n > 0) as n_filled, round(100.0 * count(*) filter (n < 3) / count(*), 6) as percent_under_3 from (select count(*) as n from applied group by voxel_idx)"))
def occupancy(spark, d):
    return rounded(reports.occupancy(_map(spark, d)[0]))


@query("R03_occupancy_histogram", sql(st.APPLIED, "select least(floor(ln(n / 1.0::double) / ln(most + 1.5::double) * 12), 11)::int as bin, count(*) as n from (select n, max(n) over () as most from (select count(*) as n from applied group by voxel_idx)) group by 1"))
def occupancy_histogram(spark, d):
    """Bins of equal ratio from one observation to beyond the most that a voxel has."""
    v = _map(spark, d)[0].withColumn("v", F.col("num_observations").cast("double"))
    return reports.log_histogram(v, "v", 1.0, float(v.agg(F.max("v")).first()[0] or 1.0) + 1.5, 12)


_STEPPED = f"(select *, I_merged_relative as i, Sigma_merged_relative as s, " + ", ".join(f"round_even({c}_center * {n}, 0)::bigint as {c.lower()}_step" for c, n in zip("HKL", st.NDIV, strict=True)) + f" from ({MAP}))"


@query("R04_slices", sql(st.APPLIED, " union all ".join(f"select '{c.upper()}' as axis, voxel_idx, h_step, k_step, l_step, round(i, 3) as intensity, round(s, 4) as sigma, round(case when s > 0 then i / s else 0 end, 3) as i_over_sigma, num_observations as occupancy from {_STEPPED}, (select floor((low_{c} + high_{c}) / 2.0)::bigint as mid from bounds) where {c}_step = mid" for c in "hkl")))
def map_slices(spark, d):
    v, g = _map(spark, d)
    out = reports.orthogonal_slices(v, g)
    return out.withColumns({"intensity": F.round("intensity", 3), "sigma": F.round("sigma", 4), "i_over_sigma": F.round("i_over_sigma", 3)})


@query("R05_positive_statistics", sql(st.APPLIED, f"select count(*) as n, count(*) filter (i > 0) as n_positive, round(avg(i) filter (i > 0), 3) as mean, round(median(i) filter (i > 0), 3) as median from (select I_merged_relative as i from {mq._merged_sql('applied')})"))
def positive_statistics(spark, d):
    return rounded(reports.positive_statistics(_map(spark, d)[0]), 3)


@query("R06_scale_summary", sql("scales", "select count(*) as n, " + ", ".join(f"round({e}, 6) as {n}" for n, e in (("mean", "avg(s)"), ("std", "stddev_pop(s)"), ("low", "min(s)"), ("high", "max(s)"), ("mean_less_std", "avg(s) - stddev_pop(s)"), ("mean_plus_std", "avg(s) + stddev_pop(s)"))) + " from (select multiplicative_scale as s from scales)"))
def scale_summary(spark, d):
    return rounded(reports.scale_summary(st.scales(spark, d)))


@query("R05_log_histogram", sql(st.APPLIED, f"select least(floor(ln(i / 100.0) / ln(1000.0) * 30), 29)::int as bin, count(*) as n from (select I_merged_relative as i from {mq._merged_sql('applied')}) where i between 100.0 and 100000.0 group by 1"))
def log_histogram(spark, d):
    """Merged intensities that are positive, in bins of equal ratio."""
    return reports.log_histogram(_map(spark, d)[0], "I_merged_relative", 100.0, 100_000.0, 30)


@query("R07_smoother_curve", sql("obs", f"select round(q0, 9) as q, round(case when q0 < 0.5 then 1.0 when q0 < 1.0 then 1.0 + (q0 - 0.5) * 0.4 when q0 < 1.5 then 1.2 - (q0 - 1.0) * 0.6 else 0.9 end, 9) as scale from {mq._PLACES}"))
def smoother_curve(spark, d):
    """A curve of control points over the range of the observations."""
    return rounded(reports.smoother_curve(_obs(spark, d), [(0.5, 1.0), (1.0, 1.2), (1.5, 0.9)]), 9)


@query("R08_map_summary", sql(st.APPLIED, f"select count(*) as n_voxels, round(100.0 * count(*) filter (i > 0) / count(*), 3) as percent_positive, round(avg(i / s), 3) as snr_mean, round(stddev_pop(i / s), 3) as snr_std, sum(n)::bigint as n_observations from (select I_merged_relative as i, Sigma_merged_relative as s, num_observations as n from {mq._merged_sql('applied')})"))
def map_summary(spark, d):
    return rounded(reports.map_summary(_map(spark, d)[0]), 3)


@query("R09_grid_summary", sql("obs hkl bounds", "select " + ", ".join(f"round((high_{c} - low_{c})::double / {n}, 6) as extent_{c}" for c, n in zip("hkl", st.NDIV, strict=True)) + " from bounds"))
def grid_summary(spark, d):
    e = st.grid(st.observations(spark, d)).summary()["extent"]
    return spark.createDataFrame([tuple(round(float(x), 6) for x in e)], "extent_h double, extent_k double, extent_l double")


@query("R10_extraction_summary", sql("obs", "select count(*) as n, round(min(intensity), 4) as i_min, round(max(intensity), 4) as i_max, round(avg(intensity), 4) as i_mean, round(avg(sigma), 4) as sigma_mean, round(avg(intensity / sigma), 4) as i_over_sigma_mean from obs"))
def extraction_summary(spark, d):
    return rounded(reports.extraction_summary(st.observations(spark, d)), 4)


@query("R11_snr_histogram", sql("obs", f"select {_BIN} as bin, count(*) as n from (select *, intensity / sigma as v, min(intensity / sigma) over () as lo, max(intensity / sigma) over () as hi from obs) group by 1"))
def snr_histogram(spark, d):
    return reports.histogram(reports.signal_to_noise(st.observations(spark, d)), "snr").select("bin", "n")


_RANGE = "(select *, intensity as v, min(intensity) over () as lo, max(intensity) over () as hi from obs)"


@query("R11_intensity_histogram", sql("obs", f"select {_BIN} as bin, round(min(lo + ({_BIN} + 0.5) * (hi - lo) / 50), 3) as centre, count(*) as n from {_RANGE} group by 1"))
def intensity_histogram(spark, d):
    return rounded(reports.histogram(st.observations(spark, d), "intensity"), 3)


@query("R11_sigma_by_intensity", sql("obs", f"select {_BIN} as bin, round(min(lo + ({_BIN} + 0.5) * (hi - lo) / 50), 3) as centre, round(avg(sigma), 3) as sigma, count(*) as n from {_RANGE} group by 1"))
def sigma_by_intensity(spark, d):
    return rounded(reports.sigma_by_intensity(st.observations(spark, d)), 3)


@query("R11_q_projections", sql("obs", " union all ".join(f"select '{a}{b}' as plane, floor(q{a} / 0.15)::int as i, floor(q{b} / 0.15)::int as j, count(*) as n, round(avg(intensity), 3) as mean from obs group by 2, 3" for a, b in ("xy", "xz", "yz"))))
def q_projections(spark, d):
    return rounded(reports.q_projections(st.observations(spark, d), 0.15), 3)


@query("R12_colour_limits", sql("obs", "select round(quantile_cont(intensity, 0.01), 4) as low, round(quantile_cont(intensity, 0.999), 4) as high from obs"))
def colour_limits(spark, d):
    return rounded(reports.colour_limits(st.observations(spark, d), "intensity"), 4)


@query("R13_heat_map", sql("pixels", "select panel_id, slow, fast, round(arg_max(raw, image_id), 6) as intensity from pixels group by all"))
def heat_map(spark, d):
    from reciprospark.operators.pixels import unfolded

    return rounded(reports.heat_map(unfolded(st.images(spark, d)).withColumnRenamed("raw", "intensity"), "image_id"))


@query("R15_partiality_statistics", sql("reflections", "select count(partiality) as n, round(avg(partiality), 6) as mean, round(min(partiality), 6) as low, round(max(partiality), 6) as high from reflections"))
def partiality_statistics(spark, d):
    return rounded(reports.spread_of(st.reflections(spark, d), "partiality"))


@query("T04_running_merge", sql(st.BINNED, "select voxel_idx, round(sum(intensity / (sigma * sigma + 1e-10)) / sum(1.0 / (sigma * sigma + 1e-10)), 4) as intensity, round(1.0 / sqrt(sum(1.0 / (sigma * sigma + 1e-10))), 6) as sigma, count(*) as n from binned group by 1"))
def running_merge(spark, d):
    from reciprospark.streaming.accumulate import running_merge as merge

    return merge(st.binned(spark, d)[0]).select("voxel_idx", r("intensity", "intensity", 4), r("sigma", "sigma"), "n")
