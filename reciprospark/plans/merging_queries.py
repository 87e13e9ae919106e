"""Queries of the grid, scaling and merging operators over the stand-in observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from reciprospark.functions import vec
from reciprospark.operators import grid as grids
from reciprospark.operators import grouped, merging, orchestration, scaling, symmetry
from reciprospark.plans import stand_ins as st
from reciprospark.plans.registry import lister, r, rounded
from reciprospark.schema import lacking
from reciprospark.sources import store
from reciprospark.sources.shared import scratch
from reciprospark.streaming import accumulate

QUERIES, ORACLES, query = lister()
sql = st.with_tables


def _applied(spark, d):
    b, g = st.binned(spark, d)
    out = scaling.applied(scaling.with_scales(b, st.scales(spark, d)))
    return out.withColumn("q", vec.norm([F.col(c) for c in grids.Q])), g




def _centres(of: str) -> str:
    """Centres of the voxels of a table of voxel_idx and other columns."""
    names = ", ".join(f"round({c}, 6) as {c}" for c in ("H_center", "K_center", "L_center", "q_center_x", "q_center_y", "q_center_z"))
    return f"""select * exclude (low_h, high_h, low_k, high_k, low_l, high_l, nh, nk) replace ({names}), round(sqrt(q_center_x * q_center_x + q_center_y * q_center_y + q_center_z * q_center_z), 6) as q_magnitude_center from (
select *, {st.QX} as q_center_x, {st.QY} as q_center_y, {st.QZ} as q_center_z from (
select *, (voxel_idx % nh + low_h)::double / {st.NDIV[0]} as H_center, ((voxel_idx % (nh * nk)) // nh + low_k)::double / {st.NDIV[1]} as K_center, (voxel_idx // (nh * nk) + low_l)::double / {st.NDIV[2]} as L_center
from {of}, (select *, high_h - low_h + 1 as nh, high_k - low_k + 1 as nk from bounds)))"""


def _merged_sql(of: str, least: int = 1) -> str:
    w = "1.0 / (sigma * sigma + 1e-10)"
    return f"(select voxel_idx, round(case when count(*) = 1 then first(intensity) else sum({w} * intensity) / sum({w}) end, 4) as I_merged_relative, round(case when count(*) = 1 then first(sigma) else 1.0 / sqrt(sum({w})) end, 6) as Sigma_merged_relative, count(*) as num_observations from {of} group by voxel_idx having count(*) >= {least})"


ENOUGH = "(select * from (select *, count(*) over (partition by voxel_idx) as c from applied) where c >= 2)"
REJECTED = f"""(select * from (select *, count(*) over v as n, max(near::int) over v as found from (select *, off <= 3.0 * 1.4826 * mad as near from (
select *, median(off) over (partition by voxel_idx) as mad from (select *, abs(intensity - med) as off from (select *, median(intensity) over (partition by voxel_idx) as med from {ENOUGH})))) window v as (partition by voxel_idx)) where n <= 2 or near or found = 0)"""


@query("M05_merge_pipeline", sql(st.APPLIED, _centres(_merged_sql(REJECTED, 2))))
def merge_pipeline(spark, d):
    obs, g = _applied(spark, d)
    out = merging.merge(obs, g, least=2, reject=3.0)
    return out.withColumns({c: F.round(c, 4 if c == "I_merged_relative" else 6) for c, t in out.dtypes if t == "double"})


@query("M02_count_per_voxel", sql(st.BINNED, "select voxel_idx, count(*) as n from binned group by 1"))
def count_per_voxel(spark, d):
    return st.binned(spark, d)[0].groupBy("voxel_idx").agg(F.count("*").alias("n"))


@query("M03_outlier_rejection", sql(st.APPLIED, f"select voxel_idx, count(*) as n, round(sum(intensity), 2) as total from {REJECTED} group by 1"))
def outlier_rejection(spark, d):
    out = merging.without_outliers(_applied(spark, d)[0], least=2)
    return out.groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum("intensity"), "total", 2))


@query("M04_weighted_merge", sql(st.APPLIED, "select * from " + _merged_sql("applied")))
def weighted_merge(spark, d):
    return rounded(merging.merged(_applied(spark, d)[0]).withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("M04_uniform_merge", sql(st.APPLIED, "select voxel_idx, round(avg(intensity), 4) as I_merged_relative, round(sqrt(sum(sigma * sigma)) / count(*), 6) as Sigma_merged_relative, count(*) as num_observations from applied group by 1"))
def uniform_merge(spark, d):
    return rounded(merging.merged(_applied(spark, d)[0], "uniform").withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("F07_min_observations", sql(st.APPLIED, "select voxel_idx, count(*) as n from applied group by 1 having count(*) >= 40"))
def min_observations(spark, d):
    return merging.observed_enough(_applied(spark, d)[0], 40).groupBy("voxel_idx").agg(F.count("*").alias("n"))


@query("M01_flatten_binned", sql(st.BINNED, "select voxel_idx, still_id, count(*) as n, round(sum(intensity), 2) as total, round(sum(sigma), 2) as sigmas from binned group by all"))
def flatten_binned(spark, d):
    flat = merging.flattened(merging.nested(st.binned(spark, d)[0], 40))  # most voxels come in several rows
    return flat.groupBy("voxel_idx", "still_id").agg(F.count("*").alias("n"), r(F.sum("intensity"), "total", 2), r(F.sum("sigma"), "sigmas", 2))


W = "1.0 / ((sigma / scale) * (sigma / scale) + 1e-10)"
REFERENCES = f"(select voxel_idx, sum({W} * intensity / scale) / sum({W}) as reference, 1.0 / sqrt(sum({W})) as reference_sigma, count(*) as n from scaled group by 1)"


def _scaled(spark, d):
    return scaling.with_scales(st.binned(spark, d)[0], st.scales(spark, d))


@query("M06_voxel_reference", sql(f"scales {st.BINNED} scaled", f"select voxel_idx, round(reference, 4) as reference, round(reference_sigma, 6) as reference_sigma, n from {REFERENCES}"))
def voxel_reference(spark, d):
    out = scaling.references(_scaled(spark, d))
    return out.select("voxel_idx", r("reference", "reference", 4), r("reference_sigma", "reference_sigma"), "n")


@query("J05_reference_window", sql(f"scales {st.BINNED} scaled", f"select voxel_idx, count(*) as n, round(sum(abs(intensity / scale - reference)), 2) as off from scaled join {REFERENCES} using (voxel_idx) group by 1"))
def reference_window(spark, d):
    out = scaling.with_references(_scaled(spark, d))
    return out.groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum(F.abs(F.col("intensity") / F.col("scale") - F.col("reference"))), "off", 2))


@query("F08_has_reference", sql(f"scales {st.BINNED} scaled", f"select count(*) as n, count(distinct voxel_idx) as n_voxels from scaled where voxel_idx in (select voxel_idx from {REFERENCES} where n >= 10)"))
def has_reference(spark, d):
    s = _scaled(spark, d)
    known = scaling.references(s).where("n >= 10").select("voxel_idx")
    return s.join(known, "voxel_idx", "left_semi").agg(F.count("*").alias("n"), F.countDistinct("voxel_idx").alias("n_voxels"))


@query("M07_r_factor", sql(f"scales {st.BINNED} scaled", f"select round(sum(abs(intensity / scale - reference)) / sum(intensity / scale), 9) as r_factor from scaled join {REFERENCES} using (voxel_idx)"))
def r_factor(spark, d):
    return rounded(scaling.r_factor(scaling.with_references(_scaled(spark, d))), 9)


@query("M08_normal_equations", sql(f"scales {st.BINNED} scaled", f"select still_id, round(sum(-(intensity / scale / scale) * (intensity / scale - reference)) / 1e9, 5) as jr, round(sum((intensity / scale / scale) * (intensity / scale / scale)) / 1e9, 5) as jj from scaled join {REFERENCES} using (voxel_idx) group by 1"))
def normal_equations(spark, d):
    sums = scaling.normal_sums(scaling.with_references(_scaled(spark, d)), scaling.ScaleModel({}))
    return sums.select("still_id", r(F.col("jr") / 1e9, "jr", 5), r(F.col("jj") / 1e9, "jj", 5))


def _rounds(n: int) -> str:
    """Tables s0 .. sn (still_id, b) of n rounds of refinement from scales of 1 over the table binned."""
    out = ["s0 as materialized (select distinct still_id, 1.0::double as b from binned)"]
    for k in range(n):
        w = "1.0 / ((sigma / b) * (sigma / b) + 1e-10)"
        out.append(f"ref{k} as materialized (select voxel_idx, sum({w} * intensity / b) / sum({w}) as reference from binned join s{k} using (still_id) group by 1)")
        out.append(f"s{k + 1} as materialized (select still_id, b - sum(-(intensity / b / b) * (intensity / b - reference)) / (sum((intensity / b / b) * (intensity / b / b)) + 1e-6) as b from binned join s{k} using (still_id) join ref{k} using (voxel_idx) group by still_id, b)")
    return ",\n".join(out)


st.SQL["refined3"] = _rounds(3)


@query("M09_refinement", sql(f"{st.BINNED} refined3", "select still_id, round(b / avg(b) over (), 6) as multiplicative_scale from s3"))
def refinement(spark, d):
    """Scales after three rounds, relative to their mean."""
    b, _ = st.binned(spark, d)
    model, _ = scaling.refine(b, rounds=3)
    return scaling.relative(model.scales).select("still_id", r("b", "multiplicative_scale"))


def _model(spark, d):
    return scaling.ScaleModel({row.still_id: row.multiplicative_scale for row in st.scales(spark, d).collect()})  # one number for each image


_BY_STILL = sql(f"scales {st.BINNED} scaled", "select still_id, round(min(scale), 9) as low, round(max(scale), 9) as high, count(*) as n from scaled group by 1")


@query("C01_scale_lookup", _BY_STILL)
def scale_lookup(spark, d):
    """Scales that the model holds as literals."""
    return _model(spark, d).scaled(st.binned(spark, d)[0]).groupBy("still_id").agg(r(F.min("scale"), "low", 9), r(F.max("scale"), "high", 9), F.count("*").alias("n"))


@query("J04_scale_join", _BY_STILL)
def scale_join(spark, d):
    """Scales joined from a table."""
    return _scaled(spark, d).groupBy("still_id").agg(r(F.min("scale"), "low", 9), r(F.max("scale"), "high", 9), F.count("*").alias("n"))


@query("C02_set_scale", sql("scales", "select still_id, round(case still_id when 2 then 1.75 else multiplicative_scale end, 9) as scale from scales"))
def set_scale(spark, d):
    model = _model(spark, d).with_scale(2, 1.75)
    return spark.createDataFrame([(k, round(v, 9)) for k, v in model.stills.items()], "still_id int, scale double")


def _raised(f) -> str:
    try:
        f()
    except ValueError:
        return "ValueError"
    return "none"


@query("C08_model_guards", "select * from (values ('two points', 'none'), ('six points', 'ValueError'), ('empty range', 'ValueError'), ('additive part', 'ValueError'), ('unknown still', 'ValueError'), ('negative scale', 'ValueError')) t(what, raised)")
def model_guards(spark, d):
    model = _model(spark, d)
    cases = {
        "two points": lambda: scaling.Smoother((1.0, 1.0), 0.0, 1.0), "six points": lambda: scaling.Smoother((1.0,) * 6, 0.0, 1.0), "empty range": lambda: scaling.Smoother((1.0,), 1.0, 1.0),
        "additive part": lambda: scaling.ScaleModel.start([0], components=("additive",)), "unknown still": lambda: model.with_scale(99, 1.0), "negative scale": lambda: model.with_scale(2, -1.0),
    }
    return spark.createDataFrame([(k, _raised(f)) for k, f in cases.items()], "what string, raised string")


_SMOOTHER = scaling.Smoother((1.0, 1.2, 0.9), 0.1, 1.5)
_X = "greatest(0.1, least(1.5, sqrt(qx * qx + qy * qy + qz * qz)))"
_WEIGHTS = [f"exp(-pow(({_X} - {p!r}) / 0.7, 2))" for p in _SMOOTHER.points]
_A = f"greatest(0.01, ({' + '.join(f'{v!r} * {w}' for v, w in zip(_SMOOTHER.values, _WEIGHTS, strict=True))}) / ({' + '.join(_WEIGHTS)}))"


@query("C03_resolution_smoother", sql("obs", f"select still_id, round(avg(a), 6) as mean, round(min(a), 6) as low, round(max(a), 6) as high from (select still_id, {_A} as a from obs) group by 1"))
def resolution_smoother(spark, d):
    obs = st.observations(spark, d).withColumn("a", _SMOOTHER.column(vec.norm([F.col(c) for c in grids.Q])))
    return obs.groupBy("still_id").agg(r(F.avg("a"), "mean"), r(F.min("a"), "low"), r(F.max("a"), "high"))


_WINDOWED = scaling.WindowedSmoother((1.0, 1.2, 0.9, 1.1, 1.0), 0.1, 1.5)
_LOW = f"greatest(least(floor(({_X} - {_WINDOWED.points[0]!r}) / {_WINDOWED.spacing!r} - 1 + 0.5), 2), 0)"
_NEAR = [f"case when lo <= {k} and lo + 3 > {k} then exp(-pow(({_X} - {p!r}) / {0.65 * _WINDOWED.spacing!r}, 2)) else 0 end" for k, p in enumerate(_WINDOWED.points)]


@query("C03_windowed_smoother", sql("obs", f"select still_id, round(avg(a), 6) as mean, round(min(a), 6) as low, round(max(a), 6) as high from (select still_id, greatest(0.01, ({' + '.join(f'{v!r} * ({w})' for v, w in zip(_WINDOWED.values, _NEAR, strict=True))}) / ({' + '.join(f'({w})' for w in _NEAR)})) as a from (select *, {_LOW} as lo from obs)) group by 1"))
def windowed_smoother(spark, d):
    """A scale by |q| of which the three nearest control points count."""
    obs = st.observations(spark, d).withColumn("a", _WINDOWED.column(vec.norm([F.col(c) for c in grids.Q])))
    return obs.groupBy("still_id").agg(r(F.avg("a"), "mean"), r(F.min("a"), "low"), r(F.max("a"), "high"))


@query("C04_q_magnitude", sql("obs", "select still_id, round(avg(sqrt(qx * qx + qy * qy + qz * qz)), 6) as q from obs group by 1"))
def q_magnitude(spark, d):
    return st.observations(spark, d).groupBy("still_id").agg(r(F.avg(vec.norm([F.col(c) for c in grids.Q])), "q"))


_MODEL = scaling.ScaleModel({0: 1.1, 1: 0.9, 2: 1.05, 4: 1.2}, _SMOOTHER)
_B = "case still_id when 0 then 1.1::double when 1 then 0.9 when 2 then 1.05 when 4 then 1.2 else 1.0 end"


def _modelled(spark, d):
    return _MODEL.scaled(st.observations(spark, d).withColumn("q", vec.norm([F.col(c) for c in grids.Q])))


@query("C05_total_scale", sql("obs", f"select still_id, round(avg({_B} * {_A}), 6) as scale from obs group by 1"))
def total_scale(spark, d):
    return _modelled(spark, d).groupBy("still_id").agg(r(F.avg("scale"), "scale"))


@query("C06_scale_jacobian", sql("obs", f"select still_id, round(avg({_A}), 6) as by_still, " + ", ".join(f"round(avg({_B} * {w} / ({' + '.join(_WEIGHTS)})), 6) as by_point_{k}" for k, w in enumerate(_WEIGHTS)) + " from obs group by 1"))
def scale_jacobian(spark, d):
    m = _modelled(spark, d)
    a, b = _SMOOTHER.column(F.col("q")), F.col("scale") / _SMOOTHER.column(F.col("q"))
    return m.groupBy("still_id").agg(r(F.avg(a), "by_still"), *[r(F.avg(b * w), f"by_point_{k}") for k, w in enumerate(_SMOOTHER.weights(F.col("q")))])


@query("C07_apply_scale", sql(st.APPLIED, "select still_id, round(avg(intensity), 4) as intensity, round(avg(sigma), 6) as sigma from applied group by 1"))
def apply_scale(spark, d):
    return _applied(spark, d)[0].groupBy("still_id").agg(r(F.avg("intensity"), "intensity", 4), r(F.avg("sigma"), "sigma"))


@query("C09_model_info", sql("scales", "select count(*) as n_stills, round(avg(multiplicative_scale), 6) as mean, round(stddev_pop(multiplicative_scale), 6) as std, round(min(multiplicative_scale), 6) as low, round(max(multiplicative_scale), 6) as high from scales"))
def model_info(spark, d):
    return rounded(scaling.model_info(st.scales(spark, d)))


@query("C09_driver_info", sql("scales", "select count(*) as n_parameters, round(avg(multiplicative_scale), 6) as mean, round(max(multiplicative_scale), 6) as high from scales"))
def driver_info(spark, d):
    info = _model(spark, d).info()
    return spark.createDataFrame([(info["n_parameters"], round(info["mean"], 6), round(info["max"], 6))], "n_parameters long, mean double, high double")


# grid


@query("G01_mean_cell", sql("crystals", "select " + ", ".join(f"round(avg({c}), 6) as {c}" for c in grids.CELL) + " from crystals"))
def mean_cell(spark, d):
    return spark.createDataFrame([tuple(round(x, 6) for x in grids.mean_cell(st.crystals(spark, d)))], ", ".join(f"{c} double" for c in grids.CELL))


@query("G02_orientation_spread", sql("crystals", "select round(sqrt(avg(g * g)), 5) as rms, count(*) as n from (select degrees(acos(greatest(least(cos(t.turn) * cos(f.turn) + sin(t.turn) * sin(f.turn) + sin(t.turn) * sin(f.turn) + cos(t.turn) * cos(f.turn) + 1.0, 3.0), -1.0) / 2 - 0.5)) as g from crystals t, (select turn from crystals order by still_id limit 1) f)"))
def orientation_spread(spark, d):
    return rounded(grids.orientation_spread(st.crystals(spark, d)), 5)


_ANGLE = "degrees(acos(greatest(least(2 * cos(t.turn - f.turn) + 1.0, 3.0), -1.0) / 2 - 0.5))"


@query("J11_first_crystal", sql("crystals", f"select still_id, round({_ANGLE}, 4) as angle from crystals t, (select turn from crystals order by still_id limit 1) f"))
def first_crystal(spark, d):
    return grids.misorientations(st.crystals(spark, d)).select("still_id", r("angle", "angle", 4))


@query("M24_rms_misorientation", sql("crystals", f"select round(sqrt(avg(g * g)), 4) as rms, sqrt(avg(g * g)) > 0.2 as warned, sqrt(avg(g * g)) > 2.0 as refused from (select {_ANGLE} as g from crystals t, (select turn from crystals order by still_id limit 1) f)"))
def rms_misorientation(spark, d):
    """The check that a grid makes of its crystals: its value, and whether it warns or refuses."""
    try:
        rms, warned, refused = *grids.check_spread(st.crystals(spark, d), most=2.0, warn=0.2), False
    except ValueError:
        rms, warned, refused = float("nan"), True, True
    return spark.createDataFrame([(round(rms, 4), bool(warned), refused)], "rms double, warned boolean, refused boolean")


@query("G03_mean_orientation", sql("crystals", "select round(cos(a), 6) as u0, round(-sin(a), 6) as u1, 0.0::double as u2, round(sin(a), 6) as u3, round(cos(a), 6) as u4 from (select atan2(avg(sin(turn)), avg(cos(turn))) as a from crystals)"))
def mean_orientation(spark, d):
    u = grids.mean_orientation(st.crystals(spark, d)).ravel()
    return spark.createDataFrame([tuple(round(float(x), 6) + 0.0 for x in u[:5])], "u0 double, u1 double, u2 double, u3 double, u4 double")


_CELL = "(select avg(a) as a, avg(b) as b, avg(c) as c, cos(radians(avg(alpha))) as ca, cos(radians(avg(beta))) as cb, cos(radians(avg(gamma))) as cg, sin(radians(avg(gamma))) as sg, atan2(avg(sin(turn)), avg(cos(turn))) as t from crystals)"
_REAL = f"(select *, a as r11, b * cg as r12, c * cb as r13, b * sg as r22, c * (ca - cb * cg) / sg as r23, c * sqrt(1 - ca * ca - cb * cb - cg * cg + 2 * ca * cb * cg) / sg as r33 from {_CELL})"
_BASIS = f"(select t, 1 / r11 as b00, -r12 / (r11 * r22) as b10, (r12 * r23 - r13 * r22) / (r11 * r22 * r33) as b20, 1 / r22 as b11, -r23 / (r22 * r33) as b21, 1 / r33 as b22 from {_REAL})"
_SETTING = [("cos(t) * b00 - sin(t) * b10", "-sin(t) * b11", "0.0::double"), ("sin(t) * b00 + cos(t) * b10", "cos(t) * b11", "0.0::double"), ("b20", "b21", "b22")]


@query("G04_setting_matrix", sql("crystals", " union all ".join(f"select {k} as row, " + ", ".join(f"round({x}, 6) + 0.0 as c{j}" for j, x in enumerate(row)) + f" from {_BASIS}" for k, row in enumerate(_SETTING))))
def setting_matrix(spark, d):
    a = grids.setting_matrix(st.crystals(spark, d))
    return spark.createDataFrame([(k, *[round(x, 6) + 0.0 for x in row]) for k, row in enumerate(a)], "row int, c0 double, c1 double, c2 double")


@query("G05_hkl_transform", sql("obs hkl", "select still_id, round(avg(h), 6) as h, round(avg(k), 6) as k, round(avg(l), 6) as l from hkl group by 1"))
def hkl_transform(spark, d):
    return grids.with_hkl(st.observations(spark, d), st.inverse()).groupBy("still_id").agg(*[r(F.avg(c), c) for c in grids.HKL])


@query("G06_grid_bounds", sql("obs hkl bounds", "select low_h, high_h, low_k, high_k, low_l, high_l from bounds"))
def grid_bounds(spark, d):
    return grids.hkl_bounds(grids.with_hkl(st.observations(spark, d), st.inverse()), st.NDIV)


_D = "1.0 / (sqrt(qx * qx + qy * qy + qz * qz) + 1e-10)"


@query("F05_resolution_range", sql("obs", f"select still_id, count(*) as n from obs where {_D} between 0.6 and 1.5 group by 1"))
def resolution_range(spark, d):
    return grids.in_resolution(st.observations(spark, d), 0.6, 1.5).groupBy("still_id").agg(F.count("*").alias("n"))


@query("P06_grid_d", sql("obs", f"select still_id, round(avg(d), 6) as d from (select still_id, least({_D}, 100.0) as d from obs) group by 1"))
def grid_d(spark, d):
    from reciprospark.operators.pixels import grid_d_spacing

    obs = st.observations(spark, d).withColumn("d", F.least(grid_d_spacing(vec.norm([F.col(c) for c in grids.Q])), F.lit(100.0)))
    return obs.groupBy("still_id").agg(r(F.avg("d"), "d"))


@query("G07_voxel_count", sql("obs hkl bounds", "select (high_h - low_h + 1) * (high_k - low_k + 1) * (high_l - low_l + 1) as n from bounds"))
def voxel_count(spark, d):
    return spark.createDataFrame([(st.grid(st.observations(spark, d)).total_voxels,)], "n long")



@query("G08_symmetry", sql("obs hkl", "select round(m.h, 9) as h, round(m.k, 9) as k, round(m.l, 9) as l, count(*) as n from (select greatest(" + ", ".join(f"{{'h': {a}, 'k': {b}, 'l': {c}}}" for a, b, c in (("h", "k", "l"), ("-h", "-k", "l"), ("-h", "k", "-l"), ("h", "-k", "-l"))) + ") as m from hkl) group by all"))
def symmetry_reduction(spark, d):
    out = symmetry.reduced(grids.with_hkl(st.observations(spark, d), st.inverse()), symmetry.operations("P222"))
    return out.groupBy(*[r(c, c, 9) for c in grids.HKL]).agg(F.count("*").alias("n"))


@query("G08_mirrors_and_inversion", sql("obs hkl", "select round(sum(abs(h)) / 1e3, 6) as h, round(sum(abs(k)) / 1e3, 6) as k, round(sum(abs(l)) / 1e3, 6) as l, still_id, count(*) as n from hkl group by still_id"))
def mirrors_and_inversion(spark, d):
    """Indices reduced by a group with mirrors, from its full symbol: the greatest of eight mates has no negative index."""
    out = symmetry.reduced(grids.with_hkl(st.observations(spark, d), st.inverse()), symmetry.operations("P n m a"))
    return out.groupBy("still_id").agg(*[r(F.sum(c) / 1e3, c) for c in grids.HKL], F.count("*").alias("n"))


@query("G08_hexagonal_indices", sql("obs hkl", "select still_id, count(*) as n, round(sum(greatest(h, k, -h - k, -h, -k, h + k)) / 1e3, 6) as h from hkl group by still_id"))
def hexagonal_indices(spark, d):
    """Indices reduced by a sixfold axis with inversion: mates h k l, -k h+k l, ... and their negatives, of which the greatest first index counts."""
    out = symmetry.reduced(grids.with_hkl(st.observations(spark, d), st.inverse()), symmetry.for_indices(symmetry.operations("P 6/m")))
    return out.groupBy("still_id").agg(F.count("*").alias("n"), r(F.sum("h") / 1e3, "h"))


@query("G09_subdivide", sql("obs hkl", "select " + ", ".join(f"round_even({c} * {n}, 0)::bigint as s{c}" for c, n in zip("hkl", st.NDIV, strict=True)) + ", count(*) as n from hkl group by all"))
def subdivide(spark, d):
    hkl = grids.with_hkl(st.observations(spark, d), st.inverse())
    return hkl.groupBy(*[s.alias(f"s{c}") for s, c in zip(grids.subdivided(st.NDIV), "hkl", strict=True)]).agg(F.count("*").alias("n"))


@query("G10_linear_index", sql(st.BINNED, "select voxel_idx, still_id, count(*) as n from binned group by all"))
def linear_index(spark, d):
    return st.binned(spark, d)[0].groupBy("voxel_idx", "still_id").agg(F.count("*").alias("n"))


_NARROW = sql("obs hkl bounds", "select still_id, count(*) as n from (select hkl.*, bounds.*, " + ", ".join(f"round_even({c} * {n}, 0)::bigint as s{c}" for c, n in zip("hkl", st.NDIV, strict=True)) + " from hkl, bounds) where sh between low_h + 2 and high_h - 2 and sk between low_k + 2 and high_k - 2 and sl between low_l + 2 and high_l - 2 group by 1")


@query("F06_voxel_bounds", _NARROW)
def voxel_bounds(spark, d):
    """A grid that is too small by two steps on each side: what falls outside goes."""
    obs = st.observations(spark, d)
    g = st.grid(obs)
    small = grids.Grid(g.setting, g.ndiv, tuple(x + 2 for x in g.low), tuple(x - 2 for x in g.high))
    return grids.binned(obs, small).groupBy("still_id").agg(F.count("*").alias("n"))


@query("G11_index_to_centre", sql(st.BINNED, _centres("(select distinct voxel_idx from binned)")))
def index_to_centre(spark, d):
    b, g = st.binned(spark, d)
    return rounded(grids.with_centres(b.select("voxel_idx").distinct(), g))


@query("G12_centre_q", sql(st.BINNED, f"select still_id, round(avg(sqrt(pow(qx - q_center_x, 2) + pow(qy - q_center_y, 2) + pow(qz - q_center_z, 2))), 6) as off from binned join ({_centres('(select distinct voxel_idx from binned)')}) using (voxel_idx) group by 1"))
def centre_q(spark, d):
    """How far observations are from the centres of their voxels."""
    b, g = st.binned(spark, d)
    centres = rounded(grids.with_centres(b.select("voxel_idx").distinct(), g)).select("voxel_idx", *[F.col(f"q_center_{x}").alias(f"_{x}") for x in "xyz"])
    off = vec.norm([F.col(f"q{x}") - F.col(f"_{x}") for x in "xyz"])
    return b.join(centres, "voxel_idx").groupBy("still_id").agg(r(F.avg(off), "off"))


@query("G14_grid_validation", "select * from (values ('no subdivision', 'ValueError'), ('too many voxels', 'ValueError'), ('one limit', 'ValueError'), ('limits in the wrong order', 'ValueError'), ('nothing in range', 'ValueError'), ('a valid range', 'none')) t(what, raised)")
def grid_validation(spark, d):
    obs = st.observations(spark, d)
    cases = {
        "no subdivision": lambda: grids.Grid(st.SETTING, (0, 1, 1), (0, 0, 0), (1, 1, 1)), "too many voxels": lambda: grids.Grid(st.SETTING, (1, 1, 1), (0, 0, 0), (1 << 30,) * 3),
        "one limit": lambda: grids.fit(obs, st.SETTING, st.NDIV, 1.0), "limits in the wrong order": lambda: grids.fit(obs, st.SETTING, st.NDIV, 2.0, 1.0),
        "nothing in range": lambda: grids.fit(obs, st.SETTING, st.NDIV, 1e6, 1e7), "a valid range": lambda: grids.fit(obs, st.SETTING, st.NDIV, 0.6, 4.0),
    }
    return spark.createDataFrame([(k, _raised(f)) for k, f in cases.items()], "what string, raised string")


@query("G13_grid_diagnostics", sql("crystals obs hkl", "select count(*) as n_observations, 0::bigint as n_outside, " + ", ".join(f"round(min({c}), 4) as min_{c}, round(max({c}), 4) as max_{c}" for c in "hkl") + ", round(sqrt(avg(" + " + ".join(f"pow({c} - round_even({c}, 0), 2)" for c in "hkl") + f")), 4) as rms_delta_hkl, (select round(sqrt(avg(g * g)), 4) from (select {_ANGLE} as g from crystals t, (select turn from crystals order by still_id limit 1) f)) as rms_misorientation, (select count(*) from crystals) as n_crystals from hkl"))
def grid_diagnostics(spark, d):
    obs = st.observations(spark, d)
    return rounded(grids.diagnostics(obs, st.crystals(spark, d), st.grid(obs)), 4)


@query("G15_frame_transform", sql("obs hkl", "select still_id, round(avg(case when still_id < 3 then qx * 0.8::double else h end), 6) as h from hkl group by 1"))
def frame_transform(spark, d):
    frames = spark.range(3).select(F.col("id").cast("int").alias("frame_idx"), F.array(*[F.lit(x) for x in (0.8, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)]).alias("a_inv"))
    out = grids.with_frame_hkl(st.observations(spark, d).withColumn("frame_idx", F.col("still_id")), frames, st.inverse())
    return out.groupBy("still_id").agg(r(F.avg("h"), "h"))


# statistics of the map


@query("M21_merge_statistics", sql(st.APPLIED, f"""select count(*) as n_voxels, round(avg(i), 3) as i_mean, round(stddev_pop(i), 3) as i_std, round(min(i), 3) as i_min, round(max(i), 3) as i_max, round(median(i), 3) as i_median, round(avg(n), 6) as obs_mean, sum(n)::bigint as obs_total,
count(*) filter (n = 1) as n_single, max(n) as obs_max, round(min(q), 6) as q_min, round(max(q), 6) as q_max, round(avg(q), 6) as q_mean, round(avg(s / (i + 1e-10)), 6) as rel_mean, count(*) filter (i > b) as n_high, count(*) filter (s / (i + 1e-10) < 0.1) as n_precise
from (select I_merged_relative as i, Sigma_merged_relative as s, num_observations as n, q_magnitude_center as q, avg(I_merged_relative) over () + 2 * stddev_pop(I_merged_relative) over () as b from ({_centres(_merged_sql('applied'))}))"""))
def merge_statistics(spark, d):
    obs, g = _applied(spark, d)
    v = merging.merge(obs, g)
    v = v.withColumns({"I_merged_relative": F.round("I_merged_relative", 4), "Sigma_merged_relative": F.round("Sigma_merged_relative", 6)})
    out = merging.merge_statistics(v)
    return out.select(*[(F.round(c, 3 if c.startswith("i_") else 6) if t == "double" else F.col(c)).alias(c) for c, t in out.dtypes])


@query("M22_accumulation_statistics", sql(st.BINNED, "select sum(n)::bigint as n_observations, count(*) as n_voxels, round(avg(n), 6) as mean_n, round(stddev_pop(n), 6) as std_n, min(n) as min_n, max(n) as max_n from (select count(*) as n from binned group by voxel_idx)"))
def accumulation_statistics(spark, d):
    return rounded(merging.accumulation_statistics(st.binned(spark, d)[0]))


@query("M23_still_counts", sql(st.BINNED, "select still_id, count(*) as n_observations, count(distinct voxel_idx) as n_voxels from binned group by 1"))
def still_counts(spark, d):
    return merging.still_counts(st.binned(spark, d)[0])


@query("M25_running_statistics", sql(st.BINNED, "select voxel_idx, count(*) as n, round(avg(intensity), 4) as mean, round(var_pop(intensity) / 1e6, 4) as variance from binned group by 1"))
def running_statistics(spark, d):
    out = accumulate.running_statistics(st.binned(spark, d)[0])
    return out.select("voxel_idx", "n", r("mean", "mean", 4), r(F.col("variance") / 1e6, "variance", 4))


def _stored(spark, d, parts: int = 1):
    """The binned observations in a store that is dealt by voxel, written in parts."""
    b, g = st.binned(spark, d)
    path = scratch(spark, "store")
    store.create(b.where(F.pmod("obs_id", F.lit(parts)) == 0), path)
    for k in range(1, parts):
        store.append(b.where(F.pmod("obs_id", F.lit(parts)) == k), path)
    return path, g


@query("K05_voxel_store", sql(st.BINNED, "select voxel_idx, count(*) as n, round(sum(intensity) / 1e3, 2) as total from binned group by 1"))
def voxel_store(spark, d):
    """A store written in three parts; what groups by voxel needs no shuffle."""
    return store.opened(spark, _stored(spark, d, 3)[0]).groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum("intensity") / 1e3, "total", 2))


@query("L01_stored_lookup", sql(st.BINNED, "select obs_id, voxel_idx, still_id, round(intensity, 4) as intensity from binned where voxel_idx in (select max(voxel_idx) from binned union all select min(voxel_idx) from binned)"))
def stored_lookup(spark, d):
    """Observations of the first and the last voxel that is occupied: a read of their buckets."""
    path, _ = _stored(spark, d)
    ends = store.opened(spark, path).agg(F.min("voxel_idx").alias("low"), F.max("voxel_idx").alias("high")).first()
    return store.lookup(spark, path, ends.low, ends.high).select("obs_id", "voxel_idx", "still_id", r("intensity", "intensity", 4))


@query("M06_stored_reference", ORACLES["M06_voxel_reference"])
def stored_reference(spark, d):
    scaled = scaling.with_scales(store.opened(spark, _stored(spark, d)[0]), st.scales(spark, d))
    return scaling.references(scaled).select("voxel_idx", r("reference", "reference", 4), r("reference_sigma", "reference_sigma"), "n")


@query("M03_stored_rejection", ORACLES["M03_outlier_rejection"])
def stored_rejection(spark, d):
    applied = scaling.applied(scaling.with_scales(store.opened(spark, _stored(spark, d)[0]), st.scales(spark, d)))
    return merging.without_outliers(applied, least=2).groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum("intensity"), "total", 2))


@query("L01_point_lookup", sql(st.BINNED, "select still_id, count(*) as n, round(sum(intensity), 2) as total from binned where voxel_idx = (select min(voxel_idx) from binned) group by 1"))
def point_lookup(spark, d):
    b, _ = st.binned(spark, d)
    index = b.agg(F.min("voxel_idx")).first()[0]
    return merging.of_voxel(b, index).groupBy("still_id").agg(F.count("*").alias("n"), r(F.sum("intensity"), "total", 2))


@query("L02_binned_export", sql(st.BINNED, "select voxel_idx, still_id, round(intensity, 4) as intensity, round(sigma, 6) as sigma from binned"))
def binned_export(spark, d):
    return st.binned(spark, d)[0].select("voxel_idx", "still_id", r("intensity", "intensity", 4), r("sigma", "sigma"))


@query("L06_union_stills", sql("obs", "select still_id, count(*) as n, round(sum(intensity) / 1e6, 4) as total from obs group by 1"))
def union_stills(spark, d):
    """The union of the tables of all stills."""
    obs = st.observations(spark, d)
    stills = [row.still_id for row in obs.select("still_id").distinct().collect()]  # one number for each image
    out = merging.concatenated([obs.where(F.col("still_id") == k) for k in stills])
    return out.groupBy("still_id").agg(F.count("*").alias("n"), r(F.sum("intensity") / 1e6, "total", 4))


@query("F16_still_selection", sql("obs", "select count(*) as n, round(avg(intensity), 4) as mean from obs where still_id = 2"))
def still_selection(spark, d):
    return st.observations(spark, d).where("still_id = 2").agg(F.count("*").alias("n"), r(F.avg("intensity"), "mean", 4))


_ODD = "case when obs_id % 5 = 0 then -intensity when obs_id % 7 = 0 then 'nan'::double when obs_id % 11 = 0 then 'inf'::double else intensity end"


@query("F14_positive_finite", sql("obs", f"select count(*) as n, count(*) filter (i > 0) as n_positive, round(sum(i / s) filter (i > 0) / 1e3, 4) as snr from (select {_ODD} as i, case when obs_id % 13 = 0 then 0.0 else sigma end as s from obs) where isfinite(i) and s <> 0"))
def positive_finite(spark, d):
    """Observations some of which are negative, not a number, infinite or without an error."""
    from reciprospark.operators.reports import signal_to_noise

    k = F.col("obs_id")
    i = F.when(k % 5 == 0, -F.col("intensity")).when(k % 7 == 0, float("nan")).when(k % 11 == 0, float("inf")).otherwise(F.col("intensity"))
    obs = st.observations(spark, d).withColumn("intensity", i).withColumn("sigma", F.when(k % 13 == 0, 0.0).otherwise(F.col("sigma")))
    found, positive = signal_to_noise(obs), F.col("intensity") > 0
    return found.agg(F.count("*").alias("n"), F.count_if(positive).alias("n_positive"), r(F.sum(F.when(positive, F.col("snr"))) / 1e3, "snr", 4))


st.SQL["near"] = f"near as (select * from hkl where {_D} between {st.D_MIN} and {st.D_MAX})"
st.SQL["near_bounds"] = st.SQL["bounds"].replace("from hkl", "from near")
st.SQL["refined2"] = _rounds(2)
st.SQL["phase"] = "applied as (select voxel_idx, still_id, intensity / b as intensity, sigma / abs(b) as sigma from binned join s2 using (still_id))"


@query("O04_merge_phase", sql("obs hkl near near_bounds binned refined2 phase", _centres(_merged_sql(REJECTED, 2))))
def merge_phase(spark, d):
    """Grid, refinement and merge of all stills with the defaults of a batch."""
    out, _ = orchestration.merge_phase(st.observations(spark, d), st.SETTING, orchestration.MergePhase(d_min=st.D_MIN, d_max=st.D_MAX, ndiv=st.NDIV, rounds=2))
    return rounded(out.withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("O03_merge_gate", "select vec_id // 3 as batch, count(*) filter (vec_id % 7 not in (3, 5)) as n_outputs, count(*) filter (vec_id % 7 not in (3, 5)) >= 2 as may_merge from embeddings group by 1")
def merge_gate(spark, d):
    """Which batches of three images go on to merging: those with two outputs at least."""
    outcomes = st.table(spark, d, "embeddings").select(F.expr("vec_id div 3").alias("batch"), F.when((F.col("vec_id") % 7).isin(3, 5), "FAILURE").otherwise("SUCCESS").alias("status"))
    return orchestration.gate(outcomes, orchestration.MergePhase(), "batch")


@query("X07_voxel_integration", sql(st.BINNED, "select voxel_idx, round(sum(intensity), 2) as counts, count(*) as pixels, round(sum(still_id * intensity) / sum(intensity), 6) as mean_frame from binned group by 1"))
def voxel_integration(spark, d):
    out = merging.integrated(st.binned(spark, d)[0])
    return out.select("voxel_idx", r("counts", "counts", 2), "pixels", r("mean_frame", "mean_frame"))


# group functions, retrieval, and what is specified beyond the core


@query("U01_group_rejection", sql(st.APPLIED, f"select voxel_idx, count(*) as n, round(sum(intensity), 2) as total from {REJECTED} group by 1"))
def group_rejection(spark, d):
    out = grouped.without_outliers(merging.observed_enough(_applied(spark, d)[0], 2).select("voxel_idx", "intensity"))
    return out.groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum("intensity"), "total", 2))


@query("U02_group_merge", sql(st.APPLIED, "select * from " + _merged_sql("applied")))
def group_merge(spark, d):
    return rounded(grouped.merged(_applied(spark, d)[0].select("voxel_idx", "intensity", "sigma")).withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("U03_group_reference", ORACLES["M06_voxel_reference"])
def group_reference(spark, d):
    out = grouped.references(_scaled(spark, d))
    return out.select("voxel_idx", r("reference", "reference", 4), r("reference_sigma", "reference_sigma"), "n")


@query("U04_scale_components", ORACLES["C05_total_scale"])
def scale_components(spark, d):
    """The same total scale, from two components of one's own."""
    known = F.create_map(*[F.lit(x) for pair in _MODEL.stills.items() for x in pair])
    parts = [lambda obs: F.coalesce(F.try_element_at(known, obs["still_id"]), F.lit(1.0)), lambda obs: _SMOOTHER.column(vec.norm([obs[c] for c in grids.Q]))]
    return scaling.product(parts, st.observations(spark, d)).groupBy("still_id").agg(r(F.avg("scale"), "scale"))


_PLACES = "(select low + (high - low) * k / 99 as q0 from (select min(sqrt(qx * qx + qy * qy + qz * qz)) as low, max(sqrt(qx * qx + qy * qy + qz * qz)) as high from obs), range(100) t(k))"


@query("U05_evaluated_smoother", sql("obs", f"select round(q0, 9) as q, round(greatest(0.01, ({' + '.join(f'{v!r} * exp(-pow((x - {p!r}) / 0.7, 2))' for v, p in zip(_SMOOTHER.values, _SMOOTHER.points, strict=True))}) / ({' + '.join(f'exp(-pow((x - {p!r}) / 0.7, 2))' for p in _SMOOTHER.points)})), 9) as scale from (select q0, greatest(0.1, least(1.5, q0)) as x from {_PLACES})"))
def evaluated_smoother(spark, d):
    """Any Python function of one |q|, evaluated for a curve over the range of the observations."""
    from reciprospark.operators.reports import evaluated

    obs = st.observations(spark, d).withColumn("q", vec.norm([F.col(c) for c in grids.Q]))
    return rounded(evaluated(obs, _SMOOTHER.at), 9)


_MATES = [("h", "k", "l"), ("-h", "-k", "l"), ("-h", "k", "-l"), ("h", "-k", "-l")]


@query("J13_symmetry_operations", sql("obs hkl", " union all ".join(f"select {n} as op, count(*) as n, round(avg({a}), 6) as h, round(avg({b}), 6) as k, round(avg({c}), 6) as l from hkl" for n, (a, b, c) in enumerate(_MATES))))
def symmetry_operations(spark, d):
    """Each observation by each operation of the group."""
    out = symmetry.mates(grids.with_hkl(st.observations(spark, d), st.inverse()), symmetry.operations("P 21 21 21"))
    return out.groupBy("op").agg(F.count("*").alias("n"), *[r(F.avg(c), c) for c in grids.HKL])


_P4212 = [("h", "k", "l"), ("-k", "h", "l"), ("-h", "-k", "l"), ("k", "-h", "l"), ("h", "-k", "-l"), ("k", "h", "-l"), ("-h", "k", "-l"), ("-k", "-h", "-l")]


@query("G08_space_group", sql("obs hkl", "select round(m.h, 6) as h, round(m.k, 6) as k, round(m.l, 6) as l, count(*) as n from (select greatest(" + ", ".join(f"{{'h': {a}, 'k': {b}, 'l': {c}}}" for a, b, c in _P4212) + ") as m from (select round(h, 6) as h, round(k, 6) as k, round(l, 6) as l from hkl)) group by all"))
def space_group(spark, d):
    """A group by its symbol, and the same from the crystal's own operations."""
    own = symmetry.parsed(["x,y,z", "-y+1/2,x+1/2,z+3/4", "-x,-y,z+1/2", "y+1/2,-x+1/2,z+1/4", "x+1/2,-y+1/2,-z+1/4", "y,x,-z", "-x+1/2,y+1/2,-z+3/4", "-y,-x,-z+1/2"])
    if set(own) != set(symmetry.operations("P 43 21 2")):
        raise AssertionError("the symbol and the operations differ")
    hkl = grids.with_hkl(st.observations(spark, d), st.inverse()).select(*[r(c, c) for c in grids.HKL])
    return symmetry.reduced(hkl, own).groupBy(*[r(F.col(c) + 0.0, c) for c in grids.HKL]).agg(F.count("*").alias("n"))


@query("J06_valid_voxels", sql(st.BINNED, "select voxel_idx, count(*) as n from binned group by 1 having count(*) between 2 and 60"))
def valid_voxels(spark, d):
    b = st.binned(spark, d)[0].select("voxel_idx")
    valid = b.groupBy("voxel_idx").agg(F.count("*").alias("n")).where("n between 2 and 60").select("voxel_idx")
    return b.join(valid, "voxel_idx", "left_semi").groupBy("voxel_idx").agg(F.count("*").alias("n"))


@query("L03_sorted_stills", sql("obs", "select still_id, row_number() over (order by still_id)::int as place from (select distinct still_id from obs)"))
def sorted_stills(spark, d):
    ids = sorted(row.still_id for row in st.observations(spark, d).select("still_id").distinct().collect())  # one number for each image
    return spark.createDataFrame([(s, k + 1) for k, s in enumerate(ids)], "still_id int, place int")


@query("L04_first_crystals", sql("crystals", "select still_id, a, gamma from crystals order by still_id limit 3"))
def first_crystals(spark, d):
    return st.crystals(spark, d).select("still_id", "a", "gamma").orderBy("still_id").limit(3)


@query("L07_chunk_union", sql("obs", "select count(*) as n, round(sum(intensity) / 1e6, 4) as total from obs"))
def chunk_union(spark, d):
    obs = st.observations(spark, d)
    chunks = [obs.where(F.pmod("obs_id", F.lit(3)) == k).select(*(obs.columns if k else reversed(obs.columns))) for k in range(3)]
    return merging.concatenated(chunks).agg(F.count("*").alias("n"), r(F.sum("intensity") / 1e6, "total", 4))


@query("L08_required_columns", "select o_orderkey as file_id, case o_orderkey % 3 when 0 then 'frame_idx,sigma' when 1 then 'frame_idx' else '' end as lacks from orders")
def required_columns(spark, d):
    """What each file of a manifest lacks of the columns that are required."""
    k = F.col("o_orderkey") % 3
    some = F.array(*map(F.lit, ("qx", "intensity")))
    have = F.when(k == 0, some).when(k == 1, F.array_append(some, "sigma")).otherwise(F.concat(some, F.array(F.lit("sigma"), F.lit("frame_idx"))))
    return st.table(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"), F.array_join(lacking(have, ["qx", "sigma", "frame_idx"]), ",").alias("lacks"))


@query("C08_scale_guards", "select s_suppkey, case when s is null then 'missing' when isnan(s) then 'not finite' when s <= 0 then 'not positive' when s < 0.01 or s > 100 then 'out of range' end as doubt from (select s_suppkey, case s_suppkey % 5 when 0 then null when 1 then 'nan'::double else s_acctbal / 50 end as s from supplier)")
def scale_guards(spark, d):
    """What is wrong with the scales of a table."""
    k = F.col("s_suppkey") % 5
    scales = st.table(spark, d, "supplier").select("s_suppkey", F.when(k == 1, float("nan")).when(k != 0, F.col("s_acctbal") / 50).alias("multiplicative_scale"))
    return scales.select("s_suppkey", scaling.doubtful_scale().alias("doubt"))


@query("G14_input_validation", sql("obs", "select still_id, doubt, count(*) as n from (select *, case when obs_id % 11 = 0 then 'q is not finite' when obs_id % 13 = 0 then 'intensity is not finite' when obs_id % 7 = 0 then 'sigma is not positive' end as doubt from obs) group by all"))
def input_validation(spark, d):
    """Observations of each still that cannot be binned or merged, by the reason."""
    k = F.col("obs_id")
    obs = st.observations(spark, d).withColumns({"qy": F.when(k % 11 == 0, float("nan")).otherwise(F.col("qy")), "intensity": F.when(k % 13 != 0, F.col("intensity")), "sigma": F.when(k % 7 == 0, -F.col("sigma")).otherwise(F.col("sigma"))})
    return obs.withColumn("doubt", grids.doubtful_observation()).groupBy("still_id", "doubt").agg(F.count("*").alias("n"))


_WHOLE = "(select round_even(h, 0)::int as h, round_even(k, 0)::int as k, round_even(l, 0)::int as l, intensity, sigma, (obs_id % 20) / 20.0::double as partiality from hkl)"
_ASU = "greatest(" + ", ".join(f"{{'h': {a}, 'k': {b}, 'l': {c}}}" for a, b, c in _MATES) + ")"


def _bragg(least: float) -> str:
    return sql("obs hkl", f"select m.h as h, m.k as k, m.l as l, round(sum(w * intensity) / sum(w), 4) as intensity, round(1 / sqrt(sum(w)), 6) as sigma, count(*) as n from (select {_ASU} as m, intensity, 1 / (sigma * sigma + 1e-10) as w from {_WHOLE} where partiality >= {least}) group by all")


def _merged_bragg(spark, d, least: float):
    hkl = grids.with_hkl(st.observations(spark, d), st.inverse()).withColumn("partiality", (F.col("obs_id") % 20) / 20.0)
    out = merging.bragg_merge(hkl, symmetry.operations("P222"), least)
    return out.select("h", "k", "l", r("intensity", "intensity", 4), r("sigma", "sigma"), "n")


@query("M26_reference_merge", _bragg(0.1))
def reference_merge(spark, d):
    """Weighted mean of each reflection, mates together, of observations whole enough."""
    return _merged_bragg(spark, d, 0.1)


@query("X05_bragg_filter", _bragg(0.95))
def bragg_filter(spark, d):
    """The same of observations that are nearly whole."""
    return _merged_bragg(spark, d, 0.95)


@query("X08_weighted_correction", sql(st.BINNED, "select voxel_idx, round(sum(n * s) / sum(n), 6) as correction from (select voxel_idx, still_id, count(*) as n, avg(sigma) as s from binned group by all) group by 1"))
def weighted_correction(spark, d):
    return rounded(merging.averaged_correction(st.binned(spark, d)[0], "sigma"))


@query("X10_phase_summary", sql(f"scales {st.BINNED} scaled", "select 'read' as phase, count(*) as n, 0::bigint as n_with_null from obs union all select 'binned', count(*), 0 from binned union all select 'merged', count(distinct voxel_idx), 0 from binned union all select 'scales', count(*), count(*) filter (multiplicative_scale is null) from (select distinct still_id from obs) left join scales using (still_id)"))
def phase_summary(spark, d):
    from reciprospark.operators.reports import phase_summary as summary

    b, g = st.binned(spark, d)
    obs = st.observations(spark, d)
    return summary({"read": obs, "binned": b, "merged": merging.merge(b, g), "scales": obs.select("still_id").distinct().join(st.scales(spark, d), "still_id", "left")})
