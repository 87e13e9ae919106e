"""Queries of the absolute scale and of the histograms of counts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from reciprospark.functions import vec
from reciprospark.operators import absolute, counts, merging, terms
from reciprospark.operators import grid as grids
from reciprospark.plans import merging_queries as mq
from reciprospark.plans import stand_ins as st
from reciprospark.plans.registry import lister, r, rounded

QUERIES, ORACLES, query = lister()
sql = st.with_tables
CONTENTS = {"C": 20.0, "H": 30.0, "N": 5.0, "O": 6.0, "S": 0.5}
ELECTRONS, VOLUME, WIDTH = absolute.electrons(CONTENTS), 3000.0, 0.1
_Q = "sqrt(qx * qx + qy * qy + qz * qz)"


def _f0(element: str, q: str) -> str:
    *pairs, c = absolute.ATOMS[element][1]
    s2 = f"pow({q} / {4 * math.pi!r}, 2)"
    return "(" + " + ".join([f"{a!r}::double * exp(-{b!r}::double * {s2})" for a, b in zip(pairs[::2], pairs[1::2], strict=True)] + [f"{c!r}::double"]) + ")"


def _theory(q: str) -> tuple[str, str]:
    f2 = {e: f"pow({_f0(e, q)}, 2)" for e in CONTENTS}
    z = {e: absolute.ATOMS[e][0] for e in CONTENTS}
    return " + ".join(f"{n!r} * {f2[e]}" for e, n in CONTENTS.items()), " + ".join(f"{n!r} * ({z[e]} - {f2[e]} / {z[e]})" for e, n in CONTENTS.items())


F_SQUARED, INCOHERENT = _theory("q_magnitude_center")
_MAP = mq._centres(mq._merged_sql("applied"))


def _map(spark, d):
    obs, g = mq._applied(spark, d)
    v = merging.merge(obs, g)
    return rounded(v.withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("X01_theoretical_scattering", sql(st.APPLIED, f"select voxel_idx, round({F_SQUARED}, 4) as f_squared, round({INCOHERENT}, 4) as incoherent from ({_MAP})"))
def theoretical_scattering(spark, d):
    out = absolute.with_theory(_map(spark, d), CONTENTS)
    return out.select("voxel_idx", r("f_squared", "f_squared", 4), r("incoherent", "incoherent", 4))


_F2Q, _INCQ = _theory("q")
_SHELLS = f"(select floor(q / {WIDTH})::int as shell, count(*) as n, avg(intensity) as o, avg({_F2Q} + {_INCQ}) as t from (select *, {_Q} as q from obs) group by 1)"
_V = f"(4 * pi() / 3 * (pow((shell + 1) * {WIDTH}, 3) - pow(shell * {WIDTH}, 3)))"
_SCALES = f"(select shell, n, {VOLUME} * sum(o * {_V}) over (order by shell) as cumulative_observed, {-(ELECTRONS**2)!r} + {VOLUME} * sum(t * {_V}) over (order by shell) as cumulative_theory from {_SHELLS})"


def _scales(spark, d):
    obs = st.observations(spark, d).withColumn("q", vec.norm([F.col(c) for c in grids.Q]))
    theory = absolute.with_theory(obs, CONTENTS, "q").withColumn("total", F.col("f_squared") + F.col("incoherent"))
    return absolute.absolute_scales(absolute.shell_averages(obs, "intensity", "q", WIDTH), absolute.shell_averages(theory, "total", "q", WIDTH), ELECTRONS, VOLUME)


@query("X02_absolute_scales", sql("obs", f"select shell, n, round(cumulative_observed / 1e6, 3) as observed, round(cumulative_theory / 1e6, 6) as theory, round(cumulative_theory / cumulative_observed, 9) as scale from {_SCALES}"))
def absolute_scales(spark, d):
    return _scales(spark, d).select("shell", "n", r(F.col("cumulative_observed") / 1e6, "observed", 3), r(F.col("cumulative_theory") / 1e6, "theory"), r("scale", "scale", 9))


_LAST = f"(select round(max_by(cumulative_theory / cumulative_observed, shell), 9) as scale from {_SCALES})"


def _last(spark, d) -> float:
    return _scales(spark, d).agg(F.round(F.max_by("scale", "shell"), 9)).first()[0]


@query("X03_absolute_map", sql(st.APPLIED, f"select voxel_idx, round(I_merged_relative * scale - ({INCOHERENT}), 4) as intensity, round(Sigma_merged_relative * scale, 6) as sigma from ({_MAP}), {_LAST}"))
def absolute_map(spark, d):
    """The merged map on the scale of the last shell."""
    out = absolute.with_theory(_map(spark, d), CONTENTS)
    out = absolute.on_absolute_scale(out, _last(spark, d), F.col("incoherent"))
    return out.select("voxel_idx", r("I_abs_diffuse", "intensity", 4), r("Sigma_abs_diffuse", "sigma"))


@query("X04_folded_scale", sql("obs scales", f"select still_id, round(multiplicative_scale / scale, 4) as scale, round(10.0 * multiplicative_scale / scale, 3) as offset_ from scales, {_LAST}"))
def folded_scale(spark, d):
    """Scales of stills with the absolute one folded in, and 10 as incoherent scattering."""
    out = absolute.folded(st.scales(spark, d).withColumn("additive_offset", F.lit(0.0)), _last(spark, d), F.lit(10.0))
    return out.select("still_id", r("multiplicative_scale", "scale", 4), r("additive_offset", "offset_", 3))


@query("X09_four_terms", sql("obs", "select still_id, round(avg(intensity / (a * b * d) - c / b), 4) as intensity, round(avg(sigma / abs(a * b * d)), 6) as sigma from (select *, 1 + qx / 10 as a, 1 + still_id / 20.0::double as b, qy * 100 as c, 1 - qz / 10 as d from obs) group by 1"))
def four_terms(spark, d):
    obs = st.observations(spark, d).withColumns({"a": 1 + F.col("qx") / 10, "b": 1 + F.col("still_id") / 20.0, "c": F.col("qy") * 100, "d": 1 - F.col("qz") / 10})
    return absolute.applied(obs).groupBy("still_id").agg(r(F.avg("intensity"), "intensity", 4), r(F.avg("sigma"), "sigma"))


# fitting of the terms

_SCALE = terms.Term("b", (terms.Axis("qx", 0.0, 1.0, 5),), smoothness=1e-6)
_PANEL = terms.Term("d", by=("still_id",))


def _distorted(spark, d):
    """Observations distorted by a scale along qx and a factor of each still; what they were is the reference."""
    obs = st.observations(spark, d).withColumn("reference", F.col("intensity"))
    return obs.withColumn("intensity", F.col("reference") * (1 + F.col("qx") / 2) * (1 + (F.col("still_id") - 3) / 20.0))


st.SQL["distorted"] = "distorted as (select * replace (intensity * (1 + qx / 2) * (1 + (still_id - 3) / 20.0::double) as intensity), intensity as reference from obs)"


@query("X09_cell_sums", sql("obs distorted", "select _cell0, count(*) as n, round(sum((1 - u) * (1 - u) * g) / 1e3, 4) as n0_0, round(sum(u * (1 - u) * g) / 1e3, 4) as n0_1, round(sum(u * u * g) / 1e3, 4) as n1_1, round(sum((1 - u) * h) / 1e3, 4) as r0, round(sum(u * h) / 1e3, 4) as r1 from (select _cell0, qx * 4 - _cell0 as u, reference * reference / (sigma * sigma + 1e-10) as g, reference * intensity / (sigma * sigma + 1e-10) as h from (select *, least(floor(qx * 4), 3)::int as _cell0 from distorted)) group by 1"))
def term_cell_sums(spark, d):
    """The normal equations of the scale, by cell of its control points."""
    out = terms.cell_sums(terms.with_terms(_distorted(spark, d), [], {}), _SCALE)
    return out.select("_cell0", "n", *[r(F.col(c) / 1e3, c, 4) for c in ("n0_0", "n0_1", "n1_1", "r0", "r1")])


@query("X09_panel_step", sql("obs distorted", "select still_id, round(sum(reference * intensity / (sigma * sigma + 1e-10)) / sum(reference * reference / (sigma * sigma + 1e-10)), 8) as d from distorted group by 1"))
def panel_step(spark, d):
    """One step for the term that has a value for each panel."""
    sums = terms.cell_sums(terms.with_terms(_distorted(spark, d), [], {}), _PANEL)
    return terms.solved(sums, _PANEL).select("still_id", r("v0", "d", 8))


@query("X09_fitted_terms", "select 'b' as term, null::int as still_id, k::int as cell, round(1 + k / 8.0::double, 4) as low, round(1 + (k + 1) / 8.0::double, 4) as high from range(4) t(k) union all select distinct 'd', (l_suppkey % 7)::int, 0, round(1 + (l_suppkey % 7 - 3) / 20.0::double, 4), null from lineitem")
def fitted_terms(spark, d):
    """Both terms together, one after the other, until they are what was planted."""
    fitted, _ = terms.fit(_distorted(spark, d), [_SCALE, _PANEL], rounds=8)
    b = fitted["b"].select(F.lit("b").alias("term"), F.lit(None).cast("int").alias("still_id"), F.col("_cell0").alias("cell"), r("v0", "low", 4), r("v1", "high", 4))
    return b.unionByName(fitted["d"].select(F.lit("d").alias("term"), "still_id", F.lit(0).alias("cell"), r("v0", "low", 4), F.lit(None).cast("double").alias("high")))


# counts

_COUNT = "(qx * 50)::int"


def _counted(spark, d):
    b, g = st.binned(spark, d)
    return b.withColumn("count", F.col("qx") * 50), g


@query("X06_count_histogram", sql(st.BINNED, f"select voxel_idx, round(qx * 50)::int as count, count(*) as n from binned where round(qx * 50) <= 40 group by all"))
def count_histogram(spark, d):
    rows, _ = _counted(spark, d)
    return counts.histogram(rows.withColumn("count", F.round("count")), 40)


@query("X06_overflow", sql(st.BINNED, "select voxel_idx, sum(round(qx * 50))::double as overflow from binned where round(qx * 50) > 40 group by all"))
def overflow(spark, d):
    rows, _ = _counted(spark, d)
    return counts.overflow(rows.withColumn("count", F.round("count")), 40)


_AT = "(voxel_idx % nh) as ih, (voxel_idx % (nh * nk)) // nh as ik, voxel_idx // (nh * nk) as il"
_SIZE = "(select high_h - low_h + 1 as nh, high_k - low_k + 1 as nk, high_l - low_l + 1 as nl from bounds)"
_STEPS = "(values (0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) o(dh, dk, dl)"
_SPREAD = f"""hist as materialized (select voxel_idx, (1 + (obs_id * obs_id + voxel_idx) % 9)::int as count, count(*) as n from binned group by all),
means as materialized (select voxel_idx, sum(count * n) / sum(n)::double as mean, sum(n) as w from hist group by 1),
near as materialized (select voxel_idx + dh + dk * nh + dl * nh * nk as target, voxel_idx from (select *, {_AT} from means, {_SIZE}), {_STEPS} where ih + dh between 0 and nh - 1 and ik + dk between 0 and nk - 1 and il + dl between 0 and nl - 1),
ranked as (select target as voxel_idx, mean, sum(w) over (partition by target order by mean) as below, sum(w) over (partition by target) as total from near join means using (voxel_idx) where target in (select voxel_idx from means)),
rates as materialized (select voxel_idx, min(mean) as rate from ranked where 2 * below >= total group by 1),
around as materialized (select target as voxel_idx, count, sum(n) as n from near join hist using (voxel_idx) group by all),
parts as (select voxel_idx, rate, count, n / sum(n) over (partition by voxel_idx)::double as p from around join rates using (voxel_idx)),
divergent as materialized (select voxel_idx, first(rate) as rate, sum(p * (ln(p) - (count * ln(rate) - rate - lgamma(count + 1)))) as divergence from parts group by 1)"""
st.SQL["divergent"] = _SPREAD


def _tallied(binned):
    return binned.withColumn("count", 1 + (F.col("obs_id") * F.col("obs_id") + F.col("voxel_idx")) % 9)


def _hist(spark, d):
    b, g = st.binned(spark, d)
    return counts.histogram(_tallied(b)), g


@query("X06_divergence", sql(f"{st.BINNED} divergent", "select voxel_idx, round(rate, 9) as rate, round(divergence, 6) as divergence from divergent"))
def divergence(spark, d):
    hist, g = _hist(spark, d)
    out = counts.divergence(hist, g)
    return out.select("voxel_idx", r("rate", "rate", 9), r("divergence", "divergence"))


@query("X06_outlying_voxels", sql(f"{st.BINNED} divergent", "select voxel_idx from divergent where divergence > 0.5"))
def outlying_voxels(spark, d):
    """No count is beyond the bins here."""
    b, g = st.binned(spark, d)
    return counts.outlying(_hist(spark, d)[0], counts.overflow(_tallied(b)), g, 0.5)


st.SQL["low_hist"] = _SPREAD.replace("count(*) as n from binned group by all", "count(*) as n from binned where 1 + (obs_id * obs_id + voxel_idx) % 9 <= 6 group by all", 1)


@query("X06_outlying_or_overflowing", sql(f"{st.BINNED} low_hist", "select voxel_idx from divergent where divergence > 0.5 union select voxel_idx from binned where 1 + (obs_id * obs_id + voxel_idx) % 9 > 6 group by 1 having sum(1 + (obs_id * obs_id + voxel_idx) % 9) > 800"))
def outlying_or_overflowing(spark, d):
    """Voxels unlike a Poisson process up to a count of 6, or with many greater counts."""
    b, g = st.binned(spark, d)
    rows = _tallied(b)
    return counts.outlying(counts.histogram(rows, 6), counts.overflow(rows, 6), g, 0.5, 800.0)
