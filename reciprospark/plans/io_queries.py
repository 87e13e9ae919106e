"""Queries of readers, sinks and streams: each writes the stand-in tables to the shared folder by a sink and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from reciprospark.operators import grid as grids
from reciprospark.operators import masks, merging, orchestration, scaling
from reciprospark.plans import merging_queries as mq
from reciprospark.plans import pixel_queries as pq
from reciprospark.plans import stand_ins as st
from reciprospark.plans.registry import lister, r, rounded
from reciprospark.schema import OBSERVATIONS
from reciprospark.sources import adapters, sinks, tables
from reciprospark.sources.shared import scratch
from reciprospark.streaming import accumulate

QUERIES, ORACLES, query = lister()
sql = st.with_tables
_OBS = ["still_id", "qx", "qy", "qz", "intensity", "sigma"]


def _experiment(spark, d) -> str:
    path = scratch(spark, "experiment")
    beam = st.images(spark, d).select("image_id", F.lit(st.BEAM.wavelength).alias("wavelength"), F.array(*[F.lit(x) for x in st.BEAM.s0]).alias("s0"))
    panel = spark.createDataFrame([(k, 8 + k, 8, [-60.0, -40.0, 200.0 + k]) for k in range(3)], "panel_id int, n_fast int, n_slow int, origin array<double>")
    sinks.save_experiments(beam, panel, st.crystals(spark, d), path)
    return path


@query("S04_experiment_scan", sql("crystals", "select count(*) as n, " + ", ".join(f"round(avg({c}), 6) as {c}" for c in grids.CELL) + ", round(avg(cos(turn)), 6) as u0 from crystals"))
def experiment_scan(spark, d):
    """The crystals of an experiment file."""
    crystal = adapters.read(spark, "crystal", _experiment(spark, d))
    return crystal.agg(F.count("*").alias("n"), *[r(F.avg(c), c) for c in grids.CELL], r(F.avg(F.col("u")[0]), "u0"))


@query("K09_experiment_save", "select * from (select 'beam' as part, count(*) as n, round(avg(0.9768::double), 6) as value from embeddings union all select 'panel', 3, 201.0 union all select 'crystal', count(*), round(avg(10.0 + (c_custkey % 11) * 0.01), 6) from customer)")
def experiment_save(spark, d):
    found = tables.experiments(spark, _experiment(spark, d))
    parts = {"beam": F.col("wavelength"), "panel": F.col("origin")[2], "crystal": F.col("a")}
    return merging.concatenated([found[k].agg(F.lit(k).alias("part"), F.count("*").alias("n"), r(F.avg(v), "value")) for k, v in parts.items()])


@query("K09_model_tables", sql("crystals reflections beams", "select 'beam' as part, count(*) as n, round(avg(wavelength), 6) as value from beams union all select 'crystal', count(*), round(avg(a), 6) from crystals union all select 'reflections', count(*), round(avg(x), 6) from reflections where refl_id % 37 = 5"))
def model_tables(spark, d):
    """Beams, crystals and reflections saved as tables with a row for each, and read again; of the reflections one image's."""
    path = scratch(spark, "models")
    sinks.save_models(path, beam=st.beams(spark, d), crystal=st.crystals(spark, d), reflections=st.image_reflections(spark, d))
    found = tables.models(spark, path, "beam", "crystal", "reflections")
    parts = {"beam": (found["beam"], "wavelength"), "crystal": (found["crystal"], "a"), "reflections": (found["reflections"].where("image_id = 5"), "x")}
    return merging.concatenated([rows.agg(F.lit(k).alias("part"), F.count("*").alias("n"), r(F.avg(c), "value")) for k, (rows, c) in parts.items()])


@query("S05_reflection_scan", sql("reflections", "select round_even(frame, 0)::int as frame, count(*) as n, round(sum(x), 4) as x, round(sum(y), 4) as y from reflections group by 1"))
def reflection_scan(spark, d):
    """Reflections from their file, their centres from the observed centroid."""
    path = scratch(spark, "reflections")
    st.reflections(spark, d).select("refl_id", F.col("panel_id").alias("panel"), F.array("x", "y", "frame").alias("xyzobs_px"), "partiality").write.parquet(path)
    spots = masks.spot_centres(adapters.read(spark, "reflections", path))
    return spots.groupBy(F.rint("frame").cast("int").alias("frame")).agg(F.count("*").alias("n"), r(F.sum("x"), "x", 4), r(F.sum("y"), "y", 4))


def _saved_mask(spark, d):
    path = scratch(spark, "mask")
    sinks.save_mask(masks.combined_mask(pq._static(spark, d), pq._dynamic(spark, d)), path)
    return adapters.read(spark, "mask", path)


@query("S06_mask_scan", pq.MASKS + "select panel_id, slow, fast, good from combined")
def mask_scan(spark, d):
    return _saved_mask(spark, d)


@query("K07_mask_save", pq.MASKS + "select count(*) as n, count(*) filter (good) as n_good from combined")
def mask_save(spark, d):
    return _saved_mask(spark, d).agg(F.count("*").alias("n"), F.count_if("good").alias("n_good"))


@query("S07_background_scan", "with " + st.SQL["pixels"] + ", " + pq._BG + " select slow, fast, round(bg, 6) as bg from background")
def background_scan(spark, d):
    path = scratch(spark, "background")
    pq._background(spark, d).write.parquet(path)
    return rounded(adapters.read(spark, "background", path)).drop("panel_id")


_BY_STILL = sql("obs", "select still_id, count(*) as n, round(avg(intensity), 4) as intensity, round(avg(sigma), 6) as sigma, round(sum(qx), 3) as qx from obs group by 1")


def _by_still(obs):
    return obs.groupBy("still_id").agg(F.count("*").alias("n"), r(F.avg("intensity"), "intensity", 4), r(F.avg("sigma"), "sigma"), r(F.sum("qx"), "qx", 3))


@query("S09_observation_scan", _BY_STILL)
def observation_scan(spark, d):
    """A file for each still, numbered by its place in the list."""
    obs, paths = st.observations(spark, d), []
    for k in range(7):
        paths.append(scratch(spark, f"still-{k}"))
        sinks.save_observations(obs.where(F.col("still_id") == k).drop("still_id"), paths[-1])
    return _by_still(tables.observations(spark, paths))


@query("K01_observation_save", _BY_STILL)
def observation_save(spark, d):
    path = scratch(spark, "observations")
    sinks.save_observations(st.observations(spark, d), path)
    return _by_still(tables.parquet(spark, path, _OBS))


def _saved_map(spark, d):
    obs, g = mq._applied(spark, d)
    path = scratch(spark, "voxels")
    sinks.save_voxels(merging.merge(obs, g), path)
    return adapters.read(spark, "voxels", path)


@query("S10_voxel_scan", sql(st.APPLIED, "select * from " + mq._merged_sql("applied")))
def voxel_scan(spark, d):
    out = _saved_map(spark, d).select("voxel_idx", "I_merged_relative", "Sigma_merged_relative", "num_observations")
    return rounded(out.withColumn("I_merged_relative", F.round("I_merged_relative", 4)))


@query("K02_voxel_save", sql(st.APPLIED, "select count(*) as n, sum(c)::bigint as observations, 11 as n_columns from (select count(*) as c from applied group by voxel_idx)"))
def voxel_save(spark, d):
    out = _saved_map(spark, d)
    return out.agg(F.count("*").alias("n"), F.sum("num_observations").alias("observations"), F.lit(len(out.columns)).alias("n_columns"))


@query("K03_q_map_save", sql(pq.GEO, "select panel_id, slow, fast, round(max(qx), 6) as qx, round(max(qy), 6) as qy, round(max(qz), 6) as qz from geometry group by all"))
def q_map_save(spark, d):
    path = scratch(spark, "q-map")
    sinks.save_q_map(pq.q_map(spark, d), path)
    return tables.parquet(spark, path, ("panel_id", "qx", "qy", "qz")).select("panel_id", "slow", "fast", "qx", "qy", "qz")


@query("S11_grid_scan", sql("obs hkl bounds", "select low_h, high_h, low_k, high_k, low_l, high_l, (high_h - low_h + 1) * (high_k - low_k + 1) * (high_l - low_l + 1) as total_voxels from bounds"))
def grid_scan(spark, d):
    path = scratch(spark, "grid")
    sinks.save_grid(spark, st.grid(st.observations(spark, d)), path)
    g = tables.grid(spark, path)
    return spark.createDataFrame([(*[x for pair in zip(g.low, g.high, strict=True) for x in pair], g.total_voxels)], "low_h long, high_h long, low_k long, high_k long, low_l long, high_l long, total_voxels long")


@query("S11_scaling_scan", sql("scales", "select still_id, round(multiplicative_scale * (1.0 + 1.2 * exp(-1.0::double)) / (1.0 + exp(-1.0::double)), 5) as low, round(multiplicative_scale, 5) as scale from scales"))
def scaling_scan(spark, d):
    """Refined scales from their file; low: the total scale where |q| is least."""
    path = scratch(spark, "scales")
    model = scaling.ScaleModel(mq._model(spark, d).stills, scaling.Smoother((1.0, 1.2), 0.1, 1.5))
    sinks.save_scale_model(spark, model, {"n_iterations": 3}, path)
    found = tables.scale_model(spark, path)
    return spark.createDataFrame([(k, round(v * found.smoother.at(0.1), 5), round(v, 5)) for k, v in found.stills.items()], "still_id int, low double, scale double")


_CONFIG = '{"beamstop": {"type": "circle", "center_x": 4, "center_y": 3, "radius": 2}, "untrusted_rects": [{"min_x": 0, "max_x": 2, "min_y": 6, "max_y": 7}], "untrusted_panels": [2]}'


@query("S12_config_scan", sql("pixels", "select image_id, count(*) as n, round(sum(raw), 3) as total from pixels where not (pow(slow - 3.0, 2) + pow(fast - 4.0, 2) <= 4.0 or (slow between 6 and 7 and fast between 0 and 2)) and image_id % 5 <> 2 group by 1"))
def config_scan(spark, d):
    """A mask configuration from a file, and what the mask that it asks for leaves of each image."""
    path = scratch(spark, "config")
    sinks.save_text(spark, [_CONFIG], path)
    regions, untrusted = tables.static_regions(tables.settings(spark, path))
    px = st.panelled(pq._pixels(spark, d))
    good = masks.static_mask(masks.positions(px), regions, untrusted)
    return masks.image_masks(px, good, None).where("good").groupBy("image_id").agg(F.count("*").alias("n"), r(F.sum("raw"), "total", 3))


@query("K04_json_save", sql("obs hkl bounds", "select 'grid' as what, (high_h - low_h + 1) * (high_k - low_k + 1) * (high_l - low_l + 1) as n from bounds union all select 'observations', count(*) from obs"))
def json_save(spark, d):
    path = scratch(spark, "numbers")
    obs = st.observations(spark, d)
    sinks.save_json(spark, {"grid": st.grid(obs).total_voxels, "observations": obs.count()}, path)
    return spark.createDataFrame(list(tables.settings(spark, path, ("grid", "observations")).items()), "what string, n long")


@query("K05_append_store", sql(st.BINNED, "select voxel_idx, count(*) as n, round(sum(intensity) / 1e3, 2) as total from binned group by 1"))
def append_store(spark, d):
    b, _ = st.binned(spark, d)
    path = scratch(spark, "binned")
    for k in range(3):
        sinks.append_binned(b.where(F.pmod("obs_id", F.lit(3)) == k), path)
    return spark.read.parquet(path).groupBy("voxel_idx").agg(F.count("*").alias("n"), r(F.sum("intensity") / 1e3, "total", 2))


@query("K06_run_log", "select status, error_code, vec_id % 2 = 0 as has_artifacts, count(*) as n from (select vec_id, case when vec_id % 7 in (3, 5) then 'FAILURE' else 'SUCCESS' end as status, case when vec_id % 7 in (3, 5) then 'InputFileError' end as error_code from embeddings) group by all")
def run_log(spark, d):
    """The outcomes of all images in a log that two runs have written."""
    path = scratch(spark, "log")
    k = F.col("vec_id")
    failed = (k % 7).isin(3, 5)
    rows = st.table(spark, d, "embeddings").select("vec_id", F.format_string("%d.cbf", k).alias("input_path"), F.when(failed, "FAILURE").otherwise("SUCCESS").alias("status"), F.when(failed, "file not found").alias("message"), F.when(failed, "InputFileError").alias("error_code"))
    artifacts = F.create_map(F.lit("observations"), F.concat("input_path", F.lit(".parquet")))
    sinks.append_outcomes(spark, rows.where("vec_id % 2 = 0").withColumn("artifacts", artifacts), path)
    sinks.append_outcomes(spark, rows.where("vec_id % 2 = 1"), path)
    return spark.read.parquet(path).groupBy("status", "error_code", F.col("artifacts").isNotNull().alias("has_artifacts")).agg(F.count("*").alias("n"))


@query("K08_manifest", sql("obs", "select still_id, 'still-' || still_id || '.parquet' as observations, count(*) as n from obs group by 1"))
def manifest(spark, d):
    path = scratch(spark, "manifest")
    rows = st.observations(spark, d).groupBy("still_id").agg(F.count("*").alias("n"))
    sinks.save_manifest(rows.withColumn("observations", F.format_string("still-%d.parquet", "still_id")), path)
    return spark.read.schema("still_id int, observations string, n long").json(path)


@query("K10_text_report", sql("obs", "select '# extraction' as line union all select 'n: ' || count(*) from obs union all select 'n_stills: ' || count(distinct still_id) from obs"))
def text_report(spark, d):
    path = scratch(spark, "report")
    sinks.save_report(st.observations(spark, d).agg(F.count("*").alias("n"), F.countDistinct("still_id").alias("n_stills")), path, "extraction")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("U07_uniform_adapters", sql("obs", "select 'observations' as kind, count(*) as n from obs union all select 'own', count(*) from customer"))
def uniform_adapters(spark, d):
    """One interface for every kind of table, an own one among them."""
    path = scratch(spark, "observations")
    sinks.save_observations(st.observations(spark, d).drop("still_id"), path)
    adapters.register("own", lambda session, at: st.crystals(session, at))
    each = {"observations": path, "own": d}
    return merging.concatenated([adapters.read(spark, k, p).agg(F.lit(k).alias("kind"), F.count("*").alias("n")) for k, p in each.items()])


# incremental


@query("T01_add_observations", sql(st.BINNED, "select voxel_idx, still_id, count(*) as n from binned group by all"))
def add_observations(spark, d):
    """A stream of observation files, binned batch by batch."""
    obs = st.observations(spark, d)
    source, out = scratch(spark, "in"), scratch(spark, "binned")
    obs.select(*_OBS).repartition(6).write.parquet(source)
    accumulate.accumulate(accumulate.observation_stream(spark, source, OBSERVATIONS, 2), st.grid(obs), out, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).groupBy("voxel_idx", "still_id").agg(F.count("*").alias("n"))


@query("T01_added_counts", sql(st.BINNED, "select * from (select 'first' as what, count(*) as n from binned where still_id < 4 and obs_id % 3 = 0 union all select 'first again', count(*) from binned where still_id < 4 and obs_id % 3 = 0 union all select 'more of them', count(*) from binned where still_id < 4 and obs_id % 3 <> 0 union all select 'rest', count(*) from binned where still_id >= 4 union all select 'stored', count(*) from binned)"))
def added_counts(spark, d):
    """Numbers binned of stills added in parts, one part twice under one batch id: parts of a still add up, a batch that comes again replaces itself."""
    obs = st.observations(spark, d)
    g, path = st.grid(obs), scratch(spark, "binned")
    low, third = F.col("still_id") < 4, F.col("obs_id") % 3 == 0
    parts = [("first", obs.where(low & third), "a"), ("first again", obs.where(low & third), "a"), ("more of them", obs.where(low & ~third), "b"), ("rest", obs.where(~low), None)]
    seen = [(what, accumulate.add_observations(part, g, path, batch)) for what, part, batch in parts]
    return spark.createDataFrame([*seen, ("stored", accumulate.finalized(spark, path)[0].count())], "what string, n long")


@query("T01_stills_of_parts", sql(st.BINNED, "select still_id, count(*) as n, count(distinct voxel_idx) as n_voxels, round(sum(intensity) / 1e3, 2) as total from binned group by 1"))
def stills_of_parts(spark, d):
    """What is stored of each still when every still comes in three parts."""
    obs = st.observations(spark, d)
    g, path = st.grid(obs), scratch(spark, "binned")
    for k in range(3):
        accumulate.add_observations(obs.where(F.pmod("obs_id", F.lit(3)) == k), g, path)
    stored = accumulate.finalized(spark, path)[0]
    return stored.groupBy("still_id").agg(F.count("*").alias("n"), F.countDistinct("voxel_idx").alias("n_voxels"), r(F.sum("intensity") / 1e3, "total", 2))


@query("T02_finalize", sql(st.BINNED, "select sum(n)::bigint as n_observations, count(*) as n_voxels, round(avg(n), 6) as mean_n, round(stddev_pop(n), 6) as std_n, min(n) as min_n, max(n) as max_n from (select count(*) as n from binned group by voxel_idx)"))
def finalize(spark, d):
    obs = st.observations(spark, d)
    path = scratch(spark, "binned")
    accumulate.add_observations(obs, st.grid(obs), path)
    return rounded(accumulate.finalized(spark, path)[1])


def _in_two_runs(spark, d):
    """Binned observations as files, of which the first half was there when a stream ran, the other when it ran again from its checkpoint."""
    b, _ = st.binned(spark, d)
    source, out, checkpoint = (scratch(spark, n) for n in ("in", "running", "checkpoint"))
    rows = b.select("obs_id", "voxel_idx", "intensity", "sigma")
    for k in range(2):
        rows.where(F.pmod("obs_id", F.lit(2)) == k).drop("obs_id").repartition(3).write.mode("append").parquet(source)
        stream = accumulate.observation_stream(spark, source, "voxel_idx long, intensity double, sigma double", 2)
        accumulate.keep_running(stream, out, checkpoint).awaitTermination()
    return accumulate.latest(spark, out)


@query("T04_merge_in_two_runs", sql(st.BINNED, "select voxel_idx, count(*) as n, round(sum(intensity / (sigma * sigma + 1e-10)) / sum(1.0 / (sigma * sigma + 1e-10)), 4) as intensity, round(1.0 / sqrt(sum(1.0 / (sigma * sigma + 1e-10))), 6) as sigma from binned group by 1"))
def merge_in_two_runs(spark, d):
    out = accumulate.from_sums(_in_two_runs(spark, d))
    return out.select("voxel_idx", "n", r("intensity", "intensity", 4), r("sigma", "sigma"))


@query("M25_statistics_in_two_runs", sql(st.BINNED, "select voxel_idx, count(*) as n, round(avg(intensity), 4) as mean, round(var_pop(intensity) / 1e6, 6) as variance from binned group by 1"))
def statistics_in_two_runs(spark, d):
    out = accumulate.from_sums(_in_two_runs(spark, d))
    return out.select("voxel_idx", "n", r("mean", "mean", 4), r(F.col("variance") / 1e6, "variance"))


@query("M25_combined_statistics", ORACLES["M25_statistics_in_two_runs"])
def combined_statistics(spark, d):
    """The same from sums that were kept apart, by still."""
    b, _ = st.binned(spark, d)
    parts = accumulate.running_sums(b.where("still_id < 3"))
    for rest in ("still_id between 3 and 4", "still_id > 4"):
        parts = parts.unionByName(accumulate.running_sums(b.where(rest)))
    return accumulate.from_sums(accumulate.combined(parts)).select("voxel_idx", "n", r("mean", "mean", 4), r(F.col("variance") / 1e6, "variance"))
