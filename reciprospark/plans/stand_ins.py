"""The engine's tables made from the driver's: the same rows from Spark and, as common table expressions, from SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reciprospark.operators import grid as grids
from reciprospark.operators.pixels import Beam, Panel

#: A skewed setting, so that every element takes part.
SETTING = ((1.25, 0.05, 0.0), (0.0, 1.1, 0.03), (0.02, 0.0, 0.9))
NDIV = (5, 4, 3)
D_MIN, D_MAX = 0.6, 4.0
PANEL = Panel((-60.0, -40.0, 200.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), 0.172, 0.172, 8, 8)
BEAM = Beam(0.9768)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("obs_id"), (F.col("l_suppkey") % 7).cast("int").alias("still_id"),
        (F.col("l_quantity") / 50.0).alias("qx"), (F.col("l_discount") * 10.0).alias("qy"), (F.col("l_tax") * 10.0).alias("qz"),
        F.col("l_extendedprice").alias("intensity"), (F.sqrt("l_extendedprice") + 1.0).alias("sigma"),
    )


def scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales of all stills but 3."""
    t = table(spark, sf_dir, "supplier").withColumn("still_id", (F.col("s_suppkey") % 7).cast("int")).where("still_id <> 3")
    return t.groupBy("still_id").agg((1.0 + F.round(F.avg("s_acctbal"), 2) / 20000.0).alias("multiplicative_scale"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "embeddings")
    return t.select(F.col("vec_id").cast("int").alias("image_id"), F.lit(0).alias("panel_id"), F.lit(8).alias("n_slow"), F.lit(8).alias("n_fast"), F.transform("embedding", lambda x: x.cast("double") * 100.0).alias("data"))


def crystals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "customer")
    turn = F.radians((F.col("c_custkey") % 5) * 0.1)
    cell = [(n, lo + (F.col("c_custkey") % 11) * 0.01) for n, lo in (("a", 10.0), ("b", 15.0), ("c", 20.0))] + [(n, F.lit(90.0) + (F.col("c_custkey") % m) * 0.02) for n, m in (("alpha", 3), ("beta", 4), ("gamma", 5))]
    u = F.array(F.cos(turn), -F.sin(turn), F.lit(0.0), F.sin(turn), F.cos(turn), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    return t.select(F.col("c_custkey").cast("int").alias("still_id"), *[c.alias(n) for n, c in cell], u.alias("u"))


def reflections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events")
    return t.select(
        F.col("event_id").alias("refl_id"), F.lit(0).alias("panel_id"), (F.col("value") % 8).alias("x"), ((F.col("user_id") % 80) / 10.0).alias("y"),
        ((F.col("event_id") % 40) / 4.0).alias("frame"), ((F.col("event_id") % 20) / 20.0).alias("partiality"),
    )


def panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five panels, each turned and moved a little."""
    k = F.col("r_regionkey").cast("double")
    turn = k * 0.01
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("int").alias("panel_id"), F.lit(8).alias("n_fast"), F.lit(8).alias("n_slow"), (0.172 + k * 0.001).alias("px_fast"), (0.172 + k * 0.002).alias("px_slow"),
        F.array(k * 2 - 60.0, k * 3 - 40.0, k + 200.0).alias("origin"), F.array(F.cos(turn), F.sin(turn), F.lit(0.0)).alias("fast_axis"), F.array(-F.sin(turn), F.cos(turn), F.lit(0.0)).alias("slow_axis"),
    )


def beams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A beam for each image: thirteen wavelengths, three directions."""
    k = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(k.cast("int").alias("image_id"), (0.2 + (k % 13) * 0.9).alias("wavelength"), ((k % 3) * 0.01).alias("s0x"), F.lit(0.0).alias("s0y"), F.lit(-1.0).alias("s0z"))


def panelled(images: DataFrame) -> DataFrame:
    """Images, or pixels, of five panels: image k is on panel k % 5."""
    return images.withColumn("panel_id", (F.col("image_id") % 5).cast("int"))


def image_reflections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reflections, each on one of 37 images."""
    return reflections(spark, sf_dir).withColumn("image_id", (F.col("refl_id") % 37).cast("int"))


SQL = {
    "panels": "panels as (select r_regionkey::int as panel_id, 0.172 + k * 0.001::double as px_fast, 0.172 + k * 0.002::double as px_slow, k * 2 - 60.0 as ox, k * 3 - 40.0 as oy, k + 200.0 as oz, cos(k * 0.01::double) as co, sin(k * 0.01::double) as si from (select *, r_regionkey::double as k from region))",
    "beams": "beams as (select vec_id::int as image_id, 0.2 + (vec_id % 13) * 0.9::double as wavelength, (vec_id % 3) * 0.01::double as s0x, 0.0 as s0y, -1.0 as s0z from embeddings)",
    "obs": "obs as (select l_orderkey * 8 + l_linenumber as obs_id, (l_suppkey % 7)::int as still_id, l_quantity / 50.0 as qx, l_discount * 10.0 as qy, l_tax * 10.0 as qz, l_extendedprice as intensity, sqrt(l_extendedprice) + 1.0 as sigma from lineitem)",
    "scales": "scales as (select (s_suppkey % 7)::int as still_id, 1.0 + round(avg(s_acctbal), 2) / 20000.0 as multiplicative_scale from supplier where s_suppkey % 7 <> 3 group by 1)",
    "pixels": "pixels as (select vec_id::int as image_id, 0 as panel_id, (i // 8)::int as slow, (i % 8)::int as fast, v::double * 100.0 as raw from (select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings))",
    "crystals": "crystals as (select c_custkey::int as still_id, 10.0 + (c_custkey % 11) * 0.01 as a, 15.0 + (c_custkey % 11) * 0.01 as b, 20.0 + (c_custkey % 11) * 0.01 as c, 90.0 + (c_custkey % 3) * 0.02 as alpha, 90.0 + (c_custkey % 4) * 0.02 as beta, 90.0 + (c_custkey % 5) * 0.02 as gamma, radians((c_custkey % 5) * 0.1::double) as turn from customer)",
    "reflections": "reflections as (select event_id as refl_id, 0 as panel_id, value % 8 as x, (user_id % 80) / 10.0::double as y, (event_id % 40) / 4.0::double as frame, (event_id % 20) / 20.0::double as partiality from events)",
}


def inverse() -> tuple[tuple[float, ...], ...]:
    return tuple(map(tuple, np.linalg.inv(np.array(SETTING)).tolist()))


def _product(m, names) -> list[str]:
    return [" + ".join(f"({x!r}::double * {n})" for x, n in zip(row, names, strict=True)) for row in m]


H, K, L = _product(inverse(), ("qx", "qy", "qz"))
QX, QY, QZ = _product(SETTING, ("H_center", "K_center", "L_center"))
SQL["hkl"] = f"hkl as (select *, {H} as h, {K} as k, {L} as l from obs)"
SQL["bounds"] = "bounds as (select " + ", ".join(f"floor(min({c}) * {n})::bigint - 1 as low_{c}, ceil(max({c}) * {n})::bigint + 1 as high_{c}" for c, n in zip("hkl", NDIV, strict=True)) + " from hkl)"
SQL["binned"] = (
    "binned as (select t.*, (sl - low_l) * (nh * nk) + (sk - low_k) * nh + (sh - low_h) as voxel_idx from (select hkl.*, bounds.*, high_h - low_h + 1 as nh, high_k - low_k + 1 as nk, "
    + ", ".join(f"round_even({c} * {n}, 0)::bigint as s{c}" for c, n in zip("hkl", NDIV, strict=True))
    + " from hkl, bounds) t where sh between low_h and high_h and sk between low_k and high_k and sl between low_l and high_l)"
)
SQL["scaled"] = "scaled as (select b.*, coalesce(s.multiplicative_scale, 1.0) as scale from binned b left join scales s using (still_id))"
SQL["applied"] = "applied as (select voxel_idx, still_id, intensity / scale as intensity, sigma / abs(scale) as sigma, sqrt(qx * qx + qy * qy + qz * qz) as q from scaled)"


def with_tables(names: str, query: str) -> str:
    """A query with the named tables before it."""
    return "with " + ",\n".join(SQL[n] for n in names.split()) + "\n" + query


BINNED = "obs hkl bounds binned"
APPLIED = f"scales {BINNED} scaled applied"


def grid(obs: DataFrame) -> grids.Grid:
    return grids.fit(obs, SETTING, NDIV)


def binned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, grids.Grid]:
    obs = observations(spark, sf_dir)
    g = grid(obs)
    return grids.binned(obs, g), g
