"""Attenuation of X-rays in air for tables of energies: an as-of join of each energy with the segments of a tabulation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reciprospark.functions import air


def tabulated(spark: SparkSession) -> DataFrame:
    """element, energy (eV) and coefficient (cm2/g) of the tabulation that the engine has itself."""
    return spark.createDataFrame([(n, float(e), c) for n, own in air.COEFFICIENTS.items() for e, c in zip(air.ENERGIES, own, strict=True)], "element string, energy double, coefficient double")


def segments(table: DataFrame) -> DataFrame:
    """element, from_energy, to_energy (null: no end) and the logarithms of both ends. The first begins at 0; both ends of the table are held."""
    by = Window.partitionBy("element").orderBy("energy")
    rows = table.select("element", F.col("energy").alias("e0"), F.log("coefficient").alias("c0"), F.lead("energy").over(by).alias("e1"), F.log(F.lead("coefficient").over(by)).alias("c1"), F.row_number().over(by).alias("k"))
    first = rows.where("k = 1").select("element", F.lit(0.0).alias("from_energy"), F.col("e0").alias("to_energy"), F.lit(0.0).alias("x0"), F.lit(1.0).alias("x1"), "c0", F.col("c0").alias("c1"))
    rest = rows.select("element", F.col("e0").alias("from_energy"), F.col("e1").alias("to_energy"), F.log("e0").alias("x0"), F.coalesce(F.log("e1"), F.log("e0") + 1).alias("x1"), "c0", F.coalesce("c1", "c0").alias("c1"))
    return first.unionByName(rest)


def mass_attenuation(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows (element, energy) with mu: log-log interpolation in the segment that the energy falls in; 1e-3 for an element that the table lacks, null for an energy that is null or not positive.

    Each row meets the few segments of its element; the table has some tens of rows for each element, and Spark broadcasts it."""
    own = segments(table).withColumnRenamed("element", "_element")
    here = (F.col("_element") == F.col("element")) & (F.col("energy") >= F.col("from_energy")) & (F.coalesce(F.col("energy") < F.col("to_energy"), F.lit(True)))
    share = (F.log("energy") - F.col("x0")) / (F.col("x1") - F.col("x0"))
    mu = F.coalesce(F.exp(F.col("c0") + share * (F.col("c1") - F.col("c0"))), F.lit(1e-3))
    return rows.join(own, here, "left").withColumn("mu", F.when(F.col("energy") > 0, mu)).select(*rows.columns, "mu")


def with_air(beams: DataFrame, table: DataFrame | None = None, temperature_k: float = 293.15, pressure_atm: float = 1.0) -> DataFrame:
    """beams (image_id, wavelength, ...) with air: the linear coefficient of air per metre at each beam's energy; 0.001 where the conditions make no sense.

    Wavelengths that images share are looked up once."""
    spark = beams.sparkSession
    if temperature_k <= 0:
        return beams.withColumn("air", F.lit(0.001))
    energies = beams.select("wavelength").distinct().where("wavelength > 0").withColumn("energy", F.lit(air.HC) / F.col("wavelength"))
    parts = F.explode(F.array(*[F.struct(F.lit(e).alias("element"), F.lit(f).alias("share")) for e, f in air.COMPOSITION.items()])).alias("part")
    rows = energies.select("wavelength", "energy", parts).select("wavelength", "energy", "part.element", "part.share")
    density = air.air_density(temperature_k, pressure_atm)
    found = mass_attenuation(rows, tabulated(spark) if table is None else table).groupBy("wavelength").agg((100.0 * density * F.sum(F.col("share") * F.col("mu"))).alias("air"))
    return beams.join(found, "wavelength", "left").withColumn("air", F.coalesce("air", F.lit(0.001))).select(*beams.columns, "air")
