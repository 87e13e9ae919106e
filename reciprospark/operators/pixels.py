"""From detector pixels to observations: geometry, corrections, filters."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.functions import corrections, vec
from reciprospark.operators import attenuation


@dataclass(frozen=True)
class Panel:
    """One panel, of numbers; or of columns, where each row has its own (see with_models)."""

    origin: tuple[float, float, float]
    fast_axis: tuple[float, float, float] = (1.0, 0.0, 0.0)
    slow_axis: tuple[float, float, float] = (0.0, 1.0, 0.0)
    px_fast: float = 0.172
    px_slow: float = 0.172
    n_fast: int = 0
    n_slow: int = 0


@dataclass(frozen=True)
class Beam:
    """One beam, of numbers; or of columns, where each row has its own. air: attenuation per metre, where it is not that of the wavelength."""

    wavelength: float
    s0: tuple[float, float, float] = (0.0, 0.0, -1.0)
    air: Column | None = None

    @property
    def direction(self) -> tuple[float, ...]:
        if any(isinstance(x, Column) for x in self.s0):
            return tuple(vec.column(x) / vec.norm(self.s0) for x in self.s0)
        length = math.sqrt(sum(x * x for x in self.s0))
        return tuple(x / length for x in self.s0)


@dataclass(frozen=True)
class Extraction:
    """Settings of an extraction; None: a filter is off."""

    pixel_step: int = 1
    gain: float = 1.0
    constant_background: float | None = None
    min_res: float | None = None  # d-limits: low resolution first
    max_res: float | None = None
    min_intensity: float | None = None
    max_intensity: float | None = None
    use_lp: bool = True
    use_qe: bool = True
    use_solid_angle: bool = True
    use_air: bool = True
    drop_invalid: bool = False
    q_convention: str = "2pi"


def unfolded(images: DataFrame) -> DataFrame:
    """Dense images (image_id, panel_id, n_slow, n_fast, data) as one row for each pixel."""
    cells = images.select("image_id", "panel_id", "n_fast", F.posexplode("data").alias("at", "raw"))
    return cells.select("image_id", "panel_id", F.expr("cast(at div n_fast as int)").alias("slow"), (F.col("at") % F.col("n_fast")).cast("int").alias("fast"), F.col("raw").cast("double").alias("raw"))


def thinned(pixels: DataFrame, step: int) -> DataFrame:
    """Every step-th pixel along both axes."""
    if step < 1:
        raise ValueError(f"pixel step {step} is not positive")
    return pixels if step == 1 else pixels.where((F.col("slow") % step == 0) & (F.col("fast") % step == 0))


def lab_position(panel: Panel, slow: Column, fast: Column) -> tuple[Column, ...]:
    """Millimetres in the laboratory frame."""
    return tuple(vec.column(o) + fast * vec.column(panel.px_fast * f) + slow * vec.column(panel.px_slow * s) for o, f, s in zip(panel.origin, panel.fast_axis, panel.slow_axis, strict=True))


def q_vector(lab: vec.Vector, beam: Beam, convention: str = "2pi") -> tuple[Column, ...]:
    """Scattering vector; convention "2pi": |k| = 2 pi / wavelength, "1": 1 / wavelength."""
    if convention not in ("2pi", "1"):
        raise ValueError(f"q convention {convention!r} is neither 2pi nor 1")
    k = (2 * math.pi if convention == "2pi" else 1.0) / beam.wavelength
    r = vec.norm(lab)
    return tuple(F.lit(k) * (vec.column(x) / r - F.lit(s)) for x, s in zip(lab, beam.direction, strict=True))


def q_length(lab: vec.Vector, beam: Beam, convention: str = "2pi") -> Column:
    """|q| from the scattering angle: a filter on it, pushed below the projections, stays one short expression."""
    k = (2 * math.pi if convention == "2pi" else 1.0) / beam.wavelength
    return F.lit(k) * F.sqrt(F.greatest(F.lit(2.0) - 2.0 * vec.dot(lab, beam.direction) / vec.norm(lab), F.lit(0.0)))


def d_spacing(q: Column, convention: str = "2pi") -> Column:
    k = 2 * math.pi if convention == "2pi" else 1.0
    return F.when(q == 0, F.lit(float("inf"))).otherwise(F.lit(k) / F.when(q == 0, F.lit(1.0)).otherwise(q))


def grid_d_spacing(q: Column) -> Column:
    return F.lit(1.0) / (q + 1e-10)


def with_geometry(pixels: DataFrame, panel: Panel, beam: Beam, convention: str = "2pi") -> DataFrame:
    """pixels with lab_x.., qx.., q and d."""
    lab = lab_position(panel, F.col("slow"), F.col("fast"))
    out = pixels.withColumns(dict(zip(("lab_x", "lab_y", "lab_z"), lab, strict=True)))
    out = out.withColumns(dict(zip(("qx", "qy", "qz"), q_vector([F.col(c) for c in ("lab_x", "lab_y", "lab_z")], beam, convention), strict=True)))
    out = out.withColumn("q", q_length([F.col(c) for c in ("lab_x", "lab_y", "lab_z")], beam, convention))
    return out.withColumn("d", d_spacing(F.col("q"), convention))


#: Columns that with_models adds to pixels: of the panel and of the beam.
_PANEL = {"origin": 3, "fast_axis": 3, "slow_axis": 3, "px_fast": 0, "px_slow": 0}
_BEAM = ("wavelength", "s0x", "s0y", "s0z")


def with_models(pixels: DataFrame, panels: DataFrame, beams: DataFrame, table: DataFrame | None = None) -> tuple[DataFrame, Panel, Beam]:
    """pixels joined with the panel of each (by panel_id) and the beam of its image (by image_id), and both as columns of the result.

    panels, beams: see schema.PANEL and schema.BEAM; table: of mass attenuation (see air.tabulated). Both are dimensions of one row for each panel
    and image; Spark broadcasts them where their size allows it. Pixels without a panel or beam stay, with nulls.
    """
    panels = panels.select("panel_id", *[F.col(c).alias(f"_p_{c}") for c in _PANEL])
    beams = attenuation.with_air(beams, table).select("image_id", *[F.col(c).alias(f"_b_{c}") for c in (*_BEAM, "air")])
    out = pixels.join(panels, "panel_id", "left").join(beams, "image_id", "left")
    panel = Panel(**{c: tuple(F.col(f"_p_{c}")[k] for k in range(n)) if n else F.col(f"_p_{c}") for c, n in _PANEL.items()})
    return out, panel, Beam(F.col("_b_wavelength"), tuple(F.col(f"_b_{c}") for c in _BEAM[1:]), F.col("_b_air"))


def without_models(pixels: DataFrame) -> DataFrame:
    return pixels.drop(*[f"_p_{c}" for c in _PANEL], *[f"_b_{c}" for c in (*_BEAM, "air")])


def usable(pixels: DataFrame, bad: DataFrame | None) -> DataFrame:
    """Without the listed bad pixels: of their image where the list has an image_id (image_id, panel_id, slow, fast), else of all images. An
    anti-join, which Spark broadcasts where the list is small; its key is the pixel, so an image of many pixels is no hot key."""
    if bad is None:
        return pixels
    keys = [c for c in ("image_id", "panel_id", "slow", "fast") if c in bad.columns]
    return pixels.join(bad.select(*keys).distinct(), keys, "left_anti")


def with_background(pixels: DataFrame, measured: DataFrame) -> DataFrame:
    """pixels with bg of a measured background (panel_id, slow, fast, bg), null where it has none."""
    return pixels.join(measured.select("panel_id", "slow", "fast", "bg"), ["panel_id", "slow", "fast"], "left")


def placed() -> Column:
    """Whether a pixel has a position in the laboratory."""
    out = F.lit(True)
    for c in ("lab_x", "lab_y", "lab_z"):
        out = out & F.col(c).isNotNull() & ~F.isnan(c)
    return out


def limits(column: str, low: float | None, high: float | None) -> Column:
    out = F.lit(True)
    if low is not None:
        out = out & (F.col(column) >= low)
    if high is not None:
        out = out & (F.col(column) <= high)
    return out


def observations(
    pixels: DataFrame, panel: Panel | DataFrame, beam: Beam | DataFrame, settings: Extraction = Extraction(), bad: DataFrame | None = None,
    measured: DataFrame | None = None, peaks: DataFrame | None = None,
) -> DataFrame:
    """Corrected observations of usable pixels. Optional columns lp_div and qe of pixels hold those factors; measured: (panel_id, slow, fast, bg).

    panel and beam: one for all pixels, or both as tables (see with_models). bad: pixels of a mask that all images share; peaks: of each image (image_id, panel_id, slow, fast).
    """
    out = usable(usable(thinned(pixels, settings.pixel_step), bad), peaks)
    bg = None
    if measured is not None:
        out, bg = with_background(out, measured), F.col("bg")
    if isinstance(panel, DataFrame) != isinstance(beam, DataFrame):
        raise ValueError("give both panel and beam as tables, or none")
    if isinstance(panel, DataFrame):
        out, panel, beam = with_models(out, panel, beam)
    out = with_geometry(out, panel, beam, settings.q_convention)
    lab = [F.col(c) for c in ("lab_x", "lab_y", "lab_z")]
    out = out.where(placed() & F.col("q").isNotNull()).where(limits("d", settings.max_res, settings.min_res))
    factors = {
        "lp": corrections.lp_factor(F.col("lp_div")) if settings.use_lp and "lp_div" in pixels.columns else F.lit(1.0),
        "qe": corrections.qe_factor(F.col("qe")) if settings.use_qe and "qe" in pixels.columns else F.lit(1.0),
        "sa": corrections.solid_angle_factor(corrections.solid_angle(lab, panel.fast_axis, panel.slow_axis, panel.px_fast, panel.px_slow)) if settings.use_solid_angle else F.lit(1.0),
        "air": corrections.air_factor(lab, beam.wavelength, mu=beam.air) if settings.use_air else F.lit(1.0),
    }
    level, variance = corrections.background(bg, settings.constant_background)
    out = out.withColumn("factor", corrections.total_factor(factors))
    out = out.withColumn("intensity", corrections.net_intensity(F.col("raw"), level, settings.gain) * F.col("factor"))
    out = out.withColumn("sigma", corrections.poisson_sigma(F.col("raw"), variance, settings.gain) * F.col("factor"))
    out = out.where(limits("intensity", settings.min_intensity, settings.max_intensity))
    if settings.drop_invalid:
        out = out.where(~F.isnan("sigma"))
    return out.select("image_id", "panel_id", "slow", "fast", "qx", "qy", "qz", "intensity", "sigma")
