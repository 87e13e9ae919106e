"""Quality rules: robust multivariate outliers by minimum covariance determinant, for each language and source.

Each text gives six transformed statistics. For each (language, source), each language and all rows together, three
deterministic starts (medians and inter-quartile ranges; these with the correlations of bounded scores; with those of spatial
signs) each take concentration steps over all rows: the share KEPT of the rows nearest to the centre, by Mahalanobis distance,
gives the next mean and covariance. Steps go on until no determinant falls any more; the start of the least determinant
wins, and its covariance is made consistent for normal data. The estimate of a language is drawn towards that of all rows, and that of a
(language, source) towards its language's, as if PRIOR rows of theirs had been seen: small groups have estimates by the same
rule as large ones. FLOOR is added to each standard deviation's square: a statistic that hardly varies rejects no small change.

A row is rejected beyond CUT: SIGMAS standard deviations over the mean of the logarithm of a chi-square variable of as many degrees of
freedom as there are statistics. Distances of real statistics have longer tails than normal ones have; labels play no part in the bound.

A step is one aggregation with partial sums, by group and by distance in steps of 1/RESOLUTION octave, so a source with a third
of all rows is no hot key; only sums of a group, never its rows, meet in one task. The nearest share is made of whole
steps of distance, and quartiles are of values rounded to 1/VALUES: both are the same rule for groups of any size.

Cases: null language or source are values like any other; null and empty texts fail the base rule (no words);
rows that fail the base rules are rejected and take no part in the estimates; repeated rows count each; rows at equal
distance are near together or not at all; without a row that passes the base rules there is no estimate, and no row to judge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reciprospark.llm.common import discard, stored, table
from reciprospark.llm.statistics import with_counts

KEPT, SIGMAS, PRIOR, RESOLUTION, VALUES, FALL = 0.75, 5.0, 60.0, 16, 4096, 1e-3
FLOOR = (0.04, 0.05, 0.08, 0.12, 0.05, 0.05)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NEEDED = (*BASE, "n_chars_all", "n_lines", "n_distinct", "n_upper")
P = len(FLOOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
GROUP = ["level", "lang", "source"]
X = [f"x{i}" for i in range(P)]


def transformed() -> list[Column]:
    """The statistic vector: log mean word length, and variance-stabilised shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log(1 + F.col("word_chars") / words),
        F.sqrt(F.col("n_symbols") / words),
        F.asin(F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))),
        F.asin(F.sqrt(F.col("n_repeat_words") / words)),
        F.log(1 + F.col("n_distinct")) / F.log(1 + words),
        F.sqrt(F.col("n_upper") / F.greatest(F.col("n_chars_all"), F.lit(1))),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def chi_square(x: float, p: int) -> float:
    """The distribution function for an even number p of degrees of freedom."""
    term = total = 1.0
    for k in range(1, p // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_bound(tail: float, p: int) -> float:
    """x with the given probability beyond it."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        low, high = (x, high) if 1 - chi_square(x, p) > tail else (low, x)
    return low


def log_chi_square(p: int) -> tuple[float, float]:
    """Mean and standard deviation of the logarithm of a chi-square variable of an even number p of degrees of freedom."""
    k = range(1, p // 2)
    return math.log(2) - 0.5772156649015329 + sum(1 / x for x in k), math.sqrt(math.pi**2 / 6 - sum(1 / x**2 for x in k))


CUT = math.exp(log_chi_square(P)[0] + SIGMAS * log_chi_square(P)[1])
_KEYS = "level int, lang string, source string"
_FIELDS = f"{_KEYS}, start int, n long, h long, det double, " + ", ".join([f"m{i} double" for i in range(P)] + [f"c{i}_{j} double" for i, j in PAIRS] + [f"v{i}_{j} double" for i, j in PAIRS])
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def consistency(share: float) -> float:
    """What the covariance of the nearest share of normal rows is to be multiplied with."""
    return share / chi_square(chi_square_bound(1 - share, P), P + 2) if 0 < share < 1 else 1.0


def _row(group: list, start: int, n: float, h: float, mean: np.ndarray, cov: np.ndarray) -> list:
    whole = cov + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(whole)
    return [*group, start, int(n), int(h), float(np.linalg.slogdet(whole)[1]), *mean.tolist(), *[float(cov[i, j]) for i, j in PAIRS], *[float(inverse[i, j]) for i, j in PAIRS]]


def _matrix(r, name: str) -> np.ndarray:
    out = np.zeros((P, P))
    for i, j in PAIRS:
        out[i, j] = out[j, i] = getattr(r, f"{name}{i}_{j}")
    return out


def _mapped(df: DataFrame, rows, fields: str = _FIELDS) -> DataFrame:
    """rows(r) gives the rows that come of each row r."""
    names = [f.split()[0] for f in fields.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([x for r in f.itertuples(index=False) for x in rows(r)], columns=names)

    return df.mapInPandas(run, fields)


def _text(x):
    return None if x is None or x != x else x


def levelled(rows: DataFrame) -> DataFrame:
    """Each row three times: for its language and source, its language, and all rows."""
    none = F.lit(None).cast("string")
    keys = [F.struct(F.lit(k).alias("level"), a.alias("lang"), b.alias("source")) for k, (a, b) in enumerate(((F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)))]
    return rows.select(F.explode(F.array(*keys)).alias("g"), *X).select("g.*", *X)


def joined(rows: DataFrame, fit: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """rows with what fit has of their group; null keys are equal. Spark broadcasts the estimates where their stored size allows it."""
    fit = fit.withColumnsRenamed({c: f"_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & rows[c].eqNullSafe(fit[f"_{c}"])
    return rows.join(fit, on, how).drop(*[f"_{c}" for c in by])


def quartiles(rows: DataFrame) -> DataFrame:
    """Of each group: n and, for each statistic, q0_i, q1_i, q2_i. rows as of levelled."""
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.rint(F.col(x) * VALUES).cast("long").alias("v")) for i, x in enumerate(X)])).alias("s")
    counts = rows.select(*GROUP, values).groupBy(*GROUP, "s.i", "s.v").agg(F.count("*").alias("n"))
    over = Window.partitionBy(*GROUP, "i")
    counts = counts.withColumn("below", F.sum("n").over(over.orderBy("v"))).withColumn("all", F.sum("n").over(over))
    at = [F.min(F.when((F.col("i") == i) & (F.col("below") >= q * F.col("all")), F.col("v") / VALUES)).alias(f"q{k}_{i}") for k, q in enumerate((0.25, 0.5, 0.75)) for i in range(P)]
    return counts.groupBy(*GROUP).agg(F.max("all").alias("n"), *at)


def starts(rows: DataFrame) -> DataFrame:
    """The three first estimates of each group."""
    of = stored(quartiles(rows), "quartiles")
    near = joined(rows, of, GROUP, "inner")
    z = [(F.col(x) - F.col(f"q1_{i}")) / F.sqrt(F.pow((F.col(f"q2_{i}") - F.col(f"q0_{i}")) / 1.349, 2) + FLOOR[i] ** 2) for i, x in enumerate(X)]
    near = near.withColumns({f"z{i}": c for i, c in enumerate(z)}).withColumn("r", F.greatest(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0)), F.lit(1e-12)))
    bounded = [F.sum(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"t{i}_{j}") for i, j in PAIRS]
    signs = [F.sum(F.col(f"z{i}") * F.col(f"z{j}") / F.col("r")).alias(f"s{i}_{j}") for i, j in PAIRS]
    sums = near.groupBy(*GROUP, "n", *[f"q{k}_{i}" for k in range(3) for i in range(P)]).agg(*bounded, *signs)

    def first(r) -> Iterator[list]:
        q = np.array([[getattr(r, f"q{k}_{i}") for i in range(P)] for k in range(3)])
        scale = (q[2] - q[0]) / 1.349
        for start, name in enumerate((None, "t", "s")):
            m = np.eye(P) if name is None else _matrix(r, name)
            size = np.sqrt(np.maximum(np.diag(m), 1e-12))
            correlation = m / size / size[:, None]
            np.fill_diagonal(correlation, 1.0)
            yield _row([int(r.level), _text(r.lang), _text(r.source)], start, r.n, 0, q[1], correlation * scale * scale[:, None])

    out = stored(_mapped(sums, first), "mcd")
    discard(of)
    return out


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. under m0.. and v0_0.. of the same row."""
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    return sum((d[i] * d[j] * F.col(f"v{i}_{j}") * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def concentrated(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """The estimates after one step for each group and start; only those of a determinant that falls."""
    centre = ["start", *[f"m{i}" for i in range(P)], *[f"v{i}_{j}" for i, j in PAIRS]]
    near = joined(rows, fit.select(*GROUP, *centre), GROUP, "inner")
    step = F.floor(F.log2(distance() + 1e-6) * RESOLUTION).cast("int").alias("step")
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    sums = near.groupBy(*GROUP, "start", step).agg(F.count("*").alias("h"), *[F.sum(d[i]).alias(f"s{i}") for i in range(P)], *[F.sum(d[i] * d[j]).alias(f"p{i}_{j}") for i, j in PAIRS])
    over = Window.partitionBy(*GROUP, "start")
    sums = sums.withColumn("before", F.sum("h").over(over.orderBy("step")) - F.col("h")).withColumn("n", F.sum("h").over(over))
    sums = sums.where(F.col("before") < KEPT * F.col("n")).groupBy(*GROUP, "start", "n").agg(*[F.sum(c).alias(c) for c in ("h", *[f"s{i}" for i in range(P)], *[f"p{i}_{j}" for i, j in PAIRS])])
    old = fit.select(*GROUP, "start", F.col("det").alias("was"), (F.col("h") > 0).alias("stepped"), *[f"m{i}" for i in range(P)])

    def after(r) -> Iterator[list]:
        shift = np.array([getattr(r, f"s{i}") for i in range(P)]) / r.h
        found = _row([int(r.level), _text(r.lang), _text(r.source)], int(r.start), r.n, r.h, np.array([getattr(r, f"m{i}") for i in range(P)]) + shift, _matrix(r, "p") / r.h - np.outer(shift, shift))
        if found[6] < r.was - FALL or not r.stepped:
            yield found

    return _mapped(joined(sums, old, [*GROUP, "start"], "inner"), after)


def estimated(rows: DataFrame) -> DataFrame:
    """The estimate of each (level, lang, source) of rows, which has x0..: a table of _FIELDS. The least determinant of the three starts, settled."""
    rows = levelled(rows)
    moving, settled = starts(rows), []
    while not moving.isEmpty():
        after = stored(concentrated(rows, moving), "mcd")
        # a group and start that did not fall stays as it was
        still = moving.join(after.select(*[F.col(c).alias(f"_{c}") for c in (*GROUP, "start")]), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*GROUP, "start")], "left_anti")
        settled.append(stored(still, "settled"))
        discard(moving)
        moving = after
    best = moving
    for part in settled:
        best = best.unionByName(part)
    best = best.withColumn("_rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy("det", "start"))).where("_rank = 1").drop("_rank")
    out = stored(best, "mcd")
    discard(moving, *settled)
    return out


def fitted(rows: DataFrame) -> DataFrame:
    """The estimate to judge each (lang, source) by; rows has x0.. and base_failed."""
    found = estimated(rows.where(~F.col("base_failed")).select("lang", "source", *X))
    values = ["n", "h", *[f"m{i}" for i in range(P)], *[f"c{i}_{j}" for i, j in PAIRS]]

    def of(level: int) -> DataFrame:
        return found.where(F.col("level") == level).select(*GROUP, *[F.col(c).alias(c if level == 0 else f"{'_lp'[level]}_{c}") for c in values])

    whole = joined(of(0), of(1).drop("level", "source"), ["lang"], "inner").crossJoin(F.broadcast(of(2).drop(*GROUP)))  # one row

    def drawn(r) -> Iterator[list]:
        mean = cov = None
        for name in ("p_", "l_", ""):
            n = float(getattr(r, f"{name}n"))
            own = np.array([getattr(r, f"{name}m{i}") for i in range(P)])
            spread = _matrix(r, f"{name}c") * consistency(getattr(r, f"{name}h") / n)
            mean, cov = (own, spread) if mean is None else ((n * own + PRIOR * mean) / (n + PRIOR), (n * spread + PRIOR * cov) / (n + PRIOR))
        yield _row([0, _text(r.lang), _text(r.source)], 0, r.n, r.h, mean, cov)

    return stored(_mapped(whole, drawn).select("lang", "source", *[f"m{i}" for i in range(P)], *[f"v{i}_{j}" for i, j in PAIRS]), "mcd")


def vectors(docs: DataFrame) -> DataFrame:
    """docs with the counts, base_failed and x0..; columns of docs with such names are replaced."""
    out = with_counts(docs, NEEDED).withColumn("base_failed", base_failed())
    return out.withColumns(dict(zip(X, transformed(), strict=True)))


def verdicts(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """rows with distance (null where there is no estimate) and kept."""
    rows = joined(rows, fit, ["lang", "source"]).withColumn("distance", distance())
    rows = rows.drop(*[f"m{i}" for i in range(P)], *[f"v{i}_{j}" for i, j in PAIRS])
    return rows.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUT))


def filtered(docs: DataFrame) -> DataFrame:
    """The documents kept, with the columns of docs. Columns that clash with this module's are carried in a struct meanwhile.

    Texts and statistics are written once to the shared folder, so the statistics are counted once."""
    held = docs.select("text", "lang", "source", F.struct(*[c for c in docs.columns if c != "text"]).alias("_held"))
    rows = stored(vectors(held), "vectors")
    out = verdicts(rows, fitted(rows)).where("kept")
    return out.select(*[F.col("text") if c == "text" else F.col("_held").getField(c).alias(c) for c in docs.columns])


def op4_outliers(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = stored(vectors(docs).drop("text"), "vectors")
    return verdicts(rows, fitted(rows)).select("doc_id", *BASE, "base_failed", "kept", "distance")
