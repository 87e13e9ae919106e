"""Quality classifier: a sparse rule ensemble, compiled into Spark column expressions.

Small boosted trees over text statistics are grown on a bounded sample of labelled rows; each path from a root becomes a
conjunction of thresholds. A lasso logistic regression over these rules, its penalty chosen on a fifth of the sample,
leaves a few rules with weights. A score is the logistic function of their weighted sum: one expression over the
statistics, evaluated in generated code over all rows; the statistics come from one narrow pass over whole texts.

The sample: at most SAMPLE labelled rows, those of smallest hash of their id. It is all that comes to the driver.

Cases: null and empty texts have zero statistics and get the score of such texts; labels other than 0 and 1, or null,
are not learned from; of several labels of one id the least counts; with labels of one class only, or none, the score is that class's share, or a half; repeated rows
are each scored; other columns are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import remainder, table
from reciprospark.llm.statistics import COUNTS, with_counts

SAMPLE, TREES, DEPTH, BINS, SHRINK, LEAST_LEAF = 20_000, 40, 3, 32, 0.3, 10


def features() -> dict[str, Column]:
    """Shares and averages of the counts; 0 for texts without words."""
    c = {n: F.col(n).cast("double") for n in COUNTS}
    words, chars, rows = (F.greatest(c[n], F.lit(1.0)) for n in ("n_words", "n_chars_all", "n_lines"))
    return {
        "f_words": F.log1p(c["n_words"]), "f_word_chars": c["word_chars"] / words, "f_symbols": c["n_symbols"] / words, "f_dup_lines": c["n_dup_lines"] / rows,
        "f_repeats": c["n_repeat_words"] / words, "f_distinct": c["n_distinct"] / words, "f_upper": c["n_upper"] / chars, "f_lower": c["n_lower"] / chars,
        "f_digits": c["n_digits"] / chars, "f_punct": c["n_punct"] / words, "f_marked": c["n_marked"] / words, "f_short_lines": c["n_short_lines"] / rows, "f_runs": c["n_runs"] / words,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each (feature, bound, above) the feature is over the bound, or at most it."""

    terms: tuple[tuple[str, float, bool], ...]

    def on(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(x[f] > b) == above for f, b, above in self.terms])

    def column(self) -> Column:
        out = F.lit(True)
        for f, b, above in self.terms:
            out = out & ((F.col(f) > b) if above else (F.col(f) <= b))
        return out


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(binned: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, path: tuple, depth: int, out: list) -> None:
    """A regression tree by histograms of gradients; appends (path, rows, step) of every node but the root."""
    g, h = grad[rows], hess[rows]
    if path:
        out.append((path, rows, -g.sum() / (h.sum() + 1.0), depth == 0))
    if depth == 0:
        return
    best = (1e-6, -1, 0)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(binned.shape[1]):
        b = binned[rows, f]
        gs, hs, ns = (np.cumsum(np.bincount(b, weights=w, minlength=BINS))[:-1] for w in (g, h, np.ones(len(rows))))
        gain = gs**2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - whole
        gain[(ns < LEAST_LEAF) | (len(rows) - ns < LEAST_LEAF)] = -1
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    if best[1] < 0:
        if path:
            out[-1] = (*out[-1][:3], True)
        return
    for above in (False, True):
        side = (binned[rows, best[1]] > best[2]) == above
        _grow(binned, rows[side], grad, hess, (*path, (best[1], best[2], above)), depth - 1, out)


def tree_rules(x: dict[str, np.ndarray], y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """The distinct paths of boosted trees, each tree grown on half the rows."""
    names = list(x)
    cuts = [np.unique(np.quantile(x[n], np.linspace(0, 1, BINS + 1)[1:-1])) for n in names]
    binned = np.stack([np.searchsorted(c, x[n], side="left") for c, n in zip(cuts, names, strict=True)], axis=1)
    rng, f, found = np.random.default_rng(7), np.zeros(len(y)), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        grad, hess = p - y, p * (1 - p)
        nodes: list = []
        _grow(binned, np.flatnonzero(rng.random(len(y)) < 0.5), grad, hess, (), depth, nodes)
        for path, _, step, leaf in nodes:
            rule = Rule(tuple((names[k], float(cuts[k][b]), above) for k, b, above in path))
            found[rule] = None
            if leaf:
                f[rule.on(x)] += SHRINK * step
    return list(found)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal steps."""
    n, k = r.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    v, c, t = w.copy(), b, 1.0
    step = 4.0 / (np.square(np.linalg.norm(r, 2)) / n + 1.0)
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-(r @ v + c))) - y
        new = v - step * (r.T @ e) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        nb = c - step * e.mean()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / s * (new - w), nb + (t - 1) / s * (nb - b)
        w, b, t = new, nb, s
    return b, w


def fit(x: dict[str, np.ndarray], y: np.ndarray) -> Ensemble:
    """The ensemble of a sample: features by name, labels 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Ensemble(float(np.log((share + 1e-3) / (1 - share + 1e-3))), ())
    rules = tree_rules(x, y)
    r = np.stack([rule.on(x) for rule in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 1))
    held = np.arange(len(y)) % 5 == 0
    best = (np.inf, 0.0)
    for penalty in (0.02, 0.005, 0.001, 0.0003):
        b, w = lasso(r[~held], y[~held], penalty, 200)
        p = np.clip(1 / (1 + np.exp(-(r[held] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p))
        if loss < best[0] - 1e-4:
            best = (loss, penalty)
    b, w = lasso(r, y, best[1])
    return Ensemble(float(b), tuple((rule, float(k)) for rule, k in zip(rules, w, strict=False) if abs(k) > 1e-6))


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column, limit: int = SAMPLE) -> DataFrame:
    """doc_id, text and y of the rows of at most limit labelled ids, those of smallest hash. keep: which ids may be learned from."""
    own = labels.where(F.col(label).isin(0, 1) & keep).groupBy("doc_id").agg(F.min(label).cast("double").alias("y"))
    own = F.broadcast(own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))  # at most limit rows of two numbers
    return docs.select("doc_id", "text").join(own, "doc_id")


def scored(docs: DataFrame, model: Ensemble) -> DataFrame:
    """docs with score in (0, 1) in place of text."""
    rows = with_counts(docs.select(*[c for c in docs.columns if c != "score"]), drop_text=True)
    names = [c for c in rows.columns if c not in COUNTS]
    return rows.select(*names, *[c.alias(n) for n, c in features().items()]).select(*names, model.column().alias("score"))


def learned(docs: DataFrame, labels: DataFrame, label: str, keep: Column, limit: int = SAMPLE) -> Ensemble:
    rows = with_counts(labelled(docs, labels, label, keep, limit), drop_text=True).select("doc_id", "y", *[c.alias(n) for n, c in features().items()])
    rows = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(limit).toPandas()  # ids may repeat: the limit holds for rows, too
    return fit({n: rows[n].to_numpy(float) for n in features()}, rows["y"].to_numpy(float))


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those predicted to be of low quality. Columns of docs stay as they are."""
    model = learned(docs, labels, "quality", remainder(F.col("doc_id"), 3) != 1)
    held = docs.select("text", F.struct(*docs.columns).alias("__held"))
    return scored(held, model).where("score >= 0.5").select("__held.*")


def op2_rule_ensemble(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learned(docs, table(spark, sf_dir, "labels"), "quality", remainder(F.col("doc_id"), 3) != 1)
    found = scored(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
