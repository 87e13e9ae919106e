from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCS, prose

from reciprospark.llm import lm, outliers, quotes, rules, seating, toxicity, urls
from reciprospark.llm.common import stored

LABELS = "doc_id long, quality int, toxic int"


# language model


def brute_base(docs):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in docs]
    tokens = [[*(t or "").encode().lower().split(), None] for _, t, *_ in docs]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return sorted(((i if i is not None else -1), h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for (i, *_), t, h in zip(docs, tokens, held, strict=True))


@pytest.mark.parametrize("small", [False, True])
def test_lm_scores(spark, odd_docs, folder, monkeypatch, small):
    if small:  # many chunks, buckets and blocks
        monkeypatch.setattr(lm, "CHUNK_BYTES", 100_000)
        monkeypatch.setattr(lm, "BLOCK_TOKENS", 20_000)
        monkeypatch.setattr(lm, "BUCKET_WORDS", 50)
        monkeypatch.setattr(lm, "FAN_IN", 2)
    docs = [*odd_docs, *[(100 + k, "the same start of a text " + prose(k % 20, 40), "en", "s", 1) for k in range(60)]]
    got = lm.op1_pitman_yor(spark, folder(documents=(docs, DOCS))).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == brute_base(docs)
    assert all(r.score < 0 for r in got)
    held = [r for r in got if r.held_out and (r.doc_id or 0) >= 100]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_is_a_distribution(spark):
    """The probabilities of what may follow a context add up to one: those after a word give the chances that a text ends there, which those after the begin must agree with."""
    docs = [(k, t, "en", "s", 1) for k, t in enumerate(["a b a c", "a b", "c a b", "b"] * 3)]
    train = spark.createDataFrame(docs, DOCS).select("doc_id", "text", F.lit(False).alias("held"))
    names = ["a", "b", "c", "zzz"]
    texts = ["", *names, *[f"{x} {y}" for x in names for y in names]]
    asked = spark.createDataFrame([(100 + k, t, True) for k, t in enumerate(texts)], "doc_id long, text string, held boolean")
    got = {texts[r.doc_id - 100]: 10**r.score for r in lm.scored(train.unionByName(asked), F.col("held")).where("doc_id >= 100").collect()}
    one = np.array([got[x] for x in names])  # P(x) P(end | x)
    two = np.array([[got[f"{x} {y}"] for y in names] for x in names])
    chance = np.linalg.solve(np.diag(one) - two, one)  # 1 / P(end | x), if what follows each x adds up to one
    assert (chance > 1).all() and (one * chance).sum() + got[""] == pytest.approx(1, abs=1e-5)


def test_perplexity(spark):
    rows = spark.createDataFrame([(True, 2, -3.0), (True, 4, -3.0), (False, 1, -1.0)], "held_out boolean, n_tokens long, score double")
    assert {r.held_out: (r.n_texts, r.n_tokens, r.perplexity) for r in lm.perplexity(rows).collect()} == {True: (2, 6, pytest.approx(10.0)), False: (1, 1, pytest.approx(10.0))}


def test_scores_do_not_depend_on_files(spark):
    docs = spark.createDataFrame([(k, prose(k % 9, 30 + k), k % 5 == 0) for k in range(40)], "doc_id long, text string, held boolean")
    one, many = ({r.doc_id: r.score for r in lm.scored(docs.repartition(n, "doc_id"), F.col("held")).collect()} for n in (1, 5))
    assert one == pytest.approx(many, rel=1e-6)


def seat_by_seat(n, d, d0, base, sweeps, seed):
    """Mean tables of each dish, and of each of the root's, by moving one customer at a time."""
    r, rest, root = random.Random(seed), [[[] for _ in row] for row in n], [[] for _ in n[0]]

    def chosen(sizes, weights, new):
        x = r.random() * (new + sum(weights))
        for k, w in enumerate(weights):
            x -= w
            if x < 0:
                return k
        sizes.append(0)
        return len(sizes) - 1

    def enter(sizes, discount, new):
        k = chosen(sizes, [z - discount for z in sizes], new)
        sizes[k] += 1
        return sizes[k] == 1

    def leave(sizes):
        k = chosen(sizes, list(sizes), 0)
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            return True
        return False

    def new_in_root():
        return (1 + d0 * sum(map(len, root))) * base

    def add(u, w):
        p = (sum(root[w]) - d0 * len(root[w]) + new_in_root()) / (1 + sum(map(sum, root)))
        if enter(rest[u][w], d, (1 + d * sum(map(len, rest[u]))) * p):
            enter(root[w], d0, new_in_root())

    def remove(u, w):
        if leave(rest[u][w]):
            leave(root[w])

    customers = [(u, w) for u, row in enumerate(n) for w, c in enumerate(row) for _ in range(c)]
    for u, w in customers:
        add(u, w)
    tables, roots = np.zeros(np.shape(n)), np.zeros(len(n[0]))
    for k in range(sweeps):
        for u, w in customers:
            remove(u, w)
            add(u, w)
        if k >= 50:
            tables += [[len(x) for x in row] for row in rest]
            roots += [len(x) for x in root]
    return tables / (sweeps - 50), roots / (sweeps - 50)


def test_blocks_are_seated_as_seat_by_seat():
    n, d, d0, base = np.array([[9, 3, 1, 0], [2, 8, 2, 1], [0, 1, 6, 4]]), 0.6, 0.5, 0.2
    want = seat_by_seat(n.tolist(), d, d0, base, 3000, 1)
    rng, t, roots = np.random.default_rng(2), np.minimum(n, 1), np.ones(4, dtype=np.int64)
    c, total, total_root, sweeps = t.sum(0), np.zeros(n.shape), np.zeros(4), 3000
    for k in range(sweeps):
        mass, rest = seating.root_masses(c, roots, d0, rng), rng.standard_gamma(1 + d0 * roots.sum())
        p = (mass + rest * base) / (mass.sum() + rest)
        t = seating.tables(n.ravel(), (seating.restaurant_masses(t.sum(1), 1.0, d, rng)[:, None] * p).ravel(), d, rng).reshape(n.shape)
        c = t.sum(0)
        roots = seating.tables(c, np.full(4, seating.restaurant_masses(np.array([roots.sum()]), 1.0, d0, rng)[0] * base), d0, rng)
        if k >= 50:
            total, total_root = total + t, total_root + roots
    assert total / (sweeps - 50) == pytest.approx(want[0], rel=0.05) and total_root / (sweeps - 50) == pytest.approx(want[1], rel=0.05)


def test_lm_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, held boolean")
    assert lm.scored(empty, F.col("held")).count() == 0
    held = spark.createDataFrame([(1, "a b", True), (2, None, True)], "doc_id long, text string, held boolean")
    assert all(r.score == 0 and r.base_score == 0 and r.train_tokens == 0 for r in lm.scored(held, F.col("held")).collect())


# outliers


def brute_mcd(x):
    """The estimate of one group: mean, covariance, rows in the nearest share."""
    floor = np.diag(np.square(outliers.FLOOR))
    v = np.rint(x * outliers.VALUES) / outliers.VALUES
    q = np.array([[np.sort(c)[max(0, math.ceil(share * len(c)) - 1)] for c in v.T] for share in (0.25, 0.5, 0.75)])
    scale = (q[2] - q[0]) / 1.349
    z = (x - q[1]) / np.sqrt(scale**2 + np.square(outliers.FLOOR))
    best = None
    for m in (np.eye(outliers.P), np.tanh(z).T @ np.tanh(z), (z / np.square(z).sum(1)[:, None]).T @ z):
        size = np.sqrt(np.diag(m))
        mean, cov, last, h = q[1], m / size / size[:, None] * scale * scale[:, None], math.inf, 0
        while True:
            d = np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov + floor), x - mean)
            step = np.floor(np.log2(d + 1e-6) * outliers.RESOLUTION)
            near = x[step <= np.sort(step)[math.ceil(outliers.KEPT * len(x)) - 1]]
            new = near.mean(0), np.cov(near.T, bias=True)
            det = np.linalg.slogdet(new[1] + floor)[1]
            if h and det >= last - outliers.FALL:
                break
            (mean, cov), last, h = new, det, len(near)
        if best is None or last < best[0] - 1e-9:
            best = last, mean, cov, h
    return best[1:]


def test_mcd_against_numpy(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(outliers.P, outliers.P)) * 0.2
    x = rng.normal(size=(400, outliers.P)) @ mix + 1
    x[:60] += 3
    small = rng.normal(size=(7, outliers.P)) * 0.1
    rows = [("en", None, *map(float, r)) for r in x] + [("fr", "s", *map(float, r)) for r in small]
    rows = stored(spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"x{i} double" for i in range(outliers.P))).withColumn("base_failed", F.lit(False)))
    found = {(r.level, r.lang): r for r in outliers.estimated(rows).collect()}
    want = {(0, "en"): x, (1, "en"): x, (0, "fr"): small, (1, "fr"): small, (2, None): np.concatenate([x, small])}
    assert found.keys() == want.keys()
    fits = {k: brute_mcd(v) for k, v in want.items()}
    for k, r in found.items():
        mean, cov, h = fits[k]
        assert (r.n, r.h) == (len(want[k]), h) and [r[f"m{i}"] for i in range(outliers.P)] == pytest.approx(mean.tolist(), abs=1e-7)
        assert [r[f"c{i}_{j}"] for i, j in outliers.PAIRS] == pytest.approx([cov[i, j] for i, j in outliers.PAIRS], abs=1e-7)
    # small groups are drawn towards larger ones by the same rule
    drawn = {r.lang: r for r in outliers.fitted(rows).collect()}
    mean = cov = None
    for level in (2, 1, 0):
        key = (level, None if level == 2 else "fr")
        n, (m, c, h) = len(want[key]), fits[key]
        c = c * outliers.consistency(h / n)
        mean, cov = (m, c) if mean is None else ((n * m + outliers.PRIOR * mean) / (n + outliers.PRIOR), (n * c + outliers.PRIOR * cov) / (n + outliers.PRIOR))
    assert [drawn["fr"][f"m{i}"] for i in range(outliers.P)] == pytest.approx(mean.tolist(), abs=1e-6)
    got = outliers.verdicts(rows, outliers.fitted(rows)).where("lang = 'en'").collect()
    assert sum(not r.kept for r in got) >= 60 and all(not r.kept for r in got if r.x0 > x[60:, 0].max() and r.distance > outliers.CUT)
    d = np.array([r.distance for r in got])
    far = np.array([min(np.abs(np.array([r[c] for c in outliers.X]) - y).max() for y in x[:60]) < 1e-9 for r in got])
    assert (d[far] > outliers.CUT).all() and (d[~far] < outliers.CUT).all()


def test_chi_square():
    logs = np.log(np.random.default_rng(0).chisquare(6, 200_000))
    assert outliers.log_chi_square(6) == pytest.approx((logs.mean(), logs.std()), abs=0.01)
    assert outliers.chi_square(outliers.chi_square_bound(0.05, 6), 6) == pytest.approx(0.95)
    assert outliers.chi_square_bound(0.05, 6) == pytest.approx(12.5916, abs=1e-3)


def test_outlier_rows(spark, odd_docs, folder):
    good = [(1000 + k, prose(k, 150) + ".\nNext line " + prose(k + 500, 50), "en", "src", 1) for k in range(150)]
    junk = [(5000 + k, " ".join(w + "###" for w in prose(k, 200).split()), "en", "src", 1) for k in range(15)]
    d = folder(documents=([*odd_docs, *good, *junk], DOCS))
    got = {r.doc_id: r for r in outliers.op4_outliers(spark, d).collect()}
    assert all(got[i].kept for i, *_ in good) and not any(got[i].kept for i, *_ in junk)
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept and got[3].kept
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(None).cast("string"))
    kept = outliers.filtered(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert outliers.filtered(docs.limit(0)).count() == 0


def test_outliers_of_a_rare_language(spark, folder):
    good = [(k, prose(k, 150) + ".\nNext line " + prose(k + 500, 50), "de" if k % 10 == 0 else "en", "src", 1) for k in range(150)]
    junk = [(5000 + k, " ".join(w + "###" for w in prose(k, 200).split()), "de", "src", 1) for k in range(3)]
    got = {r.doc_id: r for r in outliers.op4_outliers(spark, folder(documents=([*good, *junk], DOCS))).collect()}
    assert all(r.kept == (i < 5000) and r.distance is not None for i, r in got.items())


# rules


def test_rule_ensemble(spark, odd_docs, folder):
    good = [(1000 + k, prose(k, 80), "en", "s", 1) for k in range(200)]
    bad = [(3000 + k, " ".join(w + "$$$" for w in prose(k, 80).split()), "en", "s", 1) for k in range(100)]
    labels = [(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad] + [(1, None, None), (2, 7, 7), (None, 1, 1)]
    d = folder(documents=([*odd_docs, *good, *bad], DOCS), labels=(labels, LABELS))
    got = rules.op2_rule_ensemble(spark, d).collect()
    assert len(got) == len(odd_docs) + 300 and all(0 <= r.score <= 1 for r in got)
    held = {r.doc_id: r.predicted for r in got if r.held_out and (r.doc_id or 0) >= 1000}
    assert len(held) > 50 and all(p == (i < 3000) for i, p in held.items())
    kept = rules.filtered(spark.read.parquet(f"{d}/documents.parquet").withColumn("score", F.lit("mine")), spark.read.parquet(f"{d}/labels.parquet"))
    assert "score" in kept.columns and not any((r.doc_id or 0) >= 3000 for r in kept.collect())


def test_lasso_is_optimal():
    """Where a weight is 0 the slope of the loss is within the penalty, elsewhere it balances it."""
    rng = np.random.default_rng(9)
    r = (rng.random((500, 12)) < 0.4).astype(float)
    y = (rng.random(500) < 1 / (1 + np.exp(-(2 * r[:, 0] - 1.5 * r[:, 1] - 0.3)))).astype(float)
    for penalty in (0.03, 0.005):
        b, w = rules.lasso(r, y, penalty, 3000)
        slope = r.T @ (1 / (1 + np.exp(-(r @ w + b))) - y) / len(y)
        zero = np.abs(w) < 1e-7
        assert zero.any() and (np.abs(slope[zero]) <= penalty + 1e-5).all()
        assert slope[~zero] == pytest.approx(-penalty * np.sign(w[~zero]), abs=1e-5) and abs((1 / (1 + np.exp(-(r @ w + b))) - y).mean()) < 1e-6


def test_rules_are_the_paths_of_trees():
    rng = np.random.default_rng(10)
    x = {"p": rng.random(600), "q": rng.random(600)}
    y = ((x["p"] > 0.5) & (x["q"] <= 0.3)).astype(float)
    found = rules.tree_rules(x, y, trees=3, depth=2)
    assert all(1 <= len(rule.terms) <= 2 for rule in found) and len(set(found)) == len(found)
    assert all((rule.on(x) == np.all([(x[f] > b) if above else (x[f] <= b) for f, b, above in rule.terms], axis=0)).all() for rule in found)
    best = max(found, key=lambda rule: (rule.on(x) == y).mean())
    assert (best.on(x) == y).mean() > 0.95


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x = {n: np.round(rng.random(400), 3) for n in rules.features()}
    y = ((x["f_marked"] > 0.5) & (x["f_upper"] > 0.3)).astype(float)
    model = rules.fit(x, y)
    rows = [tuple(float(x[n][k]) for n in x) for k in range(400)]
    got = [r.s for r in spark.createDataFrame(rows, ", ".join(f"{n} double" for n in x)).coalesce(1).select(model.column().alias("s")).collect()]
    want = 1 / (1 + np.exp(-(model.bias + sum(w * r.on(x) for r, w in model.rules))))
    assert got == pytest.approx(want.tolist()) and ((np.array(got) > 0.5) == (y > 0)).mean() > 0.97 and len(model.rules) < 120


def plain_features(text):
    """The features of a text, counted the long way."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    chars = len(text or "")
    w, c, n = max(len(words), 1), max(chars, 1), max(len(lines), 1)
    count = lambda of: sum(x in of for x in raw)
    return {
        "f_words": math.log1p(len(words)), "f_word_chars": sum(len(x.decode()) for x in words) / w, "f_symbols": count(b"#*$%&|<>") / w, "f_dup_lines": dup / n, "f_repeats": len(again) / w,
        "f_distinct": len({*words}) / w, "f_upper": count(range(65, 91)) / c, "f_lower": count(range(97, 123)) / c, "f_digits": count(range(48, 58)) / c, "f_punct": count(b".,;:!?") / w,
        "f_marked": sum(x[-1:] in [b"%c" % k for k in b"#*$%&|!<>"] for x in words) / w, "f_short_lines": sum(len(x) < 30 for x in lines) / n, "f_runs": sum(a == b for a, b in zip(words, words[1:], strict=False)) / w,
    }


def test_the_rule_query_against_plain_python(spark, folder, odd_docs):
    rng = random.Random(21)
    docs, labels = [r for r in odd_docs if r[0] not in (4, None)], []
    for k in range(360):
        words = prose(k, rng.randrange(20, 90)).split()
        kind = k % 3
        if kind == 1:
            words = [w.upper() + "!" if rng.random() < 0.4 else w for w in words]
        elif kind == 2:
            words = [w for w in words for _ in range(1 + (rng.random() < 0.5))]
        docs.append((1000 + k, "\n".join(" ".join(words[a : a + 9]) for a in range(0, len(words), 9)), "en", "s", 1))
        labels.append((1000 + k, int((kind == 0) != (rng.random() < 0.05)), 0))
    d = folder(documents=(docs, DOCS), labels=(labels, LABELS))
    got = {r.doc_id: r for r in rules.op2_rule_ensemble(spark, d).collect()}
    learn = {i: y for i, y, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    model = rules.learned(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"), "quality", rules.remainder(F.col("doc_id"), 3) != 1)
    assert model.rules and len(learn) < len(labels)
    for i, text, *_ in docs:
        x = plain_features(text)
        total = model.bias + sum(w for rule, w in model.rules if all((x[f] > b) == above for f, b, above in rule.terms))
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9) and got[i].predicted == int(got[i].score >= 0.5)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    held = [i for i, *_ in labels if i not in learn]
    assert np.mean([got[i].predicted == ((i - 1000) % 3 == 0) for i in held]) > 0.93


def test_one_class(spark):
    assert rules.fit({n: np.zeros(0) for n in rules.features()}, np.zeros(0)).rules == ()
    assert rules.fit({n: np.zeros(4) for n in rules.features()}, np.ones(4)).bias > 5


# toxicity


def test_weak_supervision(spark, odd_docs, folder):
    rng = random.Random(3)
    bad = ["grumble", "snarlier", "snarlish", "snarlous", "vexing"]
    docs, labels = [*odd_docs], []
    for k in range(500):
        toxic = k % 4 == 0
        words = prose(k, 60).split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(60), rng.choice(bad))
        docs.append((1000 + k, " ".join(words), "en", "s", 1))
        if k % 3:
            labels.append((1000 + k, 1, int(toxic)))
    d = folder(documents=(docs, DOCS), labels=([*labels, (1, None, None), (None, 0, 1)], LABELS))
    got = toxicity.op10_weak_supervision(spark, d).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in got if (r.doc_id or 0) >= 1000 and r.held_out)
    assert all(r.predicted == 0 for r in got if r.doc_id in (1, 2, 5))


def test_correlated_voters_share_their_evidence():
    rng = np.random.default_rng(4)
    y = rng.random(8000) < 0.3
    lone = (rng.random((8000, 5)) < np.where(y, 0.6, 0.05)[:, None]).astype(float)
    twins = np.where(rng.random((8000, 2)) < 0.97, lone[:, 4:], 1 - lone[:, 4:])
    model, q = toxicity.label_model(toxicity.Votes.of(np.concatenate([lone, twins], axis=1)), (np.full(7, 0.05), np.full(7, 0.5)), 0.3)
    assert ((q > 0.5) == y).mean() > 0.93 and sorted(tuple(sorted((k, p))) for k, p in enumerate(model.parent.tolist()) if k >= 4 <= p) in ([(4, 5), (4, 6)], [(4, 5), (5, 6)], [(4, 6), (5, 6)])
    votes = np.zeros((3, 7))
    votes[1, 0] = votes[2, 4:] = 1  # none, one by itself, three that go together
    none, one, three = model.odds(toxicity.Votes.of(votes))
    assert 0 < three - none < 1.5 * (one - none)


def test_label_model_finds_rates_without_labels():
    """Rates and the class of each row from the votes alone, with two voters that go together."""
    rng = np.random.default_rng(5)
    y = rng.random(6000) < 0.2
    rates = np.where(y[:, None], [0.7, 0.6, 0.5, 0.4, 0.5], [0.02, 0.05, 0.03, 0.1, 0.02])
    v = (rng.random((6000, 5)) < rates).astype(float)
    v = np.concatenate([v, np.where(rng.random(6000) < 0.9, v[:, 0], 1 - v[:, 0])[:, None]], axis=1)
    model, q = toxicity.label_model(toxicity.Votes.of(v), (np.full(6, 0.1), np.full(6, 0.4)), 0.2)
    once, at, times = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    again, same = toxicity.label_model(toxicity.Votes.of(once), (np.full(6, 0.1), np.full(6, 0.4)), 0.2, times.astype(float))
    assert same[at.ravel()] == pytest.approx(q, abs=1e-6) and (again.parent == model.parent).all()
    assert toxicity.linear(toxicity.Inputs(toxicity.Votes.of(once), 5), same, times.astype(float)) == pytest.approx(toxicity.linear(toxicity.Inputs(toxicity.Votes.of(v), 5), q), abs=1e-4)
    assert q @ v[:, :5] / q.sum() == pytest.approx(np.array([0.7, 0.6, 0.5, 0.4, 0.5]), abs=0.06)
    assert ((q > 0.5) == y).mean() > 0.94 and 0 in (model.parent[5], 5 * (model.parent[0] != 5))


def test_forest_keeps_the_strongest_edges():
    info = np.array([[0, 0.5, 0.4, 0], [0.5, 0, 0.45, 0], [0.4, 0.45, 0, 0], [0, 0, 0, 0]])
    parent = toxicity.forest(info.__getitem__, 4, 1000)
    assert sorted(tuple(sorted((k, p))) for k, p in enumerate(parent.tolist()) if p >= 0) == [(0, 1), (1, 2)]


def test_terms_against_plain_python(spark):
    rng = random.Random(9)
    vocabulary = ["grumble", "grumbler", "grumbling", "snarl", "snarling", "vexing", "ok", "fine", "Übel", "übler"]
    rows = [(" ".join([*prose(k, 12).split(), *rng.choices(vocabulary, k=rng.randrange(4) if k % 3 else 0)]) + "!?", int(k % 3 > 0)) for k in range(240)] + [(None, 0), ("", 1)]
    clean, toxic = (sum(y == c for _, y in rows) for c in (0, 1))
    counts = {}
    for text, y in rows:
        words = set("".join(c if ord(c) >= 128 or c.isalnum() else " " for c in text or "").lower().split())
        for t in {t for w in words for t in (w, *[w[:n] + "*" for n in (4, 5, 6, 7) if len(w) > n])}:
            counts.setdefault(t, [0, 0])[y] += 1
    share = {t: (b + 0.1) / (toxic + 0.2) / ((a + 0.1) / (clean + 0.2)) for t, (a, b) in counts.items()}
    wanted = sorted((t for t in counts if counts[t][1] >= 4 and share[t] >= 24), key=lambda t: (-math.log(share[t]) * counts[t][1] ** 0.5, t))
    kept = []
    for t in wanted:
        stem = t.rstrip("*")
        covered = any(k.endswith("*") and stem.startswith(k[:-1]) for k in kept)
        same = t.endswith("*") and any(k.rstrip("*").startswith(stem) and counts[k][1] >= 0.8 * counts[t][1] for k in kept)
        if not covered and not same:
            kept.append(t)
    got = toxicity.mined(spark.createDataFrame(rows, "text string, y int"))
    assert got == kept and len(got) > 3


def test_odds_against_plain_python():
    rng = np.random.default_rng(11)
    size = 12
    v = (rng.random((80, size)) < 0.3).astype(float)
    parent = np.array([-1, 0, 0, 1, -1, 4, 4, 4, 5, -1, 9, -1])
    model = toxicity.LabelModel(-0.7, parent, rng.normal(0, 2, (2, size)), np.where(parent >= 0, rng.normal(0, 2, size), 0))
    want = []
    for row in v:
        total = -0.7
        for k in range(size):
            up = parent[k] >= 0 and row[parent[k]]
            p = [1 / (1 + math.exp(-(model.alone[c][k] + (model.together[k] if up else 0)))) for c in (0, 1)]
            total += math.log(p[1] / p[0]) if row[k] else math.log((1 - p[1]) / (1 - p[0]))
        want.append(total)
    votes = toxicity.Votes.of(v)
    assert model.odds(votes) == pytest.approx(want, abs=1e-9)
    w = rng.random(80)
    assert np.stack([votes.beside(k, w) for k in range(size)]) == pytest.approx((v * w[:, None]).T @ v)
    assert votes.above(parent).tolist() == [bool(parent[k] >= 0 and v[i, parent[k]]) for i in range(80) for k in range(size) if v[i, k]]
    x = toxicity.Inputs(votes, 10)
    n = v[:, :10].sum(axis=1)
    whole = np.concatenate([v, np.log1p(n)[:, None], np.minimum(n, 1)[:, None], np.ones((80, 1))], axis=1)
    a, b = rng.random(size + 3), rng.random(80)
    assert x.times(a) == pytest.approx(whole @ a) and x.back(b) == pytest.approx(b @ whole) and x.squares(b) == pytest.approx(b @ whole**2)


def test_many_voters_need_no_matrix_of_pairs():
    rng = np.random.default_rng(12)
    y = rng.random(3000) < 0.3
    rows = [np.unique(rng.integers(0, 2000, 12) + (2000 if t else 0)) for t in y]
    votes = toxicity.Votes(rows, 4000)
    rates = tuple((votes.by_voter(w.astype(float)) + 0.1) / (w.sum() + 0.2) for w in (~y, y))
    model, q = toxicity.label_model(votes, rates, float(y.mean()), rounds=2)
    assert ((q > 0.5) == y).mean() > 0.99
    fitted = toxicity.Model(["t"] * (4000 - len(toxicity.PATTERNS)), toxicity.linear(toxicity.Inputs(votes, 4000 - len(toxicity.PATTERNS)), q))
    assert ((fitted.scores(votes) > 0.5) == y).mean() > 0.99


EMPTY = {"documents": ([], DOCS), "labels": ([], LABELS), "benchmark": ([], "item_id long, text string")}


@pytest.mark.parametrize("name", ["op2_rule_ensemble", "op3_decontamination", "op4_outliers", "op6_simhash", "op7_token_counts", "op8_bpe", "op10_weak_supervision"])
def test_empty_documents(spark, folder, name):
    from reciprospark.llm import registry

    assert registry.QUERIES[name](spark, folder(**EMPTY)).count() == 0


def test_no_labels(spark, folder):
    d = folder(documents=([(1, "a b", "en", "s", 1)], DOCS), labels=([], LABELS))
    assert [r.score for r in toxicity.op10_weak_supervision(spark, d).collect()] == [pytest.approx(0.5)]


# urls and quotes


def test_url_parts_and_rules(spark, folder):
    rows = [(1, "HTTP://A.Example.NET/en/x?y"), (2, "http://example.net/en"), (3, "http://notexample.com/de/"), (4, "http://x.example.com/de/1#t"), (5, "http://b.org/fr/"), (6, "http://b.org/FR/"), (7, None), (8, "no scheme"), (9, "http://net?q"), (9, "http://net?q"), (10, "x://net/"), (11, "a://b://c.net/"), (12, "http://" + "é" * 5000)]
    got = {r.page_id: r for r in urls.op5_url_filter(spark, folder(pages=(rows, "page_id long, url string"))).collect()}
    assert {i: r.rule for i, r in got.items()} == {1: "example.net/en/", 2: "net/", 3: None, 4: "example.com/de/", 5: "org/fr/", 6: None, 7: None, 8: None, 9: None, 10: "net/", 11: None, 12: None}
    assert (got[1].host, got[1].path) == ("a.example.net", "/en/x") and (got[7].host, got[7].path) == ("", "") and (got[9].host, got[9].path) == ("net", "")
    assert {r.verdict for r in got.values()} <= {"allow", "block"} and got[4].verdict == "block" and got[5].verdict == "allow"


def test_url_models_learn_from_rules(spark, folder):
    rows = [(k, f"http://good{k % 9}.example.net/en/{k}") for k in range(120)] + [(200 + k, f"http://spam-casino{k % 9}.net/win/{k}") for k in range(120)] + [(900, "http://spam-casino3.info/win/77"), (901, "http://good4.example.info/en/12")]
    got = {r.page_id: r.verdict for r in urls.op5_url_filter(spark, folder(pages=(rows, "page_id long, url string"))).collect()}
    assert got[900] == "block" and got[901] == "allow"


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, score string")
    got = urls.judged(pages).collect()
    assert got[0].verdict == "allow" and urls.judged(pages.limit(0)).count() == 0


def test_quotes(spark):
    rows = [
        (1, 1, "u", "First point\nSecond point"), (1, 2, "v", "> second   POINT\nMy answer"), (1, 3, "u", "unrelated"),
        (1, 4, "w", ">> Second point\n> My answer\nDeep"), (1, 5, "u", "> never written\nown"), (2, 1, "u", "> Second point"), (1, None, "u", "> First point"), (3, 1, "u", None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("mine"))
    got = {(r.conv_id, r.turn): r for r in quotes.linked(df).collect()}
    assert {k: r.parent for k, r in got.items()} == {(1, 1): None, (1, 2): 1, (1, 3): None, (1, 4): 2, (1, 5): None, (2, 1): None, (1, None): None, (3, 1): None}
    assert (got[1, 4].thread, got[1, 4].depth, got[1, 4].max_level, got[1, 4].text) == (1, 2, 2, "Deep") and got[2, 1].text == ""
    order = [(r.conv_id, r.turn) for r in quotes.conversations(df.where("conv_id = 1 and turn is not null")).collect()]
    assert order == [(1, 1), (1, 2), (1, 4), (1, 3), (1, 5)]
    assert quotes.linked(df.limit(0)).count() == 0


def brute_quotes(rows):
    """(parent, thread, depth, lines quoted, levels, text without quotes) of each row, by looking at all pairs."""

    def lines(text):
        for line in (text or "").split("\n"):
            mark = re.match(r"[ \t]*(?:>[ \t]*)+", line)
            yield (mark[0].count(">") if mark else 0), " ".join((line[mark.end() :] if mark else line).lower().split()), line

    parents = {}
    for conv, turn, _, text in rows:
        if turn is None:
            continue
        found = {}
        for level, passage, _ in lines(text):
            sources = [t for c, t, _, other in rows if c == conv and t is not None and t < turn and any(n == 0 and p == passage for n, p, _ in lines(other))]
            first = min((t for c, t, _, other in rows if c == conv and t is not None and any(n == 0 and p == passage for n, p, _ in lines(other))), default=None)
            if level and passage and sources and first is not None:
                found[level, first] = found.get((level, first), 0) + len(passage)
        if found:
            best = min(found, key=lambda k: (k[0], -found[k], -k[1]))[1]
            parents[conv, turn] = min(best, parents.get((conv, turn), best))
    out = []
    for conv, turn, _, text in rows:
        at, depth = turn, 0
        while (conv, at) in parents:
            at, depth = parents[conv, at], depth + 1
        each = list(lines(text))
        own = None if text is None else "\n".join(line for n, _, line in each if n == 0)
        out.append((conv, turn, parents.get((conv, turn)), at, depth, sum(n > 0 for n, _, _ in each), max(n for n, _, _ in each), own))
    return out


def test_quotes_against_all_pairs(spark, folder):
    """Nested quotes, one line that most messages have, a null conversation, a long text, null turns and texts."""
    rng = random.Random(8)
    rows = []
    for conv in (1, 2, None):
        said = []
        for turn in range(25):
            own = [f"  {prose(1000 * (conv or 9) + turn, 4)} ", rng.choice(["Kind regards", "kind  REGARDS", "thanks"])]
            quoted = [f"{rng.choice(['>', '> > ', '>>', ' >'])} {line.upper()}" for text in rng.sample(said, min(len(said), rng.randrange(3))) for line in text.split("\n")]
            said.append("\n".join([*quoted, *own]))
            rows.append((conv, turn, "u", said[-1]))
    rows += [(1, None, "u", "> thanks"), (2, 40, "v", None), (2, 41, "v", ""), (1, 50, "u", "\n".join(f"> {prose(k, 30)}" for k in range(400)))]
    key = lambda r: tuple(str(x) for x in r)
    d = folder(conversations=(rows, "conv_id long, turn long, role string, text string"))
    got = quotes.op9_quote_links(spark, d).collect()
    assert sorted(((r.conv_id, r.turn, r.parent, r.thread, r.depth, r.n_quoted, r.max_level, r.text) for r in got), key=key) == sorted(brute_quotes(rows), key=key)
    assert sum(r.parent is not None for r in got) > 20 and max(r.depth for r in got) > 2
    order = [(r.conv_id or 0, r.thread if r.thread is not None else -1, r.turn if r.turn is not None else -1) for r in got]
    assert order == sorted(order)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{d}/conversations.parquet/*.parquet'")
    names = ("conv_id", "turn", "parent", "thread", "depth", "n_quoted", "max_level", "text")
    sql = [tuple(None if x != x else x for x in r) for r in con.sql(f"select {', '.join(names)} from ({quotes.ORACLE})").fetchall()]
    assert sorted(sql, key=key) == sorted((tuple(r[n] for n in names) for r in got), key=key)


def test_repeated_messages_are_each_returned(spark):
    rows = [(1, 1, "a b c"), (1, 1, "d e f"), (1, 2, "> d e f"), (1, 2, "> d e f")]
    got = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    assert sorted((r.turn, r.parent) for r in got if r.turn == 2) == [(2, 1), (2, 1)] and len(got) == 4
