"""MinHash near-dedup against all pairs of shingle sets."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tests.llm.conftest import DOCS, prose

from reciprospark.llm import minhash, near


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """Rows of the result by all pairs: doc_id, n_shingles, component_id, kept."""
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[find(k)] = min(ids.get(find(k), r[0]), r[0])
    return sorted(((r[0], len(sets[k]), ids.get(find(k)), r[0] == ids.get(find(k))) for k, r in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def changed(text, n, seed):
    """n words, far apart, replaced."""
    words, rng = text.split(), random.Random(seed)
    for k in rng.sample(range(len(words) // 6), n):
        words[6 * k] = f"new{seed}x{k}"
    return " ".join(words)


def test_signatures_agree_as_the_sets_do():
    rng = np.random.default_rng(1)
    for size, both in ((400, 360), (40, 36), (8, 7), (1, 1)):
        agree = []
        for _ in range(40):
            all_ = np.unique(rng.integers(0, 1 << 63, 2 * size - both, dtype=np.uint64) * np.uint64(2))
            a, b = np.sort(all_[:size]), np.sort(np.concatenate([all_[: both], all_[size:]]))
            a, b = (np.sort(x) for x in (all_[rng.permutation(len(all_))][:size], all_)) if size == 8 else (a, b)
            agree.append(np.mean(minhash.signature(a, 96) == minhash.signature(b, 96)) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(agree)) < 0.04


@pytest.mark.parametrize("tile", [minhash.TILE, 7])
def test_against_all_pairs(spark, odd_docs, tile):
    base = prose(1, 240)
    rows = [(k, t, lang, s, 1) for k, t, lang, s, _ in odd_docs]
    rows += [(100 + k, prose(50 + k // 4, 150 + k // 4), "en", "s", 1) for k in range(40)]  # copies
    rows += [(200 + k, changed(prose(50 + k, 120), 1 + k % 5, k), "en", "s", 1) for k in range(40)]  # near the bound
    rows += [(300 + k, changed(base, 1 + k % 9, k), "en", "s", 1) for k in range(90)]  # one group, many of whose pairs are no links
    rows += [(400 + k, prose(9, 160) + " " + prose(900 + k // 2, 60 + k % 3), "en", "s", 1) for k in range(60)]  # share much, few link
    rows += [(600 + k, " ".join(["a b c d e f g h i j k".split()[x] for x in range(5 + k % 6)]), "en", "s", 1) for k in range(20)]
    rows += [(700, "One TWO", "en", "s", 1), (699, "one two", "en", "s", 1), (701, "one  two ", "en", "s", 1), (800, "Ä b c d e f", "en", "s", 1), (801, "ä b c d e f", "en", "s", 1)]
    docs = spark.createDataFrame([(*r, 1, "mine", 2) for r in rows], DOCS + ", fp int, keys string, id int").repartition(3)
    got = minhash.clustered(docs, tile=tile)
    assert {"lang", "source", "fp", "keys", "id"} <= {*got.columns} and {r.id for r in got.collect()} == {2}
    assert found(got) == plain(rows)


def test_blocks_compare_all_pairs_of_different_components(spark):
    bins = minhash.SECOND[0] * minhash.SECOND[1]
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, bins, dtype=np.uint8)
    rows = []
    for k in range(60):
        sig = base.copy()
        sig[: int(rng.integers(0, 400))] ^= 1 + k
        rows.append((k % 2, 79, k, int(rng.integers(0, 20)), bytearray(sig.tobytes())))  # the first 40 bands differ in all of these
    bands = lambda x, y: [n for n in range(80) if x[10 * n : 10 * n + 10] == y[10 * n : 10 * n + 10]]
    agree = {(a[2], b[2]): sum(x == y for x, y in zip(a[4], b[4], strict=True)) for a in rows for b in rows if a[0] == b[0] and a[2] < b[2] and a[3] != b[3]}
    for band in (0, 39, 79):
        first = {p: n for p, n in agree.items() if n >= 600 and not [x for x in bands(*(rows[k][4] for k in p)) if x < band]}
        table = spark.createDataFrame([(r[0], band, *r[2:]) for r in rows], "key long, band long, fp long, root long, sig binary")
        for tile in (4, 1000):
            got = [tuple(r) for r in minhash.compared(table, 600, tile).collect()]
            assert len(got) == len({*got}) and {*got} == first.keys()
            one = [tuple(r) for r in minhash.compared(table, 600, tile, nearest=True).collect()]
            assert {*one} <= first.keys() and {p[0] for p in one if tile == 1000} == {p[0] for p in first if tile == 1000}
            assert tile != 1000 or all(first[p] == max(n for q, n in first.items() if q[0] == p[0]) for p in one)


def test_rows_that_are_kept_and_the_query(spark, folder, odd_docs):
    rows = [(k, t, "en", None, 1) for k, t, *_ in odd_docs] + [(20 + k, changed(prose(7, 200), k % 3, k), "fr", "s", 2) for k in range(12)]
    got = minhash.deduplicated(spark.createDataFrame(rows, DOCS))
    kept = {k for k, _, _, own in plain(rows) if own}
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"] and sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r[0]) for r in rows if r[0] in kept or r[0] is None)
    assert found(minhash.op12_minhash(spark, folder(documents=(rows, DOCS)))) == plain(rows)
    assert minhash.op12_minhash(spark, folder(documents=([], DOCS))).count() == 0
    only_empty = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert found(minhash.clustered(only_empty)) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]
    assert near.shingles(b"", 5).size == 0
