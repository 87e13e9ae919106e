"""Near copies of the pipeline against all pairs of shingle sets."""

from __future__ import annotations

import random

import numpy as np
from tests.llm.conftest import DOCS, prose

import corpus_pipeline
from reciprospark.llm import near, simhash


def brute(a: str, b: str) -> float:
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def varied(text: str, n: int, seed: int) -> str:
    """n words in a row replaced."""
    words, at = text.split(), random.Random(seed).randrange(20, 150)
    return " ".join([*words[:at], *[f"new{seed}x{k}" for k in range(n)], *words[at + n :]])


def test_the_stage_removes_near_copies(spark):
    base = {100 * k: prose(40 + k, 200) for k in range(30)}
    near_copies = {k + 1: varied(t, 8, k) for k, t in base.items()}
    others = {k + 2: varied(t, 40, k + 7) for k, t in base.items()}
    assert all(brute(base[k - 1], t) >= 0.8 for k, t in near_copies.items()) and all(brute(base[k - 2], t) < 0.8 for k, t in others.items())
    assert any((simhash.fingerprint(base[k - 1].encode()) ^ simhash.fingerprint(t.encode())).bit_count() > simhash.BITS for k, t in near_copies.items())
    rows = [(k, t, "en", "s", len(t)) for k, t in (base | near_copies | others).items()]
    docs = spark.createDataFrame([*rows, (None, None, "en", "s", 0), (9001, "", "en", "s", 0)], DOCS)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == base.keys() | others.keys() | {9001}
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_a_large_group_of_near_copies_is_one_component(spark):
    text = prose(3, 200)
    rows = [(k, varied(text, 1 + k % 4, k), "en", "s", 1) for k in range(400)]
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), "").collect()] == [0]


def test_fingerprints_agree_as_the_sets_do():
    a, b = prose(1, 2000), varied(prose(1, 2000), 100, 5)
    x, y = (near.shingles(t.encode(), 5) for t in (a, b))
    assert near.jaccard(x, y) == brute(a, b)
    agree = np.mean(np.frombuffer(near.fingerprint(x), np.uint8) == np.frombuffer(near.fingerprint(y), np.uint8))
    assert abs(agree - brute(a, b)) < 0.15


def test_lists_dealt_to_blocks_give_the_same_components(spark):
    text = prose(5, 160)
    rows = [(k, varied(text, 1 + k % 7, k)) for k in range(60)] + [(100 + k, varied(prose(6, 160), 30, k % 4)) for k in range(20)] + [(200 + k, prose(300 + k, 50)) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = near.fingerprints(docs, 5).groupBy("fp").agg(simhash.F.min("sig").alias("sig"))
    found = []
    for tile in (near.TILE, 9):
        links = near.links(docs, prints, 5, 0.8, simhash.components, tile)
        found.append({(r.fp, r.root) for r in simhash.components(links).collect()})
    nodes = {near.node(t.lower().split()) for _, t in [(k, t.encode()) for k, t in rows]}
    assert found[0] == found[1] and len(found[0]) > 50 and len(nodes) > len(found[0])


def test_bitmaps_go_by_the_number_of_keys():
    from reciprospark.llm import common

    assert common.bits_for(0) == common.bits_for(1 << 20) == common.MARKS
    assert common.bits_for(1 << 23) == 1 << 27 and common.bits_for(10**12) == common.MOST_MARKS
