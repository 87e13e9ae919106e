"""The pipeline against each operator applied by hand, and against plain Python where that can say it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCS, prose
from tests.llm.test_near import brute, varied

import corpus_pipeline
from reciprospark.llm import bpe, common, outliers, rules
from reciprospark.llm.common import table


@pytest.fixture
def corpus(folder, odd_docs):
    rng = random.Random(1)
    item = prose(777, 14)
    good = [(1000 + k, prose(k, 120) + ".\nNext line " + prose(k + 500, 40), "en" if k % 3 else None, "src", 1) for k in range(120)]
    copies = [(3000 + k, varied(good[k][1], 3, k), "en", "src", 1) for k in range(10)] + [(3100, good[20][1], "en", "src", 1), (3100, good[20][1], "en", "src", 1)]
    leaks = [(4000 + k, f"{prose(50 + k, 100)} {item.upper()}, {prose(90 + k, 30)}", "en", "src", 1) for k in range(5)]
    junk = [(5000 + k, " ".join(w + rng.choice(["###", "$$"]) for w in prose(k, 200).split()), "en", "src", 1) for k in range(20)]
    poor = [(6000 + k, " ".join(w.upper() if j % 2 else w for j, w in enumerate(prose(k + 7000, 150).split())), "en", "src", 1) for k in range(40)]
    docs = [*odd_docs, *good, *copies, *leaks, *junk, *poor]
    labels = [(i, int(i < 5000), 0) for i, *_ in docs if i and i >= 1000]
    bench = [(1, item), (2, None), (None, prose(778, 12))]
    return folder(documents=(docs, DOCS), labels=(labels, "doc_id long, quality int, toxic int"), benchmark=(bench, "item_id long, text string"))


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_stages_against_the_operators_by_hand(spark, corpus):
    docs = table(spark, corpus, "documents")
    first = corpus_pipeline.quality_rules(spark, docs, corpus)
    kept = outliers.op4_outliers(spark, corpus).where("kept").select("doc_id").distinct()
    assert first.columns == docs.columns and rows(first) == rows(docs.join(kept, docs.doc_id.eqNullSafe(kept.doc_id), "left_semi"))
    assert not any(r.doc_id and 5000 <= r.doc_id < 6000 for r in first.collect())

    second = corpus_pipeline.quality_classifier(spark, first, corpus)
    model = rules.learned(first, table(spark, corpus, "labels"), "quality", rules.remainder(F.col("doc_id"), 3) != 1)
    good = {r.doc_id for r in rules.scored(first.select("doc_id", "text"), model).where("score >= 0.5").collect()}
    assert rows(second) == rows(first.where(F.col("doc_id").isin(list(good)))) and any(r.doc_id == 1001 for r in second.collect())

    third = corpus_pipeline.near_duplicates(spark, second, corpus)
    texts = sorted({(r.doc_id, r.text) for r in second.collect()})
    root = list(range(len(texts)))  # the first text that each one reaches
    for a in range(len(texts)):
        for b in range(a):
            if root[a] != root[b] and brute(texts[a][1], texts[b][1]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    assert [r.doc_id for r in third.orderBy("doc_id").collect()] == [t[0] for k, t in enumerate(texts) if root[k] == k]

    fourth = corpus_pipeline.decontamination(spark, third, corpus)
    item = prose(777, 14).upper()
    assert rows(fourth.select("doc_id", "text", "n_chars")) == sorted((str(r.doc_id), r.text.replace(item, ""), str(len(r.text.replace(item, "")))) for r in third.collect())

    fifth = corpus_pipeline.encoding(spark, fourth, corpus)
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    assert {r.doc_id: r.n_tokens for r in fifth.collect()} == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in fourth.collect()}
    assert rows(corpus_pipeline.run(spark, corpus)) == rows(fifth)


def test_stages_keep_columns_that_clash(spark, corpus):
    names = ("kept", "score", "items", "n_words", "root", "fp", "x0", "distance", "_held")
    docs = table(spark, corpus, "documents").where("doc_id >= 1000 or doc_id is null").withColumns({c: F.lit("mine") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.columns == docs.columns and {tuple(r[c] for c in names) for r in out.collect()} == {("mine",) * len(names)}


def test_a_run_leaves_the_table_before_its_last_stage_only(spark, corpus):
    since = common.stored_so_far()
    corpus_pipeline.run(spark, corpus).count()
    assert [p.rsplit("-", 1)[1] for p in common._STORED[since:]] == ["decontamination"]


def test_empty_tables(spark, folder):
    d = folder(documents=([], DOCS), labels=([], "doc_id long, quality int, toxic int"), benchmark=([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, d).count() == 0
