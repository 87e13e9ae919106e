from __future__ import annotations

import hashlib
import json
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import DOCS, prose

from reciprospark.llm import bpe, common, decontaminate, lm, pieces, rules, seating, simhash, statistics, toxicity

BENCH = "item_id long, text string"


def test_slices_cover_all_texts(spark):
    import pyarrow as pa

    batch = pa.record_batch({"text": pa.array(["a" * 3_000_000, None, "", "b" * 9_000_000, "c", "é"]), "n": pa.array(range(6))})
    got = [(b.column("n").to_pylist(), [len(t) for t in texts]) for b, texts in common.slices([batch.slice(1), batch.slice(0, 0)])]
    assert [n for ns, _ in got for n in ns] == [1, 2, 3, 4, 5] and [n for _, ns in got for n in ns] == [0, 0, 9_000_000, 1, 2]


def test_packing():
    for a in (np.arange(1000, dtype=np.int64), np.zeros(0, np.uint32), np.array([1.5, -2.0])):
        assert (common.unpacked(common.packed(a), a.dtype) == a).all()


# decontamination


def brute_hits(text, items):
    words = decontaminate.words_of((text or "").encode())
    hit, found = set(), set()
    for item, t in items:
        own = decontaminate.words_of((t or "").encode())
        n = min(10, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[k : k + n]:
                    hit |= set(range(p, p + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, odd_docs):
    rng = random.Random(5)
    items = [(k, prose(100 + k, rng.choice([0, 1, 4, 10, 25]))) for k in range(12)] + [(3, prose(500, 12)), (77, None), (78, "One-two; three")]
    docs = [*odd_docs]
    for k in range(40):
        parts = [prose(1000 + k, 30)]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(items)[1] or ""
            parts.append(words.upper().replace(" ", rng.choice([" ", ", ", "\n"])))
        docs.append((100 + k, " ".join(parts), "en", "s", 1))
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)
    want = sorted((r[0] or -1, *brute_hits(r[1], items)) for r in docs if len(r[1] or "") < 90_000)
    for block in (10**6, 20):  # one block of items, and many
        got = decontaminate.hits(d, b, block_words=block).where("coalesce(length(text), 0) < 90000").collect()
        assert sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"])) for r in got) == want


def test_removal(spark):
    item = prose(9, 12)
    docs = spark.createDataFrame([(1, f"keep this, {item.upper()}; and that", "en", "s", 1), (2, "clean text", "en", "s", 1)], DOCS)
    bench = spark.createDataFrame([(1, item)], BENCH)
    got = {r.doc_id: r.text for r in decontaminate.remove(docs, bench).collect()}
    assert got == {1: "keep this, ; and that", 2: "clean text"}
    assert [r.doc_id for r in decontaminate.remove(docs, bench, "documents").collect()] == [2]
    clash = docs.withColumns({"items": F.lit("mine"), "n_words": F.lit(13), "spans": F.lit(None).cast("string"), "N_HIT": F.lit(1)})
    for mode, block in (("spans", 1), ("spans", 10**6), ("documents", 1)):
        out = decontaminate.remove(clash, bench, mode, block_words=block)
        assert out.columns == clash.columns and out.collect() and all(r["items"] == "mine" and r.n_words == 13 and r.spans is None for r in out.collect())
    nameless = decontaminate.hits(docs, bench.select(F.lit(None).cast("long").alias("item_id"), "text")).collect()
    assert any(r.n_hit for r in nameless) and all(r["items"] == [] for r in nameless)
    assert decontaminate.remove(docs, bench.limit(0)).count() == 2 and decontaminate.hits(docs.limit(0), bench).count() == 0
    with pytest.raises(ValueError, match="mode"):
        decontaminate.remove(docs, bench, "other")


# byte pairs


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(library):
    own = bpe.Codec(bpe.default_path())
    rng = random.Random(2)
    texts = ["", " ", "Hello World's don't 123", "a<|endoftext|>b<|endoftext", "ΣΑΣ", "é e\u0301 Å", "aaaa" * 300, "日本語 текст", "x" * 5000, "\x00\x1c\x85"]
    texts += ["".join(rng.choice("abcdeé '#.1\n\u0301ß") for _ in range(60)) for _ in range(300)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.packed(t)[1].decode() == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_merges_come_in_order_of_rank():
    ranks = {("a", "b"): 1, ("b", "a"): 0, ("ba", "ba"): 2}
    assert bpe.merge_ranks(list("ababa"), ranks) == ["a", "baba"] and bpe.merge_ranks(["a"], ranks) == ["a"]
    rng = random.Random(3)
    for _ in range(300):
        ranks = {p: k for k, p in enumerate({("".join(rng.choices("ab", k=rng.randint(1, 2))), "".join(rng.choices("ab", k=rng.randint(1, 2)))) for _ in range(6)})}
        s = list("".join(rng.choices("ab", k=rng.randint(1, 12))))
        want = list(s)
        while True:
            best = min(((ranks[p], k) for k, p in enumerate(zip(want, want[1:], strict=False)) if p in ranks), default=None)
            if best is None:
                break
            want[best[1] : best[1] + 2] = ["".join(want[best[1] : best[1] + 2])]
        assert bpe.merge_ranks(s, ranks) == want


def test_bpe_rows(spark, odd_docs, library):
    got = bpe.digests(spark.createDataFrame(odd_docs, DOCS).withColumn("n_tokens", F.lit("old"))).collect()
    assert len(got) == len(odd_docs)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    r = bpe.encoded(spark.createDataFrame(odd_docs, DOCS)).where("doc_id = 4").first()
    assert list(r.ids) == library.encode("One two THREE", add_special_tokens=False).ids and r.decoded == library.decode(list(r.ids), skip_special_tokens=False)


# word pieces


def test_pieces_against_greedy_search():
    rng, single = random.Random(4), {bytes([b]) for b in range(256)}
    for _ in range(60):
        some = lambda: {bytes(rng.choices(b"ab", k=rng.randint(1, 6))) for _ in range(6)} | single
        starts, inner = some(), some()
        machine = pieces.Automaton(starts, inner)
        for _ in range(30):
            word, at, n = bytes(rng.choices(b"ab", k=rng.randint(1, 30))), 0, 0
            while at < len(word):
                at += max(k for k in range(1, len(word) - at + 1) if word[at : at + k] in (inner if at else starts))
                n += 1
            assert machine.count(word) == n
    with pytest.raises(ValueError, match="bytes"):
        pieces.Automaton({b"a"}, single)


def test_piece_rows(spark, odd_docs):
    got = {(r.doc_id, r.n_words, r.n_tokens > 0) for r in pieces.token_counts(spark.createDataFrame(odd_docs, DOCS)).collect()}
    assert {(1, 0, False), (2, 0, False), (4, 3, True), (5, 0, False), (6, 1, True)} <= got


# statistics


def brute_counts(text):
    words = (text or "").encode().split()
    seen = {}
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k : k + 3]), []).append(k)
    repeat = {k + i for v in seen.values() if len(v) > 1 for k in v for i in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat)


def test_counts_against_brute_force(odd_docs):
    rng = random.Random(6)
    texts = [t for _, t, *_ in odd_docs if len(t or "") < 90_000] + ["\n".join(" ".join(rng.choice(["a", "b", "é#", "c|"]) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 9))) for _ in range(100)]
    got = statistics.counted([(t or "").encode() for t in texts])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(int(got[n][k]) for n in names) for k in range(len(texts))] == [brute_counts(t) for t in texts]


def test_token_counts_of_rows_against_greedy_search(spark, odd_docs):
    """Every row of the query's table, with the pieces of the file itself."""
    with open(pieces.default_path(), encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    tokens = {bytes(byte[c] for c in t) for t in vocab if all(c in byte for c in t)} | {bytes([b]) for b in range(256)}
    longest = max(map(len, tokens))

    def count(word):
        n, at = 0, 0
        while at < len(word):
            for size in range(min(longest, len(word) - at), 0, -1):
                piece = word[at : at + size]
                if (b" " + piece in tokens or size == 1) if at == 0 else (piece in tokens and piece[:1] != b" "):
                    break
            n, at = n + 1, at + size
        return n

    rows = [r for r in odd_docs if len(r[1] or "") < 90_000] + [(70 + k, f"{prose(k, 30)} Überraschung naïve 日本語 don't #{k}$$", "en", "s", 1) for k in range(5)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("mine"))
    got = sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in pieces.token_counts(docs).collect())
    assert got == sorted((r[0] or -1, len((r[1] or "").encode().split()), sum(map(count, (r[1] or "").encode().split()))) for r in rows)


CLASH = ("score", "n_votes", "n_words", "n_tokens", "fp", "sig", "h", "held", "ids", "word", "bits", "y", "__times")


def test_operators_pass_columns_with_clashing_names(spark, odd_docs):
    docs = spark.createDataFrame(odd_docs, DOCS).withColumns({c: F.lit("mine") for c in CLASH})
    made = {
        "pieces": (pieces.token_counts(docs), {"n_words", "n_tokens"}),
        "bpe": (bpe.encoded(docs), {"ids"}),
        "toxicity": (toxicity.scored(docs, toxicity.Model([], np.zeros(len(toxicity.PATTERNS) + 3))), {"score", "n_votes"}),
        "rules": (rules.scored(docs, rules.Ensemble(0.0, ())), {"score", *statistics.COUNTS}),
        "simhash": (simhash.fingerprints(docs), {"fp"}),
    }
    for name, (out, replaced) in made.items():
        kept = [c for c in CLASH if c in out.columns and c not in replaced]
        rows = out.collect()
        assert len(rows) == len(odd_docs) and len(kept) >= len(CLASH) - len(replaced) and all(r[c] == "mine" for r in rows for c in kept), name
    assert simhash.deduplicated(docs, 5, 0.8).columns == docs.columns
    asked = docs.select("doc_id", "text", *[c for c in CLASH if c != "held"])
    assert lm.scored(asked, F.lit(False)).count() == len(odd_docs)


# fingerprints


def brute_components(prints):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(p, seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_bit_by_bit():
    texts = ["", " ", "One", "one TWO", "a b c", "É b c d", "a b c a b c a b c", *[prose(k, 5 + 40 * k) for k in range(8)]]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("long", [4, 1024])
def test_links_against_all_pairs(spark, monkeypatch, long):
    monkeypatch.setattr(simhash, "LONG", long)  # 4: nearly every list is split
    rng = random.Random(7)
    prints = {0, 1, 3}
    for _ in range(40):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(rng.choice([0, 3, 30])):
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    low = rng.getrandbits(48) << 16
    prints |= {low | k for k in rng.sample(range(1 << 16), 400)}  # one long list
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    back = {s: k for k, s in enumerate(signed)}
    assert all((prints[back[r.a]] ^ prints[back[r.b]]).bit_count() <= 2 for r in edges.collect())
    found = {r.fp: r.root for r in simhash.components(edges).collect()}
    want = brute_components(prints)
    groups = {}
    for k, w in enumerate(want):
        groups.setdefault(w, []).append(signed[k])
    assert all(found.get(x, x) == min(g) for g in groups.values() for x in g)


def test_every_two_positions_are_left_out_together():
    assert all(any({a, b} <= set(out) for out in simhash.LEFT_OUT) for a in range(8) for b in range(a))
    assert all(len(out) == 8 - simhash.LISTED for out in simhash.LEFT_OUT)


def test_deduplication_keeps_other_columns(spark, odd_docs):
    text = prose(11, 60)
    docs = spark.createDataFrame([*odd_docs, (50, text, "en", "s", 1), (51, text, "en", "s", 1)], DOCS).withColumns({c: F.lit("mine") for c in ("root", "fp", "shared", "__id", "word", "bits", "h", "component_id")})
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns and sorted(r.doc_id or -1 for r in got.collect()) == [-1, 1, 3, 4, 6, 7, 50] and all(r.root == "mine" for r in got.collect())


def test_deduplication(spark, odd_docs):
    text = prose(11, 400)
    rows = [*odd_docs, (50, text, "en", "s", 1), (51, text.upper(), "en", "s", 1), (52, text, "en", "s", 1), (50, text, "en", "s", 1), (60, prose(12, 400), "en", "s", 1), (None, prose(13, 50), "en", "s", 1), (None, prose(14, 50), "en", "s", 1)]
    got = simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, -1, -1, 1, 3, 4, 6, 7, 50, 60]
    marked = {(r.doc_id, r.component_id) for r in simhash.clustered(spark.createDataFrame(rows, DOCS).select("doc_id", "text")).collect()}
    assert {(51, 50), (52, 50), (2, 1), (5, 1), (60, 60)} <= marked
    assert simhash.deduplicated(spark.createDataFrame([], DOCS)).count() == 0


# seating


def test_tables_follow_their_conditional():
    rng = np.random.default_rng(0)
    for n, q, d in ((3, 0.5, 0.7), (20, 30.0, 0.8), (40, 2.0, 0.7)):
        s = np.zeros((n + 1, n + 2))
        s[1, 1] = 1
        for c in range(1, n):
            for t in range(1, n + 1):
                s[c + 1, t + 1] += s[c, t]
                s[c + 1, t] += s[c, t] * (c - d * t)
        p = s[n, 1 : n + 1] * q ** np.arange(1, n + 1)
        want = (p / p.sum()) @ np.arange(1, n + 1)
        assert seating.tables(np.full(20000, n), np.full(20000, q), d, rng).mean() == pytest.approx(want, rel=0.02)
    a, b = seating._few(256, np.full(5000, 200.0), 0.7, rng), seating._many(np.full(5000, 256.0), np.full(5000, 200.0), 0.7, rng)
    assert a.mean() == pytest.approx(b.mean(), rel=0.01) and a.std() == pytest.approx(b.std(), rel=0.1)
    assert seating.tables(np.array([0, 1, 1_000_000]), np.ones(3), 0.5, rng)[:2].tolist() == [0, 1]


def test_stirling_numbers_by_contour():
    for d in (0.1, 0.5, 0.8, 0.95):
        table = seating.log_stirling(d)
        for n in (300, 1000):
            t = np.unique(np.concatenate([np.arange(1, 25), np.geomspace(1, n, 40).astype(int), n - np.arange(5)]))
            got = seating.log_coefficient(np.full(len(t), n), t, d) + math.lgamma(n + 1) - np.array([math.lgamma(x + 1) for x in t])
            assert got == pytest.approx(table[n, t], abs=1e-3) and np.median(np.abs(got - table[n, t])) < 1e-8


def test_many_customers_follow_their_conditional():
    """Draws by rejection against the whole distribution, by chi-square."""
    rng = np.random.default_rng(1)
    for n, q, d in ((300, 0.05, 0.7), (1000, 60.0, 0.8), (600, 900.0, 0.9), (400, 3.0, 0.3)):
        w = seating.log_stirling(d)[n, 1 : n + 1] + np.arange(1, n + 1) * math.log(q)
        w = np.exp(w - w.max())
        want = 8000 * w / w.sum()
        got = np.bincount(seating._many(np.full(8000, float(n)), np.full(8000, q), d, rng), minlength=n + 1)[1:]
        often = want >= 5
        assert (np.square(got - want)[often] / want[often]).sum() < often.sum() + 5 * math.sqrt(2 * often.sum()) + 3 and got[~often].sum() < 200


def test_clashing_names_of_url_filter_and_quotations(spark):
    from reciprospark.llm import quotes, urls

    pages = [(k, f"http://{h}/{p}/page{k}", k, k, k) for k, (h, p) in enumerate([("a.net", "x"), ("example.net", "en"), ("example.com", "de"), ("b.org", "fr"), ("other.com", "q")] * 12)] + [(99, None, 1, 1, 1)]
    got = urls.judged(spark.createDataFrame(pages, "page_id long, url string, __key int, KEY int, Score int"))
    assert got.columns == ["page_id", "url", "__key", "KEY", "host", "path", "rule", "score", "verdict"]
    plain = {r.page_id: (r.host, r.rule, r.score, r.verdict) for r in urls.judged(spark.createDataFrame([p[:2] for p in pages], "page_id long, url string")).collect()}
    assert {r.page_id: (r.host, r.rule, r.score, r.verdict) for r in got.collect()} == plain and {r["__key"] for r in got.collect()} == {*range(60)}
    rows = [(1, 0, "the first line\nand more", 7, 8), (1, 1, "> the first line\nyes", 7, 8)]
    out = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string, __conv int, __turn int"))
    assert {(r.turn, r.parent, r["__conv"], r["__turn"]) for r in out.collect()} == {(0, None, 7, 8), (1, 0, 7, 8)}


def test_ratios_that_are_not_broadcast_give_the_same_scores(spark):
    from reciprospark.llm import urls

    keys = spark.createDataFrame([(f"h{k % 7}.net/p{k}/q", "allow" if k % 3 else "block" if k % 2 else None) for k in range(60)], "key string, verdict string")
    one, other = ({r.key: r.score for r in urls.scores(keys, n).collect()} for n in (0, urls.BROADCAST))
    assert one == pytest.approx(other) and len(one) == 60


def test_the_simhash_query_against_all_pairs(spark, folder, odd_docs):
    def plain(text):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = [r for r in odd_docs if len(r[1] or "") < 200_000] + [(100 + k, prose(k // 3, 90) + (f" extra{k}" if k % 3 == 1 else ""), "en", "s", 1) for k in range(60)] + [(50, prose(4, 90), "fr", None, 1), (51, "  ", "fr", None, 1)]
    prints = [plain(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    ids = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[find(k)] = min(ids.get(find(k), r[0]), r[0])
    want = sorted((str(r[0]), f"{prints[k]:016x}", str(ids.get(find(k)))) for k, r in enumerate(rows))
    got = simhash.op6_simhash(spark, folder(documents=(rows, DOCS))).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want and len(set(ids.values())) < 40
