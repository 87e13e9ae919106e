"""Fill-in-middle against regular expressions, and back again."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from tests.llm.conftest import DOCS

from reciprospark.llm import infill

UNITS = {"line": r"[^\n]*\n|[^\n]+", "run": r"[ \t-\r]+|[^ \t-\r]+", "character": r"(?s)."}
ODD = ["", "\n", "a", "a\n", "\na", "\n\n\n", " a  b\t\nc ", "é日\U0001f600\n x\x85y\n", "<P", "a<P>b", "<<S>", "x<M>", "\x00\n\x0b", " ", "a b"]


def plain_cut(unit, text, key, rate, spm):
    units = re.findall(UNITS[unit], text)
    digest = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(s in text for s in infill.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", list(UNITS))
def test_ranks_are_those_of_regular_expressions(unit):
    scanner, rng = infill.Scanner(unit), random.Random(4)
    for text in [*ODD, *["".join(rng.choice("ab\n \té<P>") for _ in range(rng.randrange(40))) for _ in range(300)]]:
        at, marked = scanner.events(text)
        ranks, units = infill.Ranks(unit, at, len(text)), re.findall(UNITS[unit], text)
        assert marked == any(s in text for s in infill.SENTINELS)
        assert [ranks.end(k) for k in range(ranks.count + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


@pytest.mark.parametrize(("unit", "rate", "spm"), [("line", 100, 50), ("run", 60, 0), ("character", 100, 100)])
def test_against_plain_python_and_back(spark, odd_docs, unit, rate, spm):
    rows = [*odd_docs, *[(1000 + k, t * (k % 3 + 1), "en", "s", 1) for k, t in enumerate(ODD * 4)]]
    docs = spark.createDataFrame([(*r, "mine", 5) for r in rows], DOCS + ", form string, other int")
    got = infill.transformed(docs, unit, rate=rate, spm=spm).withColumn("back", infill.restored(infill.F.col("output"), infill.F.col("form"))).collect()
    want = [(r[0], *plain_cut(unit, r[1] or "", "" if r[0] is None else r[0], rate, spm), r[1] or "", 5) for r in rows]
    key = lambda r: [(x is None, str(x)) for x in r]
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back, r.other) for r in got), key=key) == sorted(want, key=key)
    assert infill.transformed(docs.limit(0), unit).count() == 0


def test_the_query_against_plain_python(spark, folder, odd_docs):
    rows = [*odd_docs, *[(1000 + k, t, "en", "s", 1) for k, t in enumerate(ODD)]]
    got = infill.op13_infill(spark, folder(documents=(rows, DOCS))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, text, *_ in rows:
        n, form, before, middle, out = plain_cut("line", text or "", "" if i is None else i, 100, 50)
        want.append((i, n, form, before, middle, sha(out), sha(text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_what_is_refused(spark):
    for bad in (("line", ("<P>", "<P>", "<M>")), ("line", ("", "<S>", "<M>")), ("word", infill.SENTINELS), ("line", ("<P>", "P", "<M>")), ("line", ("ab", "ba", "c"))):
        with pytest.raises(ValueError):
            infill.Scanner(*bad)
