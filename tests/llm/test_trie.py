"""Prefix tries of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reciprospark.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Rows of the result, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        path = (*own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h], *own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, leaves, saved = [], {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in children[path]) or 1
        saved[path] = sum(saved[x] for x in children[path]) + ((len(members[path]) - 1) * len(path[-1][1].encode().split()) if path else 0)
        sha = hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()
        out.append((members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(children[path]), leaves[path], saved[path], sha))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=str)


@pytest.fixture
def odd():
    rng = random.Random(2)
    rows = [(k, t, rng.choice(["user", None, "assistant"]), rng.choice(["a b", "", None, "c", "d e\n f"])) for k in range(70) for t in range(rng.randrange(1, 7))]
    rows += [(k, t, "user", f"the same {min(t, 5)} words") for k in range(100, 160) for t in range(8)]  # copies
    rows += [(k, t, "user", f"common {t}" if t < 12 else f"own {k}") for k in range(200, 230) for t in range(14)]  # a long way together
    rows += [(400, t, "user", "long " * 3) for t in range(300)]  # one long conversation
    rows += [(None, 1, "user", "x"), (500, None, None, None), (500, None, "user", "b"), (500, 1, "user", "x" * 50_000), (500, 1, "user", "x" * 50_000), (500, 1, "assistant", "y"), (-5, 1, "user", "a b"), (541, 1, "user", "only")]
    return rows


@pytest.mark.parametrize(("limit", "target"), [(trie.LIMIT, trie.TARGET), (20, 50), (1, 7)])
def test_against_plain_python(spark, odd, limit, target):
    turns = trie.stored(trie.ordered(spark.createDataFrame([(*r, "extra") for r in odd], TURNS + ", node string").repartition(3)))
    got = trie.nodes(trie.rebuilt(turns), turns.where("k = 1").select("conv_id"), limit, target)
    assert found(got) == plain(odd)


def test_the_query_and_conversations_without_turns(spark, folder):
    rows = [(k, t, "user", f"w{k}") for k in range(1, 60) if k not in (20, 40) for t in range(1 if k % 3 else 5)]  # some lose their only turn
    got = found(trie.op11_prefix_trie(spark, folder(conversations=(rows, TURNS))))
    assert got == plain(rows) and got[-1][1] >= 0 and any(r[1] == 0 and r[7] != trie.NO_ONE for r in got)
    only = next(k for k in range(1, 20) if zlib.crc32(str(k).encode()) % 4)
    assert found(trie.op11_prefix_trie(spark, folder(conversations=([(only, 1, "user", "x")], TURNS)))) == [(only, 0, None, 1, 0, 1, 0, hashlib.sha256(str(only).encode()).hexdigest())]
    assert trie.op11_prefix_trie(spark, folder(conversations=([], TURNS))).count() == 0
