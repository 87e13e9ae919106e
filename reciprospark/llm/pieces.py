"""Token counts by a longest-match automaton: greedy word-piece lengths without building pieces.

The vocabulary is held in a trie with two kinds of roots: one for the piece that begins a word and one for the pieces
that go on. A node that cannot take the next byte follows its failure link: to the node reached from the inner root by
what is left of the path after popping the longest pieces that cover its front. The number of popped pieces is stored
with the link, so each byte is read once and a word of n bytes costs O(n): its count is the sum of the popped counts on
the way. Each single byte is a piece, so every word has pieces.

A worker remembers the counts of a bounded number of distinct words. Cases: null and empty texts have no tokens; very
long words take linear time; repeated documents are each counted; other columns are passed through; an empty table gives
an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from reciprospark.llm.bpe import byte_alphabet
from reciprospark.llm.common import record, slices, table

#: Distinct words that a worker remembers the counts of; beyond it starts anew.
REMEMBERED = 100_000


class Automaton:
    """starts: pieces that begin a word; inner: pieces that go on (every single byte must be a piece of both)."""

    def __init__(self, starts: set[bytes], inner: set[bytes]) -> None:
        self.next: list[dict[int, int]] = [{}, {}]  # node 0: word begin, node 1: going on
        self.piece = [False, False]
        for root, pieces in ((0, starts), (1, inner)):
            for p in pieces:
                k = root
                for b in p:
                    if (to := self.next[k].get(b)) is None:
                        to = self.next[k][b] = len(self.next)
                        self.next.append({})
                        self.piece.append(False)
                    k = to
                self.piece[k] = True
        missing = [b for b in range(256) for root in (0, 1) if b not in self.next[root] or not self.piece[self.next[root][b]]]
        if missing:
            raise ValueError(f"{len(missing)} single bytes are no pieces")
        n = len(self.next)
        self.fail, self.popped = [1] * n, [0] * n
        self.fail[1] = 1
        order = [(0, -1, 0), (1, -1, 0)]
        for k, parent, byte in order:  # in order of depth: the list grows as it is read
            order += [(to, k, b) for b, to in self.next[k].items()]
            if parent < 0:
                continue
            if self.piece[k]:  # the whole path is one piece
                self.fail[k], self.popped[k] = 1, 1
            else:
                at, count = self.fail[parent], self.popped[parent]
                while byte not in self.next[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                self.fail[k], self.popped[k] = self.next[at][byte], count

    def count(self, word: bytes) -> int:
        """Pieces of a word."""
        if not word:
            return 0
        after, fail, popped = self.next, self.fail, self.popped
        at = total = 0
        for b in word:
            while (to := after[at].get(b)) is None:
                total += popped[at]
                at = fail[at]
            at = to
        while at != 1:
            total += popped[at]
            at = fail[at]
        return total


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """From a byte-level vocabulary: tokens with a leading blank begin words, the others go on; single bytes do both."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    tokens = [bytes(byte[c] for c in t) for t in vocab if all(c in byte for c in t)]
    single = {bytes([b]) for b in range(256)}
    return Automaton({t[1:] for t in tokens if t[:1] == b" " and len(t) > 1} | single, {t for t in tokens if t[:1] != b" "} | single)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with n_words and n_tokens (long) in place of text. Words are runs of what is not ASCII white space."""
    kept = docs.select(*[c for c in docs.columns if c not in ("n_words", "n_tokens")])
    own = [c for c in kept.columns if c != "text"]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"] + ["n_words long", "n_tokens long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = automaton(path or default_path()), {}
        for batch, texts in slices(batches):
            words, tokens = [], []
            for t in texts:
                found = t.split()
                for w in set(found).difference(known):
                    known[w] = machine.count(w)
                words.append(len(found))
                tokens.append(sum(map(known.__getitem__, found)))
                if len(known) > REMEMBERED:
                    known.clear()
            yield record(pa.schema([*[batch.schema.field(c) for c in own], pa.field("n_words", pa.int64()), pa.field("n_tokens", pa.int64())]), [*[batch.column(c) for c in own], words, tokens])

    return kept.mapInArrow(run, fields)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))
