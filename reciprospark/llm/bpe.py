"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the positions of a pretoken's symbols; a leaf holds the rank of the pair that starts there
(or NONE), an inner node the least of its two children, so the root yields the lowest rank and, by going left first,
the leftmost pair of that rank. A merge changes at most three leaves, each in logarithmic time. It ends when the root
holds NONE.

The vocabulary file is given by its path; it is read once in each Python worker from ``public_tokenizers`` (installed
with the engine on every machine) or from any other path that all machines have.

Cases: null and empty texts give no ids and empty decoded text; strings of special tokens in a text give their ids;
very long pretokens cost O(n log n); repeated documents are each encoded; other columns are passed through; an empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from reciprospark.llm.common import record, slices, table

NONE = 1 << 62
#: ASCII, Latin letters and general punctuation, for which all versions of Unicode in use agree.
_COMMON = regex.compile("[\\x00-\u024f\u2010-\u2027]*+")
#: Bytes of pretokens and their ids that a worker remembers in each of two generations; when the young one is full, the old one goes.
REMEMBERED_BYTES = 32 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = [""] * 256
    for b in own:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if b not in set(own)):
        out[b] = chr(256 + k)
    return out


def merge_ranks(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the leftmost lowest-rank merge until none is left."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * size)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # linked symbols; n: the end
    symbols = list(symbols)
    for k in range(n - 1):
        tree[size + k] = ranks.get((symbols[k], symbols[k + 1]), NONE)
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b

    def put(k: int, rank: int) -> None:
        k += size
        tree[k] = rank
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a <= b else b
            if tree[k] == low:
                return
            tree[k] = low
            k >>= 1

    while (low := tree[1]) != NONE:
        k = 1
        while k < size:
            k *= 2
            if tree[k] != low:
                k += 1
        k -= size
        right = after[k]
        symbols[k] += symbols[right]
        after[k] = end = after[right]
        put(right, NONE)
        if end < n:
            before[end] = k
            put(k, ranks.get((symbols[k], symbols[end]), NONE))
        else:
            put(k, NONE)
        if (left := before[k]) >= 0:
            put(left, ranks.get((symbols[left], symbols[k]), NONE))
    out, k = [], 0
    while k < n:
        out.append(symbols[k])
        k = after[k]
    return out


class Codec:
    """A byte-level BPE with word ends, as its JSON file describes it: NFC, runs of white space, lower case, one split pattern."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): k for k, m in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.text = {k: t for t, k in self.ids.items()} | {k: t for t, k in self.special.items()}
        self.alphabet = byte_alphabet()
        self.path, self.tables, self.byte = path, None, {}
        self.spaced = {k: f" {t}".encode() for k, t in self.text.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def pretokens(self, text: str) -> list[str]:
        """Normalised and cut. Scripts whose characters differ between versions of Unicode are left to the library's own tables."""
        if _COMMON.fullmatch(text):
            return self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        if self.tables is None:
            from tokenizers import Tokenizer

            self.tables = Tokenizer.from_file(self.path)
            self.byte = {c: b for b, c in enumerate(self.alphabet)}
        cut = self.tables.pre_tokenizer.pre_tokenize_str(self.tables.normalizer.normalize_str(text))
        return [bytes(self.byte[c] for c in word).decode() for word, _ in cut]

    def of_pretoken(self, word: str) -> list[int]:
        symbols = [self.alphabet[b] for b in word.encode()]
        symbols[-1] += self.end
        return [k for s in merge_ranks(symbols, self.ranks) if (k := self.ids.get(s)) is not None]

    def remembered(self, word: str) -> bytes:
        """Packed ids of a pretoken."""
        if (out := self.known.get(word)) is None:
            if (out := self.older.get(word)) is None:
                out = struct.pack(f"<{len(ids := self.of_pretoken(word))}I", *ids)
            self.held += 200 + len(word) + len(out)  # and what Python's objects take
            if self.held > REMEMBERED_BYTES:
                self.older, self.known, self.held = self.known, {}, 0
            self.known[word] = out
        return out

    def packed(self, text: str) -> tuple[bytes, bytes]:
        """The ids of a text as little-endian unsigned 32-bit integers, and its decoded text in UTF-8."""
        found: list[bytes] = []
        for k, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if k % 2:
                found.append(self.special[part].to_bytes(4, "little"))
            else:
                found += map(self.remembered, self.pretokens(part))
        ids = b"".join(found)
        return ids, b"".join(map(self.spaced.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))[1:]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text)[0], dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks: the file names no decoder."""
        return " ".join(self.text[k] for k in ids if k in self.text)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with ids (array<int>) and decoded (string) of column text."""
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    return _mapped(docs.select(*keep), path, [("ids", pa.list_(pa.int32()), "array<int>"), ("decoded", pa.string(), "string")], lambda ids, text: (np.frombuffer(ids, dtype="<i4"), text.decode()))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 of column text."""
    keep = [c for c in docs.columns if c not in ("n_tokens", "ids_sha256", "decoded_sha256")]
    return _mapped(docs.select(*keep), path, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")], lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))


def _mapped(docs: DataFrame, path: str | None, more: list, of) -> DataFrame:
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{n} {s}" for n, _, s in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path or default_path())
        for batch, texts in slices(batches):
            out = [of(*own.packed(t.decode())) for t in texts]
            schema = pa.schema([*batch.schema, *[pa.field(n, t) for n, t, _ in more]])
            yield record(schema, [*batch.columns, *[[x[k] for x in out] for k in range(len(more))]])

    return docs.mapInArrow(run, fields)


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
