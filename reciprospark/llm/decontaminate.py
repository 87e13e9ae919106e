"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over token windows.

Words are lower-cased runs of ASCII digits, ASCII letters and characters beyond ASCII. A window is 10 consecutive
words of a test item; an item with fewer words, but some, is one window. A scan looks each window of a text up by a
64-bit hash, verifies it word by word, and marks the words that any occurrence covers.

The test windows are cut into blocks of at most BLOCK_WORDS words (and one item), a bound on what is broadcast. One block is one
narrow pass over the documents. Of several, each is a pass that writes what it has hit only (a digest of the text, its spans and items: what is
hit depends on the text alone); a last pass joins that to the texts that a bitmap of fixed size marks, and merges the spans. So any
number of items is handled, a worker holds one block at a time, and no text is written.

Cases: null and empty texts have no words and are never hit; an item without words has no window; repeated items count
once by their id; an item of null id hits words but is not listed; repeated documents are each reported. ``hits`` replaces
columns of the names that it adds; ``remove`` returns the columns of docs as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import discard, fresh, marked, marks, record, slices, stored, table

WINDOW = 10
#: Words of test items in one broadcast: about 100 MB in a Python worker.
BLOCK_WORDS = 1_000_000
_WORD = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Windows:
    """Windows of test items by length: sorted hashes for a first look, exact word ids to verify, items of each."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            found = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            n = min(size, len(found))
            for k in range(len(found) - n + 1 if n else 0):
                of = self.items.setdefault(tuple(found[k : k + n]), set())
                if item is not None:
                    of.add(item)
        self.hashes = {}
        for n in {len(x) for x in self.items}:
            rows = np.array([x for x in self.items if len(x) == n], dtype=np.int64)
            self.hashes[n] = np.unique(_rolled(rows.ravel(), n)[:: n])

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[set[str]], list[list[tuple[int, int]]]]:
        """For each text its number of words, of hit words, its items, and its spans of words."""
        get = self.ids.get
        parts = [[get(w, -1) for w in words_of(t)] for t in texts]
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(counts + 1)])  # a gap after each text
        flat = np.full(int(starts[-1]), -1, dtype=np.int64)
        for p, s in zip(parts, starts, strict=False):
            flat[s : s + len(p)] = p
        known = np.concatenate([[0], np.cumsum(flat >= 0)])
        cover = np.zeros(len(flat) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in texts]
        for n, hashes in self.hashes.items():
            if len(flat) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            h = _rolled(flat, n)[at]
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for p in at[hashes[k] == h]:
                if (of := self.items.get(tuple(flat[p : p + n].tolist()))) is not None:
                    items[int(np.searchsorted(starts, p, side="right")) - 1] |= of
                    cover[p] += 1
                    cover[p + n] -= 1
        hit = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            k = int(np.searchsorted(starts, a, side="right")) - 1
            spans[k].append((a - int(starts[k]), b - int(starts[k])))
        return counts, total[starts[:-1] + counts] - total[starts[:-1]], items, spans


def _rolled(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each window of n ids."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    x ^= x >> np.uint64(29)
    out = np.zeros(max(0, len(x) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(6364136223846793005) + x[k : k + len(out)]
    return out


def blocks(benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Windows]:
    """Windows of the items, a bounded number of words at a time."""
    held, words = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator(prefetchPartitions=False):
        held.append((None if row.item_id is None else str(row.item_id), row.text.encode()))
        words += len(words_of(held[-1][1]))
        if words >= block_words:
            yield Windows(held, size)
            held, words = [], 0
    if held:
        yield Windows(held, size)


SPANS = "array<struct<first: int, stop: int>>"
ADDED = ("n_words", "n_hit", "items", "spans")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with n_words, n_hit, items (sorted ids) and spans (of words, stop excluded). One narrow pass for each block of test items, and a last one where there are several."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ADDED])
    return _passes(docs, benchmark, dict(zip(ADDED, ADDED, strict=True)), size, block_words, False)


SPAN = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))


def _passes(docs: DataFrame, benchmark: DataFrame, names: dict[str, str], size: int, block_words: int, cut: bool) -> DataFrame:
    """docs with the columns ADDED, which go by names, of all blocks. cut: the spans are cut out of the texts."""
    of = blocks(benchmark, size, block_words)
    windows = next(of, Windows([], size))
    after = next(of, None)
    if after is None:
        return _scanned(docs, windows, names, cut)
    parts = []
    while windows is not None:
        parts.append(stored(_hit_by(docs, windows), "hits"))
        windows, after = after, next(of, None)
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    found = stored(found.groupBy("digest").agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans")), "found")  # a row for each block at most
    discard(*parts)
    digest, flag = (fresh(c, (*docs.columns, *names.values(), "word", "bits")) for c in ("digest", "flag"))
    rows = marked(docs.withColumn(digest, text_digest()), F.xxhash64(digest), stored(marks(found.select(F.xxhash64("digest").alias("key"))), "marks"), flag)
    own = found.select(F.col("digest").alias(digest), F.col("items").alias(names["items"]), F.col("spans").alias(names["spans"]))
    hit = rows.where(F.col(flag)).join(own, digest, "left")
    none = {names["items"]: F.lit(None).cast("array<string>"), names["spans"]: F.lit(None).cast(SPANS)}
    rows = hit.unionByName(rows.where(~F.col(flag)).withColumns(none)).drop(digest, flag)
    return _merged(rows, docs, names, cut)


def text_digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _hit_by(docs: DataFrame, windows: Windows) -> DataFrame:
    """digest, items and spans of the distinct texts of a task that windows hit."""
    held = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("digest", pa.binary()), ("items", pa.list_(pa.string())), ("spans", SPAN)])
        for _, texts in slices(batches):
            _, hit, items, spans = held.value.scan(texts)
            at = np.flatnonzero(hit).tolist()
            yield record(schema, [[hashlib.md5(texts[k]).digest() for k in at], [sorted(items[k]) for k in at], [_rows(spans[k]) for k in at]])

    return docs.select("text").mapInArrow(run, f"digest binary, items array<string>, spans {SPANS}").dropDuplicates(["digest"])


def _rows(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"first": a, "stop": b} for a, b in spans]


def _finished(batch: pa.RecordBatch, kept: list[str], more: list, n: np.ndarray, items: list, spans: list, cut: bool) -> pa.RecordBatch:
    own = {f.name: batch.column(f.name) for f in batch.schema if f.name in kept}
    if cut and any(spans):
        kind = own["text"].type
        own["text"] = pa.array([without(t, x) if x else t for t, x in zip(own["text"].to_pylist(), spans, strict=True)], type=kind)
    schema = pa.schema([*[f for f in batch.schema if f.name in kept], *[pa.field(*x) for x in more]])
    return record(schema, [*own.values(), n, [sum(b - a for a, b in x) for x in spans], [sorted(x) for x in items], [_rows(x) for x in spans]])


def _mapped(rows: DataFrame, docs: DataFrame, names: dict[str, str], run) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    added = ", ".join(f"`{names[c]}` {t}" for c, t in zip(ADDED, ("long", "long", "array<string>", SPANS), strict=True))
    return rows.mapInArrow(run, f"{fields}, {added}")


def _more(names: dict[str, str]) -> list:
    return [(names[c], t) for c, t in zip(ADDED, (pa.int64(), pa.int64(), pa.list_(pa.string()), SPAN), strict=True)]


def _scanned(docs: DataFrame, windows: Windows, names: dict[str, str], cut: bool) -> DataFrame:
    """One scan, of the only block."""
    held, kept, more = docs.sparkSession.sparkContext.broadcast(windows), docs.columns, _more(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            n, _, items, spans = held.value.scan(texts)
            yield _finished(batch, kept, more, n, items, spans, cut)

    return _mapped(docs, docs, names, run)


def _merged(rows: DataFrame, docs: DataFrame, names: dict[str, str], cut: bool) -> DataFrame:
    """What earlier scans have found (items and spans of all blocks, or null), as of one scan."""
    kept, more = docs.columns, _more(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            n = np.array([len(words_of(t)) for t in texts], dtype=np.int64)
            items = [{*(x or ())} for x in batch.column(names["items"]).to_pylist()]
            spans = [merged([(s["first"], s["stop"]) for s in x or ()]) for x in batch.column(names["spans"]).to_pylist()]
            yield _finished(batch, kept, more, n, items, spans, cut)

    return _mapped(rows, docs, names, run)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the given spans of words; what stood between their first and last word goes too."""
    at = [m.span() for m in _RUN.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "spans", size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with the hit spans cut out of their texts (mode "spans") or without the documents hit (mode "documents")."""
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode {mode!r} is neither spans nor documents")
    names = {c: fresh(c, docs.columns) for c in ADDED}
    found = _passes(docs, benchmark, names, size, block_words, mode == "spans")
    return (found if mode == "spans" else found.where(F.col(names["n_hit"]) == 0)).select(*docs.columns)


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, tests = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = hits(docs.select("doc_id", "text"), tests)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(lower_a, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from
    (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_a from documents)),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
g as (select distinct item_id, n, array_to_string(w[k : k + n - 1], ' ') as s from
    (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from b where len(w) > 0)),
sizes as (select distinct n from g),
o as (select r, k, n, array_to_string(w[k : k + n - 1], ' ') as s from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d, sizes where len(w) >= n)),
h as (select r, k, o.n, item_id from o join g on o.s = g.s and o.n = g.n),
c as (select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from h) group by r),
i as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from h group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (r) left join i using (r)
"""
