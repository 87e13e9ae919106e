"""SimHash near-duplicates: an inverted index of byte positions with count filtering.

A fingerprint has 64 bits over the XXH64 (seed 42) of a text's 3-word shingles, repeats included. Two fingerprints of at
most BITS = 2 differing bits agree in at least SHARED = 8 - BITS = 6 of their 8 positional bytes.

The index lists each distinct fingerprint by positional bytes. A list of one byte would hold a 256th of all fingerprints and tally
a number of pairs that grows with the square of the input, so a list's key is LISTED = 5 positional bytes. LEFT_OUT holds
the positions that each of the 11 keys leaves out: any two positions are left out together by one of them, so two fingerprints
that differ in two bytes at most meet in a list. Within a list the shared positional bytes of each pair are tallied over all
8 positions, pairs under the minimum of 6 are passed over, and the rest are verified bit by bit. A list of over LONG
fingerprints is hot and is split: it is listed again by each of the three bytes left out, one of which a pair with the
minimum shares; what is long even then is verified by looking up the few fingerprints within BITS bits of each. No pair is lost in
either way. Only distinct fingerprints are listed, so thousands of copies are one entry; a union-find keeps a
spanning set of a list's links.

Components of links are found by repeated large-star and small-star steps on distinct fingerprints, each written to the
shared folder. Nothing of all documents comes to the driver but counts.

Cases: null and empty texts have fingerprint zero, linked like any other; fewer than 3 words are one shingle; repeated
rows and ids are each reported; a null id is never a component's id unless all ids of the component are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reciprospark.llm import near
from reciprospark.llm.common import discard, fresh, marked, marks, record, slices, stored, table

SEED, WIDTH, BITS, LISTED, LONG = 42, 3, 2, 5, 1024
SHARED = 8 - BITS
LEFT_OUT = ((0, 1, 2), (0, 1, 3), (0, 2, 4), (0, 3, 5), (0, 6, 7), (1, 4, 5), (1, 6, 7), (2, 3, 6), (2, 5, 7), (3, 4, 7), (4, 5, 6))


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(ends))
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with fp (bigint: the 64 bits) in place of text."""
    kept = docs.select(*[c for c in docs.columns if c != "fp"])
    own = [c for c in kept.columns if c != "text"]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text"] + ["fp long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            fp = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield record(pa.schema([*[batch.schema.field(c) for c in own], pa.field("fp", pa.int64())]), [*[batch.column(c) for c in own], fp])

    return kept.mapInArrow(run, fields)


def listed(prints: DataFrame) -> DataFrame:
    """The index: key (a choice of positions and their bytes) and fp. Column expressions only."""
    masks = [sum(0xFF << (8 * p) for p in range(8) if p not in out) for out in LEFT_OUT]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(k).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for k, m in enumerate(signed)])
    return prints.select("fp", F.explode(keys).alias("key"))


def _within(positions: tuple[int, ...]) -> np.ndarray:
    """What the bytes at these positions can be XORed with to change 1 to BITS bits."""
    bits = [1 << (8 * p + b) for p in positions for b in range(8)]
    return np.array([sum(x) for n in range(1, BITS + 1) for x in combinations(bits, n)], dtype=np.uint64)


def _links_of(fps: np.ndarray, left_out: tuple[int, ...]) -> Iterator[tuple[int, int]]:
    """Pairs of one list's fingerprints that share the minimum of bytes and differ by at most BITS bits; the bytes beside left_out are equal."""
    if len(fps) <= LONG:
        for k in range(len(fps) - 1):
            x = fps[k + 1 :] ^ fps[k]
            counted = np.flatnonzero((x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= SHARED)
            for j in counted[np.bitwise_count(x[counted]) <= BITS].tolist():
                yield int(fps[k]), int(fps[k + 1 + j])
    elif 8 - len(left_out) < SHARED:
        for p in left_out:
            byte = (fps >> np.uint64(8 * p)) & np.uint64(0xFF)
            order = np.argsort(byte, kind="stable")
            for part in np.split(fps[order], np.flatnonzero(np.diff(byte[order])) + 1):
                yield from _links_of(part, tuple(x for x in left_out if x != p))
    else:
        fps = np.sort(fps)
        for change in _within(left_out):
            other = fps ^ change
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            for k in np.flatnonzero((fps[at] == other) & (fps < other)).tolist():
                yield int(fps[k]), int(other[k])


def _spanning(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs that connect what earlier ones do not."""
    root: dict[int, int] = {}

    def find(k: int) -> int:
        while (up := root.setdefault(k, k)) != k:
            root[k] = root[up]
            k = up
        return k

    out = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough of them to connect all that link. prints: distinct fp."""
    lists = listed(prints).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held = (np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64))  # a list that the next batch may continue
        for batch in batches:
            key = batch.column("key")
            more = (key.field("choice").to_numpy(), key.field("bytes").to_numpy(), batch.column("fp").to_numpy())
            held = tuple(np.concatenate(x) for x in zip(held, more, strict=True))
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            if len(new):
                yield record(schema, _pairs(held, new, int(new[-1])))
                held = tuple(x[new[-1] :] for x in held)
        if len(held[0]):
            yield record(schema, _pairs(held, np.zeros(0, np.int64), len(held[0])))

    return lists.mapInArrow(run, "a long, b long").distinct()


def _pairs(rows: tuple[np.ndarray, ...], new: np.ndarray, stop: int) -> list[list[int]]:
    starts = np.concatenate([[0], new[new < stop]])
    ends = np.concatenate([starts[1:], [stop]])
    found = []
    for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        found += _spanning(_links_of(rows[2][s:e].view(np.uint64), LEFT_OUT[int(rows[0][s])]))
    return list(np.array(found, dtype=np.uint64).reshape(-1, 2).T.astype(np.int64))


def components(links: DataFrame) -> DataFrame:
    """The smallest node (root) that each node with a link reaches. links: a, b. Large-star and small-star in turn."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        # large star: all larger neighbours of a node go to the smallest of its neighbours and itself
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        after = stored(small.where("a <> b").distinct(), "small")
        same = edges.join(after, ["a", "b"], "left_anti").isEmpty() and after.join(edges, ["a", "b"], "left_anti").isEmpty()
        discard(edges, large)
        edges = after
        if same:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def clustered(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) without text, with fp, root (the component's smallest fingerprint, as bigint) and component_id."""
    prints = stored(fingerprints(docs), "prints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "first")
    return _named(prints, first, components(links(first.select("fp"))))


def _named(prints: DataFrame, first: DataFrame, roots: DataFrame) -> DataFrame:
    whole = first.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(stored(whole.join(least, "root").select("fp", "root", "component_id"), "ids"), "fp")


def similar(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """As clustered, by links between texts whose shingles of the given width have that Jaccard similarity; fp is a text's words (see near.py)."""
    prints = stored(near.fingerprints(docs, width), "prints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("sig").alias("sig")), "first")
    roots = components(near.links(docs, first.select("fp", "sig"), width, similarity, components))
    return _named(prints.drop("sig"), first.drop("sig"), roots)


def deduplicated(docs: DataFrame, width: int = WIDTH, similarity: float | None = None) -> DataFrame:
    """One document of each component: the one of smallest id (null last), then of smallest hash of its text. Columns of docs stay as they are.

    Without similarity, components are op6's, of fingerprints within BITS; with it, of shingles of the given width. Rows that are
    alone in their component are not shuffled: a bitmap of fixed size tells them from the rows that are joined with what is kept."""
    if similarity is None and width != WIDTH:
        raise ValueError(f"without a similarity the width is {WIDTH}")
    text_hash = F.xxhash64("text")
    rows = docs.select("doc_id", "text", text_hash.alias("h"))
    whole = stored(clustered(rows) if similarity is None else similar(rows, width, similarity), "clusters")
    roots = whole.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "h")).alias("s"))
    roots = stored(roots.select("root", "n", F.col("s.doc_id").alias("__id"), F.col("s.h").alias("__hash")), "roots")
    crowded = whole.join(roots.where("n > 1").select("root"), "root", "left_semi")
    bitmap = stored(marks(crowded.select(F.xxhash64("doc_id", "h").alias("key"))), "marks")
    times = crowded.groupBy("doc_id", "h").agg(F.count("*").alias("__times")).where("__times > 1").withColumnsRenamed({"doc_id": "__doc", "h": "__h"})
    keep = stored(roots.join(times, F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__h")), "left").select("__id", "__hash", "__times"), "keep")
    names, flag = docs.columns, fresh("shared", docs.columns)
    found = marked(docs, F.xxhash64(F.col("doc_id"), text_hash), bitmap, flag)
    alone = found.where(~F.col(flag)).select(*names)
    names_of = {n: fresh(n, names) for n in ("__id", "__hash", "__times")}
    keep = keep.withColumnsRenamed(names_of)
    at, h, n = names_of.values()
    out = found.where(flag).join(keep, F.col("doc_id").eqNullSafe(F.col(at)) & (text_hash == F.col(h)))
    once = out.where(F.col(n).isNull()).select(*names)
    repeated = out.where(F.col(n).isNotNull()).dropDuplicates(["doc_id", h]).select(*names)
    return alone.unionByName(once).unionByName(repeated)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    found = clustered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
