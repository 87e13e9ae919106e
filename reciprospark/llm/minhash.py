"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidate edges.

A text is the set of its shingles of a given width (lower-cased words; fewer words than that are one shingle). One hash of each
shingle gives its bin and its value; a bin keeps the least. An empty bin takes the value of the first bin that is not empty along its own
fixed sequence of random bins, so two texts agree in any bin with a probability of their similarity. Runs of bins are bands;
texts of equal words are one node, and nodes with an equal band share a bucket.

Candidates are a star: each member of a bucket with its least node, so a bucket of n has n - 1 pairs, and groups of copies
have nearly the same star in all bands. Candidates are confirmed on their whole sets. Two members that are no copies of
the star's centre may still be copies of each other. So members of a bucket that belong to different components, the
centre aside, are open: they are put into buckets anew by sharper bands (SECOND) and compared there by the agreeing bins of
their signatures, in blocks of about TILE members, each pair of blocks a group of its own. First each member with the
one of another component that it agrees with most, which connects nearly all that can be; then all pairs of components
that are different even so, if enough bins agree. All these are confirmed. Nodes that are connected already need no further link,
and no pair of an open bucket is passed over, however large the bucket is.

What can be lost: at a similarity of 0.85 a pair shares no bucket of FIRST with a probability of 2e-8, none of SECOND with 3e-8 and
falls under the agreeing bins asked for (SPREAD standard deviations below the similarity) with 1e-9; all fall fast with similarity.

Cases: null texts, and texts without words, have an empty set and link with nothing; a null id is never a component's id unless all
ids of the component are null; repeated rows and ids are each reported; very long texts are sets of any size; an
empty table gives an empty one. Columns of docs named like an added one are replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reciprospark.llm import near
from reciprospark.llm.common import discard, fresh, record, slices, stored, table
from reciprospark.llm.simhash import components

WIDTH, SIMILARITY = 5, 0.85
#: Bins of a band, and bands, of the first buckets and of the sharper ones.
FIRST, SECOND = (4, 24), (10, 80)
SPREAD, TILE = 6.0, 1024
ADDED = ("n_shingles", "component_id", "kept")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=64)  # at most 6 MB in a worker
def probes(bins: int, block: int, size: int = 64) -> np.ndarray:
    """For each bin the bins to try, a block of them at a time: a fixed sequence of random bins of its own."""
    tries = np.arange(block * size, (block + 1) * size, dtype=np.uint64)
    return (mixed(np.arange(1, bins + 1, dtype=np.uint64)[:, None] * _A + mixed(tries + _C)) % np.uint64(bins)).astype(np.uint16)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The least of the hashes (sorted, distinct, at least one) in each bin; empty bins take another's."""
    at = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out, full = np.zeros(bins, dtype=np.uint64), np.zeros(bins, dtype=bool)
    out[at[first]], full[at[first]] = hashes[first], True
    empty, block = np.flatnonzero(~full), 0
    while len(empty):
        tried = probes(bins, block)[empty]
        hit = full[tried]
        found, place = hit.any(axis=1), hit.argmax(axis=1)
        out[empty[found]] = out[tried[found, place[found]]]
        empty, block = empty[~found], block + 1
    return out


def bands(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A key (int64) for each band of each signature."""
    runs = signatures.reshape(len(signatures), signatures.shape[1] // rows, rows)
    out = np.broadcast_to(np.arange(1, runs.shape[1] + 1, dtype=np.uint64) * _A, runs.shape[:2])
    for k in range(rows):
        out = mixed((out ^ runs[:, :, k]) * _A + _C)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """docs with fp (bigint: the node), n_shingles and keys (of its buckets) in place of text."""
    own = [c for c in docs.columns if c != "text"]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"] + ["fp long, n_shingles long, keys array<long>"])
    more = [("fp", pa.int64()), ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64()))]
    rows, n = FIRST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            fp = np.array([near.node(t.lower().split()) for t in texts], dtype=np.uint64).view(np.int64)
            sizes, keys = np.zeros(len(texts), np.int64), []
            for k, t in enumerate(texts):
                found = near.shingles(t, width)
                sizes[k] = len(found)
                if len(found):
                    keys.append(signature(found, rows * n))
            flat = bands(np.array(keys, dtype=np.uint64).reshape(-1, rows * n), rows).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((sizes > 0) * n)]).astype(np.int32)), pa.array(flat))
            yield record(pa.schema([*[batch.schema.field(c) for c in own], *[pa.field(*x) for x in more]]), [*[batch.column(c) for c in own], fp, sizes, lists])

    return docs.mapInArrow(run, fields)


def sharper(texts: DataFrame, width: int) -> DataFrame:
    """fp, keys (of the sharper buckets) and sig (a byte for each bin). texts: fp, body."""
    rows, n = SECOND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                sigs = np.array([signature(near.shingles(zstandard.decompress(x.as_py()), width), rows * n) for x in batch.column("body")], dtype=np.uint64)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, len(batch) * n + 1, n, dtype=np.int32)), pa.array(bands(sigs, rows).ravel()))
                yield record(pa.schema([("fp", pa.int64()), ("keys", pa.list_(pa.int64())), ("sig", pa.binary())]), [batch.column("fp"), keys, [x.astype(np.uint8).tobytes() for x in sigs]])
        pa.default_memory_pool().release_unused()  # the worker lives on, for tasks of other stages

    return texts.select("fp", "body").mapInArrow(run, "fp long, keys array<long>, sig binary")


def buckets(nodes: DataFrame) -> DataFrame:
    """The members of buckets of two and more: key, fp, centre (the least fp) and n (members). nodes: fp, keys."""
    rows = nodes.select("fp", F.explode("keys").alias("key"))
    centres = rows.groupBy("key").agg(F.min("fp").alias("centre"), F.count("*").alias("n")).where("n > 1")
    return rows.join(centres, "key")


def star(members: DataFrame) -> DataFrame:
    """Candidates (a, b): each member of a bucket with its centre."""
    return members.where("fp <> centre").select(F.col("centre").alias("a"), F.col("fp").alias("b")).distinct()


def opened(members: DataFrame, roots: DataFrame) -> DataFrame:
    """fp of those members (centres aside) whose bucket has members of several components, each once. roots: fp, root."""
    rows = members.where("n > 2 and fp <> centre").select("key", "fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rows.join(_several(rows), "key").select("fp").distinct()


def _several(rows: DataFrame) -> DataFrame:
    """The keys of buckets with members of several components. rows: key, root."""
    return rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")


def apart(wide: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of sharper buckets of several components: key, band, fp, root, sig. wide: fp, keys, sig; roots: fp, root."""
    rows = wide.select("fp", F.posexplode("keys").alias("band", "key")).join(roots, "fp", "left")
    rows = rows.select("key", F.col("band").cast("long").alias("band"), "fp", F.coalesce("root", "fp").alias("root"))
    return rows.join(_several(rows), "key").join(wide.select("fp", "sig"), "fp")


def least_agreeing(similarity: float) -> int:
    bins = SECOND[0] * SECOND[1]
    return int(bins * similarity - SPREAD * (bins * similarity * (1 - similarity)) ** 0.5)


def compared(rows: DataFrame, least: int, tile: int, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) of one bucket and different components with enough agreeing bins, each once. rows: key, band, fp, root, sig.

    A bucket's members are dealt to blocks of about ``tile``; each two of its blocks, and each with itself, are a group. A pair that shares
    several buckets is taken in the first. nearest: of a member only the pair that agrees most in a group: at most one for each member."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    rows = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(group.alias("key"), "band", "fp", "root", F.signum(F.col("own") - F.col("other")).cast("long").alias("side"), "sig")
    of_band, n = SECOND

    def of(_: int, band: np.ndarray, fp: np.ndarray, root: np.ndarray, side: np.ndarray, sig: np.ndarray) -> list[np.ndarray]:
        found, first = [], int(band[0]) * of_band
        for k in np.flatnonzero(side <= 0).tolist():
            others = np.flatnonzero((side > 0) & (root != root[k])) if side[k] else k + 1 + np.flatnonzero((side[k + 1 :] == 0) & (root[k + 1 :] != root[k]))
            if not len(others):
                continue
            same = sig[others] == sig[k]
            agree = same.sum(axis=1)
            if first:
                agree[same[:, :first].reshape(len(others), -1, of_band).all(axis=2).any(axis=1)] = 0
            picked = np.flatnonzero(agree >= least)
            found += [(k, j) for j in others[picked[[agree[picked].argmax()]] if nearest and len(picked) else picked].tolist()]
        return near._columns(found, fp)

    return near._by_list(rows, ("band", "fp", "root", "side"), of_band * n, "a long, b long", of)


def links(docs: DataFrame, nodes: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """Confirmed links (a, b) of nodes, enough of them to connect all that link. nodes: distinct fp, with keys; docs: text."""
    members = stored(buckets(nodes), "members")
    pairs = stored(star(members), "pairs")
    texts = stored(near.bodies(docs, members.select("fp").distinct(), members.select("fp").limit(0), width), "bodies")
    good = stored(near.verified(pairs, texts, width, similarity), "good")
    roots = stored(components(good), "roots")
    left = stored(opened(members, roots), "open")
    if left.isEmpty():
        discard(members, pairs, texts, roots, left)
        return good
    wide, least = stored(sharper(texts.join(left, "fp"), width), "wide"), least_agreeing(similarity)
    more = stored(compared(apart(wide, roots), least, tile, nearest=True).distinct().join(pairs, ["a", "b"], "left_anti"), "more")
    good_more = stored(good.union(near.verified(more, texts, width, similarity)), "good")
    after = stored(components(good_more), "roots")
    rest = stored(compared(apart(wide, after), least, tile).distinct().join(pairs.union(more), ["a", "b"], "left_anti"), "rest")
    out = stored(good_more.union(near.verified(rest, texts, width, similarity)), "links")
    discard(members, pairs, texts, good, roots, left, wide, more, good_more, after, rest)
    return out


def clustered(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """docs (doc_id, text, ...) without text, with n_shingles, component_id (the smallest doc_id reachable by links) and kept (whether that is the row's own)."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ADDED])
    names = {c: fresh(c, ("fp", "keys", "root", "id", *docs.columns, *ADDED)) for c in docs.columns if c.lower() in ("fp", "keys", "root", "id")}
    prints = stored(fingerprints(docs.withColumnsRenamed(names), width), "prints")
    first = stored(prints.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.count("*").alias("n")), "first")
    roots = components(links(docs, first.select("fp", "keys"), width, similarity, tile))
    whole = first.join(roots, "fp", "left").select("fp", "id", "n", F.coalesce("root", "fp").alias("root"))
    least = whole.groupBy("root").agg(F.min("id").alias("component_id"), F.sum("n").alias("rows")).where("rows > 1").select("root", "component_id")
    ids = stored(whole.join(least, "root").select("fp", "component_id", F.lit(True).alias("id")), "ids")
    out = prints.drop("keys").join(ids, "fp", "left").withColumn("component_id", F.when(F.col("id"), F.col("component_id")).otherwise(F.col("doc_id")))
    out = out.drop("fp", "id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.withColumnsRenamed({v: k for k, v in names.items()})


def deduplicated(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that are kept; columns stay as they are. Rows that repeat the kept one, id and all, are kept as it is."""
    h = F.xxhash64("text")
    gone = clustered(docs.select("doc_id", "text", h.alias("h")), width, similarity).where("not kept").select("doc_id", "h")
    names = {c: fresh(f"__{c}", docs.columns) for c in gone.columns}
    gone = stored(gone.withColumnsRenamed(names).distinct(), "gone")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (h == F.col(names["h"])), "left_anti")


def op12_minhash(spark, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct r, array_to_string(w[k : k + 4], ' ') as s from (select r, w, unnest(range(1, greatest(2, len(w) - 3))) as k from d where len(w) > 0)),
n as (select r, count(*) as n from s group by r),
p as (select a.r as a, b.r as b, count(*) as c from s a join s b on a.s = b.s and a.r < b.r group by all),
l as (select a, b from p join n x on x.r = a join n y on y.r = b where 100 * c >= 85 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
t as (select r as x, r as y from d union select t.x, e.b from t join e on t.y = e.a),
i as (select x, min(doc_id) as component_id from t join d on d.r = t.y group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id is not distinct from component_id as kept from d left join n using (r) join i on i.x = d.r
"""
