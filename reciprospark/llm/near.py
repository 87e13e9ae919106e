"""Near-duplicates by the Jaccard similarity of word shingles: an index of byte positions, count filter, verified.

A text is the set of its shingles of a given width (lower-cased words; fewer words than that are one shingle). Texts of
equal words are one node, so thousands of copies are one entry. A node's fingerprint has BYTES positional bytes, each of
one minimum of the hashed shingles: two texts agree in a byte with a probability of their similarity (and 1/256 of the
rest). The index lists each node under BYTES / BAND runs of BAND bytes. Within a list the agreeing bytes of a pair are
tallied; pairs under the minimum (SPREAD standard deviations below the similarity asked for) are passed over, and the rest
are verified on their whole sets of shingles. At similarity 0.8 a pair shares no list with probability 2e-4, and falls under
the minimum with 1e-4; both fall fast with similarity.

Two rounds keep the work near-linear without losing links. The first compares lists of up to SMALL nodes in all pairs; in a
longer one a node waits after a strong match or TRIES others. Lists of over TILE nodes are dealt to blocks for that. The second takes the longer
lists again, with the components that the verified links have made, and with WIDE further positional bytes of each node, which make the
tally sharper: every pair of different components that reaches both minima is verified. A list's nodes are dealt to blocks of about
TILE, and each two blocks, and each with itself, are a group of its own, so no task holds more than two blocks. Nodes that are
connected already need no further link; so all that the tallies let through is decided, in lists of any length.

Texts are not shuffled to verify: of those whose node a bitmap marks (see common.marks; its size goes by the number of nodes, up to 32 MB), one for each node and task is
sent on, compressed, and an exact join follows. Links of one node are verified in PARTS groups, so that a large cluster is no
hot key.

Cases: null and empty texts are one node; repeated rows and ids are each reported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import bits_for, discard, marks, record, slices, stored

SEED, BYTES, WIDE, BAND, SPREAD, SMALL, TRIES, PARTS, TILE = 42, 64, 512, 4, 4.0, 8, 4, 64, 1024
_DRAW = np.random.default_rng(SEED)
_FACTORS = _DRAW.integers(1, 1 << 63, BYTES + WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAW.integers(0, 1 << 63, BYTES + WIDE, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def node(words: list[bytes]) -> int:
    """Of lower-cased words in their order; 0 without any."""
    return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0


def shingles(text: bytes, width: int) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(ends)))


def fingerprint(hashes: np.ndarray, at: slice = slice(BYTES)) -> bytes:
    """The positional bytes of a set of shingles; those beyond BYTES are the further ones."""
    factors, shifts = _FACTORS[at], _SHIFTS[at]
    low = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), 512):
        low = np.minimum(low, (hashes[k : k + 512, None] * factors + shifts).min(axis=0))
    return (((low ^ (low >> np.uint64(32))) * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def minimum(similarity: float, n: int = BYTES) -> int:
    """The least number of agreeing bytes, of n, of a pair to verify."""
    return max(BAND, int(n * similarity - SPREAD * (n * similarity * (1 - similarity)) ** 0.5))


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """docs with fp (bigint: the node) and sig in place of text."""
    own = [c for c in docs.columns if c != "text"]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"] + ["fp long", "sig binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            fp = np.array([node(t.lower().split()) for t in texts], dtype=np.uint64).view(np.int64)
            sig = [fingerprint(shingles(t, width)) for t in texts]
            schema = pa.schema([*[batch.schema.field(c) for c in own], ("fp", pa.int64()), ("sig", pa.binary())])
            yield record(schema, [*[batch.column(c) for c in own], fp, sig])

    return docs.mapInArrow(run, fields)


def listed(nodes: DataFrame) -> DataFrame:
    """The index: key (which bytes, and the bytes), fp and sig. nodes: fp, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = BYTES // BAND
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                sig = batch.column("sig").to_pylist()
                keys = np.frombuffer(b"".join(sig), dtype=f"<u{BAND}").reshape(-1, lists).astype(np.int64) + (np.arange(lists, dtype=np.int64) << 32)
                fp = np.repeat(batch.column("fp").to_numpy(), lists)
                yield record(pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("sig", pa.binary())]), [keys.ravel(), fp, [s for s in sig for _ in range(lists)]])

    return nodes.mapInArrow(run, "key long, fp long, sig binary")


def _by_list(rows: DataFrame, columns: tuple[str, ...], n_bytes: int, out: str, of: Callable[..., list[list]]) -> DataFrame:
    """What ``of`` gives of each list of rows (key, sig of n_bytes, ...): its key, then the given columns and the bytes as arrays."""
    names = ("key", *columns)
    schema = pa.schema([(n.split()[0], pa.int64()) for n in out.split(", ")])

    def made(held: list[np.ndarray]) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.flatnonzero(np.diff(held[0])) + 1])
        ends = np.append(starts[1:], len(held[0]))
        found = [of(int(held[0][s]), *(x[s:e] for x in held[1:])) for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True)]
        return record(schema, [np.concatenate([np.zeros(0, np.int64), *[x[k] for x in found]]) for k in range(len(schema))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [*(np.zeros(0, np.int64) for _ in names), np.zeros((0, n_bytes), np.uint8)]  # a list that the next batch may continue
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint8).reshape(-1, n_bytes)
            held = [np.concatenate(x) for x in zip(held, [*(batch.column(n).to_numpy() for n in names), sig], strict=True)]
            if len(held[0]) and len(stop := np.flatnonzero(np.diff(held[0]))):
                stop = int(stop[-1]) + 1
                yield made([x[:stop] for x in held])
                held = [x[stop:] for x in held]
        if len(held[0]):
            yield made(held)

    return rows.select(*names, "sig").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, out)


def _first(sig: np.ndarray, least: int, strong: int) -> list[tuple[int, int]]:
    """Pairs of one list that agree in enough bytes; in a long one a node with a strong match, or TRIES others, waits for the second round."""
    out = []
    n = len(sig)
    tries = np.zeros(n, dtype=np.int64)
    for k in range(n - 1):
        if n > SMALL and tries[k] >= TRIES:
            continue
        others = np.arange(k + 1, n) if n <= SMALL else k + 1 + np.flatnonzero(tries[k + 1 :] < TRIES)
        agree = (sig[others] == sig[k]).sum(axis=1)
        tries[others] += np.where(agree >= strong, TRIES, agree >= least)
        out += [(k, j) for j in others[agree >= least].tolist()]
    return out


def _apart(root: np.ndarray, side: np.ndarray, sig: np.ndarray, least: int, least_wide: int, band: int) -> list[tuple[int, int]]:
    """Pairs of a group that agree in enough bytes, of the first ones and of all, and belong to different components: all of
    them that share no list of an earlier run of bytes, where they are compared as well. side: -1 and 1 of two blocks, 0 of a block by itself."""
    out = []
    runs = np.ascontiguousarray(sig[:, :BYTES]).view(f"<u{BAND}")[:, :band]
    for k in np.flatnonzero(side <= 0).tolist():
        others = np.flatnonzero((side > 0) & (root != root[k])) if side[k] else k + 1 + np.flatnonzero((side[k + 1 :] == 0) & (root[k + 1 :] != root[k]))
        others = others[(sig[others, :BYTES] == sig[k, :BYTES]).sum(axis=1) >= least]
        others = others[~(runs[others] == runs[k]).any(axis=1)]
        out += [(k, j) for j in others[(sig[others] == sig[k]).sum(axis=1) >= least_wide].tolist()]
    return out


def _columns(pairs: list[tuple[int, int]], fp: np.ndarray) -> list[np.ndarray]:
    at = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return [np.minimum(fp[at[:, 0]], fp[at[:, 1]]), np.maximum(fp[at[:, 0]], fp[at[:, 1]])]


def first_round(nodes: DataFrame, similarity: float, tile: int = TILE) -> DataFrame:
    """Of kind 0, pairs (a, b) to verify; of kind 1, members b of long lists a. nodes: distinct fp, with sig."""
    least, strong = minimum(similarity), int(np.ceil(BYTES * (1 + similarity) / 2))
    rows = listed(nodes)
    blocks = stored(rows.groupBy("key").agg(F.ceil(F.count("*") / tile).alias("blocks")).where("blocks > 1"), "blocks")
    long = None
    if blocks.isEmpty():
        rows = rows.withColumn("dealt", F.lit(0).cast("long"))
    else:
        rows = rows.join(blocks, "key", "left")
        long = rows.where("blocks is not null").select(F.lit(1).cast("long").alias("kind"), F.col("key").alias("a"), F.col("fp").alias("b"))
        block = F.xxhash64("key", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        rows = rows.select(F.when(F.col("blocks").isNotNull(), block).otherwise(F.col("key")).alias("key"), "fp", F.col("blocks").isNotNull().cast("long").alias("dealt"), "sig")

    def of(key: int, fp: np.ndarray, dealt: np.ndarray, sig: np.ndarray) -> list[np.ndarray]:
        a, b = _columns(_first(sig, least, strong), fp)
        more = fp if len(fp) > SMALL and not dealt[0] else fp[:0]  # a dealt list is a long one as a whole
        return [np.repeat([0, 1], [len(a), len(more)]), np.concatenate([a, np.full(len(more), key)]), np.concatenate([b, more])]

    found = _by_list(rows, ("fp", "dealt"), BYTES, "kind long, a long, b long", of)
    return found if long is None else found.union(long)


def second_round(members: DataFrame, similarity: float, tile: int = TILE) -> DataFrame:
    """Pairs (a, b), each once, of nodes in a list whose components differ. members: key, fp, root, sig (all bytes)."""
    least, wide = minimum(similarity), minimum(similarity, BYTES + WIDE)
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key", "blocks")
    rows = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(group.alias("key"), F.shiftright("key", 32).alias("band"), "fp", "root", F.signum(F.col("own") - F.col("other")).cast("long").alias("side"), "sig")

    def of(_: int, band: np.ndarray, fp: np.ndarray, root: np.ndarray, side: np.ndarray, sig: np.ndarray) -> list[np.ndarray]:
        return _columns(_apart(root, side, sig, least, wide, int(band[0])), fp)

    return _by_list(rows, ("band", "fp", "root", "side"), BYTES + WIDE, "a long, b long", of)


def _bitmap(fps: DataFrame) -> np.ndarray:
    """The bitmap of nodes (fp)."""
    bits = bits_for(fps.count())
    found = marks(fps.select(F.col("fp").alias("key")), bits).toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def bodies(docs: DataFrame, fps: DataFrame, long: DataFrame, width: int) -> DataFrame:
    """fp, the compressed words (body) and, for those of long, the further bytes (wide) of each of fps (distinct fp): one row for each node."""
    held = docs.sparkSession.sparkContext.broadcast((_bitmap(fps), _bitmap(long)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        schema = pa.schema([("fp", pa.int64()), ("body", pa.binary()), ("wide", pa.binary())])
        for _, texts in slices(batches):
            words = [t.lower().split() for t in texts]
            fp = np.array([node(w) for w in words], dtype=np.uint64)
            asked, further = (((b[(fp & np.uint64(64 * len(b) - 1)) >> np.uint64(6)] >> (fp & np.uint64(63))) & np.uint64(1)).astype(bool) for b in held.value)
            out = []
            for k in np.flatnonzero(asked).tolist():
                if (f := int(fp[k])) not in seen:
                    seen.add(f)
                    out.append((fp[k : k + 1].view(np.int64)[0], zstandard.compress(b" ".join(words[k]), 3), fingerprint(shingles(texts[k], width), slice(BYTES, None)) if further[k] else None))
            yield record(schema, [[x[i] for x in out] for i in range(3)])

    return docs.select("text").mapInArrow(run, "fp long, body binary, wide binary").join(fps, "fp", "left_semi").dropDuplicates(["fp"])


def verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least the given similarity. texts: fp, body."""
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS)))
    texts = texts.select("fp", "body")
    one = pairs.select("a", "part").distinct().join(texts.withColumnsRenamed({"fp": "a", "body": "one"}), "a")
    both = pairs.join(texts.withColumnsRenamed({"fp": "b", "body": "other"}), "b").join(one, ["a", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def items(fp: int, body: pa.Scalar) -> np.ndarray:
            if (out := known.get(fp)) is None:
                if len(known) >= 64:
                    known.clear()
                out = known[fp] = shingles(zstandard.decompress(body.as_py()), width)
            return out

        for batch in batches:
            a, b, one, other = batch.columns
            near = [jaccard(items(i, x), items(j, y)) >= similarity for i, j, x, y in zip(a.to_pylist(), b.to_pylist(), one, other, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "one", "other").mapInArrow(run, "a long, b long")


def links(docs: DataFrame, nodes: DataFrame, width: int, similarity: float, components: Callable[[DataFrame], DataFrame], tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of nodes of at least the given similarity, enough of them to connect all. nodes: distinct fp, with sig."""
    found = stored(first_round(nodes, similarity, tile), "found")
    pairs = found.where("kind = 0").select("a", "b").distinct()
    long = found.where("kind = 1")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("fp")).union(long.select(F.col("b").alias("fp")))
    texts = stored(bodies(docs, ends.distinct(), long.select(F.col("b").alias("fp")), width), "bodies")
    good = stored(verified(pairs, texts, width, similarity), "good")
    if long.isEmpty():
        discard(found, texts)
        return good
    roots = components(good)
    members = long.select(F.col("a").alias("key"), F.col("b").alias("fp")).join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    members = members.join(nodes, "fp").join(texts.select("fp", "wide"), "fp").select("key", "fp", "root", F.concat("sig", "wide").alias("sig"))
    rest = stored(second_round(members, similarity, tile).join(pairs, ["a", "b"], "left_anti"), "rest")
    out = stored(good.union(verified(rest, texts, width, similarity)), "links")
    discard(found, texts, good, rest)
    return out
