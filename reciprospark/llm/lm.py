"""LM scoring by a hierarchical Pitman-Yor model of word pairs.

Restaurants: one for each context (the word before, or the begin of a text), all sharing one parent, the restaurant without
context, whose base is uniform over the V training tokens and one unknown. A sweep of Gibbs sampling draws the parent's measure
given its seating, then, given that measure, a gamma variable of each context restaurant and the tables of all its dishes,
exactly and independently (see ``seating``): context restaurants do not depend on each other but through the measure, so a
block of them is drawn at once without standing in for a sequence. Their tables are the parent's customers, whose tables are drawn in
the same way. One thing is not exact: the part of the parent's measure that has no table yet is spread over the words as the base
is, at its mean. After BURN_IN sweeps each sweep is a sample; the predictive probabilities of the samples are averaged;
``perplexity`` is of those. Discounts come from the counts of counts at each level; strengths are fixed.

Tokens are the words of a text, A-Z lower-cased, and one end.

Data flow (all arrays are packed blobs, a row for each chunk, bucket or block, so no table has a row for each token):

* chunks: about CHUNK_BYTES of text each, tokenised once: distinct words, local ids of the tokens, written to the shared folder.
* vocabulary buckets: words dealt by hash; a bucket counts its words over all chunks, numbers them and replies to each chunk.
* blocks: pairs (word before, word) dealt to a G x G grid by both ids modulo G, each pair once for each chunk. A block
  counts its pairs over all chunks. G follows the number of tokens, so a block holds a bounded share of the pairs; a
  context that a third of all tokens follow still has each of its dishes once, dealt over G blocks.
* slices: the state of a sweep (tables of contexts; customers and tables of words) cut by id modulo G. A block meets its two
  slices by key, draws, and adds up its tables for each of them. Nothing that grows with the corpus is broadcast or
  collected; the driver holds a dozen totals.
* scores: blocks and slices reply to the chunks that asked, and each chunk adds up its documents; a task has a few chunks.

Draws are seeded by (seed, sweep, block or slice), so a task that runs again repeats them, and the last pass redraws the samples'
tables in place of storing them. Ids go by count, then by the word's bytes, so they do not depend on how files are cut.
Word ids take 32 bits: beyond 2**32 - 2 distinct training words it raises.

Cases: ids are whole numbers; null and empty texts are one end token; a word that no training text has is unknown (probability of the
uniform base's unknown, by the parent); without training texts all probabilities are 1; null ids count as training rows
(crc32 of empty text) and are returned as null; repeated rows count and are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import discard, packed, record, remainder, slices, stored, table, unpacked
from reciprospark.llm.seating import restaurant_masses, root_masses, tables

CHUNK_BYTES, BLOCK_TOKENS, BUCKET_WORDS = 16 << 20, 2_000_000, 200_000
#: Blocks' sums for a slice that meet in one task.
FAN_IN = 64
BURN_IN, SAMPLES, STRENGTH, SEED = 1, 2, 1.0, 20240
UNKNOWN, SPECIAL = 0, 1  # SPECIAL: the end as a word, the begin as a context


@dataclass(frozen=True)
class Sizes:
    tokens: int
    texts: int  # training texts
    train: int  # training tokens
    vocab: int  # distinct training tokens
    grid: int
    buckets: int
    ids: int  # ids are below it
    chunks: int = 1

    @property
    def slice_len(self) -> int:
        return -(-max(self.ids, 2) // self.grid)


def _bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), dtype=np.int64, count=len(words))


CHUNKS = "chunk string, n_tokens long, n_train long, n_texts long, n_distinct long, doc_ids array<long>, held array<boolean>, lens binary, words binary, counts binary, ids binary"


def chunks(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, held. One row for each chunk of texts: local ids of the tokens without ends, words by local id."""
    kinds = pa.schema([("chunk", pa.string()), ("n_tokens", pa.int64()), ("n_train", pa.int64()), ("n_texts", pa.int64()), ("n_distinct", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), *[(c, pa.binary()) for c in ("lens", "words", "counts", "ids")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        parts, doc_ids, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            lens = np.array([len(p) for p in parts], dtype=np.int64)
            ids = np.concatenate(parts).astype(np.uint32)
            train = np.repeat(~np.array(held, dtype=bool), lens)
            counts = np.bincount(ids[train], minlength=len(known))
            texts = int((~np.array(held, dtype=bool)).sum())
            row = [f"{part}-{made}", len(ids) + len(lens), int(train.sum()) + texts, texts, len(known), doc_ids, held, packed(lens), packed(np.frombuffer(b" ".join(known), dtype=np.uint8)), packed(counts), packed(ids)]
            return record(kinds, [[x] for x in row])

        for batch, texts in slices(batches):
            for t, i, h in zip(texts, batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), strict=True):
                words = t.lower().split()
                put = known.setdefault
                parts.append(np.fromiter((put(w, len(known)) for w in words), dtype=np.int64, count=len(words)))
                doc_ids.append(i)
                held.append(h)
                size += len(t) + 64
                if size >= CHUNK_BYTES:
                    yield flush()
                    known, parts, doc_ids, held, size, made = {}, [], [], [], 0, made + 1
        if parts:
            yield flush()

    return docs.select("doc_id", "text", "held").mapInArrow(run, CHUNKS)


def _words(row) -> list[bytes]:
    return unpacked(row.words, np.uint8).tobytes().split(b" ") if row.words else []


def vocabulary(rows: DataFrame, buckets: int) -> DataFrame:
    """Replies (chunk, bucket, ids, counts: of the chunk's words of the bucket in their order) and, with chunk null, totals of each bucket."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                words, counts = _words(r), unpacked(r.counts, np.int64)
                of = _bucket_of(words, buckets)
                order = np.argsort(of, kind="stable")
                edges = np.searchsorted(of[order], np.arange(buckets + 1))
                out = [(b, r.chunk, packed(np.frombuffer(b" ".join([words[k] for k in order[a:e]]), dtype=np.uint8)), packed(counts[order[a:e]])) for b, (a, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if e > a]
                yield pd.DataFrame(out, columns=["bucket", "chunk", "words", "counts"])

    def count(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("chunk")
        known: dict[bytes, int] = {}
        local, total = [], []
        for r in f.itertuples(index=False):
            local.append(np.array([known.setdefault(w, len(known)) for w in _words(r)], dtype=np.int64))
            total.append(unpacked(r.counts, np.int64))
        c = np.bincount(np.concatenate(local), weights=np.concatenate(total), minlength=len(known)).astype(np.int64)
        bucket, first = int(f.bucket.iloc[0]), int(f.bucket.iloc[0] == 0)  # bucket 0 leaves its first id to SPECIAL
        rank, names = np.empty(len(c), dtype=np.int64), list(known)
        rank[sorted(range(len(c)), key=lambda k: (-c[k], names[k]))] = np.arange(len(c))
        ids = np.where(c > 0, 1 + bucket + buckets * (rank + first), UNKNOWN)
        if len(ids) and ids.max() >= 1 << 32:
            raise ValueError("more distinct training words than 32-bit ids")
        out = [(chunk, bucket, packed(ids[k].astype(np.uint32)), packed(c[k]), 0, 0, 0) for chunk, k in zip(f.chunk, local, strict=True)]
        out.append((None, bucket, b"", b"", int(c.sum()), int((c > 0).sum()), int(ids.max()) + 1 if len(ids) else 1))
        return pd.DataFrame(out, columns=["chunk", "bucket", "ids", "counts", "n", "v", "top"])

    asked = rows.select("chunk", "words", "counts").mapInPandas(ask, "bucket int, chunk string, words binary, counts binary")
    return asked.groupBy("bucket").applyInPandas(count, "chunk string, bucket int, ids binary, counts binary, n long, v long, top long")


def _global(chunk, replies: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and counts of a chunk's words by local id, and the order in which bucket replies list them."""
    words = _words(chunk)
    order = np.argsort(_bucket_of(words, buckets), kind="stable")
    replies = replies.sort_values("bucket")
    ids, counts = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    if len(words):
        ids[order] = np.concatenate([unpacked(b, np.uint32) for b in replies.ids]).astype(np.int64)
        counts[order] = np.concatenate([unpacked(b, np.int64) for b in replies.counts])
    return ids, counts, order


def _sequence(chunk, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each token of a chunk, ends included: local id (-1: end) of its context (-1: begin) and itself, and their global ids."""
    lens, local = unpacked(chunk.lens, np.int64), unpacked(chunk.ids, np.uint32).astype(np.int64)
    ends = np.cumsum(lens + 1) - 1
    word = np.full(int(lens.sum()) + len(lens), -1, dtype=np.int64)
    inner = np.ones(len(word), dtype=bool)
    inner[ends] = False
    word[inner] = local
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.concatenate([[0], ends[:-1] + 1])] = -1
    padded = np.append(ids, SPECIAL)  # index -1
    return before, word, padded[before], padded[word]


def _pairs(u: np.ndarray, w: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct known pairs as keys, in order of block and key; their blocks; and for each token the place of its pair, or -1."""
    known = (u != UNKNOWN) & (w != UNKNOWN)
    keys, at = np.unique((w[known].astype(np.uint64) << np.uint64(32)) | u[known].astype(np.uint64), return_inverse=True)
    block = _block(keys, grid)
    order = np.argsort(block, kind="stable")
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.arange(len(keys))
    out = np.full(len(u), -1, dtype=np.int64)
    out[known] = place[at]
    return keys[order], block[order], out


def _block(keys: np.ndarray, grid: int) -> np.ndarray:
    u, w = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), (keys >> np.uint64(32)).astype(np.int64)
    return (u - 1) % grid * grid + (w - 1) % grid


def _local(keys: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the contexts and of the words of keys in their slices."""
    return ((keys & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1) // grid, ((keys >> np.uint64(32)).astype(np.int64) - 1) // grid


def _delta(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def _undelta(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


BLOCKS = "block int, keys binary, counts binary, keys2 binary, counts2 binary, once_u binary, once_w binary, n1 long, n2 long, asked array<struct<chunk: string, at: binary>>"


def blocks(rows: DataFrame, replies: DataFrame, size: Sizes) -> DataFrame:
    """Counts of the distinct pairs, a row for each block; asked: which of them each chunk has, in its order."""
    grid, buckets, width = size.grid, size.buckets, size.slice_len

    def ask(chunk: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in chunk.itertuples(index=False):
            ids, _, _ = _global(r, words, buckets)
            _, _, u, w = _sequence(r, ids)
            keys, block, at = _pairs(u, w, grid)
            train = np.repeat(~np.array(r.held, dtype=bool), unpacked(r.lens, np.int64) + 1) & (at >= 0)
            counts = np.bincount(at[train], minlength=len(keys))
            first = np.flatnonzero(np.diff(block, prepend=-1))  # of the blocks that the chunk has pairs of: never all of the grid
            out += [(int(block[a]), r.chunk, _delta(keys[a:e]), packed(counts[a:e].astype(np.uint32))) for a, e in zip(first.tolist(), [*first[1:].tolist(), len(block)], strict=False)]
        return pd.DataFrame(out, columns=["block", "chunk", "keys", "counts"])

    def count(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("chunk")
        each = [_undelta(k) for k in f["keys"]]
        keys, at = np.unique(np.concatenate(each), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate([unpacked(b, np.uint32) for b in f["counts"]]), minlength=len(keys)).astype(np.int64)
        once, more = keys[c == 1], c > 1
        iu, iw = _local(once, grid)
        edges = np.concatenate([[0], np.cumsum([len(k) for k in each])])
        asked = [{"chunk": chunk, "at": packed(at[a:b].astype(np.uint32))} for chunk, a, b in zip(f.chunk, edges[:-1], edges[1:], strict=True)]
        row = (int(f.block.iloc[0]), _delta(keys), packed(c), _delta(keys[more]), packed(c[more]), packed(np.bincount(iu, minlength=width)), packed(np.bincount(iw, minlength=width)), len(once), int((c == 2).sum()), asked)
        return pd.DataFrame([row], columns=["block", "keys", "counts", "keys2", "counts2", "once_u", "once_w", "n1", "n2", "asked"])

    words = replies.where("chunk is not null").select("chunk", "bucket", "ids", "counts")
    pairs = rows.select("chunk", "held", "lens", "words", "ids").groupBy("chunk").cogroup(words.groupBy("chunk")).applyInPandas(ask, "block int, chunk string, keys binary, counts binary")
    return pairs.groupBy("block").applyInPandas(count, BLOCKS)


@dataclass(frozen=True)
class Sweep:
    """What the driver knows of a sweep: the discounts, the parent's totals, the state of SPECIAL, and what it draws for the next sweep."""

    number: int
    discount: float
    parent_discount: float
    base: float
    customers: int
    tables: int
    special: tuple[float, float]  # tables of the begin context; probability of the end by the parent
    masses: float = 1.0  # of the parent's measure: the sum of all, before division
    rest: float = 0.0  # of that, the part without a table
    root: float = 1.0  # d g of the parent restaurant

    def parent(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        mass = (STRENGTH + self.parent_discount * self.tables) * self.base
        return (np.maximum(c - self.parent_discount * t, 0) + mass) / (STRENGTH + self.customers)


def _at_blocks(state: DataFrame, grid: int) -> DataFrame:
    """A state's slices, each for the blocks that need it."""
    other = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    return state.withColumn("_o", other).withColumn("block", F.when(F.col("kind") == "u", F.col("idx") * grid + F.col("_o")).otherwise(F.col("_o") * grid + F.col("idx")).cast("int")).drop("_o")


_BLOCK, _CONTEXTS, _WORDS, _ROOT, _DRIVER = range(5)  # what a draw is for


def _rng(seed: int, number: int, what: int, index: int = 0) -> np.random.Generator:
    return np.random.default_rng([seed, number, what, index])


def _drawn(block: int, keys2: np.ndarray, c2: np.ndarray, state: pd.DataFrame, last: Sweep, grid: int, seed: int) -> np.ndarray:
    """The tables of a block's pairs of two or more customers, given its slices of the sweep before."""
    iu, iw = _local(keys2, grid)
    by = {r.kind: r for r in state.itertuples(index=False)}
    contexts = restaurant_masses(unpacked(by["u"].a, np.int64), STRENGTH, last.discount, _rng(seed, last.number + 1, _CONTEXTS, int(by["u"].idx)))
    words = _measure(by["w"], last, seed) / last.masses + last.rest / last.masses * last.base
    return tables(c2, contexts[iu] * words[iw], last.discount, _rng(seed, last.number + 1, _BLOCK, block))


def _measure(row, last: Sweep, seed: int) -> np.ndarray:
    """The parent's measure of a slice's words, not yet divided by the sum of all."""
    return root_masses(unpacked(row.a, np.int64), unpacked(row.b, np.int64), last.parent_discount, _rng(seed, last.number + 1, _WORDS, int(row.idx)))


STATE = "kind string, idx int, a binary, b binary, sum_a long, sum_b long, ones long, twos long, special double, special_b double"
_STATE = ["kind", "idx", "a", "b", "sum_a", "sum_b", "ones", "twos", "special", "special_b"]


PARTS = "kind string, idx int, `from` int, part binary"


def _total(parts) -> np.ndarray:
    return sum((unpacked(b, np.int64) for b in parts), 0)


def _state(added: DataFrame, singles: DataFrame | None, last: Sweep | None, seed: int, grid: int) -> DataFrame:
    """Sum what blocks add for each slice (kind, idx, part); draw the tables of the parent's words."""

    def total(f: pd.DataFrame) -> pd.DataFrame:
        kind, idx = str(f.kind.iloc[0]), int(f.idx.iloc[0])
        a = _total(f["part"])
        b = np.minimum(a, 1)
        if kind == "w" and last is not None:
            b = tables(a, np.full(len(a), last.root * last.base), last.parent_discount, _rng(seed, last.number + 1, _ROOT, idx))
        special = idx == 0 and len(a) > 0
        return pd.DataFrame([(kind, idx, packed(a), packed(b), int(a.sum()), int(b.sum()), int((a == 1).sum()), int((a == 2).sum()), float(a[0]) if special else None, float(b[0]) if special else None)], columns=_STATE)

    def some(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(str(f.kind.iloc[0]), int(f.idx.iloc[0]), int(f["from"].iloc[0]), packed(_total(f["part"])))], columns=["kind", "idx", "from", "part"])

    step = FAN_IN
    while grid > step:  # as many rounds as the logarithm of the grid
        added = added.withColumn("from", F.expr(f"cast(`from` div {FAN_IN} as int)")).groupBy("kind", "idx", "from").applyInPandas(some, PARTS)
        step *= FAN_IN
    if singles is not None:
        added = added.unionByName(singles)
    return added.groupBy("kind", "idx").applyInPandas(total, STATE)


def _known(state: DataFrame, number: int, discount: float, parent_discount: float | None, base: float, seed: int) -> Sweep:
    """The totals of a state; parent_discount None: from its counts of counts."""
    row = {r.kind: r for r in state.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("sum_a", "sum_b", "ones", "twos", "special", "special_b")]).collect()}
    w, u = row.get("w"), row.get("u")
    if w is None:
        return Sweep(number, discount, 0.5, base, 0, 0, (0.0, base))
    d = parent_discount if parent_discount is not None else _discount(w.ones, w.twos)
    out = Sweep(number, discount, d, base, w.sum_a, w.sum_b, (u.special or 0.0, 0.0))
    end = float(out.parent(np.array([w.special or 0.0]), np.array([w.special_b or 0.0]))[0])

    def masses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"idx": f.idx, "mass": [float(_measure(r, out, seed).sum()) for r in f.itertuples(index=False)]})

    parts = state.where("kind = 'w'").select("idx", "a", "b").mapInPandas(masses, "idx int, mass double").collect()  # a number for each slice
    rng = _rng(seed, number + 1, _DRIVER)
    rest = float(rng.standard_gamma(STRENGTH + d * w.sum_b))
    root = float(restaurant_masses(np.array([float(w.sum_b)]), STRENGTH, d, rng)[0])
    return replace(out, special=(u.special or 0.0, end), masses=rest + sum(p.mass for p in sorted(parts)), rest=rest, root=root)


def _discount(ones: int, twos: int) -> float:
    """From counts of counts, kept inside (0, 1)."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones else 0.5


def sampled(pairs: DataFrame, size: Sizes, burn_in: int, samples: int, seed: int) -> tuple[list[DataFrame], list[Sweep]]:
    """The states after 0, 1, ... burn_in + samples sweeps, each stored."""
    grid = size.grid
    base = 1.0 / (size.vocab + 1)
    # pairs of one customer have one table always
    n = pairs.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
    discount = _discount(n.n1 or 0, n.n2 or 0)
    i, j = (F.col("block") / grid).cast("int"), (F.col("block") % grid).cast("int")

    def once(f: DataFrame) -> DataFrame:
        return f.select(F.explode(F.array(F.struct(F.lit("u").alias("kind"), i.alias("idx"), j.alias("from"), F.col("once_u").alias("part")), F.struct(F.lit("w").alias("kind"), j.alias("idx"), i.alias("from"), F.col("once_w").alias("part")))).alias("s")).select("s.*")

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                out += _sums(r.block, _undelta(r.keys2), None, grid, size.slice_len)
            yield pd.DataFrame(out, columns=["kind", "idx", "from", "part"])

    singles = stored(_state(once(pairs.select("block", "once_u", "once_w")), None, None, seed, grid).select("kind", "idx", F.lit(0).alias("from"), F.col("a").alias("part")), "singles")
    heavy = stored(pairs.select("block", "keys2", "counts2"), "heavy")
    states = [stored(_state(heavy.mapInPandas(begin, PARTS), singles, None, seed, grid), "state")]
    sweeps = [_known(states[0], 0, discount, None, base, seed)]
    for number in range(1, burn_in + samples + 1):
        near = _at_blocks(states[-1].select("kind", "idx", "a", "b"), grid)
        added = heavy.groupBy("block").cogroup(near.groupBy("block")).applyInPandas(_drawing(sweeps[-1], size, seed), PARTS)
        states.append(stored(_state(added, singles, sweeps[-1], seed, grid), "state"))
        sweeps.append(_known(states[-1], number, discount, sweeps[-1].parent_discount, base, seed))
    discard(singles, heavy)
    return states, sweeps


def _drawing(last: Sweep, size: Sizes, seed: int):
    """A sweep of the context restaurants: what each block's tables add to its slices."""

    def draw(block: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in block.itertuples(index=False):
            keys2 = _undelta(r.keys2)
            t = _drawn(int(r.block), keys2, unpacked(r.counts2, np.int64), state, last, size.grid, seed)
            out += _sums(r.block, keys2, t, size.grid, size.slice_len)
        return pd.DataFrame(out, columns=["kind", "idx", "from", "part"])

    return draw


def _by_bucket(grid: int, buckets: int):
    """Cut slices into the ids of each vocabulary bucket: every (buckets / grid)-th of a slice."""
    step = buckets // grid

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                a, b = unpacked(r.a, np.int64), unpacked(r.b, np.int64)
                out = [(r.number, r.kind, int(r.idx) + grid * k, packed(a[k::step]), packed(b[k::step])) for k in range(step)]
                yield pd.DataFrame(out, columns=["number", "kind", "bucket", "a", "b"])

    return run


def _slices(state: pd.DataFrame, sweep: Sweep) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the contexts, and the parent's predictive probabilities of the words, of two slices."""
    by = {r.kind: r for r in state.itertuples(index=False)}
    return unpacked(by["u"].a, np.int64), sweep.parent(unpacked(by["w"].a, np.int64), unpacked(by["w"].b, np.int64))


def _sums(block: int, keys2: np.ndarray, t: np.ndarray | None, grid: int, width: int) -> list[tuple]:
    iu, iw = _local(keys2, grid)
    weights = np.ones(len(keys2)) if t is None else t
    sums = [packed(np.bincount(at, weights=weights, minlength=width).astype(np.int64)) for at in (iu, iw)]
    i, j = int(block) // grid, int(block) % grid
    return [("u", i, j, sums[0]), ("w", j, i, sums[1])]


def scores(rows: DataFrame, replies: DataFrame, pairs: DataFrame, states: list[DataFrame], sweeps: list[Sweep], size: Sizes, burn_in: int, seed: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each text."""
    grid, buckets = size.grid, size.buckets
    kept = list(range(burn_in + 1, len(states)))
    numbered = [s.select(F.lit(k).alias("number"), "kind", "idx", "a", "b") for k, s in enumerate(states)]

    def union(ks: list[int]) -> DataFrame:
        out = numbered[ks[0]]
        for k in ks[1:]:
            out = out.unionByName(numbered[k])
        return out

    def pair_replies(block: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        """What joining a table weighs for each pair asked, averaged over the samples."""
        out = []
        for r in block.itertuples(index=False):
            keys, c = _undelta(r.keys), unpacked(r.counts, np.int64)
            more, t = c > 1, np.minimum(c, 1).astype(float)
            if more.any():
                t[more] = np.mean([_drawn(int(r.block), keys[more], c[more], state[state.number == k - 1], sweeps[k - 1], grid, seed) for k in kept], axis=0)
            weight = (c - sweeps[-1].discount * t).astype(np.float32)
            out += [(a["chunk"], "pair", int(r.block), packed(weight[unpacked(a["at"], np.uint32)]), b"") for a in r.asked]
        return pd.DataFrame(out, columns=["chunk", "kind", "part", "x", "y"])

    def word_replies(asked: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        """For the words asked: tables as contexts and the parent's probability, by sample; nothing for unknown words."""
        found = [_slices(state[state.number == k], sweeps[k]) for k in kept] if len(state) else []
        out = []
        for r in asked.itertuples(index=False):
            ids = unpacked(r.ids, np.uint32).astype(np.int64)
            at = (ids - 1) // buckets
            t = np.stack([np.where(ids > 0, u[at], 0) for u, _ in found] or [np.zeros(len(ids), np.int64) for _ in kept])
            p = np.stack([np.where(ids > 0, w[at], 0.0) for _, w in found] or [np.zeros(len(ids)) for _ in kept])
            out.append((r.chunk, "word", int(r.bucket), packed(t.astype(np.uint32).ravel()), packed(p.astype(np.float32).ravel())))
        return pd.DataFrame(out, columns=["chunk", "kind", "part", "x", "y"])

    answer = "chunk string, kind string, part int, x binary, y binary"
    words = replies.where("chunk is not null").select("chunk", "bucket", "ids", "counts")
    of_pairs = pairs.select("block", "keys", "counts", "asked").groupBy("block").cogroup(_at_blocks(union([k - 1 for k in kept]), grid).groupBy("block")).applyInPandas(pair_replies, answer)
    of_words = words.groupBy("bucket").cogroup(union(kept).mapInPandas(_by_bucket(grid, buckets), "number int, kind string, bucket int, a binary, b binary").groupBy("bucket")).applyInPandas(word_replies, answer)
    ids = words.select("chunk", F.lit("id").alias("kind"), F.col("bucket").alias("part"), F.col("ids").alias("x"), F.col("counts").alias("y"))
    all_replies = of_pairs.unionByName(of_words).unionByName(ids)
    base_total = size.train + size.vocab + 1
    unknown = np.array([float(sweeps[k].parent(np.zeros(1), np.zeros(1))[0]) for k in kept])

    def add_up(chunk: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in chunk.itertuples(index=False):
            named = got[got.kind == "id"].rename(columns={"part": "bucket", "x": "ids", "y": "counts"})
            ids, counts, order = _global(r, named, buckets)
            before, word, u, w = _sequence(r, ids)
            _, _, at = _pairs(u, w, grid)
            of_pair = got[got.kind == "pair"].sort_values("part")
            weight = np.concatenate([*[unpacked(b, np.float32) for b in of_pair.x], np.zeros(1, np.float32)]).astype(float)[at]
            of_word = got[got.kind == "word"].sort_values("part")
            n = len(kept)
            t, p = np.zeros((n, len(ids) + 1)), np.zeros((n, len(ids) + 1))
            if len(ids):
                t[:, order] = np.concatenate([unpacked(b, np.uint32).reshape(n, -1) for b in of_word.x], axis=1)
                p[:, order] = np.concatenate([unpacked(b, np.float32).reshape(n, -1) for b in of_word.y], axis=1)
                p[:, :-1] = np.where(ids > 0, p[:, :-1], unknown[:, None])
            t[:, -1], p[:, -1] = [sweeps[k].special[0] for k in kept], [sweeps[k].special[1] for k in kept]
            seen = np.append(counts, size.texts).astype(float)
            shared = np.mean([(STRENGTH + sweeps[k].discount * t[s][before]) * p[s][word] for s, k in enumerate(kept)], axis=0)
            logp = np.log10((weight + shared) / (STRENGTH + seen[before]))
            c = seen[word]
            lens = unpacked(r.lens, np.int64) + 1
            ends = np.cumsum(lens)
            cut = lambda x: np.add.reduceat(x, ends - lens)
            out.append(pd.DataFrame({"doc_id": pd.array([None if i is None or i != i else int(i) for i in r.doc_ids], dtype="Int64"), "held_out": np.array(r.held, dtype=bool), "n_tokens": lens, "n_known": cut((c > 0).astype(np.int64)), "train_tokens": size.train, "base_score": cut(np.log10((c + 1) / base_total)), "score": cut(logp)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    own = rows.select("chunk", "doc_ids", "held", "lens", "words", "ids").repartition(size.chunks, "chunk")
    all_replies = all_replies.repartition(size.chunks, "chunk")
    return own.groupBy("chunk").cogroup(all_replies.groupBy("chunk")).applyInPandas(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def scored(docs: DataFrame, held: Column, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """Learn from the texts of docs (doc_id, text) that are not held out, and score all of them."""
    rows = stored(chunks(docs.select("doc_id", "text", held.alias("held"))), "chunks")
    n = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_train", "n_texts", "n_distinct")], F.count("*").alias("n_chunks")).first()
    grid = max(1, int(np.ceil(np.sqrt(n.n_tokens / BLOCK_TOKENS))))
    buckets = grid * max(1, int(np.ceil(n.n_distinct / BUCKET_WORDS / grid)))
    replies = stored(vocabulary(rows, buckets), "vocabulary")
    v = replies.where("chunk is null").agg(F.sum("v").alias("v"), F.max("top").alias("top")).first()
    size = Sizes(n.n_tokens, n.n_texts, n.n_train, (v.v or 0) + (n.n_texts > 0), grid, buckets, max(v.top or 0, 2), max(n.n_chunks, 1))
    pairs = stored(blocks(rows, replies, size), "blocks")
    states, sweeps = sampled(pairs, size, burn_in, samples, seed)
    return scores(rows, replies, pairs, states, sweeps, size, burn_in, seed)


def perplexity(scores_: DataFrame) -> DataFrame:
    """held_out, n_texts, n_tokens and the perplexity of what scored() gives: of the averaged predictive probabilities, ends included."""
    out = scores_.groupBy("held_out").agg(F.count("*").alias("n_texts"), F.sum("n_tokens").alias("n_tokens"), F.sum("score").alias("s"))
    return out.select("held_out", "n_texts", "n_tokens", F.pow(F.lit(10.0), -F.col("s") / F.col("n_tokens")).alias("perplexity"))


def op1_pitman_yor(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)
