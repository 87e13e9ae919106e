"""Prefix tries of conversations: which turns conversations share, and the tokens that sharing saves.

A node is a distinct sequence of first turns, known by a chained digest of its turns; a conversation's turns are read in order as a
stream, so one of any length needs no memory. Identical nodes are one entry before anything is dealt out: thousands of copies
of a conversation are one path. Entries are hash-partitioned by the digest of their first turn; a task builds a trie of
pointers in a dictionary for several first turns and walks it in postorder, without recursion.

A subtrie of over ``limit`` entries is split: the turns that all its conversations share, up to where they part, are its spine, and the
subtries below are dealt out anew by the next turn, again and again where they are still too large. The spine is then summed up from the
tops of the subtries, deepest round first. The root is the spine above all first turns. So a third of all
conversations may share their first turns, and no task holds more than a bounded number of entries.

The ids of the conversations that end in a node are hashed as a sorted stream.

Cases: a null role or text is empty; rows without a conv_id belong to no conversation; turns are ordered by turn (null first), then role and
text, so ties and repeated rows are in a defined order, each a turn of its own; empty and very long texts are turns
like any others; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reciprospark.llm.common import record, stored, table

#: Entries of a subtrie that one task builds whole, and of all the subtries of a task on average.
LIMIT, TARGET = 20_000, 20_000
#: Conversations of a block share the turns of the block's first one.
BLOCK, MOST_SHARED = 20, 3
#: The node of no turns.
ROOT = b""
NO_ONE = hashlib.sha256(b"").hexdigest()


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, k (1, 2, ... in order), digest (of role and text) and words (of text) of each turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    whole = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select("conv_id", place.alias("k"), F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def shared(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turns in which each conversation begins with up to MOST_SHARED turns of its block's first, in place of its own. turns: conv_id, k, digest, words."""
    block = F.col("conv_id") - F.col("conv_id") % BLOCK
    asks = turns.select("conv_id").distinct().where(shared(F.col("conv_id")) > 0).select(block.alias("lead"), F.col("conv_id").alias("member"))
    first = turns.where((F.col("k") <= MOST_SHARED) & (F.col("conv_id") % BLOCK == 0)).withColumnRenamed("conv_id", "lead")
    given = first.join(asks, "lead").where(F.col("k") <= shared(F.col("member")))
    own = turns.where(F.col("k") > shared(F.col("conv_id")))
    return own.select("conv_id", "k", "digest", "words").union(given.select(F.col("member").alias("conv_id"), "k", "digest", "words"))


def chained(turns: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, depth, node (of the turns up to it), parent, top (the node of depth 1), words and last (whether the conversation ends there)."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), *[(n, pa.binary()) for n in ("node", "parent", "top")], ("words", pa.int64()), ("last", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, node, top, held = None, 0, ROOT, ROOT, None  # the last turn waits for what follows it
        for batch in batches:
            out = []
            for c, digest, words in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "digest", "words")), strict=True):
                if held is not None:
                    out.append((*held, c != conv))
                depth, parent = (depth + 1, node) if c == conv else (1, ROOT)
                node = hashlib.blake2b(parent + digest, digest_size=16).digest()
                conv, top = c, node if depth == 1 else top
                held = (c, depth, node, parent, top, words)
            yield record(schema, [[x[k] for x in out] for k in range(7)])
        if held is not None:
            yield record(schema, [[x] for x in (*held, True)])

    rows = turns.select("conv_id", "k", "digest", "words").repartition("conv_id").sortWithinPartitions("conv_id", "k")
    return rows.mapInArrow(run, "conv_id long, depth long, node binary, parent binary, top binary, words long, last boolean")


def endings(rows: DataFrame) -> DataFrame:
    """node and ends_sha256 (of the ids, ascending, joined by commas) of the nodes that conversations end in. rows: node, conv_id."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if n == node:
                    digest.update(b",%d" % c)
                else:
                    done += [(node, digest.hexdigest())] if node is not None else []
                    node, digest = n, hashlib.sha256(b"%d" % c)
            yield record(schema, [[x[k] for x in done] for k in range(2)])
        if node is not None:
            yield record(schema, [[node], [digest.hexdigest()]])

    return rows.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, "node binary, ends_sha256 string")


#: Of a result; above is the parent's node, for the top of a subtrie only: the parent is in a spine then.
RESULT = ("node", "above", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
FIELDS = "node binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def walked(entries: pd.DataFrame) -> pd.DataFrame:
    """Results of whole subtries: a trie whose nodes point to places in the list of entries, walked in postorder."""
    place = {node: k for k, node in enumerate(entries["node"])}
    above = [place.get(parent, -1) for parent in entries["parent"]]
    children: list[list[int]] = [[] for _ in above]
    tops = []
    for k, up in enumerate(above):
        (children[up] if up >= 0 else tops).append(k)
    saved = ((entries["n_convs"] - 1) * entries["words"]).tolist()
    leaves = [0 if own else 1 for own in children]
    for top in tops:
        waiting = [(top, 0)]
        while waiting:
            k, done = waiting.pop()
            if done < len(children[k]):
                waiting += [(k, done + 1), (children[k][done], 0)]
            elif above[k] >= 0:  # all of its children are summed up
                saved[above[k]] += saved[k]
                leaves[above[k]] += leaves[k]
    ids = entries["conv_id"].tolist()
    out = entries[["node", "conv_id", "depth", "n_convs"]].copy()
    out["above"] = [parent if up < 0 else None for up, parent in zip(above, entries["parent"], strict=True)]
    out["parent_conv_id"] = pd.array([ids[up] if up >= 0 else None for up in above], dtype="Int64")
    out["n_children"], out["n_leaves"], out["saved_tokens"] = [len(own) for own in children], leaves, saved
    return out[list(RESULT)]


def tries(entries: DataFrame, target: int) -> DataFrame:
    """Results of entries whose subtries (column top) are whole and of a bounded size."""
    parts = max(1, -(-entries.count() // target))
    return entries.groupBy(F.pmod(F.xxhash64("top"), F.lit(parts)).alias("part")).applyInPandas(walked, FIELDS)


def _sums(below: DataFrame) -> DataFrame:
    """Of each node that is above tops of subtries: how many, their leaves and saved tokens."""
    return below.where("above is not null").groupBy("above").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))


def _spine(spine: DataFrame, below: DataFrame) -> DataFrame:
    """Results of the turns that a large subtrie's (top's) conversations share, from those of the subtries below, whose parent is the deepest of them."""
    along = Window.partitionBy("top").orderBy("depth")
    up = Window.partitionBy("top").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("top")
    last = F.col("depth") == F.col("parted") - 1
    rows = spine.join(_sums(below), spine.node == F.col("above"), "left").drop("above")
    first = F.lag("conv_id").over(along)
    return rows.select(
        "node", F.when(first.isNull(), F.col("parent")).alias("above"), "conv_id", "depth", first.alias("parent_conv_id"), "n_convs",
        F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"), F.coalesce(F.max("leaves").over(all_), F.lit(1)).alias("n_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("words") + F.coalesce("saved", F.lit(0))).over(up).alias("saved_tokens"),
    )  # fmt: skip


def nodes(turns: DataFrame, conversations: DataFrame, limit: int = LIMIT, target: int = TARGET) -> DataFrame:
    """Of each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, k, digest, words; conversations: the distinct conv_id, of which some may have no turns. Members begin with a node's
    turns; leaves are counted, and tokens ((n_convs - 1) times the words of a node's last turn) summed, over its subtree, itself included.
    """
    rows = stored(chained(turns), "turns")
    firsts = [F.first(c).alias(c) for c in ("depth", "parent", "top", "words")]
    left = stored(rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *firsts), "entries")
    small, spines = [], []
    while True:  # a round deals out subtries by the turn in which their conversations part
        large = stored(left.groupBy("top").agg(F.count("*").alias("size")).where(F.col("size") > limit).select("top"), "large")
        small.append(left.join(large, "top", "left_anti"))
        if large.isEmpty():
            break
        hot = left.join(large, "top")
        at = hot.groupBy("top", "depth").agg(F.count("*").alias("n")).groupBy("top").agg(F.min(F.when(F.col("n") > 1, F.col("depth"))).alias("at"), F.max("depth").alias("deepest"))
        hot = stored(hot.join(at.select("top", F.coalesce("at", F.col("deepest") + 1).alias("parted")), "top"), "hot")
        spines.append(hot.where("depth < parted"))
        below = rows.select("conv_id", F.col("depth").alias("parted"), F.col("node").alias("next"))
        left = stored(hot.where("depth >= parted").join(below, ["conv_id", "parted"]).drop("top", "parted").withColumnRenamed("next", "top"), "entries")
    results = [stored(tries(x, target), "tries") for x in small]
    found = results[-1]
    shared_turns = []
    for spine, of_round in zip(reversed(spines), reversed(results[:-1]), strict=True):  # the deepest first
        shared_turns.append(stored(_spine(spine, found), "spine"))
        found = of_round.unionByName(shared_turns[-1])
        results.append(shared_turns[-1])
    everyone = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = everyone.crossJoin(found.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))  # one row each
    null = F.lit(None)
    root = stored(root.select(
        F.lit(ROOT).alias("node"), null.cast("binary").alias("above"), "conv_id", F.lit(0).cast("long").alias("depth"), null.cast("long").alias("parent_conv_id"), "n_convs",
        "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    ), "root")  # fmt: skip
    parents = root.select(F.col("node").alias("above"), F.col("conv_id").alias("parent"))
    for x in shared_turns:
        parents = parents.union(x.select("node", "conv_id"))
    whole = root
    for x in results:
        whole = whole.unionByName(x.where("above is null")).unionByName(x.where("above is not null").join(parents, "above").withColumn("parent_conv_id", F.col("parent")).select(*RESULT))
    turnless = conversations.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = endings(rows.where("last").select("node", "conv_id").union(turnless))
    return whole.join(ends, "node", "left").select(*[c for c in RESULT if c not in ("node", "above")], F.coalesce("ends_sha256", F.lit(NO_ONE)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = stored(ordered(table(spark, sf_dir, "conversations")), "ordered")
    return nodes(rebuilt(turns), turns.where("k = 1").select("conv_id"))


ORACLE = r"""
with recursive o as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
    from conversations where conv_id is not null),
b as (select conv_id, unnest(list_transform(range(1, len(conv_id::varchar) + 1), lambda i: ascii((conv_id::varchar)[i]))) as byte, unnest(range(1, len(conv_id::varchar) + 1)) as i from (select distinct conv_id from o)),
x as (select conv_id, 0::bigint as i, 4294967295::bigint as crc from (select distinct conv_id from o)
    union all select x.conv_id, x.i + 1, list_reduce(list_concat([xor(x.crc, b.byte::bigint)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384)) from x join b on b.conv_id = x.conv_id and b.i = x.i + 1),
c as (select conv_id, xor(arg_max(crc, i), 4294967295) % 4 as h from x group by conv_id),
r as (select conv_id, k, role, text from o join c using (conv_id) where k > h
    union all select c.conv_id, k, role, text from c join o on o.conv_id = c.conv_id - c.conv_id % 20 and o.k <= c.h),
p as (select conv_id, text, list({'r': role, 't': text}) over (partition by conv_id order by k rows unbounded preceding) as path, count(*) over (partition by conv_id) as total from r
    union all select conv_id, '', [], (select count(*) from r where r.conv_id = c.conv_id) from c),
n as (select path, len(path) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(len(regexp_extract_all(text, '[^ 	-]+'))) as words,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (total = len(path)), '') as ends from p group by path),
kids as (select path[1 : depth - 1] as path, count(*) as n_children from n where depth > 0 group by all),
m as (select n.*, coalesce(n_children, 0) as n_children from n left join kids on n.path = kids.path),
a as (select path[1 : up] as path, sum((n_convs - 1) * case when depth > 0 then words else 0 end) as saved, count(*) filter (n_children = 0) as n_leaves
    from (select *, unnest(range(0, depth + 1)) as up from m) group by all)
select m.conv_id, m.depth::bigint as depth, q.conv_id as parent_conv_id, m.n_convs, m.n_children, a.n_leaves, a.saved::bigint as saved_tokens, sha256(m.ends) as ends_sha256
from m join a on m.path = a.path left join n q on m.depth > 0 and q.path = m.path[1 : m.depth - 1]
"""
