"""Quotation linking of messages, in DataFrame expressions only.

A line whose first characters are ">", with or without blanks between, is quoted; its level is the number of them. A
passage is a quoted line without its marks, lower-cased, its white space collapsed; it is joined by its md5, and its length, to
the first message of the conversation that wrote the same passage itself (level 0) in an earlier turn. The message that most
characters of the lowest level with links come from, the latest of equals, is the parent. A message without such a
link begins a thread; the others belong to their parent's. Conversations are ordered thread by thread, and by turn
within one, so a reply follows what it answers; texts lose their quoted lines.

Scale: the index has one row for each conversation and passage, so no pair of messages is ever made; it is summed up before
it is joined, by conversation and passage, so a line that every message has is no hot key; threads are found
by doubling steps of joins on (conversation, turn), never by collecting a conversation, as long as links are left.

Cases: null and empty texts have no lines (a null text stays null); very long texts are many lines, each a row; a null conv_id is a conversation like any other; a message of null turn
neither has a parent nor is one; rows that share (conv_id, turn) are one message for links (the least parent counts)
and are each returned; a passage without a source is counted but not linked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reciprospark.llm.common import fresh, stored, table

MARKS = r"^[ \t]*(>[ \t]*)+"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def passage(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, MARKS, "")), r"\s+", " "))


def lines(messages: DataFrame) -> DataFrame:
    """One row for each line with a passage: conv_id, turn, level, size, hash."""
    out = messages.select("conv_id", "turn", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    out = out.select("conv_id", "turn", level(F.col("line")).alias("level"), passage(F.col("line")).alias("passage"))
    return out.where("passage <> ''").select("conv_id", "turn", "level", F.length("passage").alias("size"), F.md5(F.col("passage").cast("binary")).alias("hash"))


def parents(messages: DataFrame) -> DataFrame:
    """conv_id, turn, parent (a turn) of the messages that have one."""
    all_lines = lines(messages.where("turn is not null"))
    quoted = all_lines.where("level > 0").groupBy("conv_id", "turn", "level", "hash", F.col("size").alias("length")).agg(F.sum("size").alias("size"))
    quoted = stored(quoted, "quoted")
    index = all_lines.where("level = 0").groupBy("conv_id", "hash", F.col("size").alias("length")).agg(F.min("turn").alias("parent"))
    key = F.xxhash64("conv_id", "hash").alias("_key")  # a first look; the join below is exact
    index = index.withColumn("_key", key).join(quoted.select(key).distinct(), "_key", "left_semi").drop("_key")
    index = index.withColumnsRenamed({"conv_id": "_conv", "hash": "_hash", "length": "_length"})
    linked = quoted.join(index, quoted.conv_id.eqNullSafe(index._conv) & (quoted.hash == index._hash) & (quoted.length == index._length) & (index.parent < quoted.turn))
    linked = linked.groupBy("conv_id", "turn", "level", "parent").agg(F.sum("size").alias("size"))
    best = F.min_by("parent", F.struct("level", -F.col("size"), -F.col("parent"))).alias("parent")
    return linked.groupBy("conv_id", "turn").agg(best)


def threads(links: DataFrame) -> DataFrame:
    """links with thread (the turn that the chain of parents ends at) and depth (its length)."""
    found = stored(links.select("conv_id", "turn", "parent", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = found.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("thread").alias("_thread"), F.col("depth").alias("_depth"))
        on = found.conv_id.eqNullSafe(up._conv) & (found.thread == up._turn)
        if found.join(up, on, "left_semi").isEmpty():
            return found
        more = found.join(up, on, "left")
        found = stored(more.select("conv_id", "turn", "parent", F.coalesce("_thread", "thread").alias("thread"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "threads")


def unquoted(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(MARKS)), "\n")


ADDED = ("parent", "thread", "depth", "n_quoted", "max_level")


def linked(messages: DataFrame) -> DataFrame:
    """messages with parent, thread, depth (0: begins a thread), n_quoted (lines), max_level, and text without quotes.

    Columns of messages with such names are replaced; others stay.
    """
    own = messages.select(*[c for c in messages.columns if c.lower() not in ADDED])
    conv, turn = (fresh(c, (*own.columns, *ADDED)) for c in ("conv_id", "turn"))
    found = threads(parents(own.select("conv_id", "turn", "text"))).withColumnsRenamed({"conv_id": conv, "turn": turn})
    levels = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), level)
    out = own.join(found, own.conv_id.eqNullSafe(found[conv]) & (own.turn == found[turn]), "left").drop(conv, turn)
    return out.withColumns({
        "thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0).cast("long")),
        "n_quoted": F.size(F.filter(levels, lambda x: x > 0)).cast("long"), "max_level": F.array_max(levels).cast("long"), "text": unquoted(F.col("text")),
    })


def conversations(messages: DataFrame) -> DataFrame:
    """linked(), in reply order: by conversation, thread and turn."""
    return linked(messages).orderBy("conv_id", "thread", "turn")


def op9_quote_links(spark, sf_dir: str) -> DataFrame:
    """In reply order."""
    found = conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return found.select("conv_id", "turn", "role", "parent", "thread", "depth", "n_quoted", "max_level", "text")


ORACLE = r"""
with recursive m as (select row_number() over () as r, conv_id, turn, role, text is null as nil, string_split(coalesce(text, ''), chr(10)) as ls from conversations),
l0 as (select r, conv_id, turn, unnest(ls) as line, unnest(range(len(ls))) as k from m),
l as (select r, conv_id, turn, k, line, length(regexp_replace(regexp_extract(line, '^[ \t]*(>[ \t]*)+'), '[^>]', '', 'g')) as level,
    trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*(>[ \t]*)+', '')), '\s+', ' ', 'g')) as p from l0),
i as (select conv_id, p, min(turn) as parent from l where level = 0 and p <> '' and turn is not null group by all),
q as (select l.conv_id, l.turn, level, i.parent, sum(length(l.p)) as size from l join i on l.conv_id is not distinct from i.conv_id and l.p = i.p and i.parent < l.turn where level > 0 group by all),
b as (select conv_id, turn, first(parent order by level, size desc, parent desc) as parent from q group by all),
t as (select conv_id, turn, parent, parent as thread, 1 as depth from b
    union all select t.conv_id, t.turn, t.parent, b.parent, depth + 1 from t join b on t.conv_id is not distinct from b.conv_id and t.thread = b.turn),
e as (select conv_id, turn, first(parent) as parent, min(thread) as thread, max(depth) as depth from t group by all),
s as (select r, count(*) filter (level > 0) as n_quoted, max(level) as max_level, coalesce(string_agg(line, chr(10) order by k) filter (level = 0), '') as own from l group by r)
select m.conv_id, m.turn, role, e.parent, coalesce(e.thread, m.turn) as thread, coalesce(e.depth, 0)::bigint as depth, n_quoted, max_level::bigint as max_level, case when not nil then own end as text
from m join s using (r) left join e on m.conv_id is not distinct from e.conv_id and m.turn = e.turn
"""
