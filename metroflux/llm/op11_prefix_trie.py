"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn's id is a 128-bit digest of its role and text, with the words of the text
beside it.  Each conversation is cut into blocks of ``COLUMNS`` turns, one column a
position.  ``GROUP BY block, prior node, ROLLUP(t1 .. tK)`` then counts every
prefix of every block at once; ``grouping_id`` tells how deep a group reaches.  A
block is keyed by the node its conversation had reached before it: the exclusive-or
of hashes of (position, turn id), which is associative, so it is found by running
aggregates and no conversation is ever gathered.

Sums over subtrees take a second ROLLUP over the nodes.  What lies in later blocks
is first summed per block and carried to the block's node by doubling: after k
rounds a block's node knows the 2**k levels of blocks below it.  A conversation of
L turns takes log2(L / COLUMNS) rounds, none where all fit in one block.

Scale: the rows are numbered by a range sort with partition offsets, so one
conversation may hold any share of them; all groupings combine before they
shuffle.  The ids that end at a node are packed into strings of ``PACK`` in range
order and only those strings meet in the node's task, which hashes them as a
stream (a digest of one sequence cannot be split).

Defined results: NULL turns come first, equal turns are ordered by the digest of
their role and text; a repeated row is a turn of its own; NULL role or text is
empty; rows with a NULL conversation id belong to no conversation and are left
out; an empty table gives no rows, not even a root; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflux.llm.common import stage

COLUMNS = 8
#: Blocks of a conversation numbered together by one window.
SPAN = 4096
#: Ids joined to one string before a node's ids meet.
PACK = 4096
FAMILY, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"


def partitions(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, t): every turn's place in its conversation and its id, ``t`` = (a, b, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    turns = stage(conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.struct(half(1).alias("a"), half(17).alias("b"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t")), "trie-turns")
    order = ["conv_id", "turn", "t", "row"]  # the row number only spreads equal rows; NULL turns sort first
    ranked = stage(turns.withColumn("row", F.monotonically_increasing_id())
                   .repartitionByRange(partitions(turns), *order).sortWithinPartitions(*order)
                   .select("conv_id", "t", F.monotonically_increasing_id().alias("at")), "trie-order")
    part = F.shiftright("at", 33)
    pieces = ranked.groupBy("conv_id", part.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    starts = pieces.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"))
    return (ranked.withColumn("part", part).join(starts, ["conv_id", "part"])
            .select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "t"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, t) of the rebuilt conversations; a row of position 0 without turn stands for each conversation.

    The first h turns of conversation c are those of the first of its family of 20, h = crc32(c) % 4.
    """
    family = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    heads = (turns.where((F.col("pos") < HEADS) & (F.col("conv_id") == family)).groupBy(F.col("conv_id").alias("family"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "t"))).alias("heads")))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    rows = turns.withColumn("family", family).join(heads, "family", "left").withColumn("h", h)
    taken = F.when(F.col("h") > 0, F.slice(F.coalesce("heads", F.array().cast("array<struct<pos:bigint,t:struct<a:bigint,b:bigint,words:int>>>")),
                                           F.lit(1), F.greatest("h", F.lit(1)))).otherwise(F.array().cast("array<struct<pos:bigint,t:struct<a:bigint,b:bigint,words:int>>>"))
    row = lambda pos, t: F.struct(pos.cast("long").alias("pos"), t.alias("t"))
    nothing = F.lit(None).cast("struct<a:bigint,b:bigint,words:int>")
    opening = F.when(F.col("pos") == 1, F.concat(F.array(row(F.lit(0), nothing)), F.transform("taken", lambda x: row(x["pos"], x["t"]))))
    own = F.when(F.col("pos") > F.col("h"), F.array(row(F.col("pos") - F.col("h") + F.size("taken"), F.col("t"))))
    empty = F.array().cast("array<struct<pos:bigint,t:struct<a:bigint,b:bigint,words:int>>>")
    return (rows.withColumn("taken", taken)
            .select("conv_id", F.explode(F.concat(F.coalesce(opening, empty), F.coalesce(own, empty))).alias("row"))
            .select("conv_id", "row.pos", "row.t"))


def term(pos: Column, t: Column, k: int) -> Column:
    """A hash of a turn at its place; 0 where there is none.  A node's key is the exclusive-or over its turns, for k = 0 and 1."""
    return F.when(t.isNotNull(), F.xxhash64(F.lit(k), pos.cast("long"), t["a"], t["b"])).otherwise(F.lit(0).cast("long"))


def names() -> list[str]:
    return [f"t{k}" for k in range(1, COLUMNS + 1)]


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, t1 .. tK, xa, xb, n, pa, pb): a conversation's turns by block, with the key of the node before it."""
    slot, block = F.pmod(F.col("pos") - 1, F.lit(COLUMNS)) + 1, F.greatest(F.floor((F.col("pos") - 1) / COLUMNS), F.lit(0))
    cut = (turns.groupBy("conv_id", block.cast("long").alias("block"))
           .agg(*[F.max(F.when(slot == k, F.col("t"))).alias(name) for k, name in enumerate(names(), 1)],
                F.bit_xor(term(F.col("pos"), F.col("t"), 0)).alias("xa"), F.bit_xor(term(F.col("pos"), F.col("t"), 1)).alias("xb"),
                F.count("t").alias("n")).withColumn("span", F.floor(F.col("block") / SPAN)))
    xors = lambda w, names=("xa", "xb"): [F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long")) for c in names]
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Spans of blocks first, so that no window numbers a whole conversation of millions of turns.
    spans = cut.groupBy("conv_id", "span").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"))
    ca, cb = xors(Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.select("conv_id", "span", ca.alias("ca"), cb.alias("cb")).where("span > 0")
    pa_, pb_ = xors(earlier.partitionBy("conv_id", "span"))
    return (cut.withColumns({"pa": pa_, "pb": pb_}).join(carried, ["conv_id", "span"], "left")
            .withColumns({"pa": F.col("pa").bitwiseXOR(F.coalesce("ca", F.lit(0).cast("long"))),
                          "pb": F.col("pb").bitwiseXOR(F.coalesce("cb", F.lit(0).cast("long")))}).drop("ca", "cb", "span"))


def rolled_up(df: DataFrame, measures: str) -> DataFrame:
    """``measures`` of every prefix of every block, with ``level`` (columns of the prefix) and ``last`` (its last turn).

    Conversations that end inside a block give groups of NULL turns; they are dropped.  The empty prefix is kept
    in block 0 only: that of a later block is the last node of the block before.
    """
    t = ", ".join(names())
    groups = df.sparkSession.sql(f"SELECT block, pa, pb, {t}, cast({COLUMNS} - bit_count(grouping_id()) AS int) AS level, {measures} "
                                 f"FROM {{df}} GROUP BY block, pa, pb, ROLLUP({t})", df=df)
    last = functools.reduce(lambda c, k: c.when(F.col("level") == k, F.col(f"t{k}")), range(2, COLUMNS + 1),
                            F.when(F.col("level") == 1, F.col("t1")))
    return groups.withColumn("last", last).where("last is not null or (level = 0 and block = 0)")


def trie_nodes(cut: DataFrame) -> DataFrame:
    """Every node: depth, its key (ka, kb), its parent's (ua, ub), members, smallest member, words of its last text."""
    groups = rolled_up(cut, "count(*) AS n_convs, min(conv_id) AS conv_id")
    at = lambda k: F.col("block") * COLUMNS + k
    path = lambda k: functools.reduce(lambda c, i: c.bitwiseXOR(term(at(i), F.col(f"t{i}"), k)), range(1, COLUMNS + 1),
                                      F.col("pb" if k else "pa"))
    depth = at(F.col("level"))
    keyed = groups.withColumns({"depth": depth.cast("long"), "ka": path(0), "kb": path(1),
                                "words": F.coalesce(F.col("last.words"), F.lit(0)).cast("long")})
    return keyed.withColumns({"ua": F.col("ka").bitwiseXOR(term(depth, F.col("last"), 0)),
                              "ub": F.col("kb").bitwiseXOR(term(depth, F.col("last"), 1))}).drop("last")


def below_blocks(nodes: DataFrame) -> DataFrame:
    """(depth, ka, kb, saved, leaves): sums over all that lies below each node at which a further block begins."""
    totals = (nodes.where("block > 0").groupBy("block", "pa", "pb").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
              .select((F.col("block") * COLUMNS).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"), "saved", "leaves"))
    above = nodes.where(F.col("level") == COLUMNS).select("depth", "ka", "kb", (F.col("block") * COLUMNS).alias("up"), "pa", "pb")
    sums = stage(totals.join(above, ["depth", "ka", "kb"]), "trie-blocks")
    deepest = sums.agg(F.max("depth")).first()[0]
    for _ in range(math.ceil(math.log2(deepest / COLUMNS)) if deepest else 0):
        held = sums.where("up > 0")  # the root is reached without a further jump
        gain = (held.groupBy(F.col("up").alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
                .agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves")))
        jump = sums.select(F.col("depth").alias("up"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                           F.col("up").alias("up2"), F.col("pa").alias("pa2"), F.col("pb").alias("pb2"))
        sums = stage(sums.join(gain, ["depth", "ka", "kb"], "left").join(jump, ["up", "pa", "pb"], "left")
                     .select("depth", "ka", "kb", (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
                             (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                             F.coalesce("up2", F.lit(0)).cast("long").alias("up"),
                             F.coalesce("pa2", F.lit(0)).cast("long").alias("pa"),
                             F.coalesce("pb2", F.lit(0)).cast("long").alias("pb")), "trie-jump")
    return sums.select("depth", "ka", "kb", "saved", "leaves")


KEY = ["depth", "ka", "kb"]


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """(key, values of the fourth column) of successive rows of one key; a long run comes in several."""
    for batch in batches:
        d, a, b, v = (c.to_pylist() for c in batch.columns[:4])
        start = 0
        for i in range(1, len(d) + 1):
            if i == len(d) or (d[i], a[i], b[i]) != (d[start], a[start], b[start]):
                yield (d[start], a[start], b[start]), v[start:i]
                start = i


def ending_digests(ends: DataFrame) -> DataFrame:
    """(depth, ka, kb, ends_sha256) of the nodes at which conversations end; ``ends`` has the node's key and conv_id."""
    def packed(batches):
        for key, ids in runs_of(batches):
            for i in range(0, len(ids), PACK):
                some = ids[i:i + PACK]
                yield pa.RecordBatch.from_pydict({"depth": [key[0]], "ka": [key[1]], "kb": [key[2]], "ids": [",".join(map(str, some))],
                                                  "first": [some[0]]})

    def gathered(batches):
        """Few rows a batch cost more than the rows: batches of about a thousand."""
        held, n = [], 0
        for batch in packed(batches):
            held.append(batch)
            n += 64 + len(batch.column(3)[0].as_py())
            if len(held) >= 1024 or n > 1 << 22:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def digests(batches):
        key, running, rows = None, None, []
        for now, strings in runs_of(batches):
            if now != key:
                if key is not None:
                    rows.append((*key, running.hexdigest()))
                key, running = now, hashlib.sha256()
                running.update(strings[0].encode())
                strings = strings[1:]
            for s in strings:
                running.update(b"," + s.encode())
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pydict(dict(zip((*KEY, "ends_sha256"), map(list, zip(*rows)))))
                rows = []
        if key is not None:
            rows.append((*key, running.hexdigest()))
            yield pa.RecordBatch.from_pydict(dict(zip((*KEY, "ends_sha256"), map(list, zip(*rows)))))

    strings = (ends.select(*KEY, "conv_id").repartitionByRange(partitions(ends), *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
               .mapInArrow(gathered, "depth long, ka long, kb long, ids string, first long"))
    return (strings.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(digests, "depth long, ka long, kb long, ends_sha256 string"))


def trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie of ``turns`` (conv_id, pos, t; position 0 stands for the conversation itself)."""
    cut = stage(blocks(turns), "trie-cut")
    nodes = stage(trie_nodes(cut), "trie-nodes")
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("ka"), F.col("ub").alias("kb"))
                .agg(F.count("*").alias("n_children")))
    own = stage(nodes.join(children, KEY, "left")
                .withColumns({"n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
                              "leaf": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
                              "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-own")
    later = below_blocks(own).withColumnsRenamed({"saved": "later", "leaves": "later_leaves"})
    whole = (own.join(later, KEY, "left")
             .withColumns({"saved": F.col("saved") + F.coalesce("later", F.lit(0)), "leaf": F.col("leaf") + F.coalesce("later_leaves", F.lit(0)),
                           "me": F.struct("depth", "ka", "kb", "ua", "ub", "conv_id", "n_convs", "n_children")})
             .withColumnRenamed("level", "own_level"))
    # The node itself is the shallowest of its group; all others lie below it.
    sums = rolled_up(whole, "min_by(me, own_level) AS me, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves")
    found = sums.select("me.*", "saved_tokens", "n_leaves")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("ua"), F.col("kb").alias("ub"), F.col("conv_id").alias("parent_conv_id"))
    ends = cut.groupBy("conv_id").agg(F.max(F.col("block") * COLUMNS + F.col("n")).alias("depth"), F.bit_xor("xa").alias("ka"),
                                      F.bit_xor("xb").alias("kb"))
    return (found.join(parents, ["depth", "ua", "ub"], "left").join(ending_digests(ends), KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_tokens").cast("long").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of the conversations as they are, not rebuilt."""
    turns = numbered_turns(conversations, **columns)
    start = turns.where("pos = 1").select("conv_id", F.lit(0).cast("long").alias("pos"),
                                          F.lit(None).cast("struct<a:bigint,b:bigint,words:int>").alias("t"))
    return trie(turns.union(start))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """Query op11: the trie of the rebuilt conversations."""
    return trie(rebuilt(numbered_turns(conversations)))
