"""A trie of conversations: what they share from their first turn on.

A node of depth d stands for a distinct sequence of d first turns (role and text);
its members are the conversations that begin with it, the root's all of them.

Method, a roll-up in bands of depth. Along each conversation a chained SHA-256
names its nodes, and a node learns the names of its ancestors within its band of
``height`` levels only. Sums over subtrees start within bands: a node explodes to
the ancestors in its band. The tops of the bands then form a trie of their own,
``height`` times lower, whose sums are found the same way, until one band holds
all of it. Back down, the completed total of each band's top goes to the ancestors
in the band above. A row explodes to at most ``height`` rows, and the rounds
grow with the logarithm of the depth, however long a conversation is.

Every sum is an aggregate with map-side combine, so the root and other common
nodes are few rows when they are shuffled. The conversations that end at a node
are joined to bounded pieces of text before these stream through one hash.

Order within a conversation: turn, NULL first; rows of one turn by SHA-256 of role
and text. Defined results: a NULL role or text is empty; rows without a
conversation id belong to no conversation and are left out; repeated rows are turns
each; a conversation without turns is a member of the root alone; without any
conversation there is no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.digests import run_digests
from tramline.llm.stored import parts_of, written

HEIGHT = 16
ROWS_OUT = 4096
ENDS_SPAN = 4096  # conversation ids joined to one piece of text

WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
ROOT = hashlib.sha256(b"").digest()
PATH_SCHEMA = "conv_id long, depth long, key binary, up array<array<binary>>, words long, ends long"


def turns(rows: DataFrame) -> DataFrame:
    """``conv_id, place, digest, words``: the turns of ``rows(conv_id, turn, role, text)``, numbered from 0.

    The texts themselves are not shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    known = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return known.withColumn("place", F.row_number().over(order).cast("long") - 1).drop("turn")


def regrown(known: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """All ids, and turns of which the first ``head`` are those of the conversation ``base``.

    ``known`` has the columns of ``turns``; ``base`` and ``head`` are functions of
    ``conv_id``. A conversation without the base keeps its turns from place ``head`` on.
    """
    convs = known.select("conv_id").distinct()
    convs = convs.select("conv_id", base.alias("base"), head.alias("head"))
    own = known.where(F.col("place") >= head)
    most = convs.agg(F.max("head")).first()[0] or 0
    heads = known.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    lent = convs.join(heads, "base").where("place < head").select(*known.columns)
    return convs.select("conv_id"), own.unionByName(lent)


def _paths(height: int):
    schema = pa.schema(
        [("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()),
         ("up", pa.list_(pa.list_(pa.binary()))), ("words", pa.int64()), ("ends", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, waits = [], None
        bands: list[list[bytes]] = []  # bands[l]: names at depths that height^l divides, since the last band began
        depth, key = 0, ROOT

        def above() -> list[list[bytes]]:
            """Ancestors on each level that the depth is on; the node then joins these levels itself."""
            out, level, at = [], 0, depth
            while True:
                if level == len(bands):
                    # the first node of a level but the root: the level begins with the root
                    bands.append([ROOT] if depth else [])
                out.append(list(bands[level]))
                if at % height == 0:
                    bands[level] = []
                bands[level].append(key)
                if at % height or depth == 0:
                    return out
                level, at = level + 1, at // height

        def table() -> pa.RecordBatch:
            columns = zip(*done) if done else [()] * len(schema)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        names = ("conv_id", "place", "digest", "words")
        for batch in batches:
            for conv_id, place, digest, words in zip(*(batch.column(n).to_pylist() for n in names)):
                if place < 0:
                    if waits is not None:
                        done.append((*waits, 1))
                    bands, depth, key = [], 0, ROOT
                else:
                    done.append((*waits, 0))
                    depth, key = depth + 1, hashlib.sha256(key + digest).digest()
                waits = (conv_id, depth, key, above(), words)
                if len(done) >= ROWS_OUT:
                    yield table()
                    done = []
        if waits is not None:
            done.append((*waits, 1))
        yield table()

    return run


def paths(convs: DataFrame, known: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A row for each conversation and node it is a member of; ``up[l]`` are the node's ancestors on level l."""
    starts = convs.select(
        "conv_id", F.lit(-1).cast("long").alias("place"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words")
    )
    rows = known.select("conv_id", "place", "digest", "words").unionByName(starts)
    rows = rows.repartition(parts_of(rows), "conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(_paths(height), PATH_SCHEMA)


def _totals(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("key").agg(*(F.sum(c).alias(c) for c in MEASURES))


MEASURES = ("n_leaves", "saved_tokens")


def roll_up(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``key, n_leaves, saved_tokens``: the measures of ``nodes(key, depth, up, …)``, summed over subtrees."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    level, step, values, within = 0, 1, nodes.select("key", "depth", "up", *MEASURES), []
    while True:
        at = F.expr(f"depth DIV {step}")
        inner = values.where(at % height != 0)
        inner = inner.select(F.explode(F.get("up", F.lit(level))).alias("key"), *MEASURES)
        within.append(written(_totals(values.select("key", *MEASURES), inner), "bands"))
        if deepest < step * height:
            break
        level, step = level + 1, step * height
        tops = nodes.where(F.col("depth") % step == 0).select("key", "depth", "up")
        values = tops.join(within[-1], "key")
    total = within[-1]
    for level in range(level - 1, -1, -1):
        tops = nodes.where((F.col("depth") % height ** (level + 1) == 0) & (F.col("depth") > 0))
        tops = tops.select("key", F.get("up", F.lit(level)).alias("up")).join(total, "key")
        lent = tops.select(F.explode("up").alias("key"), *MEASURES)
        total = written(_totals(within[level], lent), "bands")
    return total


def ends_of(members: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the ids of the conversations that end at a node, ascending, joined by commas."""
    last = members.where("ends = 1").select("key", "conv_id", F.expr(f"conv_id DIV {ENDS_SPAN}").alias("span"))
    pieces = last.groupBy("key", "span").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("key", "span", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ends_sha256"))
    ordered = pieces.repartition(parts_of(members), "key").sortWithinPartitions("key", "span")
    return run_digests(ordered, "key", {"ends_sha256": ","}).drop("n_rows")


def trie(convs: DataFrame, known: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes of the conversations ``convs(conv_id)`` with ``known(conv_id, place, digest, words)``.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``. A node saves the words of its last text for
    each member but one; ``n_leaves`` and ``saved_tokens`` are those of its subtree.
    """
    members = written(paths(convs, known, height), "members")
    nodes = members.groupBy("key", "depth", "up", "words").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends")
    )
    nodes = nodes.select(
        "key", "depth", "up", "conv_id", "n_convs", F.try_element_at(F.get("up", F.lit(0)), F.lit(-1)).alias("parent"),
        # a node is a leaf if all of its members end there
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    nodes = written(nodes, "nodes")
    totals = roll_up(nodes, height)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).count()
    out = nodes.select("key", "parent", "conv_id", "depth", "n_convs").join(totals, "key")
    out = out.join(children, "key", "left").join(ends_of(members), "key", "left")
    out = written(out, "trie")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(parents, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("count", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
