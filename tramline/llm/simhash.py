"""Near duplicates by SimHash fingerprints, linked through pivot distance tables.

A fingerprint bit is set if it is set in over half of the hashes of the
document's word shingles. Two fingerprints link if at most ``bits`` bits differ.

1. Equal fingerprints fold to one node, so copies never meet each other.
2. ``bits`` differing bits leave one of ``bits + 1`` blocks of the fingerprint
   untouched, so nodes meet in the groups of equal blocks. A group of over
   ``group_nodes`` nodes is split by the same rule on the bits that its block
   leaves open, as often as needed; this ends, as open bits run out.
3. In a group, the table of distances to ``pivots`` reference fingerprints is
   computed once per node. If any coordinate of two nodes differs by more than
   ``bits``, so do the nodes (triangle inequality). The first coordinate is
   sorted, so most pairs are never formed; the others discard pairs one
   coordinate after the other; the full distance is taken of the survivors.
4. A group sends one edge for each of its nodes but the first, not all pairs.
   Large and small stars join the groups' edges to components.

Defined results: a NULL, empty or blank text has fingerprint zero, linked like
any other. Rows with NULL ``doc_id`` get a fingerprint and a NULL component and
link to nothing. Rows that repeat a ``doc_id`` stand for one document with as
many texts: a component that any of them reaches joins all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import arrays
from tramline.llm.components import components
from tramline.session import scratch_dir

SHINGLE = 4
SEED = 42
BITS = 4
PIVOTS = 24
GROUP_NODES = 4096
CHUNK = 1 << 14
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
EDGE_SCHEMA = "a long, b long"
GROUP_SCHEMA = "mask long, block long, node long, fp long"


def fingerprint(text: bytes, size: int, seed: int = SEED) -> int:
    """The SimHash of one text, as an unsigned number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    step = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(step) - 1
    size = min(size, len(words))
    lo = (ends - step + 1)[: len(words) - size + 1].tolist()
    hi = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(lo), CHUNK):
        part = np.array([digest(joined[a:b], seed) for a, b in zip(lo[at : at + CHUNK], hi[at : at + CHUNK])], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(lo)).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in arrays.blocks(batch, "text"):
                raw = data.tobytes()
                found = [fingerprint(raw[a:b], size) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(rows.start, rows.stop - rows.start),
                        pa.array(np.array(found, np.uint64).view(np.int64)),
                    ],
                    names=["doc_id", "fp"],
                )

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed number) of each row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_fingerprints(size), "doc_id long, fp long")


def references(n: int) -> np.ndarray:
    """Reference fingerprints by rule: mixed multiples of an odd number."""
    return arrays.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(arrays.WORD_BASE))


def linked_labels(fps: np.ndarray, groups: np.ndarray, bits: int, pivots: int) -> np.ndarray:
    """The least position each position links to within its group, by any path.

    ``groups`` numbers the groups; positions of a group need not be adjacent.
    """
    n = len(fps)
    table = np.bitwise_count(fps[None, :] ^ references(pivots)[:, None]).astype(np.int16)
    order = np.lexsort((table[0], groups))
    fps, groups, table = fps[order], groups[order], table[:, order]
    label = np.arange(n)

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    left, lag = np.arange(n), 0
    while len(left):
        lag += 1
        left = left[left < n - lag]
        left = left[(groups[left] == groups[left + lag]) & (table[0, left + lag] - table[0, left] <= bits)]
        a = left[label[left] != label[left + lag]]
        for row in table[1:]:
            a = a[np.abs(row[a] - row[a + lag]) <= bits]
        a = a[np.bitwise_count(fps[a] ^ fps[a + lag]) <= bits]
        for i in a.tolist():
            x, y = root(i), root(i + lag)
            label[max(x, y)] = min(x, y)
        if len(a):
            while not np.array_equal(step := label[label], label):
                label = step
    least = np.full(n, n)
    np.minimum.at(least, label, order)
    out = np.empty(n, np.int64)
    out[order] = least[label]
    return out


def _group_edges(bits: int, pivots: int):
    """Edges of whole groups; rows come sorted by mask and block."""

    def edges(table: pa.Table) -> pa.RecordBatch:
        mask, block = np.asarray(table.column("mask")), np.asarray(table.column("block"))
        new = np.ones(len(mask), dtype=bool)
        new[1:] = (mask[1:] != mask[:-1]) | (block[1:] != block[:-1])
        fps, nodes = np.asarray(table.column("fp")).view(np.uint64), np.asarray(table.column("node"))
        to = linked_labels(fps, np.cumsum(new), bits, pivots)
        at = np.flatnonzero(to != np.arange(len(to)))
        return pa.record_batch([pa.array(nodes[at]), pa.array(nodes[to[at]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, block = np.asarray(batch.column("mask")), np.asarray(batch.column("block"))
            other = np.flatnonzero((mask != mask[-1]) | (block != block[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            last = held[-1] if held else None
            if cut:
                yield edges(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            elif last and (last.column("mask")[0].as_py(), last.column("block")[0].as_py()) != (mask[0], block[0]):
                yield edges(pa.Table.from_batches(held))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield edges(pa.Table.from_batches(held))

    return run


def split_masks(mask: int, bits: int) -> list[int]:
    """``bits + 1`` masks: ``mask`` and one block each of the bits it leaves open."""
    open_bits = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in part) for part in np.array_split(open_bits, bits + 1) if len(part)]


def _split(bits: int):
    """Each node once for each block of the bits that its mask leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks: dict[int, np.ndarray] = {}
        for batch in batches:
            node, fp, mask = (np.asarray(batch.column(c)) for c in ("node", "fp", "mask"))
            for m in np.unique(mask).tolist():
                if m not in masks:
                    masks[m] = np.array(split_masks(m & (1 << 64) - 1, bits), np.uint64).view(np.int64)
                at = mask == m
                for part in masks[m]:
                    columns = [np.full(int(at.sum()), part), fp[at] & part, node[at], fp[at]]
                    yield pa.record_batch([pa.array(c) for c in columns], names=["mask", "block", "node", "fp"])

    return run


def links(nodes: DataFrame, bits: int = BITS, pivots: int = PIVOTS, group_nodes: int = GROUP_NODES) -> DataFrame:
    """Edges ``a, b`` between nodes ``(node, fp)`` of distinct fingerprints.

    They connect all nodes that a path of links of at most ``bits`` bits connects.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out, rows = None, nodes.withColumn("mask", F.lit(0).cast("long"))
    while True:
        path = scratch_dir(spark, "groups")
        rows = rows.select("node", "fp", "mask").mapInArrow(_split(bits), GROUP_SCHEMA)
        sizes = rows.groupBy("mask", "block").agg(F.count("*").alias("n")).where("n > 1")
        rows.join(sizes, ["mask", "block"]).select(
            "mask", "block", "node", "fp", (F.col("n") > group_nodes).alias("large")
        ).write.partitionBy("large").parquet(path)
        held = spark.read.schema(GROUP_SCHEMA + ", large boolean").parquet(path)
        found = (
            held.where("NOT large")
            .drop("large")
            .repartition(parts, "mask", "block")
            .sortWithinPartitions("mask", "block")
            .mapInArrow(_group_edges(bits, pivots), EDGE_SCHEMA)
        )
        out = found if out is None else out.unionByName(found)
        rows = held.where("large")
        if rows.isEmpty():
            return out


def near_duplicates(docs: DataFrame, size: int = SHINGLE, bits: int = BITS, **how) -> DataFrame:
    """``doc_id, fingerprint, component_id, n_linked`` of each row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` that links reach, ``n_linked``
    the number of other rows of the component.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "fingerprints")
    # Written: the texts are read once, and the rest works on 16 bytes a row.
    fingerprints(docs, size).write.parquet(path)
    prints = spark.read.schema("doc_id long, fp long").parquet(path)
    known = prints.where("doc_id IS NOT NULL")
    nodes = known.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("rows"))
    home = scratch_dir(spark, "nodes")
    nodes.write.parquet(home)
    nodes = spark.read.schema("fp long, node long, rows long").parquet(home)
    edges = links(nodes.select("node", "fp"), bits, **how)
    # A repeated doc_id ties its texts together.
    repeated = known.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    own = known.join(repeated.select("doc_id"), "doc_id").join(nodes, "fp")
    edges = edges.unionByName(own.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    stars = components(edges).select(F.col("a").alias("node"), F.col("b").alias("least"))
    reached = (
        nodes.join(stars, "node", "left")
        .select("fp", "rows", F.coalesce("least", "node").alias("component_id"))
    )
    counts = reached.groupBy("component_id").agg((F.sum("rows") - 1).alias("n_linked"))
    reached = reached.join(counts, "component_id").select("fp", "component_id", "n_linked")
    found = known.join(reached, "fp").select("doc_id", "fp", "component_id", "n_linked")
    alone = prints.where("doc_id IS NULL").select(
        "doc_id", "fp", F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_linked")
    )
    return found.unionByName(alone).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_linked"
    )
