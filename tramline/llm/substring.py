"""Removing passages that an earlier document has already said.

Method: sparse suffix trees, partitioned by prefix. A window is ``window``
consecutive words. Of the suffixes that start in a window, the one whose first
``prefix`` words hash least is its anchor, so equal windows have equal anchors
at equal places, and only about one suffix in eighteen is an anchor.

1. Anchor prefixes that occur in one document only are dropped.
2. Documents that hold repeated prefixes send, for each such anchor, the words
   of the windows it stands for to the group of its prefix.
3. Groups are built into suffix trees down to the depth of the window. An inner
   node as deep as the window is a repeat; its smallest document keeps it.
4. A prefix with more suffixes than fit in memory (``group_rows``) is made
   longer: first to all words an anchor stands for, where equal ones fold to
   the smallest document's, then, for what is left, to the whole window. At
   that length a subtree is a single node, so a minimum by key, combined before
   the shuffle, replaces the tree.

Texts are compared by their words in the trees and by 128 bits of hash in
step 4; no other decision rests on a hash. A third of all documents may share
a passage: its prefix goes the way of step 4, where nothing is gathered.

Defined results: a NULL text has no words. A row without ``doc_id`` is returned
as it is and compared with nothing. Rows that repeat a ``doc_id`` are judged
one by one and never against each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import arrays
from tramline.session import scratch_dir

WINDOW = 50
PREFIX = 16
GROUP_ROWS = 16_384

ANCHOR_SCHEMA = "doc_id long, prefix long, times long"
CHUNK_SCHEMA = "prefix long, doc_id long, version long, at long, words string"
HOT_SCHEMA = "h1 long, h2 long, doc_id long, version long, at array<long>, w1 array<long>, w2 array<long>"
SPANS = "array<struct<lo: bigint, hi: bigint>>"
RUN_SCHEMA = f"doc_id long, version long, spans {SPANS}"
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def anchors_of(hashes: np.ndarray, offsets: np.ndarray, window: int, prefix: int):
    """Runs of windows with one anchor: text, first and last window, hash of the prefix.

    Windows are word positions in the block. Ties go to the leftmost suffix.
    """
    grams = arrays.gram_hashes(hashes, prefix)
    reach = window - prefix + 1
    count = np.maximum(np.diff(offsets) - window + 1, 0)
    starts = arrays.ranges(offsets[:-1], count)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least, where, span = grams, np.arange(len(grams)), 1
    while span * 2 <= reach:
        take = least[:-span] <= least[span:]
        where = np.where(take, where[:-span], where[span:])
        least, span = grams[where], span * 2
    left, right = starts, starts + reach - span
    at = np.where(least[left] <= least[right], where[left], where[right])
    text = np.repeat(np.arange(len(count)), count)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return text[first], starts[first], starts[last], grams[at[first]]


def _anchors(window: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"))
            for rows, data, offsets in arrays.blocks(batch, "text"):
                starts, ends, words = arrays.find_words(data, offsets)
                hashes = arrays.word_hashes(data, starts, ends)
                text, _, _, key = anchors_of(hashes, words, window, prefix)
                order = np.lexsort((key, text))
                text, key = text[order], key[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1])
                at = np.flatnonzero(new)
                yield pa.record_batch(
                    [
                        pa.array(ids[rows][text[at]]),
                        pa.array(key[at].view(np.int64)),
                        pa.array(np.diff(np.append(at, len(text)))),
                    ],
                    names=["doc_id", "prefix", "times"],
                )

    return run


def _repeated_runs(batch: pa.RecordBatch, hot: bool, window: int, prefix: int):
    """The runs of windows whose anchor is among the row's repeated prefixes."""
    marks = batch.column("marks")
    at = np.asarray(marks.offsets)
    struct = marks.values
    keys = np.asarray(struct.field("prefix"))
    wanted = np.asarray(struct.field("hot")).astype(bool) == hot
    for rows, data, offsets in arrays.blocks(batch, "text"):
        starts, ends, words = arrays.find_words(data, offsets)
        hashes = arrays.word_hashes(data, starts, ends)
        text, first, last, key = anchors_of(hashes, words, window, prefix)
        key = key.view(np.int64)
        border = np.searchsorted(text, np.arange(len(words)))
        keep = np.zeros(len(text), dtype=bool)
        for i in range(rows.start, rows.stop):
            own = keys[at[i] : at[i + 1]][wanted[at[i] : at[i + 1]]]
            part = slice(border[i - rows.start], border[i - rows.start + 1])
            keep[part] = np.isin(key[part], own)
        if keep.any():
            yield rows.start, data, starts, ends, words, text[keep], first[keep], last[keep], key[keep]


def _chunks(window: int, prefix: int):
    """For the trees: the words of the windows of each repeated anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for at, data, starts, ends, words, text, first, last, key in _repeated_runs(batch, False, window, prefix):
                raw = data.tobytes()
                held = [
                    b" ".join(raw[starts[f] : ends[z + window - 1]].split()).decode()
                    for f, z in zip(first.tolist(), last.tolist())
                ]
                rows = pa.array(text + at)
                yield pa.record_batch(
                    [
                        pa.array(key),
                        ids.take(rows),
                        versions.take(rows),
                        pa.array(first - words[text]),
                        pa.array(held, pa.string()),
                    ],
                    names=["prefix", "doc_id", "version", "at", "words"],
                )

    return run


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _hot_chunks(window: int, prefix: int):
    """For longer prefixes: a 128-bit hash of what each anchor stands for, and of its windows.

    Equal ones of one text share a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h1", "h2", "doc_id", "version", "at", "w1", "w2"]
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for base, data, starts, ends, words, text, first, last, _ in _repeated_runs(batch, True, window, prefix):
                raw = data.tobytes()
                places: dict[tuple[int, bytes], list[int]] = {}
                held: dict[bytes, list[bytes]] = {}
                for t, f, z in zip(text.tolist(), first.tolist(), last.tolist()):
                    parts = raw[starts[f] : ends[z + window - 1]].split()
                    digest = xxhash.xxh3_128_digest(b" ".join(parts))
                    places.setdefault((t, digest), []).append(f - int(words[t]))
                    if digest not in held:
                        held[digest] = [
                            xxhash.xxh3_128_digest(b" ".join(parts[i : i + window])) for i in range(z - f + 1)
                        ]
                keys = list(places)
                for lo in range(0, len(keys), 1 << 14):
                    part = keys[lo : lo + (1 << 14)]
                    both = _halves([d for _, d in part])
                    inner = _halves([w for _, d in part for w in held[d]])
                    at = np.concatenate([[0], np.cumsum([len(held[d]) for _, d in part])]).astype(np.int32)
                    rows = pa.array([base + t for t, _ in part], pa.int64())
                    yield pa.record_batch(
                        [
                            pa.array(both[:, 0].copy()),
                            pa.array(both[:, 1].copy()),
                            ids.take(rows),
                            versions.take(rows),
                            pa.array([places[k] for k in part], pa.list_(pa.int64())),
                            pa.ListArray.from_arrays(at, inner[:, 0].copy()),
                            pa.ListArray.from_arrays(at, inner[:, 1].copy()),
                        ],
                        names=names,
                    )

    return run


def suffix_ranks(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix among all, by its first ``depth`` ids.

    Ranks of length 1 are combined to ranks of length 2, 4, … and the last two
    overlap. Suffixes of equal rank stand below one inner node of that depth.
    Entries whose suffix is shorter than ``depth`` are not in the result.
    """
    ranks, length = ids, 1
    while length < depth:
        step = min(length, depth - length)
        pair = ranks[: len(ranks) - step] * (int(ranks.max()) + 1) + ranks[step:]
        ranks = np.unique(pair, return_inverse=True)[1]
        length += step
    return ranks


def deep_nodes(chunks: list[bytes], docs: np.ndarray, window: int):
    """Of each chunk, the windows below a node that a smaller document shares.

    Builds the suffix tree of the chunks down to ``window`` words. Returns the
    chunk and first window of every such suffix.
    """
    names: dict[bytes, int] = {}
    parts = [c.split() for c in chunks]
    ids = np.fromiter((names.setdefault(w, len(names)) for p in parts for w in p), np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    ranks = suffix_ranks(ids, window)
    count = np.diff(offsets) - window + 1
    at = arrays.ranges(offsets[:-1], count)
    chunk = np.repeat(np.arange(len(chunks)), count)
    node = ranks[at]
    order = np.argsort(node, kind="stable")
    borders = np.flatnonzero(np.diff(node[order], prepend=-1))
    first_doc = np.minimum.reduceat(docs[chunk][order], borders)
    owner = np.empty(len(node), np.int64)
    owner[order] = np.repeat(first_doc, np.diff(np.append(borders, len(order))))
    found = owner < docs[chunk]
    return chunk[found], (at - offsets[chunk])[found]


def _trees(window: int):
    """Trees of whole prefix groups; rows come sorted by prefix."""

    def found(table: pa.Table) -> pa.RecordBatch:
        docs = np.asarray(table.column("doc_id"))
        chunks = [c.encode() for c in table.column("words").to_pylist()]
        chunk, at = deep_nodes(chunks, docs, window)
        new = np.ones(len(chunk), dtype=bool)
        new[1:] = (chunk[1:] != chunk[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(chunk)) - 1
        base = np.asarray(table.column("at"))[chunk[first]]
        versions = np.asarray(table.column("version"))
        spans = pa.StructArray.from_arrays(
            [pa.array(base + at[first]), pa.array(base + at[last[: len(first)]] + window)], ["lo", "hi"]
        )
        return pa.record_batch(
            [
                pa.array(docs[chunk[first]]),
                pa.array(versions[chunk[first]]),
                pa.ListArray.from_arrays(np.arange(len(first) + 1, dtype=np.int32), spans),
            ],
            names=["doc_id", "version", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column("prefix"))
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = [batch.slice(cut)]
            elif held and held[-1].column("prefix")[0].as_py() != keys[0]:
                yield found(pa.Table.from_batches(held))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
    for batch in batches:
        runs, versions = batch.column("runs"), batch.column("version").to_pylist()
        totals, removed, digests, kept = [], [], [], []
        at, values = np.asarray(runs.offsets), runs.values
        spans = values.field("spans")
        whose = np.repeat(np.asarray(values.field("version")), np.diff(np.asarray(spans.offsets)))
        at = np.asarray(spans.offsets)[at]
        lo, hi = np.asarray(spans.values.field("lo")), np.asarray(spans.values.field("hi"))
        for i, text in enumerate(batch.column("text")):
            words = (text.as_py() or "").encode().split()
            total = len(words)
            own = slice(at[i], at[i + 1])
            mine = whose[own] == versions[i]
            if mine.any():
                step = np.zeros(total + 1, np.int64)
                np.add.at(step, lo[own][mine], 1)
                np.add.at(step, hi[own][mine], -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
            out = b" ".join(words)
            totals.append(total)
            removed.append(total - len(words))
            digests.append(hashlib.sha256(out).hexdigest())
            kept.append(out.decode())
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(totals, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept, pa.string()),
            ],
            names=names,
        )


def _spans(anchors: DataFrame, docs: DataFrame, window: int, prefix: int, group_rows: int) -> DataFrame:
    """Word spans [lo, hi) of repeated windows by document and version of its text.

    All parts read the same shuffled texts within one plan, so texts move once.
    """
    repeated = (
        anchors.groupBy("prefix")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum("times").alias("rows"))
        .where("lo < hi")
        .select("prefix", (F.col("rows") > group_rows).alias("hot"))
    )
    marks = (
        anchors.select("doc_id", "prefix")
        .join(repeated, "prefix")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("prefix", "hot")).alias("marks"))
    )
    marked = docs.join(marks, "doc_id", "left").where("marks IS NOT NULL")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = (
        marked.where(F.exists("marks", lambda m: ~m.hot))
        .mapInArrow(_chunks(window, prefix), CHUNK_SCHEMA)
        .repartition(parts, "prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_trees(window), RUN_SCHEMA)
    )
    chunks = marked.where(F.exists("marks", lambda m: m.hot)).mapInArrow(_hot_chunks(window, prefix), HOT_SCHEMA)
    # Equal chunks fold to the smallest document's; only that one has windows of its own to look up.
    firsts = chunks.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.first("w1").alias("w1"), F.first("w2").alias("w2"))
    nodes = firsts.select("h1", "h2", "owner", F.posexplode(F.arrays_zip("w1", "w2")).alias("k", "w")).select(
        "h1", "h2", "owner", "k", F.col("w.w1").alias("w1"), F.col("w.w2").alias("w2")
    )
    least = nodes.groupBy("w1", "w2").agg(F.min("owner").alias("least"))
    gone = nodes.join(least, ["w1", "w2"]).groupBy("h1", "h2").agg(
        F.min("owner").alias("owner"),
        F.count("*").alias("n"),
        F.collect_list(F.when(F.col("owner") > F.col("least"), F.col("k"))).alias("ks"),
    )
    whole = F.expr(f"transform(at, a -> struct(a AS lo, a + n - 1 + {window} AS hi))")
    own = F.expr(f"flatten(transform(at, a -> transform(ks, k -> struct(a + k AS lo, a + k + {window} AS hi))))")
    folded = (
        chunks.select("h1", "h2", "doc_id", "version", "at")
        .join(gone, ["h1", "h2"])
        .select("doc_id", "version", F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(own).cast(SPANS).alias("spans"))
    )
    return trees.unionByName(folded)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` of every row of ``docs(doc_id, text)``.

    Each word is removed that lies in a window whose words also start in a
    document with a smaller ``doc_id``; windows are judged on the input.
    ``kept_text`` is the kept words, joined by one space.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    path = scratch_dir(spark, "anchors")
    # Written once, read twice: the prefixes are counted and then joined with the counts.
    docs.where("doc_id IS NOT NULL").mapInArrow(_anchors(window, prefix), ANCHOR_SCHEMA).write.parquet(path)
    anchors = spark.read.schema(ANCHOR_SCHEMA).parquet(path)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    spans = _spans(anchors, docs, window, prefix, group_rows)
    runs = spans.groupBy("doc_id").agg(F.collect_list(F.struct("version", "spans")).alias("runs"))
    none = F.expr(f"CAST(array() AS array<struct<version: bigint, spans: {SPANS}>>)")
    return (
        docs.join(runs, "doc_id", "left")
        .withColumn("runs", F.coalesce("runs", none))
        .mapInArrow(_apply, RESULT_SCHEMA)
    )
