"""Token ids in binary shards, compressed by a grammar, readable at random.

Method (Re-Pair): in each shard, pairs of neighbouring symbols that occur often
are replaced by new symbols, in rounds of at most ``ROUND_RULES`` rules, until no
pair occurs ``LEAST`` times (overlaps counted) or symbols run out. A rule holds its two symbols and how many ids it expands to. Pairs never
cross documents, so each document is a run of symbols of its own, and sums of
expansion lengths lead to any id without decoding what stands before it.

Documents are dealt out by ranges of ``doc_id`` and sorted, so that shards in
the order of their names hold ids in ascending order of documents. A task
writes shards of about ``SHARD_IDS`` ids as it goes; memory does not grow with
its range. A shard is written under a name of its own and then moved to its
final name, so a repeated task replaces a shard by the same shard.

Shard layout (little-endian): magic, four counts, terminals (u32), rules (two
u16 each), expansion lengths of rules (u32), doc ids (i64), flags of NULL ids
(u8), symbol offsets of documents (i64), id offsets of documents (i64), symbols
(u16).

Defined results: a NULL or empty text is the end id alone. NULL ids come first;
rows that repeat an id stand side by side in the order of their texts. An empty
table writes no shard. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm import arrays
from tramline.llm.word_ids import word_ids

MAGIC = b"TRLGRAM1"
END_ID = 2
SHARD_IDS = 2_000_000
MAX_SYMBOLS = 65_535
BORDER = 65_535  # stands between documents while pairs are counted
LEAST = 6  # a rule costs eight bytes and saves two each time
ROUND_RULES = 4_096
SLOTS = 20

INDEX_SCHEMA = "part long, shard string, n_ids long"
DOC_SCHEMA = "shard string, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


@dataclass
class Shard:
    terminals: np.ndarray
    rules: np.ndarray  # n x 2
    lengths: np.ndarray  # of rules
    doc_ids: np.ndarray
    nulls: np.ndarray
    symbol_at: np.ndarray
    id_at: np.ndarray
    symbols: np.ndarray

    def to_bytes(self) -> bytes:
        parts = [
            self.terminals.astype("<u4"),
            self.rules.astype("<u2"),
            self.lengths.astype("<u4"),
            self.doc_ids.astype("<i8"),
            self.nulls.astype("u1"),
            self.symbol_at.astype("<i8"),
            self.id_at.astype("<i8"),
            self.symbols.astype("<u2"),
        ]
        counts = np.array([len(p) for p in parts[:1] + parts[1:2] + parts[3:4] + parts[7:]], "<i8")
        return MAGIC + counts.tobytes() + b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        if raw[:8] != MAGIC:
            raise ValueError("not a grammar shard")
        terminals, rules, docs, symbols = np.frombuffer(raw, "<i8", 4, 8).tolist()
        at, out = 40, []
        for kind, n in (
            ("<u4", terminals),
            ("<u2", 2 * rules),
            ("<u4", rules),
            ("<i8", docs),
            ("u1", docs),
            ("<i8", docs + 1),
            ("<i8", docs + 1),
            ("<u2", symbols),
        ):
            out.append(np.frombuffer(raw, kind, n, at))
            at += out[-1].nbytes
        out[1] = out[1].reshape(-1, 2)
        return cls(*out)

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all symbols one after the other, and the symbols' offsets in them."""
        n, (left, right) = len(self.terminals), self.rules.astype(np.int64).T
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.ones(n, np.int64), self.lengths]))])
        out = np.empty(int(offsets[-1]), np.uint32)
        out[:n] = self.terminals
        # Rules are made out in runs that only ask for symbols before them: the rounds that made them.
        newest, first = np.maximum.accumulate(np.maximum(left, right)), 0
        while first < len(left):
            last = int(np.searchsorted(newest, n + first))
            for symbols, starts in (
                (left[first:last], offsets[n + first : n + last]),
                (right[first:last], offsets[left[first:last] + 1] - offsets[left[first:last]] + offsets[n + first : n + last]),
            ):
                sizes = offsets[symbols + 1] - offsets[symbols]
                out[arrays.ranges(starts, sizes)] = out[arrays.ranges(offsets[symbols], sizes)]
            first = last
        return out, offsets

    def decode(self, symbols: np.ndarray, expansions=None) -> np.ndarray:
        ids, offsets = expansions or self.expansions()
        return ids[arrays.ranges(offsets[symbols], offsets[symbols + 1] - offsets[symbols])]

    def document(self, place: int) -> np.ndarray:
        """The ids of one document, without decoding others."""
        return self.decode(self.symbols[self.symbol_at[place] : self.symbol_at[place + 1]].astype(np.int64))

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first to last - 1 of the shard; only the symbols that reach into them are expanded."""
        size = np.concatenate([np.ones(len(self.terminals), np.int64), self.lengths])[self.symbols]
        ends = np.cumsum(size)
        lo, hi = np.searchsorted(ends, [first, last - 1], "right")
        out = self.decode(self.symbols[lo : hi + 1].astype(np.int64))
        skip = first - int(ends[lo] - size[lo])
        return out[skip : skip + last - first]


def re_pair(symbols: np.ndarray, n_symbols: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Replace frequent pairs in rounds; BORDER is never part of a pair.

    Of pairs that overlap in the sequence the left one is replaced. All pairs are
    counted once, then only places that held a frequent pair or stand beside a new
    symbol. No other pair can be frequent: all places that a pair ever has come up
    in the round that makes the newer of its symbols, and later rounds only take
    places from it.
    """
    symbols, rules = symbols.astype(np.uint32), []
    counted = np.ones(len(symbols), dtype=bool)
    # Tables by hash: whether a pair is frequent and has a rule, and which.
    kind, rule = np.zeros(1 << SLOTS, np.uint8), np.zeros(1 << SLOTS, np.uint32)

    def slot(keys: np.ndarray) -> np.ndarray:
        return keys * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOTS)

    while n_symbols < MAX_SYMBOLS and len(symbols) > 1:
        plain = symbols != BORDER
        counted[:-1] &= plain[:-1] & plain[1:]
        at = np.flatnonzero(counted[:-1])
        keys = (symbols[:-1] << np.uint32(16) | symbols[1:])[at]
        ordered = np.sort(keys)
        # A pair with k places equals the one LEAST - 1 further on k - LEAST + 1 times.
        often = ordered[np.flatnonzero(ordered[LEAST - 1 :] == ordered[: 1 - LEAST])]
        if not len(often):
            break
        first = np.concatenate([[0], np.flatnonzero(often[1:] != often[:-1]) + 1])
        frequent, times = often[first], np.diff(np.append(first, len(often)))
        pairs = frequent[np.lexsort((frequent, -times))][: min(ROUND_RULES, MAX_SYMBOLS - n_symbols)]
        # Of pairs that share a slot the most frequent goes first.
        pairs = pairs[np.sort(np.unique(slot(pairs), return_index=True)[1])]
        kind[:] = 0
        kind[slot(frequent)] = 1
        kind[slot(pairs)] = 2
        rule[slot(pairs)] = np.arange(len(pairs))
        slots = slot(keys)
        kinds = kind[slots]
        counted[at] = kinds > 0
        hit = np.flatnonzero(kinds == 2)
        number = rule[slots[hit]]
        same = pairs[number] == keys[hit]
        at, number = at[hit[same]], number[same]
        run = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        even = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0
        at, number = at[even], number[even]
        symbols[at] = n_symbols + number
        counted[at] = counted[at - 1] = True
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, counted = symbols[keep], counted[keep]
        rules += [(int(p) >> 16, int(p) & 0xFFFF) for p in pairs.tolist()]
        n_symbols += len(pairs)
    return symbols, rules


def compress(ids: np.ndarray, offsets: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray) -> Shard:
    """A shard of the documents ids[offsets[i]:offsets[i+1]]; none is empty."""
    terminals = np.flatnonzero(np.bincount(ids))
    if len(terminals) > MAX_SYMBOLS:
        raise ValueError("a shard of more distinct ids than symbols")
    local = np.zeros(int(terminals[-1]) + 1, np.int64)
    local[terminals] = np.arange(len(terminals))
    local = local[ids]
    apart = np.full(len(ids) + len(offsets) - 2, BORDER, np.int64)
    apart[np.arange(len(ids)) + arrays.row_of(offsets)] = local
    symbols, rules = re_pair(apart, len(terminals))
    lengths = [1] * len(terminals)
    for a, b in rules:
        lengths.append(lengths[a] + lengths[b])
    border = np.flatnonzero(symbols == BORDER)
    symbol_at = np.concatenate([[0], border - np.arange(len(border)), [len(symbols) - len(border)]])
    return Shard(
        terminals,
        np.array(rules, np.int64).reshape(-1, 2),
        np.array(lengths[len(terminals) :], np.int64),
        doc_ids,
        nulls,
        symbol_at,
        offsets,
        symbols[symbols != BORDER],
    )


def _write_file(folder: str, name: str, data: bytes) -> None:
    """One file, complete under its name or not there at all."""
    system, root = fs.FileSystem.from_uri(folder)
    own = f"{root}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, f"{root}/{name}")


def _write(path: str, folder: str, end: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(path), TaskContext.get().partitionId()
        held, held_ids, number = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, held_ids, number
            ids = np.concatenate([h[0] for h in held])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(h[1]) for h in held]))])
            shard = compress(ids, offsets, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))
            name = f"part-{part:06d}-{number:06d}.ids"
            _write_file(folder, name, shard.to_bytes())
            held, held_ids, number = [], 0, number + 1
            return pa.record_batch(
                [pa.array([part], pa.int64()), pa.array([name]), pa.array([len(ids)], pa.int64())],
                names=["part", "shard", "n_ids"],
            )

        for batch in batches:
            for rows, data, offsets in arrays.blocks(batch, "text"):
                own = batch.column("doc_id").slice(rows.start, rows.stop - rows.start)
                ids, at = encoder.encode(data.tobytes(), offsets, end)
                held.append((ids, at, np.asarray(own.fill_null(0)), np.asarray(own.is_null().cast(pa.uint8()))))
                held_ids += len(ids)
                if held_ids >= shard_ids:
                    yield flush()
        if held:
            yield flush()

    return run


def write_shards(
    docs: DataFrame, path: str, folder: str, end: int = END_ID, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Write ``docs(doc_id, text)`` below ``folder``; returns the index of shards, a written table.

    ``folder`` is a URI all executors can write to; the index goes to
    ``folder/index``, the shards to ``folder/shards``.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    system, root = fs.FileSystem.from_uri(f"{folder}/shards")
    system.create_dir(root, recursive=True)
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_write(path, f"{folder}/shards", end, shard_ids), INDEX_SCHEMA)
        .write.parquet(f"{folder}/index")
    )
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            shard = Shard.from_bytes(content.as_buffer().to_pybytes())
            expansions = shard.expansions()
            crc = []
            # Documents are decoded some at a time: what a worker holds is bounded.
            for lo in range(0, len(shard.doc_ids), 256):
                hi = min(lo + 256, len(shard.doc_ids))
                symbols = shard.symbols[shard.symbol_at[lo] : shard.symbol_at[hi]].astype(np.int64)
                raw = shard.decode(symbols, expansions).astype("<u4").tobytes()
                at = (4 * (shard.id_at[lo : hi + 1] - shard.id_at[lo])).tolist()
                crc += [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
            n = len(shard.doc_ids)
            yield pa.record_batch(
                [
                    pa.array([name] * n),
                    pa.array(np.arange(n)),
                    pa.array(shard.doc_ids, mask=shard.nulls.astype(bool)),
                    pa.array(shard.id_at[:-1]),
                    pa.array(np.diff(shard.id_at)),
                    pa.array(crc, pa.int64()),
                ],
                names=["shard", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, shard, place`` of every document below ``folder``."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    # Two sums: one over the tasks that wrote, one over the shards of each.
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select(
        "part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    starts = index.withColumn("own", F.sum("n_ids").over(inside) - F.col("n_ids")).join(before, "part")
    starts = starts.select("shard", (F.col("part_start") + F.col("own")).alias("shard_start"))
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.schema(schema).format("binaryFile").option("pathGlobFilter", "part-*.ids").load(f"{folder}/shards")
    docs = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content").mapInArrow(_read, DOC_SCHEMA)
    return docs.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "place"
    )
