"""Packing documents into training sequences of a fixed length.

Method: a document is cut at whole windows; full pieces are sequences already.
What is left of each document is shorter than a window. All combinations of two
or three lengths that fill a window exactly are enumerated, and non-negative
least squares finds how often to use each so that together they use up the
histogram of lengths over all documents. The counts are rounded; each task
applies its share of them to its own pieces and packs what remains greedily,
longest piece first into the fullest sequence that still holds it.

The histogram has one row for each length below the window, whatever the size
of the corpus; it alone reaches the driver. Pieces are dealt out by a hash of
all their columns in tasks of about ``TASK_PIECES``. Equal lengths need not
meet, so a length that a third of all documents have is no burden.

A sequence whose length is a power of two is not padded; others are filled up
to the window by padding.

Defined results: a NULL or empty text is a piece of the end id alone. Ids may be
NULL or repeat; every row's pieces are packed. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import arrays
from tramline.llm.word_ids import word_ids
from tramline.session import scratch_dir

WINDOW = 2048
END_ID = 1
TASK_PIECES = 50_000
SWEEPS = 3

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED_SCHEMA = f"{PIECE_SCHEMA}, sequence_id long, offset long"


def _pieces(path: str, window: int, end: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        for batch in batches:
            for rows, data, offsets in arrays.blocks(batch, "text"):
                ids, at = encoder.encode(data.tobytes(), offsets, end)
                total = np.diff(at)
                count = -(-total // window)
                doc = np.repeat(np.arange(len(total)), count)
                start = arrays.ranges(np.zeros(len(total), np.int64), count) * window
                length = np.minimum(total[doc] - start, window)
                raw = ids.astype("<u4").tobytes()
                lo = at[:-1][doc] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist())]
                own = batch.column("doc_id").slice(rows.start, rows.stop - rows.start)
                columns = [own.take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    borders = pa.array(np.append(lo, at[-1]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(borders, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return run


def combinations(lengths: list[int], window: int) -> np.ndarray:
    """Rows of three of the given lengths, the first perhaps 0, whose sum is the window."""
    has = np.zeros(window + 1, dtype=bool)
    has[lengths] = True
    out = []
    for a in [0, *sorted(x for x in lengths if 3 * x <= window)]:
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[has[b] & has[window - a - b]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(out)


def solve(histogram: dict[int, int], window: int, sweeps: int = SWEEPS) -> list[tuple[int, int, int, float]]:
    """How often to use each combination: non-negative least squares by coordinate descent.

    Each step sets one count to what fits the remaining histogram best, not
    below 0. Returns the combinations with a count of half or more, most used first.
    """
    rows = combinations(list(histogram), window)
    left = [0.0] * (window + 1)
    for length, n in histogram.items():
        left[length] = float(n)
    used = [0.0] * len(rows)
    for _ in range(sweeps):
        for k, (a, b, c) in enumerate(rows.tolist()):
            weights = Counter(x for x in (a, b, c) if x)
            step = sum(m * left[x] for x, m in weights.items()) / sum(m * m for m in weights.values())
            step = max(step, -used[k])
            if step:
                used[k] += step
                for x, m in weights.items():
                    left[x] -= m * step
    found = [(*row, n) for row, n in zip(rows.tolist(), used) if n >= 0.5]
    return sorted(found, key=lambda r: (-r[3], r))


def place(lengths: list[int], plan: list[tuple[int, int, int, float]], share: float, window: int) -> list[list[int]]:
    """Sequences of positions of ``lengths``: first by the plan, then greedily."""
    free: dict[int, list[int]] = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        free[lengths[i]].append(i)
    out = []
    for a, b, c, n in plan:
        for _ in range(round(n * share + 0.499)):
            need = Counter(x for x in (a, b, c) if x)
            if any(len(free[x]) < m for x, m in need.items()):
                break
            out.append([free[x].pop() for x in (a, b, c) if x])
    rest = sorted((i for left in free.values() for i in left), key=lambda i: (-lengths[i], i))
    rooms: list[int] = []  # room that open sequences have, sorted
    open_by_room: dict[int, list[list[int]]] = defaultdict(list)
    for i in rest:
        at = bisect_left(rooms, lengths[i])
        if at == len(rooms):
            room, sequence = window, []
            out.append(sequence)
        else:
            room = rooms.pop(at)
            sequence = open_by_room[room].pop()
        sequence.append(i)
        room -= lengths[i]
        if room:
            insort(rooms, room)
            open_by_room[room].append(sequence)
    return out


def _place(plan: list[tuple[int, int, int, float]], total: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        # The same rows in the same order, however the shuffle brought them.
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "start", "ids_crc32")])
        sequences = place(table.column("length").to_pylist(), plan, table.num_rows / total, window)
        first = TaskContext.get().partitionId() << 32
        order = np.array([i for s in sequences for i in s], np.int64)
        ids = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        table = table.take(pa.array(order))
        length = np.asarray(table.column("length"))
        ends = np.cumsum(length)
        begins = (ends - length)[np.searchsorted(ids, np.arange(len(sequences)))]
        yield from (
            table.append_column("sequence_id", pa.array(2 * (first + ids)))
            .append_column("offset", pa.array(ends - length - begins[ids]))
            .to_batches(max_chunksize=10_000)
        )

    return run


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, end: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """A row for each piece of ``docs(doc_id, text)``: where it is cut, and where it is packed.

    ``path`` is a word-level tokenizer file that every executor can open.
    ``keep_ids`` adds the ids of the piece as ``ids``. Sequences of a single
    full piece have odd ids, others even ones.
    """
    spark = docs.sparkSession
    schema = PIECE_SCHEMA + (", ids array<int>" if keep_ids else "")
    home = scratch_dir(spark, "pieces")
    # Written: texts are tokenized once; the histogram and the packing read lengths.
    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(path, window, end, keep_ids), schema
    ).write.parquet(home)
    pieces = spark.read.schema(schema).parquet(home)
    full = pieces.where(F.col("length") == window).select(
        "*", (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = pieces.where(F.col("length") < window)
    histogram = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}
    total = sum(histogram.values())
    if not total:
        return full
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = rest.repartition(-(-total // TASK_PIECES), *columns).mapInArrow(
        _place(solve(histogram, window), total, window),
        schema + ", sequence_id long, offset long",
    )
    return full.unionByName(placed)
