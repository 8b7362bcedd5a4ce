"""SHA-256 digests of long sequences of rows, taken as the rows stream by."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROWS_OUT = 4096


def _runs(key: str, joined: dict[str, str], sums: tuple[str, ...], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, started = [], None, False
        count, totals, hashes = 0, [], []

        def result() -> tuple:
            return (current, count, *totals, *(h.hexdigest() for h in hashes))

        def table() -> pa.RecordBatch:
            columns = zip(*done) if done else [()] * len(schema)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            keys, added, texts = (
                batch.column(key).to_pylist(),
                [batch.column(c).to_pylist() for c in sums],
                [batch.column(c).to_pylist() for c in joined],
            )
            for i, own in enumerate(keys):
                if not started or own != current:
                    if started:
                        done.append(result())
                    current, started, count, totals = own, True, 0, [0] * len(sums)
                    hashes = [hashlib.sha256() for _ in joined]
                for h, column, separator in zip(hashes, texts, joined.values()):
                    if count and separator:
                        h.update(separator.encode())
                    h.update(column[i].encode())
                for k, column in enumerate(added):
                    totals[k] += column[i]
                count += 1
            if len(done) >= ROWS_OUT:
                yield table()
                done = []
        if started:
            done.append(result())
        yield table()

    return run


def run_digests(ordered: DataFrame, key: str, joined: dict[str, str], sums: tuple[str, ...] = ()) -> DataFrame:
    """A row for each run of equal keys within a partition, in the order of its rows.

    ``key, n_rows``, the totals ``sums`` and, named as the columns in ``joined``, the
    lowercase SHA-256 of their texts, joined by the separator given for each. A task
    holds one hash state, never the rows of a run. Texts and added numbers must not be
    NULL; a NULL key is a key like others; no rows give no rows.
    """
    own = StructField(key, ordered.schema[key].dataType)
    numbers = [StructField(name, LongType()) for name in ("n_rows", *sums)]
    schema = StructType([own, *numbers, *(StructField(name, StringType()) for name in joined)])
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])
    return ordered.select(key, *sums, *joined).mapInArrow(_runs(key, joined, sums, arrow), schema)
