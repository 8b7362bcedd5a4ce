"""Token counts without token ids.

Method: a byte-level BPE tokenizer merges within pre-tokens only, so a text has
as many tokens as its pre-tokens have together. Each task takes the pre-tokens
of its texts as (text, pre-token, frequency), asks the tokenizer once for each
distinct pre-token, keeps the answer for later rows, joins the counts to the
frequencies and sums them. Ids of a text are never made. The table of counts is
dropped when it holds ``CACHE`` pre-tokens, so a worker's memory is bounded.

The join stays in the task: as a shuffle it would move a row for most words of
the corpus, several times the input.

Pre-tokens are taken by the tokenizer's own pattern. Libraries follow different
versions of Unicode, so a text with characters outside ``STABLE`` is split by
the tokenizer itself, which is slower and always right.

Special strings inside a text are single tokens, as the library has them by
default; they are cut out before pre-tokens are taken.

Defined results: a NULL or empty text has 0 bytes and 0 tokens. Ids may be NULL
or repeat; each row has its own result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import mul

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramline.llm import arrays

LIMIT = 512
CACHE = 400_000
# Letters, digits and signs whose classes all versions of Unicode in use agree on.
STABLE = r"\x00-\u0527\u2010-\u2027\u2030-\u205e\u20ac\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class Counts:
    """Pieces of pre-tokens, each asked for once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_pattern = regex.compile(public_tokenizers.PATTERN).findall
        self.unstable = regex.compile(f"[^{STABLE}]").search
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        longest = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest))) if special else None
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.unstable(text):
            return self.by_pattern(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> Counter:
        """Frequencies of the text's pre-tokens; special strings count under their own text."""
        if self.special is None or not self.special.search(text):
            return Counter(self.split(text))
        found = Counter(self.special.findall(text))
        for part in self.special.split(text):
            found.update(self.split(part))
        return found

    def learn(self, tables: list[Counter]) -> None:
        new = set().union(*tables).difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = set().union(*tables)
        names = list(new)
        for name, e in zip(names, self.tokenizer.encode_batch_fast(names, add_special_tokens=False)):
            self.known[name] = len(e)

    def total(self, table: Counter) -> int:
        return sum(map(mul, map(self.known.__getitem__, table), table.values()))


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = arrays.worker_state()
        if ("counts", path) not in state:
            state["counts", path] = Counts(path)
        counts: Counts = state["counts", path]
        for batch in batches:
            for rows, data, offsets in arrays.blocks(batch, "text"):
                raw = data.tobytes()
                size = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                tables = [counts.pieces(x.decode()) for x in size]
                counts.learn(tables)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(rows.start, rows.stop - rows.start),
                        pa.array(map(len, size), pa.int64()),
                        pa.array(map(counts.total, tables), pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs(doc_id, text)``.

    ``path`` is a byte-level BPE file of the tokenizers library that every
    executor can open.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_counts(path), COUNT_SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
