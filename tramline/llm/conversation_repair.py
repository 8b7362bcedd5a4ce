"""The cheapest repair of damaged conversations, with an audit of its edits.

A conversation is good if the initials of its roles read ``(s?(ua)+)?``: nothing,
or an optional system row and then user and assistant in turns. Rows are edited
in order: kept (0), given the role user or assistant (1), deleted (2), or a row
with empty text and one of these roles is put in (5). Blank rows and repeated
rows have to go; a truncated row that stays costs 5 more.

Method: one pass over the rows of a conversation, with the cheapest edits for
each of the four states of the pattern. Edits so far are strings in a persistent
structure (``edit_paths``): states share the beginnings of their strings, and of
equally cheap strings the ASCII-least is found by a search for their longest
common prefix. What a string has cost is told by its letters, so of two equally
cheap strings for the same rows neither begins the other, and the least beginning
always leads to the least whole. Roles of changed and added rows follow from the
string: user, but assistant behind a user row.

The rows' texts are not needed for that. The first pass reads a digest and some
flags of each row; its audits are a written table. A second pass lays the audit
before the texts of its conversation and applies it as they stream by. A task
holds one audit (a byte for each row of a conversation, as the result does), the
strings of four states, and the digests of one conversation, never its texts.
A conversation is one task's work in both passes: the least string depends on all
its rows in order.

Order within a conversation: turn, NULL first; rows of one turn by SHA-256 of role
and text. Defined results: a NULL role or text is empty; an empty text is blank, an
empty role has no initial and is never kept; NULL is a conversation id like others;
a conversation without rows is unknown here. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.edit_paths import ROOT, EditPaths
from tramline.llm.stored import parts_of, written

BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT = b"KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
MOST = (1 << 63) - 1
ROWS_OUT, BYTES_OUT = 4096, 4 << 20

REPORT_SCHEMA = (
    "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string"
)
REPAIRED_SCHEMA = "conv_id long, place long, edit string, turn long, role string, text string"

# States of the pattern: nothing yet, behind system, behind user, behind assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
BEFORE_USER = (START, SYSTEM, ASSISTANT)


def row_digest(role: Column, text: Column) -> Column:
    """32 bytes that stand for a role and a text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def prepared(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    return rows.withColumn("digest", row_digest(F.col("role"), F.col("text")))


class Repair:
    """The cheapest edits of one conversation, row by row."""

    def __init__(self, paths: EditPaths | None = None):
        self.paths = paths or EditPaths()
        self.paths.clear()
        self.live: list[tuple[int, int] | None] = [(0, ROOT), None, None, None]  # cost, string
        self._insert()

    def _better(self, state: int, cost: int, node: int, letter: int, into: list) -> None:
        """Take the string of ``node`` and ``letter`` for a state, if it is cheaper, or as cheap and less."""
        held = into[state]
        if held is not None and held[0] < cost:
            return
        node = self.paths.add(node, letter)
        if held is None or cost < held[0] or self.paths.less(node, held[1]):
            into[state] = (cost, node)

    def _insert(self) -> None:
        """Rows put in behind what was read: at most a user row and then an assistant row."""
        for state in BEFORE_USER:
            if self.live[state] is not None:
                cost, node = self.live[state]
                self._better(USER, cost + INSERT_COST, node, INSERT, self.live)
        if self.live[USER] is not None:
            cost, node = self.live[USER]
            self._better(ASSISTANT, cost + INSERT_COST, node, INSERT, self.live)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        after: list[tuple[int, int] | None] = [None] * 4
        extra = TRUNCATED_COST if truncated else 0
        for state, held in enumerate(self.live):
            if held is None:
                continue
            cost, node = held
            self._better(state, cost + DELETE_COST, node, DELETE, after)
            if must_go:
                continue
            then, fits = (ASSISTANT, "a") if state == USER else (USER, "u")
            if initial == fits:
                self._better(then, cost + extra, node, KEEP, after)
            else:
                self._better(then, cost + extra + REROLE_COST, node, REROLE, after)
            if state == START and initial == "s":
                self._better(SYSTEM, cost + extra, node, KEEP, after)
        self.live = after
        self._insert()
        if len(self.paths) > self.paths.limit:
            known = [s for s in range(4) if self.live[s] is not None]
            nodes = self.paths.collect([self.live[s][1] for s in known])
            for s, node in zip(known, nodes):
                self.live[s] = (self.live[s][0], node)

    def best(self) -> tuple[int, str]:
        """The cost and the edits of the cheapest repair."""
        cost, node = self.live[START]
        if self.live[ASSISTANT] is not None:
            other, last = self.live[ASSISTANT]
            if other < cost or other == cost and self.paths.less(last, node):
                cost, node = other, last
        return cost, self.paths.string(node).decode()


class Report:
    """What is wrong with one conversation; rows come in order."""

    def __init__(self, conv_id: int | None, paths: EditPaths):
        self.conv_id, self.repair = conv_id, Repair(paths)
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.least, self.last = 0, None, None
        self.seen: set[bytes] = set()
        self.initial: str | None = None

    def row(self, turn: int | None, initial: str, digest: bytes, blank: bool, unfinished: bool) -> None:
        self.n += 1
        if turn is not None and (self.least is None or turn != self.last):
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        repeated = digest in self.seen
        self.seen.add(digest)
        self.blank += blank
        self.duplicate += repeated and not blank
        truncated = unfinished and not blank and not repeated
        self.truncated += truncated
        self.repair.row(initial, blank or repeated, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.least is None else min(self.last - self.least + 1 - self.turns, MOST)
        found = (self.n, gaps, self.blank, self.duplicate, self.truncated, self.illegal)
        return self.conv_id, *found, *self.repair.best()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=names)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, done, size, paths = None, [], 0, EditPaths()
    for batch in batches:
        for conv_id, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.result())
                    size += len(done[-1][-1])
                current = Report(conv_id, paths)
                if len(done) >= ROWS_OUT or size >= BYTES_OUT:
                    yield _batch(done, REPORT_SCHEMA)
                    done, size = [], 0
            current.row(*row)
    if current is not None:
        done.append(current.result())
    if done:
        yield _batch(done, REPORT_SCHEMA)


def audit(rows: DataFrame) -> DataFrame:
    """A report for each conversation of ``rows(conv_id, turn, role, text)``, with the audit of its repair."""
    known = prepared(rows)
    end = F.rtrim("text", F.lit(BLANKS))
    flags = known.select(
        "conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "digest",
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(*STOPS)).alias("unfinished"),
    )
    flags = flags.repartition(parts_of(rows), "conv_id")
    return flags.sortWithinPartitions("conv_id", "turn", "digest").mapInArrow(_reports, REPORT_SCHEMA)


class Applied:
    """Repaired rows of one conversation after the other."""

    def __init__(self):
        self.audit, self.at, self.place, self.conv_id, self.user = "", 0, 0, None, False

    def _out(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        self.user = role[:1] == "u"
        self.place += 1
        return self.conv_id, self.place - 1, edit, turn, role, text

    def _role(self) -> str:
        return "assistant" if self.user else "user"

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._out("I", None, self._role(), "")

    def start(self, conv_id: int | None, audit: str) -> None:
        self.audit, self.at, self.place, self.conv_id, self.user = audit, 0, 0, conv_id, False

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._out(edit, turn, role if edit == "K" else self._role(), text)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    applied = Applied()
    for batch in batches:
        done, size = [], 0
        names = ("conv_id", "part", "turn", "role", "text", "audit")
        for conv_id, part, turn, role, text, edits in zip(*(batch.column(n).to_pylist() for n in names)):
            if part == 0:
                done += applied.inserted()
                applied.start(conv_id, edits)
                continue
            done += applied.row(turn, role, text)
            size += len(text)
            if size >= BYTES_OUT:
                yield _batch(done, REPAIRED_SCHEMA)
                done, size = [], 0
        yield _batch(done, REPAIRED_SCHEMA)
    yield _batch(list(applied.inserted()), REPAIRED_SCHEMA)


def apply(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id, place, edit, turn, role, text``.

    Each conversation's rows stand together in one partition, in order, from place 0 on.
    """
    texts = prepared(rows).select("*", F.lit(1).alias("part"), F.lit(None).cast("string").alias("audit"))
    names = ("turn", "role", "text", "digest")
    heads = audits.select(
        "conv_id", *(F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in names),
        F.lit(0).alias("part"), "audit",
    )
    both = texts.unionByName(heads).repartition(parts_of(rows), "conv_id")
    return both.sortWithinPartitions("conv_id", "part", "turn", "digest").mapInArrow(_apply, REPAIRED_SCHEMA)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report of all conversations (a written table) and their repaired rows."""
    report = written(audit(rows), "audits")
    return report, apply(rows, report)
