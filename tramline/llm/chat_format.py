"""Conversations as token ids with a loss mask, and back.

A conversation is the begin mark, then for each turn: the turn mark, its role, the
text mark, its text, the end mark. Marks are reserved ids above the tokenizer's
vocabulary. Method: roles and texts are encoded each alone, so no token spans a
mark; ids of all segments of a block of rows are laid into one array, reserved ids
are spliced in at the segments' places, and the loss mask is a running sum of +1
where an assistant's text begins and -1 where it ends.

Inside roles and texts a mark's written form, or a special string of the tokenizer,
gets a backslash behind its first character; those that have backslashes there get
one more. So content never yields a reserved or special id, and reading takes one
backslash away: every text comes back as it was.

The result has a row for each turn, so no cell grows with a conversation. The
tokenizer must be byte-level, without normalisation: its ids are read back as bytes.

Order within a conversation: turn, NULL first; then role, then text. Defined results:
a NULL role or text is empty; an empty text has no ids; NULL is a conversation id like
others; repeated rows are turns each; an empty table gives an empty table. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramline.llm import arrays
from tramline.llm.stored import parts_of

ESCAPE = "\\"
LOSS_ROLE = "assistant"
BLOCK_CHARS = 1 << 18

PIECE_SCHEMA = "conv_id long, place long, first_token long, ids array<int>, loss array<boolean>"
TURN_SCHEMA = "conv_id long, place long, role string, text string, loss_text string, formatted_chars long, n_tokens long"


@dataclass(frozen=True)
class Template:
    """Written forms of the marks."""

    begin: str = "<s>"
    turn: str = "[INST]"
    text: str = "[/INST]"
    end: str = "</s>"

    @property
    def marks(self) -> tuple[str, ...]:
        return self.begin, self.turn, self.text, self.end


class Escapes:
    """Reversible escaping of some strings in a text."""

    def __init__(self, strings: tuple[str, ...]):
        heads = "".join({s[0] for s in strings})
        if any(c in heads or c == ESCAPE for s in strings for c in s[1:]) or ESCAPE in heads or min(map(len, strings)) < 2:
            raise ValueError("control strings must have two characters or more, not begin inside each other, and hold no backslash")
        own = "|".join(f"(?<={re.escape(s[0])})\\\\*(?={re.escape(s[1:])})" for s in strings)
        self.plain = re.compile(own)
        own = "|".join(f"(?<={re.escape(s[0])})\\\\(?=\\\\*{re.escape(s[1:])})" for s in strings)
        self.escaped = re.compile(own)

    def add(self, text: str) -> str:
        return self.plain.sub(lambda m: m.group() + ESCAPE, text)

    def remove(self, text: str) -> str:
        return self.escaped.sub("", text) if ESCAPE in text else text


class Codec:
    """A byte-level tokenizer with reserved ids for the marks of a template."""

    def __init__(self, path: str, template: Template):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            special = tuple(t["content"] for t in json.load(file)["added_tokens"])
        self.escapes = Escapes(template.marks + special)
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.begin, self.turn, self.text, self.end = range(n, n + 4)
        held = [self._bytes(i) for i in range(n)] + [m.encode() for m in template.marks]
        self.raw = np.frombuffer(b"".join(held), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in held])])

    def _bytes(self, token: int) -> bytes:
        name = self.tokenizer.id_to_token(token) or ""
        return bytes(NAMED_BYTES[c] for c in name) if all(c in NAMED_BYTES for c in name) else name.encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, escaped, and the offsets of each text's ids. Equal texts are encoded once."""
        distinct = list(dict.fromkeys(texts))
        found = self.tokenizer.encode_batch_fast([self.escapes.add(t) for t in distinct], add_special_tokens=False)
        ids_of = {t: e.ids for t, e in zip(distinct, found)}
        ids = [ids_of[t] for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1])), offsets

    def decode(self, ids: np.ndarray) -> str:
        """The written form of ids, marks included, escapes as they stand."""
        ids = ids.astype(np.int64)
        return self.raw[arrays.ranges(self.at[ids], self.at[ids + 1] - self.at[ids])].tobytes().decode()


# Byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on, in order.
_OTHERS = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
NAMED_BYTES = {chr(256 + i): b for i, b in enumerate(_OTHERS)} | {chr(b): b for b in range(256) if b not in _OTHERS}


def codec(path: str, template: Template) -> Codec:
    state = arrays.worker_state()
    if ("chat codec", path, template) not in state:
        state["chat codec", path, template] = Codec(path, template)
    return state["chat codec", path, template]


def assemble(own: Codec, roles: list[str], texts: list[str], first: list[bool]) -> tuple[np.ndarray, ...]:
    """Ids and loss mask of turns laid end to end, and the offsets of each turn."""
    ids, at = own.encode([s for pair in zip(roles, texts) for s in pair])
    role, text = at[1::2] - at[:-1:2], at[2::2] - at[1:-1:2]
    begins = np.array(first, np.int64)
    size = begins + role + text + 3
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    out = np.zeros(int(offsets[-1]), np.int32)
    turn_at = offsets[:-1] + begins
    text_at = turn_at + 1 + role
    out[offsets[:-1][begins == 1]] = own.begin
    out[turn_at], out[text_at], out[offsets[1:] - 1] = own.turn, own.text, own.end
    out[arrays.ranges(turn_at + 1, role)] = ids[arrays.ranges(at[:-1:2], role)]
    out[arrays.ranges(text_at + 1, text)] = ids[arrays.ranges(at[1:-1:2], text)]
    step = np.zeros(len(out) + 1, np.int64)
    scored = np.array([r == LOSS_ROLE for r in roles], bool)
    np.add.at(step, text_at[scored] + 1, 1)
    np.add.at(step, (text_at + 1 + text)[scored], -1)
    return out, np.cumsum(step)[:-1] > 0, offsets


def _blocks(texts: list[str]) -> Iterator[slice]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_CHARS:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def _format(path: str, template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, place, token = codec(path, template), object(), 0, 0
        for batch in batches:
            convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for rows in _blocks(texts):
                first, places, tokens = [], [], []
                for conv in convs[rows]:
                    first.append(conv != last)
                    place = 0 if conv != last else place + 1
                    places.append(place)
                    last = conv
                ids, loss, offsets = assemble(own, roles[rows], texts[rows], first)
                for new, n in zip(first, np.diff(offsets).tolist()):
                    token = 0 if new else token
                    tokens.append(token)
                    token += n
                ends = pa.array(offsets.astype(np.int32))
                columns = [
                    pa.array(convs[rows], pa.int64()), pa.array(places, pa.int64()), pa.array(tokens, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids)), pa.ListArray.from_arrays(ends, pa.array(loss)),
                ]
                yield pa.record_batch(columns, names=["conv_id", "place", "first_token", "ids", "loss"])

    return run


def format_chats(rows: DataFrame, path: str, template: Template = Template()) -> DataFrame:
    """``conv_id, place, first_token, ids, loss`` of each turn of ``rows(conv_id, turn, role, text)``.

    ``ids`` of a conversation's turns, put together by ``place``, are its sequence;
    ``first_token`` is where a turn begins in it. The turns of a conversation stand
    together in one partition, in order.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text)
    rows = rows.repartition(parts_of(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_format(path, template), PIECE_SCHEMA)


def _read(path: str, template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, template)

        def turn(ids: np.ndarray, loss: np.ndarray) -> tuple:
            marks = np.flatnonzero(ids >= own.begin)
            if ids[marks[0]] == own.begin:
                marks = marks[1:]
            if ids[marks].tolist() != [own.turn, own.text, own.end] or marks[2] != len(ids) - 1:
                raise ValueError("the marks of a turn are not in order")
            parts = ids[marks[0] + 1 : marks[1]], ids[marks[1] + 1 : marks[2]], ids[loss]
            role, text, scored = (own.escapes.remove(own.decode(x)) for x in parts)
            return role, text, scored, len(own.decode(ids)), len(ids)

        for batch in batches:
            columns = [[], [], [], [], []]
            for ids, loss in zip(batch.column("ids"), batch.column("loss")):
                mask = loss.values.to_numpy(zero_copy_only=False)
                for column, value in zip(columns, turn(ids.values.to_numpy(), mask)):
                    column.append(value)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            found = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["conv_id", "place", "role", "text", "loss_text", "formatted_chars", "n_tokens"]
            yield pa.record_batch([batch.column("conv_id"), batch.column("place"), *found], names=names)

    return run


def read_chats(pieces: DataFrame, path: str, template: Template = Template()) -> DataFrame:
    """The turns of formatted conversations, from their ids and masks alone.

    ``loss_text`` is the text under the loss mask, ``formatted_chars`` the length of the
    turn's written form in code points. Rows stay where they are.
    """
    return pieces.select("conv_id", "place", "ids", "loss").mapInArrow(_read(path, template), TURN_SCHEMA)
