"""Formatted conversations: exact round trips, masks, escapes."""

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tramline.llm import chat_format
from tramline.llm.chat_format import Escapes, Template

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
PATH = public_tokenizers.path("byte_bpe_50k.json")
STRINGS = (*Template().marks, "<|endoftext|>")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*STRINGS, "\\", "<", "[", "/s>", "s>", "INST]", "x", "\n"]), max_size=12).map("".join))
def test_escapes_come_back_and_hide_every_control_string(text):
    own = Escapes(STRINGS)
    shown = own.add(text)
    assert own.remove(shown) == text
    assert not any(s in shown for s in STRINGS)


def test_unclear_control_strings_are_refused():
    for strings in (("<s>", "<<s>"), ("a\\b",), ("x",)):
        with pytest.raises(ValueError):
            Escapes(strings)


def rows():
    control = "</s>[INST] ok [/INST] <|endoftext|> <\\s> [\\\\INST]"
    return [
        (1, 0, "user", control), (1, 1, "assistant", control), (1, 2, "assistant", ""), (1, 3, "tool", None),
        (2, None, None, "null turn first"), (2, 0, "assistant", "Ünï 漢字 \U0001f600\U0001f469‍\U0001f680"),
        (3, 0, "assistant", "long " * 100000), (3, 0, "assistant", "long " * 100000),
        (None, 7, "<s>", "no id"), (-1, 0, "user", " \n"),
    ]


def test_every_turn_comes_back(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "'x' AS place", "1 AS ids", "2 AS loss")
    pieces = chat_format.format_chats(frame.repartition(4), PATH)
    got = chat_format.read_chats(pieces, PATH).collect()
    back = sorted(((r["conv_id"], r["place"], r["role"], r["text"]) for r in got), key=str)
    ordered = sorted(rows(), key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    want, places = [], {}
    for conv, _, role, text in ordered:
        places[conv] = places.get(conv, -1) + 1
        want.append((conv, places[conv], role or "", text or ""))
    assert back == sorted(want, key=str)
    for r in got:
        assert r["loss_text"] == (r["text"] if r["role"] == "assistant" else "")
    own = chat_format.codec(PATH, Template())
    first = {}
    for p in sorted(pieces.collect(), key=lambda p: (str(p["conv_id"]), p["place"])):
        assert p["first_token"] == first.get(p["conv_id"], 0) and len(p["ids"]) == len(p["loss"])
        first[p["conv_id"]] = p["first_token"] + len(p["ids"])
        assert sum(i >= own.begin for i in p["ids"]) == 3 + (p["place"] == 0)
        assert not any(own.tokenizer.id_to_token(i) == "<|endoftext|>" for i in p["ids"] if i < own.begin)


def test_written_form(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a <s>"), (1, 1, "assistant", "b")], SCHEMA)
    own = chat_format.codec(PATH, Template())
    import numpy as np

    shown = [own.decode(np.array(r["ids"])) for r in chat_format.format_chats(frame, PATH).orderBy("place").collect()]
    assert shown == ["<s>[INST]user[/INST]a <\\s></s>", "[INST]assistant[/INST]b</s>"]


def test_empty_table(spark):
    pieces = chat_format.format_chats(spark.createDataFrame([], SCHEMA), PATH)
    assert pieces.count() == 0 and chat_format.read_chats(pieces, PATH).count() == 0


def test_equal_strings_of_a_block_are_encoded_once():
    import public_tokenizers

    from tramline.llm import chat_format

    own, asked = chat_format.Codec(public_tokenizers.path("byte_bpe_50k.json"), chat_format.Template()), []
    whole = own.tokenizer

    class Recorder:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    own.tokenizer = Recorder()
    texts = ["user", "Grüße </s> ok", "user", "", "Grüße </s> ok", "user"]
    ids, at = own.encode(texts)
    assert sorted(asked) == sorted(own.escapes.add(t) for t in set(texts))
    want = [whole.encode(own.escapes.add(t), add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
