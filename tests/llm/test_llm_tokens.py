"""Token counts, packing and grammar shards, held against the tokenizer library."""

import glob
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from tramline.llm import grammar, packing, token_counts, word_ids
from tramline.session import scratch_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def encoded(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


AWKWARD = [
    "a<|endoftext|>b  c\n\n d\t\t e   ",
    "it's I'll we'RE 12345 x1y2 é́ ẞ İstanbul ΑΣ ",
    "<|startoftext|> <|ENDOFTEXT|> <|endoftext|><|endoftext|> <|endo ftext|>",
    "   nbsp space ́accent á ​ zero \x1c\x1d\x1e\x85 line sep",
    "漢字かな交じり文 한국어 عربى हिन्दी \U0001f468‍\U0001f469‍\U0001f467 ﷺ",
    "",
    None,
    "x" * 5000,
    "'s 's'S ''''tt don't' ... --- !!!\n!!\r\n\x0b\x0c",
]


@pytest.fixture(scope="module")
def frame(spark, texts):
    rows = [(100 + i, t) for i, t in enumerate(AWKWARD)] + list(texts)
    rows.append((99, " ".join(t or "" for _, t in texts) * 2))
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string"), rows


def test_counts_like_the_library(frame):
    df, rows = frame
    want = []
    for i, t in rows:
        n = len(encoded(BYTES, t))
        want.append((i, len((t or "").encode()), n, n > 512))
    got = token_counts.token_counts(df, BYTES)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_pre_tokens_split_as_the_library_does():
    """Every character of the stable ranges, between letters, digits and spaces."""
    pre = Tokenizer.from_file(BYTES).pre_tokenizer
    split = regex.compile(public_tokenizers.PATTERN).findall
    stable = regex.findall(f"[{token_counts.STABLE}]", "".join(map(chr, range(0xD800))))
    for lo in range(0, len(stable), 512):
        text = "".join(f"a{c}1{c} {c}b{c}{c}." for c in stable[lo : lo + 512])
        ends, at = [], 0
        for p in split(text):
            at += len(p)
            ends.append(at)
        assert [e for _, (_, e) in pre.pre_tokenize_str(text)] == ends


def test_pieces_like_the_library(frame):
    df, rows = frame
    got = packing.pack(df, WORDS, window=64, keep_ids=True).collect()
    want = Counter()
    for i, t in rows:
        ids = [*encoded(WORDS, t), 1]
        for lo in range(0, len(ids), 64):
            want[i, lo, crc(ids[lo : lo + 64]), len(ids), tuple(ids[lo : lo + 64])] += 1
    assert Counter((r.doc_id, r.start, r.ids_crc32, r.doc_tokens, tuple(r.ids)) for r in got) == want
    check_sequences(got, 64)


def check_sequences(rows, window):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return by


def test_little_padding(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(n))) for i, n in enumerate(rng.integers(1, 300, 3000))]
    rows += [(5000 + i, " ".join(["w"] * 77)) for i in range(1500)]  # a hot length
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    by = check_sequences(packing.pack(df, WORDS, window=256).collect(), 256)
    fill = [sum(n for _, n in p) for p in by.values()]
    padding = sum(256 - f for f in fill if f & (f - 1))
    assert padding < 0.02 * sum(fill)


def test_solve_uses_up_a_histogram_that_fits():
    plan = packing.solve({10: 30, 54: 30, 20: 20, 24: 10, 32: 40}, 64)
    used = Counter()
    for a, b, c, n in plan:
        assert a + b + c == 64
        for x in (a, b, c):
            if x:
                used[x] += round(n)
    assert used[10] >= 25 and used[54] >= 25 and used[32] >= 35


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, WORDS).collect() == []


@pytest.mark.parametrize("shard_ids", [300, 2_000_000])
def test_shards_round_trip(spark, frame, shard_ids):
    df, rows = frame
    folder = scratch_dir(spark, "test-grammar")
    index = grammar.write_shards(df, WORDS, folder, shard_ids=shard_ids)
    got = sorted(grammar.read_shards(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for r, (i, t) in zip(got, ordered, strict=True):
        ids = [*encoded(WORDS, t), 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), crc(ids))
        at += len(ids)
    assert sum(r.n_ids for r in index.collect()) == at
    # Random access: one document, and a stretch of ids.
    r = got[-3]
    raw = open(glob.glob(f"{folder}/shards/{r.shard}".removeprefix("file://"))[0], "rb").read()
    shard = grammar.Shard.from_bytes(raw)
    assert crc(shard.document(r.place)) == r.ids_crc32
    everything = np.concatenate([shard.document(k) for k in range(len(shard.doc_ids))])
    for lo, hi in ((0, 1), (5, 60), (len(everything) - 7, len(everything))):
        assert shard.ids(lo, hi).tolist() == everything[lo:hi].tolist()


def test_no_shards(spark, no_docs):
    folder = scratch_dir(spark, "test-grammar")
    grammar.write_shards(no_docs, WORDS, folder)
    assert grammar.read_shards(spark, folder).collect() == []


def test_grammar_makes_repeats_small():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 400, int(n)) for n in rng.integers(2, 8, 200)]
    docs = [np.concatenate([words[k] for k in rng.zipf(1.3, 300) % 200]) for _ in range(40)]
    docs += [np.full(3000, 7), np.array([2])]
    ids = np.concatenate(docs).astype(np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    shard = grammar.compress(ids, offsets, np.arange(len(docs)), np.zeros(len(docs)))
    back = grammar.Shard.from_bytes(shard.to_bytes())
    assert back.decode(back.symbols.astype(np.int64)).tolist() == ids.tolist()
    assert all(back.document(k).tolist() == d.tolist() for k, d in enumerate(docs))
    sizes = np.concatenate([np.ones(len(back.terminals), int), back.lengths])
    assert sizes[back.symbols].sum() == len(ids)
    assert 4 * len(back.symbols) < len(ids)


def test_letters_are_asked_for_once_whatever_signs_stand_behind_them():
    """The table holds pieces of words; cutting changes no id."""
    encoder = word_ids.WordIds(WORDS)
    texts = ["Élan word, word. Word!! WORD; word", "word's 12 <|endoftext|> word<|x (word) ×é é÷", "", "a,b c\x85d Élan?", *filter(None, AWKWARD)]
    raw = [t.encode() for t in texts]
    ids, at = encoder.encode(b"".join(raw), np.cumsum([0, *map(len, raw)]), 2)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [encoded(WORDS, t) + [2] for t in texts]
    assert {p for p in encoder.index if p.lower().startswith(b"word")} == {b"word", b"word's", b"word<|x"}


@pytest.mark.parametrize("one_hash", [False, True])
def test_pieces_that_are_alike_have_their_own_places(monkeypatch, one_hash):
    """The same first bytes, NUL bytes behind, sizes around 8 and 16 bytes, and one hash for all."""
    if one_hash:
        monkeypatch.setattr(word_ids, "_hash", lambda low, high, size: np.full(len(low), 2**64 - 1, np.uint64))
    pieces = [b"abcdefgh" * 4 + bytes(3), b"\0" * 32, b"x" * 40]
    pieces = sorted({p[:k] for p in pieces for k in (*range(1, 19), 32)}) + [b"%d" % k for k in range(2000)]
    table, at = word_ids.Pieces(), 0
    for lo in range(0, len(pieces), 700):
        keys = word_ids.Keys(pa.array(pieces[: lo + 700], pa.large_binary()).slice(lo))
        assert (table.find(keys) == -1).all()
        rows = np.arange(len(keys.size))
        assert table.add(keys, rows).tolist() == (at + rows).tolist()
        assert table.find(keys).tolist() == (at + rows).tolist()
        at += len(rows)
    assert table.find(word_ids.Keys(pa.array(pieces, pa.large_binary()))).tolist() == list(range(len(pieces)))
    assert table.index() == {p: i for i, p in enumerate(pieces)}


def test_known_pieces_are_found_as_arrays(monkeypatch):
    """A block of known pieces makes no Python object for each; only new ones are asked for, also after the table starts anew."""
    encoder, asked = word_ids.WordIds(WORDS), []
    found = encoder._found
    monkeypatch.setattr(encoder, "_found", lambda pieces: asked.append(len(pieces)) or found(pieces))
    words = [f"w{k}x" for k in range(3000)] + ["long" * 9]
    learn = lambda some: encoder.learn(pa.array([w.encode() for w in some], pa.large_binary()))
    first = learn(words)
    assert learn(words).tolist() == first.tolist() and learn([*words[9:], "new"])[-1] == 3001
    assert asked == [3001, 1]
    monkeypatch.setattr(word_ids, "CACHE_BYTES", encoder.size)
    assert learn(["w0x", "other"]).tolist() == [0, 1] and asked[2:] == [2]
    raw = "w0x other w1x".encode()
    ids, _ = encoder.encode(raw, np.array([0, len(raw)]), 2)
    assert ids.tolist() == encoded(WORDS, raw.decode()) + [2]
