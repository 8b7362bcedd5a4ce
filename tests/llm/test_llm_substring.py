import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tramline.llm import arrays, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    owner = defaultdict(set)
    for i, text in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                owner[tuple(w[k : k + window])].add(i)
    out = []
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and min(owner[tuple(w[k : k + window])]) < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(df):
    return sorted(map(tuple, df.drop("kept_text").collect()), key=str)


@pytest.mark.parametrize("group_rows", [2048, 3, 0])
@pytest.mark.parametrize("window,prefix", [(50, 16), (20, 5), (6, 6)])
def test_like_brute_force(docs, texts, window, prefix, group_rows):
    got = substring.remove_repeats(docs, window=window, prefix=prefix, group_rows=group_rows)
    assert found(got) == sorted(brute(texts, window), key=str)


def test_empty(no_docs):
    assert found(substring.remove_repeats(no_docs)) == []


def test_ranks_are_classes_of_equal_suffixes():
    ids = np.random.default_rng(1).integers(0, 2, 400)
    for depth in (1, 2, 3, 7, 8, 13):
        ranks = substring.suffix_ranks(ids, depth)
        suffixes = [tuple(ids[i : i + depth]) for i in range(len(ids) - depth + 1)]
        order = {s: k for k, s in enumerate(sorted(set(suffixes)))}
        assert ranks.tolist() == ([order[s] for s in suffixes] if depth > 1 else ids.tolist())


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    left, right = rng.integers(0, 1 << 60, (2, 90)).astype(np.uint64)
    words = np.concatenate([left, passage, right, right, passage, left])
    offsets = np.array([0, 240, 480])
    text, first, last, key = substring.anchors_of(words, offsets, 50, 16)
    runs = {}
    for t, f, z, k in zip(text, first, last, key):
        for s in range(f, z + 1):
            runs[t, s - offsets[t]] = k
    assert all(runs[0, 90 + d] == runs[1, 90 + d] for d in range(11))
    assert len(runs) == 2 * (240 - 49)


def test_words_of_blocks_match_the_pattern():
    rows = ["a  b\n", "", "c", " \x0b", "déjà vu x", "z"]
    raw = [r.encode() for r in rows]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, words = arrays.find_words(data, offsets)
    got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert got == [w for r in rows for w in WORD.findall(r)]
    assert np.diff(words).tolist() == [len(WORD.findall(r)) for r in rows]
    hashes = arrays.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(got))
