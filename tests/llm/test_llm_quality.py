import math
import re
from collections import Counter

import pytest

from tramline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = (
    "The committee of the town met on Monday, and it was clear that the plan for the bridge is in need of work. "
    "At first a few members of the board had asked for more time; others said that the cost was too high, not the "
    "time. By the end of the day an answer to both was found, as it is in most years, with some help from the county. "
)


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(again),
        len(words) < 20 or 100 * len(again) > 30 * len(words),
    )


def brute_histograms(text):
    chars = [0] * (len(quality.CLASSES) + 2)
    for c in text:
        at = next((k for k, members in enumerate(quality.CLASSES) if c in members), None)
        chars[at if at is not None else len(quality.CLASSES) + (ord(c) > 127)] += 1
    common = quality._common()
    words = [0] * (len(common) + 1)
    for w in WORD.findall(text):
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in w.encode())
        words[common.index(raw) if raw in common else len(common)] += 1
    return [x / max(sum(chars), 1) for x in chars], [x / max(sum(words), 1) for x in words]


def js(p, q):
    total = 0.0
    for a, b in zip(p, q):
        for x in (a, b):
            if x > 0:
                total += x * math.log2(2 * x / (a + b)) / 2
    return math.sqrt(max(total, 0))


def test_counts_like_brute_force(docs, texts):
    got = quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    want = sorted(((i, *brute_counts(t)) for i, t in texts), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def corpus():
    rows = [(i, PLAIN * (1 + i % 3) + f"Note {i} of it.", "en") for i in range(40)]
    words = PLAIN.replace(".", "").split()
    rows += [
        (100, " ".join(w.upper() + "!!" for w in words), "en"),
        (101, " ".join(w + "###" for w in words), "en"),
        (102, " ".join(f"{i}/{i * 7}" for i in range(200)), "en"),
        (103, "short ### text |", "en"),
        (104, "line a\nline b\nline a\n\n \nline a " + PLAIN, None),
        (105, PLAIN, "xx"),
        (None, None, "en"),
    ]
    return rows


def test_verdicts_like_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {
        k: brute_histograms(t)
        for k, (i, t, lang) in enumerate(rows)
        if t and len(t) >= quality.GUARD_CHARS and len(WORD.findall(t)) >= quality.GUARD_WORDS
    }
    got = sorted(quality.judge(frame).collect(), key=lambda r: str(r.doc_id))
    by_id = {r.doc_id: r for r in got}
    for k, (i, t, lang) in enumerate(rows):
        row = by_id[i]
        failed = brute_counts(t)[-1]
        if k not in judged:
            assert row.char_distance is None and row.kept == (not failed)
            continue
        peers = [judged[m] for m in judged if rows[m][2] == lang and not brute_counts(rows[m][1])[-1]]
        means = [[sum(x) / len(peers) for x in zip(*(p[h] for p in peers))] for h in (0, 1)] if peers else None
        if means is None:
            assert row.char_distance is None
            continue
        distances = [js(judged[k][h], means[h]) for h in (0, 1)]
        assert row.char_distance == pytest.approx(distances[0], abs=1e-4)
        assert row.word_distance == pytest.approx(distances[1], abs=1e-4)
        far = distances[0] > quality.MAX_CHAR_DISTANCE or distances[1] > quality.MAX_WORD_DISTANCE
        far |= distances[0] > quality.MAX_BOTH[0] and distances[1] > quality.MAX_BOTH[1]
        assert row.kept == (not failed and not far)


def test_junk_goes_and_prose_stays(spark):
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(corpus(), "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(0, 40, 3)) and not any(got[i] for i in (100, 101, 102, 103))


def test_empty(no_docs):
    assert quality.judge(no_docs).collect() == []
