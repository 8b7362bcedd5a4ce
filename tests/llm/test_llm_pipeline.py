"""The stages one after the other, each held against brute force on its own input."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tramline.llm import quality

from .test_llm_decontamination import shingles
from .test_llm_quality import brute_counts, brute_histograms, js
from .test_llm_secrets import ASSIGN
from .test_llm_simhash import brute_components, brute_fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, _kept string"
TOPICS = "river road school market harbour station library garden museum bakery theatre forest".split()
ITEM = "The harbour master of the old port kept a small book of all the ships that had come in since the war."


def article(k, n=12):
    out = []
    for i in range(n):
        topic = TOPICS[(k * 7 + i * 5) % len(TOPICS)]
        other = TOPICS[(k * 3 + i * 11 + 1) % len(TOPICS)]
        third = TOPICS[(k * 5 + i * 7) % len(TOPICS)]
        out.append(f"In the {topic} {k} of {other} {i * k + i} there was a {third} plan to be read by {k + i} people.")
    return " ".join(out)


def rows():
    out = [(i, article(i)) for i in range(30)]
    out += [(40, article(3)), (41, article(3)), (42, article(5) + " End."), (2, article(2))]
    out += [(50, article(50) + " " + ITEM + " " + article(51)), (51, article(52) + " " + ITEM.upper())]
    out += [(60, article(60) + " password=abcdefabcdefabcdef12 and so on."), (61, "too short"), (62, None)]
    out += [(63, " ".join(w.upper() + "!!" for w in article(63).split())), (64, "the same eight words are said again here " * 9)]
    out += [(None, article(70)), (None, article(70)), (None, ITEM), (None, "too short")]
    return [(i, t, "en", "s", len(t or ""), "x", "x") for i, t in out]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows(), SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, folder).write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        out.append((name, given, docs))
    return folder, out


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_order_and_columns(stages):
    _, out = stages
    assert [name for name, _, _ in out] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, given, kept in out[:-1]:
        assert kept.columns == given.columns and kept.dtypes == given.dtypes


def test_quality(stages):
    _, given, kept = stages[1][0]
    rows_ = [(r.doc_id, r.text, r.lang) for r in given.collect()]
    judged = {
        k: brute_histograms(t)
        for k, (_, t, _) in enumerate(rows_)
        if t and len(t) >= quality.GUARD_CHARS and len(t.split()) >= quality.GUARD_WORDS
    }
    peers = [h for k, h in judged.items() if not brute_counts(rows_[k][1])[-1]]
    means = [[sum(x) / len(peers) for x in zip(*(p[i] for p in peers))] for i in (0, 1)]
    refused, want = set(), []
    for k, (i, t, _) in enumerate(rows_):
        far = False
        if k in judged:
            a, b = (js(judged[k][m], means[m]) for m in (0, 1))
            far = a > quality.MAX_CHAR_DISTANCE or b > quality.MAX_WORD_DISTANCE
            far |= a > quality.MAX_BOTH[0] and b > quality.MAX_BOTH[1]
        if far or brute_counts(t)[-1]:
            refused.add(i)
        else:
            want.append((i, t))
    assert {61, 62, 63, 64, None} <= refused and None in {i for i, _ in want}
    assert pairs(kept) == sorted(want, key=str)


def test_near_duplicates(stages):
    _, given, kept = stages[1][1]
    rows_ = [(r.doc_id, r.text) for r in given.collect()]
    sets = [shingles(t) for _, t in rows_]
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or len(a & b) >= 0.8 * len(a | b)]
    label = brute_components(edges, range(len(rows_)))
    groups = defaultdict(list)
    for k, row in enumerate(rows_):
        groups[label[k]].append(row)
    first = [min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()]
    named = [r.doc_id for r in kept.collect()]
    assert sorted(named, key=str) == sorted((i for i, _ in first), key=str)
    assert 3 in named and not {40, 41, 42} & set(named)
    alone = [t for i, t in first if i is None]
    assert sorted(r.text for r in kept.collect() if r.doc_id is None) == sorted(alone) and alone


def test_decontamination(stages):
    _, given, kept = stages[1][2]
    asked = shingles(ITEM)
    want = [(r.doc_id, r.text) for r in given.collect() if len(asked & shingles(r.text)) < 0.8 * len(asked)]
    assert pairs(kept) == sorted(want, key=str)
    gone = {r.doc_id for r in given.collect()} - {i for i, _ in want}
    assert {50, 51} <= gone | ({50, 51} - {r.doc_id for r in given.collect()})
    assert ITEM in {r.text for r in given.collect() if r.doc_id is None} and ITEM not in {t for _, t in pairs(kept)}


def test_secrets(stages):
    _, given, kept = stages[1][3]

    def hidden(text):
        return ASSIGN.sub(lambda m: "[assign]" if len(m[2]) >= 12 else m[0], text)

    assert pairs(kept) == sorted(((r.doc_id, hidden(r.text)) for r in given.collect()), key=str)
    assert any("[assign]" in t for _, t in pairs(kept)) and not any(re.search("abcdefabcdef", t) for _, t in pairs(kept))
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_packing(stages):
    _, given, kept = stages[1][4]
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in given.collect():
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, 1]
        for lo in range(0, len(ids), 2048):
            part = ids[lo : lo + 2048]
            want.append((r.doc_id, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted((tuple(r)[:5] for r in kept.collect()), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in kept.collect():
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_is_the_stages(spark, stages):
    folder, out = stages
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = corpus_pipeline.run(spark, folder).select(columns).collect()
    assert sorted(got, key=str) == sorted(out[-1][2].select(columns).collect(), key=str)


def test_empty(spark, stages, tmp_path):
    folder, _ = stages
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_leave_only_what_their_rows_are_read_from(spark, tmp_path):
    """The tables of the search for copies, leaks and secrets go when it is done: they held the disk to the end."""
    from pathlib import Path

    from tramline.session import scratch_dir

    folder, scratch = str(tmp_path), Path(scratch_dir(spark, "probe").removeprefix("file:")).parent
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage, left in (
        (corpus_pipeline.keep_first, ["kept", "numbered"]),
        (corpus_pipeline.keep_clean, ["leaks", "numbered"]),
        (corpus_pipeline.hide_secrets, ["secrets"]),
    ):
        before = {p.name for p in scratch.iterdir()} if scratch.exists() else set()
        assert stage(spark, docs, folder).count() > 0
        assert sorted(p.name.split("-")[0] for p in scratch.iterdir() if p.name not in before) == left
