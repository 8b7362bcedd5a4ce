import re

import pytest

from tramline.llm import decontamination

ITEM_SCHEMA = "item_id LONG, text STRING, h STRING"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if not w:
        return set()
    return {" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def brute(docs, items, share):
    out = {}
    for i, text in docs:
        own = shingles(text)
        for j, item in items:
            asked = shingles(item)
            if i is None or j is None or not asked:
                continue
            n = len(asked & own)
            if n / len(asked) >= share:
                best = (n / len(asked), len(asked), n)
                out[i, j] = max(out.get((i, j), best), best)
    return sorted((i, j, b[1], b[2], b[0]) for (i, j), b in out.items())


@pytest.mark.parametrize("share", [0.8, 0.5, 1.0])
def test_like_brute_force(spark, docs, texts, share):
    by_id = {}
    for i, t in texts:
        by_id.setdefault(i, t)
    long = by_id[10].split()
    items = [
        (1, " ".join(long[100:140])),
        (2, " ".join(long[300:340]).upper()),
        (3, " ".join(long[500:536] + ["not", "in", "any", "text"])),
        (4, " ".join(long[700:720] + ["broken"] + long[720:740])),
        (5, None),
        (6, ""),
        (7, "One"),
        (8, "is onhe. is onhe. is onhe."),
        (None, " ".join(long[:50])),
        (9, " ".join(long[100:140])),  # a tie
        (9, by_id[1]),  # a repeated id
        (10, " ".join(long[900:910] + long[2000:2030])),  # in two places
        (11, "no such words in any of the texts here"),
    ]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM_SCHEMA)
    got = decontamination.contained_items(docs, frame, share=share)
    assert sorted(map(tuple, got.collect())) == brute(texts, items, share)


def test_empty(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "a b c d e f", "x")], ITEM_SCHEMA)
    assert decontamination.contained_items(no_docs, items).collect() == []
    assert decontamination.contained_items(docs, items.where("item_id > 1")).collect() == []


def test_no_python_in_the_plan(docs, spark):
    items = spark.createDataFrame([(1, "a b c d e f", "x")], ITEM_SCHEMA)
    plan = decontamination.contained_items(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
