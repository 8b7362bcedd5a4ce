import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tramline.llm import simhash
from tramline.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(edges, nodes):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_like_brute_force(docs, texts):
    prints = [(i, brute_fingerprint(t)) for i, t in texts]
    known = [(i, f) for i, f in prints if i is not None]
    edges = [(a, b) for a, f in known for b, g in known if (f ^ g).bit_count() <= 4 or a == b]
    label = brute_components(edges, {i for i, _ in known})
    want = sorted(((i, f"{f:016x}", label.get(i)) for i, f in prints), key=str)
    got = simhash.near_duplicates(docs)
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == want
    assert {r.component_id: r.n_linked for r in got.collect() if r.doc_id is not None} == {
        c: sum(label[i] == c for i, _ in known) - 1 for c in set(label.values())
    }


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []


def clusters(rng, n, size, flips):
    out = []
    for _ in range(n):
        center = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(size):
            x = center
            for b in rng.choice(64, int(rng.integers(0, flips + 1)), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("group_nodes", [4096, 12])
def test_links_lose_nothing(spark, group_nodes):
    """Groups that must be split, once or to the last bit, give the same components."""
    fps = clusters(np.random.default_rng(3), 6, 16, 4)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = brute_components(np.argwhere(near).tolist(), range(len(fps)))
    nodes = spark.createDataFrame(list(enumerate(fps.view(np.int64).tolist())), "node long, fp long")
    edges = simhash.links(nodes, group_nodes=group_nodes)
    assert all(near[r.a, r.b] or want[r.a] == want[r.b] for r in edges.collect())
    stars = {r.a: r.b for r in components(edges).collect()}
    assert {n: stars.get(n, n) for n in range(len(fps))} == want


def test_a_group_is_linked_by_any_path():
    fps = clusters(np.random.default_rng(4), 5, 30, 5)
    groups = np.arange(len(fps)) % 3
    near = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4) & (groups[:, None] == groups[None, :])
    want = brute_components(np.argwhere(near).tolist(), range(len(fps)))
    assert dict(enumerate(simhash.linked_labels(fps, groups, 4, 24).tolist())) == want


def test_split_masks_leave_one_block_untouched():
    masks = simhash.split_masks(0, 4)
    assert len(masks) == 5 and sum(masks) == (1 << 64) - 1
    again = simhash.split_masks(masks[0], 4)
    assert all(m & masks[0] == masks[0] for m in again)
    assert simhash.split_masks((1 << 64) - 1, 4) == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 299)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.a: r.b for r in components(frame).collect()}
    nodes = defaultdict(set)
    for a, b in got.items():
        nodes[b].add(a)
    assert nodes == {0: set(range(1, 61)), 100: set(range(101, 150)), 299: {300}}
