"""The conversation trie against a trie of dictionaries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tramline.llm import prefix_trie

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"


def brute(rows, base, head):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
    members = {}
    for c, turns in convs.items():
        built = [t[1:] for t in convs.get(base(c), [])[: head(c)]] + [t[1:] for t in turns[head(c) :]]
        for d in range(len(built) + 1):
            members.setdefault(tuple(built[:d]), []).append((c, d == len(built)))
    out, below = {}, {}
    for key in sorted(members, key=len, reverse=True):
        kids = [k for k in below if k[:-1] == key and k]
        own = (len(members[key]) - 1) * (len(key[-1][1].split()) if key else 0)
        below[key] = (sum(below[k][0] for k in kids) or 1, own + sum(below[k][1] for k in kids))
        ends = ",".join(str(c) for c in sorted(c for c, end in members[key] if end))
        parent = min(c for c, _ in members[key[:-1]]) if key else None
        least = min(c for c, _ in members[key])
        out[least, len(key)] = (
            parent, len(members[key]), len(kids), *below[key], hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(spark, rows, base, head, height):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS depth", "1 AS key", "2 AS place", "3 AS up")
    known = prefix_trie.turns(frame.repartition(5))
    out = prefix_trie.trie(*prefix_trie.regrown(known, F.expr(base), F.expr(head)), height).collect()
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    got = {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in out}
    assert len(got) == len(out)
    return got


def awkward(seed, n, depth):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.randrange(depth)):
            text = pick.choice(["a b", "a  b c", "x", "", None]) if pick.random() < 0.2 else "same words"
            rows.append((c, t, pick.choice(["user", None]) if pick.random() < 0.1 else "user", text))
    rows += [(41, None, "user", "first"), (41, None, "user", "first"), (None, 1, "user", "lost"), (-7, 0, "", "x " * 5000)]
    return rows + [(60, 0, "user", "own head")]  # its base is itself; 61 has a head and no turn of its own


CRC = "crc32(CAST(conv_id AS STRING)) % 4"


@pytest.mark.parametrize("height", [2, 3, 16])
def test_bands_of_any_height_give_the_same_trie(spark, height):
    rows = awkward(height, 45, 12)
    got = found(spark, rows, "conv_id - conv_id % 20", CRC, height)
    want = brute(rows, lambda c: c - int(c / abs(c) * (abs(c) % 20)) if c else 0, lambda c: zlib.crc32(str(c).encode()) % 4)
    assert got == want


def test_long_conversations_rise_through_several_levels(spark):
    rows = [(c, t, "user", f"w {t if t < 70 + c else c * 1000 + t}") for c in range(4) for t in range(90)]
    got = found(spark, rows, "conv_id", "0", 3)
    assert got == brute(rows, lambda c: c, lambda c: 0)


def test_copies_share_all_nodes(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(5000, 9300) for t in range(2)]
    got = found(spark, rows, "conv_id", "0", 16)
    ids = ",".join(map(str, range(5000, 9300)))
    assert got[5000, 2] == (5000, 4300, 0, 1, 4299 * 2, hashlib.sha256(ids.encode()).hexdigest())
    assert got[5000, 0][:5] == (None, 4300, 1, 1, 4299 * 4) and len(got) == 3


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = [(21, 0, "user", "a")]  # the base, 20, is not there, so the head is lost
    assert found(spark, rows, "conv_id - 1", "1", 16) == brute(rows, lambda c: c - 1, lambda c: 1)


def test_no_rows_no_nodes(spark):
    assert found(spark, [], "conv_id", "1", 16) == {}


def test_a_row_explodes_within_its_band_only(spark):
    rows = [(1, t, "user", "a") for t in range(300)]
    known = prefix_trie.turns(spark.createDataFrame(rows, SCHEMA))
    sizes = prefix_trie.paths(known.select("conv_id").distinct(), known, 4).select(
        F.array_max(F.transform("up", F.size)).alias("n"), F.size("up").alias("levels")).collect()
    assert len(sizes) == 301 and max(r["n"] for r in sizes) == 4 and max(r["levels"] for r in sizes) == 5
