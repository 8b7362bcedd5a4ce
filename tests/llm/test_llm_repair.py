"""Repair of conversations against a search over all short strings of edits."""

import itertools
import random
import re

import pytest

from tramline.llm import conversation_repair as repair
from tramline.llm.edit_paths import EditPaths

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
GOOD = re.compile(r"(s?(ua)+)?")


def states(role, must_go, cut):
    """Edits of one row: letter, cost, the initial it leaves."""
    yield "D", 2, ""
    if not must_go:
        extra = 5 if cut else 0
        yield "K", extra, role[:1] or "?"
        for initial in "ua":
            yield "R", 1 + extra, initial


def cheapest(rows):
    """Over all edits of all rows and up to two rows put in at each gap."""
    gaps = [(("I" * len(g)), 5 * len(g), g) for n in range(3) for g in map("".join, itertools.product("ua", repeat=n))]
    best = None
    parts = [gaps]
    for row in rows:
        parts += [list(states(*row)), gaps]
    for edits in itertools.product(*parts):
        if GOOD.fullmatch("".join(e[2] for e in edits)):
            found = sum(e[1] for e in edits), "".join(e[0] for e in edits)
            best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("collect_at", [4, 1 << 20])
def test_audits_are_cheapest_and_least(collect_at):
    pick = random.Random(7)
    for _ in range(60):
        rows = [(pick.choice(["user", "assistant", "system", "tool", ""]), pick.random() < 0.2, pick.random() < 0.2)
                for _ in range(pick.randrange(4))]
        own = repair.Repair(EditPaths(collect_at=collect_at))
        for role, must_go, cut in rows:
            own.row(role[:1], must_go, cut)
        assert own.best() == cheapest(rows), rows


def test_collisions_of_hashes_do_not_change_the_order():
    pick = random.Random(3)
    for prime in (2, 7, (1 << 61) - 1):
        paths = EditPaths(base=3, prime=prime)
        nodes, texts = [0], [b""]
        known = {b"": 0}
        for _ in range(400):
            k = pick.randrange(len(nodes))
            text = texts[k] + bytes([pick.choice(b"DIKR")])
            if text not in known:
                known[text] = paths.add(nodes[k], text[-1])
                nodes.append(known[text])
                texts.append(text)
        for _ in range(2000):
            a, b = pick.randrange(len(nodes)), pick.randrange(len(nodes))
            assert paths.less(nodes[a], nodes[b]) == (texts[a] < texts[b])


def frame(spark, rows):
    built = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS digest", "1 AS audit", "2 AS part", "3 AS place")
    return built.repartition(5)


def test_reports_and_repaired_rows(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes!"),
        (2, 0, "user", "Hello."), (2, 2, "user", "Again."), (2, 3, "assistant", "Yes."),
        (3, 5, "assistant", " \t"), (3, None, None, None),
        (4, 0, "system", "Be good."), (4, 1, "user", "Cut here"), (4, 2, "assistant", "So."),
        (None, 0, "user", "No id."), (None, 1, "assistant", "None."),
        (5, 0, "user", "x" * 300000 + "."), (5, 1, "user", "x" * 300000 + "."), (5, 2, "assistant", "End?"),
    ]
    report, repaired = repair.repair(frame(spark, rows))
    got = {r["conv_id"]: tuple(r)[1:] for r in report.collect()}
    assert got == {
        1: (2, 0, 0, 0, 0, 0, 0, "KK"),
        2: (3, 1, 0, 0, 0, 1, 2, "DKK"),
        3: (2, 0, 2, 0, 0, 1, 4, "DD"),
        4: (3, 0, 0, 0, 1, 0, 3, "RDK"),
        None: (2, 0, 0, 0, 0, 0, 0, "KK"),
        5: (3, 0, 0, 1, 0, 1, 2, "KDK"),
    }
    out = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["conv_id"] or 0, r["place"])):
        out.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"][:6]))
    assert out[2] == [("K", "user", "Again."), ("K", "assistant", "Yes.")]
    assert 3 not in out and len(out[5]) == 2 and len(out[None]) == 2


def test_long_conversations_stay_within_their_paths(spark):
    rows = [(1, t, ("user", "tool", "assistant")[t % 3], f"Row {t}.") for t in range(6000)]
    report = repair.audit(frame(spark, rows)).collect()
    assert len(report) == 1 and report[0]["audit"].count("I") == 0 and len(report[0]["audit"]) == 6000


def test_empty_tables(spark):
    report, repaired = repair.repair(frame(spark, []))
    assert report.count() == 0 and repaired.count() == 0
