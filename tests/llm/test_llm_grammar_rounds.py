from collections import Counter

import numpy as np
import pytest

from tramline.llm import grammar


def test_rounds_go_on_until_no_pair_is_frequent():
    """A long text without repeats must not stop the rounds while some pairs still pay."""
    rng = np.random.default_rng(1)
    phrase = rng.permutation(3000)[:64]
    apart = [x for _ in range(12) for x in (*phrase.tolist(), *rng.integers(3000, 30000, 4000).tolist())]
    symbols, rules = grammar.re_pair(np.array(apart), 30000)
    assert len(symbols) < len(apart) and rules
    pairs = symbols[:-1].astype(np.int64) << 16 | symbols[1:]
    assert np.unique(pairs, return_counts=True)[1].max() < grammar.LEAST


def test_late_rounds_count_only_places_that_may_be_frequent(monkeypatch):
    """Rounds with few rules must not sort all pairs of the shard anew."""
    rng = np.random.default_rng(2)
    phrase = rng.permutation(3000)[:256]
    apart = [x for _ in range(12) for x in (*phrase.tolist(), *rng.integers(3000, 30000, 4000).tolist())]
    counted, sort = [], np.sort
    monkeypatch.setattr(np, "sort", lambda x, *a, **b: counted.append(len(x)) or sort(x, *a, **b))
    monkeypatch.setattr(grammar, "ROUND_RULES", 16)
    _, rules = grammar.re_pair(np.array(apart), 30000)
    assert len(rules) > 200
    assert sum(counted) < 3 * len(apart)


def plain_rounds(symbols, n_symbols):
    """The rounds by their definition, all pairs counted in each."""
    rules = []
    slot = lambda a, b: ((a << 16 | b) * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - grammar.SLOTS
    while n_symbols < grammar.MAX_SYMBOLS:
        times = Counter(p for p in zip(symbols, symbols[1:]) if grammar.BORDER not in p)
        often = sorted((-k, p) for p, k in times.items() if k >= grammar.LEAST)
        new = {}
        for _, p in often[: min(grammar.ROUND_RULES, grammar.MAX_SYMBOLS - n_symbols)]:
            new.setdefault(slot(*p), p)
        if not new:
            break
        number = {p: n_symbols + i for i, p in enumerate(new.values())}
        out, i = [], 0
        while i < len(symbols):
            pair = tuple(symbols[i : i + 2])
            out.append(number.get(pair, symbols[i]))
            i += 2 if pair in number else 1
        symbols, n_symbols = out, n_symbols + len(number)
        rules += number
    return symbols, rules


@pytest.mark.parametrize("slots, round_rules, first", [(20, 4096, 60), (5, 4, 60), (4, 2, 65_530)])
def test_rounds_are_those_that_count_all_pairs(monkeypatch, slots, round_rules, first):
    monkeypatch.setattr(grammar, "SLOTS", slots)
    monkeypatch.setattr(grammar, "ROUND_RULES", round_rules)
    rng = np.random.default_rng(3)
    for size in [0, 1, 2, 5, 6, 7, *rng.integers(8, 1500, 60).tolist()]:
        symbols = rng.zipf(1.5, size) % int(rng.integers(1, 40))
        symbols[rng.random(size) < 0.02] = grammar.BORDER
        got, rules = grammar.re_pair(symbols, first)
        assert (got.tolist(), rules) == plain_rounds(symbols.tolist(), first)


@pytest.mark.parametrize("round_rules", [1, 3, 4096])
def test_expansions_follow_the_rules(monkeypatch, round_rules):
    """Rules of many rounds, of none, and symbols that nest deeply are made out as the ids they stand for."""
    monkeypatch.setattr(grammar, "ROUND_RULES", round_rules)
    rng = np.random.default_rng(4)
    phrase = rng.integers(0, 50, 40)
    for docs in ([np.tile(phrase, 30), np.full(700, 7)], [np.array([2])], [rng.integers(0, 6, 900), phrase]):
        ids = np.concatenate(docs).astype(np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        shard = grammar.compress(ids, offsets, np.arange(len(docs)), np.zeros(len(docs)))
        held = [[x] for x in shard.terminals.tolist()]
        for a, b in shard.rules.tolist():
            held.append(held[a] + held[b])
        out, at = grammar.Shard.from_bytes(shard.to_bytes()).expansions()
        assert [out[a:b].tolist() for a, b in zip(at, at[1:])] == held


def test_expansions_work_on_rounds_not_on_rules(monkeypatch):
    docs = np.random.default_rng(5).integers(0, 60, 60_000).astype(np.uint32)
    shard = grammar.compress(docs, np.array([0, len(docs)]), np.zeros(1), np.zeros(1))
    calls, concatenate = [], np.concatenate
    monkeypatch.setattr(np, "concatenate", lambda *a, **b: calls.append(1) or concatenate(*a, **b))
    shard.expansions()
    assert len(shard.rules) > 1000 and len(calls) < 100
