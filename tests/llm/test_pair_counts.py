"""Counting pairs for the grammar: bins that several pairs share."""

import numpy as np

from gridflow.llm import grammar


def place_of(pairs):
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - grammar.BIN_BITS)).astype(np.int32)


def sharing():
    """Two pairs of ids below 1000 that fall into one bin."""
    ids = np.arange(1000, dtype=np.uint64)
    pairs = ((ids[:, None] << np.uint64(32)) | ids).ravel()
    bins = place_of(pairs)
    order = np.argsort(bins, kind="stable")
    at = np.flatnonzero(bins[order][1:] == bins[order][:-1])[0]
    return pairs[order[at]], pairs[order[at + 1]]


def test_distinct_pairs_are_told_apart_within_a_bin():
    a, b = sharing()
    values = np.random.default_rng(3).choice(np.array([a, b, 5, 7 << 32], np.uint64), 500)
    for found, wanted in zip(grammar.distinct(values, place_of(values), place_of),
                             np.unique(values, return_inverse=True, return_counts=True)):
        assert np.array_equal(found, wanted)


def test_pairs_left_out_do_not_have_all_others_looked_through(monkeypatch):
    """Two pairs of 20 places each fill a bin and make no rule; a third one, found less often than the bin is full, does."""
    looked, isin, fresh = [], np.isin, iter(range(10_000, 1_000_000))
    monkeypatch.setattr(np, "isin", lambda x, *more: (looked.append(len(x)), isin(x, *more))[1])
    a, b = ([int(p) >> 32, int(p) & 0xFFFFFFFF] for p in sharing())
    ids = [i for n in range(20) for i in (*a, next(fresh), *b, next(fresh))]
    ids += [i for n in range(33) for i in (2001, 2002, next(fresh))] + [next(fresh) for n in range(3000)]
    starts = np.zeros(len(ids), bool)
    starts[0] = True
    symbols, _, left, right = grammar.replace_pairs(np.array(ids, np.uint32), starts, 1_000_000)
    assert (left.tolist(), right.tolist()) == ([2001], [2002]) and len(symbols) == len(ids) - 33
    assert looked and max(looked) < 100


def test_only_pairs_around_replaced_places_are_counted_again(monkeypatch):
    """Many rounds of few replacements in a long sequence: all pairs are counted once, then a few each round."""
    counted, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *more, **named: (counted.append(len(x)), bincount(x, *more, **named))[1])
    rare = np.random.default_rng(5).permutation(np.arange(100, 60_100, dtype=np.uint32))
    ids = np.concatenate([np.tile(np.arange(40, dtype=np.uint32), 40), rare])
    starts = np.zeros(len(ids), bool)
    starts[0] = True
    symbols, _, left, right = grammar.replace_pairs(ids, starts, 100_000)
    assert np.array_equal(grammar.expand(symbols, grammar.expansions(left, right, 100_000), 100_000), ids)
    assert len(left) == 40 and max(counted[1:]) < 6000
